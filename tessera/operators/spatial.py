"""Point-in-polygon joins over a multi-level uniform grid (``ST_Within`` joins).

Plan
----
1. ``prepare_polygons``: coordinates -> edge list + bounding box (once per polygon set).
2. ``plan_grid``: pick a cell side (median bbox side unless given) and, per polygon,
   the finest level whose cells its bbox touches at most ``max_cells`` times, or as often
   as it has edges if those are many (level ``L`` has side ``cell_size * FAN**L``).  Large polygons therefore move to
   coarser levels instead of being replicated into many cells, and no polygon is
   ever dropped.  One small aggregate job over the (bounded) polygon side returns
   the used levels and the size of the cell table.
3. The polygon side explodes to ``(level, gx, gy)`` rows that hold only the edges a ray
   from the cell can meet; cells without an edge inside are whole or gone.  Each point
   computes its cell at every used level; the join is an equi-join on the cell key
   followed by a bbox test and the ray cast.  A point meets each polygon at most once,
   so no de-duplication is needed.

The cell table is broadcast only when its estimated size is under
``max_broadcast_bytes``; otherwise both sides shuffle on the cell key, and a cell with more
than a task's share of the points is dealt over several salted keys.  The point side is never broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.geometry import EDGES_TYPE, edges_bbox, polygon_edges, within
from ..session import ensure_checkpoint_dir
from .strategy import with_strategy

FAN = 4
FEW_EDGES = 24
_INTERNAL = ("__lvl", "__gx", "__gy", "__plvl", "__pgx", "__pgy")


@dataclass(frozen=True)
class GridSpec:
    cell_size: float
    levels: tuple[int, ...]
    broadcast: bool
    cell_rows: int
    most_edges: int = 1 << 30

    def side(self, level: int) -> float:
        return self.cell_size * (FAN ** level)


def prepare_polygons(df: DataFrame, geometry: str = "geometry", edges: str = "edges",
                     keep_geometry: bool = False) -> DataFrame:
    """Add ``edges`` and the bbox columns; polygons without edges are dropped (they hold no point)."""
    if edges not in df.columns:
        df = df.withColumn(edges, polygon_edges(F.col(geometry)))
        if not keep_geometry:
            df = df.drop(geometry)
    df = df.withColumns(edges_bbox(edges))
    return df.filter(F.size(edges) > 0)


def _floor_div(c: Column, side: float) -> Column:
    return F.floor(c / F.lit(side))


def _dbl(v: float) -> str:
    """A double literal for SQL text (a bare ``10.0`` would be a decimal)."""
    return f"CAST({float(v)!r} AS DOUBLE)"


def _ncells_sql(side: str) -> str:
    return (f"((floor(x_max / {side}) - floor(x_min / {side}) + 1)"
            f" * (floor(y_max / {side}) - floor(y_min / {side}) + 1))")


def _level_expr(cell_size: float, max_cells: int, max_level: int) -> Column:
    # Built as one SQL expression: a single call instead of hundreds of column builders.
    limit = f"(CASE WHEN size(edges) > {FEW_EDGES} THEN greatest({int(max_cells)}, size(edges)) ELSE {int(max_cells)} END)"
    opts = [f"CASE WHEN {_ncells_sql(_dbl(cell_size * FAN ** lv))} <= {limit} THEN {lv} END"
            for lv in range(max_level)]
    return F.expr(f"coalesce({', '.join(opts)}, {int(max_level)})")


def _side_sql(level: str, spec_size: float, levels) -> str:
    whens = " ".join(f"WHEN {lv} THEN {_dbl(spec_size * FAN ** lv)}" for lv in levels)
    return f"(CASE {level} {whens} ELSE raise_error('a polygon needs a grid level that spec lacks: plan the grid for these polygons') END)"


def plan_grid(prepared: DataFrame, cell_size: float | None = None, max_cells: int = 16,
              max_level: int = 16, max_broadcast_bytes: int = 256 << 20) -> GridSpec:
    """Grid parameters from one or two small aggregates over the polygon side."""
    if cell_size is None:
        side = F.greatest(F.col("x_max") - F.col("x_min"), F.col("y_max") - F.col("y_min"))
        # a polygon of many edges is cut into about as many cells, so that a place meets few of them
        side = side / F.when(F.size("edges") > FEW_EDGES, F.greatest(F.lit(1.0), F.sqrt(F.size("edges")) - 1)).otherwise(1.0)
        row = prepared.agg(F.percentile_approx(side, 0.5).alias("s"), F.max(side).alias("m")).first()
        cell_size = row["s"] if row and row["s"] else (row["m"] if row and row["m"] else 1.0)
        if cell_size <= 0:
            cell_size = 1.0
    lvl = _level_expr(cell_size, max_cells, max_level)
    others = [F.col(f"`{c}`") for c in prepared.columns if c not in ("edges", "x_min", "x_max", "y_min", "y_max")]
    width = F.octet_length(F.to_json(F.struct(*others))) if others else F.lit(0)  # these go along into every cell
    sized = prepared.select(lvl.alias("lvl"), F.size("edges").alias("ne"), width.cast("long").alias("width"),
                            "x_min", "x_max", "y_min", "y_max", "edges")
    sized = sized.withColumn("side", F.expr(_side_sql("lvl", cell_size, range(max_level + 1))))
    sized = sized.withColumn("nc", F.expr(_ncells_sql("side")))
    # clipped edges go into the cells of their rows (see ``_cell_edges``)
    rows_met = F.aggregate("edges", F.lit(0.0), lambda a, e: a + F.abs(e["y2"] - e["y1"])) / F.col("side") + 2 * F.col("ne")
    copies = F.col("nc") * F.col("ne")
    clipped = rows_met * ((F.col("x_max") - F.col("x_min")) / F.col("side") + 2)
    copies = F.when(F.col("ne") > FEW_EDGES, F.least(copies.cast("double"), clipped)).otherwise(copies)
    row = sized.agg(
        F.sort_array(F.collect_set("lvl")).alias("levels"),
        F.sum("nc").alias("rows"),
        F.sum(copies * 40 + F.col("nc") * (F.col("width") + 96)).alias("bytes"), F.max("ne").alias("most"),
    ).first()
    used = tuple(row["levels"] or [0])
    rows = int(row["rows"] or 0)
    est = int(row["bytes"] or 0)
    return GridSpec(float(cell_size), used, est <= max_broadcast_bytes, rows, int(row["most"] or 0))


def polygon_cells(prepared: DataFrame, spec: GridSpec, max_cells: int = 16, max_level: int = 16) -> DataFrame:
    """One row per (polygon, covering cell) with ``__lvl, __gx, __gy``."""
    df = prepared.withColumn("__lvl", _level_expr(spec.cell_size, max_cells, max_level))
    side = _side_sql("__lvl", spec.cell_size, spec.levels)
    cells = F.expr(
        f"explode(flatten(transform(sequence(floor(x_min / {side}), floor(x_max / {side})), "
        f"i -> transform(sequence(floor(y_min / {side}), floor(y_max / {side})), "
        f"j -> named_struct('gx', i, 'gy', j)))))")
    out = df.withColumn("__cell", cells)
    return out.withColumns({"__gx": F.col("__cell.gx"), "__gy": F.col("__cell.gy")}).drop("__cell")


def _point_cells(points: DataFrame, x: str, y: str, spec: GridSpec) -> DataFrame:
    px, py = F.col(x), F.col(y)
    if len(spec.levels) == 1:
        s = spec.side(spec.levels[0])
        return points.withColumns({"__plvl": F.lit(spec.levels[0]),
                                   "__pgx": _floor_div(px, s), "__pgy": _floor_div(py, s)})
    keys = F.array(*[F.struct(F.lit(lv).alias("l"), _floor_div(px, spec.side(lv)).alias("gx"),
                              _floor_div(py, spec.side(lv)).alias("gy")) for lv in spec.levels])
    out = points.withColumn("__pk3", F.explode(keys))
    return out.withColumns({"__plvl": F.col("__pk3.l"), "__pgx": F.col("__pk3.gx"),
                            "__pgy": F.col("__pk3.gy")}).drop("__pk3")


def _cell_edges(cells: DataFrame, spec: GridSpec, edges: str = "edges") -> DataFrame:
    """Each cell's row with the edges that matter to its places, ``edges``, and ``__whole``: the polygon covers the cell.

    A ray towards larger x from a place of the cell can only meet edges of the cell's rows that do not lie to its left.
    A cell that no edge enters is covered wholly or not at all: its middle decides, and cells not covered go.  Polygons of
    a few edges (``FEW_EDGES``) are taken as they are: there is nothing to save.
    """
    if spec.most_edges <= FEW_EDGES:
        return cells.withColumns({"__own": F.col(edges), "__whole": F.lit(False)})
    side = F.expr(_side_sql("__lvl", spec.cell_size, spec.levels))
    slack = 1e-9  # of a side: a place on the line between two cells may round into either
    cells = cells.withColumns({"__cx0": (F.col("__gx") - slack) * side, "__cx1": (F.col("__gx") + 1 + slack) * side,
                               "__cy0": (F.col("__gy") - slack) * side, "__cy1": (F.col("__gy") + 1 + slack) * side})
    x0, x1, y0, y1 = (F.col(c) for c in ("__cx0", "__cx1", "__cy0", "__cy1"))

    def in_rows(e: Column) -> Column:
        return (F.greatest(e.y1, e.y2) >= y0) & (F.least(e.y1, e.y2) <= y1) & (F.greatest(e.x1, e.x2) >= x0)

    cells = cells.withColumn("__own", F.filter(edges, in_rows))
    entered = F.exists("__own", lambda e: F.least(e.x1, e.x2) <= x1)
    middle = within((x0 + x1) / 2, (y0 + y1) / 2, "__own")
    cells = cells.withColumn("__whole", F.when(entered, F.lit(False)).when(middle, F.lit(True)))
    return cells.where(F.col("__whole").isNotNull()).drop("__cx0", "__cx1", "__cy0", "__cy1").withColumn(
        "__own", F.when(F.col("__whole"), F.array().cast(EDGES_TYPE)).otherwise(F.col("__own")))


def _salted(points: DataFrame, cells: DataFrame, tasks: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``__salt``: a cell with over a task's share of the points is dealt over several keys.

    The hot cells are found by one aggregate over the points' cells; there can't be more than ``tasks`` of them, so their
    table is broadcast.
    """
    counts = points.groupBy("__plvl", "__pgx", "__pgy").agg(F.count(F.lit(1)).alias("__n")).checkpoint(eager=True)
    total = counts.agg(F.sum("__n")).first()[0] or 0
    share = max(1, -(-total // tasks))
    hot = counts.where(F.col("__n") > share).select(F.col("__plvl").alias("__hl"), F.col("__pgx").alias("__hx"), F.col("__pgy").alias("__hy"),
                                                    F.ceil(F.col("__n") * 2 / share).cast("int").alias("__salts"))
    hot = F.broadcast(hot)
    salts = F.coalesce("__salts", F.lit(1))
    points = points.join(hot, (F.col("__plvl") == F.col("__hl")) & (F.col("__pgx") == F.col("__hx")) & (F.col("__pgy") == F.col("__hy")), "left")
    points = points.withColumn("__psalt", F.pmod(F.monotonically_increasing_id(), salts).cast("int")).drop("__hl", "__hx", "__hy", "__salts")
    cells = cells.join(hot, (F.col("__lvl") == F.col("__hl")) & (F.col("__gx") == F.col("__hx")) & (F.col("__gy") == F.col("__hy")), "left")
    cells = cells.withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("__hl", "__hx", "__hy", "__salts")
    return points, cells


def _planned(points: DataFrame, polygons: DataFrame, spec: GridSpec | None, cell_size: float | None, max_cells: int,
             max_broadcast_bytes: int) -> tuple[DataFrame, GridSpec]:
    prepared = polygons if {"edges", "x_min"}.issubset(polygons.columns) else prepare_polygons(polygons)
    clash = set(points.columns) & set(prepared.columns)
    if clash:
        raise ValueError(f"points and polygons share column names {sorted(clash)}; rename one side")
    if spec is None:
        # The polygon side is bounded; write it once to the checkpoint folder so the
        # sizing job and the join read it instead of recomputing its lineage twice.
        ensure_checkpoint_dir(prepared.sparkSession)
        prepared = prepared.checkpoint(eager=True)
        spec = plan_grid(prepared, cell_size, max_cells, max_broadcast_bytes=max_broadcast_bytes)
    return prepared, spec


def spatial_join(points: DataFrame, polygons: DataFrame, x: str = "x", y: str = "y", how: str = "inner",
                 cell_size: float | None = None, strategy: str | None = None, max_cells: int = 16,
                 keep_edges: bool = False, spec: GridSpec | None = None,
                 max_broadcast_bytes: int = 256 << 20, boundary: str = "half_open") -> DataFrame:
    """Pair each point with every polygon that contains it.

    ``how="inner"`` keeps matches only; ``how="left"`` also keeps unmatched points
    with NULL polygon columns.  ``polygons`` may be raw (``geometry`` coordinates) or
    already prepared (``edges`` + bbox).  ``strategy`` forces a join hint on the
    polygon-cell side (BROADCAST, MERGE, SHUFFLE_HASH); a broadcast, asked for or by
    default, is size-checked (edges and all other columns).  Where the points are shuffled,
    the keys of hot cells are salted by their counts.  ``boundary`` says how a point on an
    edge counts (see :func:`~tessera.functions.geometry.within`).
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    prepared, spec = _planned(points, polygons, spec, cell_size, max_cells, max_broadcast_bytes)
    if strategy and strategy.upper() == "BROADCAST" and not spec.broadcast:
        strategy = None  # the cells are beyond the limit: the optimizer chooses
    drop = list(_INTERNAL) + ["__own", "__whole", "__psalt", "__salt", "x_min", "x_max", "y_min", "y_max"] + ([] if keep_edges else ["edges"])
    shuffles = (strategy or "").upper() in ("MERGE", "SHUFFLE_HASH") or not (strategy or spec.broadcast)
    if how == "left":
        # a point with no match needs its row once: its matches are gathered in-row, then exploded
        hit_type = [c for c in prepared.columns if c not in drop or (c == "edges" and keep_edges)]
        out = tag_points(points, prepared, hit_type, x, y, strategy=strategy, max_cells=max_cells, spec=spec, boundary=boundary, hits="__hit")
        out = out.withColumn("__hit", F.explode_outer("__hit"))
        return out.select(*points.columns, *[F.col("__hit")[c].alias(c) for c in hit_type])
    cells = _cell_edges(polygon_cells(prepared, spec, max_cells), spec)
    if not keep_edges:
        cells = cells.drop("edges")
    pts = _point_cells(points, x, y, spec)
    px, py = F.col(x), F.col(y)
    keyed = (F.col("__pgx") == F.col("__gx")) & (F.col("__pgy") == F.col("__gy"))
    if shuffles:
        pts, cells = _salted(pts, cells, int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        keyed = keyed & (F.col("__psalt") == F.col("__salt"))
    if strategy:
        cells = with_strategy(cells, strategy)
    elif spec.broadcast:
        cells = F.broadcast(cells)
    if len(spec.levels) > 1:
        keyed = keyed & (F.col("__plvl") == F.col("__lvl"))
    box = (px >= F.col("x_min")) & (px <= F.col("x_max")) & (py >= F.col("y_min")) & (py <= F.col("y_max"))
    return pts.join(cells, keyed & box & (F.col("__whole") | within(px, py, F.col("__own"), boundary)), "inner").drop(*drop)


def tag_points(points: DataFrame, polygons: DataFrame, columns, x: str = "x", y: str = "y", cell_size: float | None = None,
               strategy: str | None = None, max_cells: int = 16, spec: GridSpec | None = None,
               max_broadcast_bytes: int = 256 << 20, boundary: str = "half_open", hits: str = "hits") -> DataFrame:
    """``points`` with ``hits``: an array of the polygon ``columns`` of every polygon that holds the point, one row a point.

    Per grid level a point meets the list of polygons of its one cell and keeps those that contain it, so
    points need no key and are not grouped.
    """
    prepared, spec = _planned(points, polygons, spec, cell_size, max_cells, max_broadcast_bytes)
    cells = _cell_edges(polygon_cells(prepared, spec, max_cells), spec)
    px, py = F.col(x), F.col(y)
    out, found = points, []
    entry = F.struct(F.struct(*[F.col(c) for c in columns]).alias("row"), F.col("__own").alias("own"), F.col("__whole").alias("whole"),
                     "x_min", "x_max", "y_min", "y_max")
    for lv in spec.levels:
        side = spec.side(lv)
        per_cell = (cells.filter(F.col("__lvl") == lv).groupBy(F.col("__gx").alias(f"__gx{lv}"), F.col("__gy").alias(f"__gy{lv}"))
                    .agg(F.collect_list(entry).alias(f"__pl{lv}")))
        if strategy:
            per_cell = with_strategy(per_cell, strategy)
        elif spec.broadcast:
            per_cell = F.broadcast(per_cell)
        out = out.withColumns({f"__px{lv}": _floor_div(px, side), f"__py{lv}": _floor_div(py, side)})
        out = out.join(per_cell, (F.col(f"__px{lv}") == F.col(f"__gx{lv}")) & (F.col(f"__py{lv}") == F.col(f"__gy{lv}")), "left")
        inside = F.filter(F.coalesce(F.col(f"__pl{lv}"), F.array().cast(per_cell.schema[f"__pl{lv}"].dataType)),
                          lambda p: (px >= p["x_min"]) & (px <= p["x_max"]) & (py >= p["y_min"]) & (py <= p["y_max"])
                          & (p["whole"] | within(px, py, p["own"], boundary)))
        out = out.withColumn(f"__hit{lv}", F.transform(inside, lambda p: p["row"]))
        out = out.drop(f"__px{lv}", f"__py{lv}", f"__gx{lv}", f"__gy{lv}", f"__pl{lv}")
        found.append(f"__hit{lv}")
    return out.withColumn(hits, F.concat(*[F.col(c) for c in found])).drop(*found)
