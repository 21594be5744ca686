"""Nearest and k-nearest site per point, on the plane or on the sphere, exact, with ties.

Sites are first reduced to distinct *locations* carrying their multiplicity (and, for k-nearest, the k best site rows at
that spot), so a pile of sites at one place is one entry.  Then

1. *Occupied cells.*  Points fall into the cells of a grid: on the plane its side follows the sites' spacing inside their
   bounding box and grows with the distance from it, so there are about as many cells a ring as inside; on the sphere the cells
   are those of the points' unit vectors, so poles and the date line are places like any other.  One aggregate over
   the points' coordinates gives the cells that hold a point at all.
2. *Candidates by cell.*  For each such cell a search over the packed tree of locations (:mod:`.site_index`) finds every
   location that can be among the k nearest anywhere in it, and only those.  A cell with many of them (dense sites) is cut
   into smaller ones in the same task until its list is short.  Work and size follow the sites and the cells, not the points.
3. *One streaming join.*  A point meets the one row of its cell by an equi-join and picks its best entries in-row.  Nothing
   of the point side is written, shuffled or searched again.

Locations reach the tasks as one index of at most ``index_sites`` of them; more locations are dealt into several indexes, and
a point concatenates its candidates from each before it picks.  Cell tables are broadcast under a byte limit, else
both sides shuffle by cell.  The point side is never broadcast.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.geometry import EARTH_RADIUS_M, sphere_distance
from ..session import ensure_checkpoint_dir
from .site_index import SiteIndex, leaf_cells

#: Parts a dimension that a crowded cell is cut into, and how often at most.
FAN, DEEPEST = 4, 20
RINGS = 24


def _dist(px: Column, py: Column, qx: Column, qy: Column) -> Column:
    dx = qx - px
    dy = qy - py
    return F.sqrt(dx * dx + dy * dy)


def _select(frame: DataFrame, cands: str, distance, k: int, ties: bool) -> DataFrame:
    """Add ``__pick`` (chosen entries with rank), ``__kth`` (k-th distance, counting
    multiplicity) from a candidate list.  ``distance`` makes the distance column of a site's coordinates.

    Lambda bodies use only their own variables, literals and join-output columns, and
    every intermediate array used twice is its own column, so nothing is re-evaluated
    per element or per reference.
    """
    c_ = F.col(cands)
    if ties and k == 1:
        # distances once, a native minimum, then the tied entries by a zipped filter
        frame = frame.withColumn("__d", F.transform(c_, lambda c: distance(c["__sx"], c["__sy"])))
        frame = frame.withColumn("__kth", F.array_min("__d"))
        zipped = F.arrays_zip(F.col("__d").alias("d"), c_.alias("c"),
                              F.array_repeat("__kth", F.size("__d")).alias("m"))
        pick = F.transform(F.filter(zipped, lambda e: e["d"] == e["m"]), lambda e: F.struct(
            e["d"].alias("d"), e["c"]["__sx"].alias("sx"), e["c"]["__sy"].alias("sy"),
            F.lit(1).cast("long").alias("rk")))
        return frame.withColumn("__pick", pick).drop("__d")
    if ties:
        # rank semantics: sorted by distance, rank = 1 + sites strictly closer
        scored = F.sort_array(F.transform(c_, lambda c: F.struct(
            distance(c["__sx"], c["__sy"]).alias("d"), c["__sx"].alias("sx"), c["__sy"].alias("sy"),
            c["__m"].alias("m"))))
        init = F.struct(F.lit(0).cast("long").alias("cum"), F.lit(None).cast("double").alias("ld"),
                        F.lit(0).cast("long").alias("lr"), F.lit(None).cast("double").alias("kth"),
                        F.array().cast("array<struct<d:double,sx:double,sy:double,rk:bigint>>").alias("a"))

        def step(acc, z):
            rk = F.when(z["d"] == acc["ld"], acc["lr"]).otherwise(acc["cum"] + 1)
            cum = acc["cum"] + z["m"]
            kth = F.when(acc["kth"].isNull() & (cum >= k), z["d"]).otherwise(acc["kth"])
            pick = F.struct(z["d"].alias("d"), z["sx"].alias("sx"), z["sy"].alias("sy"), rk.alias("rk"))
            a = F.when(rk <= k, F.concat(acc["a"], F.array(pick))).otherwise(acc["a"])
            return F.struct(cum.alias("cum"), z["d"].alias("ld"), rk.alias("lr"), kth.alias("kth"), a.alias("a"))

        frame = frame.withColumn("__res", F.aggregate(scored, init, step))
        return frame.withColumns({"__pick": F.col("__res.a"), "__kth": F.col("__res.kth")}).drop("__res")
    # Row-number semantics.  Rank locations by compact (d, first tie key with NULLs last, its site row) keys; the
    # global top k entries all come from the first k locations in that order, so only
    # those are expanded into their site rows and re-sorted (exact also when several
    # locations tie on distance).
    keys = F.sort_array(F.transform(c_, lambda c, i: F.struct(
        distance(c["__sx"], c["__sy"]).alias("d"), F.isnull(c["__firstk"][0]["t"]).alias("tn"),
        c["__firstk"][0]["t"].alias("t"), c["__firstk"][0]["r"].alias("r"), i.alias("ci"))))
    expanded = F.sort_array(F.flatten(F.transform(F.slice(keys, 1, k), lambda e: F.transform(
        F.element_at(c_, e["ci"] + 1)["__firstk"],
        lambda f: F.struct(e["d"].alias("d"), F.isnull(f["t"]).alias("tn"), f["t"].alias("t"), f["r"].alias("r"))))))
    frame = frame.withColumn("__exp", expanded)
    chosen = F.transform(F.slice("__exp", 1, k), lambda e, i: F.struct(
        e["d"].alias("d"), e["t"].alias("t"), e["r"].alias("r"), (i + 1).cast("long").alias("rk")))
    return frame.withColumns({"__pick": chosen, "__kth": F.try_element_at("__exp", F.lit(k))["d"]}).drop("__exp")


def _unit_vectors(lon: np.ndarray, lat: np.ndarray) -> np.ndarray:
    lon, lat = np.radians(lon), np.radians(lat)
    return np.stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)], axis=1)


def _cell_columns(x: Column, y: Column, sphere: bool, side: float, box) -> tuple[Column, list[Column]]:
    """(ring, coordinates to be divided by the cell side): ring r has cells of ``side * FAN**r``."""
    if sphere:
        lon, lat = F.radians(x), F.radians(y)
        return F.lit(0), [F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat)]
    x0, x1, y0, y1 = box
    reach = max((x1 - x0) / 2, (y1 - y0) / 2, side)
    off = F.greatest(F.abs(x - (x0 + x1) / 2), F.abs(y - (y0 + y1) / 2)) / F.lit(reach)
    # one logarithm: a sum of a step for each ring grows past what the JVM compiles
    return F.when(off > 1.0, F.least(F.lit(RINGS), F.ceil(F.log(float(FAN), off)).cast("int"))).otherwise(0), [x, y]


def _leaves(cells: DataFrame, index: SiteIndex, places: np.ndarray, side: float, k: int, most: int, sphere: bool, deepest: int) -> DataFrame:
    """ring, depth, c0, c1 (, c2), cands (array of site coordinates and multiplicity): the cells' parts and their candidates."""
    dims = 3 if sphere else 2
    names = [f"c{d}" for d in range(dims)]
    shared = cells.sparkSession.sparkContext.broadcast((vars(index), places))  # plain arrays: tasks need no package to read them

    def run(batches):
        index_, places_ = SiteIndex.__new__(SiteIndex), shared.value[1]
        vars(index_).update(shared.value[0])
        x, y, m = places_[index_.order, 0], places_[index_.order, 1], index_.weight
        for b in batches:
            if not b.num_rows:
                continue
            ring, above = b.column("ring").to_numpy().astype(np.int64), b.column("depth").to_numpy().astype(np.int64)
            own = np.stack([b.column(c).to_numpy() for c in names], axis=1)
            for root, depth, cell, starts, sites in leaf_cells(index_, own, side * float(FAN) ** (ring - above), k, most, FAN, deepest, sphere):
                entry = pa.StructArray.from_arrays([pa.array(x[sites]), pa.array(y[sites]), pa.array(m[sites])], ["__sx", "__sy", "__m"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ring[root].astype(np.int32)), pa.array((above[root] + depth).astype(np.int32))] + [pa.array(cell[:, d]) for d in range(dims)]
                    + [pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), entry)], ["ring", "depth", *names, "cands"])

    kinds = ", ".join(f"{c} long" for c in names)
    return cells.mapInArrow(run, f"ring int, depth int, {kinds}, cands array<struct<__sx:double,__sy:double,__m:long>>")


def nearest(points: DataFrame, sites: DataFrame, x: str, y: str, site_x: str, site_y: str, k: int = 1,
            ties: bool = True, site_order: str | None = None, distance_col: str = "distance",
            rank_col: str | None = None, cell_size: float | None = None, max_cell_sites: int | None = None,
            max_broadcast_bytes: int = 256 << 20, compete_by: str | None = None, use_sphere: bool = False,
            radius: float = EARTH_RADIUS_M, index_sites: int = 2_000_000) -> DataFrame:
    """Join every point with its ``k`` nearest sites.

    ``ties=True``: rank semantics -- every site whose rank (1 + number of strictly closer
    sites) is at most k (``RANK() <= k``); with ``k=1`` all equally near sites.
    ``ties=False``: exactly ``min(k, #sites)`` sites ordered by distance, then
    ``site_order``, then the site row (``ROW_NUMBER() <= k``).

    ``use_sphere=True`` takes x as longitude and y as latitude in degrees and measures great-circle
    distances on a sphere of ``radius`` (metres by default); otherwise distances are planar, in the unit of the input.

    Points or sites with a NULL, NaN or infinite coordinate are left out.  ``compete_by``
    reproduces a window partitioned by a non-unique point key: rows sharing the key keep
    only the pairs at the key's smallest distance.  ``max_cell_sites`` is the number of candidates
    from which a cell is cut into smaller ones.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    spark = points.sparkSession
    ensure_checkpoint_dir(spark)
    site_cols, point_cols = sites.columns, points.columns
    clash = set(point_cols) & set(site_cols)
    if clash:
        raise ValueError(f"points and sites share column names {sorted(clash)}; rename one side")

    def valid(c: str) -> Column:
        return F.abs(F.col(c).cast("double")) < F.lit(float("inf"))  # NaN is above every number; NULL is not true

    def place(c: str) -> Column:
        return F.col(c).cast("double") + F.lit(0.0)  # one zero

    tie = F.col(site_order) if site_order else F.lit(None).cast("long")
    S = sites.filter(valid(site_x) & valid(site_y)).select(
        place(site_x).alias("__sx"), place(site_y).alias("__sy"), tie.alias("__tie"), F.struct(*[F.col(c) for c in site_cols]).alias("__row"))
    locs = S.groupBy("__sx", "__sy").agg(F.count(F.lit(1)).alias("__m"))
    few = locs.limit(index_sites + 1).toArrow()
    if few.num_rows <= index_sites:  # all of them
        own = [few.column(c).to_numpy() for c in range(3)]
        n_sites, n_locs = int(own[2].sum()), few.num_rows
        box = tuple(float(v) for c in own[:2] for v in (c.min(), c.max())) if n_locs else None
    else:
        few, locs = None, locs.checkpoint(eager=True)
        st = locs.agg(F.sum("__m").alias("n"), F.count(F.lit(1)).alias("locs"), F.min("__sx"), F.max("__sx"), F.min("__sy"), F.max("__sy")).first()
        n_sites, n_locs, box = int(st["n"]), int(st["locs"]), tuple(st[2:])
    out_cols = point_cols + site_cols + [distance_col] + ([rank_col] if rank_col else [])
    if n_sites == 0:
        empty = points.join(sites, F.lit(False), "inner").withColumn(distance_col, F.lit(None).cast("double"))
        if rank_col:
            empty = empty.withColumn(rank_col, F.lit(None).cast("int"))
        return empty.select(*out_cols)
    k_eff = min(k, n_sites)
    side = float(cell_size) if cell_size else _cell_side(box, n_locs, use_sphere)
    dims = [f"c{d}" for d in range(3 if use_sphere else 2)]
    most = max_cell_sites or 16 + 4 * k_eff

    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    pts = points.filter(valid(x) & valid(y))
    ring, coords = _cell_columns(px, py, use_sphere, side, box)
    ring_side = F.lit(side) if use_sphere else F.lit(side) * F.pow(F.lit(float(FAN)), F.col("ring"))
    cells = (pts.select(ring.alias("ring"), *[c.alias(f"__u{d}") for d, c in enumerate(coords)])
             .select("ring", F.lit(0).alias("depth"), *[F.floor(F.col(f"__u{d}") / ring_side).alias(n) for d, n in enumerate(dims)]).distinct())

    # --- candidates by cell, an index at a time ------------------------------------------
    parts = -(-n_locs // index_sites)
    tasks = min(int(spark.conf.get("spark.sql.shuffle.partitions")), n_locs // 2048 + 1)  # there are a few cells a location
    tables, size = [], 0
    for g in range(parts):
        got = few if few is not None else locs.filter(F.pmod(F.xxhash64("__sx", "__sy"), F.lit(parts)) == g).toArrow()  # about ``index_sites`` locations
        if not got.num_rows:
            continue
        places = np.stack([got.column(0).to_numpy(), got.column(1).to_numpy()], axis=1)
        index = SiteIndex(_unit_vectors(places[:, 0], places[:, 1]) if use_sphere else places, got.column(2).to_numpy())
        # the first index, an even share of the locations, says how the cells are cut; the others follow
        of = tables[0].select("ring", "depth", *dims) if tables else cells
        table = _leaves(of.repartition(tasks, "ring", "depth", *dims), index, places, side, k_eff, most, use_sphere, 0 if tables else DEEPEST)
        if not ties:
            table = _with_first_rows(table, S, k_eff, dims)
        table = table.checkpoint(eager=True)
        row = table.agg(F.sum(F.size("cands").cast("long")), F.count(F.lit(1)), F.collect_set("depth")).first()
        size += (row[0] or 0) * (64 + (0 if ties else k_eff * (32 + 16 * len(site_cols)))) + row[1] * 64
        if not tables:
            depths = sorted(row[2])  # ``DEEPEST`` + 1 at most
        tables.append(table)

    # --- one streaming join --------------------------------------------------------------
    frame = pts.withColumns({"__ring": ring, **{f"__u{d}": c for d, c in enumerate(coords)}})
    frame = frame.withColumn("__depth", F.explode(F.array(*[F.lit(d) for d in depths])) if len(depths) > 1 else F.lit(depths[0] if depths else 0))
    own_side = F.lit(side) * F.pow(F.lit(float(FAN)), (F.col("__ring") - F.col("__depth")).cast("double"))
    frame = frame.withColumns({f"__{n}": F.floor(F.col(f"__u{d}") / own_side) for d, n in enumerate(dims)})
    keys = ["ring", "depth", *dims]
    for g, table in enumerate(tables):
        named = table.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(keys)], F.col("cands").alias(f"__cands{g}"))
        named = F.broadcast(named) if size <= max_broadcast_bytes else named
        meet = reduce(lambda a, b: a & b, [F.col(f"__{c}") == F.col(f"__k{i}") for i, c in enumerate(keys)])
        frame = frame.join(named, meet).drop(*[f"__k{i}" for i in range(len(keys))])
    frame = frame.withColumn("__c", F.concat(*[F.col(f"__cands{g}") for g in range(len(tables))]))

    def distance(sx: Column, sy: Column) -> Column:
        return sphere_distance(px, py, sx, sy, radius) if use_sphere else _dist(px, py, sx, sy)

    picked = _select(frame, "__c", distance, k_eff, ties).select(*point_cols, "__pick")
    out = _expand(picked, S, point_cols, site_cols, ties, distance_col, rank_col, n_sites, max_broadcast_bytes)
    if compete_by:
        # rows sharing the key keep the pairs at the key's smallest distance: a partial
        # aggregate per key, joined back (a hot key is split by AQE, never sorted whole)
        by = [compete_by] if isinstance(compete_by, str) else list(compete_by)
        best = out.groupBy(*by).agg(F.min(distance_col).alias("__best"))
        best = best.select("__best", *[F.col(c).alias(f"__by{i}") for i, c in enumerate(by)])
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__by{i}")) for i, c in enumerate(by)])
        out = out.join(best, same).filter(F.col(distance_col) == F.col("__best")).select(*out_cols)
    return out


def _cell_side(box, n_locs: int, sphere: bool) -> float:
    """Half the spacing of evenly spread locations; where they lie denser, cells are cut later."""
    if sphere:
        return math.sqrt(4 * math.pi / n_locs) / 2
    w, h = float(box[1] - box[0]), float(box[3] - box[2])
    spacing = math.sqrt(w * h / n_locs) if w * h > 0 else max(w, h) / n_locs
    return spacing / 2 if spacing > 0 else 1.0


def _with_first_rows(table: DataFrame, S: DataFrame, k: int, dims: list[str]) -> DataFrame:
    """The cells' candidates with the ``k`` best site rows at each location (``__firstk``)."""
    # row_number <= k gets a partial group limit before the shuffle, so a location holding many sites never gathers them in one task
    w = Window.partitionBy("__sx", "__sy").orderBy(F.col("__tie").asc_nulls_last(), F.col("__row"))
    best = (S.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= k)
            .groupBy("__sx", "__sy").agg(F.sort_array(F.collect_list(F.struct(F.col("__tie").alias("t"), F.col("__row").alias("r")))).alias("__firstk")))
    each = table.select("ring", "depth", *dims, F.explode("cands").alias("c")).select("ring", "depth", *dims, "c.*")
    entry = F.struct("__sx", "__sy", "__m", "__firstk")
    return each.join(best, ["__sx", "__sy"]).groupBy("ring", "depth", *dims).agg(F.collect_list(entry).alias("cands"))


def _expand(picked: DataFrame, S: DataFrame, point_cols, site_cols, ties, distance_col, rank_col, n_sites,
            max_broadcast_bytes) -> DataFrame:
    """(point, chosen entries) -> one row per (point, site)."""
    m = F.col("__m")
    rows = picked.select(*point_cols, F.explode("__pick").alias("__m"))
    if ties:
        # every site standing at a chosen location is a tied answer
        pairs = rows.select(*point_cols, m["sx"].alias("__sx"), m["sy"].alias("__sy"), m["d"].alias("__d"),
                            m["rk"].cast("int").alias("__rk"))
        site_side = S.select("__sx", "__sy", "__row")
        if n_sites * (64 + 32 * len(site_cols)) <= max_broadcast_bytes:
            site_side = F.broadcast(site_side)
        rows = pairs.join(site_side, ["__sx", "__sy"])
    else:
        rows = rows.select(*point_cols, m["r"].alias("__row"), m["d"].alias("__d"), m["rk"].cast("int").alias("__rk"))
    sel = [*[F.col(c) for c in point_cols], *[F.col("__row")[c].alias(c) for c in site_cols],
           F.col("__d").alias(distance_col)]
    if rank_col:
        sel.append(F.col("__rk").alias(rank_col))
    return rows.select(*sel)
