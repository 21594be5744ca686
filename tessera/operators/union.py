"""Union of any polygons per group, overlapping ones included, as directed boundary edges and as rings.

1. *Cells.*  A group's plane is cut into square cells, a level at a time and only where many edges pass.  A cell that one
   member covers with a margin holds no boundary of the union and goes with all that lies in it, so what is left follows
   the union's outline and not the number of overlaps.
2. *Split.*  Edges meet within the cells that are left; where two of them cross, touch or run along each other both are cut, so that
   afterwards two pieces are equal or share end points at most.  Pieces that pass a cell that went go too.  Coordinates are
   rounded to ``snap_digits``.
3. *Sides.*  A piece's middle meets the members of the group that enter its cell.  The parity of the edges that a ray from it
   crosses says whether a member covers the place; for the members whose own edges the piece is on, those edges are left
   out for the one side and counted for the other.
4. *Reduce.*  A piece bounds the union if exactly one of its sides is covered by any member.  It is directed so that the
   covered side is on its left.

Every step is a join or an aggregate by (group, cell) or (group, piece).  The boundary of one group ends as one value, as a
geometry column has to; :func:`rings` makes GeoJSON coordinates of it (outer rings counter-clockwise, their holes clockwise).
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.geometry import EDGES_TYPE, _crossing, edges_bbox, polygon_edges

MULTIPOLYGON = "array<array<array<array<double>>>>"
#: Parts a dimension that a cell is cut into, edges from which it is cut, and how often at most.
FAN, MOST, DEEPEST = 4, 48, 24
#: A cell is cut again only if it has less than this share of its parent's edges: cuts don't part edges that run together.
SHRINKS = 0.9
#: (cell, edge) pairs that a task looks at together.
PAIRS = 1 << 19
CELL = ["__g", "__lvl", "__gx", "__gy"]
ENTRY = {"e": pa.int32(), **dict.fromkeys(("x1", "y1", "x2", "y2", "t0", "t1"), pa.float64())}


def _key(keys) -> Column:
    """A group's key columns as one text; NULL is a group too."""
    return F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})


def _snapped(e: Column, digits: int) -> Column:
    return F.struct(*[F.round(e[n], digits).alias(n) for n in ("x1", "y1", "x2", "y2")])


def _on(px: Column, py: Column, x1, y1, x2, y2, tol: float) -> Column:
    """Whether a point lies on a segment, ends included, within ``tol``."""
    dx, dy = x2 - x1, y2 - y1
    cross = F.abs(dx * (py - y1) - dy * (px - x1))
    box = ((px >= F.least(x1, x2) - tol) & (px <= F.greatest(x1, x2) + tol)
           & (py >= F.least(y1, y2) - tol) & (py <= F.greatest(y1, y2) + tol))
    return box & (cross <= F.lit(tol) * F.sqrt(dx * dx + dy * dy))


def _in_cells(own: dict, cell: np.ndarray, gx: np.ndarray, gy: np.ndarray, side: float, pad: float):
    """(edges that enter each cell, covered or not; pairs kept, t0, t1 of each): members' edges ``own`` against cells.

    ``cell`` and ``own`` are the pairs.  An edge is kept for a cell that it enters (at t0 .. t1 of its length), or if a ray from the
    cell, to the right or upwards, can meet it.  Cells reach ``pad`` over their borders.
    """
    x1, y1, x2, y2 = (own[c] for c in ("x1", "y1", "x2", "y2"))
    x0, xe, y0, ye = (((g + up) * side + (pad if up else -pad))[cell] for g in (gx, gy) for up in (0, 1))
    t0, t1 = np.zeros(len(cell)), np.ones(len(cell))
    with np.errstate(divide="ignore", invalid="ignore"):
        for a, b, low, high in ((x1, x2, x0, xe), (y1, y2, y0, ye)):
            p, q = (low - a) / (b - a), (high - a) / (b - a)
            still = a == b
            t0 = np.where(still, np.where((a >= low) & (a <= high), t0, 2.0), np.maximum(t0, np.minimum(p, q)))
            t1 = np.where(still, t1, np.minimum(t1, np.maximum(p, q)))
        enters = t0 <= t1
        left, right, low, high = np.minimum(x1, x2), np.maximum(x1, x2), np.minimum(y1, y2), np.maximum(y1, y2)
        seen = ((high >= y0) & (low <= ye) & (right >= x0)) | ((right >= x0) & (left <= xe) & (high >= y0))
        mx, my = ((gx + 0.5) * side)[cell], ((gy + 0.5) * side)[cell]
        crossed = ((y1 > my) != (y2 > my)) & (mx < (x2 - x1) * (my - y1) / (y2 - y1) + x1)
    n = np.bincount(cell, enters, minlength=len(gx))
    odd = np.bincount(cell, crossed, minlength=len(gx)) % 2 == 1
    return n, (n == 0) & odd, seen & (n > 0)[cell], t0, t1


def _cut_cells(rows: DataFrame, side: float, pad: float, root: bool) -> DataFrame:
    """__g, __p, __gx, __gy, above, n, whole, own: members in the parts (of ``side``) of their cells, or (``root``) in the cells of their box."""
    def run(batches):
        for b in batches:
            ends = np.concatenate([[0], np.cumsum(b.column("own").value_lengths().to_numpy())])
            flat = b.column("own").flatten()
            flat = {c: flat.field(c).to_numpy() for c in list(ENTRY)[:5]}
            gx, gy = (b.column(c).to_numpy() for c in ("__gx", "__gy"))
            wide, tall = (b.column(c).to_numpy() for c in ("__w", "__h")) if root else (np.full(len(gx), FAN), np.full(len(gx), FAN))
            parts = wide * tall
            upto = np.cumsum(parts * np.diff(ends))
            first = 0
            while first < len(gx):
                last = max(first + 1, int(np.searchsorted(upto, (upto[first - 1] if first else 0) + PAIRS, "right")))
                row = np.repeat(np.arange(first, last), parts[first:last])
                k = np.arange(len(row)) - np.repeat(np.cumsum(parts[first:last]) - parts[first:last], parts[first:last])
                cx, cy = gx[row] * (1 if root else FAN) + k // tall[row], gy[row] * (1 if root else FAN) + k % tall[row]
                size = np.diff(ends)[row]
                cell = np.repeat(np.arange(len(row)), size)
                at = ends[row][cell] + np.arange(len(cell)) - (np.cumsum(size) - size)[cell]
                n, whole, kept, t0, t1 = _in_cells({c: v[at] for c, v in flat.items()}, cell, cx, cy, side, pad)
                out = np.flatnonzero((n > 0) | whole)
                starts = np.concatenate([[0], np.cumsum(np.bincount(cell[kept], minlength=len(row))[out])])
                own = [flat[c][at[kept]] for c in flat] + [t0[kept], t1[kept]]
                entries = pa.StructArray.from_arrays([pa.array(v, t) for v, t in zip(own, ENTRY.values())], list(ENTRY))
                take = pa.array(row[out])
                yield pa.RecordBatch.from_arrays(
                    [b.column("__g").take(take), b.column("__p").take(take), pa.array(cx[out]), pa.array(cy[out]), b.column("above").take(take),
                     pa.array(n[out].astype(np.int64)), pa.array(whole[out]), pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), entries)],
                    ["__g", "__p", "__gx", "__gy", "above", "n", "whole", "own"])
                first = last

    kinds = "e:int," + ",".join(f"{c}:double" for c in list(ENTRY)[1:])
    return rows.mapInArrow(run, f"__g string, __p long, __gx long, __gy long, above long, n long, whole boolean, own array<struct<{kinds}>>")


def _open_cells(members: DataFrame, digits: int, finest: float | None) -> tuple[DataFrame, dict[int, float]]:
    """The cells that no member covers with the members that enter them (``CELL``, __p, own), and the sides of their levels."""
    side = members.agg(F.max(F.greatest(F.col("x_max") - F.col("x_min"), F.col("y_max") - F.col("y_min")))).first()[0]
    pad = 2 * 10.0 ** -digits + 1e-9 * side
    least, most = (lambda c: F.floor((F.col(c) - pad) / side)), (lambda c: F.floor((F.col(c) + pad) / side))
    own = F.transform("edges", lambda e, i: F.struct(i.alias("e"), e["x1"].alias("x1"), e["y1"].alias("y1"), e["x2"].alias("x2"), e["y2"].alias("y2")))
    rows = members.select("__g", "__p", own.alias("own"), least("x_min").alias("__gx"), least("y_min").alias("__gy"),
                          (most("x_max") - least("x_min") + 1).alias("__w"), (most("y_max") - least("y_min") + 1).alias("__h"),
                          F.lit((1 << 62)).alias("above"))
    leaves, sides = [], {}
    for level in range(DEEPEST + 1):
        sides[level] = side
        parts = _cut_cells(rows, side, pad, level == 0).checkpoint(eager=True)
        found = parts.groupBy("__g", "__gx", "__gy").agg(F.max("whole").alias("covered"), F.sum("n").alias("all"), F.max("above").alias("before"))
        again = F.lit(level < DEEPEST and not (finest and side / FAN < finest)) & (F.col("all") > MOST) & (F.col("all") < F.col("before") * SHRINKS)
        left = found.where("not covered").select("__g", "__gx", "__gy", "all", again.alias("again"))
        kept = parts.drop("above").join(left, ["__g", "__gx", "__gy"]).checkpoint(eager=True)
        leaves.append(kept.where("not again").select("__g", F.lit(level).alias("__lvl"), "__gx", "__gy", "__p", "own"))
        rows = kept.where("again").select("__g", "__p", "__gx", "__gy", F.col("all").alias("above"), "own")
        if rows.isEmpty():
            break
        side /= FAN
    out = leaves[0]
    for leaf in leaves[1:]:
        out = out.unionByName(leaf)
    return out, sides


def _pieces(cells: DataFrame, digits: int) -> DataFrame:
    """__g, __p, __e, ax, ay, bx, by (a before b): the members' edges in ``cells``, cut wherever they meet another edge of the group."""
    tol = 10.0 ** -digits
    homes = cells.select(*CELL, "__p", F.explode("own").alias("s")).where("s.t0 <= s.t1").select(
        *CELL, "__p", F.col("s.e").alias("__e"), *[F.col(f"s.{c}") for c in list(ENTRY)[1:]])
    homes = homes.withColumns({"x_min": F.least("x1", "x2"), "x_max": F.greatest("x1", "x2"), "y_min": F.least("y1", "y2"), "y_max": F.greatest("y1", "y2")})
    edges = homes.groupBy("__g", "__p", "__e", "x1", "y1", "x2", "y2").agg(F.array_sort(F.collect_set(F.struct("t0", "t1"))).alias("spans"))
    other = homes.select(*CELL, *[F.col(c).alias(f"o{c.strip('_')}") for c in
                                  ("__p", "__e", "x1", "y1", "x2", "y2", "x_min", "x_max", "y_min", "y_max")])
    met = homes.join(other, CELL).where(
        ((F.col("__p") < F.col("op")) | ((F.col("__p") == F.col("op")) & (F.col("__e") < F.col("oe"))))
        & (F.col("x_min") <= F.col("ox_max") + tol) & (F.col("ox_min") <= F.col("x_max") + tol)
        & (F.col("y_min") <= F.col("oy_max") + tol) & (F.col("oy_min") <= F.col("y_max") + tol))
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    u1, v1, u2, v2 = (F.col(c) for c in ("ox1", "oy1", "ox2", "oy2"))
    touch = F.array(
        F.when(_on(u1, v1, x1, y1, x2, y2, tol), F.struct(u1.alias("x"), v1.alias("y"))),
        F.when(_on(u2, v2, x1, y1, x2, y2, tol), F.struct(u2.alias("x"), v2.alias("y"))),
        F.when(_on(x1, y1, u1, v1, u2, v2, tol), F.struct(x1.alias("x"), y1.alias("y"))),
        F.when(_on(x2, y2, u1, v1, u2, v2, tol), F.struct(x2.alias("x"), y2.alias("y"))))
    det = (x2 - x1) * (v2 - v1) - (y2 - y1) * (u2 - u1)
    t = F.try_divide((u1 - x1) * (v2 - v1) - (v1 - y1) * (u2 - u1), det)
    s = F.try_divide((u1 - x1) * (y2 - y1) - (v1 - y1) * (x2 - x1), det)
    crossing = F.when((t > 0) & (t < 1) & (s > 0) & (s < 1), F.struct(F.round(x1 + t * (x2 - x1), digits).alias("x"),
                                                                     F.round(y1 + t * (y2 - y1), digits).alias("y")))
    met = met.withColumn("touch", F.array_compact(touch))
    # where an end touches, the end itself is the cut: a crossing computed next to it would differ by rounding
    met = met.withColumn("cuts", F.when(F.size("touch") > 0, F.col("touch")).otherwise(F.array_compact(F.array(crossing)))).where(F.size("cuts") > 0)
    cuts = (met.select("__g", "__p", "__e", "cuts").unionByName(met.select("__g", F.col("op").alias("__p"), F.col("oe").alias("__e"), "cuts"))
            .groupBy("__g", "__p", "__e").agg(F.array_distinct(F.flatten(F.collect_list("cuts"))).alias("cuts")))
    # the parts of an edge that lie in cells: spans that overlap are one
    runs = F.aggregate("spans", F.array().cast("array<struct<t0:double,t1:double>>"), lambda a, z: F.when(
        F.try_element_at(a, F.lit(-1))["t1"] >= z["t0"], F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(
            F.try_element_at(a, F.lit(-1))["t0"].alias("t0"), F.greatest(F.try_element_at(a, F.lit(-1))["t1"], z["t1"]).alias("t1"))))).otherwise(F.concat(a, F.array(z))))
    chain = edges.withColumn("runs", runs).join(cuts, ["__g", "__p", "__e"], "left")

    def along(px, py):
        return ((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))

    inner = F.filter(F.coalesce("cuts", F.array().cast("array<struct<x:double,y:double>>")),
                     lambda c: (along(c["x"], c["y"]) > 0) & (along(c["x"], c["y"]) < 1))
    ordered = F.array_sort(F.transform(inner, lambda c: F.struct(along(c["x"], c["y"]).alias("t"), c["x"].alias("x"), c["y"].alias("y"))))
    end = lambda t, x, y: F.array(F.struct(F.lit(t).alias("t"), x.alias("x"), y.alias("y")))
    chain = chain.withColumn("at", F.concat(end(0.0, x1, y1), ordered, end(1.0, x2, y2)))
    steps = chain.select("__g", "__p", "__e", "runs", F.explode(F.arrays_zip(F.expr("slice(at, 1, size(at) - 1)").alias("a"),
                                                                             F.expr("slice(at, 2, size(at) - 1)").alias("b"))).alias("z"))
    # a piece that leaves the cells passes one that a member covers
    steps = steps.where(F.exists("runs", lambda r: (r["t0"] <= F.col("z.a.t")) & (r["t1"] >= F.col("z.b.t"))))
    steps = steps.select("__g", "__p", "__e", *[F.struct(F.col(f"z.{c}.x").alias("x"), F.col(f"z.{c}.y").alias("y")).alias(c) for c in "ab"])
    low, high = F.least("a", "b"), F.greatest("a", "b")
    steps = steps.where(F.col("a") != F.col("b")).select("__g", "__p", "__e", low.alias("a"), high.alias("b"))
    return steps.select("__g", "__p", "__e", F.col("a.x").alias("ax"), F.col("a.y").alias("ay"), F.col("b.x").alias("bx"), F.col("b.y").alias("by"))


def union_boundary(df: DataFrame, by, geometry: str = "geometry", edges: str = "edges", snap_digits: int = 9,
                   cell_size: float | None = None) -> DataFrame:
    """__g (key text), x1, y1, x2, y2: the union's boundary pieces of every group, covered side on the left."""
    keys = [F.col(k) if isinstance(k, str) else k for k in ([by] if isinstance(by, (str, Column)) else list(by))]
    if edges not in df.columns:
        df = df.withColumn(edges, polygon_edges(F.col(geometry)))
    snapped = F.filter(F.transform(edges, lambda e: _snapped(e, snap_digits)), lambda e: (e["x1"] != e["x2"]) | (e["y1"] != e["y2"]))
    members = df.select(_key(keys).alias("__g"), snapped.alias("edges")).where(F.size("edges") > 0).distinct()
    members = members.withColumn("__p", F.monotonically_increasing_id()).withColumns(edges_bbox("edges")).checkpoint(eager=True)
    if members.isEmpty():
        return members.select("__g", *[F.lit(0.0).alias(c) for c in ("x1", "y1", "x2", "y2")])
    cells, sides = _open_cells(members, snap_digits, cell_size)
    pieces = (_pieces(cells, snap_digits).groupBy("__g", "ax", "ay", "bx", "by")
              .agg(F.collect_list(F.struct("__p", "__e")).alias("own"))
              .withColumns({"__mx": (F.col("ax") + F.col("bx")) / 2, "__my": (F.col("ay") + F.col("by")) / 2}).checkpoint(eager=True))
    mx, my = F.col("__mx"), F.col("__my")
    at = F.array(*[F.struct(F.lit(lv).alias("lvl"), F.floor(mx / side).alias("gx"), F.floor(my / side).alias("gy")) for lv, side in sides.items()])
    near = pieces.withColumn("__c", F.explode(at)).select("*", *[F.col(f"__c.{c.strip('_')}").alias(c) for c in CELL[1:]]).drop("__c")
    hits = near.join(cells.withColumnRenamed("own", "edges"), CELL)
    hits = hits.withColumn("mine", F.transform(F.filter("own", lambda o: o["__p"] == F.col("__p")), lambda o: o["__e"]))
    level = F.col("ay") == F.col("by")

    def crossed(e: Column) -> Column:
        flipped = F.struct(e["y1"].alias("x1"), e["x1"].alias("y1"), e["y2"].alias("x2"), e["x2"].alias("y2"))
        ray = F.when(level, _crossing(my, mx, flipped)).otherwise(_crossing(mx, my, e))  # upwards from level pieces
        return F.when(F.array_contains("mine", e["e"]), F.lit(0)).otherwise(ray)

    hits = hits.withColumn("n", F.aggregate(F.transform("edges", crossed), F.lit(0), lambda a, c: a + c))
    sides = hits.groupBy("__g", "ax", "ay", "bx", "by").agg(
        F.max(F.col("n") % 2 == 1).alias("ahead"), F.max((F.col("n") + F.size("mine")) % 2 == 1).alias("behind"))
    bound = sides.where(F.col("ahead") != F.col("behind"))
    # "ahead" is the side of larger x (above, for a level piece); a comes first by x, then y
    left = F.when(level, F.col("ahead")).when(F.col("by") > F.col("ay"), F.col("behind")).otherwise(F.col("ahead"))
    turn = lambda p, q: F.when(left, F.col(p)).otherwise(F.col(q))
    return bound.select("__g", turn("ax", "bx").alias("x1"), turn("ay", "by").alias("y1"), turn("bx", "ax").alias("x2"), turn("by", "ay").alias("y2"))


def union_aggregate(df: DataFrame, by, geometry: str = "geometry", edges: str = "edges", snap_digits: int = 9,
                    cell_size: float | None = None) -> DataFrame:
    """The key columns of ``by`` and the union's boundary of every group as a directed edge list."""
    names = [by] if isinstance(by, str) else list(by)
    df = df.checkpoint(eager=True)  # the bounded polygon side, read for the boundary and for the groups
    bound = union_boundary(df, names, geometry, edges, snap_digits, cell_size)
    geom = bound.groupBy("__g").agg(F.array_sort(F.collect_list(F.struct("x1", "y1", "x2", "y2"))).alias(edges))
    groups = df.select(*names).distinct().withColumn("__k", _key([F.col(n) for n in names]))
    out = groups.join(geom, F.col("__k") == F.col("__g"), "left")
    return out.select(*names, F.coalesce(edges, F.array().cast(EDGES_TYPE)).alias(edges))


def ring_coordinates(edges: list[tuple[float, float, float, float]]) -> list[list[list[list[float]]]]:
    """MultiPolygon coordinates of a directed boundary (covered side on the left).

    At a vertex where several rings touch, a ring goes on with the edge that is next clockwise from where it came, so touching
    parts stay apart.  Vertices inside a straight run are left out.  A hole goes to the smallest outer ring around it.
    """
    out = defaultdict(list)
    for e in edges:
        out[e[0], e[1]].append(e)
    left = dict.fromkeys(edges)
    found = []
    while left:
        first = e = next(iter(left))
        ring = []
        while e in left:
            del left[e]
            ring.append((e[0], e[1]))
            nexts = [f for f in out[e[2], e[3]] if f in left or f == first]
            if not nexts:
                break
            back = math.atan2(e[1] - e[3], e[0] - e[2])
            e = min(nexts, key=lambda f: (back - math.atan2(f[3] - f[1], f[2] - f[0]) - 1e-15) % (2 * math.pi))
        found.append(ring)
    outer, holes = [], []
    for ring in found:
        n = len(ring)
        area = sum(ring[i][0] * ring[(i + 1) % n][1] - ring[(i + 1) % n][0] * ring[i][1] for i in range(n)) / 2
        bends = [p for i, p in enumerate(ring) if _bends(ring[i - 1], p, ring[(i + 1) % n])]
        if len(bends) > 2 and area:
            (outer if area > 0 else holes).append((abs(area), bends))
    outer.sort()
    parts = [[ring] for _, ring in outer]
    for _, hole in holes:
        at = ((hole[0][0] + hole[1][0]) / 2, (hole[0][1] + hole[1][1]) / 2)
        home = next((p for p in parts if _inside(at, p[0])), None)
        if home:
            home.append(hole)
    return [[[[x, y] for x, y in [*ring, ring[0]]] for ring in part] for part in parts]


def _bends(a, b, c) -> bool:
    dx, dy, ex, ey = b[0] - a[0], b[1] - a[1], c[0] - b[0], c[1] - b[1]
    return abs(dx * ey - dy * ex) > 1e-12 * math.hypot(dx, dy) * math.hypot(ex, ey) or dx * ex + dy * ey < 0


def _inside(at, ring) -> bool:
    x, y = at
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


def rings(df: DataFrame, edges: str = "edges", geometry: str = "geometry") -> DataFrame:
    """``df`` with the directed boundary ``edges`` replaced by MultiPolygon coordinates."""
    keep = [c for c in df.columns if c != edges]
    plan = df.select(*keep, F.transform(edges, lambda e: F.array(e["x1"], e["y1"], e["x2"], e["y2"])).alias(geometry))

    def run(batches):
        for b in batches:
            made = [ring_coordinates([tuple(e) for e in row or ()]) for row in b.column(geometry).to_pylist()]
            kind = pa.list_(pa.list_(pa.list_(pa.list_(pa.float64()))))
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [pa.array(made, kind)], [*keep, geometry])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plan.schema if f.name != geometry)
    return plan.mapInArrow(run, f"{kinds}{', ' * bool(kinds)}`{geometry}` {MULTIPOLYGON}")
