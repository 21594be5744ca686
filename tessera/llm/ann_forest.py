"""Approximate nearest neighbours: a forest of random-projection trees, one priority queue, exact reranking.

Trees are fitted on at most ``SAMPLE`` distinct vectors (those of the lowest hash; a bound, not a share) and
split by the plane between two of them until a leaf holds ``LEAF``; every vector of the table is then put
into its leaf of every tree.  A query walks all trees through one priority queue ordered by the margin to
the planes passed on the wrong side, until the leaves it has opened hold as many vectors as the table asks
for: ``TRIED`` of its queries are compared with every vector, and the number is the one at which their walks
have met ``WANTED`` of their true neighbours, ``SEARCH`` at least.  Queries and vectors meet by (tree, leaf); each leaf's candidates are scored exactly, in double precision, and only a
query's best few leave it.  Large leaves are worked on in parts of about ``PART`` vectors.

Equal vectors are one point of the index, which names the smallest ids it needs for the ranks asked for, so
copies neither fill a leaf nor a query's list at another's cost.

Defined results.  Vectors that are null, empty, zero, hold a null or a non-finite number, or have not the
most common length (of equally common ones the smaller) take no part, nor do rows without vec_id.  Ties go to the smaller vec_id.  Repeated rows of one
vec_id count once.  Extra columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from itertools import takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import by_key, sorted_groups, written

TREES = 14
LEAF = 128
SAMPLE = 65_536
SEARCH = 24_000
TRIED = 256
WANTED = 0.94
PART = 8192


def plane(points: np.ndarray, rows: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The plane between the means of the two halves that a few 2-means steps from two points make."""
    a, b = points[rng.choice(rows, 2, replace=False)]
    some = points[rng.choice(rows, min(len(rows), 256), replace=False)]
    for _ in range(4):
        near = some @ a >= some @ b
        if near.all() or not near.any():
            break
        a, b = some[near].mean(0), some[~near].mean(0)
        a, b = a / (np.linalg.norm(a) or 1.0), b / (np.linalg.norm(b) or 1.0)
    return a - b


def tree(points: np.ndarray, leaf: int, rng: np.random.Generator) -> tuple[np.ndarray, list[list[int]], int, int]:
    """(normals, children, root, number of leaves); a child is a node (>= 0) or a leaf (~leaf)."""
    normals: list[np.ndarray] = []
    child: list[list[int]] = []
    leaves, root = 0, -1
    todo = [(np.arange(len(points)), -1, 0)]
    while todo:
        rows, parent, side = todo.pop()
        here = None
        if len(rows) > leaf:
            normal = plane(points, rows, rng)
            right = points[rows] @ normal > 0
            if right.any() and not right.all():
                here = len(normals)
                normals.append(normal)
                child.append([0, 0])
                todo += [(rows[~right], here, 0), (rows[right], here, 1)]
        if here is None:
            leaves += 1
            here = ~(leaves - 1)
        if parent < 0:
            root = here
        else:
            child[parent][side] = here
    return np.array(normals).reshape(-1, points.shape[1]), child, root, leaves


def leaf_of(t, points: np.ndarray) -> np.ndarray:
    normals, child, root, _ = t
    out = np.empty(len(points), np.int32)
    todo = [(np.arange(len(points)), root)]
    while todo:
        rows, node = todo.pop()
        if node < 0:
            out[rows] = ~node
        elif len(rows):
            right = points[rows] @ normals[node] > 0
            todo += [(rows[~right], child[node][0]), (rows[right], child[node][1])]
    return out


def walk_of(trees: list, counts: list[np.ndarray], query: np.ndarray):
    """(tree, leaf, vectors in the leaves before it) of the leaves in a unit ``query``'s order, by one queue over all trees."""
    margins = [t[0] @ query for t in trees]
    heap = [(0.0, k, t[2]) for k, t in enumerate(trees)]
    heapq.heapify(heap)
    seen = 0
    while heap:
        cost, k, node = heapq.heappop(heap)
        while node >= 0:
            m = margins[k][node]
            heapq.heappush(heap, (max(cost, abs(m)), k, trees[k][1][node][int(m <= 0)]))
            node = trees[k][1][node][int(m > 0)]
        yield k, ~node, seen
        seen += int(counts[k][~node])


def search(trees: list, counts: list[np.ndarray], query: np.ndarray, most: int) -> list[tuple[int, int]]:
    """(tree, leaf) of the leaves opened for a unit ``query``."""
    return [(k, x) for k, x, _ in takewhile(lambda o: o[2] < most, walk_of(trees, counts, query))]


def points_of(table: DataFrame, ranks: int) -> tuple[DataFrame, DataFrame]:
    """The rows that take part (vec_id, vector), and their distinct vectors: rep (the smallest id), ids (the
    smallest ``ranks`` + 1), vector."""
    kind = table.schema["embedding"].dataType.simpleString()
    v = F.col("embedding").cast(kind if kind == "array<float>" else "array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    ok = table.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("vector")).where(
        F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0))
    ok = written(ok.withColumn("vector", F.transform("vector", lambda x: F.when(x == 0, F.abs(x)).otherwise(x))).dropDuplicates(["vec_id"]))
    length = ok.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    ok = ok.where(F.size("vector") == (length[0]["d"] if length else 0))
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    few = ok.withColumn("place", place).where(F.col("place") <= ranks + 1)
    return ok, written(few.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
                       .select(F.col("ids")[0].alias("rep"), "ids", "vector"))


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _unit(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def enough(points: DataFrame, placed: DataFrame, queries: DataFrame, shared, counts, ranks: int) -> int:
    """The vectors to open a query, so that ``TRIED`` of the ``queries`` meet ``WANTED`` of their true neighbours."""
    spark = points.sparkSession
    tried = queries.select("rep", "vector").orderBy(F.xxhash64("rep"), "rep").limit(TRIED).toArrow().combine_chunks()
    if not tried.num_rows or sum(int(c.sum()) for c in counts.value) <= SEARCH:
        return SEARCH
    own = spark.sparkContext.broadcast((tried.column("rep").to_numpy(), _unit(_matrix(tried.column("vector").combine_chunks()))))

    def compare(batches):
        ids, asked = own.value
        for b in batches:
            if not b.num_rows:
                continue
            reps = b.column("rep").to_numpy()
            near = asked @ _unit(_matrix(b.column("vector"))).T
            near[ids[:, None] == reps[None, :]] = -np.inf
            keep = min(ranks, b.num_rows)
            best = np.argpartition(-near, keep - 1, axis=1)[:, :keep]
            q = np.repeat(np.arange(len(ids)), keep)
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(reps[best.ravel()]), pa.array(near[q, best.ravel()])], ["q", "rep", "score"])

    order = Window.partitionBy("q").orderBy(F.desc("score"), "rep")
    true = points.select("rep", "vector").mapInArrow(compare, "q long, rep long, score double").where(F.col("score") >= -2)
    true = written(true.withColumn("at", F.row_number().over(order)).where(F.col("at") <= ranks).select("q", "rep"))  # at most TRIED x ranks
    lies = placed.select("rep", "tree", "leaf").join(F.broadcast(true), "rep").groupBy("q").agg(F.collect_list(F.struct("rep", "tree", "leaf")).alias("lies"))

    def follow(batches):
        for b in batches:
            for q, lies in zip(b.column("q").to_pylist(), b.column("lies").to_pylist()):
                held: dict[tuple[int, int], list[int]] = {}
                for x in lies:
                    held.setdefault((x["tree"], x["leaf"]), []).append(x["rep"])
                left, met = {x["rep"] for x in lies}, []
                for k, leaf, seen in walk_of(shared.value, counts.value, own.value[1][q]):
                    for rep in left.intersection(held.get((k, leaf), ())):
                        left.remove(rep)
                        met.append(seen)
                    if not left:
                        break
                yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64())], ["seen"])

    seen = sorted(r["seen"] for r in lies.mapInArrow(follow, "seen long").collect())
    return max(SEARCH, seen[math.ceil(WANTED * len(seen)) - 1] + 1) if seen else SEARCH


def nearest(table: DataFrame, is_query, ranks: int = 5, trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE,
            most: int | None = None, seed: int = 7) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``table`` (vec_id, embedding) where ``is_query``.

    ``most`` vectors are opened a query; without it, what ``enough`` finds.
    """
    spark = table.sparkSession
    rows, points = points_of(table, ranks)
    empty = "query_id long, rank int, vec_id long, score double"
    fit = points.orderBy(F.xxhash64("rep"), "rep").limit(sample).select("vector").toArrow()
    if not fit.num_rows:
        return spark.createDataFrame([], empty)
    fit = _unit(_matrix(fit.column("vector").combine_chunks()))
    rng = np.random.default_rng(seed)
    forest = [tree(fit, leaf, rng) for _ in range(trees)]
    shared = spark.sparkContext.broadcast(forest)

    def assign(batches):
        for b in batches:
            unit = _unit(_matrix(b.column("vector")))
            for k, t in enumerate(shared.value):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(unit), k, np.int32)), pa.array(leaf_of(t, unit)), b.column("rep"), b.column("vector")],
                    ["tree", "leaf", "rep", "vector"])

    vector = points.schema["vector"].dataType.simpleString()
    placed = written(points.select("rep", "vector").mapInArrow(assign, f"tree int, leaf int, rep long, vector {vector}"))
    sizes = [np.zeros(t[3], np.int64) for t in forest]
    for r in placed.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n")).collect():  # one row a leaf of the index
        sizes[r["tree"]][r["leaf"]] = r["n"]
    counts = spark.sparkContext.broadcast(sizes)
    asked = rows.where(is_query).select("vec_id", "vector")
    named = points.select("rep", "vector")
    query_rows = written(asked.join(named, "vector").select(F.col("vec_id").alias("query_id"), "rep"))
    queries = query_rows.select("rep").distinct().join(points.select("rep", "vector"), "rep")
    if most is None:
        most = enough(points, placed, queries, shared, counts, ranks)

    def walk(batches):
        for b in batches:
            m = _matrix(b.column("vector"))
            unit = _unit(m)
            for k in range(len(unit)):
                found = search(shared.value, counts.value, unit[k], most)
                parts = [-(-int(counts.value[t][x]) // PART) for t, x in found]
                out = [(t, x, p) for (t, x), n in zip(found, parts) for p in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int32()), pa.array([o[2] for o in out], pa.int32()),
                     pa.array(np.full(len(out), b.column("rep")[k].as_py(), np.int64)),
                     b.column("vector").take(pa.array(np.full(len(out), k, np.int32)))], ["tree", "leaf", "part", "rep", "vector"])

    def part(batches):
        for b in batches:
            n = np.array([counts.value[t][x] for t, x in zip(b.column("tree").to_pylist(), b.column("leaf").to_pylist())], np.int64)
            p = (b.column("rep").to_numpy() * 2654435761 >> 8) % np.maximum(1, -(-n // PART))
            yield pa.RecordBatch.from_arrays([b.column("tree"), b.column("leaf"), pa.array(p.astype(np.int32)), b.column("rep"),
                                              b.column("vector")], ["tree", "leaf", "part", "rep", "vector"])

    kind = f"tree int, leaf int, part int, rep long, vector {vector}"
    both = queries.repartition("rep").mapInArrow(walk, kind).withColumn("kind", F.lit(0)).union(
        placed.mapInArrow(part, kind).withColumn("kind", F.lit(1)))

    def score(batches):
        for t in sorted_groups(batches, ["tree", "leaf", "part"]):
            kinds = t.column("kind").to_numpy()
            ask = int((kinds == 0).sum())
            if not ask or ask == len(kinds):
                continue
            reps = t.column("rep").to_numpy()
            m = _matrix(t.column("vector").combine_chunks())
            big = np.abs(m).max(axis=1, keepdims=True)
            m = m / big
            norm = np.sqrt((m * m).sum(axis=1))
            q, v = m[:ask], m[ask:]
            for s in range(0, ask, 256):
                rough = (q[s:s + 256] @ v.T) / norm[s:s + 256 if s + 256 < ask else ask, None] / norm[None, ask:]
                keep = min(ranks + 1, rough.shape[1])
                least = np.partition(rough, rough.shape[1] - keep, axis=1)[:, rough.shape[1] - keep]
                a, b = np.nonzero(rough >= least[:, None] - 1e-9)  # with all that may tie once they are exact
                a += s
                exact = (q[a] * v[b]).sum(axis=1) / (norm[a] * norm[ask + b])
                order = np.lexsort((reps[ask + b], -exact, a))
                a, b, exact = a[order], b[order], exact[order]
                first = np.arange(len(a)) - np.searchsorted(a, a) < keep
                a, b, exact = a[first], b[first], exact[first]
                yield pa.RecordBatch.from_arrays([pa.array(reps[a]), pa.array(reps[ask + b]), pa.array(exact)], ["rep", "other", "score"])

    hits = by_key(both, ["tree", "leaf", "part"], ["kind", "rep"]).mapInArrow(score, "rep long, other long, score double")
    hits = hits.groupBy("rep", "other").agg(F.max("score").alias("score"))
    close = Window.partitionBy("rep").orderBy(F.desc("score"), "other")
    hits = hits.withColumn("at", F.row_number().over(close)).where(F.col("at") <= ranks + 1)
    ids = hits.join(points.select(F.col("rep").alias("other"), "ids"), "other").select("rep", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("rep").orderBy(F.desc("score"), "vec_id")
    ids = ids.withColumn("at", F.row_number().over(order)).where(F.col("at") <= ranks + 1)
    mine = query_rows.join(ids, "rep").where("query_id <> vec_id")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return mine.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= ranks).select("query_id", "rank", "vec_id", "score")


def op7_ann_forest(spark, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)
