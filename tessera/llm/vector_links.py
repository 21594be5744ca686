"""Near-duplicate vectors by a robust-pruned flat graph and range-expanding search, within labels.

1. Shards.  Vectors of one label (and length) that are equal are one point.  Groups over ``SHARD`` points are
   split by spherical k-means, fitted on a bounded sample of the group (``SAMPLE`` for a child); a point is a member of its
   ``own`` nearest children and visits its ``visits`` nearest ones, so the shards overlap.  Children over the size are
   split again in the next round; a round's centroids are within ``CENTROID_BYTES``, groups beyond it wait for the next.
2. Graph.  In each shard every member gets the robust-pruned ones (``ALPHA``) of its nearest members and of a
   few drawn ones, and the edges back.  A point's adjacency lists of all its shards are united into one flat graph.
3. Search.  Each point searches the shards that it visits: best first with a beam of ``BEAM`` from the shard's medoids
   (and the point itself where it is a member), along the united lists; then the range expands: every vector met within
   ``SLACK`` of the threshold is expanded in turn until none is left.  What is met is verified in double precision.
4. Counts.  A pair counts in the first of the shards that could find it, so links are counted where they are
   found and no table of pairs is made: a shard gives its points' numbers of links and a spanning forest.
5. Audit.  ``AUDIT`` points are compared with all vectors of their labels.  While less than ``WANTED`` of their links
   have been found, the job runs again with twice the visits and beam, until every shard is visited whole.

Defined results.  Rows whose label is null, and vectors that are null, empty, zero or hold a null or a non-finite number, link with nothing,
nor do vectors of unequal lengths.  Repeated rows of one vec_id give one row each, alike; if they are not equal, the smallest
(label, vector) that can link counts.  A row without vec_id links with nothing (component null, kept true).  Extra columns are not looked at;
an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import by_key, components, partitions, sorted_groups, written

SHARD = 2048
SAMPLE = 48
FAN = 1024
CENTROID_BYTES = 32 << 20
OWN, VISITS = 2, 3
NEAR, FAR, POOL = 16, 6, 48
ALPHA = 1.2
MEDOIDS = 12
BEAM = 24
SLACK = 0.02
AUDIT = 256
WANTED = 0.99


def points_of(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vec_id, rep of every row that can link; rep, label, vector, copies of the distinct vectors); rep is the smallest vec_id."""
    kind = "array<float>" if table.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    v = F.col("embedding").cast(kind)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    ok = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0)
    plus = F.transform(v, lambda x: F.when(x == 0, F.abs(x)).otherwise(x))  # no negative zeros
    rows = table.where(ok).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), plus.alias("vector"))
    rows = rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("p")).select("vec_id", "p.label", "p.vector")
    rows = written(rows.withColumn("key", F.xxhash64("vector")))
    points = written(rows.groupBy("label", "key", "vector").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")))
    named = points.select(F.col("label").alias("l__"), F.col("key").alias("k__"), F.col("vector").alias("v__"), "rep")
    same = (F.col("label") == F.col("l__")) & (F.col("key") == F.col("k__")) & (F.col("vector") == F.col("v__"))
    return rows.join(named, same).select("vec_id", "rep"), points.drop("key")


def matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def unit(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def means(points: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 6) -> np.ndarray:
    """``k`` unit centroids of unit ``points`` (fewer, if there are fewer points)."""
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)]
    for _ in range(rounds):
        near = (points @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        size = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(size > 0, sums / np.maximum(size, 1e-12), centres)
    return centres


def shards_of(points: DataFrame, own: int, visits: int, shard: int = SHARD, centroid_bytes: int = CENTROID_BYTES) -> DataFrame:
    """shard, rep, member, copies, vector: one row for every shard that a point visits."""
    spark = points.sparkSession
    vector = points.schema["vector"].dataType.simpleString()
    done = None
    todo = points.select(F.concat_ws("/", "label", F.size("vector")).alias("shard"), "rep", F.lit(True).alias("member"), "copies", "vector")
    parents: dict[str, int] = {}
    while True:
        sizes = written(todo.groupBy("shard").agg(F.count_if("member").alias("n"), F.max(F.size("vector")).alias("d")).where(F.col("n") > shard))
        fan = F.least(F.lit(FAN), F.ceil(F.col("n") * own * 2 / shard)).cast("int")
        # the largest groups first; a row is a group of over ``shard`` points
        waiting = sizes.withColumn("fan", fan).orderBy(F.desc("n"), "shard").limit(max(1, centroid_bytes // 1024)).collect()
        large, room = [], centroid_bytes
        for r in waiting:
            # a child that kept nearly all of its parent's points can't be split: it stays whole
            if r["n"] < 0.9 * parents.get(r["shard"].rpartition(":")[0], math.inf) and (not large or r["fan"] * r["d"] * 4 <= room):
                large.append(r)
                room -= r["fan"] * r["d"] * 4
        if not large:
            return todo if done is None else done.unionByName(todo)
        parents |= {r["shard"]: r["n"] for r in large}
        fans = spark.createDataFrame([(r["shard"], r["fan"]) for r in large], "shard string, fan int")
        split = F.broadcast(fans)
        place = F.row_number().over(Window.partitionBy("shard").orderBy(F.xxhash64("rep"), "rep"))
        sample = todo.where("member").join(split, "shard").withColumn("place", place)
        sample = sample.where(F.col("place") <= FAN * SAMPLE).where(F.col("place") <= F.col("fan") * SAMPLE)

        def fit(batches):
            for t in sorted_groups(batches, ["shard"]):
                fan_ = t.column("fan")[0].as_py()
                centres = means(unit(matrix(t.column("vector"))), fan_, np.random.default_rng(fan_)).astype(np.float32)
                yield pa.RecordBatch.from_arrays([t.column("shard").combine_chunks().slice(0, 1), pa.array([centres.tobytes()], pa.binary())],
                                                 ["shard", "centres"])

        fitted = by_key(sample.select("shard", "fan", "rep", "vector"), ["shard"], ["rep"]).mapInArrow(fit, "shard string, centres binary")
        shared = spark.sparkContext.broadcast({r["shard"]: bytes(r["centres"]) for r in fitted.collect()})  # within ``centroid_bytes``

        def deal(batches):
            for b in batches:
                name = np.array(b.column("shard").to_pylist(), object)
                for s in sorted(set(name)):
                    at = np.flatnonzero(name == s)
                    m = unit(matrix(b.column("vector").take(pa.array(at))))
                    centres = np.frombuffer(shared.value[s], np.float32).reshape(-1, m.shape[1])
                    near = np.argsort(-(m @ centres.T), axis=1, kind="stable")[:, :visits]
                    rows = pa.array(np.repeat(at, near.shape[1]))
                    was = b.column("member").take(rows).to_numpy(zero_copy_only=False)
                    child = pa.array([f"{s}:{c}" for c in near.ravel().tolist()], pa.string())
                    inside = pa.array(was & (np.tile(np.arange(near.shape[1]), len(at)) < own))
                    yield pa.RecordBatch.from_arrays([child, b.column("rep").take(rows), inside, b.column("copies").take(rows),
                                                      b.column("vector").take(rows)], ["shard", "rep", "member", "copies", "vector"])

        rest = todo.join(split, "shard", "left_anti").select("shard", "rep", "member", "copies", "vector")
        done = rest if done is None else done.unionByName(rest)
        todo = written(todo.join(split, "shard").select("shard", "rep", "member", "copies", "vector")
                       .mapInArrow(deal, f"shard string, rep long, member boolean, copies long, vector {vector}"))


def robust_prune(points: np.ndarray, rows: np.ndarray, pool: np.ndarray, most: int, alpha: float = ALPHA) -> np.ndarray:
    """For each of ``rows`` at most ``most`` of its ``pool`` (-1: none): the nearest, less what a kept one is ``alpha`` times nearer to."""
    out = np.full((len(rows), most), -1, np.int64)
    cand = points[pool]
    to_row = np.einsum("ncd,nd->nc", cand, points[rows])
    alive = (pool >= 0) & (pool != rows[:, None])
    among = cand @ cand.transpose(0, 2, 1)
    every = np.arange(len(rows))
    for k in range(most):
        score = np.where(alive, to_row, -9.0)
        pick = score.argmax(axis=1)
        has = score[every, pick] > -9.0
        if not has.any():
            break
        out[has, k] = pool[every, pick][has]
        alive &= alpha * alpha * (1 - among[every, pick]) > 1 - to_row
        alive[every, pick] = False
    return out


def shard_graph(points: np.ndarray, seed: int = 3) -> list[np.ndarray]:
    """The adjacency lists of unit ``points`` (float32): pruned near ones, pruned drawn ones, and edges back."""
    n = len(points)
    rng = np.random.default_rng(seed)
    pools = min(POOL, n - 1)
    if pools < 1:
        return [np.empty(0, np.int64)] * n
    near, far = [], []
    for s in range(0, n, 256):
        rows = np.arange(s, min(n, s + 256))
        sims = points[rows] @ points.T
        sims[np.arange(len(rows)), rows] = -9.0
        near.append(robust_prune(points, rows, np.argpartition(-sims, pools - 1, axis=1)[:, :pools], NEAR))
        far.append(robust_prune(points, rows, rng.integers(0, n, (len(rows), POOL)), FAR))
    near, far = np.concatenate(near), np.concatenate(far)
    a = np.repeat(np.arange(n), NEAR + FAR)
    b = np.concatenate([near, far], axis=1).ravel()
    a, b = a[b >= 0], b[b >= 0]
    sim = np.einsum("nd,nd->n", points[a], points[b])
    order = np.lexsort((-sim, b))
    back_to, back_from = b[order], a[order]
    place = np.arange(len(order)) - np.searchsorted(back_to, back_to)
    total = np.bincount(back_to, minlength=n)[back_to]
    keep = (place < NEAR) | (total - place <= 2 * FAR)  # the nearest and the farthest of the edges back
    heads, tails = np.concatenate([a, back_to[keep]]), np.concatenate([b, back_from[keep]])
    pairs = np.unique(heads * n + tails)
    return np.split(pairs % n, np.searchsorted(pairs, np.arange(1, n) * n))


def range_search(points: np.ndarray, lists: np.ndarray, entries: np.ndarray, queries: np.ndarray, own: np.ndarray,
                 floor: float, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """(query, point) pairs met with a similarity of ``floor`` or more.

    ``lists`` are the points' adjacency lists, padded by len(points); ``own`` is a query's place among the points (-1: none).
    """
    n, q = len(points), len(queries)
    every = np.arange(q)
    seen = np.zeros((q, n + 1), bool)
    seen[:, n] = True
    met_q, met_p = [], []

    def meet(a, b):
        sim = np.einsum("nd,nd->n", queries[a], points[b])
        inside = sim >= floor
        met_q.append(a[inside])
        met_p.append(b[inside])
        return sim

    ids = np.full((q, beam + len(entries) + 1), n)
    ids[:, :len(entries)] = entries
    mine = (own >= 0) & ~np.isin(own, entries)
    ids[mine, len(entries)] = own[mine]
    a, at = np.nonzero(ids < n)
    sims = np.full(ids.shape, -2.0, np.float32)
    sims[a, at] = meet(a, ids[a, at])
    seen[a, ids[a, at]] = True
    first = np.argsort(-sims, axis=1, kind="stable")[:, :beam]
    ids, sims = np.take_along_axis(ids, first, 1), np.take_along_axis(sims, first, 1)
    opened = np.zeros((q, n + 1), bool)
    while True:
        score = np.where(opened[every[:, None], ids] | (ids == n), -3.0, sims)
        pick = score.argmax(axis=1)
        rows = np.flatnonzero(score[every, pick] > -3.0)
        if not len(rows):
            break
        node = ids[rows, pick[rows]]
        opened[rows, node] = True
        nearby = lists[node]
        a, at = np.nonzero(~seen[rows[:, None], nearby])
        if not len(a):
            continue
        more = np.full(nearby.shape, -2.0, np.float32)
        found = nearby[a, at]
        seen[rows[a], found] = True
        more[a, at] = meet(rows[a], found)
        both_ids = np.concatenate([ids[rows], np.where(more > -2.0, nearby, n)], axis=1)
        both = np.concatenate([sims[rows], more], axis=1)
        best = np.argpartition(-both, beam - 1, axis=1)[:, :beam]
        ids[rows], sims[rows] = np.take_along_axis(both_ids, best, 1), np.take_along_axis(both, best, 1)
    # the range expands: whatever lies in it is opened too
    done = 0
    while done < len(met_q):
        a, b = np.concatenate(met_q[done:]), np.concatenate(met_p[done:])
        done = len(met_q)
        fresh = ~opened[a, b]
        a, b = a[fresh], b[fresh]
        opened[a, b] = True
        for s in range(0, len(a), 1 << 15):
            aa = np.repeat(a[s:s + (1 << 15)], lists.shape[1])
            bb = lists[b[s:s + (1 << 15)]].ravel()
            new = ~seen[aa, bb]
            pairs = np.unique(aa[new] * np.int64(n + 1) + bb[new])
            if len(pairs):
                aa, bb = pairs // (n + 1), pairs % (n + 1)
                seen[aa, bb] = True
                meet(aa, bb)
    return np.concatenate(met_q), np.concatenate(met_p)


class Shard:
    """The members of a shard with their lists, ready to be searched."""

    def __init__(self, vectors: np.ndarray, reps: np.ndarray, lists: list):
        """``lists`` are the members' united lists; they also name points of other shards."""
        self.exact, self.reps = unit(vectors), reps
        self.points = self.exact.astype(np.float32)
        n = len(reps)
        order = np.argsort(reps)
        ranked = reps[order]
        rows = np.repeat(np.arange(n), [len(x) for x in lists])
        to = np.fromiter((x for own in lists for x in own), np.int64, len(rows))
        at = np.minimum(np.searchsorted(ranked, to), n - 1)
        here = ranked[at] == to
        rows, to = rows[here], order[at[here]]
        degree = np.bincount(rows, minlength=n)
        self.table = np.full((n, max(1, int(degree.max()))), n)
        self.table[rows, np.arange(len(rows)) - np.repeat(np.cumsum(degree) - degree, degree)] = to
        centres = means(self.exact, MEDOIDS, np.random.default_rng(n))
        self.medoids = np.unique((self.exact @ centres.T).argmax(axis=0))

    def search(self, exact: np.ndarray, own: np.ndarray, threshold: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, member) pairs that the search finds and double precision confirms; a query isn't linked with itself (``own``)."""
        out = [], []
        points = exact.astype(np.float32)
        step = max(16, min(512, (1 << 22) // len(self.reps)))
        for s in range(0, len(exact), step):
            a, b = range_search(self.points, self.table, self.medoids, points[s:s + step], own[s:s + step], threshold - SLACK, beam)
            for t in range(0, len(a), 1 << 17):
                x, y = a[t:t + (1 << 17)] + s, b[t:t + (1 << 17)]
                good = (own[x] != y) & (np.einsum("nd,nd->n", exact[x], self.exact[y]) >= threshold)
                out[0].append(x[good])
                out[1].append(y[good])
        return tuple(np.concatenate(o) if o else np.empty(0, np.int64) for o in out)


def shard_parts(batches, most: int = 4096):
    """Of rows sorted by shard, members first: (shard, True, all its members), then (shard, False, some of its visitors) for all of them."""
    pending, last = [], None
    for b in batches:
        if not b.num_rows:
            continue
        shard, member = b.column("shard").to_numpy(), b.column("member").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero((shard[1:] != shard[:-1]) | (member[1:] != member[:-1])) + 1).tolist(), b.num_rows]
        for i, j in zip(cuts, cuts[1:]):
            if pending and (shard[i] != last or not member[i]):
                yield last, True, pa.Table.from_batches(pending)
                pending = []
            last = shard[i]
            if member[i]:
                pending.append(b.slice(i, j - i))
            else:
                for k in range(i, j, most):
                    yield last, False, pa.Table.from_batches([b.slice(k, min(most, j - k))])
    if pending:
        yield last, True, pa.Table.from_batches(pending)


def first_shard(shards_a: np.ndarray, shards_b: np.ndarray, member_a: np.ndarray, member_b: np.ndarray, shard: int) -> np.ndarray:
    """Whether ``shard`` is, of each pair, the first of those that both points visit and one of them is a member of."""
    first = np.ones(len(shards_a), bool)
    for i in range(shards_a.shape[1]):
        for j in range(shards_b.shape[1]):
            first &= ~((shards_a[:, i] == shards_b[:, j]) & (member_a[:, i] | member_b[:, j]) & (shards_a[:, i] < shard))
    return first


def forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, smallest row of its component) of every row of the pairs but the smallest itself."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    rows = np.flatnonzero(label != np.arange(n))
    return rows, label[rows]


def _search_once(points: DataFrame, threshold: float, own: int, visits: int, beam: int, shard: int, centroid_bytes: int) -> DataFrame:
    """rep, other, links: numbers of links (other null) and edges that join the linked points (links null)."""
    named = shards_of(points, own, visits, shard, centroid_bytes).withColumn("shard", F.xxhash64("shard"))
    rows = written(named)

    def build(batches):
        for t in sorted_groups(batches, ["shard"]):
            ids = t.column("rep").to_numpy()
            lists = shard_graph(unit(matrix(t.column("vector"))).astype(np.float32))
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array([ids[x] for x in lists], pa.list_(pa.int64()))], ["rep", "to"])

    lists = by_key(rows.where("member").select("shard", "rep", "vector"), ["shard"], ["rep"]).mapInArrow(build, "rep long, to array<long>")
    graph = lists.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("to"))).alias("to"))
    visited = rows.groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("shard", "member"))).alias("visited"))
    flat = written(graph.join(visited, "rep"))
    joined = rows.join(flat, "rep").select("shard", "rep", "member", "copies", "vector", F.when(F.col("member"), F.col("to")).alias("to"),
                                           F.col("visited.shard").alias("shards"), F.col("visited.member").alias("members"))

    def visits_of(t):
        shards = t.column("shards").to_pylist()
        width = max(map(len, shards))
        shard_, member_ = np.full((len(shards), width), np.iinfo(np.int64).max), np.zeros((len(shards), width), bool)
        for i, (s, m) in enumerate(zip(shards, t.column("members").to_pylist())):
            shard_[i, :len(s)], member_[i, :len(m)] = s, m
        return shard_, member_

    def run(batches):
        own = None
        for name, members, t in shard_parts(batches):
            ids, copies = t.column("rep").to_numpy(), t.column("copies").to_numpy()
            if members:
                own, index = name, Shard(matrix(t.column("vector")), ids, t.column("to").to_pylist())
                held, weight = visits_of(t), copies
                exact, visited = index.exact, held
                a, b = index.search(exact, np.arange(len(ids)), threshold, beam)
                pairs = np.unique(np.minimum(a, b) * np.int64(len(ids)) + np.maximum(a, b))  # met from either side
                a, b = pairs // len(ids), pairs % len(ids)
            elif name != own:
                continue  # visited, but nobody's
            else:
                exact, visited = unit(matrix(t.column("vector"))), visits_of(t)
                a, b = index.search(exact, np.full(len(ids), -1), threshold, beam)
            mine = first_shard(visited[0][a], held[0][b], visited[1][a], held[1][b], name)
            a, b = a[mine], b[mine]
            links, back = np.zeros(len(ids), np.int64), np.zeros(len(index.reps), np.int64)
            np.add.at(links, a, weight[b])
            np.add.at(back, b, copies[a])
            both = np.concatenate([index.reps, ids])
            x, y = forest(a + len(index.reps), b, len(both)) if not members else forest(a, b, len(both))
            counts = [(index.reps, back), (ids, links)]
            rep = np.concatenate([r[n > 0] for r, n in counts] + [both[x]])
            n = [n for _, c in counts for n in c[c > 0].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array([None] * len(n) + both[y].tolist(), pa.int64()),
                                              pa.array(n + [None] * len(x), pa.int64())], ["rep", "other", "links"])

    dealt = joined.withColumn("visitor", ~F.col("member")).repartition(partitions(points.sparkSession), "shard")
    return written(dealt.sortWithinPartitions("shard", "visitor", "rep").drop("visitor").mapInArrow(run, "rep long, other long, links long"))


def audit(points: DataFrame, found: DataFrame, threshold: float, sample: int = AUDIT) -> tuple[int, int]:
    """(links found, links there are) of ``sample`` points, by comparison with every vector of their labels."""
    spark = points.sparkSession
    tried = points.select("rep", "label", "vector").orderBy(F.xxhash64("rep"), "rep").limit(sample).collect()
    shared = spark.sparkContext.broadcast([(r["rep"], r["label"], unit(np.array([r["vector"]], np.float64))[0]) for r in tried])

    def count(batches):
        total: dict[int, int] = {}
        for b in batches:
            label = np.array(b.column("label").to_pylist(), object)
            length = b.column("vector").value_lengths().to_numpy()
            copies, ids = b.column("copies").to_numpy(), b.column("rep").to_numpy()
            for key in sorted(set(zip(label, length))):
                asked = [x for x in shared.value if (x[1], len(x[2])) == key]
                if asked:
                    at = np.flatnonzero((label == key[0]) & (length == key[1]))
                    near = np.array([x[2] for x in asked]) @ unit(matrix(b.column("vector").take(pa.array(at)))).T >= threshold
                    near[np.array([x[0] for x in asked])[:, None] == ids[at][None, :]] = False
                    for x, n in zip(asked, (near * copies[at]).sum(axis=1).tolist()):
                        total[x[0]] = total.get(x[0], 0) + n
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["rep", "links"])

    true = points.select("rep", "label", "vector", "copies").mapInArrow(count, "rep long, links long").agg(F.sum("links")).first()[0]
    ids = spark.createDataFrame([(r["rep"],) for r in tried], "rep long")
    got = found.join(F.broadcast(ids), "rep").agg(F.sum("links")).first()[0]
    return got or 0, true or 0


def link(table: DataFrame, threshold: float = 0.93, own: int = OWN, visits: int = VISITS, shard: int = SHARD,
         centroid_bytes: int = CENTROID_BYTES) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``table`` (vec_id, embedding, label)."""
    ids, points = points_of(table)
    beam = BEAM
    while True:
        found = _search_once(points, threshold, own, visits, beam, shard, centroid_bytes)
        got, there = audit(points, found, threshold)
        if got >= WANTED * there or (visits >= FAN and beam >= shard):  # every shard was visited, whole
            break
        visits, beam = 2 * visits, 2 * beam
    links = found.where("links is not null").groupBy("rep").agg(F.sum("links").alias("links"))
    group = components(found.where("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b")))
    of_rep = (points.select("rep", "copies").join(links, "rep", "left").join(group.withColumnRenamed("node", "rep"), "rep", "left")
              .select("rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("label", "rep").alias("component")))
    each = written(ids.join(of_rep, "rep").select(F.col("vec_id").alias("id__"), "n_links", "component"))
    own_id = F.col("vec_id").cast("long")
    out = table.select(own_id.alias("vec_id")).join(each, F.col("vec_id") == F.col("id__"), "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op12_vector_links(spark, sf_dir: str) -> DataFrame:
    return link(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
       AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
          WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id AS id, vec_id AS low FROM v UNION SELECT p.b, r.low FROM reach r JOIN pairs p ON p.a = r.id),
low AS (SELECT id, min(low) AS component_id FROM reach GROUP BY id),
n AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, low.component_id, v.vec_id = low.component_id AS kept
FROM v LEFT JOIN n ON n.a = v.vec_id JOIN low ON low.id = v.vec_id
"""
