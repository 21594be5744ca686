"""MinHash near-duplicates from bottom-k sketches of one hash function.

A document's sketch holds the ``k`` smallest hashes of its distinct word shingles.  Documents of equal
sets fall into one class first (128-bit fingerprints), so copies never meet in pairs.  Then

1. inverted lists: a retained value that only one class holds cannot be shared, so classes with fewer than
   ``needed`` shared-able values leave; of the rest only the rarest ``m - needed + 1`` values are listed,
   because two sketches with ``needed`` common values must share one of those;
2. inside a list, overlaps are counted and the union-sketch estimate (how many of the k smallest values of
   both sketches lie in both) filters them; a list gives a spanning forest, never all its pairs, and lists
   over ``LIST_ROWS`` classes are worked on in pairs of blocks;
3. inside a component of estimated links, exact Jaccard on the full sets decides each link that could still
   join two parts.

``needed`` comes from the binomial law of the estimate: a pair at exactly the threshold gets lost with a
probability below ``MISS``; for sets of up to ``k`` shingles it is exact.

Defined results.  No words (null, empty or blank text): empty set, linked with nothing.  A row without
doc_id links with nothing and stays (component null, kept true).  Equal rows of one doc_id give one
row each, alike (``drop_near_duplicates`` leaves one of them); other texts of it are judged each by its own.  Other columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import (WordHashes, bounded, by_key, components, grams, link_forest, mix, partitions, sorted_groups,
                     small_batches, text_key, values, written)
from .tokens import process_wide

K = 64
MISS = 1e-9
LIST_ROWS = 16_384
BLOCK_SHINGLES = 2_000_000


def shingle_set(raw: bytes, hashes: WordHashes, n: int) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles; fewer words count as one shingle."""
    words = raw.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(grams(hashes.of(words), min(n, len(words)), n if len(words) >= n else len(words)))


def needed(n: int, k: int, percent: int, miss: float = MISS) -> int:
    """Retained values that two linked documents share at least, one of them with ``n`` shingles."""
    j = percent / 100
    if n <= k:
        return max(1, -(-percent * n // 100) - max(0, n * 100 // percent - k))
    below = 0.0
    for s in range(k + 1):
        below += math.comb(k, s) * j ** s * (1 - j) ** (k - s)
        if below > miss:
            return max(1, s)
    return k


def sketches(docs: DataFrame, words: int, k: int) -> DataFrame:
    """doc_id, key (hash of the text), n (set size), f1, f2 (fingerprint of the set), sketch (k smallest values, ascending)."""

    def run(batches):
        hashes = process_wide(("hashes",), WordHashes)
        for b in batches:
            n, f1, f2, sk = [], [], [], []
            for t in values(b.column("text")):
                s = shingle_set((t or "").encode(), hashes, words)
                n.append(len(s))
                f1.append(int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)))
                f2.append(int(mix(s + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64).view(np.int64)))
                sk.append(s[:k].view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("key"), pa.array(n, pa.int64()), pa.array(f1, pa.int64()),
                                              pa.array(f2, pa.int64()), pa.array(sk, pa.list_(pa.int64()))],
                                             ["doc_id", "key", "n", "f1", "f2", "sketch"])

    rows = docs.select("doc_id", text_key().alias("key"), "text")
    return rows.mapInArrow(run, "doc_id long, key long, n long, f1 long, f2 long, sketch array<long>")


def _listed(classes: DataFrame, k: int, percent: int) -> DataFrame:
    """value, block_a, block_b, class_id, n, values, ranks: the rows of the inverted lists."""
    values = classes.select("class_id", "n", F.posexplode("sketch").alias("rank", "value"))
    # written, so that the join has an exchange on either side and a hot value's rows can be split
    often = written(values.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1"))
    spark = classes.sparkSession
    least = spark.createDataFrame([(n, needed(n, k, percent)) for n in range(1, k + 2)], "size int, needed int")
    held = (values.join(often, "value").groupBy("class_id", "n")
            .agg(F.array_sort(F.collect_list(F.struct("df", "value", "rank"))).alias("v"))
            .withColumn("size", F.least("n", F.lit(k + 1)).cast("int"))
            .join(F.broadcast(least), "size").where("size(v) >= needed"))
    rows = held.select("class_id", "n", F.col("v.value").alias("values"), F.col("v.rank").alias("ranks"),
                       F.explode(F.slice("v", F.lit(1), F.size("v") - F.col("needed") + 1)).alias("e"))
    blocks = F.ceil(F.col("e.df") / F.lit(LIST_ROWS)).cast("int")
    own = F.pmod(F.xxhash64("class_id"), blocks).cast("int")
    rows = rows.select(F.col("e.value").alias("value"), "class_id", "n", "values", "ranks", own.alias("own"),
                       F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    return rows.select("value", F.least("own", "other").alias("block_a"), F.greatest("own", "other").alias("block_b"),
                       "class_id", "n", "values", "ranks")


def _estimated_links(listed: DataFrame, k: int, percent: int) -> DataFrame:
    """a, b: a spanning forest, for each list, of the pairs whose union-sketch estimate passes."""

    least = [needed(n, k, percent) for n in range(1, k + 2)]

    def run(batches):
        for t in sorted_groups(batches, ["value", "block_a", "block_b"]):
            if t.num_rows < 2:
                continue
            ids = t.column("class_id").to_numpy()
            sizes = t.column("n").to_numpy()
            floor = np.array([least[min(n, k + 1) - 1] for n in sizes.tolist()])
            sets = [np.array(x) for x in t.column("values").to_pylist()]
            rank = [np.array(x) for x in t.column("ranks").to_pylist()]

            def linked(i, others, shared):
                ok = shared >= np.maximum(floor[i], floor[others])
                small, large = np.minimum(sizes[i], sizes[others]), np.maximum(sizes[i], sizes[others])
                ok &= 100 * small >= percent * large
                mine = dict(zip(sets[i].tolist(), rank[i].tolist()))
                for at in np.flatnonzero(ok).tolist():
                    j = int(others[at])
                    both = sorted((mine[v], r) for v, r in zip(sets[j].tolist(), rank[j].tolist()) if v in mine)
                    # rank in the union: both own ranks less the common values before it
                    inside = sum(a + b - c < k for c, (a, b) in enumerate(both))
                    ok[at] = inside >= max(floor[i], floor[j])
                return ok

            edges = link_forest(sets, linked)
            if edges:
                e = np.array(edges)
                yield pa.RecordBatch.from_arrays([pa.array(ids[e[:, 0]]), pa.array(ids[e[:, 1]])], ["a", "b"])

    return by_key(listed, ["value", "block_a", "block_b"], ["class_id"]).mapInArrow(run, "a long, b long")


def _exact_links(docs: DataFrame, classes: DataFrame, groups: DataFrame, words: int, percent: int) -> DataFrame:
    """a, b: a spanning forest of the exact links inside the estimated components."""
    members = groups.select(F.col("node").alias("class_id"), "label").join(classes.select("class_id", "class_key", "n"), "class_id")
    weight = members.groupBy("label").agg(F.sum("n").alias("total"))
    blocks = F.ceil(F.col("total") / F.lit(BLOCK_SHINGLES)).cast("int")
    members = written(members.join(weight, "label").select(
        F.col("class_id").alias("doc_id"), F.col("class_key").alias("key"), "label", blocks.alias("blocks"),
        F.pmod(F.xxhash64("class_id"), blocks).cast("int").alias("own")).distinct())

    def full(batches):
        hashes = process_wide(("hashes",), WordHashes)
        for b in batches:
            sets = [shingle_set((t or "").encode(), hashes, words).tobytes() for t in values(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in ("doc_id", "label", "blocks", "own")]
                                             + [pa.array(sets, pa.binary())], ["doc_id", "label", "blocks", "own", "set"])

    sets = (docs.select("doc_id", text_key().alias("key"), "text").join(bounded(members), ["doc_id", "key"])
            .mapInArrow(full, "doc_id long, label long, blocks int, own int, set binary"))
    sets = sets.select("label", "doc_id", "set", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    sets = sets.select("label", F.least("own", "other").alias("block_a"), F.greatest("own", "other").alias("block_b"),
                       "doc_id", "set")

    def run(batches):
        for t in sorted_groups(batches, ["label", "block_a", "block_b"]):
            ids = t.column("doc_id").to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in t.column("set").to_pylist()]
            sizes = np.array([len(s) for s in sets])

            def linked(i, others, shared):
                return 100 * shared >= percent * (sizes[i] + sizes[others] - shared)

            edges = link_forest(sets, linked) if len(sets) > 1 else []
            if edges:
                e = np.array(edges)
                yield pa.RecordBatch.from_arrays([pa.array(ids[e[:, 0]]), pa.array(ids[e[:, 1]])], ["a", "b"])

    return by_key(sets, ["label", "block_a", "block_b"], ["doc_id"]).mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, k: int = K) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text).

    Two documents are linked if 100 * |A and B| >= percent * |A or B| over their sets of distinct
    ``words``-word shingles (A-Z lower-cased); component_id is the smallest doc_id reachable by links.
    """
    return _verdicts(docs, words, percent, k)[0].drop("key")


def _verdicts(docs: DataFrame, words: int, percent: int, k: int = K) -> tuple[DataFrame, DataFrame]:
    """The rows of ``near_duplicates`` with the ``key`` of their text, and the sketches they come from."""
    with small_batches(docs.sparkSession):
        base = written(sketches(docs, words, k))
    named = base.where("doc_id is not null and n > 0")
    classes = named.groupBy("n", "f1", "f2").agg(F.min(F.struct("doc_id", "key")).alias("first"), F.first("sketch").alias("sketch"))
    classes = written(classes.select("n", "f1", "f2", F.col("first.doc_id").alias("class_id"), F.col("first.key").alias("class_key"), "sketch"))
    guessed = components(_estimated_links(_listed(classes, k, percent), k, percent))
    with small_batches(docs.sparkSession):  # of texts and of whole sets
        exact = components(_exact_links(docs, classes, guessed, words, percent))
    where = classes.select("n", "f1", "f2", "class_id").join(exact.withColumnRenamed("node", "class_id"), "class_id", "left")
    where = where.select("n", "f1", "f2", F.coalesce("label", "class_id").alias("label"))
    out = base.select("doc_id", "key", "n", "f1", "f2").join(where, ["n", "f1", "f2"], "left")
    # an empty set has no class, and a row without doc_id takes none
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id"))
    out = out.select("doc_id", "key", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))), base


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all their columns; one row of those equal in doc_id and text."""
    rows, base = _verdicts(docs, words, percent)
    gone = written(rows.where("not kept").select(F.struct(F.col("doc_id").alias("id"), "key").alias("gone__")).distinct())
    own = (F.col("doc_id") == F.col("gone__.id")) & (text_key() == F.col("gone__.key"))
    kept = docs.join(bounded(gone), own, "left_anti")
    again = written(base.where("doc_id is not null").groupBy("doc_id", "key").count().where("count > 1").select(F.struct(F.col("doc_id").alias("id"), "key").alias("gone__")))
    if again.isEmpty():
        return kept.select(*docs.columns)
    few = kept.join(bounded(again), own, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(bounded(again), own, "left_anti").select(*docs.columns).unionByName(few.select(*docs.columns))


def op4_near_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs, words=3, percent=85)
