"""Shared helpers of the training-data operators: lineage cuts, hashing, streaming groups."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import ensure_checkpoint_dir

#: A written table is broadcast up to this many bytes of Parquet; beyond it the join shuffles.
BROADCAST_BYTES = 16 << 20

#: Entries a worker's word cache may hold before it starts again.
CACHE_WORDS = 100_000

#: Rows of an Arrow batch inside ``small_batches``.
BATCH_ROWS = 500

WORD = r"[^\x20\x09-\x0D]+"


@contextmanager
def small_batches(spark, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Jobs that run inside the block send Python at most ``rows`` rows at a time.

    A task and its worker each hold a batch whole, and the buffers grow by doubling: of long texts or sets Spark's 10,000 rows are too many.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), rows) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder: lineage is cut, executors can be lost.

    The folder goes when the session's JVM ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return spark.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A ``written`` table with a broadcast hint if its files are within ``limit``, else as it is."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return F.broadcast(df) if int(size) <= limit else df


def partitions(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser on uint64 arrays."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash of a word (bytes), remembered for the words that come again."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > CACHE_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def hashed(words: list[bytes]) -> np.ndarray:
    """The hashes that ``WordHashes`` gives ``words``, for distinct words."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def grams(h: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of every run of ``n`` word hashes, in order; empty if there are fewer words."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    acc = mix(h[:m] + np.uint64(seed))
    for i in range(1, n):
        acc = mix(acc + h[i:i + m])
    return acc


def long_grams(h: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hash of every run of ``n`` word hashes in constant work per word, for long runs.

    Prefix sums of ``mix(h + seed) * B**i`` modulo 2**64, divided by the power of the run's start.
    """
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    base = np.uint64((seed * 2 + 0x9E3779B97F4A7C15) | 1)
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    power = np.cumprod(np.full(len(h), base, np.uint64))
    back = np.cumprod(np.full(m, inverse, np.uint64))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h + np.uint64(seed)) * power)])
    return mix((total[n:n + m] - total[:m]) * back)


def text_key():
    """A row's text as a number: with the doc_id it tells rows of one doc_id apart."""
    return F.xxhash64("text")


def values(column: pa.Array, step: int = 256) -> Iterator:
    """The values of a column as Python objects, a few at a time."""
    for s in range(0, len(column), step):
        yield from column.slice(s, step).to_pylist()


def long_column(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def sorted_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of equal keys of rows that come sorted by ``keys``, over the limits of batches."""
    pending: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(b.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), b.num_rows]
        for i, j in zip(cuts, cuts[1:]):
            if i == j:
                continue
            key = tuple(c[i] for c in cols)
            if pending and key != last:
                yield pa.Table.from_batches(pending)
                pending = []
            last = key
            pending.append(b.slice(i, j - i))
    if pending:
        yield pa.Table.from_batches(pending)


def by_key(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """``df`` dealt out by ``keys`` and sorted by them (and ``order``) inside each partition."""
    return df.repartition(partitions(df.sparkSession), *keys).sortWithinPartitions(*keys, *(order or []))


class Forest:
    """Union-find over 0..n-1 that remembers the unions it made."""

    def __init__(self, n: int):
        self.parent = np.arange(n)
        self.edges: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        p = self.parent
        while p[i] != i:
            p[i] = p[p[i]]
            i = p[i]
        return i

    def roots(self) -> np.ndarray:
        p = self.parent
        while True:
            q = p[p]
            if (q == p).all():
                self.parent = q
                return q
            p = q

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
            self.edges.append((i, j))


def link_forest(sets: list[np.ndarray], linked) -> list[tuple[int, int]]:
    """A spanning forest of the graph in which ``linked(i, others, shared)`` says who is linked with ``i``.

    ``sets`` are the members' values; only members that share a value are asked about.  ``linked`` gets the
    candidates not yet joined with ``i`` and how many values each shares.  A member that another one has
    absorbed is not looked at on its own unless its component isn't the largest: every pair of two
    components has an end outside the largest one, so no link is missed.
    """
    n = len(sets)
    forest = Forest(n)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    order = np.argsort(codes, kind="stable")
    posting = owner[order]
    start = np.concatenate([[0], np.cumsum(np.bincount(codes))])
    offset = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    done = np.zeros(n, bool)

    def look(i: int) -> None:
        done[i] = True
        own = codes[offset[i]:offset[i + 1]]
        own = own[start[own + 1] - start[own] > 1]
        if not len(own):
            return
        shared = np.bincount(np.concatenate([posting[start[c]:start[c + 1]] for c in own]), minlength=n)
        roots = forest.roots()
        others = np.flatnonzero((shared > 0) & (roots != roots[i]))
        if len(others):
            for j in others[linked(i, others, shared[others])].tolist():
                forest.join(i, j)

    absorbed = np.zeros(n, bool)
    for i in range(n):
        if not absorbed[i]:
            look(i)
            absorbed |= forest.roots() == forest.root(i)
    while True:
        roots = forest.roots()
        largest = np.bincount(roots).argmax()
        rest = np.flatnonzero((roots != largest) & ~done)
        if not len(rest):
            return forest.edges
        look(int(rest[0]))


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node in ``edges`` (a, b): label is the smallest node of its component.

    Contraction: each node moves to its smallest neighbour (and that one's), the edges are renamed,
    until none is left; the graph shrinks every round and nothing reaches the driver but a count.
    """
    edges = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    label = None
    while edges.count():
        both = edges.union(edges.select(F.col("b"), F.col("a")))
        near = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("p"))
        step = near.join(near.select(F.col("u").alias("p"), F.col("p").alias("q")), "p").select("u", F.col("q").alias("p"))
        step = written(step)
        moved = step.select(F.col("u").alias("label"), "p")
        label = step.select(F.col("u").alias("node"), F.col("p").alias("label")) if label is None else written(
            label.join(moved, "label", "left").select("node", F.coalesce("p", "label").alias("label")))
        edges = (edges.join(step.select(F.col("u").alias("a"), F.col("p").alias("pa")), "a")
                 .join(step.select(F.col("u").alias("b"), F.col("p").alias("pb")), "b").where("pa <> pb"))
        edges = written(edges.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct())
    if label is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return label
