"""Bounded-space online best-fit packing of documents into token sequences.

``pieces`` tokenizes: a document's ids, then the end id, cut into ``size``-token pieces only where it is
longer.  ``pack`` places pieces: in each shard at most ``OPEN_BINS`` sequences are open; a bitset keyed by
free space finds the fullest one that still fits a piece in one shift, and when none fits and all places
are taken the fullest one closes first.  Nothing but the fill of the open sequences is held, so a shard's
memory doesn't grow with its rows, and a placement is final at once.  Pieces come in the order of a hash,
which a rerun repeats.  The shards' number follows the tokens (``SHARD_TOKENS``); what the open sequences
of all shards leave free at the end is repacked together, in fewer shards, until one is left over or what is left
(pieces that don't fill sequences) would be more than ``MERGED`` shards' tokens to a shard.

Defined results.  A null or empty text is one piece that holds the end id alone.  Repeated rows (and rows
without doc_id) are packed once each.  Extra columns are not looked at; an empty table packs into nothing.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import written
from .tokens import word_tokens

SIZE = 4096
END = 1
OPEN_BINS = 4096
SHARD_TOKENS = 16_000_000
FULL = 0.97
MERGED = 8


def pieces(docs: DataFrame, size: int = SIZE, vocabulary_file: str = "word_bpe_49k.json", end: int = END,
           with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids as bytes) of every piece of every row."""

    def run(batches):
        tokens = word_tokens(vocabulary_file)
        last = np.array([end], "<u4").tobytes()
        step = 4 * size
        for b in batches:
            cols = [[], [], [], [], [], []]
            for i, ids in zip(b.column("doc_id").to_pylist(), tokens.encode_texts(b.column("text"))):
                ids += last
                for k, s in enumerate(range(0, len(ids), step)):
                    part = ids[s:s + step]
                    for c, x in zip(cols, (i, k, s // 4, len(part) // 4, zlib.crc32(part), part)):
                        c.append(x)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols[:5 + with_ids], kinds)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:5 + with_ids])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select("doc_id", "text").mapInArrow(run, schema)


class OpenBins:
    """The open sequences of a shard, by free space."""

    def __init__(self, size: int, most: int, first: int):
        self.size, self.most, self.next = size, most, first
        self.bits = 0
        self.by_free: list[list[int]] = [[] for _ in range(size + 1)]
        self.open = 0

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) for a piece of ``length`` tokens."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            bins = self.by_free[free]
            at = bins.pop()
            if not bins:
                self.bits ^= 1 << free
            self.open -= 1
        else:
            if self.open == self.most:
                free = (self.bits & -self.bits).bit_length() - 1  # the fullest closes
                bins = self.by_free[free]
                bins.pop()
                if not bins:
                    self.bits ^= 1 << free
                self.open -= 1
            at, free = self.next, self.size
            self.next += 1
        left = free - length
        if left:
            if not self.by_free[left]:
                self.bits |= 1 << left
            self.by_free[left].append(at)
            self.open += 1
        return at, self.size - free


def _round(rows: DataFrame, size: int, shards: int, level: int) -> DataFrame:
    """``rows`` with sequence_id and offset, packed in ``shards`` shards."""
    names = rows.columns
    order = F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(level))
    dealt = rows.withColumn("order__", order).withColumn("shard__", F.pmod("order__", F.lit(shards)).cast("int"))
    dealt = dealt.repartition(shards, "shard__").sortWithinPartitions("shard__", "order__", "doc_id", "piece")

    def run(batches):
        bins, own = None, None
        for b in batches:
            seq, off = [], []
            for s, n in zip(b.column("shard__").to_pylist(), b.column("length").to_pylist()):
                if s != own:
                    own = s
                    bins = OpenBins(size, OPEN_BINS, (level << 58) + (s << 34))
                a, o = bins.place(n)
                seq.append(a)
                off.append(o)
            yield pa.RecordBatch.from_arrays([b.column(c) for c in names] + [pa.array(seq, pa.int64()), pa.array(off, pa.int64())],
                                             [*names, "sequence_id", "offset"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return dealt.mapInArrow(run, f"{kinds}, sequence_id long, offset long")


def pack(rows: DataFrame, size: int = SIZE, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """``rows`` (doc_id, piece, length, ids_crc32, ...) with sequence_id and offset.

    Sequences that end a round less than ``FULL`` full are taken apart and packed anew with those of the
    other shards, in an eighth of the shards (more, if that is over ``MERGED * shard_tokens`` each), down to one
    shard or until they can't be halved.
    """
    total = rows.agg(F.sum("length")).first()[0] or 0
    shards, level, done = max(1, -(-total // shard_tokens)), 0, None
    while True:
        placed = written(_round(rows, size, shards, level))
        if shards == 1:
            return placed if done is None else done.unionByName(placed)
        fill = placed.groupBy("sequence_id").agg(F.sum("length").alias("fill"))
        loose = written(fill.where(F.col("fill") < F.lit(int(FULL * size))))
        left = loose.agg(F.sum("fill")).first()[0] or 0
        fewer = max(-(-shards // MERGED), -(-left // (MERGED * shard_tokens)))
        if fewer > -(-shards // 2):
            return placed if done is None else done.unionByName(placed)
        loose = loose.select("sequence_id")
        kept = placed.join(loose, "sequence_id", "left_anti").select(*placed.columns)
        done = kept if done is None else done.unionByName(kept)
        rows = placed.join(loose, "sequence_id", "left_semi").select(*rows.columns)
        shards, level = fewer, level + 1


def packed_sequences(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """sequence_id, length, ids (little-endian uint32 bytes), doc_ids and starts of its pieces, in place order."""
    placed = pack(pieces(docs, size, with_ids=True), size)
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    grouped = placed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("p"))
    return grouped.select("sequence_id", "length",
                          F.aggregate("p.ids", F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"),
                          F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("starts"))


def op3_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(written(pieces(docs)))
