"""Substring deduplication by an exact index of word windows, in place of a relative Lempel-Ziv parse.

The reference of a document is every document of a smaller doc_id.  The index maps each ``window`` of consecutive words
that can repeat to the smallest document that holds it, by two hashes; documents join it by key, so no task holds a
reference block and a hot passage can be split.  Neighbouring hits of one source are joined to factors, and the words
under factors are the duplicate spans.  A greedy parse against every reference block would mark the same words: each of its
factors of ``window`` words or more is a run of such hits, and every hit lies under a factor once factor boundaries are checked.

Only passages that can repeat are indexed.  Every window has one anchor, its smallest hash of ``seed``
consecutive words; an anchor that one document alone holds proves that none of its windows repeats.
Documents of equal words are worked on once, for the smallest doc_id; the others are one factor each.

Defined results.  No words (null, empty or blank text): nothing removed, empty kept text.  A row without
doc_id has no place in the order: it is neither a reference nor deduplicated.  Repeated rows
give one row each, alike; rows of one doc_id are no references to each other, and each is judged by its own text.  Extra
columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import WordHashes, bounded, grams, long_grams, small_batches, text_key, values, written
from .tokens import process_wide

WINDOW = 50
SEED = 20
FACTOR = "array<struct<start:int,length:int,source:long>>"


def anchors_of(h: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The seed hashes of a document, and for each window the position of its anchor."""
    g = grams(h, seed)
    span = window - seed + 1
    if len(h) < window:
        return g, np.empty(0, np.int64)
    return g, np.lib.stride_tricks.sliding_window_view(g, span).argmin(axis=1) + np.arange(len(h) - window + 1)


def greedy_factors(starts: list[int], sources: list[int], window: int) -> list[tuple[int, int, int]]:
    """(start, length, source) of the factors, from the windows that the index has, in order."""
    out: list[tuple[int, int, int]] = []
    i = 0
    while i < len(starts):
        j = i
        while j + 1 < len(starts) and starts[j + 1] == starts[j] + 1 and sources[j + 1] == sources[i]:
            j += 1
        out.append((starts[i], starts[j] - starts[i] + window, sources[i]))
        i = j + 1
    return out


def _anchored(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """doc_id, key (hash of the text), n, f1, f2 (fingerprint of the word sequence), anchors (hash, position) of long enough rows."""

    def run(batches):
        hashes = process_wide(("hashes",), WordHashes)
        for b in (batch.slice(s, 256) for batch in batches for s in range(0, batch.num_rows, 256)):  # the anchors of a few texts at a time
            ids, keys, ns, f1, f2, hash_, place = [], [], [], [], [], [], []
            for i, key, t in zip(*(b.column(c).to_pylist() for c in ("doc_id", "key", "text"))):
                words = (t or "").encode().split()
                if i is None or len(words) < window:
                    continue
                h = hashes.of(words)
                g, at = anchors_of(h, window, seed)
                at = np.unique(at)
                ids.append(i)
                keys.append(key)
                ns.append(len(words))
                f1.append(int(long_grams(h, len(h), 1)[0].view(np.int64)))
                f2.append(int(long_grams(h, len(h), 2)[0].view(np.int64)))
                hash_.append(g[at].view(np.int64))
                place.append(at.astype(np.int32))
            if not ids:
                continue
            each = pa.StructArray.from_arrays([pa.array(np.concatenate(hash_)), pa.array(np.concatenate(place))], ["hash", "at"])
            anchors = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, place)]), pa.int32()), each)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in (ids, keys, ns, f1, f2)), anchors], ["doc_id", "key", "n", "f1", "f2", "anchors"])

    return docs.select("doc_id", text_key().alias("key"), "text").mapInArrow(
        run, "doc_id long, key long, n long, f1 long, f2 long, anchors array<struct<hash:long,at:int>>")


def _windows(docs: DataFrame, wanted: DataFrame, window: int, seed: int) -> DataFrame:
    """h1, h2, doc_id, key, at: the windows of the wanted documents at their wanted anchors."""

    def run(batches):
        hashes = process_wide(("hashes",), WordHashes)
        for b in batches:
            for i, key, t, ats in zip(*(values(b.column(c)) for c in ("doc_id", "key", "text", "ats"))):
                h = hashes.of((t or "").encode().split())
                _, at = anchors_of(h, window, seed)
                w = np.flatnonzero(np.isin(at, np.array(ats)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(long_grams(h, window, 3)[w].view(np.int64)), pa.array(long_grams(h, window, 4)[w].view(np.int64)),
                     pa.array(np.full(len(w), i, np.int64)), pa.array(np.full(len(w), key, np.int64)), pa.array(w.astype(np.int32))],
                    ["h1", "h2", "doc_id", "key", "at"])

    return (docs.select("doc_id", text_key().alias("key"), "text").join(bounded(wanted), ["doc_id", "key"])
            .mapInArrow(run, "h1 long, h2 long, doc_id long, key long, at int"))


def factors(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """doc_id, key, factors: the factors of every document (doc_id and text) that has one against smaller doc_ids."""
    with small_batches(docs.sparkSession):
        base = written(_anchored(docs, window, seed))
    classes = base.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("first"))
    named = base.join(classes, ["n", "f1", "f2"])
    copies = named.where("doc_id > first").select(
        "doc_id", "key", F.array(F.struct(F.lit(0).alias("start"), F.col("n").cast("int").alias("length"),
                                   F.col("first").alias("source"))).cast(FACTOR).alias("factors"))
    first = classes.select(F.col("first").alias("doc_id"), "n", "f1", "f2").join(base, ["doc_id", "n", "f1", "f2"])
    rows = first.select("doc_id", "key", F.explode("anchors").alias("a")).select("doc_id", "key", "a.hash", "a.at")
    # written, so that the join has an exchange on either side and a hot anchor's rows can be split
    often = written(rows.groupBy("hash").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("hash"))
    wanted = written(rows.join(often, "hash").groupBy("doc_id", "key").agg(F.collect_set("at").alias("ats")))
    # both written: the join has an exchange on either side, and a hot passage's rows can be split
    with small_batches(docs.sparkSession):
        windows = written(_windows(docs, wanted, window, seed))
    index = written(windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("high"))
                    .where("source < high").drop("high"))
    hits = windows.join(index, ["h1", "h2"]).where("source < doc_id").groupBy("doc_id", "key").agg(
        F.array_sort(F.collect_set(F.struct("at", "source"))).alias("hits"))

    def parse(batches):
        for b in batches:
            found = [greedy_factors([x["at"] for x in h], [x["source"] for x in h], window) for h in b.column("hits").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("key"), pa.array([[dict(zip(("start", "length", "source"), x)) for x in f] for f in found], pa.list_(
                    pa.struct([("start", pa.int32()), ("length", pa.int32()), ("source", pa.int64())])))], ["doc_id", "key", "factors"])

    parsed = hits.mapInArrow(parse, f"doc_id long, key long, factors {FACTOR}")
    with small_batches(docs.sparkSession):
        return written(parsed.unionByName(copies).dropDuplicates(["doc_id", "key"]))  # repeated rows have the same factors


def _with_factors(docs: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """``docs`` with the factors of each row's own text in column ``name``."""
    found = bounded(found.select(F.struct(F.col("doc_id").alias("id"), "key").alias(f"{name}of"), F.col("factors").alias(name)))
    return docs.join(found, (F.col("doc_id") == F.col(f"{name}of.id")) & (text_key() == F.col(f"{name}of.key")), "left").drop(f"{name}of")


def covered(n: int, spans) -> np.ndarray:
    """Which of ``n`` words lie under a factor."""
    gone = np.zeros(n + 1, np.int64)
    for s in spans or ():
        gone[min(s["start"], n)] += 1
        gone[min(s["start"] + s["length"], n)] -= 1
    return np.cumsum(gone[:n]) > 0


def digest(docs: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 per row, from the operator's factors."""

    def run(batches):
        for b in batches:
            n, gone, sha = [], [], []
            for t, spans in zip(values(b.column("text")), values(b.column("factors"))):
                words = (t or "").encode().split()
                off = covered(len(words), spans) if spans else None
                kept = words if off is None else [w for w, o in zip(words, off.tolist()) if not o]
                n.append(len(words))
                gone.append(len(words) - len(kept))
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                                              pa.array(sha, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return (_with_factors(docs.select("doc_id", "text"), found, "factors")
            .mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string"))


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the words under factors cut out of ``text``; rows left without a word go.

    The text outside the factors stays as it is, white space included; ``n_chars``, if there, follows.
    """
    name = "factors__"
    found = factors(docs, window)
    schema = docs.schema
    at = docs.columns.index("text")

    def run(batches):
        import re

        word = re.compile(rb"[^\x20\x09-\x0D]+")
        for b in (batch.slice(s, 256) for batch in batches for s in range(0, batch.num_rows, 256)):  # a few texts at a time
            texts = b.column("text").to_pylist()
            for k, spans in enumerate(b.column(name).to_pylist()):
                if spans:
                    raw = texts[k].encode()
                    limits = [m.span() for m in word.finditer(raw)]
                    off = covered(len(limits), spans).tolist()
                    if all(off):
                        texts[k] = ""
                        continue
                    keep, last = [], 0
                    for (i, j), o in zip(limits, off):
                        if o:
                            keep.append(raw[last:i])
                            last = j
                    texts[k] = b"".join([*keep, raw[last:]]).decode()
            cols = [b.column(c) for c in schema.names]
            cols[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(cols, schema.names)

    cut = _with_factors(docs, found, name).select(*docs.columns, name)
    touched = cut.where(f"{name} is not null").mapInArrow(run, schema).where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        touched = touched.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType))
    with small_batches(docs.sparkSession):
        touched = written(touched)
    return cut.where(f"{name} is null").select(*docs.columns).union(touched)


def op10_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digest(docs, factors(docs))
