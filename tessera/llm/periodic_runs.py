"""Periodic runs of words: tiles scaled to the period, boundary Z-functions, fragments stitched by (document, period).

A run is a stretch of words with smallest period q and a length of ``LEAST`` words and ``TIMES`` periods at least, which
no neighbouring word extends.

1. Tiles.  For the periods of octave k, 2**k to 2**(k+1) - 1, a document is cut into tiles that overlap by three of the
   octave's longest periods and whose stride grows with the octave (``TILE`` words at least, so the low octaves share
   their tiles).  A document that one tile holds is worked on where it is read; the tiles of longer ones are rows
   of their own, dealt over the cluster, so that no task works through a very long text alone.
2. Boundaries.  Within a tile of octave k every 2**k-th word is a boundary; a stretch of three periods q >= 2**k holds one
   with a whole square behind it.  For all boundaries and periods at once, equal hashes of the 2**k words at both ends
   of the square say where the boundary's Z-function reaches q; there, the words themselves are compared
   in both directions (exactly, so a clash of hashes costs time only), which gives the fragment.  A fragment whose
   first period is a power of a shorter word is left to that word's octave; so are four squares of one octave at one
   boundary before any word is compared (at most two primitive ones and one power fit there).
3. Stitching.  Fragments are shuffled by document and period; those that overlap by a period belong to one stretch.

Defined results.  A null, empty or blank text has no words and no run.  Equal rows (doc_id and text) get equal results,
each; two texts of one doc_id are two documents; a null doc_id is a document like any other.  Extra columns are not
looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import bounded, mix, partitions, written

LEAST, TIMES = 6, 4
TILE = 4096
BASE = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(int(BASE), -1, 1 << 64))


def codes_of(words: list[bytes]) -> np.ndarray:
    """The words as numbers, equal ones alike: by first occurrence."""
    number: dict[bytes, int] = {}
    return np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint32, len(words))


def tiles(n: int, tile: int = TILE) -> list[tuple[int, int, int, int]]:
    """(lowest octave, highest octave, first word, end) of the tiles of a document of ``n`` words."""
    if n < LEAST:
        return []
    top = max(0, (n // TIMES).bit_length() - 1)
    low = max(0, (tile // 8).bit_length() - 1)  # octaves up to here share tiles of ``tile`` words
    out = []
    for first, last in [(0, min(low, top)), *((k, k) for k in range(low + 1, top + 1))]:
        stride, lap = max(tile, 8 << last), 6 << last
        if n <= stride + lap:  # one tile holds the document, and does so for the octaves above
            out.append((first, top, 0, n))
            break
        starts = range(0, n, stride)
        out += [(first, last, s, min(n, s + stride + lap)) for s in starts if s == 0 or s + lap < n]
    return out


def primitive(word: np.ndarray) -> bool:
    """Whether ``word`` is no power of a shorter one."""
    n = left = len(word)
    for d in range(2, n + 1):
        if d * d > left:
            d = left
        if d > 1 and left % d == 0:
            if (word[n // d:] == word[:n - n // d]).all():
                return False
            while left % d == 0:
                left //= d
        if left == 1:
            break
    return True


def fragments(codes: np.ndarray, first: int, last: int, at: int = 0, total: int | None = None) -> list[tuple[int, int, int]]:
    """(period, start, end), in the document's words, of a tile's stretches with periods of octaves ``first`` to ``last``.

    The tile begins at word ``at`` of ``total``.  Whole runs are given, and from three periods on what a limit of the tile cuts.
    """
    n = len(codes)
    total = n if total is None else total
    power = np.cumprod(np.full(n, BASE, np.uint64))
    back = np.cumprod(np.full(n, BACK, np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(codes.astype(np.uint64)) * power)])
    out = []
    for k in range(first, last + 1):
        step = 1 << k
        m = n - step + 1
        count = (n - 2 * step) // step + 1  # boundaries with room for a square
        if count <= 0:
            break
        h = (sums[step:] - sums[:m]) * back[:m]  # of the step words from each word on
        far = np.zeros(count * step, np.uint64)
        own = h[step:step + count * step]
        far[:len(own)] = own
        j, r = np.nonzero(far.reshape(count, step) == h[:count * step:step, None])
        c, q = j * step, step + r
        fits = c + 2 * q <= n
        c, q = c[fits], q[fits]
        square = h[c + q - step] == h[c + 2 * q - step]
        c, q = c[square], q[square]
        if k > 1 and len(c):
            few = np.bincount(c >> k, minlength=count)[c >> k] < 4
            c, q = c[few], q[few]
        for p in np.unique(q).tolist():
            off = np.flatnonzero(codes[p:] != codes[:-p])  # where the Z-functions end
            bound = np.concatenate([[-1], off, [n - p]])
            right = np.searchsorted(bound, c[q == p])
            for i in np.unique(right[bound[right] != c[q == p]]).tolist():
                s, e = int(bound[i - 1]) + 1, int(bound[i]) + p
                cut = (s == 0 and at > 0) or (e == n and at + n < total)
                if e - s >= (3 * p if cut else max(LEAST, TIMES * p)) and primitive(codes[s:s + p]):
                    out.append((p, at + s, at + e))
    return out


def split(doc_id, text: str | None) -> list[bytes]:
    return (text or "").encode().split()


KEYS = "doc_id long, key long"
FRAGMENT = f"{KEYS}, period long, first long, end long"


def found(docs: DataFrame, words=split, tile: int = TILE) -> DataFrame:
    """doc_id, key, period, first, end: the fragments of all tiles."""

    def cut(batches):
        for b in batches:
            cols: list[list] = [[] for _ in range(10)]
            for i, key, text in zip(b.column("doc_id").to_pylist(), b.column("key").to_pylist(), b.column("text").to_pylist()):
                own = words(i, text)
                places = tiles(len(own), tile)
                if not places:
                    continue
                codes = codes_of(own)
                if len(places) == 1:
                    rows = [(i, key, p, s, e, None, None, None, None, None) for p, s, e in fragments(codes, 0, places[0][1])]
                else:
                    kind = np.uint16 if codes.max() < 65536 else np.uint32
                    rows = [(i, key, None, None, None, k0, k1, s, len(codes), codes[s:e].astype(kind).tobytes()) for k0, k1, s, e in places]
                for col, values in zip(cols, zip(*rows)):
                    col += values
            kinds = [pa.int64()] * 5 + [pa.int32()] * 2 + [pa.int64()] * 2 + [pa.binary()]
            names = ["doc_id", "key", "period", "first", "end", "k0", "k1", "at", "total", "codes"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    def solve(batches):
        for b in batches:
            rows = []
            for r in b.to_pylist():
                width = (min(r["total"], _end(r, tile)) - r["at"])
                codes = np.frombuffer(r["codes"], np.uint16 if len(r["codes"]) == 2 * width else np.uint32)
                rows += [(r["doc_id"], r["key"], *f) for f in fragments(codes, r["k0"], r["k1"], r["at"], r["total"])]
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "key", "period", "first", "end"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    both = written(rows.mapInArrow(cut, f"{FRAGMENT}, k0 int, k1 int, at long, total long, codes binary"))
    dealt = both.where("codes is not null").drop("period", "first", "end")
    dealt = dealt.repartition(partitions(docs.sparkSession), "doc_id", "key", "k0", "at")
    here = both.where("codes is null").select("doc_id", "key", "period", "first", "end")
    return here.union(dealt.mapInArrow(solve, FRAGMENT))


def _end(row: dict, tile: int) -> int:
    return next(e for k0, _, s, e in tiles(row["total"], tile) if (k0, s) == (row["k0"], row["at"]))


def runs(docs: DataFrame, words=split, tile: int = TILE) -> DataFrame:
    """doc_id, key (hash of the text), runs: array of (start, period, end) by start, then period; documents without a run are not there."""
    own = Window.partitionBy("doc_id", "key", "period").orderBy("first", "end")
    reach = F.max("end").over(own.rowsBetween(Window.unboundedPreceding, -1))
    rows = found(docs, words, tile).distinct().withColumn("fresh", F.coalesce((F.col("first") > reach - F.col("period")).cast("int"), F.lit(1)))
    rows = rows.withColumn("stretch", F.sum("fresh").over(own))
    rows = rows.groupBy("doc_id", "key", "period", "stretch").agg(F.min("first").alias("first"), F.max("end").alias("end"))
    rows = rows.where(F.col("end") - F.col("first") >= F.greatest(F.lit(LEAST), TIMES * F.col("period")))
    each = F.struct(F.col("first").alias("start"), "period", "end")
    return rows.groupBy("doc_id", "key").agg(F.array_sort(F.collect_list(each)).alias("runs"))


def collapsed(words: list[bytes], own: list[tuple[int, int, int]]) -> list[bytes]:
    """``words`` without those that a run (start, period, end) holds after its first period."""
    if not own:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for s, p, e in own:
        gone[s + p] += 1
        gone[e] -= 1
    return [w for w, g in zip(words, np.cumsum(gone[:-1]).tolist()) if not g]


def with_runs(docs: DataFrame, words=split, tile: int = TILE) -> DataFrame:
    """``docs`` (doc_id, text) with the array ``runs`` (null where there is none)."""
    own = written(runs(docs, words, tile)).select(F.col("doc_id").alias("id__"), F.col("key").alias("key__"), "runs")
    meet = F.col("doc_id").eqNullSafe(F.col("id__")) & (F.xxhash64("text") == F.col("key__"))
    return docs.select("doc_id", "text").join(bounded(own), meet, "left").select("doc_id", "text", "runs")


def collapse(docs: DataFrame, tile: int = TILE) -> DataFrame:
    """doc_id, text: every run reduced to its first period, kept words joined by one space (texts without a run as they are)."""

    def run(batches):
        for b in batches:
            texts = []
            for i, text, own in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("runs").to_pylist()):
                texts.append(text if not own else b" ".join(collapsed(split(i, text), [(r["start"], r["period"], r["end"]) for r in own])).decode())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return with_runs(docs, tile=tile).mapInArrow(run, "doc_id long, text string")


def strongest(own: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run (start, period, end) with the greatest exact length / period; ties go to the smallest start, then period."""
    best = None
    for s, p, e in own:  # by start, then period
        if best is None or (e - s) * best[1] > (best[2] - best[0]) * p:
            best = s, p, e
    return best


def planted(doc_id, text: str | None) -> list[bytes]:
    """The words of ``text``, a tail of which repeats in one document of ten, as its doc_id says."""
    words = split(doc_id, text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    tail = words[a:a + p]
    return words[:a] + (tail * (-(-(n - a) // p)))[:n - a]


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    docs = with_runs(spark.read.parquet(f"{sf_dir}/documents.parquet"), planted)

    def digest(batches):
        for b in batches:
            cols: list[list] = [[] for _ in range(7)]
            for i, text, own in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("runs").to_pylist()):
                own = [(r["start"], r["period"], r["end"]) for r in own or ()]
                top = strongest(own)
                lines = "".join(f"{s},{e - s},{p}\n" for s, p, e in own)
                kept = b" ".join(collapsed(planted(i, text), own))
                length = top and top[2] - top[0]
                for c, v in zip(cols, (len(own), top and top[0], length, top and top[1], top and 1000 * length // top[1],
                                       hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())):
                    c.append(v)
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds))], [
                "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])

    return docs.mapInArrow(digest, "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
                                   "runs_sha256 string, collapsed_sha256 string")
