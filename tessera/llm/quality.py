"""Quality rules from tokeniser fertility.

Two public vocabularies split every word of a document: a piece vocabulary with byte fallback and a
multilingual byte-level one.  A document is measured by characters per token under both, the share of
byte-fallback tokens, and the entropy (bits) of its own token distribution.  The rejection bands of a
language (``lang``; without one, the script most letters belong to) come from all of its documents that
pass the base rules: exact quantiles of each measure over its histogram, and the band is the median give
or take ``WIDTH`` robust deviations, never narrower than ``LEAST``.  A text of n words gets a band wider by
sqrt(1 + ``SHORT`` / n), as its measures scatter more.

A group of n documents counts for n / (n + ``PRIOR``) of its median; the rest comes from the script that most of
its documents are in, and that one's in the same way from all documents.  Its band is wider by sqrt(1 + ``PRIOR``
/ n) and by the way its median was moved, so it always holds the band around the group's own median: nothing is
rejected for lying off the middle of another language, and no count of documents switches the bands.

Base rules: ``base_failed`` if there are under 50 words, or more than half the words lie in 3-word windows
that the text holds twice or more.

Defined results.  A null, empty or blank text has no words, zeros, null measures, and fails the base rules.
Repeated rows are judged alike, each.  Extra columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import struct
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import bounded, grams, hashed, small_batches, written
from .tokens import CACHE_BYTES, Remembered, parted, process_wide, vocabulary

SYMBOLS = b"#*$%&|<>"
LETTERS = {"latin": (0x41, 0x24F), "greek": (0x370, 0x3FF), "cyrillic": (0x400, 0x52F), "hebrew": (0x590, 0x5FF),
           "arabic": (0x600, 0x6FF), "devanagari": (0x900, 0x97F), "thai": (0xE00, 0xE7F), "kana": (0x3040, 0x30FF),
           "han": (0x4E00, 0x9FFF), "hangul": (0xAC00, 0xD7AF)}
#: Robust deviations a measure may lie off its median: below, above (None: no limit there).
WIDTH = {"chars_per_piece": (6.0, 6.0), "chars_per_byte_token": (6.0, 6.0), "fallback_share": (None, 6.0), "entropy": (5.0, None)}
#: The least half-width of a band, in the measure's own unit.
LEAST = {"chars_per_piece": 0.1, "chars_per_byte_token": 0.1, "fallback_share": 0.1, "entropy": 0.75}
SHORT = 250
PRIOR = 50
#: Histogram steps for one unit of a measure.
GRID = 1000


class Fertility(Remembered):
    """word (bytes) -> number of tokens of the byte-level vocabulary (uint32), then ids of the piece vocabulary (uint16 each), as bytes."""

    def __init__(self, piece_file: str, byte_file: str, limit: int = CACHE_BYTES // 2):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        super().__init__(limit)
        self.piece = sentencepiece.SentencePieceProcessor(model_file=vocabulary(piece_file))
        with open(vocabulary(byte_file), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.byte = tiktoken.Encoding("byte", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.fallback = [self.piece.is_byte(i) for i in range(self.piece.get_piece_size())]

    def learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        texts = [w.decode() for w in words]
        return {w: struct.pack("<I", len(self.byte.encode_ordinary(t))) + array("H", ids).tobytes()
                for w, t, ids in zip(words, texts, self.piece.encode(texts, num_threads=1))}

    def split(self, words: list[bytes], which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of a text whose words are at the places ``which`` of ``words``: the piece vocabulary's ids, up to where they go before each word
        (and in all), and as far the number of tokens of the byte-level vocabulary."""
        own = list(self.of(words))
        flat = np.frombuffer(b"".join(own), "<u2")
        size = np.fromiter(map(len, own), np.int64, len(own)) >> 1
        first = np.cumsum(size) - size
        byte = flat[first] + (flat[first + 1].astype(np.int64) << 16)
        count = (size - 2)[which]
        upto = np.concatenate([[0], np.cumsum(count)])
        ids = flat[np.repeat((first + 2)[which] - upto[:-1], count) + np.arange(upto[-1])]
        return ids, upto, np.concatenate([[0], np.cumsum(byte[which])])


def counted(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids, ascending, and how often each comes."""
    order = np.sort(ids)
    first = np.flatnonzero(np.concatenate([[True], order[1:] != order[:-1]]))
    return order[first], np.diff(first, append=len(order))


def repeated_words(h: np.ndarray, n: int = 3) -> int:
    """Words in ``n``-word windows that occur twice or more, the first occurrence included."""
    g = grams(h, n)
    if not len(g):
        return 0
    order = np.sort(g)  # few windows repeat: the values alone are sorted, not the places
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    w = np.flatnonzero(np.isin(g, twice))
    hit = np.zeros(len(h) + 1, np.int64)
    hit[:-n] += np.bincount(w, minlength=len(h) + 1 - n)
    hit[n:] -= np.bincount(w, minlength=len(h) + 1 - n)
    return int((np.cumsum(hit[:-1]) > 0).sum())


SCRIPTS = np.zeros(max(b for _, b in LETTERS.values()) + 2, np.int8)
for _k, (_a, _b) in enumerate(LETTERS.values()):
    SCRIPTS[_a:_b + 1] = _k + 1


def script_of(text: str) -> str:
    try:  # one byte a character: no other script's letters
        return "latin" if text.encode("latin-1").translate(None, bytes(range(0x41))) else "other"
    except UnicodeEncodeError:
        points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    counts = np.bincount(SCRIPTS[np.minimum(points, len(SCRIPTS) - 1)], minlength=len(LETTERS) + 1)[1:]
    return list(LETTERS)[counts.argmax()] if counts.any() else "other"


def measured(docs: DataFrame, language: str | None = "lang", piece_file: str = "piece_bpe_32k.model",
             byte_file: str = "byte_bpe_multi_50k.tiktoken") -> DataFrame:
    """doc_id, key (hash of the text), group, script, the base counts, base_failed and the four measures of every row."""
    spark_lang = F.col(language) if language and language in docs.columns else F.lit(None).cast("string")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), spark_lang.alias("lang"), F.xxhash64("text").alias("key"))

    def run(batches):
        tokens = process_wide(("fertility", piece_file, byte_file), lambda: Fertility(piece_file, byte_file))
        is_byte = np.array(tokens.fallback)
        names = ["group", "script", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", *WIDTH]
        for b in batches:
            cols = {k: [] for k in names}
            langs = iter(b.column("lang").to_pylist())
            for texts, words, which, cuts in parted(b.column("text")):
                hashes = hashed(words)[which]
                ids, upto, byte_upto = tokens.split(words, which)
                for t, i, j in zip(texts, cuts, cuts[1:]):
                    raw = t.encode()
                    n = j - i
                    repeat = repeated_words(hashes[i:j])
                    lines = [x for x in raw.split(b"\n") if x.strip()]
                    failed = n < 50 or 100 * repeat > 50 * n
                    white = sum(map(raw.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
                    chars = len(t) - white
                    own = [None] * 4
                    if n:
                        kinds, count = counted(ids[upto[i]:upto[j]])
                        total = int(upto[j] - upto[i])
                        share = count / total
                        own = [chars / total, chars / max(1, int(byte_upto[j] - byte_upto[i])),
                               float(count[is_byte[kinds]].sum() / total), float(-(share * np.log2(share)).sum())]
                    script = script_of(t)
                    lang = next(langs)
                    for k, v in zip(names, (lang or script, script, n, chars, len(raw) - len(raw.translate(None, SYMBOLS)),
                                            len(lines) - len(set(lines)), repeat, failed, *own)):
                        cols[k].append(v)
            kinds = [pa.string()] * 2 + [pa.int64()] * 5 + [pa.bool_()] + [pa.float64()] * 4
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("key")] + [pa.array(cols[k], t) for k, t in zip(names, kinds)],
                                             ["doc_id", "key", *names])

    return rows.mapInArrow(run, "doc_id long, key long, group string, script string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                                "n_repeat_words long, base_failed boolean, " + ", ".join(f"{m} double" for m in WIDTH))


def bands(rows: DataFrame) -> DataFrame:
    """group, bands (middle, down, up of each measure) of every group that has documents passing the base rules."""
    good = rows.where("not base_failed").select("group", "script", F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.round(F.col(m) * GRID).cast("long").alias("step")) for m in WIDTH])).alias("e"))
    bins = written(good.groupBy("group", "script", "e.measure", "e.step").agg(F.count(F.lit(1)).alias("n")))

    def middles(name, keys):
        """The keys, measure, total, q50 and the robust deviation of each."""
        by = Window.partitionBy(*keys, "measure")
        ranked = bins.groupBy(*keys, "measure", "step").agg(F.sum("n").alias("n"))
        ranked = ranked.withColumn("upto", F.sum("n").over(by.orderBy("step"))).withColumn("total", F.sum("n").over(by))
        at = [F.min(F.when(F.col("upto") >= F.col("total") * q, F.col("step"))).alias(f"q{int(q * 100)}") for q in (0.25, 0.5, 0.75)]
        q = ranked.groupBy(*keys, "measure", "total").agg(*at)
        return q.select(*keys, "measure", (F.col("total") / (F.col("total") + F.lit(PRIOR))).alias(f"{name}_share"),
                        (F.col("q50") / F.lit(GRID)).alias(f"{name}_middle"), ((F.col("q75") - F.col("q25")) / F.lit(1.349 * GRID)).alias(f"{name}_robust"))

    def shrunk(own, rest_middle, rest_robust):
        share, middle, robust = (F.col(f"{own}_{x}") for x in ("share", "middle", "robust"))
        return share * middle + (1 - share) * rest_middle, share * robust + (1 - share) * F.greatest(robust, rest_robust)

    # the whole and the scripts are a few rows
    scripts = middles("script", ["script"]).join(F.broadcast(middles("whole", [])), "measure")
    middle, robust = shrunk("script", F.col("whole_middle"), F.col("whole_robust"))
    scripts = scripts.select("script", "measure", middle.alias("rest_middle"), robust.alias("rest_robust"))
    most = bins.groupBy("group", "script").agg(F.sum("n").alias("n")).groupBy("group").agg(F.max_by("script", F.struct("n", "script")).alias("script"))
    q = middles("own", ["group"]).join(most, "group").join(F.broadcast(scripts), ["script", "measure"])
    middle, robust = shrunk("own", F.col("rest_middle"), F.col("rest_robust"))
    table = F.create_map(*[x for m in WIDTH for x in (F.lit(m), F.struct(
        F.lit(WIDTH[m][0]).cast("double").alias("down"), F.lit(WIDTH[m][1]).cast("double").alias("up"), F.lit(LEAST[m]).alias("least")))])
    w = F.element_at(table, F.col("measure"))
    half = lambda side: F.when(w[side].isNotNull(), F.greatest(w[side] * robust, w["least"]) / F.sqrt("own_share")
                               + F.abs(middle - F.col("own_middle"))).alias(side)
    q = q.select("group", "measure", F.struct(middle.alias("middle"), half("down"), half("up")).alias("band"))
    return written(q.groupBy("group").agg(F.struct(*[F.max(F.when(F.col("measure") == m, F.col("band"))).alias(m) for m in WIDTH]).alias("bands")))


def judged(rows: DataFrame) -> DataFrame:
    """``measured`` rows with ``kept``: base rules passed and every measure inside its group's band."""
    own = bands(rows).select(F.col("group").alias("g"), "bands")
    j = rows.join(own, F.col("group") == F.col("g"), "left")
    wider = F.sqrt(1 + F.lit(SHORT) / F.greatest(F.col("n_words"), F.lit(1)))
    verdict = ~F.col("base_failed")
    for m in WIDTH:
        b = F.col("bands")[m]
        low, high = F.col(m) < b["middle"] - b["down"] * wider, F.col(m) > b["middle"] + b["up"] * wider
        verdict = verdict & ~F.coalesce(low, F.lit(False)) & ~F.coalesce(high, F.lit(False))
    return j.withColumn("kept", verdict).select(*[c for c in rows.columns if c != "script"], "kept")


def keep_quality(docs: DataFrame, language: str | None = "lang") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    with small_batches(docs.sparkSession):
        rows = written(measured(docs, language))
    gone = judged(rows).where("not kept").select(
        F.struct(F.col("doc_id").alias("id"), "key").alias("gone__")).distinct()
    meet = F.col("doc_id").eqNullSafe(F.col("gone__.id")) & (F.xxhash64("text") == F.col("gone__.key"))
    return docs.join(bounded(written(gone)), meet, "left_anti")


def op9_quality(spark, sf_dir: str) -> DataFrame:
    with small_batches(spark):
        rows = written(measured(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return judged(rows).drop("key")
