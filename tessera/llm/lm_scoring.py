"""Language-model scores from the subword lattice of an existing unigram vocabulary.

A word's probability sums over all its segmentations into pieces of a public vocabulary (byte pieces for
characters it lacks), by the forward recursion in log space.  The pieces' weights are learned from the
training documents' distinct words, for each document class (language) on its own, shrunk to all classes.
A word that training has seen is one more arc of its lattice: absolute discounting takes ``DISCOUNT`` from
its count in the class; what a class's words give up weighs the lattice of pieces, but for a share ``BACK`` that goes to
the counts of all classes (discounted the same way).  So P(word) is a proper distribution over all strings, and a text's probability is the
sum over the classes of that of the class, its words and one end.

Counting: every distinct word is counted and joined by word.  Words of at least 1 / 2**18 of all tokens (so
at most 2**18 of them) are scored where the documents are read; the rest is joined by word, so no key of
the join holds more than that share of the tokens.

Defined results.  A null, empty or blank text is one end.  A null doc_id counts as the empty text in the
split.  Repeated rows are scored (and learned) each.  A class not among the ``CLASSES`` most frequent, or
null, is "other".  Scores are sums of multiples of 2**-34, which any order of the rows gives alike.  Without training documents pieces weigh alike.  Extra columns are not looked at; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import written
from .tokens import process_wide, vocabulary

CLASSES = 31
DISCOUNT = 0.7
BACK = 0.1
HOT = 1 << 18
PIECE_PRIOR = 0.05
CLASS_PRIOR = 2000.0
FLUSH = 300_000
END = b" "  # no word holds a space
LN10 = float(np.log(10))


def piece_table(path: str):
    """Pieces of the vocabulary as strings (None for control and unknown), and the ids of its byte pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    plain = [None if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) else sp.id_to_piece(i) for i in range(n)]
    return sp, plain, [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]


class Lattice:
    """Forward recursion over all segmentations, for many words and all classes at once.

    The vocabulary's prefixes are hashed character by character, so a search from a position ends where no
    piece goes on.  A prefix lies in the first of the tables where its slot was free.
    """

    BASE = np.uint64(0x9E3779B97F4A7C15)
    TURN = 0xBF58476D1CE4E5B9
    BITS = 19
    CHARACTERS = 400_000

    def __init__(self, path: str):
        self.sp, plain, self.bytes = piece_table(path)
        self.size = len(plain)
        own = np.array([i for i, p in enumerate(plain) if p])
        texts = [plain[i] for i in own]
        longest = max(map(len, texts))
        codes = np.zeros((len(texts), longest), np.uint64)
        for row, t in zip(codes, texts):
            row[:len(t)] = [ord(c) + 1 for c in t]
        sizes = np.array([len(t) for t in texts])
        h, whole, prefixes = np.zeros(len(texts), np.uint64), np.zeros(len(texts), np.uint64), []
        for k in range(longest):
            h = h * self.BASE + codes[:, k]
            prefixes.append(h[sizes > k])
            whole[sizes == k + 1] = h[sizes == k + 1]
        self.key = np.unique(np.concatenate(prefixes))
        self.piece = np.full(len(self.key), -1)
        self.piece[np.searchsorted(self.key, whole)] = own
        self.tables, left = [], np.arange(len(self.key))
        while len(left):
            turn = np.uint64((self.TURN * (2 * len(self.tables) + 1)) % (1 << 64))
            at = (self.key[left] * turn) >> np.uint64(64 - self.BITS)
            table = np.full(1 << self.BITS, -1, np.int32)
            table[at[::-1]] = left[::-1]
            self.tables.append((turn, table))
            left = left[table[at] != left]

    def _find(self, h: np.ndarray) -> np.ndarray:
        """The prefix of each hash, or -1."""
        out, open_ = np.full(len(h), -1, np.int64), np.arange(len(h))
        for turn, table in self.tables:
            found = table[(h[open_] * turn) >> np.uint64(64 - self.BITS)]
            same = (found >= 0) & (self.key[found] == h[open_])
            out[open_[same]] = found[same]
            open_ = open_[(found >= 0) & ~same]  # a free slot: in no table
            if not len(open_):
                break
        return out

    def marginals(self, words: list[str], logp: np.ndarray) -> np.ndarray:
        """word x class: natural log of each word's marginal probability, from ``logp`` (class x piece)."""
        out = np.empty((len(words), len(logp)))
        sizes = np.array([len(w) + 1 for w in words], np.int64)
        part = np.cumsum(sizes) // self.CHARACTERS
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(words)]
        for i, j in zip(cuts, cuts[1:]):
            if i < j:
                out[i:j] = self._forward(words[i:j], sizes[i:j], logp)
        return out

    def _forward(self, words: list[str], sizes: np.ndarray, logp: np.ndarray) -> np.ndarray:
        codes = np.frombuffer("".join(["▁" + w for w in words]).encode("utf-32-le", "surrogatepass"), "<u4")
        word = np.repeat(np.arange(len(words)), sizes)
        first = np.cumsum(sizes) - sizes
        place = np.arange(len(codes)) - first[word]  # in the word
        rest = sizes[word] - place
        wide = codes.astype(np.uint64) + np.uint64(1)
        at, h, starts, lengths, pieces = np.arange(len(codes)), np.zeros(len(codes), np.uint64), [], [], []
        size = 0
        while len(at):
            h = h * self.BASE + wide[at + size]
            size += 1
            node = self._find(h)
            piece = np.where(node >= 0, self.piece[node], -1)
            if size == 1:  # characters that are no piece: their bytes, as one arc
                lone = np.flatnonzero(piece < 0)
                kinds, which = np.unique(codes[lone], return_inverse=True)
                spelled = [[self.bytes[b] for b in chr(c).encode("utf-8", "surrogatepass")] for c in kinds.tolist()]
                extra = [logp[:, ids].sum(axis=1)[:, None] for ids in spelled]
                logp = np.concatenate([logp, *extra], axis=1)
                piece[lone] = self.size + which
            hit = piece >= 0
            starts.append(at[hit])
            lengths.append(np.full(int(hit.sum()), size))
            pieces.append(piece[hit])
            on = (node >= 0) & (rest[at] > size)
            at, h = at[on], h[on]
        start, length, piece = map(np.concatenate, (starts, lengths, pieces))
        end = place[start] + length
        target = start + length + word[start]  # a word of n characters has n + 1 nodes
        order = np.lexsort((target, end))
        start, piece, end, target = start[order], piece[order], end[order], target[order]
        alpha = np.empty((len(logp), len(codes) + len(words)))
        alpha[:, first + np.arange(len(words))] = 0.0
        source = start + word[start]
        cuts = np.searchsorted(end, np.arange(1, int(sizes.max()) + 2)).tolist()
        new = np.concatenate([[True], target[1:] != target[:-1]])
        for i, j in zip(cuts, cuts[1:]):
            heads = np.flatnonzero(new[i:j])
            terms = alpha[:, source[i:j]] + logp[:, piece[i:j]]
            alpha[:, target[i:j][heads]] = np.logaddexp.reduceat(terms, heads, axis=1)
        return alpha[:, first + sizes + np.arange(len(words))].T


def lattice_of(piece_file: str) -> Lattice:
    return process_wide(("lattice", piece_file), lambda: Lattice(vocabulary(piece_file)))


def _prepared(docs: DataFrame, names: list[str]) -> DataFrame:
    """doc_id, text, key, held (the split), z (class number) of every row."""
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(5)) == 1
    z = F.lit(len(names))
    for k, name in enumerate(names):
        z = F.when(F.col("lang") == name, k).otherwise(z)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       F.xxhash64("text").alias("key"), held.alias("held"), z.cast("int").alias("z"))


def word_counts(rows: DataFrame, classes: int) -> DataFrame:
    """word, c (array: training count in each class) of every distinct word, and of the end."""

    def run(batches):
        seen = [Counter() for _ in range(classes)]
        only: set[bytes] = set()

        def emit():
            for z, c in enumerate(seen):
                if c:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()), pa.array(np.full(len(c), z, np.int32)),
                                                      pa.array(list(c.values()), pa.int64())], ["word", "z", "n"])
                    c.clear()
            if only:
                yield pa.RecordBatch.from_arrays([pa.array(list(only), pa.binary()), pa.array(np.zeros(len(only), np.int32)),
                                                  pa.array(np.zeros(len(only), np.int64))], ["word", "z", "n"])
                only.clear()

        for b in batches:
            for t, held, z in zip(b.column("text").to_pylist(), b.column("held").to_pylist(), b.column("z").to_pylist()):
                words = t.encode().lower().split()
                if held:
                    only.update(words)
                else:
                    seen[z].update(words)
                    seen[z][END] += 1
                if sum(map(len, seen)) + len(only) > FLUSH:
                    yield from emit()
        yield from emit()

    each = rows.select("text", "held", "z").mapInArrow(run, "word binary, z int, n long")
    per = [F.sum(F.when(F.col("z") == k, F.col("n")).otherwise(0)).alias(f"c{k}") for k in range(classes)]
    return written(each.groupBy("word").agg(*per)).select("word", F.array(*[f"c{k}" for k in range(classes)]).alias("c"))


def piece_weights(counts: DataFrame, classes: int, path_name: str) -> np.ndarray:
    """Natural-log weights, class x piece, from how the vocabulary splits each class's distinct words."""

    def run(batches):
        sp, _, _ = piece_table(vocabulary(path_name))
        total = np.zeros((classes, sp.get_piece_size()), np.int64)
        for b in batches:
            words = [w.decode() for w in b.column("word").to_pylist()]
            split = sp.encode(words, num_threads=1)
            ids = np.fromiter((i for s in split for i in s), np.int64)
            own = np.repeat(np.arange(len(words)), [len(s) for s in split])
            c = np.array(b.column("c").to_pylist()).reshape(-1, classes)
            for z in range(classes):
                total[z] += np.bincount(ids[c[own, z] > 0], minlength=total.shape[1])
        z, p = np.nonzero(total)
        if len(z):
            yield pa.RecordBatch.from_arrays([pa.array(z.astype(np.int32)), pa.array(p.astype(np.int32)), pa.array(total[z, p])], ["z", "piece", "n"])

    found = counts.where(F.col("word") != F.lit(bytearray(END))).mapInArrow(run, "z int, piece int, n long")
    found = found.groupBy("z", "piece").agg(F.sum("n").alias("n")).collect()  # at most classes x vocabulary
    sp, plain, byte_ids = piece_table(vocabulary(path_name))
    usable = np.array([p is not None for p in plain])
    usable[byte_ids] = True
    n = np.zeros((classes, len(plain)))
    for r in found:
        n[r["z"], r["piece"]] = r["n"]
    n[:, ~usable] = 0
    shared = np.where(usable, n.sum(axis=0) + PIECE_PRIOR, 0.0)
    shared /= shared.sum()
    weights = n + CLASS_PRIOR * shared
    weights /= weights.sum(axis=1, keepdims=True)
    with np.errstate(divide="ignore"):
        return np.log(weights)


def log_word(c, tokens, distinct, kinds, marginal):
    """Natural log P(word | class), word x class, from its counts in the classes, the classes' tokens and distinct words, the distinct
    words of all classes, and the lattice."""
    def backed(count, of, words, rest):
        with np.errstate(divide="ignore"):
            seen = np.log(np.maximum(count - DISCOUNT, 0.0) / (of + 1))
        return np.logaddexp(seen, np.log((DISCOUNT * words + 0.5) / (of + 1)) + rest)

    others = backed(c.sum(axis=1, keepdims=True), tokens.sum(), kinds, marginal)
    return fine(backed(c, tokens, distinct, np.logaddexp(np.log(BACK) + others, np.log(1 - BACK) + marginal)))


def fine(x):
    """``x`` in multiples of 2**-34: sums of them are exact, whatever their order."""
    return np.round(x * 2.0 ** 34) / 2.0 ** 34


def scores(docs: DataFrame, piece_file: str = "piece_bpe_32k.model") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs``.

    ``docs`` has doc_id, text and lang.
    """
    spark = docs.sparkSession
    if "lang" not in docs.columns:
        docs = docs.withColumn("lang", F.lit(None).cast("string"))
    often = docs.select("lang", split_held(docs).alias("held")).where("not held and lang is not null").groupBy("lang").count()
    names = [r["lang"] for r in often.orderBy(F.desc("count"), "lang").limit(CLASSES).collect()]
    k = len(names) + 1
    rows = _prepared(docs, names)
    counts = word_counts(rows, k)
    end = F.lit(bytearray(END))
    sums = counts.select(*[F.sum(F.col("c")[z]).alias(f"n{z}") for z in range(k)],
                         *[F.sum(F.when((F.col("c")[z] > 0) & (F.col("word") != end), 1).otherwise(0)).alias(f"v{z}") for z in range(k)],
                         *[F.sum(F.when(F.col("word") == end, F.col("c")[z]).otherwise(0)).alias(f"d{z}") for z in range(k)],
                         F.sum(F.when(F.exists("c", lambda x: x > 0), 1).otherwise(0)).alias("v")).first()
    tokens, distinct, ends = (np.array([sums[f"{x}{z}"] or 0 for z in range(k)], float) for x in "nvd")
    total, kinds = int(tokens.sum()), int(sums["v"] or 0)
    below = total + 0.5 * (kinds + 1)
    logp = piece_weights(counts, k, piece_file)
    whole = F.aggregate("c", F.lit(0).cast("long"), lambda a, x: a + x)
    hot = counts.where((F.col("word") != end) & (whole > 0) & (whole * HOT >= total)).collect()  # at most HOT words
    c = np.array([r["c"] for r in hot], float).reshape(-1, k)
    marginal = lattice_of(piece_file).marginals([bytes(r["word"]).decode() for r in hot], logp)
    hot_score = log_word(c, tokens, distinct, max(0, kinds - 1), marginal)
    hot_base = fine(np.log10((c.sum(axis=1) + 0.5) / below))
    prior = fine(np.log((ends + 0.5) / (ends.sum() + 0.5 * k)) + np.log((ends + 0.5) / (tokens + 1)))
    end_base = float(fine(np.log10((ends.sum() + 0.5) / below)))
    shared = spark.sparkContext.broadcast(({bytes(r["word"]): i for i, r in enumerate(hot)}, hot_score, hot_base, logp))
    kind = "doc_id long, key long, held boolean, word binary, n long, rows long, tokens long, known long, base double, score array<double>"

    def read(batches):
        """A row for each document, with what its frequent words give, and one for each of its rare words."""
        place, score, base, _ = shared.value
        names = [x.split()[0] for x in kind.split(", ")]
        for b in batches:
            words, times, sizes, heads, by = [], [], [], [], []
            for i, key, t in zip(*(b.column(x).to_pylist() for x in ("doc_id", "key", "text"))):
                count = Counter(t.encode().lower().split())
                near = [(place[w], n) for w, n in count.items() if w in place]
                at, n = np.array(near, np.int64).reshape(-1, 2).T
                heads.append((sum(count.values()) + 1, int(n.sum()) + (ends.sum() > 0), float(base[at] @ n) + end_base))
                by.append(prior + n @ score[at])
                rare = [w for w in count if w not in place]
                words += [b" %d %d" % (i or 0, key), *rare]  # a word of its own, that joins nothing
                times += [0, *[count[w] for w in rare]]
                sizes.append(len(rare) + 1)
            if not sizes:
                continue
            own = np.repeat(np.arange(len(sizes)), sizes)
            lead = np.concatenate([[True], own[1:] != own[:-1]])
            tokens_of, known, base_of = (np.array(x) for x in zip(*heads))
            ids = pa.array(own)
            by_class = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.where(lead, k, 0))]), pa.int32()), np.concatenate(by))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(x).take(ids) for x in ("doc_id", "key", "held")), pa.array(words, pa.binary()),
                 pa.array(np.array(times, np.int64)), *(pa.array(np.where(lead, x, 0).astype(np.int64)) for x in (1, tokens_of[own], known[own])),
                 pa.array(np.where(lead, base_of[own], 0.0)), by_class], names)

    def weigh(batches):
        """Each rare word once: whether training knows it, its base score and its score in every class."""
        weights = shared.value[3]
        own = lattice_of(piece_file)
        for b in batches:
            c = b.column("c").flatten().to_numpy().reshape(-1, k).astype(float)
            s = log_word(c, tokens, distinct, max(0, kinds - 1), own.marginals([w.decode() for w in b.column("word").to_pylist()], weights))
            seen = c.sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column("word"), pa.array((seen > 0).astype(np.int32)), pa.array(fine(np.log10((seen + 0.5) / below))),
                 pa.ListArray.from_arrays(np.arange(0, s.size + 1, k, dtype=np.int32), s.ravel())], ["word2", "seen", "base2", "score2"])

    rare = counts.where((F.col("word") != end) & ((whole == 0) | (whole * HOT < total)))
    rare = rare.mapInArrow(weigh, "word2 binary, seen int, base2 double, score2 array<double>")
    joined = rows.mapInArrow(read, kind).join(rare, F.col("word") == F.col("word2"), "left")
    n = F.col("n")
    parts = joined.select("doc_id", "key", "held", "rows", "tokens", (F.col("known") + F.when(F.col("seen") > 0, n).otherwise(0)).alias("known"),
                          (F.col("base") + F.coalesce(n * F.col("base2"), F.lit(0.0))).alias("base"),
                          *[(F.coalesce(F.get("score", F.lit(z)), F.lit(0.0)) + F.coalesce(n * F.get("score2", F.lit(z)), F.lit(0.0))).alias(f"s{z}") for z in range(k)])
    out = parts.groupBy("doc_id", "key", "held").agg(*[F.sum(x).alias(x) for x in ("rows", "tokens", "known", "base", *(f"s{z}" for z in range(k)))])
    out = out.withColumn("by", F.array(*[F.col(f"s{z}") / F.col("rows") for z in range(k)])).withColumn("top", F.array_max("by"))
    out = out.withColumn("score", F.col("top") + F.log(F.aggregate(F.transform("by", lambda s: F.exp(s - F.col("top"))), F.lit(0.0), lambda a, x: a + x)))
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    return out.select("doc_id", F.col("held").alias("held_out"), (F.col("tokens") / F.col("rows")).cast("long").alias("n_tokens"),
                      (F.col("known") / F.col("rows")).cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
                      (F.col("base") / F.col("rows")).alias("base_score"), (F.col("score") / F.lit(LN10)).alias("score"))


def split_held(docs: DataFrame):
    return F.pmod(F.crc32(F.coalesce(docs["doc_id"].cast("string"), F.lit(""))), F.lit(5)) == 1


def op1_lm_scoring(spark, sf_dir: str) -> DataFrame:
    return scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
