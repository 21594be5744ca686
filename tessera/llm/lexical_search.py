"""Ranked lexical search by the best position algorithm over impact lists.

Documents are dealt into shards of a bounded number of postings.  A shard holds, for each term asked for, an impact
list: its documents by falling impact (ties by place).  An item's search reads its terms' lists side by side.  Each
document that a list shows for the first time is looked up directly in all the others, which gives its whole score and
its position in every list.  A list's best position is the end of the stretch, from its top, of positions seen by
either kind of access; what follows it bounds what an unseen document can get from this list.  Reading goes on
behind the best positions, over those not seen yet, in steps of doubling size, and ends when the bounds' sum lies strictly
below the ``k``-th score (an equal score could still win by its doc_id).  The shards' best are merged by rank.

Terms are the maximal runs of ASCII letters and digits and of all characters outside ASCII, A-Z lower-cased.  Scores are
64-bit integers; counts (documents, terms, document frequencies) come from all documents.

Items are worked on in blocks of ``BLOCK_BYTES`` of text at most (one longer text is a block of its own), each with a pass
over the documents: what goes to the tasks is bounded, whatever the number of items.

Defined results.  A null, empty or termless text matches nothing and does not count.  Every row of the documents is a
document: repeated rows are ranked each, and a row without doc_id comes last among equal scores.  Rows of the
same item_id are one item with all their terms; rows without item_id ask nothing.  Extra columns are not looked at; an empty
table gives an empty result.
"""

from __future__ import annotations

import functools
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import sorted_groups, written

RANKS = 50
BLOCK_BYTES = 8 << 20
SHARD_POSTINGS = 1_000_000
STEP = 64

_KEPT = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))
RESULT = "item_id long, doc_id long, score long"


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_KEPT).split()


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, weight: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Scores of postings: a term ``tf`` times in a document of ``n`` terms."""
    m = 50 + (50 * n * n_docs) // n_terms
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


class ImpactLists:
    """A shard's impact lists, and per document its places in them."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray):
        """Postings of documents 0, 1, ... and terms 0, 1, ..., those of a document together, documents in rising order."""
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.start = np.concatenate([[0], np.cumsum(np.bincount(term))])
        self.of_doc = np.concatenate([[0], np.cumsum(np.bincount(doc))])
        self.place = np.empty(len(order), np.int64)  # of a document's postings in the lists
        self.place[order] = np.arange(len(order))
        self.seen = np.zeros(len(order), bool)
        self.met = np.zeros(len(self.of_doc), bool)
        self.asked = np.zeros(len(order), bool)

    def best(self, terms: list[int], k: int, step: int = STEP) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores, positions read) that hold the ``k`` best of the lists of ``terms``, equal scores included."""
        spans = [(int(self.start[t]), int(self.start[t + 1])) for t in terms if t < len(self.start) - 1]
        spans = [(a, b) for a, b in spans if a < b]
        for a, b in spans:
            self.asked[a:b] = True
        at = [a for a, _ in spans]  # first position not seen of each list
        docs, scores, read = [], [], 0
        kth, count = 0, 0
        while True:
            bound = sum(int(self.impact[p]) for p, (_, b) in zip(at, spans) if p < b)
            if bound == 0 or (count >= k and bound < kth):
                break
            new = []
            for p, (_, b) in zip(at, spans):
                rows = p + np.flatnonzero(~self.seen[p:min(b, p + step)])
                read += len(rows)
                new.append(self.doc[rows])
            new = np.unique(np.concatenate(new))
            new = new[~self.met[new]]
            self.met[new] = True
            docs.append(new)
            scores.append(self._look_up(new))
            count += len(new)
            if count >= k:
                own = np.concatenate(scores)
                kth = int(np.partition(own, count - k)[count - k])
            for i, (_, b) in enumerate(spans):
                at[i] = self._behind(at[i], b)
            step *= 2
        docs = np.concatenate(docs) if docs else np.empty(0, np.int64)
        own = np.concatenate(scores) if scores else np.empty(0, np.int64)
        for a, b in spans:
            self.asked[a:b] = self.seen[a:b] = False
        self.met[docs] = False
        good = own >= max(kth, 1)
        return docs[good], own[good], read

    def _look_up(self, docs: np.ndarray) -> np.ndarray:
        """Direct access: the documents' scores over the asked lists; their positions become seen."""
        first, count = self.of_doc[docs], self.of_doc[docs + 1] - self.of_doc[docs]
        owner = np.repeat(np.arange(len(docs)), count)
        rows = self.place[np.arange(len(owner)) + np.repeat(first - (np.cumsum(count) - count), count)]
        mine = self.asked[rows]
        rows = rows[mine]
        self.seen[rows] = True
        score = np.zeros(len(docs), np.int64)
        np.add.at(score, owner[mine], self.impact[rows])
        return score

    def _behind(self, p: int, end: int) -> int:
        """The first position from ``p`` on that is not seen."""
        width = 256
        while p < end:
            open_ = self.seen[p:min(end, p + width)]
            i = int(open_.argmin())
            if not open_[i]:
                return p + i
            p, width = p + len(open_), width * 4
        return end


def _items(benchmark: DataFrame) -> DataFrame:
    """item_id, terms (distinct, each item once), by Spark: an item's rows may lie anywhere."""

    def run(batches):
        for b in batches:
            ids, terms = [], []
            for i, text in zip(b.column("item_id").to_pylist(), b.column("text").to_pylist()):
                own = set(terms_of(text))
                ids += [i] * len(own)
                terms += own
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(terms, pa.binary())], ["item_id", "term"])

    rows = benchmark.where("item_id is not null").select("item_id", "text").mapInArrow(run, "item_id long, term binary").distinct()
    return rows.groupBy("item_id").agg(F.array_sort(F.collect_list("term")).alias("terms"))


def _blocks(items: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """The items with a column ``block``, and the number of blocks; a block holds about ``block_bytes`` of terms."""
    size = F.aggregate("terms", F.lit(0).cast("long"), lambda a, t: a + F.octet_length(t) + 8)
    items = written(items.withColumn("size", size))
    total = items.agg(F.sum("size")).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    return items.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(n)).cast("int")), n


def search(documents: DataFrame, benchmark: DataFrame, ranks: int = RANKS, shard_postings: int = SHARD_POSTINGS,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``ranks`` best documents of every item."""
    items, blocks = _blocks(_items(benchmark), block_bytes)
    parts = [_search_block(documents, items.where(F.col("block") == k), ranks, shard_postings) for k in range(blocks)]
    hits = functools.reduce(DataFrame.unionByName, parts)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranks).select("item_id", "rank", "doc_id", "score")


def _search_block(documents: DataFrame, items: DataFrame, ranks: int, shard_postings: int) -> DataFrame:
    spark = documents.sparkSession
    asked = items.select("item_id", "terms").collect()  # a block's terms, bounded by its bytes
    vocabulary: dict[bytes, int] = {}
    queries = [(r["item_id"], [vocabulary.setdefault(bytes(t), len(vocabulary)) for t in r["terms"]]) for r in asked]
    shared = spark.sparkContext.broadcast((vocabulary, queries))

    def count(batches):
        number = shared.value[0]
        deal = TaskContext.get().partitionId() << 32  # spreads the rows over the shards; which one a row goes to changes no result
        for b in batches:
            cols: list[list] = [[], [], [], [], []]
            for i, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                words = terms_of(text)
                if words:
                    tf = Counter(words)
                    own = tf.keys() & number.keys()
                    for c, v in zip(cols, (i, deal, len(words), [number[w] for w in own], [tf[w] for w in own])):
                        c.append(v)
                    deal += 1
            kinds = [pa.int64()] * 3 + [pa.list_(pa.int32())] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc_id", "deal", "n", "terms", "tf"])

    rows = documents.select("doc_id", "text").mapInArrow(count, "doc_id long, deal long, n long, terms array<int>, tf array<int>")
    rows = written(rows)
    n_docs, n_terms, postings = rows.agg(F.count(F.lit(1)), F.sum("n"), F.sum(F.size("terms").cast("long"))).first()
    if not postings:
        return spark.createDataFrame([], RESULT)
    weight = np.zeros(len(vocabulary), np.int64)
    for r in rows.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():  # a row a term of the block
        weight[r["term"]] = term_weight(n_docs, r["count"])
    weights = spark.sparkContext.broadcast(weight)
    shards = -(-postings // shard_postings)

    def find(batches):
        for t in sorted_groups(batches, ["shard"]):
            t = t.combine_chunks()
            ids, n = t.column("doc_id").chunk(0), t.column("n").to_numpy()
            terms = t.column("terms").chunk(0)
            doc = np.repeat(np.arange(len(n)), np.diff(terms.offsets.to_numpy()))
            term = terms.flatten().to_numpy().astype(np.int64)
            tf = t.column("tf").chunk(0).flatten().to_numpy().astype(np.int64)
            lists = ImpactLists(doc, term, impacts(tf, n[doc], weights.value[term], n_docs, n_terms))
            by_id = np.array([2 ** 63 - 1 if i is None else i for i in ids.to_pylist()], np.int64)
            for item, own in shared.value[1]:
                found, score, _ = lists.best(own, ranks)
                first = np.lexsort((by_id[found], -score))[:ranks]
                if len(first):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(first), item, np.int64)), ids.take(pa.array(found[first])),
                                                      pa.array(score[first])], ["item_id", "doc_id", "score"])

    dealt = rows.where(F.size("terms") > 0).withColumn("shard", F.pmod(F.xxhash64("deal"), F.lit(shards)).cast("int")).drop("deal")
    dealt = dealt.repartition(min(shards, 1 << 16), "shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(find, RESULT)


def op13_lexical_search(spark, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


# the same scores by joins: every document is scored, none is skipped
SQL = """
WITH t AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents WHERE text IS NOT NULL),
d AS (SELECT doc_id, r, w, CAST(len(w) AS BIGINT) AS n FROM t WHERE len(w) > 0),
s AS (SELECT CAST(count(*) AS BIGINT) AS nd, CAST(sum(n) AS BIGINT) AS nt FROM d),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark WHERE item_id IS NOT NULL),
e AS (SELECT doc_id, r, n, unnest(w) AS term FROM d),
p AS (SELECT doc_id, r, n, term, CAST(count(*) AS BIGINT) AS tf FROM e WHERE term IN (SELECT term FROM q) GROUP BY ALL),
f AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(nd) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS wt
      FROM p, s GROUP BY term),
i AS (SELECT doc_id, r, term, wt * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nd) // nt))) AS imp FROM p JOIN f USING (term), s),
x AS (SELECT item_id, doc_id, r, CAST(sum(imp) AS BIGINT) AS score FROM i JOIN q USING (term) GROUP BY ALL HAVING sum(imp) > 0),
y AS (SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM x)
SELECT item_id, rank, doc_id, score FROM y WHERE rank <= 50
"""
