"""Language identification of pages by Bayesian evidence fusion.

Evidence for each language: the likelihood of the page's text (hashed byte trigrams, tempered, learned from
labelled documents), the declared markup language (how often a declaration goes with a language), the
address suffix (the first path part, where it looks like a language code), and a prior of the host.  The
prior is smoothed hierarchically: the host's share of each language leans on its domain's, that on its top
domain's, that on all pages'.  All counts are grouped sums of soft text posteriors over all pages; each page's
own share is taken out of the counts it is judged by, so a page never votes for itself.

The likelihoods are fitted on at most ``SAMPLE`` labelled documents (those of the lowest hash).

Defined results.  A null or empty page is judged by its other evidence; with none of it, by the prior.  A null
url has a host of its own.  Repeated rows are judged alike, each.  Without labelled documents the language
is null.  Ties go to the language that comes first by code point.  Extra columns are not looked at; an empty
table gives an empty result.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bounded, written
from .html_text import host_of

SAMPLE = 20_000
BUCKETS = 1 << 15
#: Trigrams of a text are far from independent; their joint evidence counts as this many of them at most.
TRIGRAMS = 60.0
SMOOTH = {"top": 20.0, "domain": 10.0, "host": 5.0}
DROPPED = re.compile(rb"<(script|style|title|nav|header|footer|aside|form)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)|<[^>]*(?:>|\Z)", re.S | re.I)
DECLARED = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([a-zA-Z]{2,3})", re.I)


def trigrams(text: str) -> np.ndarray:
    """Counts of the hashed trigrams of the lower-cased text's bytes."""
    b = np.frombuffer(f" {text.lower()} ".encode(), np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(BUCKETS, np.int64)
    h = (b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA6B)) ^ (b[2:] * np.uint32(0xC2B2AE35))
    return np.bincount((h ^ (h >> np.uint32(15))) % np.uint32(BUCKETS), minlength=BUCKETS)


def plain(page: str) -> str:
    return html.unescape(DROPPED.sub(b" ", page.encode()).decode())


def fit(documents: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages in order and their log trigram distributions, from ``documents`` (doc_id, text, lang)."""
    chosen = documents.where("lang is not null and text is not null").select("doc_id", F.col("lang").alias("label"))
    chosen = written(chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).distinct())

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for b in batches:
            for t, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist()):
                total[lang] = total.get(lang, 0) + trigrams(t)
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])],
                                             ["lang", "bucket", "n"])

    rows = documents.where("text is not null and lang is not null").select("doc_id", "text", "lang").join(
        bounded(chosen.select("doc_id")), "doc_id").select("text", "lang")
    found = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect()
    names = sorted({r["lang"] for r in found})
    n = np.full((len(names), BUCKETS), 0.5)
    for r in found:  # languages x buckets at most
        n[names.index(r["lang"]), r["bucket"]] += r["n"]
    return names, np.log(n / n.sum(axis=1, keepdims=True))


def _text_evidence(pages: DataFrame, model: np.ndarray) -> DataFrame:
    """page_id, url, declared, loglik (array, by language) of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value.T
        for b in batches:
            declared, ll = [], []
            for h in b.column("html").to_pylist():
                found = DECLARED.search(h or "")
                declared.append(found[1].lower() if found else None)
                n = trigrams(plain(h or ""))
                total = n.sum()
                ll.append((n @ m) * min(1.0, TRIGRAMS / max(1, total)))
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(declared, pa.string()),
                                              pa.array(ll, pa.list_(pa.float64()))], ["page_id", "url", "declared", "loglik"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, declared string, loglik array<double>")


def _softmax(x):
    top = F.array_max(x)
    e = F.transform(x, lambda v: F.exp(v - top))
    return F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda a, y: a + y))


def identify(pages: DataFrame, documents: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """page_id, url, declared, lang, confidence, posterior (by language, in code point order) of every page."""
    names, model = fit(documents, sample)
    k = len(names)
    if not k:
        none = F.lit(None)
        return pages.select("page_id", "url", none.cast("string").alias("declared"), none.cast("string").alias("lang"),
                            none.cast("double").alias("confidence"), none.cast("array<double>").alias("posterior"))
    host = host_of(F.col("url"))
    first = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"://[^/?#]*/([a-zA-Z]{2,3})(?:[/?#]|$)", 1))
    rows = written(_text_evidence(pages, model).withColumn("host", host)
                   .withColumn("domain", F.substring_index("host", ".", -2)).withColumn("top", F.substring_index("host", ".", -1))
                   .withColumn("suffix", F.when(first != "", first)).withColumn("soft", _softmax(F.col("loglik"))))
    parts = [F.sum(F.col("soft")[i].cast("decimal(38,12)")).cast("double").alias(f"s{i}") for i in range(k)]  # sums that any order gives
    share = F.array(*[f"s{i}" for i in range(k)])
    add = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)

    def counted(by):
        return written(rows.groupBy(by).agg(*parts).select(F.col(by).alias(f"{by}_key"), share.alias(f"{by}_n")))

    out = rows
    for by in ("top", "domain", "host", "declared", "suffix"):
        table = counted(by)
        out = out.join(bounded(table), F.col(by) == F.col(f"{by}_key"), "left")
    whole = rows.agg(*parts).first()  # one number a language
    out = out.withColumn("all_n", F.array(*[F.lit(float(x or 0.0)) for x in whole]))
    less = lambda a: F.transform(F.arrays_zip(F.col(a).alias("n"), F.col("soft").alias("s")), lambda x: F.greatest(x["n"] - x["s"], F.lit(0.0)))
    out = out.withColumn("prior", F.transform(less("all_n"), lambda x: (x + 1.0) / (add(less("all_n")) + float(k))))
    for by in ("top", "domain", "host"):  # each level leans on the one above
        a = SMOOTH[by]
        out = out.withColumn("own", less(f"{by}_n"))
        out = out.withColumn("prior", F.transform(F.arrays_zip("own", "prior"), lambda x: (x["own"] + a * x["prior"]) / (add(F.col("own")) + a)))
    for by in ("declared", "suffix"):  # P(value | language), next to languages without the value
        out = out.withColumn("own", less(f"{by}_n"))
        out = out.withColumn(f"{by}_l", F.when(F.col(by).isNotNull(), F.transform(
            F.arrays_zip("own", F.col("all_n").alias("all")), lambda x: F.log((x["own"] + 0.5) / (x["all"] + 1.0)))).otherwise(
            F.array_repeat(F.lit(0.0), k)))
    fused = F.transform(F.arrays_zip("loglik", "prior", "declared_l", "suffix_l"),
                        lambda x: x["loglik"] + F.log(x["prior"]) + x["declared_l"] + x["suffix_l"])
    out = out.withColumn("posterior", _softmax(fused))
    best = F.array_position("posterior", F.array_max("posterior")).cast("int")
    return out.select("page_id", "url", "declared", F.element_at(F.array(*[F.lit(n) for n in names]), best).alias("lang"),
                      F.array_max("posterior").alias("confidence"), "posterior")


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/pages.parquet"), spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("posterior")
