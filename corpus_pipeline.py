"""The corpus pipeline: quality rules, near-duplicates, repeated passages, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns a DataFrame
that is written as Parquet and read again as the next stage's docs; all but the last return the columns of
``documents``.  The stages' results cannot be written in SQL (``ORACLE_SQL`` is None); tests check each
against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import small_batches, written
from tessera.llm.mixing import mix
from tessera.llm.near_dedup import drop_near_duplicates
from tessera.llm.packing import pack, pieces
from tessera.llm.quality import keep_quality
from tessera.llm.substring_dedup import remove_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and their language's fertility bands."""
    return keep_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: five-word shingles, similarity of 0.8 or more."""
    return drop_near_duplicates(docs, words=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that a smaller doc_id holds are cut; documents left empty go."""
    return remove_repeats(docs, window=50)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix to the target weights takes it."""
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every copy with its sequence and place in it."""
    with small_batches(spark):
        rows = written(pieces(docs))
    return pack(rows)


STAGES = [("quality rules", quality), ("near-duplicates", near_dedup), ("substring dedup", substring_dedup), ("mixing", mixing),
          ("packing", packing)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
