"""Relational building blocks: grouped counts, conditional rates with ranking,
code-table lookup, top/bottom-k, semi filters and word count.

Every function is DataFrame -> DataFrame and lazy.  Aggregations are plain
``groupBy().agg()`` so Spark plans a partial (map-side) aggregate before the
shuffle: a hot group key costs one partial row per task, not a hot partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.buckets import AGE_GROUPS, bucketize
from ..functions.cleaning import ratio, words
from .strategy import broadcast_if_bounded


def _cols(cols) -> list:
    return [cols] if isinstance(cols, (str, Column)) else list(cols)


# --- counts --------------------------------------------------------------------------

def count_by(df: DataFrame, keys, name: str = "count", descending: bool = True) -> DataFrame:
    """``groupBy(keys).count()`` sorted by the count (A1/A2/A8)."""
    out = df.groupBy(*_cols(keys)).agg(F.count(F.lit(1)).alias(name))
    return out.orderBy(F.col(name).desc() if descending else F.col(name).asc())


def bucket_count(df: DataFrame, value: str, label: str, buckets=AGE_GROUPS,
                 where: Column | None = None, name: str = "count") -> DataFrame:
    """Filter, label each row with its bucket, count per label, sort by count (Q1 shape).

    Values outside every bucket (and NULL values) form a NULL group, as a CASE WHEN
    without ELSE does.
    """
    if where is not None:
        df = df.filter(where)
    return count_by(df.select(bucketize(F.col(value), buckets).alias(label)), label, name)


# --- conditional rates ----------------------------------------------------------------

def conditional_rate(df: DataFrame, keys, predicate: Column, name: str = "rate",
                     hits: str | None = None, total: str | None = None) -> DataFrame:
    """Per group: rows where ``predicate`` holds / all rows (A4, A7).

    A NULL predicate (e.g. ``NOT IN`` over a NULL value) counts as a miss, as SQL's
    ``COUNT(CASE WHEN p THEN 1 END)`` does.
    """
    aggs = [F.count_if(F.coalesce(predicate, F.lit(False))).alias("__hits"), F.count(F.lit(1)).alias("__total")]
    out = df.groupBy(*_cols(keys)).agg(*aggs).withColumn(name, ratio("__hits", "__total"))
    keep = [c for c in out.columns if c not in ("__hits", "__total")]
    if hits:
        out = out.withColumnRenamed("__hits", hits)
        keep.append(hits)
    if total:
        out = out.withColumnRenamed("__total", total)
        keep.append(total)
    return out.select(*keep)


def rank_within(df: DataFrame, partition_by, order_by: Column, name: str = "rank") -> DataFrame:
    """``RANK() OVER (PARTITION BY ... ORDER BY ...)`` as a bigint column (gaps after ties)."""
    w = Window.partitionBy(*_cols(partition_by)).orderBy(order_by)
    return df.withColumn(name, F.rank().over(w).cast("long"))


def not_in(c: Column | str, values: Sequence) -> Column:
    """Three-valued ``c NOT IN (values)``: NULL stays NULL (neither in nor out)."""
    col = F.col(c) if isinstance(c, str) else c
    return ~col.isin(list(values))


# --- lookups and top-k ----------------------------------------------------------------

def code_lookup(df: DataFrame, codes: DataFrame, code_col: str, codes_key: str, label_col: str,
                max_codes: int = 1_000_000) -> DataFrame:
    """Attach the label of each row's code; unknown or NULL codes get a NULL label (J9).

    The code table is broadcast only after checking it holds at most ``max_codes``
    rows; beyond that the join is left to a shuffle.
    """
    small = codes.select(F.col(codes_key).alias("__lookup_key"), F.col(label_col).alias(label_col))
    small = broadcast_if_bounded(small, max_codes)
    return df.join(small, F.col(code_col) == F.col("__lookup_key"), "left").drop("__lookup_key")


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows by ``order`` (a TakeOrderedAndProject; add a tie-break column
    to ``order`` for a deterministic answer)."""
    return df.orderBy(*order).limit(k)


def semi_filter(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Keep rows of ``df`` whose key appears in ``keys`` (``isin`` a list, without a collect)."""
    return df.join(keys, on, "left_semi")


# --- text ---------------------------------------------------------------------------

def word_count(lines: DataFrame, text_col: str = "value", delimiter: str = " ") -> DataFrame:
    """Token counts over whole texts, most frequent first (E1).  Newlines split lines,
    ``delimiter`` splits tokens; empty tokens are kept as the line splitter yields them."""
    tokens = lines.select(F.explode(words(F.col(text_col), delimiter)).alias("word"))
    return tokens.groupBy("word").agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc())
