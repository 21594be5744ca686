"""Bucketise a numeric column into labelled ranges (a generated CASE WHEN chain)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Bucket:
    """``lo <= v <= hi`` with optional open ends and per-end inclusivity."""

    label: str
    lo: float | None = None
    hi: float | None = None
    lo_inclusive: bool = True
    hi_inclusive: bool = True

    def predicate(self, value: Column) -> Column:
        cond = F.lit(True)
        if self.lo is not None:
            cond = cond & ((value >= F.lit(self.lo)) if self.lo_inclusive else (value > F.lit(self.lo)))
        if self.hi is not None:
            cond = cond & ((value <= F.lit(self.hi)) if self.hi_inclusive else (value < F.lit(self.hi)))
        return cond


# The victim age groups of the age report, in order:
# "<18" (v < 18), "18-24" (18 <= v <= 24), "25-64" (25 <= v <= 64), ">64" (v > 64).
AGE_GROUPS = (
    Bucket("<18", hi=18, hi_inclusive=False),
    Bucket("18-24", lo=18, hi=24),
    Bucket("25-64", lo=25, hi=64),
    Bucket(">64", lo=64, lo_inclusive=False),
)


def bucketize(value: Column | str, buckets=AGE_GROUPS) -> Column:
    """Label of the first bucket holding ``value``; NULL when none does (no ELSE)."""
    v = F.col(value) if isinstance(value, str) else value
    expr = None
    for b in buckets:
        expr = F.when(b.predicate(v), F.lit(b.label)) if expr is None else expr.when(b.predicate(v), F.lit(b.label))
    return expr
