"""Scalar clean-up expressions used by the ingest jobs (all JVM-side, codegen-friendly)."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Fixed value: the 12-hour timestamp layout of the incident files.
INCIDENT_TS_FORMAT = "MM/dd/yyyy hh:mm:ss a"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c: Column | str, fmt: str = INCIDENT_TS_FORMAT) -> Column:
    """Text -> timestamp; a value that does not parse becomes NULL instead of failing the job.

    Already-typed timestamps pass through unchanged, so the clean-up is idempotent.
    """
    return F.try_to_timestamp(_c(c), F.lit(fmt))


def parse_currency(c: Column | str, to: str = "int") -> Column:
    """``"$33,887"`` -> 33887; empty or non-numeric text -> NULL."""
    stripped = F.regexp_replace(_c(c).cast("string"), r"[$,]", "")
    return stripped.try_cast(to)


def format_currency(c: Column | str) -> Column:
    """Integer amount -> ``"$12,345"`` (the inverse of :func:`parse_currency`)."""
    return F.concat(F.lit("$"), F.format_number(_c(c), 0))


def ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den`` as double; division by zero gives NULL (not an ANSI error)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def words(text: Column | str, delimiter: str = " ") -> Column:
    """Split text into lines, then lines into tokens on ``delimiter`` (empty tokens kept)."""
    return F.split(_c(text), "\n|" + re.escape(delimiter) if delimiter else "\n", -1)
