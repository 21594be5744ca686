"""Join-strategy control: checked broadcasts, hints and the strategy sweep.

A side is broadcast only after an explicit check of its rows and bytes (a partial
aggregate, one row a task), never because it "looks small"; beyond the bound the join falls back to a
shuffle, where AQE can still re-plan or split skewed partitions at run time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import product

from pyspark.sql import DataFrame, functions as F

# The join-strategy hint names Spark accepts.
JOIN_STRATEGIES = ("BROADCAST", "MERGE", "SHUFFLE_HASH", "SHUFFLE_REPLICATE_NL")

# Hints we apply.  SHUFFLE_REPLICATE_NL plans a cartesian product of the two sides, which
# does not survive large inputs; it is refused rather than silently planned.
SUPPORTED_STRATEGIES = ("BROADCAST", "MERGE", "SHUFFLE_HASH")


def broadcast_if_bounded(df: DataFrame, max_rows: int, max_bytes: int = 32 << 20) -> DataFrame:
    """``broadcast(df)`` when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes as JSON, else ``df`` unchanged."""
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))).cast("long"))
    n, b = df.agg(F.count(F.lit(1)), size).first()
    return F.broadcast(df) if n <= max_rows and (b or 0) <= max_bytes else df


def with_strategy(df: DataFrame, strategy: str | None) -> DataFrame:
    """Attach a join-strategy hint to ``df`` (the side that should be built/broadcast).

    ``None`` or ``""`` leaves the choice to the optimizer.
    """
    if not strategy:
        return df
    name = strategy.upper()
    if name not in JOIN_STRATEGIES:
        raise ValueError(f"unknown join strategy {strategy!r}; expected one of {JOIN_STRATEGIES}")
    if name not in SUPPORTED_STRATEGIES:
        raise ValueError(f"{name} plans a cartesian product; use one of {SUPPORTED_STRATEGIES}")
    return df.hint(name)


def strategy_sweep(build: Callable[[str, str], DataFrame],
                   strategies: Iterable[str] = SUPPORTED_STRATEGIES) -> dict[tuple[str, str], DataFrame]:
    """Every (first join, second join) pair of strategies -> the query built with them (D3).

    Each pair passes its *own* two strategies through (the first to the first join,
    the second to the second).
    """
    strategies = tuple(strategies)
    return {(a, b): build(a, b) for a, b in product(strategies, strategies)}


def physical_join_nodes(df: DataFrame) -> list[str]:
    """Names of the join operators in the executed physical plan (for plan assertions)."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    names = ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
             "CartesianProduct")
    found = []
    for line in plan.splitlines():
        for n in names:
            if n in line:
                found.append(n)
    return found
