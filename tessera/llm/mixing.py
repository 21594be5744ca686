"""Mixing sources to target weights by entropy balancing.

The mix is the one nearest to "each document once" (least Kullback-Leibler divergence, at most ``CAP``
copies) whose words meet each source's target.  Its dual has one multiplier per source and is convex; the
rate of a document of x words (in its source's mean) is min(CAP, exp(lambda * x)), an exponential tilt.
Newton's iterations solve all sources at once: each is one grouped sum of gradient and curvature over the
(source, size) cells, with bisection where a step leaves the bracket.

Rates become whole copies: a cell's documents get the whole part, and the cell's share of extra copies goes
on to the next cell of the source with the words that rounding left over, so a source ends within about its
smallest documents' size of its target.  Who gets an extra copy is decided by a hash of the row.

Defined results.  A null, empty or blank text has size 0 and takes 0 words.  A null source is a source of
its own, the last.  Repeated rows are mixed once each.  Sources without words have the target 0.  Extra
columns are kept by ``mix`` and not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window, functions as F

from .common import WORD, bounded, written

CAP = 3
WEIGHTS = (1, 2, 3)


def numbered(names: DataFrame, column: str) -> DataFrame:
    """``names`` with ``position``, its place (from 0) in ascending order, nulls last; no single task sees all."""
    ranged = written(names.repartitionByRange(F.col(column).asc_nulls_last())
                     .sortWithinPartitions(F.col(column).asc_nulls_last())
                     .select(column, F.monotonically_increasing_id().alias("at")))
    part = F.shiftright("at", 33)
    counts = sorted((r["part"], r["n"]) for r in ranged.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    offset, before = [], 0
    for p, n in counts:
        offset.append((p, before))
        before += n
    if not offset:
        return ranged.select(column, F.lit(0).cast("long").alias("position"))
    starts = F.broadcast(names.sparkSession.createDataFrame(offset, "part long, before long"))
    return ranged.withColumn("part", part).join(starts, "part").select(
        column, (F.col("before") + F.col("at") - F.shiftleft("part", 33)).alias("position"))


def targets(cells: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """source, source_size, target: shares by weight of all words, stopped at ``cap`` times the source."""
    sizes = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("position") % len(weights) + 1).cast("int"))
    place = numbered(sizes.select("source"), "source").withColumnRenamed("source", "name")
    t = written(sizes.join(place, F.col("source").eqNullSafe(F.col("name"))).select("source", "source_size", weight.alias("w")))
    total = t.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:  # the level only rises, and each turn stops a further source
        row = t.agg(F.sum(F.when(F.col("source_size") * cap <= F.col("w") * level, F.col("source_size") * cap)).alias("full"),
                    F.sum(F.when(F.col("source_size") * cap > F.col("w") * level, F.col("w"))).alias("open")).first()
        higher = (total - (row["full"] or 0)) / row["open"] if row["open"] else level
        if higher <= level:
            break
        level = higher
    return t.select("source", "source_size", F.least(F.col("source_size") * F.lit(float(cap)), F.col("w") * F.lit(level)).alias("target"))


def solve(cells: DataFrame, aims: DataFrame, cap: int = CAP) -> DataFrame:
    """source, rate multiplier ``l`` and mean size ``mean``: the dual's solution, by Newton's method.

    A step that leaves the bracket halves it instead, so every source ends: at its target, or where no number lies between the limits.
    Words are summed as decimals, whose sums do not depend on their order, so reruns agree.
    """
    whole = cells.groupBy("source").agg(F.sum("n").alias("docs"))
    state = whole.withColumnRenamed("source", "name").join(aims, F.col("source").eqNullSafe(F.col("name"))).select(
        "source", "target", (F.col("source_size") / F.col("docs")).alias("mean"),
        F.try_divide("target", "source_size").alias("factor"))
    edge = 1e6
    state = written(state.select("*", F.lit(0.0).alias("l"), F.lit(-edge).alias("low"), F.lit(edge).alias("high"),
                                 (F.col("factor").isNull() | (F.col("factor") >= cap)).alias("done")))
    exact = "decimal(38,6)"
    sums = cells.where("size > 0").withColumnRenamed("source", "name")
    while True:
        x = F.try_divide("size", "mean")
        r = F.least(F.lit(float(cap)), F.exp(F.col("l") * x))
        free = F.exp(F.col("l") * x) < cap
        words = F.col("n") * F.col("size")
        both = sums.join(state.where("not done"), F.col("source").eqNullSafe(F.col("name"))).groupBy("source").agg(
            F.sum((words * r).cast(exact)).cast("double").alias("g"),
            F.sum(F.when(free, words * r * x).otherwise(0.0).cast(exact)).cast("double").alias("h"))
        both = both.withColumnRenamed("source", "name")
        gap = F.col("g") - F.col("target")
        low, high = F.when(gap < 0, F.col("l")).otherwise(F.col("low")), F.when(gap < 0, F.col("high")).otherwise(F.col("l"))
        newton = F.col("l") - F.try_divide(gap, F.col("h"))
        inside = (newton > low) & (newton < high)
        moved = state.join(both, F.col("source").eqNullSafe(F.col("name")), "left").select(
            "source", "target", "mean", "factor", "l", low.alias("low2"), high.alias("high2"),
            F.when(inside, newton).otherwise((low + high) / 2).alias("l2"),
            (F.col("done") | F.col("g").isNull() | (F.abs(gap) <= 1e-9 * F.col("target") + 1e-6)
             | (high - low <= 1e-15 * F.abs("l"))).alias("done2"), "low", "high")
        state = moved.select("source", "target", "mean", "factor", F.when(F.col("done2"), F.col("l")).otherwise(F.col("l2")).alias("l"),
                             F.when(F.col("done2"), F.col("low")).otherwise(F.col("low2")).alias("low"),
                             F.when(F.col("done2"), F.col("high")).otherwise(F.col("high2")).alias("high"),
                             F.col("done2").alias("done"))
        state = written(state)
        if not state.where("not done").limit(1).count():
            break
    return state


def round_cells(rows: pd.DataFrame, cap: int = CAP) -> pd.DataFrame:
    """One source's cells (size, n, rate) with whole copies: ``base`` for each document, ``extra`` more in all.

    From the largest size down, so that what one size leaves over the smaller ones make up.
    """
    rows = rows.sort_values("size", ascending=False)
    base, extra, left = [], [], 0.0
    for size, n, rate in zip(rows["size"].tolist(), rows["n"].tolist(), rows["rate"].tolist()):
        if size == 0:
            base.append(1)
            extra.append(0)
            continue
        want = rate * n * size + left
        copies = min(cap * n, max(0, int(want / size + 0.5)))
        left = want - copies * size
        base.append(copies // n)
        extra.append(copies % n)
    return rows.assign(base=base, extra=extra)


def _sized(docs: DataFrame) -> DataFrame:
    """``docs`` with the struct column ``mix__``: size; key, a hash of the row, and tie, one of its place in its file (0 to 2**63 - 1).

    The tie parts equal rows, which are alike: which of them takes a copy changes no result.  ``docs`` that is no table of files is written.
    """
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        docs = written(docs)
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    low = F.lit(2 ** 63 - 1)
    key = F.xxhash64("doc_id", "text").bitwiseAND(low)
    tie = F.xxhash64("_metadata.file_name", "_metadata.row_index").bitwiseAND(low)
    return docs.withColumn("mix__", F.struct(size.alias("size"), key.alias("key"), tie.alias("tie")))


def _same(source: str, size: str):
    return F.col("source").eqNullSafe(F.col(source)) & (F.col("size") == F.col(size))


def plan(flat: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """name (a source), words (a size), source_size, target, base, until, until_tie: the copies of the documents of a cell.

    ``flat`` has source, size, key and tie.  A document takes ``base`` copies, and one more if (key, tie) <= (until, until_tie).
    """
    cells = written(flat.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    aims = written(targets(cells, weights, cap))
    state = solve(cells, aims, cap).select(F.col("source").alias("name"), "l", "mean", "factor")
    rate = F.when(F.col("factor").isNull(), 1.0).when(F.col("factor") >= cap, float(cap)).otherwise(
        F.least(F.lit(float(cap)), F.exp(F.col("l") * F.try_divide("size", "mean"))))
    rated = cells.join(state, F.col("source").eqNullSafe(F.col("name"))).select("source", "size", "n", rate.alias("rate"))
    cell = written(rated.groupBy("source").applyInPandas(lambda p: round_cells(p, cap)[["source", "size", "n", "base", "extra"]],
                                                         "source string, size long, n long, base long, extra long")
                   .withColumnRenamed("source", "name").withColumnRenamed("size", "words"))
    # the extra copies of a cell go by the order of the key, among rows of one key by that of the tie
    picky = flat.join(cell.where("extra > 0"), _same("name", "words")).select("source", "size", "key", "tie", F.col("extra").alias("need"))
    first = written(_border(picky, "key"))
    some = first.where("rest < same").select("name", "words", "edge", "rest")
    equal = picky.join(some, _same("name", "words") & (F.col("key") == F.col("edge"))).select("source", "size", "tie", F.col("rest").alias("need"))
    second = _border(equal, "tie").select(F.col("name").alias("s"), F.col("words").alias("z"), F.col("edge").alias("until_tie"))
    until = first.select(F.col("name").alias("s"), F.col("words").alias("z"), F.col("edge").alias("until")).join(
        second.select(F.col("s").alias("s2"), F.col("z").alias("z2"), "until_tie"), F.col("s").eqNullSafe(F.col("s2")) & (F.col("z") == F.col("z2")), "left")
    out = cell.join(until, F.col("name").eqNullSafe(F.col("s")) & (F.col("words") == F.col("z")), "left")
    out = out.join(aims, F.col("name").eqNullSafe(F.col("source")))
    return written(out.select("name", "words", "source_size", "target", "base", F.coalesce("until", F.lit(-1)).alias("until"),
                              F.coalesce("until_tie", F.lit(2 ** 63 - 1)).alias("until_tie")))


def _border(rows: DataFrame, value: str) -> DataFrame:
    """name, words, edge, rest, same: the ``value`` up to which the first ``need`` rows of a cell go, how many of the ``same`` rows that
    have just this value are among them.

    First the value's bucket, then the place inside it; equal values are one row of the second step.
    """
    bucket = F.shiftright(value, 51)
    counts = rows.groupBy("source", "size", "need", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))
    by = Window.partitionBy("source", "size").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumn("upto", F.sum("rows").over(by.orderBy("bucket"))).where("upto >= need and upto - rows < need").select(
        F.col("source").alias("name"), F.col("size").alias("words"), F.col("bucket").alias("own"), (F.col("need") - F.col("upto") + F.col("rows")).alias("left"))
    inside = rows.join(counts, _same("name", "words") & (bucket == F.col("own"))).groupBy("source", "size", "left", value).agg(F.count(F.lit(1)).alias("same"))
    inside = inside.withColumn("upto", F.sum("same").over(by.orderBy(value))).where("upto >= left and upto - same < left")
    return inside.select(F.col("source").alias("name"), F.col("size").alias("words"), F.col(value).alias("edge"),
                         (F.col("left") - F.col("upto") + F.col("same")).alias("rest"), "same")


def mix(docs: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, source, ...), each as often as the mix takes it."""
    sized = _sized(docs)
    cell = plan(written(sized.select("source", "mix__.size", "mix__.key", "mix__.tie")), weights, cap)
    cell = cell.select(F.struct(*cell.columns).alias("cell__"))
    meet = F.col("source").eqNullSafe(F.col("cell__.name")) & (F.col("mix__.size") == F.col("cell__.words"))
    row, own = F.col("mix__"), F.col("cell__")
    more = (row["key"] < own["until"]) | ((row["key"] == own["until"]) & (row["tie"] <= own["until_tie"]))
    times = own["base"] + F.when(more, 1).otherwise(0)
    taken = sized.join(bounded(cell), meet).withColumn("mix__", F.explode(F.array_repeat(F.lit(0), times.cast("int"))))
    return taken.select(*docs.columns)


def mixed_words(docs: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row of ``docs``."""
    flat = written(_sized(docs.select("doc_id", "text", "source")).select("doc_id", "source", "mix__.size", "mix__.key", "mix__.tie"))
    cell = plan(flat, weights, cap)
    more = (F.col("key") < F.col("until")) | ((F.col("key") == F.col("until")) & (F.col("tie") <= F.col("until_tie")))
    times = F.col("base") + F.when(more, 1).otherwise(0)
    return flat.join(cell, _same("name", "words")).select("doc_id", "size", "source_size", "target", (F.col("size") * times).alias("taken"))


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    return mixed_words(spark.read.parquet(f"{sf_dir}/documents.parquet"))
