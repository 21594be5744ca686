"""The incident / census / income / station model derived from the driver's tables.

The driver's tables carry no coordinates, so positions come from integer
arithmetic that SQL can repeat exactly:

* incident ``o_orderkey`` -> ``x = ((key*7919) % 1e6) / 1e4 + 0.00005``,
  ``y = ((key*104729) % 1e6) / 1e4 + 0.000025``, inside [0, 100)^2 and off every
  grid line and block diagonal;
* station ``s_suppkey`` -> the same with multipliers 15485863 and 32452843 and
  offsets 0.00003 and 0.00001;
* census blocks: nation ``n`` is the 20x20 square with corner
  ``((n%5)*20, (n div 5)*20)``; it holds four 10x10 squares ``q`` (offset
  ``((q%2)*10, (q div 2)*10)``), each cut into two triangles ``t``:
  t=0 is (0,0)-(1,0)-(1,1), t=1 is (0,0)-(1,1)-(0,1), times 10.
  Community = nation name, city = region name, zip = ``90000 + 4n + q``.
  Population and housing come from the customers placed in each block
  (``c_nationkey``, ``c_custkey % 8``), income per zip from their balances.

Everything is a Spark plan over the parquet tables; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.cleaning import format_currency
from ..operators.strategy import broadcast_if_bounded
from ..sources.ingest import clean_income

# Coordinate hashing constants and offsets (shared with the SQL oracle).
INCIDENT_MULT_X, INCIDENT_MULT_Y = 7919, 104729
INCIDENT_OFF_X, INCIDENT_OFF_Y = 0.00005, 0.000025
STATION_MULT_X, STATION_MULT_Y = 15485863, 32452843
STATION_OFF_X, STATION_OFF_Y = 0.00003, 0.00001
GRID_MOD, GRID_SCALE = 1000000, 10000.0
ZIP_BASE = 90000

# Order priority codes and their labels; "4-NOT SPECIFIED" is absent on
# purpose so that an unknown code yields a NULL label.
PRIORITY_LABELS = (
    ("1-URGENT", "Urgent"),
    ("2-HIGH", "High"),
    ("3-MEDIUM", "Medium"),
    ("5-LOW", "Low"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def hashed_coordinate(key: Column, mult: int, offset: float) -> Column:
    return ((key * F.lit(mult)) % F.lit(GRID_MOD)).cast("double") / F.lit(GRID_SCALE) + F.lit(offset)


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as incidents: key, position, status, date, code, customer."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("incident_id"),
        hashed_coordinate(k, INCIDENT_MULT_X, INCIDENT_OFF_X).alias("lon"),
        hashed_coordinate(k, INCIDENT_MULT_Y, INCIDENT_OFF_Y).alias("lat"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("occurred"),
        F.col("o_orderpriority").alias("code"),
        F.col("o_custkey").alias("cust"),
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        k.alias("station_id"),
        F.col("s_name").alias("division"),
        hashed_coordinate(k, STATION_MULT_X, STATION_OFF_X).alias("sx"),
        hashed_coordinate(k, STATION_MULT_Y, STATION_OFF_Y).alias("sy"),
    )


def _triangle(bx: Column, by: Column, t: Column) -> Column:
    def pt(x, y):
        return F.array(x.cast("double"), y.cast("double"))
    lower = F.array(pt(bx, by), pt(bx + 10, by), pt(bx + 10, by + 10), pt(bx, by))
    upper = F.array(pt(bx, by), pt(bx + 10, by + 10), pt(bx, by + 10), pt(bx, by))
    return F.array(F.array(F.when(t == 0, lower).otherwise(upper)))


def census_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """200 triangle blocks with COMM, CITY, ZCTA10, HOUSING10, POP_2010, geometry."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    cust = table(spark, sf_dir, "customer")
    base = (nation.join(broadcast_if_bounded(region, 100_000), nation.n_regionkey == region.r_regionkey)
            .select("n_nationkey", "n_name", "r_name")
            .withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(7)))))
    n, k = F.col("n_nationkey"), F.col("k")
    qd = F.floor(k / 2).cast("int")
    t = k % 2
    bx = (n % 5) * 20 + (qd % 2) * 10
    by = F.floor(n / 5).cast("int") * 20 + F.floor(qd / 2).cast("int") * 10
    blocks = base.select(
        (n * 8 + k).cast("long").alias("block_id"),
        n.alias("__n"), k.alias("__k"),
        F.col("n_name").alias("COMM"),
        F.col("r_name").alias("CITY"),
        (F.lit(ZIP_BASE) + n * 4 + qd).cast("string").alias("ZCTA10"),
        _triangle(bx, by, t).alias("geometry"),
    )
    people = (cust.groupBy(F.col("c_nationkey").alias("__n"), (F.col("c_custkey") % 8).cast("int").alias("__k"))
              .agg(F.count(F.lit(1)).alias("POP_2010"), F.count_if(F.col("c_acctbal") > 0).alias("HOUSING10")))
    out = blocks.join(people, ["__n", "__k"], "left").drop("__n", "__k")
    return out.select("block_id", "COMM", "CITY", "ZCTA10",
                      F.coalesce("HOUSING10", F.lit(0)).alias("HOUSING10"),
                      F.coalesce("POP_2010", F.lit(0)).alias("POP_2010"), "geometry")


def income_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Income table as the source ships it: ``Zip Code`` int, income as ``"$12,345"`` text."""
    cust = table(spark, sf_dir, "customer")
    zipc = (F.lit(ZIP_BASE) + F.col("c_nationkey") * 4 + F.floor((F.col("c_custkey") % 8) / 2)).cast("int")
    cents = F.round(F.abs(F.col("c_acctbal")) * 100).cast("long")
    agg = cust.groupBy(zipc.alias("Zip Code")).agg(F.sum(cents).alias("__c"), F.count(F.lit(1)).alias("__n"))
    median = F.expr("__c div (__n * 10)")
    return agg.select("Zip Code", format_currency(median).alias("Estimated Median Income"))


def income(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_income(income_text(spark, sf_dir))


def priority_codes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(PRIORITY_LABELS), "code string, label string")
