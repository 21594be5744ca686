from pyspark.sql import functions as F

from tessera.functions import AGE_GROUPS, bucketize
from tessera.operators import code_lookup, conditional_rate, rank_within, semi_filter, top_k, word_count
from tessera.plans import reports


def test_age_buckets_closed_ranges(spark):
    ages = [17.0, 18.0, 24.0, 25.0, 64.0, 65.0, 0.0, -1.0, None, 24.5]
    df = spark.createDataFrame([(a,) for a in ages], "age double")
    got = [r[0] for r in df.select(bucketize("age", AGE_GROUPS)).collect()]
    # 24.5 falls between the closed ranges 18-24 and 25-64, so no label, like CASE WHEN.
    assert got == ["<18", "18-24", "18-24", "25-64", "25-64", ">64", "<18", "<18", None, None]


def test_age_group_report_counts_and_order(spark):
    rows = [("AGGRAVATED ASSAULT X", 30), ("AGGRAVATED ASSAULT", 31), ("THEFT", 30),
            ("ASSAULT WITH DEADLY WEAPON, AGGRAVATED ASSAULT", 10), ("AGGRAVATED ASSAULT", None)]
    df = spark.createDataFrame(rows, "`Crm Cd Desc` string, `Vict Age` int")
    out = {r["age_group"]: r["count"] for r in reports.age_group_report(df).collect()}
    assert out == {"25-64": 2, "<18": 1, None: 1}


def test_conditional_rate_null_is_not_closed(spark):
    rows = [("a", "Invest Cont"), ("a", "Adult Arrest"), ("a", None), ("b", "UNK"), ("b", "UNK"),
            ("c", "Adult Other"), ("c", "Invest Cont")]
    df = spark.createDataFrame(rows, "area string, status string")
    pred = ~F.col("status").isin("Invest Cont", "UNK")
    got = {r["area"]: r["rate"] for r in conditional_rate(df, "area", pred).collect()}
    assert got == {"a": 1 / 3, "b": 0.0, "c": 0.5}


def test_closed_case_report_rank_gaps_and_null_option(spark):
    import datetime as dt
    d = dt.datetime(2020, 5, 1)
    rows = [(d, "A", "Adult Arrest"), (d, "A", "UNK"), (d, "B", "Adult Arrest"), (d, "B", "Invest Cont"),
            (d, "C", "Invest Cont"), (d, "C", None)]
    df = spark.createDataFrame(rows, "`DATE OCC` timestamp, `AREA NAME` string, `Status Desc` string")
    sql_like = {r["precinct"]: (r["closed_case_rate"], r["rank"]) for r in reports.closed_case_report(df).collect()}
    assert sql_like == {"A": (0.5, 1), "B": (0.5, 1), "C": (0.0, 3)}
    rowwise = {r["precinct"]: r["closed_case_rate"]
               for r in reports.closed_case_report(df, null_is_closed=True).collect()}
    assert rowwise["C"] == 0.5
    df.createOrReplaceTempView("t_crime")
    sql = {r["precinct"]: (r["closed_case_rate"], r["rank"])
           for r in reports.closed_case_report_sql(spark, "t_crime").collect()}
    assert sql == sql_like


def test_rank_within_is_bigint(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 2.0), (1, 1.0)], "g int, v double")
    out = rank_within(df, "g", F.col("v").desc(), "r")
    assert dict(out.dtypes)["r"] == "bigint"
    assert sorted(r["r"] for r in out.collect()) == [1, 1, 3]


def test_code_lookup_unknown_and_null(spark):
    df = spark.createDataFrame([("W",), ("Q",), (None,)], "code string")
    codes = spark.createDataFrame([("W", "White"), ("B", "Black")], "code string, full string")
    got = sorted((r["code"] or "", r["full"] or "") for r in code_lookup(df, codes, "code", "code", "full").collect())
    assert got == [("", ""), ("Q", ""), ("W", "White")]


def test_top_k_semi_filter(spark):
    df = spark.createDataFrame([(i, float(i % 4)) for i in range(10)], "id int, v double")
    top = top_k(df, [F.col("v").desc(), F.col("id")], 3)
    assert [r["id"] for r in top.collect()] == [3, 7, 2]
    kept = semi_filter(df, top.select("id"), "id")
    assert sorted(r["id"] for r in kept.collect()) == [2, 3, 7]


def test_word_count_lines_and_spaces(spark):
    df = spark.createDataFrame([("this is a text file with random words like text , words , like this is an "
                                 "example of a text file",), ("a  b\nb",)], "value string")
    got = {r["word"]: r["count"] for r in word_count(df).collect()}
    assert got["text"] == 3 and got["a"] == 3 and got["b"] == 2 and got[""] == 1 and got[","] == 2


def test_course_exercises(spark):
    emp = spark.createDataFrame([(1, "Mara K", 2000.0, 1, 500.0), (2, "Ann", 1500.0, 2, 0.0),
                                 (3, "Bo", 3000.0, 1, 100.0), (4, "Cy", 1000.0, 1, 50.0)],
                                "id int, name string, salary double, dep_id int, bonus double")
    dep = spark.createDataFrame([(1, "Dep A"), (2, "Dep B")], "id int, name string")
    assert [r["id"] for r in reports.bottom_paid(emp, 2).collect()] == [4, 2]
    assert [r["name"] for r in reports.top_paid_in_department(emp, dep, "Dep A", 2).collect()] == ["Bo", "Mara K"]
    emp.createOrReplaceTempView("t_emp")
    dep.createOrReplaceTempView("t_dep")
    assert [r["name"] for r in reports.top_paid_in_department_sql(spark, "t_emp", "t_dep", "Dep A", 2).collect()] \
        == ["Bo", "Mara K"]
    a = {r["name"]: r["yearly"] for r in reports.yearly_income(emp).collect()}
    b = {r["name"]: r["yearly"] for r in reports.yearly_income_pandas(emp).collect()}
    assert a == b and a["Mara K"] == 14 * 2000 + 500
