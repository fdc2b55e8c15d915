import math

from pyspark.sql import functions as F

from tulha.functions.values import MISSING_MARKERS, decimal_comma, finite_double, in_calendar_window, observation_value, period_month, period_year


def python_value(text):
    if text is None or text in MISSING_MARKERS:
        return None
    try:
        number = float(text)
    except ValueError:
        return None
    return number if math.isfinite(number) else None


def test_observation_values_match_float(spark):
    texts = [
        None, "..", "...", "-", "X", "", " ", "0", "-0", "12", "+3", "1.5", ".5", "5.", ".", "1e3", "1E-2", "1e", "1_000", "1__0", "_1", "1_", "1_0.2_5",
        "1d", "1f", "0x10", "NaN", "inf", "-Infinity", "1e999", " 7 ", "\t8\n", "1 2", "1,5", "sigilo", "9" * 30,
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", observation_value(F.col("t")).alias("v")).collect():
        assert r.v == python_value(r.t), r


def test_decimal_comma(spark):
    cases = {
        "1234,56": 1234.56, "1234": 1234.0, "-0,5": -0.5, ",5": 0.5, " 7,0 ": 7.0, "1.234,56": None, "1.5": None,
        "": None, " ": None, "NaN": None, "NA": None, "n/a": None, "abc": None,
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    assert {r.t: r.v for r in df.select("t", decimal_comma(F.col("t")).alias("v")).collect()} == cases
    grouped = df.select(decimal_comma(F.lit("1.234.567,8"), thousands=".").alias("v")).first()
    assert grouped.v == 1234567.8


def test_periods_and_window(spark):
    periods = {"2022": 2022, "202201": 2022, "2016": 2016, "2015": 2015, "2021-x": 2021, "abc": None, "20": None, "2023": 2023, "": None}
    df = spark.createDataFrame([(p,) for p in periods], "p string")
    got = {r.p: (r.y, r.w) for r in df.select("p", period_year(F.col("p")).alias("y"), in_calendar_window(F.col("p"), 6, 2022).alias("w")).collect()}
    assert {p: y for p, (y, _) in got.items()} == periods
    assert sorted(p for p, (_, w) in got.items() if w) == ["2016", "2021-x", "2022", "202201"]
    assert df.where(in_calendar_window(F.col("p"), None, 2022)).count() == len(periods)
    assert [r.m for r in spark.createDataFrame([("202212",), ("202213",), ("2022",)], "p string").select(period_month(F.col("p")).alias("m")).collect()] == [12, None, None]


def test_a_number_is_read_once(spark):
    texts = [("1_000.5",), (" 2 ",), ("1e999",), ("-1e999",), ("12d",), ("NaN",), ("",), (None,)]
    df = spark.createDataFrame(texts, "t string").select("t", finite_double(F.col("t")).alias("n"))
    assert [r.n for r in df.collect()] == [1000.5, 2.0] + [None] * 6
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract(") == 1 and plan.lower().count("cast(") == 1
