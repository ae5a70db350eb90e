"""Column helpers: engine-neutral rounding, guarded ceilings, name split."""

from pyspark.sql import functions as F

from tidepool.functions.numeric import bins_between, ceil_long, round_half_away, safe_div
from tidepool.functions.text import clock_label, split_name


def test_rounding_is_half_away_and_does_not_saturate(spark):
    df = spark.createDataFrame([(v,) for v in (2.5, -2.5, 1.005, 123.455, 1e30, -1e25, None)], "x double")
    r0 = [r[0] for r in df.select(round_half_away(F.col("x"), 0)).collect()]
    r2 = [r[0] for r in df.select(round_half_away(F.col("x"), 2)).collect()]
    assert r0[:2] == [3.0, -3.0]
    assert r2[2:4] == [1.0, 123.46]  # 1.005 is below the tie in binary
    assert r2[4:6] == [1e30, -1e25] and r2[6] is None


def test_guards(spark):
    df = spark.createDataFrame([(1.0, 0.0, 100), (1.0201, 1.0, 100), (2.0, 1.0, 0), (None, 1.0, 10)], "a double, b double, s int")
    rows = df.select(
        safe_div(F.col("a"), F.col("b")).alias("q"),
        bins_between(safe_div(F.col("a"), F.col("b")), F.col("s")).alias("bins"),
        ceil_long(F.lit(float("nan"))).alias("c"),
    ).collect()
    assert rows[0]["q"] is None and rows[0]["bins"] is None
    assert rows[1]["bins"] == 2 and rows[2]["bins"] is None and rows[3]["bins"] is None
    assert all(r["c"] is None for r in rows)


def test_text_helpers(spark):
    import datetime as dt

    df = spark.createDataFrame([("A-B-C", dt.datetime(2024, 1, 1, 13, 5))], "name string, ts timestamp_ntz")
    x, y = split_name(F.col("name"))
    r = df.select(x.alias("x"), y.alias("y"), clock_label(F.col("ts")).alias("t")).collect()[0]
    assert (r["x"], r["y"], r["t"]) == ("A", "B-C", "01:05 PM")
