import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from candlework.functions import columns as C
from candlework.operators.clean import clean_bars, date_window, dedup_keep_last, drop_null_critical

TEXT = "ticker string, date string, open string, high string, low string, close string, volume string"


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first().x


def test_snake_case_and_tag(spark):
    df = C.snake_case_columns(spark.createDataFrame([(1, 2)], "`Adj Close` int, Volume int"))
    assert C.tag_ticker(df, "T").columns == ["adj_close", "volume", "ticker"]


def test_landing_key(spark):
    key = C.landing_key(F.lit("INFY.NS"), dt.date(2024, 5, 6))
    assert one(spark, key) == "INFY_NS_2024-05-06.csv"


def test_parse_date(spark):
    assert one(spark, C.parse_date(F.lit("2024-02-29 00:00:00"))) == dt.date(2024, 2, 29)
    assert one(spark, C.parse_date(F.lit("nonsense"), strict=False)) is None
    for bad in ("nonsense", "2024-02-30", "2024-01-01x", ""):
        assert one(spark, C.parse_date(F.lit(bad), strict=False)) is None
        with pytest.raises(PySparkException):
            one(spark, C.parse_date(F.concat(F.lit(bad), F.substring(F.col("id"), 5, 1))))


def test_cast_volume(spark):
    df = spark.createDataFrame([(3.9,), (-3.9,), (None,)], "v double")
    assert [r.x for r in df.select(C.cast_volume(F.col("v"), strict=False).alias("x")).collect()] == [3, -3, None]
    with pytest.raises(PySparkException, match="volume is missing"):
        df.select(C.cast_volume(F.col("v"))).collect()


def test_zero_divisors_give_null(spark):
    zero, value = F.lit(0.0), F.lit(5.0)
    assert one(spark, C.price_range_pct(value, zero)) is None
    assert one(spark, C.volatility_pct(value, zero)) is None
    assert one(spark, C.volume_ratio(value, zero)) is None


def test_signal(spark):
    pairs = [(2.0, 1.0), (1.0, 2.0), (1.0, 1.0)]
    df = spark.createDataFrame(pairs, "a double, b double")
    got = [r.x for r in df.select(C.ma_signal(F.col("a"), F.col("b")).alias("x")).collect()]
    assert got == ["BULLISH", "BEARISH", "NEUTRAL"]


def test_clean_types_rounds_and_drops(spark):
    rows = [
        ("A", "2024-01-01", "1.005", "NaN", "0.125", "2.5", "10.0"),
        ("A", "2024-01-02", "1", "1", "1", None, "10"),
        ("A", None, "1", "1", "1", "1", "10"),
        (None, "2024-01-03", "1", "1", "1", "1", "10"),
        ("A", "2024-01-04", "1", "1", "1", "NaN", "10"),
    ]
    seen = Observation("clean")
    got = clean_bars(spark.createDataFrame(rows, TEXT), observation=seen).collect()
    # 1.005 is a little less than that in binary, so it rounds down.
    assert [tuple(r) for r in got] == [("A", dt.date(2024, 1, 1), 1.0, None, 0.13, 2.5, 10)]
    assert seen.get == {"rows_before": 5, "rows_after": 1}


def test_tolerant_clean_drops_bad_dates(spark):
    rows = [("A", "bad", "1", "1", "1", "1", None), ("A", "2024-01-01", "1", "1", "1", "1", None)]
    got = clean_bars(spark.createDataFrame(rows, TEXT), strict=False).collect()
    assert [(r.date, r.volume) for r in got] == [(dt.date(2024, 1, 1), None)]


def test_drop_null_critical_without_observation(spark):
    df = spark.createDataFrame([("A", "d", 1.0), ("A", None, 1.0)], "ticker string, date string, close double")
    assert drop_null_critical(df).count() == 1


def test_dedup_keeps_highest_sequence(spark):
    rows = [("A", 1, 1, "first"), ("A", 1, 3, "last"), ("A", 1, 2, "middle"), ("B", 1, 1, "only")]
    df = spark.createDataFrame(rows, "ticker string, date int, seq int, what string").repartition(4)
    got = {(r.ticker, r.what) for r in dedup_keep_last(df, ["ticker", "date"], "seq").collect()}
    assert got == {("A", "last"), ("B", "only")}


def test_date_window_is_half_open(spark):
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    df = spark.createDataFrame([(d,) for d in days], "date date")
    assert [r.date for r in date_window(df, days[0], days[2]).collect()] == days[:2]
