"""Row orders of the analyst questions, by hand; exact ratios on ties."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from candlework.functions import columns as C
from candlework.functions.numeric import stddev
from candlework.operators import analytics, clean

D = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(40)]
ENRICHED = (
    "ticker string, date date, open double, high double, low double, close double, volume long, "
    "daily_return_pct double, ma_7 double, ma_30 double, daily_range double"
)


@pytest.fixture(scope="module")
def enriched(spark):
    rows = [
        ("B", D[1], 1.0, 2.0, 1.0, 100.0, 900, 2.0, 1.0, 2.0, 1.0),
        ("A", D[1], 1.0, 2.0, 1.0, 100.0, 900, 2.0, 2.0, 1.0, 1.0),
        ("A", D[0], 1.0, 2.0, 1.0, 100.0, 100, None, None, None, 1.0),
        ("B", D[0], 1.0, 2.0, 1.0, 100.0, 100, 2.0, 1.0, 1.0, 3.0),
        ("C", D[35], 1.0, 2.0, 1.0, 100.0, 10, -1.0, 1.0, 1.0, None),
        ("A", D[35], 1.0, 2.0, 1.0, 0.0, 200, -1.0, 1.0, 1.0, 1.0),
    ]
    return spark.createDataFrame(rows, ENRICHED).repartition(3, "close", "date")


def keys(df, *names):
    names = names or ("ticker", "date")
    return [tuple(r[n] for n in names) for r in df.collect()]


def test_overview_has_missing_returns_first(spark):
    rows = [("A", 1.0), ("D", None), ("C", 2.0), ("B", 2.0), ("E", None)]
    df = spark.createDataFrame(rows, "ticker string, avg_daily_return_pct double").select(
        "*",
        *[F.lit(None).cast("date").alias(c) for c in ("from_date", "to_date")],
        F.lit(1).alias("total_trading_days"),
        *[F.lit(v).alias(c) for c, v in (("avg_close", 1.0), ("all_time_high", 201.01), ("all_time_low", 200.0))],
    )
    got = analytics.summary_overview(df.repartition(4))
    assert keys(got, "ticker", "price_range_pct") == [(t, 0.51) for t in "DEBCA"]


def test_gains_and_losses_break_ties_by_ticker_and_date(enriched):
    gains = [("A", D[1]), ("B", D[0]), ("B", D[1]), ("A", D[35]), ("C", D[35])]
    assert keys(analytics.top_gains(enriched)) == gains
    assert keys(analytics.top_losses(enriched)) == gains[3:] + gains[:3]
    assert keys(analytics.top_losses(enriched, 1)) == [("A", D[35])]
    assert sorted(keys(analytics.top_gains_per_ticker(enriched, 1))) == [("A", D[1]), ("B", D[0]), ("C", D[35])]


def test_months_signals_and_volatile_days(enriched):
    months = [("A", dt.date(2024, 1, 1)), ("A", dt.date(2024, 2, 1)), ("B", dt.date(2024, 1, 1)), ("C", dt.date(2024, 2, 1))]
    assert keys(analytics.monthly_close(enriched), "ticker", "month") == months
    assert keys(analytics.ma_regime(enriched), "ticker", "date", "signal") == [
        ("A", D[35], "NEUTRAL"), ("A", D[1], "BULLISH"), ("B", D[1], "BEARISH"), ("B", D[0], "NEUTRAL"),
        ("C", D[35], "NEUTRAL"),
    ]
    assert keys(analytics.most_volatile(enriched), "ticker", "date", "volatility_pct") == [
        ("B", D[0], 3.0), ("A", D[0], 1.0), ("A", D[1], 1.0), ("B", D[1], 1.0), ("A", D[35], None),
    ]


def test_performance_and_spikes(spark, enriched):
    assert keys(analytics.recent_performance(enriched), "ticker", "cumulative_return_pct", "volatility_stddev") == [
        ("A", -1.0, None), ("C", -1.0, None),
    ]
    assert keys(analytics.last_30_trading_days(enriched), "ticker", "volatility_stddev") == [
        ("B", 0.0), ("A", 2.1213), ("C", None),
    ]
    own = spark.createDataFrame([("A", 99.0), ("B", 300.0), ("C", 0.0)], "ticker string, avg_daily_volume double")
    assert keys(analytics.volume_spikes(enriched, own), "ticker", "date", "volume_ratio") == [
        ("A", D[1], 9.09), ("B", D[1], 3.0), ("A", D[35], 2.02), ("C", D[35], None),
    ]


def test_bars_are_sorted(enriched):
    got = clean.sort_bars(enriched.union(enriched))
    assert keys(got) == sorted(keys(enriched) * 2)


def test_ratios_round_exact_ties_away_from_zero(spark):
    one = spark.range(1).select(
        C.volume_ratio(F.lit(201), F.lit(200.0)), C.volume_ratio(F.lit(201), F.lit(0.0)),
        C.price_range_pct(F.lit(201.01), F.lit(200.0)), C.price_range_pct(F.lit(198.99), F.lit(200.0)),
        C.volatility_pct(F.lit(1.01), F.lit(200.0)), C.volatility_pct(F.lit(None).cast("double"), F.lit(1.0)),
    )
    assert tuple(one.first()) == (1.01, None, 0.51, -0.51, 0.51, None)


def test_deviation_does_not_depend_on_partitioning(spark):
    values = spark.range(5_000).selectExpr("(id * 7919 % 20011 - 10000) / 10000.0D AS x")
    got = {values.repartition(n).agg(stddev(F.col("x"), 4)).first()[0] for n in (1, 3, 7, 16)}
    assert got == {round(values.agg(F.stddev_samp("x")).first()[0], 4)}


def test_texts_that_say_missing_are_null(spark):
    names = "date string, open string, high string, low string, close string, volume string, ticker string"
    rows = [
        ("2024-01-01", "NA", "null", "N/A", "1.005", "9007199254740993", "A"),
        ("2024-01-01 00:00:00+05:30", "", "1", "1", "NA", "1", "A"),
        ("2024-01-02", "1", "1", "1", "2", "12.75", "n/a"),
        ("2024-01-03T10:00", "1", "1", "1", "2", "12.75", "B"),
    ]
    got = clean.clean_bars(spark.createDataFrame(rows, names)).orderBy("ticker").collect()
    assert [(r.ticker, r.date, r.open, r.high, r.volume) for r in got] == [
        ("A", D[0], None, None, 9007199254740993), ("B", D[2], 1.0, 1.0, 12),
    ]


@pytest.mark.parametrize(
    "bad", [{"date": "2024-01-01 banana"}, {"close": "x"}, {"open": "x"}, {"volume": "x"}, {"volume": "NA"}]
)
def test_bad_text_is_an_error_or_null(spark, bad):
    row = {"date": "2024-01-01", "open": "1", "high": "1", "low": "1", "close": "1", "volume": "1", "ticker": "A", **bad}
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} string" for c in row))
    with pytest.raises(Exception):
        clean.clean_bars(df).collect()
    got = clean.clean_bars(df, strict=False).collect()
    column = next(iter(bad))
    assert got == [] if column in ("date", "close") else got[0][column] is None


def test_long_lists_equal_short_ones_and_are_ranked_in_parts(spark):
    """Beyond the rank limit of the map tasks a ticker is dealt into parts first."""
    df = spark.range(6000).select(
        F.when(F.col("id") < 5000, "A").otherwise("B").alias("ticker"),
        F.date_add(F.lit(dt.date(2000, 1, 1)), F.col("id").cast("int")).alias("date"),
        F.lit(1.0).alias("close"),
        (F.pmod(F.xxhash64("id"), F.lit(700)) / 100.0).alias("daily_return_pct"),
    )
    every = analytics.top_losses_per_ticker(df, 10_000).collect()
    assert len(every) == 6000
    got = analytics.top_losses_per_ticker(df, 1500)
    assert sorted(got.collect()) == sorted(r for r in every if r["rank"] <= 1500)
    parts = got._jdf.queryExecution().optimizedPlan().toString()
    assert parts.count("row_number()") == 2 and "_part" in parts
    short = analytics.top_losses_per_ticker(df, 5)
    assert sorted(short.collect()) == sorted(r for r in every if r["rank"] <= 5)
    assert "_part" not in short._jdf.queryExecution().optimizedPlan().toString()
