"""Features on small frames whose results are worked out by hand or by loops."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from candlework.functions.numeric import divide, mean, round_to
from candlework.operators.features import add_features, golden_cross_events
from candlework.operators.ordered import hot_tickers, range_sorted

SCHEMA = "ticker string, date date, open double, high double, low double, close double, volume long, seq int"
DAY = dt.date(2024, 1, 1)


def frame(spark, closes, ticker="A"):
    rows = [
        (ticker, DAY + dt.timedelta(days=i), 1.0, 2.0, 1.0, c, 10, i)
        for i, c in enumerate(closes)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def half_up(value: Fraction, digits: int) -> float:
    exact = Decimal(value.numerator) / Decimal(value.denominator)
    return float(exact.quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


def brute_force(rows):
    """(ticker, date, seq) -> (return, ma_7, ma_30), one ticker after another."""
    results = {}
    for ticker in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == ticker), key=lambda r: (r[1], r[7]))
        closes = [None if r[5] is None else Fraction(str(r[5])) for r in own]
        for i, r in enumerate(own):
            back = closes[i - 1] if i else None
            change = None
            if closes[i] is not None and back:
                change = half_up((closes[i] - back) / back * 100, 4)
            means = []
            for n in (7, 30):
                frame_ = closes[i - n + 1 : i + 1] if i >= n - 1 else []
                whole = len(frame_) == n and None not in frame_
                means.append(half_up(sum(frame_) / n, 2) if whole else None)
            results[ticker, r[1], r[7]] = (change, *means)
    return results


def collected(df):
    return {
        (r.ticker, r.date, r.seq): (r.daily_return_pct, r.ma_7, r.ma_30) for r in df.collect()
    }


@pytest.mark.parametrize("n", [1, 6, 7, 29, 30, 31])
def test_averages_start_when_the_frame_is_full(spark, n):
    rows = add_features(frame(spark, [float(i + 1) for i in range(n)])).orderBy("date").collect()
    assert [r.ma_7 is not None for r in rows] == [i >= 6 for i in range(n)]
    assert [r.ma_30 is not None for r in rows] == [i >= 29 for i in range(n)]
    if n >= 7:
        assert rows[6].ma_7 == 4.0
    assert rows[0].daily_return_pct is None


def test_tickers_do_not_bleed(spark):
    both = frame(spark, [1.0, 2.0]).union(frame(spark, [10.0, 5.0], "B"))
    rows = add_features(both).orderBy("ticker", "date").collect()
    assert [r.daily_return_pct for r in rows] == [None, 100.0, None, -50.0]


def test_rows_without_ticker_are_left_out(spark):
    df = frame(spark, [1.0, 2.0]).union(frame(spark, [3.0] * 5, None))
    for hot_rows in (1, 10):
        assert add_features(df, hot_rows=hot_rows).count() == 2


def test_previous_close_of_zero_gives_null(spark):
    rows = add_features(frame(spark, [0.0, 5.0, 10.0])).orderBy("date").collect()
    assert [r.daily_return_pct for r in rows] == [None, None, 100.0]


def test_null_close_empties_the_frames_around_it(spark):
    closes = [float(i) for i in range(1, 17)]
    closes[3] = None
    rows = add_features(frame(spark, closes)).orderBy("date").collect()
    assert [r.ma_7 is not None for r in rows] == [i >= 10 for i in range(16)]
    assert rows[3].daily_return_pct is None and rows[4].daily_return_pct is None


def test_duplicate_days_count_unless_removed_first(spark):
    rows = [
        ("A", DAY, 1.0, 2.0, 1.0, 10.0, 1, 1),
        ("A", DAY, 1.0, 2.0, 1.0, 20.0, 1, 2),
        ("A", DAY + dt.timedelta(days=1), 1.0, 2.0, 1.0, 30.0, 1, 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    kept = add_features(df, ["date", "seq"]).orderBy("date", "seq").collect()
    assert [r.daily_return_pct for r in kept] == [None, 100.0, 50.0]
    first = add_features(df, ["date", "seq"], dedup_first=True).orderBy("date").collect()
    assert [(r.close, r.daily_return_pct) for r in first] == [(20.0, None), (30.0, 50.0)]


def test_ties_round_away_from_zero(spark):
    values = spark.createDataFrame([(5, 2), (-5, 2), (5, -2), (1, 3), (7, 0)], "a long, b long")
    got = [r.q for r in values.select(divide(F.col("a"), F.col("b")).alias("q")).collect()]
    assert got == [3, -3, -3, 0, None]
    cents = spark.createDataFrame([(0.125,), (-0.125,), (2.5,)], "x double")
    got = [r.y for r in cents.select(round_to(F.col("x"), 2).alias("y")).collect()]
    assert got == [0.13, -0.13, 2.5]
    large = spark.range(4).select((F.lit(9e16) + F.col("id") * 0).alias("x"))
    assert large.agg(mean(F.col("x"), 2).alias("m")).first().m == 9e16
    pair = spark.createDataFrame([(0.01,), (0.02,), (None,)], "x double")
    assert pair.agg(mean(F.col("x"), 2).alias("m")).first().m == 0.02
    assert pair.where("x > 1").agg(mean(F.col("x"), 2).alias("m")).first().m is None


def random_rows(seed, days, copies):
    """One ticker with most rows, half of them copies of a single day, and two others."""
    rng = random.Random(seed)
    rows = []
    for ticker, n in (("HOT", days), ("B", 40), ("C", 3)):
        for i in range(n):
            day = DAY + dt.timedelta(days=i)
            close = None if rng.random() < 0.01 else rng.randrange(1, 100_000) / 100
            rows.append((ticker, day, 1.0, 2.0, 1.0, close, 10, 0))
    day = DAY + dt.timedelta(days=days // 2)
    rows += [
        ("HOT", day, 1.0, 2.0, 1.0, rng.randrange(1, 100_000) / 100, 10, i + 1)
        for i in range(copies)
    ]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot_rows", [1, 29, 30, 64, 250, 10**6])
def test_hot_ticker_equals_brute_force(spark, hot_rows):
    rows = random_rows(hot_rows, 300, 300)
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = add_features(df, ["date", "seq"], hot_rows=hot_rows)
    assert collected(got) == brute_force(rows)
    assert got.count() == len(rows)


def test_identical_copies_of_a_hot_ticker_are_all_kept(spark):
    """Rows equal in every column: nothing but a scan id can split them."""
    one = frame(spark, [5.0]).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(500))))
    df = one.drop("n", "seq")
    uncut = add_features(df).groupBy("daily_return_pct", "ma_7", "ma_30").count()
    cut = add_features(df, hot_rows=40).groupBy("daily_return_pct", "ma_7", "ma_30").count()
    assert sorted(map(str, cut.collect())) == sorted(map(str, uncut.collect()))


def test_ties_do_not_depend_on_partitioning_or_size(spark):
    """Copies of a day that no sequence column tells apart."""
    df = spark.createDataFrame(random_rows(5, 100, 100), SCHEMA).drop("seq")
    results = [
        sorted(map(str, add_features(df.repartition(n), hot_rows=hot_rows).collect()))
        for n, hot_rows in ((1, 1000), (5, 1000), (3, 40))
    ]
    assert results[0] == results[1] == results[2]


def test_range_sort_spreads_copies(spark):
    df = spark.range(20_000).select(
        F.lit("A").alias("ticker"), F.lit(DAY).alias("date"), F.lit(1.0).alias("close")
    )
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, False)
    try:
        spread = range_sorted(df, "ticker", "date")
        sizes = spread.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset(merge)
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 10_000


def test_hot_tickers_are_those_above_the_bound(spark):
    df = spark.createDataFrame([("A",)] * 5 + [("B",)] * 3 + [(None,)], "ticker string")
    for bound, expected in ((4, {"A"}), (2, {"A", "B"}), (5, set())):
        assert {r.ticker for r in hot_tickers(df, bound).collect()} == expected


def test_any_number_of_hot_tickers(spark):
    df = spark.range(36_000).selectExpr("'T' || id % 12000 AS ticker")
    assert hot_tickers(df, 2).count() == 12_000


def test_features_do_not_depend_on_partitioning(spark):
    rows = random_rows(3, 200, 0)
    one = spark.createDataFrame(rows, SCHEMA)
    assert collected(add_features(one.coalesce(1))) == collected(
        add_features(one.repartition(13).orderBy(F.desc("close")))
    )


def test_golden_cross(spark):
    rows = [
        ("A", DAY + dt.timedelta(days=i), 1.0, short, long)
        for i, (short, long) in enumerate(
            [(None, None), (1.0, 2.0), (3.0, 2.0), (4.0, 2.0), (2.0, 2.0), (2.5, 2.0)]
        )
    ]
    df = spark.createDataFrame(rows, "ticker string, date date, close double, ma_7 double, ma_30 double")
    for options in ({}, {"unique_days": False, "hot_rows": 2}):
        got = golden_cross_events(df, **options).orderBy("date").collect()
        assert [(r.date - DAY).days for r in got] == [2, 5]


@pytest.mark.parametrize("operator", [add_features, golden_cross_events])
def test_days_said_to_be_unique_are_verified(spark, operator):
    """In the same window: no job runs before the action, and the plan has one shuffle and one sort."""
    df = frame(spark, [1.0, 2.0, 3.0]).unionByName(frame(spark, [4.0], "B"))
    df = df.withColumns({"ma_7": F.lit(1.0), "ma_30": F.lit(1.0)})
    good = operator(df.repartition(3), unique_days=True)
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(ticker") == 1
    assert good.count() >= 0
    doubled = operator(df.unionByName(df.where("ticker = 'A' AND seq = 1")), unique_days=True)
    with pytest.raises(PySparkException, match="several bars of A on 2024-01-02"):
        doubled.collect()
    with pytest.raises(ValueError, match="in order of date"):
        operator(df, ["close"], unique_days=True)


def test_missing_dates_are_not_a_doubled_day(spark):
    df = frame(spark, [1.0, 2.0, 3.0]).withColumn("date", F.when(F.col("seq") > 1, F.col("date")))
    assert add_features(df, unique_days=True).count() == 3


def test_further_columns_of_the_same_windows(spark):
    df = add_features(
        frame(spark, [1.0, 2.0, 3.0]), "date", also=lambda w: {"so_far": F.max("close").over(w.rowsBetween(-1, 0))}
    )
    assert sorted(r.so_far for r in df.collect()) == [1.0, 2.0, 3.0]
    assert not [c for c in df.columns if c.startswith("_")]
