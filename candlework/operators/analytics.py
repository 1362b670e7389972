"""Analyst questions over the enriched and the summary table.

Every ordered result ends its order with ticker and date, so equal values cannot
swap. Limits are arguments; ``None`` returns all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlework.functions.columns import (
    ma_signal,
    month_bucket,
    price_range_pct,
    volatility_pct,
    volume_ratio,
)
from candlework.functions.numeric import (
    PRICE_DIGITS,
    RETURN_DIGITS,
    from_units,
    mean,
    round_to,
    stddev,
    to_units,
)


# Parts of a ticker whose rows are ranked for a long list.
SALTS = 64


def _top(df: DataFrame, order: list[Column], n: int | None) -> DataFrame:
    ordered = df.orderBy(*order, "ticker", "date")
    return ordered if n is None else ordered.limit(n)


def summary_overview(summary: DataFrame) -> DataFrame:
    """Q1: the summary with the range of closes in percent of the low."""
    return summary.select(
        "ticker",
        "from_date",
        "to_date",
        "total_trading_days",
        "avg_close",
        "all_time_high",
        "all_time_low",
        price_range_pct(F.col("all_time_high"), F.col("all_time_low")).alias(
            "price_range_pct"
        ),
        "avg_daily_return_pct",
    ).orderBy(F.desc_nulls_first("avg_daily_return_pct"), "ticker")


def _returns(enriched: DataFrame) -> DataFrame:
    return enriched.where(F.col("daily_return_pct").isNotNull()).select(
        "ticker", "date", "close", "daily_return_pct"
    )


def top_gains(enriched: DataFrame, n: int | None = 10) -> DataFrame:
    """Q2: the days with the highest return over all tickers."""
    return _top(_returns(enriched), [F.desc("daily_return_pct")], n)


def top_losses(enriched: DataFrame, n: int | None = 10) -> DataFrame:
    """Q3: the days with the lowest return over all tickers."""
    return _top(_returns(enriched), [F.asc("daily_return_pct")], n)


def _first_per_ticker(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each ticker, with their ``rank``.

    Up to spark.sql.optimizer.windowGroupLimitThreshold the limit is applied in the map
    tasks too (WindowGroupLimit): few rows of even the largest ticker are shuffled. For a
    larger n each ticker is dealt into ``SALTS`` parts first; the first n of all are among
    the first n of each, which is what the last window sorts.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    columns = df.columns
    if n > limit:
        part = Window.partitionBy("ticker", "_part").orderBy(*order)
        dealt = df.withColumn("_part", F.pmod(F.xxhash64(*columns), F.lit(SALTS)))
        df = dealt.withColumn("_rank", F.row_number().over(part)).where(F.col("_rank") <= n).select(*columns)
    window = Window.partitionBy("ticker").orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= n)


def top_gains_per_ticker(enriched: DataFrame, n: int = 10) -> DataFrame:
    return _first_per_ticker(
        _returns(enriched), [F.desc("daily_return_pct"), F.asc("date")], n
    )


def top_losses_per_ticker(enriched: DataFrame, n: int = 10) -> DataFrame:
    return _first_per_ticker(
        _returns(enriched), [F.asc("daily_return_pct"), F.asc("date")], n
    )


def monthly_close(enriched: DataFrame) -> DataFrame:
    """Q4: closes and volume per ticker and month."""
    monthly = enriched.groupBy("ticker", month_bucket(F.col("date")).alias("month")).agg(
        mean(F.col("close"), PRICE_DIGITS).alias("avg_monthly_close"),
        round_to(F.max("close"), PRICE_DIGITS).alias("monthly_high"),
        round_to(F.min("close"), PRICE_DIGITS).alias("monthly_low"),
        F.sum("volume").alias("total_monthly_volume"),
    )
    return monthly.orderBy("ticker", "month")


def ma_signals(enriched: DataFrame) -> DataFrame:
    """The signal of every day on which both averages exist."""
    known = F.col("ma_7").isNotNull() & F.col("ma_30").isNotNull()
    return enriched.where(known).select(
        "ticker",
        "date",
        "close",
        "ma_7",
        "ma_30",
        ma_signal(F.col("ma_7"), F.col("ma_30")).alias("signal"),
    )


def ma_regime(enriched: DataFrame, n: int | None = 20) -> DataFrame:
    """Q5: signals by ticker, latest first."""
    ordered = ma_signals(enriched).orderBy("ticker", F.desc("date"))
    return ordered if n is None else ordered.limit(n)


def most_volatile(enriched: DataFrame, n: int | None = 10) -> DataFrame:
    """Q6: the days with the largest range relative to the close."""
    days = enriched.where(F.col("daily_range").isNotNull()).select(
        "ticker",
        "date",
        "daily_range",
        volatility_pct(F.col("daily_range"), F.col("close")).alias("volatility_pct"),
    )
    return _top(days, [F.desc("volatility_pct")], n)


def _performance(days: DataFrame) -> DataFrame:
    units = to_units(F.col("daily_return_pct"), RETURN_DIGITS)
    return (
        days.groupBy("ticker")
        .agg(
            F.min("date").alias("period_start"),
            F.max("date").alias("period_end"),
            mean(F.col("daily_return_pct"), RETURN_DIGITS).alias("avg_daily_return"),
            from_units(F.sum(units), RETURN_DIGITS).alias("cumulative_return_pct"),
            stddev(F.col("daily_return_pct"), RETURN_DIGITS).alias("volatility_stddev"),
        )
        .orderBy(F.desc("cumulative_return_pct"), "ticker")
    )


def recent_days(enriched: DataFrame, days: int = 30) -> DataFrame:
    """Rows from ``days`` calendar days before the latest date of the table on."""
    cutoff = enriched.select(F.date_sub(F.max("date"), days))
    return enriched.where(F.col("date") >= cutoff.scalar())


def recent_performance(enriched: DataFrame, days: int = 30) -> DataFrame:
    """Q7: returns per ticker over the last ``days`` calendar days."""
    return performance(recent_days(enriched.select("ticker", "date", "daily_return_pct"), days))


def performance(days: DataFrame) -> DataFrame:
    """Returns per ticker over the given days."""
    return _performance(days.where(F.col("daily_return_pct").isNotNull()))


def last_30_trading_days(enriched: DataFrame, n: int = 30) -> DataFrame:
    """Q7 over each ticker's own last ``n`` rows."""
    rows = _first_per_ticker(_returns(enriched), [F.desc("date")], n)
    return _performance(rows)


def join_summary(enriched: DataFrame, summary: DataFrame) -> DataFrame:
    """Each bar with its ticker's average volume.

    No hint and no count: the size of the summary, of its files or as measured at
    run time, decides whether it is broadcast. Otherwise both sides are shuffled by
    ticker, and adaptive execution splits a hot ticker's partition
    (spark.sql.adaptive.skewJoin).
    """
    return enriched.join(summary.select("ticker", "avg_daily_volume"), "ticker")


def volume_spikes(
    enriched: DataFrame, summary: DataFrame, n: int | None = 15
) -> DataFrame:
    """Q8: days with more than twice the ticker's average volume."""
    bars = enriched.select("ticker", "date", "volume")
    spikes = (
        join_summary(bars, summary)
        .where(F.col("volume") > F.col("avg_daily_volume") * 2)
        .select(
            "ticker",
            "date",
            "volume",
            round_to(F.col("avg_daily_volume"), 0).alias("avg_volume"),
            volume_ratio(F.col("volume"), F.col("avg_daily_volume")).alias("volume_ratio"),
        )
    )
    return _top(spikes, [F.desc("volume_ratio")], n)


def sample_bars(enriched: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows by ticker and date, in the columns worth a glance."""
    return _top(
        enriched.select("ticker", "date", "close", "daily_return_pct", "ma_7", "ma_30"),
        [],
        n,
    )
