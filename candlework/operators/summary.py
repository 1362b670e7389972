"""Aggregates over enriched bars."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlework.functions.numeric import (
    PRICE_DIGITS,
    RETURN_DIGITS,
    exact_sum,
    mean,
    mean_of_units,
    to_units,
)

_TOTAL = T.DecimalType(38, 0)
# The summary as sums of whole units, extremes and counts: states of parts add up to that
# of the whole, in any order.
STATE = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("from_date", T.DateType()),
        T.StructField("to_date", T.DateType()),
        T.StructField("n_days", T.LongType()),
        T.StructField("close_total", _TOTAL),
        T.StructField("n_closes", T.LongType()),
        T.StructField("all_time_high", T.DoubleType()),
        T.StructField("all_time_low", T.DoubleType()),
        T.StructField("volume_total", _TOTAL),
        T.StructField("n_volumes", T.LongType()),
        T.StructField("return_total", _TOTAL),
        T.StructField("n_returns", T.LongType()),
    ]
)


def ticker_summary(enriched: DataFrame) -> DataFrame:
    """One row per ticker. High and low are those of the close."""
    return enriched.groupBy("ticker").agg(
        F.min("date").alias("from_date"),
        F.max("date").alias("to_date"),
        F.count("date").alias("total_trading_days"),
        mean(F.col("close"), PRICE_DIGITS).alias("avg_close"),
        F.max("close").alias("all_time_high"),
        F.min("close").alias("all_time_low"),
        mean(F.col("volume"), 0).alias("avg_daily_volume"),
        mean(F.col("daily_return_pct"), RETURN_DIGITS).alias("avg_daily_return_pct"),
    )


def _states(rows: DataFrame, counted: Column, gained: Column, lost: Column) -> DataFrame:
    """States of the ``counted`` rows, and the change of the returns from ``lost`` to ``gained`` units."""

    def of(c: str) -> Column:
        return F.when(counted, F.col(c))

    def total(units: Column) -> Column:
        return F.coalesce(exact_sum(units).cast(_TOTAL), F.lit(0).cast(_TOTAL))

    def there(units: Column) -> Column:
        return units.isNotNull().cast("long")

    cents, volume = to_units(of("close"), PRICE_DIGITS), of("volume").cast("long")
    return rows.groupBy("ticker").agg(
        F.min(of("date")).alias("from_date"),
        F.max(of("date")).alias("to_date"),
        F.count(of("date")).alias("n_days"),
        total(cents).alias("close_total"),
        F.count(cents).alias("n_closes"),
        F.max(of("close")).alias("all_time_high"),
        F.min(of("close")).alias("all_time_low"),
        total(volume).alias("volume_total"),
        F.count(volume).alias("n_volumes"),
        total(F.coalesce(gained, F.lit(0)) - F.coalesce(lost, F.lit(0))).alias("return_total"),
        F.sum(there(gained) - there(lost)).alias("n_returns"),
    )


def summary_state(enriched: DataFrame) -> DataFrame:
    """The ``STATE`` of each ticker; ``summary_of`` it is the ``ticker_summary``."""
    units = to_units(F.col("daily_return_pct"), RETURN_DIGITS)
    return _states(enriched, F.lit(True), units, F.lit(None).cast("long"))


def state_of_changes(rows: DataFrame) -> DataFrame:
    """What ``rows`` add to the states: all of those that are new (``is_new``), and the
    difference of returns of those that are not (``return_units`` is the return so far)."""
    units = to_units(F.col("daily_return_pct"), RETURN_DIGITS)
    return _states(rows, F.col("is_new"), units, F.col("return_units"))


def merge_states(states: DataFrame, *more: Column) -> DataFrame:
    """One state per ticker of any number of them; ``more`` aggregates may be added."""
    merge = {"from_date": F.min, "to_date": F.max, "all_time_high": F.max, "all_time_low": F.min}
    return states.groupBy("ticker").agg(
        *[
            merge.get(f.name, F.sum)(f.name).cast(f.dataType).alias(f.name)
            for f in STATE.fields
            if f.name != "ticker"
        ],
        *more,
    )


def summary_of(state: DataFrame) -> DataFrame:
    """The summary rows of merged states."""

    def average(total: str, n: str, digits: int) -> Column:
        return mean_of_units(F.col(total), F.col(n), digits)

    return state.select(
        "ticker",
        "from_date",
        "to_date",
        F.col("n_days").alias("total_trading_days"),
        average("close_total", "n_closes", PRICE_DIGITS).alias("avg_close"),
        "all_time_high",
        "all_time_low",
        average("volume_total", "n_volumes", 0).alias("avg_daily_volume"),
        average("return_total", "n_returns", RETURN_DIGITS).alias("avg_daily_return_pct"),
    )


def table_row_counts(**tables: DataFrame) -> DataFrame:
    """``table_name, n_rows`` of each named table."""
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n_rows"))
        one = one.select(F.lit(name).alias("table_name"), "n_rows")
        counts = one if counts is None else counts.unionByName(one)
    return counts


def ma_population(enriched: DataFrame) -> DataFrame:
    return enriched.agg(
        F.count(F.lit(1)).alias("total"),
        F.count("ma_7").alias("ma7_populated"),
        F.count("ma_30").alias("ma30_populated"),
    )


def date_extent(enriched: DataFrame) -> DataFrame:
    return enriched.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Number of keys that occur more than once."""
    return (
        df.groupBy(*keys)
        .count()
        .where("count > 1")
        .agg(F.count(F.lit(1)).alias("n_duplicates"))
    )


def distinct_tickers(df: DataFrame) -> DataFrame:
    return df.select("ticker").distinct()


def null_critical_count(df: DataFrame) -> DataFrame:
    missing = F.col("ticker").isNull() | F.col("date").isNull() | F.col("close").isNull()
    return df.agg(F.count_if(missing).alias("n_null"))


def bad_price_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(F.col("close") <= 0).alias("n_bad"))
