"""Cleaning and typing of raw bars."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlework.functions.columns import (
    PRICE_COLUMNS,
    cast_volume,
    missing_to_null,
    nan_to_null,
    parse_date,
    round_prices,
)
from candlework.operators.ordered import range_sorted

CRITICAL = ["date", "close", "ticker"]


def drop_null_critical(
    df: DataFrame, observation: Observation | None = None
) -> DataFrame:
    """Drop rows without date, close or ticker.

    ``observation`` receives ``rows_before`` and ``rows_after`` when the plan
    runs, so the counts cost no pass of their own.
    """
    kept = F.col("date").isNotNull() & F.col("close").isNotNull()
    kept = kept & F.col("ticker").isNotNull()
    if observation is not None:
        df = df.observe(
            observation,
            F.count(F.lit(1)).alias("rows_before"),
            F.count_if(kept).alias("rows_after"),
        )
    return df.where(kept)


def clean_bars(
    df: DataFrame, strict: bool = True, observation: Observation | None = None
) -> DataFrame:
    """Raw bars, possibly all text, to typed bars.

    Text such as NA or null is NULL in every column. ``strict`` makes other text that
    is no date or number, and missing volumes, errors; otherwise they become NULL. A
    row with a NULL date or close is dropped like any other.
    """
    # Volume text is read as a decimal: a double is not exact above 2**53.
    types = {"date": "string", "ticker": "string", "volume": "decimal(38,6)"}

    def typed(c: str) -> Column:
        text, kind = missing_to_null(F.col(c)), types.get(c, "double")
        return text.cast(kind) if strict else text.try_cast(kind)

    text = {
        c: typed(c)
        for c in [*CRITICAL, *PRICE_COLUMNS, "volume"]
        if isinstance(df.schema[c].dataType, T.StringType)
    }
    df = nan_to_null(df.withColumns(text) if text else df)
    if not isinstance(df.schema["date"].dataType, T.DateType):
        df = df.withColumn("date", parse_date(F.col("date"), strict))
    df = round_prices(drop_null_critical(df, observation))
    return df.withColumn("volume", cast_volume(F.col("volume"), strict))


def sort_bars(df: DataFrame) -> DataFrame:
    """Rows in ticker, date order, for output; windows do not need it."""
    return range_sorted(df, "ticker", "date")


def date_window(
    df: DataFrame, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """Rows with ``start <= date < end``, where given; reaches the scan as a filter."""
    if start is not None:
        df = df.where(F.col("date") >= F.lit(start))
    if end is not None:
        df = df.where(F.col("date") < F.lit(end))
    return df


def dedup_keep_last(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """One row per key: the one with the highest ``seq``.

    ``seq`` has to be unique within a key. Spark keeps one row per key in each
    map task before it shuffles (WindowGroupLimit), so a key with very many
    copies does not pile up in one reducer.
    """
    last = Window.partitionBy(*keys).orderBy(F.col(seq).desc())
    return (
        df.withColumn("_rank", F.row_number().over(last))
        .where("_rank = 1")
        .drop("_rank")
    )
