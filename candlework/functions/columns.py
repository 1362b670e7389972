"""Column expressions and column-wise steps over bars."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlework.functions.numeric import (
    PRICE_DIGITS,
    from_units,
    percent_of_units,
    ratio_of_units,
    round_to,
    to_units,
)

PRICE_COLUMNS = ["open", "high", "low", "close"]


# The texts that count as missing where a column arrives as text.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# A date, after which a time of day and a zone may follow.
DATE_TEXT = (
    r"^\s*\d{4}-\d{1,2}-\d{1,2}"
    r"([ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?\s*(Z|UTC|[+-]\d{2}:?\d{2})?)?\s*$"
)


def snake_case(name: str) -> str:
    return name.lower().replace(" ", "_")


def snake_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_case(c) for c in df.columns])


def missing_to_null(text: Column) -> Column:
    """NULL for a text that says that the value is missing."""
    return F.when(~text.isin(NULL_TOKENS), text)


def tag_ticker(df: DataFrame, ticker: str) -> DataFrame:
    return df.withColumn("ticker", F.lit(ticker))


def landing_key(ticker: Column, run_date: dt.date) -> Column:
    """Name of the raw file of one ticker and one run."""
    return F.concat(
        F.replace(ticker, F.lit("."), F.lit("_")),
        F.lit("_"),
        F.date_format(F.lit(run_date), "yyyy-MM-dd"),
        F.lit(".csv"),
    )


def parse_date(value: Column, strict: bool = True) -> Column:
    """Text to DATE; a time of day may follow. Bad text is an error, or NULL when
    not ``strict``."""
    text = value.cast("string")
    shaped = text.rlike(DATE_TEXT)
    if not strict:
        return F.when(shaped, text.try_cast("date"))
    bad = F.raise_error(F.concat(F.lit("not a date: "), text)).cast("date")
    return F.when(shaped, text.cast("date")).when(text.isNotNull(), bad)


def round_prices(df: DataFrame, columns: list[str] = PRICE_COLUMNS) -> DataFrame:
    return df.withColumns({c: round_to(F.col(c), 2) for c in columns})


def cast_volume(volume: Column, strict: bool = True) -> Column:
    """Volume as a long, cut toward zero. NULL, or a value that does not fit, is an
    error, or NULL when not ``strict``."""
    if not strict:
        return volume.try_cast("bigint")
    whole = volume.cast("bigint")
    missing = F.raise_error(F.lit("volume is missing")).cast("bigint")
    return F.when(volume.isNull(), missing).otherwise(whole)


def daily_range(high: Column, low: Column) -> Column:
    """Difference of two prices in cents."""
    return from_units(to_units(high - low, PRICE_DIGITS), PRICE_DIGITS)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN is an ordinary value to Spark and sorts highest; make it NULL."""
    floats = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]
    if not floats:
        return df
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def price_range_pct(high: Column, low: Column) -> Column:
    top, bottom = to_units(high, PRICE_DIGITS), to_units(low, PRICE_DIGITS)
    return percent_of_units(top - bottom, bottom, 2)


def volatility_pct(day_range: Column, close: Column) -> Column:
    return percent_of_units(to_units(day_range, PRICE_DIGITS), to_units(close, PRICE_DIGITS), 2)


def volume_ratio(volume: Column, average: Column) -> Column:
    """Exact for volumes of up to 4e14; the average has two decimals at most."""
    return ratio_of_units(volume.cast("long") * 100, to_units(average, 2), 2)


def ma_signal(short: Column, long: Column) -> Column:
    return (
        F.when(short > long, "BULLISH")
        .when(short < long, "BEARISH")
        .otherwise("NEUTRAL")
    )


def month_bucket(date: Column) -> Column:
    return F.trunc(date, "MM")
