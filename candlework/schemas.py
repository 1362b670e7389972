"""Declared schemas of the bar tables.

In flight, prices and returns are doubles; the decimal types below are applied
once, by ``conform_schema``, where a table is written.
"""

from pyspark.sql import types as T

PRICE = T.DecimalType(12, 2)
RETURN = T.DecimalType(10, 4)

# Metadata of a text column: its declared number of characters.
MAX_LENGTH = "max_length"

# Raw bars after typing. ``seq`` is the landing order of a row; it decides which
# of several rows for one (ticker, date) came last.
BAR_COLUMNS = ["ticker", "date", "open", "high", "low", "close", "volume"]

BARS = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.LongType()),
    ]
)

ENRICHED = T.StructType(
    [
        T.StructField("ticker", T.StringType(), False, {MAX_LENGTH: 20}),
        T.StructField("date", T.DateType(), False),
        T.StructField("open", PRICE),
        T.StructField("high", PRICE),
        T.StructField("low", PRICE),
        T.StructField("close", PRICE, False),
        T.StructField("volume", T.LongType()),
        T.StructField("daily_return_pct", RETURN),
        T.StructField("ma_7", PRICE),
        T.StructField("ma_30", PRICE),
        T.StructField("daily_range", PRICE),
    ]
)

SUMMARY = T.StructType(
    [
        T.StructField("ticker", T.StringType(), False, {MAX_LENGTH: 20}),
        T.StructField("from_date", T.DateType()),
        T.StructField("to_date", T.DateType()),
        T.StructField("total_trading_days", T.IntegerType()),
        T.StructField("avg_close", PRICE),
        T.StructField("all_time_high", PRICE),
        T.StructField("all_time_low", PRICE),
        T.StructField("avg_daily_volume", T.DecimalType(20, 2)),
        T.StructField("avg_daily_return_pct", RETURN),
    ]
)

ENRICHED_KEYS = ["ticker", "date"]
SUMMARY_KEYS = ["ticker"]

# Columns a rerun may change; every other column keeps its first loaded value.
ENRICHED_UPDATES = ["close", "daily_return_pct", "ma_7", "ma_30", "daily_range"]
SUMMARY_UPDATES = [
    "to_date",
    "total_trading_days",
    "avg_close",
    "all_time_high",
    "all_time_low",
    "avg_daily_volume",
    "avg_daily_return_pct",
]
