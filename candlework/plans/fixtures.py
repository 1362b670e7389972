"""Bars, and variants of them, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlework.operators.features import add_features

# The order priorities serve as the five tickers.
TICKERS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bars(rows: DataFrame, first: Column, last: Column, volume: Column) -> DataFrame:
    """Bars of rows with ticker, date and price; open and close are ``first`` and ``last``."""
    return rows.groupBy("ticker", "date").agg(
        first.alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        last.alias("close"),
        volume.alias("volume"),
    )


def _bars_by(rows: DataFrame, order: str, volume: Column) -> DataFrame:
    """Bars whose open and close are the prices at the smallest and largest ``order``."""
    return _bars(rows, F.min_by("price", order), F.max_by("price", order), volume)


def bars_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five tickers with a long history."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("ticker"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_totalprice").alias("price"),
        "o_orderkey",
    )
    return _bars_by(rows, "o_orderkey", F.count(F.lit(1)))


def bars_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ticker per supplier: many tickers."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("ticker"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_extendedprice").alias("price"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_quantity",
    )
    # l_orderkey and l_linenumber alone do not tell all rows apart. The price is part of
    # the order, so the extreme itself holds it: no second copy goes over the shuffle.
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "price")
    first, last = F.min(order)["price"], F.max(order)["price"]
    bars = _bars(rows, first, last, F.sum(F.col("l_quantity").cast("bigint")))
    # Grouped by number, named afterwards.
    return bars.withColumn("ticker", F.concat(F.lit("S"), F.col("ticker")))


def bars_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five tickers with a short history."""
    rows = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("ticker"),
        F.col("ts").cast("date").alias("date"),
        F.col("value").alias("price"),
        "event_id",
    )
    return _bars_by(rows, "event_id", F.count(F.lit(1)))


def bars_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bars_orders with NULL closes, NaN highs, and second bars for some days."""
    bars = bars_orders(spark, sf_dir)
    day = F.dayofyear("date")
    broken = bars.withColumns(
        {
            "close": F.when(day % 97 != 0, F.col("close")),
            "high": F.when(day % 89 == 0, F.lit(float("nan"))).otherwise(F.col("high")),
        }
    )
    # Each row is emitted once, or twice on a day with a second bar.
    seqs = F.when(day % 101 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return broken.withColumn("seq", F.explode(seqs)).withColumn(
        "close", F.col("close") + (F.col("seq") - 1)
    )


def bars_bad_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = bars_orders(spark, sf_dir)
    bad = F.dayofyear("date") == 200
    return bars.withColumn("close", F.when(bad, 0.0).otherwise(F.col("close")))


def constraint_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Bars and summary tickers that break every declared rule but that for dates."""
    bars = bars_dirty(spark, sf_dir)
    day = F.dayofyear("date")
    ticker = F.when(day % 103 == 0, F.repeat("ticker", 10)).when(day % 107 != 0, F.col("ticker"))
    tickers = bars.select("ticker").distinct()
    copies = F.when(F.col("ticker").startswith("1"), F.array("ticker", "ticker")).when(
        F.col("ticker").startswith("2"), F.array(F.lit(None).cast("string"))
    )
    long = F.array(F.repeat("ticker", 10))
    return bars.withColumn("ticker", ticker), tickers.select(
        F.explode(F.coalesce(copies, long)).alias("ticker")
    )


def enriched_of(bars: DataFrame) -> DataFrame:
    """Features of derived bars, which are unique per ticker and day."""
    return add_features(bars, unique_days=True)


def upsert_pair(enriched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored rows, and a later run that overlaps them by a month."""
    existing = enriched.where(F.col("date") < F.lit("2000-06-01").cast("date"))
    incoming = enriched.where(F.col("date") >= F.lit("2000-05-01").cast("date"))
    return existing, incoming.withColumns(
        {
            "open": F.col("open") + 1,
            "close": F.col("close") + 1,
            "ma_30": F.lit(None).cast("double"),
        }
    )


def landings(bars: DataFrame) -> list[DataFrame]:
    """``bars_orders`` as they may arrive: the past, with gaps and but for one ticker; what
    was missing, restated bars and the last months."""
    old = F.col("date") < F.lit("2001-05-01").cast("date")
    missing = (F.col("ticker") == "2-HIGH") & (F.dayofyear("date") % 50 == 7) | (F.col("ticker") == "5-LOW")
    restated = F.col("ticker").isin("1-URGENT", "3-MEDIUM") & (F.trunc("date", "MM") == F.lit("1998-05-01").cast("date"))
    again = bars.where(restated).withColumns({"open": F.col("open") + 5, "close": F.col("close") + 1})
    return [bars.where(old & ~missing), bars.where(~old | missing).unionByName(again)]
