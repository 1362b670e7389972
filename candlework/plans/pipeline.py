"""The daily batch: raw files to tables to a quality report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession

from candlework.operators.clean import clean_bars
from candlework.operators.features import add_features
from candlework.operators.quality import quality_report
from candlework.operators.summary import ticker_summary
from candlework.schemas import (
    BAR_COLUMNS,
    ENRICHED,
    ENRICHED_KEYS,
    ENRICHED_UPDATES,
    SUMMARY,
    SUMMARY_KEYS,
    SUMMARY_UPDATES,
)
from candlework.session import run_scratch
from candlework.sources.readers import read_bars_csv, read_summary_csv, read_table
from candlework.sources.writers import (
    enriched_slice,
    summary_slice,
    upsert_table,
    write_enriched,
    write_summary,
)


def transform(
    spark: SparkSession,
    raw_path: str,
    root: str,
    columns: Sequence[str] | None = None,
    observation: Observation | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Raw CSV to the two results below ``<root>/processed``; returns both as read back.

    ``columns`` is the header that all files are known to have; without it the
    headers are looked up, which reads the text twice. ``observation`` receives the
    numbers of rows before and after cleaning. The typed bars are written first: the size check and the windows then read
    Parquet columns, and the text is parsed once.
    """
    bars = clean_bars(read_bars_csv(spark, raw_path, columns), observation=observation)
    bars.select(*BAR_COLUMNS, "seq").write.mode("overwrite").parquet(f"{root}/typed")
    bars = spark.read.parquet(f"{root}/typed")
    enriched = add_features(bars, ["date", "seq"])
    processed = f"{root}/processed"
    enriched_path = f"{processed}/enriched_stocks.parquet"
    write_enriched(enriched, enriched_path)
    # The summary aggregates the same rows, before duplicates are removed.
    enriched = spark.read.parquet(enriched_path)
    summary_path = f"{processed}/ticker_summary.csv"
    write_summary(ticker_summary(enriched), summary_path)
    return enriched, read_summary_csv(spark, summary_path)


def load(enriched: DataFrame, summary: DataFrame, root: str) -> None:
    """Upsert both results into the tables below ``<root>/tables``."""
    upsert_table(
        enriched,
        f"{root}/tables/enriched_stocks",
        ENRICHED,
        ENRICHED_KEYS,
        ENRICHED_UPDATES,
        enriched_slice(),
        last_by="seq",
    )
    upsert_table(
        summary,
        f"{root}/tables/ticker_summary",
        SUMMARY,
        SUMMARY_KEYS,
        SUMMARY_UPDATES,
        summary_slice(),
    )


def tables(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    return (
        read_table(spark, f"{root}/tables/enriched_stocks", ENRICHED),
        read_table(spark, f"{root}/tables/ticker_summary", SUMMARY),
    )


def run(
    spark: SparkSession,
    raw_path: str,
    root: str,
    expected: Sequence[str],
    as_of: dt.date,
    start: dt.date,
    columns: Sequence[str] | None = None,
    observation: Observation | None = None,
) -> DataFrame:
    """Transform, load and check; returns the quality report.

    Every run works on all raw files; see ``daily`` for runs over the new ones alone.
    """
    with run_scratch(spark):
        load(*transform(spark, raw_path, root, columns, observation), root)
    return quality_report(*tables(spark, root), expected, as_of, start)
