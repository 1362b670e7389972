"""Writers of raw bar files and bar tables.

Rows are sorted within each task, so that Parquet's min/max statistics let a
filter on ticker or date skip most row groups. Where files are kept in one folder
per ticker or month, rows are brought together by a rebalance: adaptive execution
merges small folders into one task and splits a large one over several.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from candlework.functions.columns import landing_key, nan_to_null
from candlework.operators.clean import date_window, dedup_keep_last
from candlework.operators.upsert import conform_schema, declared_types, merge_unique, unique_rows
from candlework.session import stored, tasks_a_core
from candlework.sources.readers import read_if_there

RECORDS_PER_FILE = 5_000_000
SUMMARY_BUCKETS = 16
# Adaptive execution merges small partitions down to this number, not below it.
LEAST_TASKS = "spark.sql.adaptive.coalescePartitions.minPartitionNum"


def _by_folder(df: DataFrame, folder: str, *order: str) -> DataFrame:
    return df.hint("rebalance", F.col(folder)).sortWithinPartitions(folder, *order)


def land_raw(
    df: DataFrame,
    path: str,
    run_date: dt.date,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> None:
    """Replace the raw files: one folder per ticker, named with the run date.

    The ticker stays inside the files. ``start`` and ``end``, each by itself, limit
    the dates. Files cost more than their bytes, so the tickers are dealt over several
    tasks a core: few tasks of equal bytes would leave most cores idle during the last.
    """
    keyed = date_window(df, start, end).withColumn("landing_key", landing_key(F.col("ticker"), run_date))
    with tasks_a_core(df.sparkSession, LEAST_TASKS):
        (
            _by_folder(keyed, "landing_key", "date")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .option("header", True)
            .option("maxRecordsPerFile", RECORDS_PER_FILE)
            .partitionBy("landing_key")
            .csv(path)
        )


def write_enriched(enriched: DataFrame, path: str) -> None:
    """No shuffle: rows that come from the feature windows are in this order already."""
    (
        enriched.sortWithinPartitions("ticker", "date")
        .write.mode("overwrite")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .parquet(path)
    )


def write_summary(summary: DataFrame, path: str) -> None:
    """CSV with header. Adaptive execution merges few rows into one file."""
    summary.write.mode("overwrite").option("header", True).csv(path)


def write_outputs(enriched: DataFrame, summary: DataFrame, root: str) -> None:
    write_enriched(enriched, f"{root}/enriched_stocks.parquet")
    write_summary(summary, f"{root}/ticker_summary.csv")


def publish_lake(
    raw: DataFrame, enriched: DataFrame, summary: DataFrame, root: str, run_date: dt.date
) -> None:
    """Write raw bars below ``raw`` and both results below ``processed``.

    ``root`` is any folder Spark can write to, such as an object store. The first write
    that fails is an error and ends the call: a lake of which a part is missing should not
    pass for whole.
    """
    land_raw(raw, f"{root}/raw", run_date)
    write_outputs(enriched, summary, f"{root}/processed")


def enriched_slice() -> Column:
    """The part of the enriched table a row is stored in."""
    return F.trunc("date", "MM")


def summary_slice(buckets: int = SUMMARY_BUCKETS) -> Column:
    """A hash bucket. ``buckets`` must stay the same for all upserts of one table."""
    return F.pmod(F.xxhash64("ticker"), F.lit(buckets)).cast("int")


def upsert_table(
    incoming: DataFrame,
    path: str,
    schema: StructType,
    keys: Sequence[str],
    update_cols: Sequence[str],
    slice_of: Column,
    last_by: str | None = None,
) -> None:
    """Upsert ``incoming`` into the Parquet table at ``path``, creating it if absent.

    NaN is stored as NULL. Of several rows with one key, the one with the highest
    ``last_by`` counts; without ``last_by`` such a key is an error.

    The table is partitioned by ``slice_of``, an expression over the keys with few
    values (months, or buckets). The incoming rows, in their declared types, are
    written down once; only the slices of these very rows are read and replaced. Rows of
    slices that the table does not hold yet have nothing to be joined with. The
    replacement of several slices is not atomic as a whole and relies on renames.
    """
    spark = incoming.sparkSession
    rows = nan_to_null(incoming)
    if last_by is not None:
        rows = dedup_keep_last(rows, list(keys), last_by)
    if last_by is None:
        # Before the other checks, which hide from Spark that the rows lie by the keys.
        rows = unique_rows(declared_types(rows, schema), keys)
    rows = conform_schema(rows, schema)
    if read_if_there(lambda: spark.read.parquet(path)) is not None:
        rows = stored(rows.withColumn("slice", slice_of), "incoming")
        table = spark.read.parquet(path)
        # Bounded by the calendar or the number of buckets; reads this column alone.
        stored_slices = table.select(F.col("slice").alias("_stored")).distinct()
        touched = rows.select("slice").distinct().join(stored_slices, F.col("slice") == F.col("_stored"))
        is_touched = F.col("slice").isin([r.slice for r in touched.collect()])
        columns = schema.fieldNames()
        old, met = (df.where(is_touched).select(columns) for df in (table, rows))
        # NULL is equal to no slice.
        unmet = rows.where(~F.coalesce(is_touched, F.lit(False))).select(columns)
        rows = merge_unique(old, met, keys, update_cols).unionByName(unmet)
    (
        _by_folder(rows.withColumn("slice", slice_of), "slice", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .partitionBy("slice")
        .parquet(path)
    )
