"""Readers of raw bar files and bar tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlework.functions.columns import snake_case
from candlework.operators.clean import date_window
from candlework.schemas import ENRICHED, SUMMARY
from candlework.session import stored, tasks_a_core

Paths = str | list[str]
# A comma outside quotes: an even number of quotes follows.
SEPARATOR = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'
# The text of a line that does not have as many fields as the schema.
ODD_LINE = "_odd_line"
# Folders are listed by a task each, up to this number.
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def require_non_empty(
    source: DataFrame | Callable[[], DataFrame], name: str, on_empty: str = "raise"
) -> DataFrame | None:
    """``source`` if it has a row; otherwise an error, or None for ``on_empty='skip'``.

    A function that reads the source may be given instead of it: a path that does
    not exist then counts as empty.
    """
    df = source if isinstance(source, DataFrame) else read_if_there(source)
    if df is not None and not df.isEmpty():
        return df
    if on_empty == "skip":
        return None
    raise FileNotFoundError(f"no rows in {name}")


def read_if_there(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` returns, or None where its path does not exist or holds no file."""
    try:
        return read()
    except FileNotFoundError:
        return None
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _csv_options(reader):
    return reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")


def _fields(line: Column) -> Column:
    return F.split(line, SEPARATOR)


def _headers(spark: SparkSession, path: Paths) -> DataFrame:
    """``file, names``: the columns named in the first line of each file below ``path``.

    One task reads the start of a file, in order, so the lowest id of a file is that
    of its first line.
    """

    def name(field: Column) -> Column:
        plain = F.regexp_replace(F.regexp_replace(field, '^"|"$', ""), '""', '"')
        return F.replace(F.lower(plain), F.lit(" "), F.lit("_"))

    with tasks_a_core(spark, LISTING_TASKS):
        lines = _csv_options(spark.read).text(path)
    first = (
        lines.where((F.col("_metadata.file_block_start") == 0) & (F.trim("value") != ""))
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.regexp_replace("value", "^\ufeff", "").alias("line"),
            F.monotonically_increasing_id().alias("id"),
        )
        .groupBy("file")
        .agg(F.min_by("line", "id").alias("line"))
    )
    return first.select("file", F.transform(_fields(F.col("line")), name).alias("names"))


def _all_fields_named(columns: Sequence[str]) -> Column:
    """True, or an error for a line of more fields than ``columns``; fewer are allowed."""
    line = F.col(ODD_LINE)
    surplus = F.size(_fields(line)) > len(columns)
    # Spark refuses to read the odd lines by themselves; the message takes a column along.
    message = F.concat_ws(" ", F.lit("more fields than columns:"), line, f"`{columns[0]}`")
    bad = F.raise_error(message).cast("boolean")
    return F.when(line.isNotNull() & surplus, bad).otherwise(True)


def _read_text(
    spark: SparkSession, path: Paths, columns: Sequence[str], check_header: bool
) -> DataFrame:
    """The files by position, as ``columns``, with each row's file and place."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, ODD_LINE]])
    reader = (
        _csv_options(spark.read)
        .option("header", True)
        .option("enforceSchema", not check_header)
        .option("columnNameOfCorruptRecord", ODD_LINE)
        # The fields of a line are counted only where all of them are parsed.
        .option("columnPruning", False)
        .schema(schema)
    )
    with tasks_a_core(spark, LISTING_TASKS):
        rows = reader.csv(path)
    # The ids rise along each part of a file; they are taken here, before any join.
    return rows.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("part"),
            F.monotonically_increasing_id().alias("id"),
        ).alias("_place"),
    )


def _read_by_name(spark: SparkSession, path: Paths) -> DataFrame:
    """One scan of all files by position, then each column picked by file header."""
    headers = stored(_headers(spark, path), "headers")
    kinds = headers.groupBy("names").agg(F.min("file").alias("file"))
    # Names in the order of the files; their number is that of the columns to come.
    found = (
        kinds.select("file", F.posexplode("names").alias("at", "name"))
        .groupBy("name")
        .agg(F.min(F.struct("file", "at")).alias("first"))
        .orderBy("first")
        .collect()
    )
    if not found:
        raise FileNotFoundError(f"no CSV files in {path}")
    names = [row["name"] for row in found]
    shape = kinds.agg(F.count("*").alias("kinds"), F.max(F.size("names")).alias("width")).first()
    if shape["kinds"] == 1:
        rows = _read_text(spark, path, names, check_header=False)
        return rows.where(_all_fields_named(names)).drop(ODD_LINE)

    cells = [f"_{i}" for i in range(shape["width"])]
    rows = _read_text(spark, path, cells, check_header=False)
    # Where each column stands is worked out once for a file; -1 where it lacks it.
    files = headers.select(
        F.col("file").alias("_file"),
        F.size("names").alias("_width"),
        *[
            (F.array_position("names", n) - 1).cast("int").alias(f"_at_{i}")
            for i, n in enumerate(names)
        ],
    )
    cell = F.array(*cells)
    beyond = F.slice(cell, F.col("_width") + 1, F.lit(len(cells)))
    short = F.concat(F.lit("more fields than columns in "), F.col("_file"))
    named = F.when(
        F.exists(beyond, lambda c: c.isNotNull()), F.raise_error(short).cast("boolean")
    ).otherwise(True)
    return (
        rows.join(files, "_file")
        .where(_all_fields_named(cells) & named)
        .select(
            *[F.get(cell, F.col(f"_at_{i}")).alias(n) for i, n in enumerate(names)],
            "_file",
            "_place",
        )
    )


def read_bars_csv(
    spark: SparkSession, path: Paths, columns: Sequence[str] | None = None
) -> DataFrame:
    """Every ``*.csv`` below ``path``, or each of a list of them, as text columns, matched by column name.

    Give ``columns`` where every file is known to have that header, which is the
    ordinary case: the text is read once, and a file that differs is an error.
    Without it the headers are looked up first, at the cost of a further scan of the
    text, since Spark matches the columns of several CSV files by position; a column
    a file lacks is NULL there.

    A line of more fields than its header is an error; fields it lacks are NULL.
    ``seq`` orders the rows by file path and place in the file, to tell which of
    two bars came last; raw files are named by ticker and run date.
    """
    if columns is None:
        rows = _read_by_name(spark, path)
    else:
        rows = _read_text(spark, path, columns, check_header=True)
        rows = rows.where(_all_fields_named(columns)).drop(ODD_LINE)
        rows = rows.withColumnsRenamed({c: snake_case(c) for c in columns})
    seq = F.struct(F.col("_file").alias("file"), F.col("_place").alias("place"))
    return rows.withColumn("seq", seq).drop("_file", "_place")


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """The stored table in its declared columns; of a table by months, the rows with
    ``start <= date < end``. Other months are not opened."""
    table = spark.read.parquet(path)
    if start is not None:
        table = table.where(F.col("slice") >= F.trunc(F.lit(start), "MM"))
    if end is not None:
        table = table.where(F.col("slice") < F.lit(end))
    return date_window(table, start, end).select(*schema.fieldNames())


def read_recent(spark: SparkSession, path: str, days: int = 30) -> DataFrame:
    """The rows of the stored enriched table from ``days`` calendar days before its
    latest date on. Only the latest month is read to find that date, and only the
    months that can hold such rows to return them."""
    table = spark.read.parquet(path)
    latest = table.select(F.max("slice")).scalar()
    cutoff = table.where(F.col("slice") == latest).select(
        F.date_sub(F.max("date"), days).alias("cutoff")
    )
    months = table.where(F.col("slice") >= cutoff.select(F.trunc("cutoff", "MM")).scalar())
    return months.where(F.col("date") >= cutoff.scalar()).select(*ENRICHED.fieldNames())


def read_enriched(spark: SparkSession, path: str) -> DataFrame:
    """The enriched table, in its declared columns; partition columns are dropped."""
    return spark.read.parquet(path).select(*ENRICHED.fieldNames())


def read_summary_csv(spark: SparkSession, path: str) -> DataFrame:
    """The summary from CSV, its two dates parsed and its numbers typed."""
    schema = T.StructType(
        [
            T.StructField(
                f.name, T.DoubleType() if isinstance(f.dataType, T.DecimalType) else f.dataType
            )
            for f in SUMMARY.fields
        ]
    )
    text_dates = T.StructType(
        [
            T.StructField(f.name, T.StringType() if f.name.endswith("_date") else f.dataType)
            for f in schema.fields
        ]
    )
    raw = _csv_options(spark.read).option("header", True).schema(text_dates).csv(path)
    return raw.withColumns({c: F.to_date(c) for c in ["from_date", "to_date"]})


def register_tables(spark: SparkSession, enriched: DataFrame, summary: DataFrame) -> None:
    """Make the two tables known to ``spark.sql`` under their names."""
    enriched.createOrReplaceTempView("enriched_stocks")
    summary.createOrReplaceTempView("ticker_summary")


def lake_manifest(spark: SparkSession, root: str) -> DataFrame:
    """``path, size_kb`` of every object below ``root``; contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    )
    return files.select("path", (F.round(F.col("length") * 100 / 1024) / 100).alias("size_kb"))
