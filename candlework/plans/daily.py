"""The daily batch over new raw files alone, with the results of a run over all of them.

A run reads the files that no earlier run has read. The features of a bar depend on the
29 bars before it, so

- a ticker whose new bars all follow the stored ones needs its last 29 closes, which are
  kept as its tail;
- a ticker with late bars needs the stored bars around them: the 29 before the first, and
  those up to 29 behind the last, which change. Only the months that hold them are read.

What changes is merged into the months and buckets that it lies in: bars, enriched bars,
the aggregates per ticker with the summary made of them, the counts per month, and the
list of files read. All of it becomes visible in one step, at the end.

Raw files are never changed or dealt with twice; a file that has changed since it was
read is an error. Files that are gone do not matter.
"""

from __future__ import annotations

import datetime as dt
import re
from bisect import bisect_right
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlework.functions.numeric import PRICE_DIGITS, RETURN_DIGITS, from_units, to_units
from candlework.operators.clean import clean_bars, dedup_keep_last
from candlework.operators.features import REACH, add_features
from candlework.operators.quality import EARLIEST_START, MONTH_COUNTS, month_counts, report_of_counts
from candlework.operators.summary import STATE, merge_states, state_of_changes, summary_of
from candlework.operators.upsert import conform_schema, merge_unique
from candlework.schemas import (
    BAR_COLUMNS,
    BARS,
    ENRICHED,
    ENRICHED_KEYS,
    ENRICHED_UPDATES,
    SUMMARY,
    SUMMARY_KEYS,
    SUMMARY_UPDATES,
)
from candlework.session import files_below, run_scratch, stored
from candlework.sources.readers import read_bars_csv
from candlework.sources.releases import Releases, Run
from candlework.sources.writers import enriched_slice, summary_slice

# Where a bar stands among all raw bars, as ``read_bars_csv`` gives it.
SEQ = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField(
            "place", T.StructType([T.StructField("part", T.LongType()), T.StructField("id", T.LongType())])
        ),
    ]
)
# Every bar of every file, doubled days too, with its present return in whole units.
STORED_BARS = T.StructType(
    [*BARS.fields, T.StructField("seq", SEQ), T.StructField("return_units", T.LongType())]
)
# The last bars of a ticker, newest first.
TAIL = T.ArrayType(
    T.StructType(
        [T.StructField("date", T.DateType()), T.StructField("seq", SEQ), T.StructField("cents", T.LongType())]
    )
)
TICKER_STATE = T.StructType([*STATE.fields, T.StructField("tail", TAIL)])
RAW_FILES = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modified", T.TimestampType()),
    ]
)
MONTH, BUCKET = T.DateType(), T.IntegerType()
# The parts by ticker that each slice is stored in: of a month, some 200 MB each is right.
BUCKETS = 32
# Runs whose lists of files are kept apart; beyond, they are written into one.
LEDGER_SLICES = 100


def run(
    spark: SparkSession,
    raw_path: str,
    root: str,
    expected: Sequence[str],
    as_of: dt.date,
    start: dt.date = EARLIEST_START,
    columns: Sequence[str] | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Reads what is new below ``raw_path`` into the tables below ``root``; returns the quality report.

    ``columns`` is the header that all files are known to have, see ``read_bars_csv``.
    ``buckets`` has to stay the same for all runs.
    Without a new file no bar is read and nothing is written. A run that fails or is
    stopped leaves the tables as they were.
    """
    with run_scratch(spark):
        base = Releases(spark, root)
        new = _new_files(spark, raw_path, base)
        if not new.isEmpty():
            base = _advance(base, new, columns, buckets)
    return report(base, expected, as_of, start)


def tables(spark: SparkSession, root: str, buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    """The enriched table and the summary, as of the latest release, bucketed by ticker.

    Windows, groups and joins by ticker need no shuffle. ``slice`` is the month of an
    enriched bar: a filter on it opens only the months that it names.
    """
    base = Releases(spark, root)
    return (
        base.table("enriched_stocks", ENRICHED, MONTH, "ticker", buckets),
        base.table("ticker_summary", SUMMARY, BUCKET, "ticker", buckets),
    )


def publish_tables(enriched: DataFrame, summary: DataFrame, root: str, buckets: int = BUCKETS) -> Releases:
    """Replaces both tables by the given ones, as ``tables`` reads them, in one step."""
    run = Releases(enriched.sparkSession, root).next_run()
    run.clear("enriched_stocks")
    run.clear("ticker_summary")
    _write_table(run, conform_schema(enriched, ENRICHED), "enriched_stocks", buckets)
    _write_table(run, conform_schema(summary, SUMMARY), "ticker_summary", buckets)
    return run.publish()


def report(base: Releases, expected: Sequence[str], as_of: dt.date, start: dt.date = EARLIEST_START) -> DataFrame:
    """The quality report, from the counts per month and the list of tickers; no bar is read."""
    counts = base.read("month_counts", MONTH_COUNTS, T.StringType())
    tickers = base.read("ticker_state", TICKER_STATE, BUCKET).select("ticker")
    summary = base.read("ticker_summary", SUMMARY, BUCKET)
    return report_of_counts(counts, tickers, summary, expected, as_of, start)


def _new_files(spark: SparkSession, raw_path: str, base: Releases) -> DataFrame:
    """The CSV files that no run has read."""
    files = files_below(spark, raw_path, "*.csv").alias("found")
    read = base.read("raw_files", RAW_FILES, T.LongType()).alias("read")
    same = (F.col("found.length") == F.col("read.length")) & (F.col("found.modified") == F.col("read.modified"))
    message = F.concat(F.lit("changed since it was read: "), F.col("found.path"))
    changed = F.raise_error(message).cast("boolean")
    is_new = F.when(F.col("read.path").isNull(), True).when(same, False).otherwise(changed)
    found = files.join(read, F.col("found.path") == F.col("read.path"), "left").where(is_new)
    return stored(found.select("found.*"), "new-files")


def _paths(files: DataFrame) -> list[str]:
    # The driver lists the files of any scan anyway. Paths are taken as patterns by readers.
    return [re.sub(r"([\[\]{}*?\\])", r"\\\1", r["path"]) for r in files.select("path").collect()]


def _order(date: str = "date", seq: str = "seq") -> Column:
    return F.struct(F.col(date).alias("date"), F.col(seq).alias("seq"))


def _advance(base: Releases, new: DataFrame, columns: Sequence[str] | None, buckets: int) -> Releases:
    raw = read_bars_csv(base.spark, _paths(new), columns)
    bars = stored(clean_bars(raw).select(*BAR_COLUMNS, "seq"), "new-bars")
    arrived = stored(
        bars.groupBy("ticker").agg(
            F.min(_order()).alias("first"), F.min("date").alias("first_date"), F.max("date").alias("last_date")
        ),
        "arrived",
    )
    known = stored(
        base.read("ticker_state", TICKER_STATE, BUCKET)
        .select("ticker", "from_date", "to_date", "tail")
        .join(arrived, "ticker"),
        "known",
    )
    last = F.col("tail")[0]
    is_late = F.col("first") <= F.struct(last["date"].alias("date"), last["seq"].alias("seq"))
    late = known.where(is_late).drop("tail", "first")
    rows = stored(_with_features(base, bars, known.where(~is_late), late), "features")

    run = base.next_run()
    changed = rows.where("affected")
    months = [r[0] for r in changed.select(enriched_slice()).distinct().collect()]
    _write_bars(run, changed, months)
    # The last bar of a day is looked for among all that are at hand, changed or not.
    last_bars = dedup_keep_last(rows, ENRICHED_KEYS, "seq").where("affected")
    _write_enriched(run, last_bars, months, buckets)
    _write_counts(run, months)
    slices = [r[0] for r in arrived.select(summary_slice()).distinct().collect()]
    _write_state(run, changed, bars, slices)
    _write_summary(run, arrived, slices, buckets)
    _write_ledger(run, new)
    return run.publish()


# What the features of new bars are worked out from


def _with_features(base: Releases, bars: DataFrame, in_order: DataFrame, late: DataFrame) -> DataFrame:
    """New bars with features, among the stored bars around them.

    ``is_new`` marks the new ones, ``affected`` all whose features may have changed, and
    ``return_units`` is a stored bar's return so far.
    """
    new = bars.select("*", F.lit(None).cast("long").alias("return_units"), F.lit(True).alias("is_new"))
    tails = in_order.select("ticker", F.explode("tail").alias("t")).select(
        "ticker", "t.date", "t.seq", from_units(F.col("t.cents"), PRICE_DIGITS).alias("close"), F.lit(False).alias("is_new")
    )
    around = (
        base.read("bars", STORED_BARS, MONTH, _months_around(base, late))
        .drop("slice")
        .join(late, "ticker", "left_semi")
        .withColumn("is_new", F.lit(False))
    )
    rows = stored(
        new.unionByName(tails, allowMissingColumns=True).unionByName(around, allowMissingColumns=True), "context"
    )
    behind_new = lambda window: {"affected": F.max("is_new").over(window.rowsBetween(-REACH, 0))}
    return add_features(rows, ["date", "seq"], also=behind_new)


def _months_around(base: Releases, late: DataFrame) -> list[str]:
    """The stored months that hold ``REACH`` bars before and after the new bars of each late ticker.

    They are looked for month by month, in steps that double; a ticker that has no more
    bars on a side asks for none.
    """
    months = base.slices_of("bars")

    def month_of(extreme, date: str) -> Column:
        return extreme(F.trunc(date, "MM")).cast("string")

    min_first, max_first, min_last, max_last = late.agg(
        month_of(F.min, "first_date"), month_of(F.max, "first_date"), month_of(F.min, "last_date"), month_of(F.max, "last_date")
    ).first()
    if min_first is None:
        return []

    def held(month: str) -> int:
        return max(bisect_right(months, month) - 1, 0)

    def short(lo: int, hi: int, beside: Column, more: Column) -> bool:
        """Whether a ticker lacks bars in these months and has further ones beyond."""
        near = base.read("bars", STORED_BARS, MONTH, months[lo : hi + 1]).select("ticker", "date")
        enough = near.join(late, "ticker").where(beside).groupBy("ticker").count().where(F.col("count") >= REACH)
        return not late.where(more).join(enough, "ticker", "left_anti").isEmpty()

    def day(i: int) -> Column:
        return F.lit(months[i]).cast("date")

    before, after = F.col("date") < F.col("first_date"), F.col("date") > F.col("last_date")
    lo, hi, end = held(min_first), held(max_last), len(months) - 1
    step = 1
    while lo > 0 and short(lo, held(max_first), before, F.col("from_date") < day(lo)):
        lo, step = max(lo - step, 0), step * 2
    step = 1
    while hi < end and short(held(min_last), hi, after, F.col("to_date") >= day(hi + 1)):
        hi, step = min(hi + step, end), step * 2
    return months[lo : hi + 1]


# What a run writes


def _write_bars(run: Run, changed: DataFrame, months: list[dt.date]) -> None:
    units = to_units(F.col("daily_return_pct"), RETURN_DIGITS)
    now = changed.select(*BAR_COLUMNS, "seq", units.alias("return_units"))
    before = run.base.read("bars", STORED_BARS, MONTH, months).drop("slice")
    again = changed.where("NOT is_new").select("ticker", "date", "seq")
    kept = before.join(again, ["ticker", "date", "seq"], "left_anti")
    run.write(kept.unionByName(now), "bars", enriched_slice(), "ticker", "date")


def _write_table(run: Run, rows: DataFrame, table: str, buckets: int) -> None:
    slice_of, order = {
        "enriched_stocks": (enriched_slice(), ENRICHED_KEYS), "ticker_summary": (summary_slice(), SUMMARY_KEYS)
    }[table]
    run.write(rows, table, slice_of, *order, key="ticker", buckets=buckets)


def _write_enriched(run: Run, rows: DataFrame, months: list[dt.date], buckets: int) -> None:
    before = run.base.read("enriched_stocks", ENRICHED, MONTH, months).drop("slice")
    merged = merge_unique(before, conform_schema(rows, ENRICHED), ENRICHED_KEYS, ENRICHED_UPDATES)
    _write_table(run, merged, "enriched_stocks", buckets)


def _write_counts(run: Run, months: list[dt.date]) -> None:
    written = run.read("enriched_stocks", ENRICHED, MONTH, months)
    others = run.base.read("month_counts", MONTH_COUNTS, T.StringType()).drop("slice")
    if months:
        others = others.where(~F.col("month").isin(months))
    run.write(others.unionByName(month_counts(written)), "month_counts", F.lit("all"))


def _write_state(run: Run, changed: DataFrame, bars: DataFrame, slices: list[int]) -> None:
    change = state_of_changes(changed).join(_tails(bars), "ticker")
    before = run.base.read("ticker_state", TICKER_STATE, BUCKET, slices).drop("slice")
    # At most two tails of a ticker meet here.
    tail = F.slice(F.sort_array(F.flatten(F.collect_list("tail")), asc=False), 1, REACH).alias("tail")
    merged = merge_states(before.unionByName(change), tail)
    run.write(merged.select(TICKER_STATE.fieldNames()), "ticker_state", summary_slice(), "ticker")


def _tails(bars: DataFrame) -> DataFrame:
    """The tail of each ticker within ``bars``; the rank is limited in the map tasks too."""
    newest = Window.partitionBy("ticker").orderBy(F.col("date").desc(), F.col("seq").desc())
    last = bars.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= REACH)
    bar = F.struct("date", "seq", to_units(F.col("close"), PRICE_DIGITS).alias("cents"))
    return last.groupBy("ticker").agg(F.collect_list(bar).alias("tail"))


def _write_summary(run: Run, arrived: DataFrame, slices: list[int], buckets: int) -> None:
    state = run.read("ticker_state", TICKER_STATE, BUCKET, slices).join(arrived, "ticker", "left_semi")
    before = run.base.read("ticker_summary", SUMMARY, BUCKET, slices).drop("slice")
    merged = merge_unique(before, conform_schema(summary_of(state), SUMMARY), SUMMARY_KEYS, SUMMARY_UPDATES)
    _write_table(run, merged, "ticker_summary", buckets)


def _write_ledger(run: Run, new: DataFrame) -> None:
    if len(run.base.slices_of("raw_files")) >= LEDGER_SLICES:
        before = run.base.read("raw_files", RAW_FILES, T.LongType()).drop("slice")
        run.clear("raw_files")
        new = new.unionByName(before)
    run.write(new, "raw_files", F.lit(run.number))
