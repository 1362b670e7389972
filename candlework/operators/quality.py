"""Data quality checks. Each returns ``check, passed, detail``, one row."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlework.operators.summary import (
    bad_price_count,
    date_extent,
    duplicate_keys,
    ma_population,
    null_critical_count,
    table_row_counts,
)
from candlework.operators.union import union_by_name

# The check names as they appear in the report, spelled as there.
ROW_COUNT = "Row Count"
NULL_CRITICAL = "Null Critical Columns"
DUPLICATES = "Dulicate Rows"
PRICE_SANITY = "Price Sanity"
ALL_TICKERS = "All Tickers Present"
DATE_RANGE = "Date Range"
MA_POPULATED = "Moving Averages Populated"

# The bounds the checks compare with.
EXPECTED_TICKERS = 5
EARLIEST_START = dt.date(2023, 1, 1)
STALE_DAYS = 7
MIN_POPULATED_PCT = 90


# The counts that the report needs, of one month of the enriched table.
MONTH_COUNTS = T.StructType(
    [
        T.StructField("month", T.DateType()),
        T.StructField("e", T.LongType()),
        T.StructField("n_null", T.LongType()),
        T.StructField("n_bad", T.LongType()),
        T.StructField("n_dup", T.LongType()),
        T.StructField("first", T.DateType()),
        T.StructField("last", T.DateType()),
        T.StructField("n_7", T.LongType()),
        T.StructField("n_30", T.LongType()),
    ]
)


def _check(df: DataFrame, name: str, passed: Column, detail: Column) -> DataFrame:
    return df.select(_row(name, passed, detail).alias("r")).select("r.*")


def _row(name: str, passed: Column, detail: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        detail.alias("detail"),
    )


def _text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("None"))


# The rule of each check over its counts, shared by the single checks and by the
# one-pass report.


def _row_counts(enriched: Column, summary: Column, expected: int) -> Column:
    return _row(
        ROW_COUNT,
        (enriched > 0) & (summary == expected),
        F.concat(F.lit("enriched_stocks="), enriched, F.lit(", ticker_summary="), summary),
    )


def _null_critical(n: Column) -> Column:
    return _row(
        NULL_CRITICAL, n == 0, F.concat(n, F.lit(" rows with nulls in ticker/date/close"))
    )


def _duplicates(n: Column) -> Column:
    return _row(
        DUPLICATES, n == 0, F.concat(n, F.lit(" duplicate (ticker, date) pairs found"))
    )


def _price_sanity(n: Column) -> Column:
    return _row(PRICE_SANITY, n == 0, F.concat(n, F.lit(" rows with close price <= 0")))


def _tickers_present(missing: Column, expected: int) -> Column:
    listed = F.array_join(F.sort_array(missing), "', '")
    return _row(
        ALL_TICKERS,
        F.size(missing) == 0,
        F.when(F.size(missing) == 0, F.lit(f"All {expected} tickers present")).otherwise(
            F.concat(F.lit("Missing tickers: {'"), listed, F.lit("'}"))
        ),
    )


def _date_range(
    first: Column, last: Column, as_of: dt.date, start: dt.date, require_both: bool
) -> Column:
    early = F.coalesce(first <= F.lit(start), F.lit(False))
    recent = F.coalesce(last >= F.lit(as_of - dt.timedelta(days=STALE_DAYS)), F.lit(False))
    return _row(
        DATE_RANGE,
        (early & recent) if require_both else (early | recent),
        F.concat(F.lit("Date from "), _text(first), F.lit(" to "), _text(last)),
    )


def _ma_populated(total: Column, ma_7: Column, ma_30: Column) -> Column:
    def pct(n: Column) -> Column:
        return F.round(F.try_divide(n * 1000.0, total)) / 10.0

    return _row(
        MA_POPULATED,
        (pct(ma_7) > MIN_POPULATED_PCT) & (pct(ma_30) > MIN_POPULATED_PCT),
        F.concat(
            F.lit("ma_7="),
            _text(pct(ma_7)),
            F.lit("% populated, ma_30="),
            _text(pct(ma_30)),
            F.lit("% populated"),
        ),
    )


def check_row_counts(
    enriched: DataFrame, summary: DataFrame, expected: int = EXPECTED_TICKERS
) -> DataFrame:
    counts = table_row_counts(enriched=enriched, summary=summary).agg(
        F.max(F.when(F.col("table_name") == "enriched", F.col("n_rows"))).alias("e"),
        F.max(F.when(F.col("table_name") == "summary", F.col("n_rows"))).alias("s"),
    )
    return counts.select(F.inline(F.array(_row_counts(F.col("e"), F.col("s"), expected))))


def check_null_critical(enriched: DataFrame) -> DataFrame:
    counts = null_critical_count(enriched)
    return counts.select(F.inline(F.array(_null_critical(F.col("n_null")))))


def check_duplicates(enriched: DataFrame) -> DataFrame:
    counts = duplicate_keys(enriched, ["ticker", "date"])
    return counts.select(F.inline(F.array(_duplicates(F.col("n_duplicates")))))


def check_price_sanity(enriched: DataFrame) -> DataFrame:
    counts = bad_price_count(enriched)
    return counts.select(F.inline(F.array(_price_sanity(F.col("n_bad")))))


def missing_tickers(enriched: DataFrame, expected: Sequence[str]) -> DataFrame:
    """The expected tickers that have no row."""
    wanted = enriched.sparkSession.createDataFrame(
        [(t,) for t in expected], "ticker string"
    )
    # Only wanted tickers leave the scan, so the distinct set, which is broadcast,
    # is no larger than the list.
    present = enriched.select("ticker").where(F.col("ticker").isin(list(expected)))
    return wanted.join(F.broadcast(present.distinct()), "ticker", "left_anti")


def check_tickers_present(enriched: DataFrame, expected: Sequence[str]) -> DataFrame:
    missing = missing_tickers(enriched, expected).agg(F.collect_list("ticker").alias("m"))
    return missing.select(F.inline(F.array(_tickers_present(F.col("m"), len(expected)))))


def check_date_range(
    enriched: DataFrame,
    as_of: dt.date,
    start: dt.date = EARLIEST_START,
    require_both: bool = False,
) -> DataFrame:
    extent = date_extent(enriched)
    row = _date_range(F.col("min_date"), F.col("max_date"), as_of, start, require_both)
    return extent.select(F.inline(F.array(row)))


def check_ma_populated(enriched: DataFrame) -> DataFrame:
    row = _ma_populated(F.col("total"), F.col("ma7_populated"), F.col("ma30_populated"))
    return ma_population(enriched).select(F.inline(F.array(row)))


def _seen(wanted: list[str]) -> Column:
    # No larger than the list of expected tickers: the others are NULL here.
    return F.collect_set(F.when(F.col("ticker").isin(wanted), F.col("ticker"))).alias("seen")


def month_counts(enriched: DataFrame) -> DataFrame:
    """``MONTH_COUNTS`` of a table with its ``slice``, the month, in one pass."""
    per_key = enriched.groupBy("slice", "ticker", "date").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("close").isNull()).alias("no_close"),
        F.count_if(F.col("close") <= 0).alias("bad"),
        F.count("ma_7").alias("with_7"),
        F.count("ma_30").alias("with_30"),
    )
    no_key = F.col("ticker").isNull() | F.col("date").isNull()
    counts = per_key.groupBy(F.col("slice").alias("month")).agg(
        F.sum("n").alias("e"),
        F.sum(F.when(no_key, F.col("n")).otherwise(F.col("no_close"))).alias("n_null"),
        F.sum("bad").alias("n_bad"),
        F.count_if(F.col("n") > 1).alias("n_dup"),
        F.min("date").alias("first"),
        F.max("date").alias("last"),
        F.sum("with_7").alias("n_7"),
        F.sum("with_30").alias("n_30"),
    )
    return counts.select(MONTH_COUNTS.fieldNames())


def _report(
    facts: Sequence[DataFrame],
    wanted: list[str],
    as_of: dt.date,
    start: dt.date,
    require_both: bool,
) -> DataFrame:
    """The rows of the report from frames of one row each, which are folded into one."""
    names = [c for df in facts for c in df.columns]
    both = union_by_name(*facts).agg(*[F.max(c).alias(c) for c in names])
    missing = F.array_except(
        F.array(*[F.lit(t) for t in wanted]).cast("array<string>"), F.col("seen")
    )

    # Sums over no month at all are NULL.
    def count(c: str) -> Column:
        return F.coalesce(c, F.lit(0).cast("long"))

    rows = [
        _row_counts(count("e"), F.col("s"), len(wanted)),
        _null_critical(count("n_null")),
        _duplicates(count("n_dup")),
        _price_sanity(count("n_bad")),
        _tickers_present(missing, len(wanted)),
        _date_range(F.col("first"), F.col("last"), as_of, start, require_both),
        _ma_populated(count("e"), count("n_7"), count("n_30")),
    ]
    listed = both.select(F.posexplode(F.array(*rows)).alias("i", "r"))
    return listed.select((F.col("i") + 1).alias("ord"), "r.*")


def quality_report(
    enriched: DataFrame,
    summary: DataFrame,
    expected: Sequence[str],
    as_of: dt.date,
    start: dt.date = EARLIEST_START,
    require_both: bool = False,
) -> DataFrame:
    """All seven checks, in order (``ord``).

    One pass counts over the whole table, one counts rows per key.
    """
    wanted = list(expected)
    no_key = F.col("ticker").isNull() | F.col("date").isNull()
    counts = enriched.agg(
        F.count(F.lit(1)).alias("e"),
        F.count_if(no_key | F.col("close").isNull()).alias("n_null"),
        F.count_if(F.col("close") <= 0).alias("n_bad"),
        F.min("date").alias("first"),
        F.max("date").alias("last"),
        F.count("ma_7").alias("n_7"),
        F.count("ma_30").alias("n_30"),
    )
    keys = enriched.groupBy("ticker", "date").count()
    keys = keys.agg(F.count_if(F.col("count") > 1).alias("n_dup"), _seen(wanted))
    facts = [counts, keys, summary.agg(F.count(F.lit(1)).alias("s"))]
    return _report(facts, wanted, as_of, start, require_both)


def report_of_counts(
    months: DataFrame,
    tickers: DataFrame,
    summary: DataFrame,
    expected: Sequence[str],
    as_of: dt.date,
    start: dt.date = EARLIEST_START,
    require_both: bool = False,
) -> DataFrame:
    """The same report from ``MONTH_COUNTS`` of all months and the table's tickers."""
    wanted = list(expected)
    merge = {"first": F.min, "last": F.max}
    names = [c for c in MONTH_COUNTS.fieldNames() if c != "month"]
    counts = months.agg(*[merge.get(c, F.sum)(c).alias(c) for c in names])
    facts = [
        counts,
        tickers.where(F.col("ticker").isin(wanted)).agg(_seen(wanted)),
        summary.agg(F.count(F.lit(1)).alias("s")),
    ]
    return _report(facts, wanted, as_of, start, require_both)


def quality_union(*checks: DataFrame) -> DataFrame:
    """Results of single checks in one frame, in the order given (``ord``)."""
    report = None
    for i, check in enumerate(checks, 1):
        one = check.select(F.lit(i).alias("ord"), "*")
        report = one if report is None else report.unionByName(one)
    return report


def check_tally(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count_if("passed").alias("n_passed"), F.count(F.lit(1)).alias("n_checks")
    )


def fail_on_error(report: DataFrame) -> DataFrame:
    """The report, with the failed checks raised instead if there are any."""
    failed = [f"{r['check']}: {r['detail']}" for r in report.collect() if not r["passed"]]
    if failed:
        raise ValueError("quality checks failed: " + "; ".join(failed))
    return report
