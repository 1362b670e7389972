"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from candlework.functions import columns as C
from candlework.operators import (
    analytics,
    clean,
    features,
    quality,
    summary,
    union,
    upsert,
)
from candlework.plans import fixtures as fx
from candlework.plans import daily, pipeline
from candlework.schemas import (
    BAR_COLUMNS,
    ENRICHED,
    ENRICHED_KEYS,
    ENRICHED_UPDATES,
    SUMMARY,
    SUMMARY_KEYS,
    SUMMARY_UPDATES,
)
from candlework.session import scratch_path, stored
from candlework.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]

RUN_DATE = dt.date(2001, 8, 1)
WINDOW = (dt.date(1997, 1, 1), dt.date(2000, 1, 1))
START = dt.date(1995, 1, 1)
ABSENT = "6-ABSENT"
# The given tables have few bars a month.
BUCKETS = 8

QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The many-ticker table most queries read."""
    return fx.enriched_of(fx.bars_lineitem(spark, sf_dir))


def _enriched_five(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.enriched_of(fx.bars_orders(spark, sf_dir))


def _upsert_enriched(rows: DataFrame, path: str) -> None:
    slices = writers.enriched_slice()
    writers.upsert_table(rows, path, ENRICHED, ENRICHED_KEYS, ENRICHED_UPDATES, slices)


def _typed_text(df: DataFrame) -> DataFrame:
    """Rows read as text, in the types of bars."""
    types = {"date": "date", "volume": "bigint"}
    return df.select(
        *[
            F.col(c).cast(types.get(c, "string" if c == "ticker" else "double")).alias(c)
            for c in BAR_COLUMNS
        ]
    )


# Sources


@_query
def csv_scan(spark, sf_dir):
    """Files of three different headers, read by column name."""
    bars = fx.bars_orders(spark, sf_dir)
    path = scratch_path(spark, "csv")
    permuted, short = fx.TICKERS[0], fx.TICKERS[-1]
    usual = bars.where(~F.col("ticker").isin(permuted, short))
    writers.land_raw(usual.select(*BAR_COLUMNS), f"{path}/a", RUN_DATE)
    other = bars.where(F.col("ticker") == permuted).select(*reversed(BAR_COLUMNS))
    writers.land_raw(other, f"{path}/b", RUN_DATE)
    writers.land_raw(
        bars.where(F.col("ticker") == short).drop("open"), f"{path}/c", RUN_DATE
    )
    return _typed_text(readers.read_bars_csv(spark, path))


@_query
def parquet_scan(spark, sf_dir):
    path = scratch_path(spark, "enriched")
    writers.write_enriched(_enriched(spark, sf_dir), path)
    return readers.read_enriched(spark, path)


@_query
def summary_csv_scan(spark, sf_dir):
    path = scratch_path(spark, "summary")
    writers.write_summary(summary.ticker_summary(_enriched(spark, sf_dir)), path)
    return readers.read_summary_csv(spark, path)


@_query
def table_scan(spark, sf_dir):
    enriched = _enriched(spark, sf_dir)
    readers.register_tables(spark, enriched, summary.ticker_summary(enriched))
    return spark.sql(
        "SELECT ticker, date, close, ma_7::DECIMAL(12,2) AS ma_7 "
        "FROM enriched_stocks WHERE ma_7 IS NOT NULL"
    )


@_query
def lake_manifest(spark, sf_dir):
    root = scratch_path(spark, "lake")
    enriched = _enriched_five(spark, sf_dir)
    bars = enriched.select(*BAR_COLUMNS)
    writers.publish_lake(bars, enriched, summary.ticker_summary(enriched), root, RUN_DATE)
    found = readers.lake_manifest(spark, root)
    # How many files an object has is up to the run.
    place = F.regexp_extract("path", "/(raw|processed)/(?:landing_key=)?([^/]+)/[^/]+$", 1)
    name = F.regexp_extract("path", "/(raw|processed)/(?:landing_key=)?([^/]+)/[^/]+$", 2)
    return found.groupBy(place.alias("prefix"), name.alias("object")).agg(
        (F.min("size_kb") > 0).alias("has_size")
    )


@_query
def require_non_empty(spark, sf_dir):
    absent = scratch_path(spark, "absent")
    skipped = readers.require_non_empty(lambda: spark.read.parquet(absent), "none", "skip")
    assert skipped is None
    return readers.require_non_empty(lambda: fx.bars_orders(spark, sf_dir), "bars")


@_query
def date_window_scan(spark, sf_dir):
    path = scratch_path(spark, "bars")
    writers.write_enriched(fx.bars_lineitem(spark, sf_dir), path)
    return clean.date_window(spark.read.parquet(path), *WINDOW)


# Sinks


@_query
def land_raw_csv(spark, sf_dir):
    path = scratch_path(spark, "raw")
    bars = fx.bars_lineitem(spark, sf_dir).select(*BAR_COLUMNS)
    writers.land_raw(bars, path, RUN_DATE)
    return _typed_text(readers.read_bars_csv(spark, path, BAR_COLUMNS))


@_query
def write_enriched(spark, sf_dir):
    path = scratch_path(spark, "enriched")
    writers.write_enriched(_enriched_five(spark, sf_dir), path)
    return readers.read_enriched(spark, path)


@_query
def write_summary(spark, sf_dir):
    path = scratch_path(spark, "summary")
    writers.write_summary(summary.ticker_summary(_enriched_five(spark, sf_dir)), path)
    return readers.read_summary_csv(spark, path)


@_query
def upsert_enriched(spark, sf_dir):
    existing, incoming = fx.upsert_pair(_enriched(spark, sf_dir))
    return upsert.merge_upsert(existing, incoming, ENRICHED_KEYS, ENRICHED_UPDATES)


@_query
def upsert_enriched_table(spark, sf_dir):
    """The same upsert into a stored table, month by month."""
    path = scratch_path(spark, "table")
    # Both runs read the same bars.
    bars = stored(fx.bars_lineitem(spark, sf_dir), "bars")
    for rows in fx.upsert_pair(fx.enriched_of(bars)):
        _upsert_enriched(rows, path)
    return readers.read_enriched(spark, path)


@_query
def upsert_summary(spark, sf_dir):
    enriched = _enriched(spark, sf_dir)
    existing, _ = fx.upsert_pair(enriched)
    later = enriched.where(F.col("date") >= F.lit("1996-01-01").cast("date"))
    return upsert.merge_upsert(
        summary.ticker_summary(existing),
        summary.ticker_summary(later),
        SUMMARY_KEYS,
        SUMMARY_UPDATES,
    )


@_query
def publish_lake(spark, sf_dir):
    """Rows per published object, read back."""
    root = scratch_path(spark, "lake")
    enriched = _enriched_five(spark, sf_dir)
    bars = enriched.select(*BAR_COLUMNS)
    writers.publish_lake(bars, enriched, summary.ticker_summary(enriched), root, RUN_DATE)
    return summary.table_row_counts(
        raw=readers.read_bars_csv(spark, f"{root}/raw", BAR_COLUMNS),
        enriched=readers.read_enriched(spark, f"{root}/processed/enriched_stocks.parquet"),
        summary=readers.read_summary_csv(spark, f"{root}/processed/ticker_summary.csv"),
    )


@_query
def conform_schema(spark, sf_dir):
    return upsert.conform_schema(_enriched(spark, sf_dir), ENRICHED)


@_query
def conform_summary(spark, sf_dir):
    return upsert.conform_schema(
        summary.ticker_summary(_enriched(spark, sf_dir)), SUMMARY
    )


@_query
def constraint_violations(spark, sf_dir):
    """Bars with second bars for some days, long and missing tickers; tickers of the
    summary doubled and missing."""
    bars, own = fx.constraint_pair(spark, sf_dir)
    return upsert.constraint_violations(bars, own)


# Pipeline


def _run_pipeline(
    spark: SparkSession, sf_dir: str, times: int, columns: list[str] | None = BAR_COLUMNS
) -> tuple[str, DataFrame]:
    raw, root = scratch_path(spark, "raw"), scratch_path(spark, "run")
    writers.land_raw(fx.bars_orders(spark, sf_dir).select(*BAR_COLUMNS), raw, RUN_DATE)
    for _ in range(times):
        report = pipeline.run(spark, raw, root, fx.TICKERS, RUN_DATE, START, columns)
    return root, report


@_query
def pipeline_report(spark, sf_dir):
    """Raw files to tables to the quality report."""
    return _run_pipeline(spark, sf_dir, 1)[1]


@_query
def pipeline_tables(spark, sf_dir):
    """The enriched table after a run and a rerun."""
    root, _ = _run_pipeline(spark, sf_dir, 2, columns=None)
    return pipeline.tables(spark, root)[0]


@_query
def pipeline_summary(spark, sf_dir):
    """The stored summary table after a run and a rerun."""
    root, _ = _run_pipeline(spark, sf_dir, 2)
    return pipeline.tables(spark, root)[1]


@_query
def rows_cleaned(spark, sf_dir):
    """Rows before and after cleaning, as observed while the bars are written."""
    counts = Observation("cleaning")
    bars = clean.clean_bars(fx.bars_dirty(spark, sf_dir), observation=counts)
    bars.write.parquet(scratch_path(spark, "typed"))
    return spark.createDataFrame([counts.get], "rows_before bigint, rows_after bigint")


# Daily runs


def _daily(spark, sf_dir) -> tuple[str, DataFrame]:
    """The tables' folder after a run for each of the landings, and the last report."""
    raw, root = scratch_path(spark, "raw"), scratch_path(spark, "tables")
    report = None
    for i, landed in enumerate(fx.landings(fx.bars_orders(spark, sf_dir))):
        writers.land_raw(landed, f"{raw}/{i}", RUN_DATE)
        report = daily.run(spark, raw, root, fx.TICKERS, RUN_DATE, START, BAR_COLUMNS, BUCKETS)
    return root, report


@_query
def daily_enriched(spark, sf_dir):
    """The enriched table after two runs, each over its new files alone."""
    return daily.tables(spark, _daily(spark, sf_dir)[0], BUCKETS)[0].drop("slice")


@_query
def daily_summary(spark, sf_dir):
    return daily.tables(spark, _daily(spark, sf_dir)[0], BUCKETS)[1].drop("slice")


@_query
def daily_report(spark, sf_dir):
    """The report of the last run, from counts per month."""
    return _daily(spark, sf_dir)[1]


@_query
def summary_from_states(spark, sf_dir):
    """The summary from the merged states of three parts of the bars."""
    enriched = _enriched(spark, sf_dir)
    part = F.month("date") % 3
    states = [summary.summary_state(enriched.where(part == i)) for i in range(3)]
    merged = summary.merge_states(states[0].unionByName(states[1]).unionByName(states[2]))
    return summary.summary_of(merged)


def _published(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    root = scratch_path(spark, "tables")
    enriched = stored(_enriched(spark, sf_dir), "enriched")
    daily.publish_tables(enriched, summary.ticker_summary(enriched), root, BUCKETS)
    return daily.tables(spark, root, BUCKETS)


@_query
def volume_spikes_published(spark, sf_dir):
    """Over tables stored by ticker: the join needs no shuffle."""
    return analytics.volume_spikes(*_published(spark, sf_dir))


@_query
def last_30_published(spark, sf_dir):
    """Over the table stored by ticker: the window and the aggregate need no shuffle."""
    return analytics.last_30_trading_days(_published(spark, sf_dir)[0])


# Columns


@_query
def snake_case_columns(spark, sf_dir):
    bars = fx.bars_orders(spark, sf_dir)
    return C.snake_case_columns(bars.toDF(*[f"Day {c.title()}" for c in bars.columns]))


@_query
def tag_ticker(spark, sf_dir):
    """All orders as one series."""
    bars = fx.bars_orders(spark, sf_dir)
    market = bars.groupBy("date").agg(F.sum("volume").alias("volume"))
    return C.tag_ticker(market, "MARKET")


@_query
def landing_key(spark, sf_dir):
    tickers = summary.distinct_tickers(fx.bars_lineitem(spark, sf_dir))
    dotted = tickers.withColumn("ticker", F.concat("ticker", F.lit(".NS")))
    return dotted.withColumn("landing_key", C.landing_key(F.col("ticker"), RUN_DATE))


@_query
def parse_date(spark, sf_dir):
    """Text dates, some of them bad; the tolerant parse makes those NULL."""
    bars = fx.bars_lineitem(spark, sf_dir)
    text = F.when(F.dayofyear("date") % 50 == 0, "no date").otherwise(
        F.date_format("date", "yyyy-MM-dd")
    )
    return bars.select("ticker", "close", text.alias("text")).select(
        "ticker", "close", "text", C.parse_date(F.col("text"), strict=False).alias("date")
    )


@_query
def round_prices(spark, sf_dir):
    bars = fx.bars_lineitem(spark, sf_dir)
    fine = bars.withColumns({c: F.col(c) / 8.0 for c in C.PRICE_COLUMNS})
    return C.round_prices(fine)


@_query
def cast_volume(spark, sf_dir):
    bars = fx.bars_lineitem(spark, sf_dir).select("ticker", "date", "volume")
    broken = bars.withColumn("volume", F.col("volume") + 0.75)
    return broken.withColumn("volume", C.cast_volume(F.col("volume")))


@_query
def daily_range(spark, sf_dir):
    bars = fx.bars_lineitem(spark, sf_dir)
    return bars.select(
        "ticker", "date", C.daily_range(F.col("high"), F.col("low")).alias("daily_range")
    )


@_query
def nan_to_null(spark, sf_dir):
    return C.nan_to_null(fx.bars_dirty(spark, sf_dir))


@_query
def price_range_pct(spark, sf_dir):
    bars = fx.bars_lineitem(spark, sf_dir)
    pct = C.price_range_pct(F.col("high"), F.col("low"))
    return bars.select("ticker", "date", pct.alias("price_range_pct"))


@_query
def ma_signal(spark, sf_dir):
    return analytics.ma_signals(_enriched(spark, sf_dir))


@_query
def volatility_pct(spark, sf_dir):
    bars = fx.bars_bad_price(spark, sf_dir)
    pct = C.volatility_pct(C.daily_range(F.col("high"), F.col("low")), F.col("close"))
    return bars.select("ticker", "date", pct.alias("volatility_pct"))


@_query
def volume_ratio(spark, sf_dir):
    """Every bar's volume against its ticker's average."""
    bars = fx.bars_lineitem(spark, sf_dir)
    averages = summary.ticker_summary(fx.enriched_of(bars))
    joined = analytics.join_summary(bars.select("ticker", "date", "volume"), averages)
    ratio = C.volume_ratio(F.col("volume"), F.col("avg_daily_volume"))
    return joined.select("ticker", "date", ratio.alias("volume_ratio"))


@_query
def month_bucket(spark, sf_dir):
    bars = fx.bars_lineitem(spark, sf_dir)
    return bars.select("ticker", "date", C.month_bucket(F.col("date")).alias("month"))


@_query
def sample_columns(spark, sf_dir):
    return analytics.sample_bars(_enriched(spark, sf_dir))


# Filters and cleaning


@_query
def drop_null_critical(spark, sf_dir):
    return clean.drop_null_critical(C.nan_to_null(fx.bars_dirty(spark, sf_dir)))


@_query
def clean_bars(spark, sf_dir):
    """Bars that arrive as text, cleaned and typed."""
    dirty = fx.bars_dirty(spark, sf_dir)
    text = dirty.select(*[F.col(c).cast("string").alias(c) for c in BAR_COLUMNS], "seq")
    return clean.clean_bars(text)


@_query
def recency_filter(spark, sf_dir):
    return analytics.recent_days(fx.bars_lineitem(spark, sf_dir))


@_query
def union_by_name(spark, sf_dir):
    return union.union_by_name(
        fx.bars_orders(spark, sf_dir), fx.bars_events(spark, sf_dir).drop("open")
    )


@_query
def sort_bars(spark, sf_dir):
    return clean.sort_bars(fx.bars_lineitem(spark, sf_dir))


@_query
def dedup_keep_last(spark, sf_dir):
    return clean.dedup_keep_last(
        C.nan_to_null(fx.bars_dirty(spark, sf_dir)), ENRICHED_KEYS, "seq"
    )


# Windows


def _feature(name: str) -> Query:
    def run(spark, sf_dir):
        return _enriched(spark, sf_dir).select("ticker", "date", name)

    return run


QUERIES["daily_return"] = _feature("daily_return_pct")
QUERIES["moving_avg_7"] = _feature("ma_7")
QUERIES["moving_avg_30"] = _feature("ma_30")


@_query
def enriched(spark, sf_dir):
    return _enriched(spark, sf_dir)


@_query
def enriched_dirty(spark, sf_dir):
    """Several bars of one day count one by one."""
    bars = clean.clean_bars(fx.bars_dirty(spark, sf_dir))
    return features.add_features(bars, ["date", "seq"])


@_query
def enriched_dedup_first(spark, sf_dir):
    bars = clean.clean_bars(fx.bars_dirty(spark, sf_dir))
    return features.add_features(bars, ["date", "seq"], dedup_first=True)


@_query
def enriched_hot_tickers(spark, sf_dir):
    """Each of the five tickers, a fifth of all rows, cut into blocks."""
    bars = stored(clean.clean_bars(fx.bars_dirty(spark, sf_dir)), "bars")
    return features.add_features(bars, ["date", "seq"], hot_rows=200)


@_query
def top_gains_per_ticker(spark, sf_dir):
    return analytics.top_gains_per_ticker(_enriched(spark, sf_dir))


@_query
def top_losses_per_ticker(spark, sf_dir):
    return analytics.top_losses_per_ticker(_enriched(spark, sf_dir))


@_query
def top_gains_deep(spark, sf_dir):
    """Lists longer than the rank limit of the map tasks: found in parts of each ticker."""
    return analytics.top_gains_per_ticker(_enriched_five(spark, sf_dir), 1500)


@_query
def golden_cross_events(spark, sf_dir):
    return features.golden_cross_events(_enriched(spark, sf_dir), unique_days=True)


@_query
def last_30_trading_days(spark, sf_dir):
    return analytics.last_30_trading_days(_enriched(spark, sf_dir))


# Aggregates and analyst queries


@_query
def ticker_summary(spark, sf_dir):
    return summary.ticker_summary(_enriched(spark, sf_dir))


@_query
def summary_overview(spark, sf_dir):
    return analytics.summary_overview(summary.ticker_summary(_enriched(spark, sf_dir)))


@_query
def top_gains(spark, sf_dir):
    return analytics.top_gains(_enriched(spark, sf_dir))


@_query
def top_losses(spark, sf_dir):
    return analytics.top_losses(_enriched(spark, sf_dir))


@_query
def monthly_close(spark, sf_dir):
    return analytics.monthly_close(_enriched(spark, sf_dir))


@_query
def ma_regime(spark, sf_dir):
    return analytics.ma_regime(_enriched(spark, sf_dir))


@_query
def most_volatile(spark, sf_dir):
    return analytics.most_volatile(_enriched(spark, sf_dir))


@_query
def recent_performance(spark, sf_dir):
    return analytics.recent_performance(_enriched(spark, sf_dir))


@_query
def recent_performance_table(spark, sf_dir):
    """The same over the stored table, of which two or three months are opened."""
    path = scratch_path(spark, "table")
    _upsert_enriched(_enriched(spark, sf_dir), path)
    return analytics.performance(readers.read_recent(spark, path))


@_query
def date_window_table(spark, sf_dir):
    """A date window of the stored table, of which only its months are opened."""
    path = scratch_path(spark, "table")
    _upsert_enriched(_enriched(spark, sf_dir), path)
    return readers.read_table(spark, path, ENRICHED, *WINDOW)


@_query
def join_summary(spark, sf_dir):
    """Every bar with its ticker's average volume."""
    bars = fx.bars_lineitem(spark, sf_dir)
    averages = summary.ticker_summary(fx.enriched_of(bars))
    joined = analytics.join_summary(bars.select("ticker", "date", "volume"), averages)
    return joined.where(F.col("volume") > F.col("avg_daily_volume") * 2)


@_query
def volume_spikes(spark, sf_dir):
    enriched = _enriched(spark, sf_dir)
    return analytics.volume_spikes(enriched, summary.ticker_summary(enriched))


@_query
def table_row_counts(spark, sf_dir):
    enriched = _enriched(spark, sf_dir)
    return summary.table_row_counts(
        enriched_stocks=enriched, ticker_summary=summary.ticker_summary(enriched)
    )


@_query
def ma_population(spark, sf_dir):
    return summary.ma_population(_enriched(spark, sf_dir))


@_query
def date_extent(spark, sf_dir):
    return summary.date_extent(fx.bars_lineitem(spark, sf_dir))


@_query
def duplicate_keys(spark, sf_dir):
    return summary.duplicate_keys(fx.bars_dirty(spark, sf_dir), ENRICHED_KEYS)


@_query
def distinct_tickers(spark, sf_dir):
    return summary.distinct_tickers(fx.bars_lineitem(spark, sf_dir))


@_query
def null_critical_count(spark, sf_dir):
    return summary.null_critical_count(fx.bars_dirty(spark, sf_dir))


@_query
def bad_price_count(spark, sf_dir):
    return summary.bad_price_count(fx.bars_bad_price(spark, sf_dir))


# Quality


@_query
def missing_tickers(spark, sf_dir):
    return quality.missing_tickers(fx.bars_orders(spark, sf_dir), [*fx.TICKERS, ABSENT])


@_query
def check_row_counts(spark, sf_dir):
    enriched = _enriched_five(spark, sf_dir)
    return quality.check_row_counts(enriched, summary.ticker_summary(enriched))


@_query
def check_null_critical(spark, sf_dir):
    return quality.check_null_critical(fx.bars_dirty(spark, sf_dir))


@_query
def check_duplicates(spark, sf_dir):
    return quality.check_duplicates(fx.bars_dirty(spark, sf_dir))


@_query
def check_price_sanity(spark, sf_dir):
    return quality.check_price_sanity(fx.bars_bad_price(spark, sf_dir))


@_query
def check_tickers_present(spark, sf_dir):
    return quality.check_tickers_present(
        fx.bars_orders(spark, sf_dir), [*fx.TICKERS, ABSENT]
    )


@_query
def check_date_range(spark, sf_dir):
    bars = fx.bars_lineitem(spark, sf_dir)
    return quality.check_date_range(bars, RUN_DATE, START, require_both=True)


@_query
def check_ma_populated(spark, sf_dir):
    return quality.check_ma_populated(_enriched_five(spark, sf_dir))


@_query
def check_ma_populated_short(spark, sf_dir):
    """The failing case: a history shorter than the long frame."""
    return quality.check_ma_populated(fx.enriched_of(fx.bars_events(spark, sf_dir)))


def _report(spark, sf_dir) -> DataFrame:
    enriched = _enriched_five(spark, sf_dir)
    return quality.quality_report(
        enriched, summary.ticker_summary(enriched), fx.TICKERS, RUN_DATE, START
    )


@_query
def quality_report(spark, sf_dir):
    return _report(spark, sf_dir)


@_query
def quality_union(spark, sf_dir):
    """Single checks of bars with every kind of fault, in one frame."""
    dirty, bad = fx.bars_dirty(spark, sf_dir), fx.bars_bad_price(spark, sf_dir)
    return quality.quality_union(
        quality.check_null_critical(dirty),
        quality.check_duplicates(dirty),
        quality.check_price_sanity(bad),
        quality.check_tickers_present(bad, [*fx.TICKERS, ABSENT]),
    )


@_query
def check_tally(spark, sf_dir):
    return quality.check_tally(_report(spark, sf_dir))
