"""Shapes of physical plans that matter at scale."""

import datetime as dt
import re

import pytest

from candlework.operators import analytics, clean, features, quality, summary, upsert
from candlework.plans import catalog
from candlework.plans import fixtures as fx
from candlework import session
from candlework.schemas import ENRICHED
from candlework.session import scratch_path
from candlework.sources import readers, writers
from candlework.sources.writers import write_enriched


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    path = scratch_path(spark, "bars")
    write_enriched(fx.bars_lineitem(spark, sf_dir), path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def table(spark, stored):
    path = scratch_path(spark, "enriched")
    write_enriched(fx.enriched_of(stored), path)
    return spark.read.parquet(path)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"\bExchange ", plan_of(df)))


def test_features_take_one_shuffle_and_one_sort(stored):
    df = fx.enriched_of(stored)
    plan = plan_of(df)
    assert exchanges(df) == 1
    assert len(re.findall(r"\bSort \[", plan)) == 1
    # The summary of the same rows needs no shuffle of its own.
    assert exchanges(summary.ticker_summary(df)) == 1


def test_writing_features_needs_no_further_sort(stored):
    df = fx.enriched_of(stored).sortWithinPartitions("ticker", "date")
    assert exchanges(df) == 1 and len(re.findall(r"\bSort \[", plan_of(df))) == 1


def test_top_k_keeps_no_global_sort(table):
    for df in (analytics.top_gains(table), analytics.most_volatile(table), analytics.ma_regime(table)):
        assert "TakeOrderedAndProject" in plan_of(df) and exchanges(df) == 0


def test_rank_limits_apply_before_the_shuffle(table, stored):
    for df in (
        analytics.top_gains_per_ticker(table),
        analytics.last_30_trading_days(table),
        clean.dedup_keep_last(stored.withColumn("seq", stored.volume), ["ticker", "date"], "seq"),
    ):
        plan = plan_of(df)
        assert re.search(r"WindowGroupLimit.*Partial", plan)


def test_filters_and_columns_reach_the_scan(table):
    plan = plan_of(analytics.top_gains(table))
    assert "IsNotNull(daily_return_pct)" in plan
    assert "ReadSchema: struct<ticker:string,date:date,close:double,daily_return_pct:double>" in plan
    counted = plan_of(summary.ma_population(table))
    assert "ReadSchema: struct<ma_7:double,ma_30:double>" in counted


def test_volume_spikes_broadcast_only_a_small_summary(table):
    own = session.stored(summary.ticker_summary(table), "summary")
    small = analytics.volume_spikes(table, own)
    assert "BroadcastHashJoin" in plan_of(small)
    spark = table.sparkSession
    limit = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(limit, -1)  # as if the summary were too large for Spark as well
    try:
        large = analytics.volume_spikes(table, own)
        assert "SortMergeJoin" in plan_of(large)
        assert large.collect() == small.collect()
    finally:
        spark.conf.unset(limit)


def test_report_shuffles_keys_alone(table, spark):
    own = spark.createDataFrame([("S1",)], "ticker string")
    plan = plan_of(quality.quality_report(table, own, ["S1"], dt.date(2001, 8, 1)))
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", plan)
    assert sorted(schemas) == [
        "ticker:string,date:date",
        "ticker:string,date:date,close:double,ma_7:double,ma_30:double",
    ]
    assert len(re.findall(r"Exchange hashpartitioning\(ticker#\d+, date#\d+", plan)) == 1


def test_upsert_joins_on_the_whole_key(table):
    existing, incoming = fx.upsert_pair(table)
    plan = plan_of(upsert.merge_upsert(existing, incoming, ["ticker", "date"], ["close"]))
    assert re.search(r"(SortMergeJoin|ShuffledHashJoin) \[ticker#\d+, date#\d+\]", plan)


def test_golden_cross_takes_one_shuffle(table):
    assert exchanges(features.golden_cross_events(table, unique_days=True)) == 1


def test_volume_spikes_are_planned_without_a_job(spark, stored):
    enriched = fx.enriched_of(stored)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    try:
        analytics.volume_spikes(enriched, summary.ticker_summary(enriched))
        assert tracker.getJobIdsForGroup("planning") == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_stored_table_opens_only_the_months_in_question(table):
    spark, path = table.sparkSession, scratch_path(table.sparkSession, "table")
    keys, updates = ["ticker", "date"], ["close"]
    writers.upsert_table(table, path, ENRICHED, keys, updates, writers.enriched_slice())
    plan = plan_of(readers.read_table(spark, path, ENRICHED, dt.date(1997, 5, 9), dt.date(1997, 7, 1)))
    assert re.search(r"PartitionFilters: \[[^]]*slice#\d+ >= 1997-05-01[^]]*slice#\d+ < 1997-07-01", plan)
    recent = readers.read_recent(spark, path)
    assert re.search(r"PartitionFilters: \[.*slice#\d+ >= .*[Ss]ubquery", plan_of(recent)), plan_of(recent)[:3000]
    assert sorted(recent.select(*keys).collect()) == sorted(
        analytics.recent_days(table).select(*keys).collect()
    )


def test_a_load_of_features_shuffles_them_once_before_the_months(stored, monkeypatch):
    """The check for doubled keys takes the rows as the windows leave them; a later load
    joins only rows of months that the table holds."""
    written, by_folder = [], writers._by_folder
    monkeypatch.setattr(writers, "_by_folder", lambda df, *by: written.append(df) or by_folder(df, *by))
    path = scratch_path(stored.sparkSession, "table")
    for rows in fx.upsert_pair(fx.enriched_of(stored)):
        writers.upsert_table(rows, path, ENRICHED, ["ticker", "date"], ["close"], writers.enriched_slice())
    assert exchanges(written[0]) == 1
    assert len(re.findall(r"PartitionFilters: \[[^]]*slice#\d+ = 2000-05-01", plan_of(written[1]))) >= 1
    assert re.search(r"Filter .*slice#\d+ = 2000-05-01", plan_of(written[1]))


def test_the_stored_upsert_builds_its_bars_once(spark, sf_dir, monkeypatch):
    scans, table_of = [], fx.table
    monkeypatch.setattr(fx, "table", lambda *args: scans.append(args) or table_of(*args))
    writes, store = [], catalog.stored
    monkeypatch.setattr(catalog, "stored", lambda df, name: writes.append(name) or store(df, name))
    catalog.upsert_enriched_table(spark, sf_dir)
    assert len(scans) == 1 and writes == ["bars"]
