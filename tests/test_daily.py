"""The daily run over new files against the run over all files, and what it reads and leaves."""

import datetime as dt
import os
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from candlework.operators.quality import quality_report
from candlework.operators.summary import merge_states, summary_of, summary_state, ticker_summary
from candlework.plans import daily, pipeline
from candlework.plans import fixtures as fx
from candlework.schemas import BAR_COLUMNS, ENRICHED
from candlework.session import delete_folder, run_scratch, scratch_path, scratch_root, stored
from candlework.sources import readers, releases
from candlework.sources.writers import land_raw

RUN, START = dt.date(2001, 8, 1), dt.date(1995, 1, 1)
BUCKETS = 4


@pytest.fixture(scope="module")
def bars(spark, sf_dir):
    return stored(fx.bars_orders(spark, sf_dir).where("date < '1996-01-01'"), "bars")


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def run(spark, raw, root, columns=None):
    return daily.run(spark, raw, root, fx.TICKERS, RUN, START, columns, BUCKETS).collect()


def tables(spark, root):
    return [t.drop("slice") for t in daily.tables(spark, root, BUCKETS)]


def run_folders(spark):
    return [f for f in os.listdir(scratch_root(spark)) if f.startswith("run-")]


def test_runs_over_new_files_equal_runs_over_all_files(spark, bars, monkeypatch):
    """In order, late, restated, doubled, out of order by file, a new ticker; a run that is
    stopped, one without a new file; the months that each opens and writes; what is pruned."""
    raw, root, full = (scratch_path(spark, name) for name in ("raw", "tables", "full"))
    opened, held = [], []
    read = releases.Releases.read

    def reading(self, table, schema, kind, only=None):
        opened.append((table, None if only is None else sorted(map(str, only))))
        return read(self, table, schema, kind, only)

    def months_opened(*names):
        return {m for table, only in opened if table in names for m in (["all"] if only is None else only)}

    def months_written(table):
        base = releases.Releases(spark, root)
        return {s for (t, s), n in base.slices.items() if t == table and n == base.number}

    def arrive(name, landed):
        """Both ways after the landing; returns the new table."""
        land_raw(landed, f"{raw}/{name}", RUN)
        opened.clear()
        with monkeypatch.context() as m:
            m.setattr(releases.Releases, "read", reading)
            report = run(spark, raw, root, BAR_COLUMNS)
        expected = pipeline.run(spark, raw, full, fx.TICKERS, RUN, START, BAR_COLUMNS).collect()
        ours, theirs = tables(spark, root), pipeline.tables(spark, full)
        assert same(ours[0], theirs[0]) and same(ours[1], theirs[1]), name
        # The report needs no bar, and says what a look at all bars says.
        assert report == expected == quality_report(*ours, fx.TICKERS, RUN, START).collect()
        held.append((ours[0], theirs[0].count()))

    # The lists of files are written into one now and then.
    monkeypatch.setattr(daily, "LEDGER_SLICES", 3)

    missing = "ticker = '2-HIGH' AND dayofyear(date) % 50 = 7"
    old = "date < '1995-08-10'"
    arrive("m", bars.where(f"{old} AND NOT ({missing}) AND ticker <> '5-LOW'"))
    assert len(months_written("enriched_stocks")) == 8

    # The next day: its month alone.
    arrive("n", bars.where("date = '1995-08-10' AND ticker <> '5-LOW'"))
    assert months_written("enriched_stocks") == months_written("bars") == {"1995-08-01"}
    assert months_opened("bars", "enriched_stocks") == {"1995-08-01"}

    # One late bar: the months around it, found in doubling steps, and those that it changes.
    late = bars.where(f"{missing} AND date < '1995-04-01'").orderBy(F.desc("date")).limit(1)
    day = late.first()["date"]
    assert dt.date(1995, 2, 20) < day
    arrive("o", late)
    assert months_written("enriched_stocks") <= {"1995-02-01", "1995-03-01", "1995-04-01", "1995-05-01"}
    assert months_opened("bars") <= {f"1995-0{i}-01" for i in range(1, 7)}

    # A ticker's whole past, the other missing days, and restated days whose file comes first
    # in order of path: of the doubled days the later file's bar stays last.
    restated = "date >= '1995-05-03' AND date < '1995-06-01' AND ticker IN ('1-URGENT', '3-MEDIUM')"
    more = bars.where(f"{old} AND (ticker = '5-LOW' OR {missing} AND date <> DATE'{day}')")
    first = bars.where(restated).withColumns({"close": F.col("close") + 2, "open": F.col("open") + 5})
    land_raw(first, f"{raw}/a", RUN)

    def stopped(*args):
        raise KeyboardInterrupt

    before = [sorted(map(str, t.collect())) for t in tables(spark, root)]
    with monkeypatch.context() as m:
        # After the bars, the enriched months and the counts are written.
        m.setattr(daily, "_write_state", stopped)
        with pytest.raises(KeyboardInterrupt):
            run(spark, raw, root)
    assert [sorted(map(str, t.collect())) for t in tables(spark, root)] == before
    assert not run_folders(spark)
    arrive("p", more)

    # Restated again, after all the others; the rest; the first bar of all.
    plus_one = {"close": F.col("close") + 1, "volume": F.col("volume") + 1}
    rest = bars.where(f"date > '1995-08-10' OR ticker = '5-LOW' AND NOT {old}")
    earliest = bars.where("date = '1995-03-01'").withColumn("date", F.lit(dt.date(1994, 12, 30)))
    arrive("q", rest.unionByName(earliest).unionByName(bars.where(restated).withColumns(plus_one)))

    # Without a new file nothing is read and nothing written.
    def never(*args, **kwargs):
        raise AssertionError("bars are read")

    with monkeypatch.context() as m:
        m.setattr(daily, "read_bars_csv", never)
        run(spark, raw, root)
    base = releases.Releases(spark, root)
    assert base.number == 5 and not run_folders(spark)
    assert base.slices_of("raw_files") == ["4", "5"]
    with pytest.raises(ValueError, match="is stored in 4 buckets, not 8"):
        daily.tables(spark, root, 8)
    with pytest.raises(ValueError, match="buckets"):
        base.next_run().write(base.read("ticker_summary", daily.SUMMARY, daily.BUCKET).drop("slice"), "ticker_summary",
                              daily.summary_slice(), "ticker", key="ticker", buckets=2)
    read_for_report = {f.split("/run=")[0].rsplit("/", 1)[1] for f in daily.report(base, fx.TICKERS, RUN, START).inputFiles()}
    assert read_for_report == {"month_counts", "ticker_state", "ticker_summary"}

    # Old releases go; readers of the kept ones are not disturbed.
    gone = releases.prune(spark, root, keep=2)
    assert any("/run=" in g for g in gone) and len([g for g in gone if "/release=" in g]) == 3
    for table, n in held[3:]:
        assert table.count() == n
    assert releases.prune(spark, root, keep=2) == []


def test_a_changed_file_is_an_error_and_a_missing_one_is_not(spark, tmp_path):
    raw, root = f"{tmp_path}/raw", f"{tmp_path}/tables"
    os.makedirs(raw)
    line = "A,2024-01-0{},1,1,1,{},5\n"
    header = "ticker,date,open,high,low,close,volume\n"
    with open(f"{raw}/a[1]{{x}}.csv", "w") as f:
        f.write(header + line.format(1, 10) + line.format(2, 11))
    run(spark, raw, root)
    assert tables(spark, root)[0].count() == 2
    with open(f"{raw}/b.csv", "w") as f:
        f.write(header + line.format(3, 12))
    os.remove(f"{raw}/a[1]{{x}}.csv")
    run(spark, raw, root)
    got = {r["date"].day: r["daily_return_pct"] for r in tables(spark, root)[0].collect()}
    assert {d: r and float(r) for d, r in got.items()} == {1: None, 2: 10.0, 3: 9.0909}
    with open(f"{raw}/b.csv", "a") as f:
        f.write(line.format(4, 13))
    with pytest.raises(PySparkException, match="changed since it was read"):
        run(spark, raw, root)
    assert tables(spark, root)[0].count() == 3


def test_files_without_bars(spark, tmp_path):
    raw, root = f"{tmp_path}/raw", f"{tmp_path}/tables"
    assert len(run(spark, raw, root)) == 7  # no such folder: the report of empty tables
    os.makedirs(raw)
    with open(f"{raw}/a.csv", "w") as f:
        f.write("ticker,date,open,high,low,close,volume\nA,2024-01-01,1,1,1,,5\n")
    report = run(spark, raw, root)
    assert not report[0]["passed"] and releases.Releases(spark, root).number == 1
    run(spark, raw, root)
    assert releases.Releases(spark, root).number == 1


def test_states_of_parts_add_up(spark, bars):
    enriched = stored(fx.enriched_of(bars).unionByName(fx.enriched_of(bars.limit(3))), "enriched")
    parts = [enriched.where(F.month("date") % 3 == i) for i in range(3)]
    states = summary_state(parts[0]).unionByName(summary_state(parts[1])).unionByName(summary_state(parts[2]))
    assert same(summary_of(merge_states(states)), ticker_summary(enriched))
    assert summary_of(merge_states(summary_state(enriched.limit(0)))).count() == 0


def test_published_tables_need_no_shuffle_by_ticker(spark, bars):
    from candlework.operators import analytics, features

    enriched = stored(fx.enriched_of(bars), "enriched")
    root = scratch_path(spark, "published")
    daily.publish_tables(enriched, ticker_summary(enriched), root, BUCKETS)
    table, summary = daily.tables(spark, root, BUCKETS)
    assert same(table.drop("slice"), daily.conform_schema(enriched, ENRICHED))

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    for df in (
        analytics.volume_spikes(table, summary.hint("merge"), n=None),
        analytics.last_30_trading_days(table),
        features.add_features(table.select(*BAR_COLUMNS), unique_days=True),
        analytics.top_gains_per_ticker(table),
        ticker_summary(table),
    ):
        assert "hashpartitioning(ticker" not in plan(df), plan(df)
    # A filter on the month opens that month alone.
    one = plan(table.where("slice = DATE'1996-05-01'"))
    assert re.search(r"PartitionFilters: \[[^\]]*slice", one)
    # Published again, the tables are replaced as a whole.
    daily.publish_tables(enriched.where("ticker = '5-LOW'"), summary.limit(0).drop("slice"), root, BUCKETS)
    table, summary = daily.tables(spark, root, BUCKETS)
    assert table.select("ticker").distinct().count() == 1 and summary.count() == 0


def test_run_scratch_is_deleted(spark):
    with run_scratch(spark) as outer:
        path = scratch_path(spark, "x")
        spark.range(3).write.parquet(path)
        assert path.startswith(outer)
        with run_scratch(spark) as inner:
            assert inner == outer
        assert os.path.exists(path)
    assert not os.path.exists(path)
    with pytest.raises(ValueError), run_scratch(spark) as folder:
        stored(spark.range(3), "y")
        raise ValueError
    assert not os.path.exists(folder)
    delete_folder(spark, folder)
    assert not scratch_path(spark, "z").startswith(folder)


def test_reading_several_paths_by_name(spark, tmp_path):
    for name, text in (("a", "date,close\n2024-01-01,1\n"), ("b", "close,date\n2,2024-01-02\n"), ("c", "date\n")):
        with open(f"{tmp_path}/{name}.csv", "w") as f:
            f.write(text)
    got = readers.read_bars_csv(spark, [f"{tmp_path}/a.csv", f"{tmp_path}/b.csv"])
    assert sorted((r["date"], r["close"]) for r in got.collect()) == [("2024-01-01", "1"), ("2024-01-02", "2")]
