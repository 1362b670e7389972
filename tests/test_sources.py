import datetime as dt

import pytest
from pyspark.sql import functions as F

from candlework import session
from candlework.operators.features import add_features
from candlework.operators.summary import ticker_summary
from candlework.schemas import BAR_COLUMNS
from candlework.session import scratch_path
from candlework.sources import readers, writers

DAY = dt.date(2024, 1, 1)


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "A_NS_2024-02-01.csv").write_text(
        "date,close,high,low,open,volume,ticker\n2024-01-01,1.5,2,1,1,10,A.NS\n2024-01-02,,2,1,1,10,A.NS\n"
    )
    (tmp_path / "B_NS_2024-02-01.csv").write_text(
        "\nTicker,Volume,Open,Low,High,Close,Date\nB.NS,20,1,1,2,2.5,2024-01-01\n"
    )
    (tmp_path / "C D_2024-02-01.csv").write_text(
        'ticker,date,close,"Trade Count"\n"C, D",2024-01-01,3.5,7\n'
    )
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header only.csv").write_text("ticker,close,date\n")
    (tmp_path / "note.txt").write_text("not,bars\n")
    return str(tmp_path)


def test_csv_by_name(spark, folder):
    got = readers.read_bars_csv(spark, folder)
    assert set(got.columns) == {*BAR_COLUMNS, "trade_count", "seq"}
    rows = {
        (r.ticker, r.date, r.close, r.open, r.volume, r.trade_count) for r in got.collect()
    }
    assert rows == {
        ("A.NS", "2024-01-01", "1.5", "1", "10", None),
        ("A.NS", "2024-01-02", None, "1", "10", None),
        ("B.NS", "2024-01-01", "2.5", "1", "20", None),
        ("C, D", "2024-01-01", "3.5", None, None, "7"),
    }


def test_csv_without_broadcast_of_the_file_list(spark, folder):
    broadcast = readers.read_bars_csv(spark, folder).orderBy("seq").collect()
    limit = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(limit, -1)
    try:
        shuffled = readers.read_bars_csv(spark, folder)
        assert "Broadcast" not in shuffled._jdf.queryExecution().executedPlan().toString()
        assert shuffled.orderBy("seq").collect() == broadcast
    finally:
        spark.conf.unset(limit)


def test_any_number_of_headers(spark, tmp_path):
    # The last column's case, quotes and place differ from file to file.
    for i in range(1_100):
        names = ["date", "close"]
        names.insert(i % 3, "".join(c.upper() if i >> j & 1 else c for j, c in enumerate("ticker name")))
        values = {"date": "2024-01-01", "close": str(i)}
        (tmp_path / f"{i}.csv").write_text(
            ",".join(f'"{n}"' for n in names) + "\n" + ",".join(values.get(n, "A") for n in names) + "\n"
        )
    got = readers.read_bars_csv(spark, str(tmp_path))
    assert set(got.columns) == {"date", "close", "ticker_name", "seq"}
    assert sorted(int(r.close) for r in got.collect()) == list(range(1_100))


@pytest.mark.parametrize("mixed", [False, True])
@pytest.mark.parametrize("columns", [None, ["date", "close", "ticker"]])
def test_a_line_of_too_many_fields_is_an_error(spark, tmp_path, mixed, columns):
    (tmp_path / "a.csv").write_text("date,close,ticker\n2024-01-01,1\n2024-01-01,2,\"A,B\"\n")
    if mixed and columns is None:
        (tmp_path / "b.csv").write_text("ticker,date,close,note\nB,2024-01-01,3,x\n")
    got = readers.read_bars_csv(spark, str(tmp_path), columns)
    assert {("1", None), ("2", "A,B")} <= {(r.close, r.ticker) for r in got.collect()}
    (tmp_path / "c.csv").write_text("date,close,ticker\n2024-01-01,1,A,EXTRA\n")
    with pytest.raises(Exception, match="more fields than columns"):
        readers.read_bars_csv(spark, str(tmp_path), columns).select("close").collect()


def test_known_columns_are_read_in_one_scan(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ticker,close\nA,1\n")
    got = readers.read_bars_csv(spark, str(tmp_path), ["ticker", "close"])
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_sequence_follows_file_names_and_lines(spark, tmp_path):
    for run, closes in (("2024-02-01", "12"), ("2024-02-02", "34")):
        lines = "".join(f"A,2024-01-01,{c}\n" for c in closes)
        (tmp_path / f"A_{run}.csv").write_text("ticker,date,close\n" + lines)
    got = readers.read_bars_csv(spark, str(tmp_path)).orderBy("seq").collect()
    assert [r.close for r in got] == ["1", "2", "3", "4"]


def test_csv_with_known_header_refuses_another(spark, folder, tmp_path_factory):
    with pytest.raises(Exception, match="CSV header"):
        readers.read_bars_csv(spark, folder, ["date", "close", "ticker"]).collect()
    own = tmp_path_factory.mktemp("own")
    (own / "a.csv").write_text("Ticker,Adj Close\nA,1\n")
    got = readers.read_bars_csv(spark, str(own), ["Ticker", "Adj Close"])
    assert [(r.ticker, r.adj_close) for r in got.collect()] == [("A", "1")]


def test_no_files_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="no CSV files"):
        readers.read_bars_csv(spark, str(tmp_path))


class NoFolder:
    """A session without spark.checkpoint.dir."""

    def __init__(self, master):
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})
        self.sparkContext = type("Context", (), {"master": master})


def test_scratch_folder(spark):
    assert session.scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")
    local = session.scratch_root(NoFolder("local[2]"))
    assert local == session.scratch_root(NoFolder("local[2]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(NoFolder("spark://host:7077"))


def test_require_non_empty(spark):
    df = spark.range(1)
    assert readers.require_non_empty(df, "x") is df
    assert readers.require_non_empty(df.where("false"), "x", "skip") is None
    with pytest.raises(FileNotFoundError, match="no rows in x"):
        readers.require_non_empty(df.where("false"), "x")


def test_a_missing_source_counts_as_empty(spark, tmp_path):
    for read in (
        lambda: spark.read.parquet(f"{tmp_path}/none"),
        lambda: readers.read_bars_csv(spark, f"{tmp_path}/none"),
        lambda: readers.read_bars_csv(spark, str(tmp_path)),
    ):
        assert readers.require_non_empty(read, "x", "skip") is None
        with pytest.raises(FileNotFoundError, match="no rows in x"):
            readers.require_non_empty(read, "x")


def bars(spark):
    rows = [
        (t, DAY + dt.timedelta(days=i), 1.0, 2.0, 1.0, float(i + 1), 10 * i)
        for t in ("A.NS", "007")
        for i in range(10)
    ]
    return spark.createDataFrame(
        rows, "ticker string, date date, open double, high double, low double, close double, volume long"
    )


def test_landing_replaces_and_names_by_run(spark):
    path = scratch_path(spark, "raw")
    writers.land_raw(bars(spark), path, dt.date(2024, 2, 1))
    writers.land_raw(bars(spark), path, dt.date(2024, 2, 2), DAY, DAY + dt.timedelta(days=2))
    got = readers.read_bars_csv(spark, path)
    assert got.count() == 4
    keys = {f.split("landing_key=")[1].split("/")[0] for f in spark.read.text(f"{path}/*/*.csv").inputFiles()}
    assert keys == {"A_NS_2024-02-02.csv", "007_2024-02-02.csv"}
    assert {r.ticker for r in got.collect()} == {"A.NS", "007"}


def test_landing_heeds_each_bound_by_itself(spark):
    for bounds, n in (({"start": DAY + dt.timedelta(days=7)}, 6), ({"end": DAY + dt.timedelta(days=2)}, 4)):
        path = scratch_path(spark, "raw")
        writers.land_raw(bars(spark), path, DAY, **bounds)
        assert readers.read_bars_csv(spark, path).count() == n


def test_landing_splits_a_large_ticker(spark):
    path = scratch_path(spark, "raw")
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "20k")
    try:
        rows = spark.range(0, 20_000, 1, 8).selectExpr(
            "IF(id % 3 = 0, 'HOT', 'T' || id % 50) AS ticker", "DATE'2024-01-01' AS date", "id / 7 AS close"
        )
        writers.land_raw(rows, path, DAY)
    finally:
        spark.conf.unset(size)
    assert len(spark.read.text(f"{path}/landing_key=HOT_2024-01-01.csv").inputFiles()) > 1
    assert readers.read_bars_csv(spark, path).count() == 20_000


def test_lake_round_trip(spark):
    root = scratch_path(spark, "lake")
    enriched = add_features(bars(spark))
    summary = ticker_summary(enriched)
    writers.publish_lake(bars(spark), enriched, summary, root, DAY)
    stored = readers.read_enriched(spark, f"{root}/processed/enriched_stocks.parquet")
    assert sorted(map(str, stored.collect())) == sorted(
        map(str, enriched.select(*stored.columns).collect())
    )
    back = readers.read_summary_csv(spark, f"{root}/processed/ticker_summary.csv")
    assert sorted(map(str, back.collect())) == sorted(map(str, summary.collect()))
    manifest = readers.lake_manifest(spark, root).collect()
    assert {r.path.split(root)[1].split("/")[1] for r in manifest} == {"raw", "processed"}
    assert all(r.size_kb > 0 for r in manifest if r.path.endswith(".parquet"))


def test_tables_answer_sql(spark):
    enriched = add_features(bars(spark))
    readers.register_tables(spark, enriched, ticker_summary(enriched))
    got = spark.sql(
        """
        SELECT e.ticker, count(*) AS n FROM enriched_stocks e
        JOIN ticker_summary t ON e.ticker = t.ticker
        WHERE e.volume > t.avg_daily_volume * 1.5
          AND date >= (SELECT MAX(date) - INTERVAL '30 days' FROM enriched_stocks)
        GROUP BY e.ticker ORDER BY e.ticker
        """
    )
    assert [tuple(r) for r in got.collect()] == [("007", 3), ("A.NS", 3)]


def test_date_window_reaches_the_scan(spark):
    from candlework.operators.clean import date_window

    path = scratch_path(spark, "bars")
    writers.write_enriched(bars(spark), path)
    got = date_window(spark.read.parquet(path), DAY, DAY + dt.timedelta(days=3))
    assert got.count() == 6
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date,2024-01-01)" in plan and "LessThan(date,2024-01-04)" in plan
    assert got.where(F.col("date") == DAY).count() == 2


def test_many_raw_files_are_dealt_over_several_tasks_a_core_and_listed_by_few(spark):
    path, cores = scratch_path(spark, "raw"), spark.sparkContext.defaultParallelism
    settings = {"spark.sql.shuffle.partitions": "100", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "100b"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        days = "explode(sequence(DATE'2024-01-01', DATE'2024-01-20')) AS date"
        rows = spark.range(0, 200, 1, 8).selectExpr("'T' || id AS ticker", days, "id / 7 AS close")
        writers.land_raw(rows, path, DAY)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        got = readers.read_bars_csv(spark, path, ["ticker", "date", "close"])
        stages = [s for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert stages and max(tracker.getStageInfo(s).numTasks for s in stages) <= 4 * cores
    files = got.inputFiles()
    assert len(files) == 200 and len({f.split("/part-")[1][:5] for f in files}) > 2 * cores
    assert got.count() == 4000
    assert spark.conf.get(writers.LEAST_TASKS, None) is None and spark.conf.get(readers.LISTING_TASKS, None) is None
