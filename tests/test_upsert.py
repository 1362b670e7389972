import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from candlework.operators.upsert import conform_schema, constraint_violations, merge_upsert
from candlework.schemas import ENRICHED
from candlework.session import scratch_path
from candlework.sources.writers import upsert_table

SCHEMA = "k string, d date, kept double, changed double"
JAN, FEB, MAR = (dt.date(2024, m, 5) for m in (1, 2, 3))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def sides(spark):
    existing = spark.createDataFrame(
        [("A", JAN, 1.0, 1.0), ("A", FEB, 2.0, 2.0), ("B", FEB, None, 3.0)], SCHEMA
    )
    incoming = spark.createDataFrame(
        [("A", FEB, 9.0, None), ("B", FEB, 9.0, 9.0), ("A", MAR, 4.0, 4.0)], SCHEMA
    )
    expected = [
        ("A", JAN, 1.0, 1.0),
        ("A", FEB, 2.0, None),  # a NULL that arrives overwrites
        ("B", FEB, None, 9.0),  # a stored NULL is kept
        ("A", MAR, 4.0, 4.0),
    ]
    return existing, incoming, sorted(expected, key=str)


def test_merge(spark):
    existing, incoming, expected = sides(spark)
    once = merge_upsert(existing, incoming, ["k", "d"], ["changed"])
    assert rows_of(once) == expected
    assert once.columns == existing.columns
    assert rows_of(merge_upsert(once, incoming, ["k", "d"], ["changed"])) == expected


def test_merge_updates_all_columns_by_default(spark):
    existing, incoming, _ = sides(spark)
    got = rows_of(merge_upsert(existing, incoming, ["k", "d"]))
    assert ("A", FEB, 9.0, None) in got and ("B", FEB, 9.0, 9.0) in got


def test_table_upsert_touches_only_its_months(spark):
    existing, incoming, expected = sides(spark)
    path = scratch_path(spark, "t")
    month = F.trunc("d", "MM")
    upsert_table(existing, path, existing.schema, ["k", "d"], ["changed"], month)

    def january():
        return sorted(spark.read.parquet(f"{path}/slice=2024-01-01").inputFiles())

    before = january()
    for _ in range(2):
        upsert_table(incoming, path, existing.schema, ["k", "d"], ["changed"], month)
        stored = spark.read.parquet(path).drop("slice").select(*existing.columns)
        assert rows_of(stored) == expected
    assert january() == before


def test_table_upsert_takes_the_last_row_of_a_key_and_no_nan(spark):
    path = scratch_path(spark, "t")
    rows = [("A", JAN, float("nan"), 1.0, 1), ("A", JAN, float("nan"), 2.0, 2)]
    df = spark.createDataFrame(rows, SCHEMA + ", seq int")
    schema = df.drop("seq").schema
    month = F.trunc("d", "MM")
    upsert_table(df, path, schema, ["k", "d"], ["changed"], month, last_by="seq")
    stored = spark.read.parquet(path).select(*schema.fieldNames())
    assert rows_of(stored) == [("A", JAN, None, 2.0)]


def test_conform_casts_and_refuses_overflow(spark):
    base = dict.fromkeys(ENRICHED.fieldNames())
    base.update(ticker="A", date=dt.date(2024, 1, 1), close=1.5, volume=3)
    schema = (
        "ticker string, date date, open double, high double, low double, close double, volume long,"
        "daily_return_pct double, ma_7 double, ma_30 double, daily_range double"
    )
    df = spark.createDataFrame([tuple(base.values())], schema)
    row = conform_schema(df.select(*reversed(df.columns)), ENRICHED).first()
    assert list(row.asDict()) == ENRICHED.fieldNames() and row.close == Decimal("1.50")
    with pytest.raises(PySparkException):
        conform_schema(df.withColumn("close", F.lit(1e11)), ENRICHED).collect()
    for required in ("ticker", "date", "close"):
        with pytest.raises(PySparkException, match=f"{required} is missing"):
            conform_schema(df.withColumn(required, F.lit(None)), ENRICHED).collect()


def test_constraints(spark):
    enriched = spark.createDataFrame(
        [("A", JAN, 1.0), ("A", JAN, 1.0), (None, JAN, 1.0), (None, JAN, None), ("B", None, 1.0)],
        "ticker string, date date, close double",
    )
    summary = spark.createDataFrame([("A",), ("A",), ("B",)], "ticker string")
    got = {r.constraint_name: r.n_violations for r in constraint_violations(enriched, summary).collect()}
    assert got == {
        "enriched_stocks.ticker not null": 2,
        "enriched_stocks.date not null": 1,
        "enriched_stocks.close not null": 1,
        "enriched_stocks.ticker length": 0,
        "enriched_stocks.(ticker,date) unique": 1,
        "ticker_summary.ticker not null": 0,
        "ticker_summary.ticker length": 0,
        "ticker_summary.(ticker) unique": 1,
    }


def test_a_doubled_incoming_key_is_an_error(spark):
    existing, incoming, expected = sides(spark)
    twice, path, month = incoming.union(incoming), scratch_path(spark, "t"), F.trunc("d", "MM")
    with pytest.raises(PySparkException, match="several rows for"):
        merge_upsert(existing, twice, ["k", "d"]).collect()
    for _ in range(2):  # the first load, then one into a table
        with pytest.raises(PySparkException, match="several rows for"):
            upsert_table(twice, path, existing.schema, ["k", "d"], ["changed"], month)
        upsert_table(existing, path, existing.schema, ["k", "d"], ["changed"], month)
    for _ in range(2):  # the same once more changes nothing
        upsert_table(incoming, path, existing.schema, ["k", "d"], ["changed"], month)
        assert rows_of(spark.read.parquet(path).drop("slice")) == expected


def test_slices_are_those_of_the_typed_rows(spark):
    path, bucket = scratch_path(spark, "t"), F.pmod(F.xxhash64("k"), F.lit(4)).cast("int")
    stored = spark.range(40).selectExpr("string(id) AS k", "id AS v")
    upsert_table(stored, path, stored.schema, ["k"], ["v"], bucket)
    upsert_table(spark.range(3).selectExpr("id AS k", "id + 100 AS v"), path, stored.schema, ["k"], ["v"], bucket)
    got = {r.k: r.v for r in spark.read.parquet(path).collect()}
    assert got == {str(i): i + 100 * (i < 3) for i in range(40)}


def test_a_ticker_has_a_length(spark):
    row = spark.createDataFrame([("T" * 21, JAN, 1.0)], "ticker string, date date, close double")
    full = row.select("*", *[F.lit(None).cast("double").alias(f.name) for f in ENRICHED.fields[2:] if f.name != "close"])
    with pytest.raises(PySparkException, match="ticker is too long"):
        conform_schema(full, ENRICHED).collect()
    got = {r.constraint_name: r.n_violations for r in constraint_violations(full, full.select("ticker")).collect()}
    assert got["enriched_stocks.ticker length"] == got["ticker_summary.ticker length"] == 1


def test_new_slices_are_inserted_beside_merged_ones(spark):
    path, month, schema = scratch_path(spark, "t"), F.trunc("d", "MM"), spark.createDataFrame([], SCHEMA).schema
    old = [("A", JAN, 1.0, 1.0), ("B", FEB, 2.0, 2.0)]
    new = [("A", JAN, 9.0, 9.0), ("C", JAN, 3.0, 3.0), ("A", MAR, 4.0, 4.0), (None, MAR, 5.0, 5.0), ("A", None, 6.0, 6.0)]
    for rows in (old, new):
        upsert_table(spark.createDataFrame(rows, schema), path, schema, ["k", "d"], ["changed"], month)
    got = rows_of(spark.read.parquet(path).select(*schema.fieldNames()))
    assert got == sorted([("A", JAN, 1.0, 9.0), old[1], *new[1:]], key=str)
