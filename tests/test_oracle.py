"""Every registered query against DuckDB on the same tables."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry

ORACLE = entry.oracle_sql()
QUERIES = entry.queries()
# No SQL. The text operators have tests of their own.
ROWS_ONLY = {q for q in QUERIES if q not in ORACLE and (q.startswith("op") or q == "pipeline")}


# Their window without a partition holds one row for each partition of the data.
OVER_PARTITIONS = {"op3_sharding"}


def _types(relation):
    return dict(zip(relation.columns, map(str, relation.types)))


def _check_plan(df, one_partition=False):
    """No cross or nested-loop join, no window over one partition, no Python."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert node not in plan
    if one_partition:
        return
    # The partition columns come first in a window's definition, unlike an order
    # they carry no direction.
    for first in re.findall(r"windowspecdefinition\(([^,]*),", plan):
        assert " ASC" not in first and " DESC" not in first


@pytest.mark.parametrize("name", sorted(set(QUERIES) - ROWS_ONLY))
def test_query_equals_oracle(name, spark, sf_dir, oracle):
    df = QUERIES[name](spark, sf_dir)
    _check_plan(df, name in OVER_PARTITIONS)
    ours = df.toArrow()
    ours = oracle.from_arrow(ours)
    theirs = oracle.sql(ORACLE[name])
    assert _types(ours) == _types(theirs)
    columns = ", ".join(f'"{c}"' for c in sorted(ours.columns))
    ours, theirs = ours.project(columns), theirs.project(columns)
    assert len(ours) == len(theirs)
    # EXCEPT ALL counts copies, takes NULL as equal to NULL and NaN to NaN.
    assert ours.except_(theirs).limit(5).fetchall() == []
    assert theirs.except_(ours).limit(5).fetchall() == []


def test_every_query_has_an_oracle_or_is_listed():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY
    assert set(ORACLE) <= set(QUERIES)


def test_plan_check_finds_a_window_over_one_partition(spark):
    one = spark.range(3).withColumn("r", F.row_number().over(Window.orderBy("id")))
    with pytest.raises(AssertionError):
        _check_plan(one)
    with pytest.raises(AssertionError):
        _check_plan(spark.range(3).crossJoin(spark.range(2).withColumnRenamed("id", "x")))


def test_entry(spark):
    assert entry.entry(spark).count() > 0
