"""Row-based windows per ticker that hold up when one ticker is very large.

A plain ``Window.partitionBy("ticker")`` runs each ticker in one task. That is
right while tickers are of ordinary size. A ticker above ``hot_rows`` is instead
cut into blocks of consecutive rows; each block also receives the ``reach`` rows
that precede it, so every window sees what it would have seen uncut.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from candlework.session import stored

# A window task of this many bars sorts and spills comfortably.
HOT_ROWS = 5_000_000

Step = Callable[[WindowSpec], dict[str, Column]]


def hot_tickers(df: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``ticker`` of all tickers with more than ``hot_rows`` rows, however many."""
    sizes = df.groupBy("ticker").count().where(F.col("count") > hot_rows)
    return sizes.select("ticker")


def range_sorted(df: DataFrame, *by: str) -> DataFrame:
    """``df`` globally sorted by ``by``, in partitions of even size.

    Rows that tie on ``by`` are told apart by their content and, when they are the
    same in every column, by a scan id; so even a group of copies spreads over many
    partitions. Swapping such ids between equal rows changes nothing, hence a
    re-run task cannot alter the result.
    """
    rest = [c for c in df.columns if c not in by]
    total_order = [*by, *rest, "_scan_id"]
    return (
        df.withColumn("_scan_id", F.monotonically_increasing_id())
        .repartitionByRange(*total_order)
        .sortWithinPartitions(*total_order)
        .drop("_scan_id")
    )


def over_ticker(
    df: DataFrame,
    order_by: Sequence[str],
    steps: Sequence[Step],
    reach: int,
    *,
    unique_days: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add the columns of ``steps``, computed over each ticker's rows in order.

    Each step maps the ordered window to new columns and may use the columns of
    the step before; no step may look back further than ``reach`` rows in all.
    Rows without a ticker belong to no series and are left out; rows that tie on
    ``order_by`` are ordered by their content.

    ``unique_days`` says that (ticker, date) is unique; a second bar of a day is an
    error, found in the same window. A ticker then has at most one row per calendar
    day, which bounds its task, and no size check is run. ``order_by`` has to begin with
    ``date``. Otherwise ``df`` is read up to three times (its tickers for the check, then the
    ordinary and the very large ones): give a stored one.
    """
    df = df.where(F.col("ticker").isNotNull())
    if not unique_days:
        rest = [c for c in df.columns if c != "ticker" and c not in order_by]
        order_by = [*order_by, *rest]
    window = Window.partitionBy("ticker").orderBy(*order_by)
    if unique_days:
        if order_by[0] != "date":
            raise ValueError("days can be told to be unique only in order of date")
        return _apply(_one_bar_a_day(df, window), window, steps)
    hot = stored(hot_tickers(df, hot_rows), "hot")
    if hot.isEmpty():
        return _apply(df, window, steps)
    cold = _apply(df.join(hot, "ticker", "left_anti"), window, steps)
    large = df.join(hot, "ticker", "left_semi")
    return cold.unionByName(_in_blocks(large, order_by, steps, reach, hot_rows))


def _one_bar_a_day(df: DataFrame, window: WindowSpec) -> DataFrame:
    """``df``, with an error for a ticker's second bar of a day."""
    message = F.concat(F.lit("several bars of "), F.col("ticker"), F.lit(" on "), F.col("date").cast("string"))
    several = F.col("_day_before") == F.col("date")
    one = F.when(several, F.raise_error(message).cast("boolean")).otherwise(True)
    return df.withColumn("_day_before", F.lag("date").over(window)).where(one).drop("_day_before")


def _apply(df: DataFrame, window: WindowSpec, steps: Sequence[Step]) -> DataFrame:
    for step in steps:
        df = df.withColumns(step(window))
    return df


def _in_blocks(
    df: DataFrame,
    order_by: Sequence[str],
    steps: Sequence[Step],
    reach: int,
    hot_rows: int,
) -> DataFrame:
    block_rows = max(hot_rows, reach)

    # 1. Sort, and number the rows. The partition bounds come from a sample, so the
    # outcome is written down: the two readings below must agree.
    ranged = stored(
        range_sorted(df, "ticker", *order_by)
        .withColumn("_partition", F.spark_partition_id())
        .withColumn("_position", F.monotonically_increasing_id()),
        "ranged",
    )

    # 2. First position and row count of each ticker within each partition: one
    # row per partition and ticker boundary, so its size is bounded by the
    # number of partitions plus the number of hot tickers.
    runs = ranged.groupBy("ticker", "_partition").agg(
        F.min("_position").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    earlier = (
        Window.partitionBy("ticker")
        .orderBy("_partition")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    runs = runs.select(
        "ticker",
        "_partition",
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias(
            "_shift"
        ),
    )

    # 3. Row number within the ticker, its block, and a copy of the last ``reach``
    # rows of each block for the next one.
    numbered = ranged.join(runs, ["ticker", "_partition"]).withColumn(
        "_row", F.col("_position") + F.col("_shift")
    )
    block = F.expr(f"_row div {block_rows}L")
    leads = F.col("_row") % block_rows >= block_rows - reach
    blocks = numbered.withColumn("_block", block).withColumn(
        "_home",
        F.explode(
            F.when(leads, F.array("_block", F.col("_block") + 1)).otherwise(
                F.array("_block")
            )
        ),
    )
    within = Window.partitionBy("ticker", "_home").orderBy("_row")
    done = _apply(blocks, within, steps).where("_home = _block")
    return done.drop("_partition", "_position", "_shift", "_row", "_block", "_home")
