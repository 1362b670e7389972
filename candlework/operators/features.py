"""Per-ticker features of bars."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from candlework.functions.columns import daily_range
from candlework.functions.numeric import (
    PRICE_DIGITS,
    RETURN_DIGITS,
    divide,
    from_units,
    mean_of_units,
    to_units,
)
from candlework.operators.clean import dedup_keep_last
from candlework.operators.ordered import HOT_ROWS, over_ticker

FRAMES = [7, 30]
# The rows before a row that its features depend on.
REACH = max(FRAMES) - 1


def _running(window: WindowSpec) -> dict[str, Column]:
    """Previous close, and the sum and count of closes so far."""
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return {
        "_previous": F.lag("_cents").over(window),
        "_sum": F.coalesce(F.sum("_cents").over(so_far), F.lit(0)),
        "_count": F.count("_cents").over(so_far),
    }


def _before_frame(frames: Sequence[int]):
    """The running sum and count as they stood just before each frame.

    Their difference to the current row's is the frame's own sum and count, so
    a row costs the same for any frame length. Cents are whole numbers, hence
    the difference is exact.
    """

    def step(window: WindowSpec) -> dict[str, Column]:
        columns = {}
        for n in frames:
            columns[f"_sum_{n}"] = F.lag("_sum", n, 0).over(window)
            columns[f"_count_{n}"] = F.lag("_count", n, 0).over(window)
        return columns

    return step


def _return_pct() -> Column:
    # 100 for percent times 10**4 for the return's units; the cents cancel out.
    change = (F.col("_cents") - F.col("_previous")) * 1_000_000
    return from_units(divide(change, F.col("_previous")), RETURN_DIGITS)


def _moving_average(n: int) -> Column:
    full = F.col("_count") - F.col(f"_count_{n}") == n
    total = F.col("_sum") - F.col(f"_sum_{n}")
    return F.when(full, mean_of_units(total, F.lit(n), PRICE_DIGITS))


def add_features(
    bars: DataFrame,
    order_by: str | Sequence[str] = "date",
    *,
    dedup_first: bool = False,
    unique_days: bool = False,
    hot_rows: int = HOT_ROWS,
    also: Callable[[WindowSpec], dict[str, Column]] | None = None,
) -> DataFrame:
    """Add daily_return_pct, ma_7, ma_30 and daily_range to cleaned bars.

    Frames count rows, not days. Several bars of one day count one by one, in
    the order given, unless ``dedup_first`` keeps the last of them beforehand
    (the last column of ``order_by`` decides). See ``over_ticker`` for
    ``unique_days`` and ``hot_rows``. ``also`` names further columns of the same
    windows; they may look back ``REACH`` rows, and do not begin with an underscore.
    """
    more = (lambda window: {}) if also is None else also
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    if dedup_first:
        bars = dedup_keep_last(bars, ["ticker", "date"], order[-1])
        unique_days = True
    rows = over_ticker(
        bars.withColumn("_cents", to_units(F.col("close"), PRICE_DIGITS)),
        order,
        [lambda window: {**_running(window), **more(window)}, _before_frame(FRAMES)],
        reach=REACH,
        unique_days=unique_days,
        hot_rows=hot_rows,
    )
    return rows.select(
        *bars.columns,
        *[c for c in rows.columns if c not in bars.columns and not c.startswith("_")],
        _return_pct().alias("daily_return_pct"),
        *[_moving_average(n).alias(f"ma_{n}") for n in FRAMES],
        daily_range(F.col("high"), F.col("low")).alias("daily_range"),
    )


def golden_cross_events(
    enriched: DataFrame,
    order_by: str | Sequence[str] = "date",
    *,
    unique_days: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Days on which ma_7 rises above ma_30, having been at or below it before.

    The enriched table is unique per ticker and day; say ``unique_days`` where
    ``enriched`` is that table, and no size check is run.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by)

    def previous(window: WindowSpec) -> dict[str, Column]:
        return {
            "_short": F.lag("ma_7").over(window),
            "_long": F.lag("ma_30").over(window),
        }

    columns = ["ticker", "date", "close", "ma_7", "ma_30"]
    rows = over_ticker(
        enriched.select(*columns, *[c for c in order if c not in columns]),
        order,
        [previous],
        reach=1,
        unique_days=unique_days,
        hot_rows=hot_rows,
    )
    crossed = (F.col("ma_7") > F.col("ma_30")) & (F.col("_short") <= F.col("_long"))
    return rows.where(crossed).select(*columns)
