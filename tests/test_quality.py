"""Each check passing, failing, and over an empty table."""

import datetime as dt

import pytest

from candlework.operators import quality as Q

SCHEMA = "ticker string, date date, close double, ma_7 double, ma_30 double"
AS_OF = dt.date(2024, 3, 1)
DAY = dt.date(2024, 2, 28)


def table(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def good(spark):
    return table(
        spark, *[(t, DAY - dt.timedelta(days=i), 1.0, 1.0, 1.0) for t in "AB" for i in range(5)]
    )


def summary(spark, n):
    return spark.range(n).selectExpr("'t' || id AS ticker")


def result(df):
    (row,) = df.collect()
    return row["passed"], row["detail"]


def test_row_counts(spark):
    check = Q.check_row_counts
    assert result(check(good(spark), summary(spark, 5))) == (
        True,
        "enriched_stocks=10, ticker_summary=5",
    )
    assert not result(check(good(spark), summary(spark, 4)))[0]
    assert not result(check(table(spark), summary(spark, 5)))[0]
    assert result(check(good(spark), summary(spark, 2), 2))[0]


def test_null_critical(spark):
    bad = table(spark, (None, DAY, 1.0, None, None), ("A", None, 1.0, None, None), ("A", DAY, None, None, None))
    assert result(Q.check_null_critical(good(spark)))[0]
    assert result(Q.check_null_critical(bad)) == (False, "3 rows with nulls in ticker/date/close")
    assert result(Q.check_null_critical(table(spark)))[0]


def test_duplicates(spark):
    row = ("A", DAY, 1.0, None, None)
    assert result(Q.check_duplicates(good(spark)))[0]
    assert result(Q.check_duplicates(table(spark, row, row, row))) == (
        False,
        "1 duplicate (ticker, date) pairs found",
    )
    assert result(Q.check_duplicates(table(spark)))[0]


def test_price_sanity(spark):
    assert result(Q.check_price_sanity(good(spark)))[0]
    bad = table(spark, ("A", DAY, 0.0, None, None), ("A", DAY, -1.0, None, None))
    assert result(Q.check_price_sanity(bad)) == (False, "2 rows with close price <= 0")
    assert result(Q.check_price_sanity(table(spark)))[0]


def test_tickers_present(spark):
    assert result(Q.check_tickers_present(good(spark), ["A", "B"])) == (True, "All 2 tickers present")
    assert result(Q.check_tickers_present(good(spark), ["Z", "A", "Y"])) == (
        False,
        "Missing tickers: {'Y', 'Z'}",
    )
    assert not result(Q.check_tickers_present(table(spark), ["A"]))[0]


def test_date_range(spark):
    old = table(spark, ("A", dt.date(2022, 1, 1), 1.0, None, None))
    stale = table(spark, ("A", dt.date(2023, 6, 1), 1.0, None, None))
    assert result(Q.check_date_range(good(spark), AS_OF))[0]
    assert result(Q.check_date_range(old, AS_OF))[0]
    assert not result(Q.check_date_range(old, AS_OF, require_both=True))[0]
    assert not result(Q.check_date_range(stale, AS_OF))[0]
    assert result(Q.check_date_range(table(spark), AS_OF)) == (False, "Date from None to None")


def test_ma_populated(spark):
    half = table(spark, ("A", DAY, 1.0, 1.0, None), ("B", DAY, 1.0, 1.0, 1.0))
    assert result(Q.check_ma_populated(good(spark))) == (
        True,
        "ma_7=100.0% populated, ma_30=100.0% populated",
    )
    assert result(Q.check_ma_populated(half)) == (
        False,
        "ma_7=100.0% populated, ma_30=50.0% populated",
    )
    assert not result(Q.check_ma_populated(table(spark)))[0]


@pytest.mark.parametrize("kind", ["good", "bad", "empty"])
def test_report_equals_the_single_checks(spark, kind):
    enriched = {
        "good": good(spark),
        "bad": table(
            spark,
            ("A", DAY, 1.0, None, None),
            ("A", DAY, -1.0, 1.0, None),
            (None, DAY, 0.0, None, None),
            (None, None, None, 1.0, 1.0),
            ("C", DAY, None, None, 1.0),
        ),
        "empty": table(spark),
    }[kind]
    tickers = ["A", "B"]
    own = summary(spark, 2)
    single = Q.quality_union(
        Q.check_row_counts(enriched, own, 2),
        Q.check_null_critical(enriched),
        Q.check_duplicates(enriched),
        Q.check_price_sanity(enriched),
        Q.check_tickers_present(enriched, tickers),
        Q.check_date_range(enriched, AS_OF),
        Q.check_ma_populated(enriched),
    )
    report = Q.quality_report(enriched, own, tickers, AS_OF)
    assert report.orderBy("ord").collect() == single.orderBy("ord").collect()
    tally = Q.check_tally(report).first()
    assert tally.n_checks == 7 and (tally.n_passed == 7) == (kind == "good")
    if kind == "good":
        assert Q.fail_on_error(report) is report
    else:
        with pytest.raises(ValueError, match="quality checks failed"):
            Q.fail_on_error(report)
