import datetime as dt

from candlework.operators.quality import check_tally
from candlework.plans import fixtures as fx
from candlework.plans import pipeline
from candlework.session import scratch_path
from candlework.sources.writers import land_raw

RUN = dt.date(2001, 8, 1)


def rows(df):
    return sorted(map(str, df.collect()))


def test_two_runs(spark, sf_dir):
    raw, root = scratch_path(spark, "raw"), scratch_path(spark, "run")
    bars = fx.bars_orders(spark, sf_dir)
    land_raw(bars, raw, RUN)

    def run():
        return pipeline.run(spark, raw, root, fx.TICKERS, RUN, bars.selectExpr("min(date)").first()[0])

    report = run()
    assert tuple(check_tally(report).first()) == (7, 7)
    first = [rows(t) for t in pipeline.tables(spark, root)]
    assert len(first[0]) == bars.count() and len(first[1]) == 5

    # Nothing new: nothing changes.
    run()
    assert [rows(t) for t in pipeline.tables(spark, root)] == first

    # A restated day: the close and what follows from it move, the volume stays.
    last = bars.selectExpr("max(date)").first()[0]
    restated = bars.selectExpr(
        "ticker", "date", "open", "high", "low",
        f"CASE WHEN date = DATE'{last}' THEN close + 1 ELSE close END AS close",
        f"CASE WHEN date = DATE'{last}' THEN volume + 1 ELSE volume END AS volume",
    )
    land_raw(restated, raw, RUN + dt.timedelta(days=1))
    before = {r.ticker: r for r in pipeline.tables(spark, root)[0].where(f"date = DATE'{last}'").collect()}
    run()
    enriched, summary = pipeline.tables(spark, root)
    after = {r.ticker: r for r in enriched.where(f"date = DATE'{last}'").collect()}
    assert after.keys() == before.keys() and after
    for ticker, row in after.items():
        assert row.close == before[ticker].close + 1
        assert row.volume == before[ticker].volume
    assert enriched.count() == bars.count() and summary.count() == 5
