"""Times the headline queries; prints one JSON line.

Each query runs once to warm up and three times measured; the median counts.
Results are written to Spark's noop sink, so every row and column is computed.

The plain names are registered queries, which first derive their bars from the
given tables. The names ending in ``_stored`` are the same operators over bars and
tables written beforehand, as they are used in daily operation.
"""

import datetime as dt
import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from candlework.operators import analytics, quality, summary, upsert
from candlework.plans import fixtures as fx
from candlework.plans.catalog import QUERIES
from candlework.schemas import ENRICHED_KEYS, ENRICHED_UPDATES
from candlework.session import stored

HEADLINE = [
    "enriched",
    "ticker_summary",
    "volume_spikes",
    "upsert_enriched",
    "quality_report",
    "top_gains_per_ticker",
    "monthly_close",
    "recent_performance",
]


def report_of_many(spark, sf_dir):
    """The report over the bars that the other queries read; its own has five tickers."""
    enriched = fx.enriched_of(fx.bars_lineitem(spark, sf_dir))
    own = summary.ticker_summary(enriched)
    return quality.quality_report(enriched, own, ["S1", "S2", "S3"], dt.date(2001, 8, 1))


def over_stored(spark, sf_dir):
    bars = stored(fx.bars_lineitem(spark, sf_dir), "bars")
    enriched = stored(fx.enriched_of(bars), "enriched")
    own = stored(summary.ticker_summary(enriched), "summary")
    as_of = dt.date(2001, 8, 1)
    return {
        "enriched_stored": lambda: fx.enriched_of(bars),
        "ticker_summary_stored": lambda: summary.ticker_summary(enriched),
        "volume_spikes_stored": lambda: analytics.volume_spikes(enriched, own),
        "upsert_enriched_stored": lambda: upsert.merge_upsert(
            *fx.upsert_pair(enriched), ENRICHED_KEYS, ENRICHED_UPDATES
        ),
        "quality_report_stored": lambda: quality.quality_report(
            enriched, own, ["S1", "S2", "S3"], as_of
        ),
        "top_gains_per_ticker_stored": lambda: analytics.top_gains_per_ticker(enriched),
        "monthly_close_stored": lambda: analytics.monthly_close(enriched),
        "recent_performance_stored": lambda: analytics.recent_performance(enriched),
    }


def run(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    timed = {name: (lambda q=QUERIES[name]: q(spark, sf_dir)) for name in HEADLINE}
    timed["quality_report"] = lambda: report_of_many(spark, sf_dir)
    timed.update(over_stored(spark, sf_dir))
    seconds = {}
    for name, query in timed.items():
        times = []
        for i in range(runs + 1):
            start = time.perf_counter()
            run(query())
            if i:
                times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_median_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
