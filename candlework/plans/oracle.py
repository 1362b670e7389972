"""DuckDB SQL for the registered queries, over the same tables.

Result columns, signal names and the texts of the checks are fixed values.
"""

from __future__ import annotations

_ORDERS = """
bars AS (
  SELECT o_orderpriority AS ticker, CAST(o_orderdate AS DATE) AS date,
         arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
         min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
         count(*) AS volume
  FROM orders GROUP BY 1, 2
)"""

_LINEITEM_ORDER = """{'a': l_orderkey, 'b': l_linenumber, 'c': l_partkey,
                      'd': l_extendedprice}"""

_LINEITEM = f"""
bars AS (
  SELECT 'S' || l_suppkey AS ticker, CAST(l_shipdate AS DATE) AS date,
         arg_min(l_extendedprice, {_LINEITEM_ORDER}) AS open,
         max(l_extendedprice) AS high, min(l_extendedprice) AS low,
         arg_max(l_extendedprice, {_LINEITEM_ORDER}) AS close,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS volume
  FROM lineitem GROUP BY 1, 2
)"""

_EVENTS = """
bars AS (
  SELECT event_type AS ticker, CAST(ts AS DATE) AS date,
         arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, event_id) AS close, count(*) AS volume
  FROM events GROUP BY 1, 2
)"""

_DIRTY_OF_BARS = """,
dirty AS (
  SELECT ticker, date, open,
         CASE WHEN dayofyear(date) % 89 = 0 THEN CAST('NaN' AS DOUBLE) ELSE high END AS high,
         low,
         CASE WHEN dayofyear(date) % 97 <> 0 THEN close END + (s.seq - 1) AS close,
         volume, s.seq AS seq
  FROM bars JOIN (VALUES (1), (2)) s(seq) ON s.seq = 1 OR dayofyear(date) % 101 = 0
)"""
_DIRTY = _ORDERS + _DIRTY_OF_BARS

_BAD = (
    _ORDERS
    + """,
bad AS (
  SELECT * REPLACE (CASE WHEN dayofyear(date) = 200 THEN 0.0 ELSE close END AS close)
  FROM bars
)"""
)

_CLEAN = (
    _DIRTY
    + """,
cleaned AS (
  SELECT ticker, date, round(open * 100) / 100 AS open,
         round(CASE WHEN isnan(high) THEN NULL ELSE high END * 100) / 100 AS high,
         round(low * 100) / 100 AS low, round(close * 100) / 100 AS close,
         volume, seq
  FROM dirty WHERE date IS NOT NULL AND close IS NOT NULL AND ticker IS NOT NULL
)"""
)


def _features(source: str, order: str, extra: str = "") -> str:
    """enriched: frames written out over whole cents."""
    return f""",
cents AS (SELECT *, CAST(round(close * 100) AS BIGINT) AS c FROM {source}),
enriched AS (
  SELECT ticker, date, open, high, low, close, volume{extra},
         round(CAST(c - lag(c) OVER w AS DOUBLE) * 1000000 / nullif(lag(c) OVER w, 0))
           / 10000 AS daily_return_pct,
         CASE WHEN count(c) OVER w7 = 7
              THEN round(CAST(sum(c) OVER w7 AS DOUBLE) / 7) / 100 END AS ma_7,
         CASE WHEN count(c) OVER w30 = 30
              THEN round(CAST(sum(c) OVER w30 AS DOUBLE) / 30) / 100 END AS ma_30,
         round((high - low) * 100) / 100 AS daily_range
  FROM cents
  WINDOW w AS (PARTITION BY ticker ORDER BY {order}),
         w7 AS (PARTITION BY ticker ORDER BY {order}
                ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
         w30 AS (PARTITION BY ticker ORDER BY {order}
                 ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
)"""


def _mean(column: str, scale: int) -> str:
    units = f"CAST(round({column} * {scale}) AS BIGINT)"
    return f"round(CAST(sum({units}) AS DOUBLE) / count({column})) / {scale}"


def _quotient(part: str, whole: str, scale: int) -> str:
    """Whole numbers divided in whole numbers, half away from zero."""
    part, whole = f"CAST({part} AS HUGEINT)", f"CAST({whole} AS HUGEINT)"
    return (
        f"CAST(CASE WHEN {whole} <> 0 THEN sign({part}) * sign({whole})"
        f" * ((2 * abs({part}) + abs({whole})) // (2 * abs({whole}))) END AS DOUBLE) / {scale}"
    )


def _cents(column: str) -> str:
    return f"CAST(round({column} * 100) AS BIGINT)"


def _summary_of(source: str) -> str:
    return f"""
  SELECT ticker, min(date) AS from_date, max(date) AS to_date,
         count(date) AS total_trading_days, {_mean("close", 100)} AS avg_close,
         max(close) AS all_time_high, min(close) AS all_time_low,
         round(CAST(sum(volume) AS DOUBLE) / count(volume)) AS avg_daily_volume,
         {_mean("daily_return_pct", 10000)} AS avg_daily_return_pct
  FROM {source} GROUP BY ticker"""


_E = _LINEITEM + _features("bars", "date")
_E5 = _ORDERS + _features("bars", "date")
_S = _E + f", summary AS ({_summary_of('enriched')})"
_S5 = _E5 + f", summary AS ({_summary_of('enriched')})"
_BAR_COLUMNS = "ticker, date, open, high, low, close, volume"
_TICKERS = "('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'), ('5-LOW')"

_PERFORMANCE = f"""
  SELECT ticker, min(date) AS period_start, max(date) AS period_end,
         {_mean("daily_return_pct", 10000)} AS avg_daily_return,
         CAST(sum(CAST(round(daily_return_pct * 10000) AS BIGINT)) AS DOUBLE) / 10000
           AS cumulative_return_pct,
         round(sqrt(CAST(count(u) * sum(u * u) - sum(u) * sum(u) AS DOUBLE)
                    / nullif(count(u) * (count(u) - 1), 0))) / 10000 AS volatility_stddev
  FROM (SELECT *, CAST(round(daily_return_pct * 10000) AS HUGEINT) AS u FROM recent)
  GROUP BY ticker ORDER BY cumulative_return_pct DESC, ticker"""


def _per_ticker(direction: str, source: str = _E, n: int = 10) -> str:
    return f"""
WITH {source}
SELECT ticker, date, close, daily_return_pct,
       CAST(row_number() OVER (PARTITION BY ticker
                               ORDER BY daily_return_pct {direction}, date) AS INTEGER) AS rank
FROM enriched WHERE daily_return_pct IS NOT NULL
QUALIFY rank <= {n}"""


def _extreme(direction: str) -> str:
    return f"""
WITH {_E}
SELECT ticker, date, close, daily_return_pct FROM enriched
WHERE daily_return_pct IS NOT NULL
ORDER BY daily_return_pct {direction}, ticker, date LIMIT 10"""


_UPSERT = f"""
WITH {_E},
existing AS (SELECT * FROM enriched WHERE date < DATE '2000-06-01'),
incoming AS (
  SELECT * REPLACE (open + 1 AS open, close + 1 AS close, CAST(NULL AS DOUBLE) AS ma_30)
  FROM enriched WHERE date >= DATE '2000-05-01'
)
SELECT i.ticker, i.date, CASE WHEN t.ticker IS NULL THEN i.open ELSE t.open END AS open,
       CASE WHEN t.ticker IS NULL THEN i.high ELSE t.high END AS high,
       CASE WHEN t.ticker IS NULL THEN i.low ELSE t.low END AS low, i.close AS close,
       CASE WHEN t.ticker IS NULL THEN i.volume ELSE t.volume END AS volume,
       i.daily_return_pct, i.ma_7, i.ma_30, i.daily_range
FROM incoming i LEFT JOIN existing t ON t.ticker = i.ticker AND t.date = i.date
UNION ALL
SELECT t.* FROM existing t
WHERE NOT EXISTS (SELECT 1 FROM incoming i WHERE i.ticker = t.ticker AND i.date = t.date)"""

_PCT_7 = "round(count(ma_7) * 1000.0::DOUBLE / nullif(count(*), 0)) / 10"
_PCT_30 = "round(count(ma_30) * 1000.0::DOUBLE / nullif(count(*), 0)) / 10"
_MA_CHECK = f"""
SELECT 'Moving Averages Populated' AS "check",
       coalesce({_PCT_7} > 90 AND {_PCT_30} > 90, false) AS passed,
       'ma_7=' || {_PCT_7} || '% populated, ma_30=' || {_PCT_30} || '% populated' AS detail
FROM enriched"""


def _null_check(source: str) -> str:
    return f"""
SELECT 'Null Critical Columns' AS "check", count(*) = 0 AS passed,
       count(*) || ' rows with nulls in ticker/date/close' AS detail
FROM {source} WHERE ticker IS NULL OR date IS NULL OR close IS NULL"""


def _duplicate_check(source: str) -> str:
    return f"""
SELECT 'Dulicate Rows' AS "check", count(*) = 0 AS passed,
       count(*) || ' duplicate (ticker, date) pairs found' AS detail
FROM (SELECT ticker, date FROM {source} GROUP BY ALL HAVING count(*) > 1)"""


def _price_check(source: str) -> str:
    return f"""
SELECT 'Price Sanity' AS "check", count(*) = 0 AS passed,
       count(*) || ' rows with close price <= 0' AS detail
FROM {source} WHERE close <= 0"""


def _ticker_check(source: str, tickers: str, n: int) -> str:
    return f"""
SELECT 'All Tickers Present' AS "check", count(*) = 0 AS passed,
       CASE WHEN count(*) = 0 THEN 'All {n} tickers present'
            ELSE 'Missing tickers: {{''' || string_agg(x.ticker, ''', ''' ORDER BY x.ticker)
                 || '''}}' END AS detail
FROM (VALUES {tickers}) x(ticker)
WHERE NOT EXISTS (SELECT 1 FROM {source} b WHERE b.ticker = x.ticker)"""


def _date_check(source: str, junction: str) -> str:
    return f"""
SELECT 'Date Range' AS "check",
       min(date) <= DATE '1995-01-01' {junction} max(date) >= DATE '2001-07-25' AS passed,
       'Date from ' || min(date) || ' to ' || max(date) AS detail
FROM {source}"""


_COUNT_CHECK = """
SELECT 'Row Count' AS "check", e.n > 0 AND s.n = 5 AS passed,
       'enriched_stocks=' || e.n || ', ticker_summary=' || s.n AS detail
FROM (SELECT count(*) AS n FROM enriched) e, (SELECT count(*) AS n FROM summary) s"""


def _report(*checks: str) -> str:
    parts = [
        f'SELECT CAST({i} AS INTEGER) AS ord, "check", passed, detail FROM ({check})'
        for i, check in enumerate(checks, 1)
    ]
    return " UNION ALL ".join(parts)


_REPORT = _report(
    _COUNT_CHECK,
    _null_check("enriched"),
    _duplicate_check("enriched"),
    _price_check("enriched"),
    _ticker_check("enriched", _TICKERS, 5),
    _date_check("enriched", "OR"),
    _MA_CHECK,
)

_RATIO = _quotient("e.volume * 10000", _cents("t.avg_daily_volume"), 100)
_VOLUME_JOIN = "FROM bars e JOIN summary t ON e.ticker = t.ticker"
_SIGNAL = """
SELECT ticker, date, close, ma_7, ma_30,
       CASE WHEN ma_7 > ma_30 THEN 'BULLISH' WHEN ma_7 < ma_30 THEN 'BEARISH'
            ELSE 'NEUTRAL' END AS signal
FROM enriched WHERE ma_7 IS NOT NULL AND ma_30 IS NOT NULL"""

_CONFORM = """
SELECT ticker, date, CAST(open AS DECIMAL(12,2)) AS open, CAST(high AS DECIMAL(12,2)) AS high,
       CAST(low AS DECIMAL(12,2)) AS low, CAST(close AS DECIMAL(12,2)) AS close, volume,
       CAST(daily_return_pct AS DECIMAL(10,4)) AS daily_return_pct,
       CAST(ma_7 AS DECIMAL(12,2)) AS ma_7, CAST(ma_30 AS DECIMAL(12,2)) AS ma_30,
       CAST(daily_range AS DECIMAL(12,2)) AS daily_range
FROM enriched"""

_CONFORM_SUMMARY = """
SELECT ticker, from_date, to_date, CAST(total_trading_days AS INTEGER) AS total_trading_days,
       CAST(avg_close AS DECIMAL(12,2)) AS avg_close,
       CAST(all_time_high AS DECIMAL(12,2)) AS all_time_high,
       CAST(all_time_low AS DECIMAL(12,2)) AS all_time_low,
       CAST(avg_daily_volume AS DECIMAL(20,2)) AS avg_daily_volume,
       CAST(avg_daily_return_pct AS DECIMAL(10,4)) AS avg_daily_return_pct
FROM summary"""

# Doubled days count one by one in the features; the table keeps the last, with the first open.
_DAILY = f"""{_ORDERS},
landed AS (
  SELECT *, 0 AS seq FROM bars
  UNION ALL
  SELECT * REPLACE (close + 1 AS close), 1 FROM bars
  WHERE ticker IN ('1-URGENT', '3-MEDIUM') AND date >= DATE '1998-05-01' AND date < DATE '1998-06-01'
){_features("landed", "date, seq", ", seq").replace("enriched AS", "every_bar AS")},
summary AS ({_summary_of("every_bar")}),
enriched AS (
  SELECT * EXCLUDE (seq) FROM every_bar
  QUALIFY row_number() OVER (PARTITION BY ticker, date ORDER BY seq DESC) = 1
)"""

_WINDOW = "date >= DATE '1997-01-01' AND date < DATE '2000-01-01'"

ORACLE: dict[str, str] = {
    # Sources
    "csv_scan": f"""WITH {_ORDERS}
SELECT ticker, date, CASE WHEN ticker <> '5-LOW' THEN open END AS open, high, low, close, volume
FROM bars""",
    "parquet_scan": f"WITH {_E} SELECT * FROM enriched",
    "summary_csv_scan": f"""WITH {_S}
SELECT * REPLACE (CAST(total_trading_days AS INTEGER) AS total_trading_days) FROM summary""",
    "table_scan": f"""WITH {_E}
SELECT ticker, date, close, CAST(ma_7 AS DECIMAL(12,2)) AS ma_7 FROM enriched
WHERE ma_7 IS NOT NULL""",
    "require_non_empty": f"WITH {_ORDERS} SELECT * FROM bars",
    "date_window_scan": f"WITH {_LINEITEM} SELECT * FROM bars WHERE {_WINDOW}",
    # Sinks
    "lake_manifest": """
SELECT DISTINCT 'raw' AS prefix, o_orderpriority || '_2001-08-01.csv' AS object, true AS has_size
FROM orders
UNION ALL
SELECT 'processed', x.object, true
FROM (VALUES ('enriched_stocks.parquet'), ('ticker_summary.csv')) x(object)""",
    "land_raw_csv": f"WITH {_LINEITEM} SELECT * FROM bars",
    "write_enriched": f"WITH {_E5} SELECT * FROM enriched",
    "write_summary": f"""WITH {_S5}
SELECT * REPLACE (CAST(total_trading_days AS INTEGER) AS total_trading_days) FROM summary""",
    "upsert_enriched": _UPSERT,
    "upsert_enriched_table": _CONFORM.replace("FROM enriched", f"FROM ({_UPSERT})"),
    "upsert_summary": f"""WITH {_E},
existing AS (SELECT * FROM enriched WHERE date < DATE '2000-06-01'),
later AS (SELECT * FROM enriched WHERE date >= DATE '1996-01-01'),
t AS ({_summary_of("existing")}), i AS ({_summary_of("later")})
SELECT i.* REPLACE (CASE WHEN t.ticker IS NULL THEN i.from_date ELSE t.from_date END AS from_date)
FROM i LEFT JOIN t ON t.ticker = i.ticker
UNION ALL
SELECT t.* FROM t WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.ticker = t.ticker)""",
    "publish_lake": f"""WITH {_S5}
SELECT 'raw' AS table_name, count(*) AS n_rows FROM bars
UNION ALL SELECT 'enriched', count(*) FROM enriched
UNION ALL SELECT 'summary', count(*) FROM summary""",
    "conform_schema": f"WITH {_E} {_CONFORM}",
    "conform_summary": f"WITH {_S} {_CONFORM_SUMMARY}",
    "constraint_violations": f"""WITH {_DIRTY},
broken AS (
  SELECT * REPLACE (CASE WHEN dayofyear(date) % 103 = 0 THEN repeat(ticker, 10)
                         WHEN dayofyear(date) % 107 <> 0 THEN ticker END AS ticker)
  FROM dirty
),
tickers AS (
  SELECT CASE WHEN ticker LIKE '2%' THEN NULL WHEN ticker LIKE '1%' THEN ticker
              ELSE repeat(ticker, 10) END AS ticker
  FROM (SELECT DISTINCT ticker FROM dirty) JOIN (VALUES (1), (2)) c(copy)
    ON c.copy = 1 OR ticker LIKE '1%'
)
SELECT 'enriched_stocks.ticker not null' AS constraint_name,
       count(*) FILTER (ticker IS NULL) AS n_violations FROM broken
UNION ALL SELECT 'enriched_stocks.date not null', count(*) FILTER (date IS NULL) FROM broken
UNION ALL SELECT 'enriched_stocks.close not null', count(*) FILTER (close IS NULL) FROM broken
UNION ALL SELECT 'enriched_stocks.ticker length', count(*) FILTER (length(ticker) > 20) FROM broken
UNION ALL SELECT 'enriched_stocks.(ticker,date) unique', count(*)
  FROM (SELECT ticker, date FROM broken WHERE ticker IS NOT NULL AND date IS NOT NULL
        GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'ticker_summary.ticker not null', count(*) FILTER (ticker IS NULL) FROM tickers
UNION ALL SELECT 'ticker_summary.ticker length', count(*) FILTER (length(ticker) > 20) FROM tickers
UNION ALL SELECT 'ticker_summary.(ticker) unique', count(*)
  FROM (SELECT ticker FROM tickers WHERE ticker IS NOT NULL GROUP BY 1 HAVING count(*) > 1)""",
    # Pipeline
    "pipeline_report": f"WITH {_S5} {_REPORT}",
    "pipeline_tables": f"WITH {_E5} {_CONFORM}",
    "pipeline_summary": f"WITH {_S5} {_CONFORM_SUMMARY}",
    # Daily runs
    "daily_enriched": f"WITH {_DAILY} {_CONFORM}",
    "daily_summary": f"WITH {_DAILY} {_CONFORM_SUMMARY}",
    "daily_report": f"WITH {_DAILY} {_REPORT}",
    "summary_from_states": f"WITH {_S} SELECT * FROM summary",
    "rows_cleaned": f"""WITH {_DIRTY}
SELECT count(*) AS rows_before,
       count(*) FILTER (date IS NOT NULL AND close IS NOT NULL AND ticker IS NOT NULL) AS rows_after
FROM dirty""",
    # Columns
    "snake_case_columns": f"""WITH {_ORDERS}
SELECT ticker AS day_ticker, date AS day_date, open AS day_open, high AS day_high,
       low AS day_low, close AS day_close, volume AS day_volume FROM bars""",
    "tag_ticker": """
SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS volume, 'MARKET' AS ticker
FROM orders GROUP BY 1""",
    "landing_key": """
SELECT DISTINCT 'S' || l_suppkey || '.NS' AS ticker,
       'S' || l_suppkey || '_NS_2001-08-01.csv' AS landing_key FROM lineitem""",
    "parse_date": f"""WITH {_LINEITEM},
texts AS (SELECT ticker, close, CASE WHEN dayofyear(date) % 50 = 0 THEN 'no date'
                                     ELSE strftime(date, '%Y-%m-%d') END AS text FROM bars)
SELECT ticker, close, text, TRY_CAST(text AS DATE) AS date FROM texts""",
    "round_prices": f"""WITH {_LINEITEM}
SELECT ticker, date, round(open / 8 * 100) / 100 AS open, round(high / 8 * 100) / 100 AS high,
       round(low / 8 * 100) / 100 AS low, round(close / 8 * 100) / 100 AS close, volume
FROM bars""",
    "cast_volume": f"""WITH {_LINEITEM}
SELECT ticker, date, CAST(trunc(volume + CAST(0.75 AS DOUBLE)) AS BIGINT) AS volume FROM bars""",
    "daily_range": f"""WITH {_LINEITEM}
SELECT ticker, date, round((high - low) * 100) / 100 AS daily_range FROM bars""",
    "nan_to_null": f"""WITH {_DIRTY}
SELECT * REPLACE (CASE WHEN NOT isnan(high) THEN high END AS high) FROM dirty""",
    "price_range_pct": f"""WITH {_LINEITEM}
SELECT ticker, date,
       {_quotient(f"({_cents('high')} - {_cents('low')}) * 10000", _cents("low"), 100)}
         AS price_range_pct
FROM bars""",
    "ma_signal": f"WITH {_E} {_SIGNAL}",
    "volatility_pct": f"""WITH {_BAD}
SELECT ticker, date,
       {_quotient(f"({_cents('high')} - {_cents('low')}) * 10000", _cents("close"), 100)}
         AS volatility_pct
FROM bad""",
    "volume_ratio": f"""WITH {_S}
SELECT e.ticker, e.date, {_RATIO} AS volume_ratio
{_VOLUME_JOIN}""",
    "month_bucket": f"""WITH {_LINEITEM}
SELECT ticker, date, CAST(date_trunc('month', date) AS DATE) AS month FROM bars""",
    "sample_columns": f"""WITH {_E}
SELECT ticker, date, close, daily_return_pct, ma_7, ma_30 FROM enriched
ORDER BY ticker, date LIMIT 10""",
    # Filters and cleaning
    "drop_null_critical": f"""WITH {_DIRTY}
SELECT * REPLACE (CASE WHEN NOT isnan(high) THEN high END AS high) FROM dirty
WHERE date IS NOT NULL AND close IS NOT NULL AND ticker IS NOT NULL""",
    "clean_bars": f"WITH {_CLEAN} SELECT * FROM cleaned",
    "recency_filter": f"""WITH {_LINEITEM}
SELECT * FROM bars WHERE date >= (SELECT max(date) - INTERVAL 30 DAY FROM bars)""",
    "union_by_name": f"""WITH {_ORDERS},
{_EVENTS.replace("bars AS", "event_bars AS")}
SELECT * FROM bars UNION ALL BY NAME
SELECT * REPLACE (CAST(NULL AS DOUBLE) AS open) FROM event_bars""",
    "sort_bars": f"WITH {_LINEITEM} SELECT * FROM bars ORDER BY ticker, date",
    "dedup_keep_last": f"""WITH {_DIRTY}
SELECT * REPLACE (CASE WHEN NOT isnan(high) THEN high END AS high) FROM dirty
QUALIFY row_number() OVER (PARTITION BY ticker, date ORDER BY seq DESC) = 1""",
    # Windows
    "daily_return": f"WITH {_E} SELECT ticker, date, daily_return_pct FROM enriched",
    "moving_avg_7": f"WITH {_E} SELECT ticker, date, ma_7 FROM enriched",
    "moving_avg_30": f"WITH {_E} SELECT ticker, date, ma_30 FROM enriched",
    "enriched": f"WITH {_E} SELECT * FROM enriched",
    "enriched_dirty": f"""WITH {_CLEAN} {_features("cleaned", "date, seq", ", seq")}
SELECT * FROM enriched""",
    "enriched_dedup_first": f"""WITH {_CLEAN},
last_bars AS (SELECT * FROM cleaned
              QUALIFY row_number() OVER (PARTITION BY ticker, date ORDER BY seq DESC) = 1)
{_features("last_bars", "date", ", seq")}
SELECT * FROM enriched""",
    "enriched_hot_tickers": f"""WITH {_CLEAN} {_features("cleaned", "date, seq", ", seq")}
SELECT * FROM enriched""",
    "top_gains_per_ticker": _per_ticker("DESC"),
    "top_losses_per_ticker": _per_ticker("ASC"),
    "top_gains_deep": _per_ticker("DESC", _E5, 1500),
    "golden_cross_events": f"""WITH {_E},
previous AS (SELECT *, lag(ma_7) OVER w AS short, lag(ma_30) OVER w AS long FROM enriched
             WINDOW w AS (PARTITION BY ticker ORDER BY date))
SELECT ticker, date, close, ma_7, ma_30 FROM previous WHERE ma_7 > ma_30 AND short <= long""",
    "last_30_trading_days": f"""WITH {_E},
recent AS (SELECT * FROM enriched WHERE daily_return_pct IS NOT NULL
           QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) <= 30)
{_PERFORMANCE}""",
    # Aggregates and analyst queries
    "ticker_summary": f"WITH {_S} SELECT * FROM summary",
    "summary_overview": f"""WITH {_S}
SELECT ticker, from_date, to_date, total_trading_days, avg_close, all_time_high, all_time_low,
       {_quotient(f"({_cents('all_time_high')} - {_cents('all_time_low')}) * 10000",
                  _cents("all_time_low"), 100)} AS price_range_pct,
       avg_daily_return_pct
FROM summary ORDER BY avg_daily_return_pct DESC NULLS FIRST, ticker""",
    "top_gains": _extreme("DESC"),
    "top_losses": _extreme("ASC"),
    "monthly_close": f"""WITH {_E}
SELECT ticker, CAST(date_trunc('month', date) AS DATE) AS month,
       {_mean("close", 100)} AS avg_monthly_close,
       round(max(close) * 100) / 100 AS monthly_high,
       round(min(close) * 100) / 100 AS monthly_low,
       CAST(sum(volume) AS BIGINT) AS total_monthly_volume
FROM enriched GROUP BY 1, 2 ORDER BY 1, 2""",
    "ma_regime": f"WITH {_E} {_SIGNAL} ORDER BY ticker, date DESC LIMIT 20",
    "most_volatile": f"""WITH {_E}
SELECT ticker, date, daily_range,
       {_quotient(f"{_cents('daily_range')} * 10000", _cents("close"), 100)} AS volatility_pct
FROM enriched WHERE daily_range IS NOT NULL
ORDER BY volatility_pct DESC, ticker, date LIMIT 10""",
    "recent_performance": f"""WITH {_E},
recent AS (SELECT * FROM enriched
           WHERE date >= (SELECT max(date) - INTERVAL 30 DAY FROM enriched)
             AND daily_return_pct IS NOT NULL)
{_PERFORMANCE}""",
    "recent_performance_table": f"""WITH {_E},
recent AS (SELECT * FROM enriched
           WHERE date >= (SELECT max(date) - INTERVAL 30 DAY FROM enriched)
             AND daily_return_pct IS NOT NULL)
{_PERFORMANCE}""",
    "date_window_table": f"WITH {_E} {_CONFORM} WHERE {_WINDOW}",
    "join_summary": f"""WITH {_S}
SELECT e.ticker, e.date, e.volume, t.avg_daily_volume {_VOLUME_JOIN}
WHERE e.volume > t.avg_daily_volume * 2""",
    "volume_spikes": f"""WITH {_S}
SELECT e.ticker, e.date, e.volume, round(t.avg_daily_volume) AS avg_volume,
       {_RATIO} AS volume_ratio
{_VOLUME_JOIN}
WHERE e.volume > t.avg_daily_volume * 2
ORDER BY volume_ratio DESC, e.ticker, e.date LIMIT 15""",
    "table_row_counts": f"""WITH {_S}
SELECT 'enriched_stocks' AS table_name, count(*) AS n_rows FROM enriched
UNION ALL SELECT 'ticker_summary', count(*) FROM summary""",
    "ma_population": f"""WITH {_E}
SELECT count(*) AS total, count(ma_7) AS ma7_populated, count(ma_30) AS ma30_populated
FROM enriched""",
    "date_extent": f"WITH {_LINEITEM} SELECT min(date) AS min_date, max(date) AS max_date FROM bars",
    "duplicate_keys": f"""WITH {_DIRTY}
SELECT count(*) AS n_duplicates
FROM (SELECT ticker, date FROM dirty GROUP BY ALL HAVING count(*) > 1)""",
    "distinct_tickers": "SELECT DISTINCT 'S' || l_suppkey AS ticker FROM lineitem",
    "null_critical_count": f"""WITH {_DIRTY}
SELECT count(*) AS n_null FROM dirty
WHERE ticker IS NULL OR date IS NULL OR close IS NULL""",
    "bad_price_count": f"WITH {_BAD} SELECT count(*) AS n_bad FROM bad WHERE close <= 0",
    # Quality
    "missing_tickers": f"""
SELECT x.ticker FROM (VALUES {_TICKERS}, ('6-ABSENT')) x(ticker)
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderpriority = x.ticker)""",
    "check_row_counts": f"WITH {_S5} {_COUNT_CHECK}",
    "check_null_critical": f"WITH {_DIRTY} {_null_check('dirty')}",
    "check_duplicates": f"WITH {_DIRTY} {_duplicate_check('dirty')}",
    "check_price_sanity": f"WITH {_BAD} {_price_check('bad')}",
    "check_tickers_present": f"""WITH {_ORDERS}
{_ticker_check("bars", _TICKERS + ", ('6-ABSENT')", 6)}""",
    "check_date_range": f"WITH {_LINEITEM} {_date_check('bars', 'AND')}",
    "check_ma_populated": f"WITH {_E5} {_MA_CHECK}",
    "check_ma_populated_short": f"WITH {_EVENTS} {_features('bars', 'date')} {_MA_CHECK}",
    "quality_report": f"WITH {_S5} {_REPORT}",
    "quality_union": f"""WITH {_BAD} {_DIRTY_OF_BARS}
{_report(
    _null_check("dirty"),
    _duplicate_check("dirty"),
    _price_check("bad"),
    _ticker_check("bad", _TICKERS + ", ('6-ABSENT')", 6),
)}""",
    "check_tally": f"""WITH {_S5}
SELECT count(*) FILTER (passed) AS n_passed, count(*) AS n_checks FROM ({_REPORT})""",
}

# The same questions over tables that are stored by ticker.
ORACLE["volume_spikes_published"] = ORACLE["volume_spikes"]
ORACLE["last_30_published"] = ORACLE["last_30_trading_days"]
