"""Reference SQL (DuckDB dialect) for every registered query.

Each string runs against the driver's pre-registered views (``events``,
``lineitem``, ``part`` ...).  The adapters are restated here as CTEs so the
oracle shares no code with the Spark side.
"""

from __future__ import annotations

QUOTES = """quotes AS (
  SELECT event_id AS row_id,
         CAST(user_id AS VARCHAR) AS id,
         event_type AS symbol,
         upper(event_type) AS name,
         value AS price_usd,
         CAST(floor(value * 1000) AS BIGINT) AS market_cap,
         TRY_CAST(props->>'$.k' AS BIGINT) AS volume_24h,
         value - 50 AS price_change_pct_24h,
         value * 1.02 AS high_24h,
         value * 0.98 AS low_24h,
         ts AS recorded_at,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS last_updated
  FROM events)"""

BRANDS = """brands AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_id,
         CAST(l_suppkey AS VARCHAR) AS id,
         p_brand AS symbol,
         upper(p_brand) AS name,
         l_extendedprice / l_quantity AS price_usd,
         CAST(floor(l_extendedprice) AS BIGINT) AS market_cap,
         CAST(l_quantity AS BIGINT) AS volume_24h,
         l_quantity - 25 AS price_change_pct_24h,
         (l_extendedprice / l_quantity) * 1.02 AS high_24h,
         (l_extendedprice / l_quantity) * 0.98 AS low_24h,
         l_shipdate AS recorded_at, l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

# market_stats: hourly windows over quotes.
HOURLY = """market_stats AS (
  SELECT symbol,
         time_bucket(INTERVAL 1 hour, recorded_at) AS window_start,
         time_bucket(INTERVAL 1 hour, recorded_at) + INTERVAL 1 hour AS window_end,
         round(avg(price_usd), 6) AS avg_price,
         round(stddev_samp(price_usd), 6) AS volatility_score,
         round(avg(volume_24h), 6) AS avg_volume,
         round(stddev_samp(volume_24h), 6) AS volume_stddev,
         coalesce(max(volume_24h) > avg(volume_24h), false) AS volume_spike,
         count(*) AS record_count
  FROM quotes
  GROUP BY symbol, time_bucket(INTERVAL 1 hour, recorded_at))"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ORACLE: dict[str, str] = {}

ORACLE["q1_top_volume"] = with_(QUOTES) + """,
latest AS (
  SELECT DISTINCT ON (symbol) symbol, name, volume_24h, price_usd, market_cap,
         price_change_pct_24h, recorded_at
  FROM quotes ORDER BY symbol, recorded_at DESC, row_id DESC)
SELECT symbol, name, volume_24h, price_usd, market_cap, price_change_pct_24h, recorded_at
FROM latest ORDER BY volume_24h DESC NULLS FIRST, symbol LIMIT 20"""

Q = with_(QUOTES)
QS = with_(QUOTES, HOURLY)
NULLS = """nq AS (
  SELECT * REPLACE (
      CASE WHEN price_usd < 1.0 THEN NULL ELSE name END AS name,
      CASE WHEN volume_24h = 0 THEN NULL ELSE price_usd END AS price_usd)
  FROM quotes)"""
QN = with_(QUOTES, NULLS)
RAW_COLS = """symbol, name, price_usd, market_cap, volume_24h, price_change_pct_24h, recorded_at,
       id, high_24h, low_24h, CAST(NULL AS DOUBLE) AS circulating_supply,
       CAST(NULL AS DOUBLE) AS total_supply, CAST(NULL AS DOUBLE) AS max_supply, last_updated"""
HOUR_TEXT = "strftime(date_trunc('hour', recorded_at), '%Y-%m-%dT%H:%M:%S') || '+00:00'"
DAY_STATS = """SELECT symbol, date_trunc('day', recorded_at) AS day,
       round(stddev_samp(price_usd), 6) AS volatility_score,
       round(avg(volume_24h), 6) AS avg_volume,
       coalesce(max(volume_24h) > avg(volume_24h), false) AS volume_spike,
       min(recorded_at) AS window_start, max(recorded_at) AS window_end,
       count(*) AS record_count
FROM {src} GROUP BY symbol, date_trunc('day', recorded_at)"""
HIST_STATS = """SELECT symbol,
       round(stddev_samp(price_usd), 6) AS volatility_score,
       round(avg(volume_24h), 6) AS avg_volume,
       coalesce(max(volume_24h) > avg(volume_24h), false) AS volume_spike,
       min(recorded_at) AS window_start, max(recorded_at) AS window_end,
       count(*) AS record_count
FROM {src} GROUP BY symbol"""
GATES = """SELECT count(*) AS row_count,
       count(*) FILTER (WHERE symbol IS NULL OR name IS NULL OR price_usd IS NULL
                        OR recorded_at IS NULL) AS null_critical_rows
FROM nq"""
REPORT = """report AS (
  SELECT row_count, null_critical_rows,
         CASE WHEN row_count >= 1 THEN 'success' ELSE 'failed' END AS row_count_status,
         CASE WHEN row_count < 1 THEN 'skipped' WHEN null_critical_rows > 0 THEN 'failed'
              ELSE 'success' END AS nulls_status
  FROM (""" + GATES + "))"
LOG = """logrows AS (
  SELECT 1 AS seq, 'data_quality_row_counts' AS stage, 'started' AS status,
         'Checking coin_prices row count' AS message FROM report
  UNION ALL
  SELECT 2, 'data_quality_row_counts', row_count_status,
         CASE WHEN row_count_status = 'success' THEN 'coin_prices row count passed'
              ELSE 'coin_prices is empty' END FROM report
  UNION ALL
  SELECT 3, 'data_quality_nulls', 'started', 'Checking coin_prices null-critical columns'
  FROM report WHERE row_count_status = 'success'
  UNION ALL
  SELECT 4, 'data_quality_nulls', nulls_status,
         CASE WHEN nulls_status = 'success' THEN 'Null checks passed'
              ELSE 'Found ' || null_critical_rows || ' null-critical rows in coin_prices' END
  FROM report WHERE row_count_status = 'success')"""

ORACLE["scan_raw"] = Q + f"SELECT {RAW_COLS} FROM quotes"
ORACLE["sink_raw"] = ORACLE["scan_raw"]
ORACLE["append_union"] = Q + f"SELECT {RAW_COLS} FROM quotes WHERE recorded_at < TIMESTAMP '2024-01-16' UNION ALL SELECT {RAW_COLS} FROM quotes WHERE recorded_at >= TIMESTAMP '2024-01-16'"
ORACLE["project_fact"] = Q + """SELECT symbol, name, price_usd, market_cap, volume_24h,
       price_change_pct_24h, recorded_at FROM quotes"""
ORACLE["envelope_roundtrip"] = Q + f"""SELECT {HOUR_TEXT} AS ingested_at, id, symbol, name,
       price_usd AS current_price, market_cap, volume_24h AS total_volume, price_change_pct_24h,
       high_24h, low_24h, CAST(NULL AS DOUBLE) AS circulating_supply,
       CAST(NULL AS DOUBLE) AS total_supply, CAST(NULL AS DOUBLE) AS max_supply, last_updated
FROM quotes"""
ORACLE["envelope_size"] = Q + f"""SELECT {HOUR_TEXT} AS ingested_at, CAST(count(*) AS INTEGER) AS n_coins
FROM quotes GROUP BY {HOUR_TEXT}, floor(row_id / 50)"""
ORACLE["snapshot_page"] = Q + """SELECT row_id, symbol, market_cap, price_usd FROM quotes
WHERE symbol IN ('click', 'view', 'purchase')
ORDER BY market_cap DESC NULLS LAST, row_id LIMIT 50 OFFSET 50"""
ORACLE["typed_cast"] = Q + """SELECT row_id, TRY_CAST(CAST(price_usd AS VARCHAR) AS DOUBLE) AS price_usd,
       TRY_CAST(CAST(volume_24h AS VARCHAR) AS BIGINT) AS volume_24h,
       TRY_CAST(symbol AS DOUBLE) AS symbol_as_number FROM quotes"""
ORACLE["parse_ts"] = Q + """SELECT row_id, last_updated,
       try_strptime(last_updated, '%Y-%m-%dT%H:%M:%S.%gZ') AS last_updated_ts,
       CAST(NULL AS TIMESTAMP) AS bad_text_ts FROM quotes"""
DERIVED = """SELECT row_id, CAST(high_24h - low_24h AS DOUBLE) AS price_range_24h,
       coalesce(price_change_pct_24h > 0, false) AS is_price_positive,
       CASE WHEN price_usd > {hi} THEN 'high' WHEN price_usd > {mid} THEN 'medium'
            ELSE 'low' END AS price_category FROM {src}"""
ORACLE["derived_fields"] = Q + DERIVED.format(hi=300.0, mid=100.0, src="quotes")
ORACLE["derived_fields_brand"] = with_(BRANDS) + DERIVED.format(hi=1000.0, mid=100.0, src="brands")
ORACLE["spike_flag"] = Q + """SELECT row_id, volume_24h, coalesce(volume_24h > 50.0, false) AS volume_spike
FROM quotes"""
ORACLE["enriched_contract"] = Q + """, ext AS (
  SELECT symbol, max(price_usd) AS ath, min(price_usd) AS atl FROM quotes GROUP BY symbol)
SELECT id, q.symbol, name, price_usd AS current_price, market_cap, volume_24h AS total_volume,
       price_change_pct_24h AS price_change_percentage_24h,
       CASE WHEN price_usd > 300.0 THEN 'high' WHEN price_usd > 100.0 THEN 'medium' ELSE 'low' END
         AS price_category,
       CASE WHEN volume_24h > 66.0 THEN 'high' WHEN volume_24h > 33.0 THEN 'medium' ELSE 'low' END
         AS volume_category,
       CASE WHEN market_cap > 300000.0 THEN 'large' WHEN market_cap > 100000.0 THEN 'mid'
            ELSE 'small' END AS market_cap_category,
       price_usd >= ath * 0.95 AS is_near_ath, price_usd <= atl * 1.05 AS is_near_atl,
       (high_24h - low_24h) / low_24h AS volatility_24h,
       recorded_at AS processing_timestamp, strftime(recorded_at, '%Y-%m-%d') AS data_date,
       'events' AS data_source, '1.0.0' AS pipeline_version
FROM quotes q LEFT JOIN ext ON q.symbol = ext.symbol"""
ORACLE["batch_stats"] = Q + DAY_STATS.format(src="quotes")
ORACLE["history_stats"] = Q + HIST_STATS.format(src="quotes")
ORACLE["history_stats_brand"] = with_(BRANDS) + HIST_STATS.format(src="brands")
ORACLE["stats_spike_join"] = Q + """SELECT symbol, date_trunc('day', recorded_at) AS day,
       coalesce(max(volume_24h) * count(volume_24h) > sum(volume_24h), false) AS volume_spike
FROM quotes GROUP BY symbol, date_trunc('day', recorded_at)"""
ORACLE["enrich_join"] = Q + ", hs AS (" + HIST_STATS.format(src="quotes") + """)
SELECT row_id, q.symbol, name, price_usd, market_cap, volume_24h, price_change_pct_24h,
       recorded_at, hs.volatility_score, hs.volume_spike
FROM quotes q LEFT JOIN hs ON q.symbol = hs.symbol"""
WINDOW_STATS = """SELECT symbol,
       time_bucket(INTERVAL {w}, recorded_at) AS window_start,
       time_bucket(INTERVAL {w}, recorded_at) + INTERVAL {w} AS window_end,
       round(avg(price_usd), 6) AS avg_price,
       round(stddev_samp(price_usd), 6) AS volatility_score,
       round(avg(volume_24h), 6) AS avg_volume,
       round(stddev_samp(volume_24h), 6) AS volume_stddev,
       coalesce(max(volume_24h) > avg(volume_24h), false) AS volume_spike,
       count(*) AS record_count
FROM quotes {where} GROUP BY symbol, time_bucket(INTERVAL {w}, recorded_at)"""
ORACLE["window_stats"] = Q + WINDOW_STATS.format(w="5 minute", where="")
ORACLE["window_join"] = Q + """, k AS (SELECT *, time_bucket(INTERVAL 1 hour, recorded_at) AS window_start FROM quotes),
b AS (SELECT symbol, window_start, round(avg(volume_24h), 6) AS av, sum(volume_24h) AS s, count(volume_24h) AS n,
             stddev_samp(price_usd) AS sd
      FROM k GROUP BY symbol, window_start)
SELECT row_id, k.symbol, k.window_start, volume_24h, av AS avg_volume_window,
       round(sd, 6) AS volatility_score, coalesce(volume_24h * n > s, false) AS volume_spike,
       coalesce(sd > 1000.0, false) AS volatility_flag
FROM k LEFT JOIN b ON k.symbol = b.symbol AND k.window_start = b.window_start"""
LATEST = """SELECT DISTINCT ON (symbol) symbol, name, price_usd, market_cap, volume_24h,
       price_change_pct_24h, recorded_at
FROM {src} ORDER BY symbol, recorded_at DESC, {tie}"""
BRAND_TIE = "l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC"
ORACLE["q1_top_volume_brand"] = with_(BRANDS) + ", latest AS (" + LATEST.format(src="brands", tie=BRAND_TIE) + """)
SELECT symbol, name, volume_24h, price_usd, market_cap, price_change_pct_24h, recorded_at
FROM latest ORDER BY volume_24h DESC NULLS FIRST, symbol LIMIT 20"""
ORACLE["q2_trend"] = Q + """SELECT date_trunc('day', recorded_at) AS day, round(avg(price_usd), 6) AS avg_price,
       max(price_usd) AS max_price, min(price_usd) AS min_price
FROM quotes WHERE symbol = 'click' GROUP BY date_trunc('day', recorded_at) ORDER BY day"""
ORACLE["q2_trend_sql"] = ORACLE["q2_trend"]
ORACLE["q3_heatmap"] = QS + """SELECT symbol, window_start, window_end, volatility_score
FROM market_stats ORDER BY window_end DESC, symbol"""
ORACLE["q4_spike_rate"] = QS + """SELECT symbol,
       100.0::DOUBLE * CAST(count(*) FILTER (WHERE volume_spike) AS BIGINT) / count(*) AS volume_spike_pct,
       count(*) AS records
FROM market_stats GROUP BY symbol HAVING count(*) > 0 ORDER BY volume_spike_pct DESC"""
ORACLE["q5_latest"] = Q + LATEST.format(src="quotes", tie="row_id DESC")
ORACLE["q5_latest_window"] = ORACLE["q5_latest"]
ORACLE["q5_latest_brand"] = with_(BRANDS) + LATEST.format(src="brands", tie=BRAND_TIE)
ORACLE["latest_n_facts"] = Q + """SELECT row_id, symbol, name, price_usd, market_cap, volume_24h,
       price_change_pct_24h, recorded_at FROM quotes ORDER BY recorded_at DESC, row_id DESC LIMIT 10"""
ORACLE["latest_n_stats"] = QS + """SELECT symbol, volatility_score, volume_spike, window_start, window_end
FROM market_stats ORDER BY window_end DESC, symbol LIMIT 10"""
ORACLE["table_counts"] = with_(QUOTES, HOURLY, NULLS.replace("FROM quotes", "FROM quotes"),
                               REPORT.replace("FROM nq", "FROM quotes"), LOG) + """
SELECT 'coin_prices' AS table_name, count(*) AS row_count FROM quotes
UNION ALL SELECT 'market_stats', count(*) FROM market_stats
UNION ALL SELECT 'pipeline_logs', count(*) FROM logrows"""
ORACLE["bi_measures"] = QS + """SELECT
       CAST(count(*) FILTER (WHERE volume_spike) AS DOUBLE) / count(*) AS spike_rate,
       round(avg(volatility_score), 6) AS avg_volatility, count(*) AS stats_rows
FROM market_stats"""
ORACLE["date_rollup"] = Q + """SELECT
       CASE grouping(y, m, d) WHEN 7 THEN 'total' WHEN 3 THEN 'year' WHEN 1 THEN 'month'
            ELSE 'day' END AS level,
       CASE grouping(y, m, d) WHEN 7 THEN 'all' WHEN 3 THEN printf('%04d', y)
            WHEN 1 THEN printf('%04d-%02d', y, m) ELSE printf('%04d-%02d-%02d', y, m, d) END AS period,
       count(*) AS records, round(avg(price_usd), 6) AS avg_price,
       CAST(sum(volume_24h) AS BIGINT) AS total_volume
FROM (SELECT year(recorded_at) AS y, month(recorded_at) AS m, day(recorded_at) AS d, price_usd,
             volume_24h FROM quotes)
GROUP BY ROLLUP (y, m, d)"""
ORACLE["heatmap_pivot"] = Q + ", daily AS (" + WINDOW_STATS.format(w="1 day", where="") + """)
SELECT window_start,
       max(CASE WHEN symbol = 'click' THEN volatility_score END) AS click,
       max(CASE WHEN symbol = 'error' THEN volatility_score END) AS error,
       max(CASE WHEN symbol = 'purchase' THEN volatility_score END) AS purchase,
       max(CASE WHEN symbol = 'signup' THEN volatility_score END) AS signup,
       max(CASE WHEN symbol = 'view' THEN volatility_score END) AS "view"
FROM daily GROUP BY window_start"""
ORACLE["contract_not_null"] = QN + """SELECT count(*) AS total,
       count(*) FILTER (WHERE NOT (symbol IS NULL OR name IS NULL OR price_usd IS NULL OR recorded_at IS NULL)) AS accepted,
       count(*) FILTER (WHERE symbol IS NULL OR name IS NULL OR price_usd IS NULL OR recorded_at IS NULL) AS rejected,
       count(*) FILTER (WHERE symbol IS NULL) AS null_symbol,
       count(*) FILTER (WHERE name IS NULL) AS null_name,
       count(*) FILTER (WHERE price_usd IS NULL) AS null_price_usd,
       count(*) FILTER (WHERE recorded_at IS NULL) AS null_recorded_at
FROM nq"""
ORACLE["contract_not_null_rejects"] = QN + """SELECT row_id,
       CASE WHEN symbol IS NULL THEN 'null_symbol' WHEN name IS NULL THEN 'null_name'
            WHEN price_usd IS NULL THEN 'null_price_usd' WHEN recorded_at IS NULL THEN 'null_recorded_at'
       END AS reject_reason
FROM nq WHERE symbol IS NULL OR name IS NULL OR price_usd IS NULL OR recorded_at IS NULL"""
ORACLE["contract_domain"] = Q + """SELECT symbol,
       coalesce(symbol IN ('click', 'view', 'purchase', 'signup'), false) AS accepted,
       count(*) AS rows
FROM quotes GROUP BY ALL"""
ORACLE["contract_decimal"] = Q + """SELECT row_id,
       CAST(TRY_CAST(price_usd AS DECIMAL(18,8)) AS DOUBLE) AS price_usd,
       CAST(TRY_CAST(market_cap AS DECIMAL(24,2)) AS DOUBLE) AS market_cap,
       CAST(TRY_CAST(volume_24h AS DECIMAL(24,2)) AS DOUBLE) AS volume_24h,
       CAST(TRY_CAST(price_change_pct_24h AS DECIMAL(8,4)) AS DOUBLE) AS price_change_pct_24h,
       coalesce((price_usd IS NOT NULL AND TRY_CAST(price_usd AS DECIMAL(18,8)) IS NULL)
             OR (market_cap IS NOT NULL AND TRY_CAST(market_cap AS DECIMAL(24,2)) IS NULL)
             OR (volume_24h IS NOT NULL AND TRY_CAST(volume_24h AS DECIMAL(24,2)) IS NULL)
             OR (price_change_pct_24h IS NOT NULL AND TRY_CAST(price_change_pct_24h AS DECIMAL(8,4)) IS NULL),
             false) AS decimal_reject
FROM quotes"""
ORACLE["contract_default"] = QS + """SELECT symbol, window_start, window_end, record_count,
       coalesce(CASE WHEN record_count > 1 THEN volume_spike END, false) AS volume_spike
FROM market_stats"""
ORACLE["contract_unique"] = with_(BRANDS) + """SELECT symbol, recorded_at, count(*) AS copies
FROM brands GROUP BY symbol, recorded_at HAVING count(*) > 1"""
ORACLE["contract_unique_line"] = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, count(*) AS copies
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey HAVING count(*) > 1"""
ORACLE["dq_row_count"] = with_(QUOTES, NULLS, REPORT.replace("FROM nq", "FROM quotes")) + \
    "SELECT row_count, row_count_status FROM report"
ORACLE["dq_nulls"] = with_(QUOTES, NULLS, REPORT) + "SELECT null_critical_rows, nulls_status FROM report"
ORACLE["dq_report"] = with_(QUOTES, NULLS, REPORT) + "SELECT * FROM report"
ORACLE["run_log"] = with_(QUOTES, NULLS, REPORT, LOG) + "SELECT * FROM logrows"
ORACLE["sink_enriched"] = Q + ", ds AS (" + DAY_STATS.format(src="quotes") + """)
SELECT row_id, q.symbol, name, price_usd, market_cap, volume_24h, price_change_pct_24h,
       recorded_at, ds.volatility_score, ds.volume_spike
FROM quotes q LEFT JOIN ds ON q.symbol = ds.symbol AND date_trunc('day', q.recorded_at) = ds.day"""

# --- streaming queries -------------------------------------------------------
# Envelopes carry the quote time as millisecond ISO text, so parsed rows hold
# recorded_at at millisecond precision.
PARSED = """parsed AS (
  SELECT * REPLACE (try_strptime(last_updated, '%Y-%m-%dT%H:%M:%S.%gZ') AS recorded_at)
  FROM quotes)"""
CLOSED = "window_end <= (SELECT max(recorded_at) FROM quotes) - INTERVAL 5 minute"
ORACLE["stream_parse"] = with_(QUOTES, PARSED) + f"SELECT {RAW_COLS} FROM parsed"
ORACLE["stream_batch_stats"] = with_(QUOTES, PARSED) + """SELECT symbol,
       least((day(quote_time) - 1) // 5, 5)::BIGINT AS batch_id,
       round(stddev_samp(price_usd), 6) AS volatility_score,
       round(avg(volume_24h), 6) AS avg_volume,
       coalesce(max(volume_24h) > avg(volume_24h), false) AS volume_spike,
       min(recorded_at) AS window_start, max(recorded_at) AS window_end,
       count(*) AS record_count
FROM (SELECT parsed.*, quotes.recorded_at AS quote_time FROM parsed JOIN quotes USING (row_id))
GROUP BY symbol, least((day(quote_time) - 1) // 5, 5)"""
ORACLE["sink_two_streams"] = ORACLE["stream_parse"]
BROKEN = """CASE volume_24h WHEN 0 THEN 'unparsable' WHEN 1 THEN 'no_coins' WHEN 2 THEN 'empty_coins'
       WHEN 3 THEN 'null_symbol' WHEN 4 THEN 'unreadable_time' END"""
ORACLE["stream_rejects"] = Q + f"""SELECT {BROKEN} AS reason, count(*) AS rows FROM quotes
WHERE {BROKEN} IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'raw', count(*) FROM quotes WHERE volume_24h IS NULL OR volume_24h > 2 OR volume_24h < 0
UNION ALL SELECT 'enriched', count(*) FROM quotes WHERE volume_24h IS NULL OR volume_24h > 4 OR volume_24h < 0"""
ORACLE["envelope_rejects"] = Q + f"""SELECT CASE volume_24h
         WHEN 0 THEN '{{"ingested_at": "' || {HOUR_TEXT}
         WHEN 1 THEN '{{"ingested_at": "' || {HOUR_TEXT} || '"}}'
         ELSE '{{"ingested_at": "' || {HOUR_TEXT} || '", "coins": []}}' END AS body,
       {BROKEN} AS reason
FROM quotes WHERE volume_24h IN (0, 1, 2)"""
ORACLE["stream_tumbling"] = Q + "SELECT * FROM (" + WINDOW_STATS.format(w="5 minute", where="") + \
    ") WHERE " + CLOSED
ORACLE["stream_complete"] = Q + WINDOW_STATS.format(w="1 hour", where="")
ORACLE["stream_late"] = Q + "SELECT * FROM (" + WINDOW_STATS.format(
    w="5 minute", where="WHERE recorded_at >= TIMESTAMP '2024-01-16'") + ") WHERE " + CLOSED
ORACLE["stream_restart"] = Q + "SELECT * FROM quotes"
ORACLE["stream_window_join"] = Q + """, k AS (SELECT *, time_bucket(INTERVAL 1 hour, recorded_at) AS window_start FROM quotes),
b AS (SELECT symbol, window_start, round(avg(volume_24h), 6) AS av, sum(volume_24h) AS s, count(volume_24h) AS n,
             stddev_samp(price_usd) AS sd
      FROM k GROUP BY symbol, window_start)
SELECT k.symbol, row_id, price_usd, volume_24h, recorded_at, k.window_start,
       k.window_start + INTERVAL 1 hour AS window_end,
       av AS avg_volume_window, round(sd, 6) AS volatility_score,
       coalesce(volume_24h * n > s, false) AS volume_spike
FROM k LEFT JOIN b ON k.symbol = b.symbol AND k.window_start = b.window_start
WHERE k.window_start + INTERVAL 1 hour <= (SELECT max(recorded_at) FROM quotes) - INTERVAL 5 minute"""

ORACLE["decimal_rejects"] = QN + """, p AS (
  SELECT * REPLACE (CASE WHEN volume_24h = 99 THEN price_usd * 1e10 ELSE price_usd END AS price_usd) FROM nq)
SELECT coalesce(CASE WHEN symbol IS NULL THEN 'null_symbol' WHEN name IS NULL THEN 'null_name'
            WHEN price_usd IS NULL THEN 'null_price_usd' WHEN recorded_at IS NULL THEN 'null_recorded_at'
            WHEN TRY_CAST(price_usd AS DECIMAL(18,8)) IS NULL THEN 'overflow_price_usd' END, 'accepted') AS reject_reason,
       count(*) AS rows
FROM p GROUP BY ALL"""
ORACLE["contract_raw_record"] = QN + """SELECT row_id,
       CASE WHEN id IS NULL THEN 'null_id' WHEN symbol IS NULL THEN 'null_symbol' WHEN name IS NULL THEN 'null_name'
            WHEN volume_24h = 1 THEN 'bad_market_cap' END AS reject_reason
FROM nq WHERE id IS NULL OR symbol IS NULL OR name IS NULL OR volume_24h = 1"""
ORACLE["backfill_stats"] = ORACLE["history_stats"]
ORACLE["backfill_facts"] = ORACLE["project_fact"]

ORACLE["q1_top_volume_sql"] = ORACLE["q1_top_volume"]
ORACLE["q3_heatmap_sql"] = ORACLE["q3_heatmap"]
ORACLE["q4_spike_rate_sql"] = ORACLE["q4_spike_rate"]
ORACLE["q5_latest_sql"] = ORACLE["q5_latest"]

ORACLE["window_stats_daily"] = Q + WINDOW_STATS.format(w="1 day", where="")
ORACLE["q5_latest_brand_two_phase"] = ORACLE["q5_latest_brand"]


ARRIVAL = "least((day(recorded_at) - 1) // 5, 5)::BIGINT"
ORACLE["sink_commit"] = Q + f""", n AS (SELECT {ARRIVAL} AS batch_id, count(*) AS rows FROM quotes GROUP BY ALL)
SELECT phase, sink, batch_id, rows FROM n, (VALUES ('crashed', 2), ('replayed', 6)) p(phase, seen), (VALUES ('raw'), ('enriched')) s(sink)
WHERE batch_id < seen"""
ORACLE["gate_publish"] = Q + f""", n AS (SELECT {ARRIVAL} AS b, count(*) AS n, count(*) FILTER (row_id % 7 = 0) AS bad FROM quotes GROUP BY ALL),
f AS (SELECT *, b = 3 AND bad > 0 AS held FROM n)
SELECT CASE WHEN held THEN 'quarantined' ELSE 'published' END AS kind, b::VARCHAR AS name, n FROM f
UNION ALL SELECT 'log', name, count(*) FROM f, (VALUES ('stream_batch started', false), ('data_quality_row_counts started', false),
  ('data_quality_row_counts success', false), ('data_quality_nulls started', false)) l(name, x) GROUP BY ALL
UNION ALL SELECT 'log', l || CASE WHEN held THEN ' failed' ELSE ' success' END, count(*)
FROM f, (VALUES ('stream_batch'), ('data_quality_nulls')) t(l) GROUP BY ALL"""
ORACLE["history_stats_incremental"] = Q + HIST_STATS.format(src="quotes")
ORACLE["stream_late_rejects"] = Q + """, w AS (SELECT symbol, recorded_at >= TIMESTAMP '2024-01-16' AS first_run,
  time_bucket(INTERVAL 5 minute, recorded_at) + INTERVAL 5 minute AS e FROM quotes)
SELECT CASE WHEN NOT first_run THEN 'late' WHEN e <= (SELECT max(recorded_at) FROM quotes) - INTERVAL 5 minute THEN 'aggregated'
  ELSE 'open' END AS kind, symbol, count(*) AS rows FROM w GROUP BY ALL"""
ORACLE["interval_join"] = Q + """, w AS (SELECT symbol, row_id AS window_id, recorded_at AS a,
  recorded_at + to_minutes(CAST(7 * (1 + volume_24h * volume_24h) AS INTEGER)) AS b FROM quotes WHERE row_id % 25 = 0)
SELECT window_id, w.symbol, count(*) AS quotes, max(price_usd) AS max_price, sum(volume_24h)::BIGINT AS volume
FROM quotes JOIN w ON quotes.symbol = w.symbol AND recorded_at >= a AND recorded_at < b GROUP BY window_id, w.symbol"""

ORACLE["latest_n_facts_days"] = ORACLE["latest_n_facts"]
ORACLE["q5_latest_days"] = ORACLE["q5_latest"]
ORACLE["append_unique"] = Q + """SELECT 'lake' AS kind, strftime(recorded_at, '%Y-%m-%d') AS name, count(*) AS n FROM quotes GROUP BY ALL
UNION ALL SELECT 'refused', 'exists', count(*) FROM quotes WHERE recorded_at >= TIMESTAMP '2024-01-14' AND recorded_at < TIMESTAMP '2024-01-16'
HAVING count(*) > 0
UNION ALL SELECT 'refused', 'duplicate_in_batch', count(*) FROM quotes WHERE recorded_at >= TIMESTAMP '2024-01-14' AND row_id % 10 = 0
HAVING count(*) > 0"""
ORACLE["facts_clustered"] = Q + """SELECT 'symbol' AS filter, row_id, price_usd FROM quotes WHERE symbol = 'click'
UNION ALL SELECT 'hour', row_id, price_usd FROM quotes WHERE recorded_at >= TIMESTAMP '2024-01-15 12:00:00'
AND recorded_at < TIMESTAMP '2024-01-15 13:00:00'"""

ORACLE["contract_unique_planted"] = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, sum(k)::BIGINT AS copies
FROM (SELECT l.*, 1 + CASE WHEN l_orderkey % 1000 = 0 THEN 1 + CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END ELSE 0 END AS k
      FROM lineitem l JOIN part ON l_partkey = p_partkey) GROUP BY ALL HAVING sum(k) > 1"""
ORACLE["window_join_flag"] = "SELECT symbol, volatility_flag, volume_spike, count(*) AS rows FROM (" + \
    ORACLE["window_join"].replace("1000.0", "60.0") + ") GROUP BY ALL"
ORACLE["run_log_lake"] = QN + """, bad AS (SELECT count(*) AS n FROM nq WHERE symbol IS NULL OR name IS NULL OR price_usd IS NULL
  OR recorded_at IS NULL), e(stage, status, message) AS (VALUES
  ('data_quality_row_counts', 'started', 'Checking coin_prices row count'), ('data_quality_row_counts', 'started', 'Checking coin_prices row count'),
  ('data_quality_row_counts', 'started', 'Checking coin_prices row count'), ('data_quality_row_counts', 'success', 'coin_prices row count passed'),
  ('data_quality_row_counts', 'success', 'coin_prices row count passed'), ('data_quality_row_counts', 'failed', 'coin_prices is empty'),
  ('data_quality_nulls', 'started', 'Checking coin_prices null-critical columns'),
  ('data_quality_nulls', 'started', 'Checking coin_prices null-critical columns'), ('data_quality_nulls', 'success', 'Null checks passed'))
SELECT stage, status, message, count(*) AS n, count(*) AS ids FROM (SELECT * FROM e UNION ALL
  SELECT 'data_quality_nulls', 'failed', 'Found ' || n || ' null-critical rows in coin_prices' FROM bad) GROUP BY ALL"""

ORACLE["stream_offsets"] = Q + """, m AS (SELECT recorded_at >= TIMESTAMP '2024-01-16' AS half, count(DISTINCT floor(row_id / 50)) AS m
  FROM quotes GROUP BY ALL), b AS (SELECT unnest(list_concat(list_transform(range(m // 100), lambda i: 100),
  CASE WHEN m % 100 > 0 THEN [m % 100] ELSE [] END)) AS size FROM m)
SELECT 'batches of' AS kind, size::BIGINT AS size, count(*) AS n FROM b GROUP BY ALL
UNION ALL SELECT kind, 0, (SELECT sum(m)::BIGINT FROM m) FROM (VALUES ('messages'), ('offsets'), ('next offset'), ('values')) v(kind)"""


# --- exact means ---------------------------------------------------------------
# A mean is rounded from whole units of 10^-8 by integer division, as in functions/exact.py.
def exact_mean(column: str) -> str:
    total = f"sum(CAST(round({column} * 1e8) AS HUGEINT))"
    n = f"(100 * CAST(count({column}) AS HUGEINT))"
    return (f"(CASE WHEN count({column}) > 0 THEN sign({total}) * CAST((2 * abs({total}) + {n}) // (2 * {n}) AS DOUBLE)"
            f" / 1e6 END)")


for _name, _sql in ORACLE.items():
    for _column in ("price_usd", "volume_24h", "volatility_score"):
        _sql = _sql.replace(f"round(avg({_column}), 6)", exact_mean(_column))
    ORACLE[_name] = _sql.replace("max(volume_24h) > avg(volume_24h)",
                                 "max(volume_24h) * count(volume_24h) > sum(volume_24h)")
