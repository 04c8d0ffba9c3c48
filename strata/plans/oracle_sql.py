"""Independent SQL (DuckDB dialect) for every catalog query.

The forecast mapping is restated directly over ``events`` - no JSON round
trip - so the Spark documents path is checked against plain aggregates.
Rolling averages are computed in integer cents (half-up), because DuckDB's
AVG over decimals returns DOUBLE.
"""

from __future__ import annotations

from strata.operators.quality import MART_CHECKS

EV = """
ev AS (
  SELECT user_id, event_id, ts, value, CAST(json_extract_string(props, '$.k') AS DECIMAL(8,2)) AS k,
         date_trunc('week', ts) AS week
  FROM events
)"""

DOCS = EV + """,
docs AS (
  SELECT DISTINCT user_id, week,
    'user_' || CAST(user_id AS VARCHAR) AS city,
    'source=events/year=' || strftime(week, '%Y') || '/month=' || strftime(week, '%m') || '/day=' || strftime(week, '%d')
      || '/run_id=' || strftime(week, '%Y%m%dT%H%M%SZ') || '/city=user_' || CAST(user_id AS VARCHAR) || '.json' AS raw_file_path
  FROM ev
)"""

STAGING = DOCS + """,
stg_daily AS (
  SELECT d.raw_file_path, d.city, a.day AS forecast_date,
    CAST(a.tmax AS DECIMAL(6,2)) AS temperature_max_c,
    CAST(a.tmin AS DECIMAL(6,2)) AS temperature_min_c,
    CAST(a.kmin AS DECIMAL(8,2)) AS precipitation_mm,
    d.week AS source_ingested_at_utc
  FROM (SELECT user_id, week, CAST(ts AS DATE) AS day, max(value) AS tmax, min(value) AS tmin, min(k) AS kmin
        FROM ev GROUP BY ALL) a
  JOIN docs d USING (user_id, week)
),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, week ORDER BY ts DESC, event_id DESC) AS rn_last,
            row_number() OVER (PARTITION BY user_id, week ORDER BY ts ASC, event_id ASC) AS rn_first
  FROM ev
),
stg_current AS (
  SELECT d.raw_file_path, d.city,
    date_trunc('minute', l.ts) AS current_time_utc,
    CAST(l.value AS DECIMAL(6,2)) AS temperature_c,
    CAST(l.k AS DECIMAL(6,2)) AS relative_humidity_pct,
    CAST(f.value AS DECIMAL(6,2)) AS wind_speed_kmh,
    d.week AS source_ingested_at_utc
  FROM docs d
  JOIN ordered l ON l.user_id = d.user_id AND l.week = d.week AND l.rn_last = 1
  JOIN ordered f ON f.user_id = d.user_id AND f.week = d.week AND f.rn_first = 1
)"""

MARTS = STAGING + """,
latest AS (
  SELECT s.* FROM stg_daily s
  JOIN (SELECT city, max(source_ingested_at_utc) AS m FROM stg_daily GROUP BY city) x
    ON x.city = s.city AND x.m = s.source_ingested_at_utc
),
summary AS (
  SELECT city, forecast_date, temperature_max_c, temperature_min_c,
    CAST(round((temperature_max_c + temperature_min_c) * 0.5, 2) AS DECIMAL(6,2)) AS temperature_avg_c,
    CAST(round(temperature_max_c - temperature_min_c, 2) AS DECIMAL(6,2)) AS diurnal_temp_range_c,
    precipitation_mm,
    precipitation_mm > 0 AS is_wet_day,
    source_ingested_at_utc
  FROM latest
),
rankings AS (
  SELECT forecast_date, city, temperature_max_c, temperature_avg_c, precipitation_mm,
    CAST(rank() OVER (PARTITION BY forecast_date ORDER BY temperature_max_c DESC NULLS FIRST, city ASC) AS BIGINT) AS max_temperature_rank
  FROM summary
),
rolling AS (""" + """
  SELECT city, forecast_date, temperature_avg_c,
    CAST(CAST((2 * sum(CAST(temperature_avg_c * 100 AS BIGINT)) OVER w + count(temperature_avg_c) OVER w)
              // (2 * count(temperature_avg_c) OVER w) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(6,2)) AS rolling_3day_avg_temp_c,
    precipitation_mm,
    CAST(sum(precipitation_mm) OVER w AS DECIMAL(8,2)) AS rolling_3day_precip_mm
  FROM summary
  WINDOW w AS (PARTITION BY city ORDER BY forecast_date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
),
mart_current AS (
  SELECT city, current_time_utc, temperature_c, relative_humidity_pct, wind_speed_kmh, source_ingested_at_utc
  FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY source_ingested_at_utc DESC, raw_file_path DESC) AS rn
        FROM stg_current) WHERE rn = 1
)"""


def _with(ctes: str, body: str) -> str:
    return "WITH " + ctes.strip() + "\n" + body


def _checks_sql(current: str = "mart_current", daily: str = "summary", rankings: str = "rankings") -> str:
    n = [name for name, _ in MART_CHECKS]
    d = [desc.replace("'", "''") for _, desc in MART_CHECKS]
    body = f"""
, counts AS (
  SELECT (SELECT count(DISTINCT user_id) FROM events) AS cities,
         (SELECT count(*) FROM {current}) AS cur_rows,
         (SELECT count(*) FROM {daily}) AS daily_rows,
         (SELECT count(*) FROM {rankings}) AS rank_rows,
         (SELECT count(*) FROM rolling) AS roll_rows
), checks AS (
  SELECT 1 AS check_order, '{n[0]}' AS name, '{d[0]}' AS description,
    (SELECT count(*) FROM {current} WHERE city IS NULL OR current_time_utc IS NULL OR source_ingested_at_utc IS NULL) AS issue_count
  UNION ALL SELECT 2, '{n[1]}', '{d[1]}',
    (SELECT count(*) FROM {daily} WHERE city IS NULL OR forecast_date IS NULL OR temperature_max_c IS NULL
       OR temperature_min_c IS NULL OR precipitation_mm IS NULL OR source_ingested_at_utc IS NULL)
  UNION ALL SELECT 3, '{n[2]}', '{d[2]}',
    (SELECT count(*) FROM (SELECT city, forecast_date FROM {daily} GROUP BY ALL HAVING count(*) > 1))
  UNION ALL SELECT 4, '{n[3]}', '{d[3]}',
    (SELECT count(*) FROM {daily} WHERE temperature_max_c < temperature_min_c
       OR temperature_max_c NOT BETWEEN -80 AND 80 OR temperature_min_c NOT BETWEEN -80 AND 80)
  UNION ALL SELECT 5, '{n[4]}', '{d[4]}', (SELECT count(*) FROM {daily} WHERE precipitation_mm < 0)
  UNION ALL SELECT 6, '{n[5]}', '{d[5]}', (SELECT CASE WHEN cur_rows = cities THEN 0 ELSE 1 END FROM counts)
  UNION ALL SELECT 7, '{n[6]}', '{d[6]}', (SELECT CASE WHEN daily_rows = cities * 7 THEN 0 ELSE 1 END FROM counts)
  UNION ALL SELECT 8, '{n[7]}', '{d[7]}', (SELECT CASE WHEN rank_rows = cities * 7 THEN 0 ELSE 1 END FROM counts)
  UNION ALL SELECT 9, '{n[8]}', '{d[8]}', (SELECT CASE WHEN roll_rows = cities * 7 THEN 0 ELSE 1 END FROM counts)
)"""
    return body


CHECKS = MARTS + _checks_sql()

# The marts with faults by user number, as the spoiled queries make them.
SPOILED = MARTS + """,
numbered AS (SELECT *, CAST(replace(city, 'user_', '') AS BIGINT) AS n FROM summary),
bad_summary AS (
  SELECT city, forecast_date,
    CASE WHEN n % 5 = 0 THEN 95 WHEN n % 13 = 0 THEN temperature_min_c - 1 ELSE temperature_max_c END AS temperature_max_c, temperature_min_c,
    CASE WHEN n % 7 = 0 THEN NULL WHEN n % 11 = 0 THEN precipitation_mm - 1000 ELSE precipitation_mm END AS precipitation_mm, source_ingested_at_utc
  FROM numbered
  UNION ALL SELECT city, forecast_date, temperature_max_c, temperature_min_c, precipitation_mm, source_ingested_at_utc FROM numbered WHERE n % 17 = 0
),
bad_current AS (
  SELECT city, CASE WHEN CAST(replace(city, 'user_', '') AS BIGINT) % 3 <> 0 THEN current_time_utc END AS current_time_utc, source_ingested_at_utc FROM mart_current
),
bad_rankings AS (SELECT * FROM rankings WHERE max_temperature_rank > 1)""" + _checks_sql("bad_current", "bad_summary", "bad_rankings")
CHECK_ROWS = "SELECT check_order, name, description, CAST(issue_count AS BIGINT) AS issue_count, issue_count = 0 AS passed FROM checks"

LINES = """
lines AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS pos,
         count(*) OVER (PARTITION BY l_orderkey) AS n
  FROM lineitem
)"""

# The seven tables as the source system declares them (column, type, nullable, place in the key).
_T, _D6, _D8, _N = "timestamp", "decimal(6,2)", "decimal(8,2)", "NULL"
DECLARED = [
    ("raw/weather_api_responses", [
        ("raw_record_id", "bigint", "false", _N), ("source", "string", "false", _N), ("city", "string", "false", _N), ("ingested_at_utc", _T, "false", _N),
        ("payload", "variant", "false", _N), ("raw_file_path", "string", "false", 1), ("loaded_at_utc", _T, "false", _N),
    ]),
    ("staging/weather_current_conditions", [
        ("raw_record_id", "bigint", "false", _N), ("city", "string", "false", _N), ("current_time_utc", _T, "false", _N), ("temperature_c", _D6, "true", _N),
        ("relative_humidity_pct", _D6, "true", _N), ("wind_speed_kmh", _D6, "true", _N), ("source_ingested_at_utc", _T, "false", _N),
        ("raw_file_path", "string", "false", 1), ("raw_loaded_at_utc", _T, "false", _N), ("loaded_at_utc", _T, "false", _N),
    ]),
    ("staging/weather_daily_forecast", [
        ("raw_record_id", "bigint", "false", _N), ("city", "string", "false", _N), ("forecast_date", "date", "false", 2), ("temperature_max_c", _D6, "true", _N),
        ("temperature_min_c", _D6, "true", _N), ("precipitation_mm", _D8, "true", _N), ("source_ingested_at_utc", _T, "false", _N),
        ("raw_file_path", "string", "false", 1), ("raw_loaded_at_utc", _T, "false", _N), ("loaded_at_utc", _T, "false", _N),
    ]),
    ("mart/city_current_weather", [
        ("city", "string", "false", 1), ("current_time_utc", _T, "false", _N), ("temperature_c", _D6, "true", _N), ("relative_humidity_pct", _D6, "true", _N),
        ("wind_speed_kmh", _D6, "true", _N), ("source_ingested_at_utc", _T, "false", _N), ("refreshed_at_utc", _T, "false", _N),
    ]),
    ("mart/daily_city_weather_summary", [
        ("city", "string", "false", 1), ("forecast_date", "date", "false", 2), ("temperature_max_c", _D6, "true", _N), ("temperature_min_c", _D6, "true", _N),
        ("temperature_avg_c", _D6, "true", _N), ("diurnal_temp_range_c", _D6, "true", _N), ("precipitation_mm", _D8, "true", _N),
        ("is_wet_day", "boolean", "false", _N), ("source_ingested_at_utc", _T, "false", _N), ("refreshed_at_utc", _T, "false", _N),
    ]),
    ("mart/daily_temperature_rankings", [
        ("forecast_date", "date", "false", 1), ("city", "string", "false", 2), ("temperature_max_c", _D6, "true", _N), ("temperature_avg_c", _D6, "true", _N),
        ("precipitation_mm", _D8, "true", _N), ("max_temperature_rank", "bigint", "false", _N), ("refreshed_at_utc", _T, "false", _N),
    ]),
    ("mart/city_rolling_3day_metrics", [
        ("city", "string", "false", 1), ("forecast_date", "date", "false", 2), ("temperature_avg_c", _D6, "true", _N), ("rolling_3day_avg_temp_c", _D6, "true", _N),
        ("precipitation_mm", _D8, "true", _N), ("rolling_3day_precip_mm", _D8, "true", _N), ("refreshed_at_utc", _T, "false", _N),
    ]),
]

ORACLES = {
    "json_extract": """
SELECT event_id, json_extract_string(props, '$.k') AS k_text,
       CAST(json_extract_string(props, '$.k') AS DECIMAL(8,2)) AS k_decimal,
       json_extract_string(props, '$.missing') AS missing_text
FROM events""",
    "partition_columns": """
SELECT event_id, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
  strftime(ts, '%Y%m%dT%H%M%SZ') AS run_id, replace(lower(trim(event_type)), ' ', '_') AS city_slug,
  'source=open_meteo/year=' || strftime(ts, '%Y') || '/month=' || strftime(ts, '%m') || '/day=' || strftime(ts, '%d')
    || '/run_id=' || strftime(ts, '%Y%m%dT%H%M%SZ') || '/city=' || replace(lower(trim(event_type)), ' ', '_') || '.json' AS raw_file_path
FROM events""",
    "raw_envelope": _with(DOCS, "SELECT raw_file_path, 'events' AS source, city, week AS ingested_at_utc FROM docs"),
    "envelope_rejects": """
SELECT d.doc_id, 'missing keys payload' AS reject_reason
FROM documents d ANTI JOIN labels l ON l.doc_id = d.doc_id""",
    "idempotent_append": _with(DOCS, """
, earlier AS (SELECT DISTINCT user_id, week FROM ev WHERE ts < TIMESTAMP '2024-01-15 00:00:00')
SELECT raw_file_path, 'user_' || CAST(user_id AS VARCHAR) AS city, week AS ingested_at_utc
FROM docs ANTI JOIN earlier USING (user_id, week)"""),
    "append_counts": _with(DOCS, """
, earlier AS (SELECT DISTINCT user_id, week FROM ev WHERE ts < TIMESTAMP '2024-01-15 00:00:00')
SELECT CAST((SELECT count(*) FROM docs) - (SELECT count(*) FROM earlier) AS BIGINT) AS inserted,
       CAST(2 * (SELECT count(*) FROM earlier) AS BIGINT) AS skipped,
       CAST((SELECT count(*) FROM docs) + (SELECT count(*) FROM earlier) AS BIGINT) AS total"""),
    "dimension_lookup": """
SELECT c.c_custkey, '  Nation_' || CAST(c.c_nationkey AS VARCHAR) || ' ' AS requested, n.n_nationkey, n.n_regionkey
FROM customer c JOIN nation n
  ON lower(trim('  Nation_' || CAST(c.c_nationkey AS VARCHAR) || ' ')) = lower(trim(n.n_name))""",
    "dimension_rejects": """
SELECT s.s_suppkey, 'Nation_' || CAST(s.s_nationkey * 2 AS VARCHAR) AS requested
FROM supplier s ANTI JOIN nation n
  ON lower(trim('Nation_' || CAST(s.s_nationkey * 2 AS VARCHAR))) = lower(trim(n.n_name))""",
    "parallel_arrays": _with(LINES, """
SELECT l_orderkey, pos, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, CAST(l_shipdate AS DATE) AS l_shipdate
FROM lines"""),
    "ragged_arrays": _with(LINES, """
SELECT l_orderkey, pos, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, CAST(l_shipdate AS DATE) AS l_shipdate
FROM lines
WHERE pos < n"""),
    "staging_current": _with(STAGING, "SELECT * FROM stg_current"),
    "staging_daily": _with(STAGING, "SELECT * FROM stg_daily"),
    "latest_per_key": """
SELECT user_id, event_id, ts, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
) WHERE rn = 1""",
    "mart_current": _with(MARTS, "SELECT * FROM mart_current"),
    "latest_snapshot": _with(MARTS, """
SELECT city, forecast_date, temperature_max_c, temperature_min_c, precipitation_mm, source_ingested_at_utc FROM latest"""),
    "daily_summary": _with(MARTS, "SELECT * FROM summary"),
    "rank_per_day": _with(MARTS, "SELECT * FROM rankings"),
    "rolling_metrics": _with(MARTS, "SELECT * FROM rolling"),
    "rolling_history": _with(STAGING, """
, hist AS (
  SELECT city, forecast_date, CAST(round((temperature_max_c + temperature_min_c) * 0.5, 2) AS DECIMAL(6,2)) AS temperature_avg_c,
         precipitation_mm
  FROM stg_daily
)
SELECT city, forecast_date, temperature_avg_c,
  CAST(CAST((2 * sum(CAST(temperature_avg_c * 100 AS BIGINT)) OVER w + count(temperature_avg_c) OVER w)
            // (2 * count(temperature_avg_c) OVER w) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(6,2)) AS rolling_3day_avg_temp_c,
  precipitation_mm,
  CAST(sum(precipitation_mm) OVER w AS DECIMAL(8,2)) AS rolling_3day_precip_mm
FROM hist
WINDOW w AS (PARTITION BY city ORDER BY forecast_date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""),
    "rank_values": """
SELECT event_id, event_type, value, user_id,
  CAST(rank() OVER (PARTITION BY event_type ORDER BY value DESC NULLS FIRST, user_id NULLS LAST) AS BIGINT) AS value_rank FROM events""",
    "event_positions": """
SELECT event_id, event_type, ts,
  CAST(row_number() OVER (PARTITION BY event_type ORDER BY ts NULLS LAST, event_id NULLS LAST) AS BIGINT) AS position FROM events""",
    "rolling_events": """
SELECT event_id, event_type, ts, value, count(*) OVER w AS n_events, min(value) OVER w AS least, max(value) OVER w AS most,
  first(event_id) OVER w AS first_id
FROM events
WINDOW w AS (PARTITION BY event_type ORDER BY ts NULLS LAST, event_id NULLS LAST ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""",
    "dq_checks": _with(CHECKS, CHECK_ROWS),
    "dq_spoiled": _with(SPOILED, CHECK_ROWS),
    "quality_document": _with(SPOILED, """
SELECT CASE WHEN bool_and(issue_count = 0) OVER () THEN 'pass' ELSE 'fail' END AS status,
       CAST(count(*) FILTER (WHERE issue_count = 0) OVER () AS BIGINT) AS passed,
       CAST(count(*) FILTER (WHERE issue_count <> 0) OVER () AS BIGINT) AS failed,
       CAST(count(*) OVER () AS BIGINT) AS total,
       check_order - 1 AS item, name, CAST(issue_count AS BIGINT) AS issue_count
FROM checks"""),
    "readiness": _with(MARTS, """
SELECT 'marts' AS "of", (SELECT count(*) FROM mart_current) > 0 AND (SELECT count(*) FROM rankings) > 0 AND (SELECT count(*) FROM rolling) > 0 AS ready
UNION ALL SELECT 'without rankings', false"""),
    "envelope_contract": """
SELECT doc_id, reject_reason FROM (
  SELECT doc_id, CASE
    WHEN doc_id % 13 = 0 THEN 'invalid JSON document'
    WHEN (doc_id % 7 = 0 AND doc_id % 23 <> 0) OR doc_id % 5 = 0 OR doc_id % 11 = 0 THEN 'null keys ' || concat_ws(', ',
      CASE WHEN doc_id % 7 = 0 AND doc_id % 23 <> 0 THEN 'source' END, CASE WHEN doc_id % 5 = 0 THEN 'city' END, CASE WHEN doc_id % 11 = 0 THEN 'ingested_at_utc' END)
    WHEN doc_id % 23 = 0 THEN 'no text in keys source'
    WHEN doc_id % 17 = 0 THEN 'unparseable ingested_at_utc' END AS reject_reason
  FROM documents) WHERE reject_reason IS NOT NULL""",
    "load_defaults": _with(DOCS, "SELECT count(*) AS n_rows, count(*) AS n_stamped, true AS one_stamp FROM docs"),
    "request_plan": """
SELECT c.c_custkey, c.requested, v.latitude, v.longitude,
  'temperature_2m,relative_humidity_2m,wind_speed_10m' AS current,
  'temperature_2m_max,temperature_2m_min,precipitation_sum' AS daily, 'UTC' AS timezone, 7 AS forecast_days
FROM (SELECT c_custkey, CASE c_nationkey % 6 WHEN 0 THEN 'Prague' WHEN 1 THEN ' vienna ' WHEN 2 THEN 'BERLIN' WHEN 3 THEN 'Warsaw'
        WHEN 4 THEN 'budapest ' ELSE 'Atlantis' END AS requested FROM customer) c
JOIN (VALUES ('prague', 50.0755::DOUBLE, 14.4378::DOUBLE), ('vienna', 48.2082, 16.3738), ('berlin', 52.52, 13.405), ('warsaw', 52.2297, 21.0122),
        ('budapest', 47.4979, 19.0402)) v(city, latitude, longitude) ON v.city = lower(trim(c.requested))""",
    "staging_repeated_dates": _with(STAGING, "SELECT * FROM stg_daily"),
    "latest_tied": _with(MARTS, """
SELECT city, forecast_date,
  CAST(temperature_max_c + CASE WHEN CAST(replace(city, 'user_', '') AS BIGINT) % 2 = 0 THEN 1 ELSE 0 END AS DECIMAL(6,2)) AS temperature_max_c,
  temperature_min_c, source_ingested_at_utc
FROM latest"""),
    "rank_per_day_nulls": _with(MARTS, """
, holed AS (
  SELECT forecast_date, city, CASE WHEN CAST(replace(city, 'user_', '') AS BIGINT) % 9 <> 0 THEN temperature_max_c END AS temperature_max_c,
    temperature_avg_c, precipitation_mm
  FROM summary
)
SELECT forecast_date, city, temperature_max_c, temperature_avg_c, precipitation_mm,
  CAST(rank() OVER (PARTITION BY forecast_date ORDER BY temperature_max_c DESC NULLS FIRST, city ASC) AS BIGINT) AS max_temperature_rank
FROM holed"""),
    "dq_summary": _with(CHECKS, """
SELECT CAST(count(*) FILTER (WHERE issue_count = 0) AS BIGINT) AS passed,
       CAST(count(*) FILTER (WHERE issue_count <> 0) AS BIGINT) AS failed,
       CAST(count(*) AS BIGINT) AS total,
       CASE WHEN count(*) FILTER (WHERE issue_count <> 0) = 0 THEN 'pass' ELSE 'fail' END AS status
FROM checks"""),
    "dq_driver_tables": """
WITH c AS (
  SELECT 1 AS check_order, 'supplier_nulls' AS name, 'Supplier key, name and nation should not be null.' AS description,
    (SELECT count(*) FROM supplier WHERE s_suppkey IS NULL OR s_name IS NULL OR s_nationkey IS NULL) AS issue_count
  UNION ALL SELECT 2, 'supplier_negative_balance', 'Supplier account balance should not be negative.',
    (SELECT count(*) FROM supplier WHERE s_acctbal < 0)
  UNION ALL SELECT 3, 'supplier_nation_range', 'Supplier nation key should lie in 0..24.',
    (SELECT count(*) FROM supplier WHERE s_nationkey < 0 OR s_nationkey > 24)
  UNION ALL SELECT 4, 'customer_negative_balance', 'Customer account balance should not be negative.',
    (SELECT count(*) FROM customer WHERE c_acctbal < 0)
  UNION ALL SELECT 5, 'customer_balance_range', 'Customer balance should lie in -1000..9000.',
    (SELECT count(*) FROM customer WHERE c_acctbal < -1000 OR c_acctbal > 9000)
  UNION ALL SELECT 6, 'customer_duplicate_names', 'Customer names should be unique.',
    (SELECT count(*) FROM (SELECT c_name FROM customer GROUP BY c_name HAVING count(*) > 1))
  UNION ALL SELECT 7, 'nation_row_count', 'Nation table should hold 25 rows.',
    (SELECT CASE WHEN count(*) = 25 THEN 0 ELSE 1 END FROM nation)
)
SELECT check_order, name, description, CAST(issue_count AS BIGINT) AS issue_count, issue_count = 0 AS passed FROM c""",
    "contract_not_null": """
SELECT doc_id, 'quality' AS "column" FROM documents d ANTI JOIN labels l USING (doc_id)
UNION ALL
SELECT doc_id, 'toxic' AS "column" FROM documents d ANTI JOIN labels l USING (doc_id)""",
    "contract_unique": """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    "contract_fk": _with(STAGING, """
SELECT 'lineitem_orders' AS contract, CAST((SELECT count(*) FROM lineitem ANTI JOIN orders ON l_orderkey = o_orderkey WHERE l_orderkey IS NOT NULL) AS BIGINT) AS violations
UNION ALL SELECT 'lineitem_open_orders', (SELECT count(*) FROM lineitem ANTI JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'F') o ON l_orderkey = o_orderkey)
UNION ALL SELECT 'lineitem_part', (SELECT count(*) FROM lineitem ANTI JOIN part ON l_partkey = p_partkey WHERE l_partkey IS NOT NULL)
UNION ALL SELECT 'lineitem_odd_part', (SELECT count(*) FROM lineitem ANTI JOIN (SELECT * FROM part WHERE p_partkey % 2 = 1) p ON l_partkey = p_partkey)
UNION ALL SELECT 'lineitem_supplier', (SELECT count(*) FROM lineitem ANTI JOIN supplier ON l_suppkey = s_suppkey WHERE l_suppkey IS NOT NULL)
UNION ALL SELECT 'orders_customer', (SELECT count(*) FROM orders ANTI JOIN customer ON o_custkey = c_custkey WHERE o_custkey IS NOT NULL)
UNION ALL SELECT 'orders_solvent_customer', (SELECT count(*) FROM orders ANTI JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) c ON o_custkey = c_custkey)
UNION ALL SELECT 'customer_nation', (SELECT count(*) FROM customer ANTI JOIN nation ON c_nationkey = n_nationkey WHERE c_nationkey IS NOT NULL)
UNION ALL SELECT 'documents_labels', (SELECT count(*) FROM documents d ANTI JOIN labels l ON l.doc_id = d.doc_id WHERE d.doc_id IS NOT NULL)
UNION ALL SELECT 'labels_documents', (SELECT count(*) FROM labels l ANTI JOIN documents d ON l.doc_id = d.doc_id WHERE l.doc_id IS NOT NULL)
UNION ALL SELECT 'staging_current_raw', (SELECT count(*) FROM stg_current s ANTI JOIN docs d ON s.raw_file_path = d.raw_file_path)
UNION ALL SELECT 'staging_daily_raw', (SELECT count(*) FROM stg_daily s ANTI JOIN docs d ON s.raw_file_path = d.raw_file_path)
UNION ALL SELECT 'staging_daily_early_raw', (SELECT count(*) FROM stg_daily s ANTI JOIN (SELECT * FROM docs WHERE week < TIMESTAMP '2024-01-15 00:00:00') d ON s.raw_file_path = d.raw_file_path)"""),
    "contract_cast": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, c AS "column", v AS value FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'l_quantity' AS c, CAST(l_quantity AS VARCHAR) AS v, TRY_CAST(l_quantity AS DECIMAL(6,2)) IS NULL AND l_quantity IS NOT NULL AS bad FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'l_extendedprice', CAST(l_extendedprice AS VARCHAR), TRY_CAST(l_extendedprice AS DECIMAL(7,2)) IS NULL AND l_extendedprice IS NOT NULL FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'l_discount', CAST(l_discount AS VARCHAR), TRY_CAST(l_discount AS DECIMAL(6,2)) IS NULL AND l_discount IS NOT NULL FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'l_tax', CAST(l_tax AS VARCHAR), TRY_CAST(l_tax AS DECIMAL(6,2)) IS NULL AND l_tax IS NOT NULL FROM lineitem
) WHERE bad""",
    "overview": _with(MARTS, """
SELECT CAST((SELECT count(*) FROM mart_current) AS BIGINT) AS current_city_count,
       CAST((SELECT count(*) FROM summary) AS BIGINT) AS summary_row_count,
       CAST((SELECT count(*) FROM rankings) AS BIGINT) AS ranking_row_count,
       CAST((SELECT count(*) FROM rolling) AS BIGINT) AS rolling_row_count,
       (SELECT max(source_ingested_at_utc) FROM summary) AS latest_snapshot_at"""),
    "full_refresh": _with(MARTS, "SELECT * FROM summary"),
    "concurrent_refresh": _with(MARTS, "SELECT * FROM rankings"),
    "refresh_checks": _with(CHECKS, CHECK_ROWS),
    "table_catalogue": _with(MARTS, """
, sizes AS (
  SELECT 'raw/weather_api_responses' AS "table", (SELECT count(*) FROM docs) AS n_rows
  UNION ALL SELECT 'staging/weather_current_conditions', (SELECT count(*) FROM stg_current)
  UNION ALL SELECT 'staging/weather_daily_forecast', (SELECT count(*) FROM stg_daily)
  UNION ALL SELECT 'mart/city_current_weather', (SELECT count(*) FROM mart_current)
  UNION ALL SELECT 'mart/daily_city_weather_summary', (SELECT count(*) FROM summary)
  UNION ALL SELECT 'mart/daily_temperature_rankings', (SELECT count(*) FROM rankings)
  UNION ALL SELECT 'mart/city_rolling_3day_metrics', (SELECT count(*) FROM rolling)
), declared("table", position, "column", type, nullable, key_position) AS (VALUES """ + ", ".join(
        f"('{rel}', {k}, '{name}', '{kind}', {null}, {key})" for rel, columns in DECLARED for k, (name, kind, null, key) in enumerate(columns, 1)
    ) + """)
SELECT d.*, true AS created, true AS as_stored, s.n_rows FROM declared d JOIN sizes s USING ("table")"""),
    # A document's payload is what had landed last when its path was first loaded:
    # events before 2024-01-17 where the week has any, else all of the week.
    "incremental_ingest": _with(DOCS, """
, seen AS (
  SELECT *, min(ts) OVER (PARTITION BY user_id, week) < TIMESTAMP '2024-01-17 00:00:00' AS early FROM ev
),
loaded AS (
  SELECT user_id, week, arg_max(value, (ts, event_id)) AS value, count(DISTINCT CAST(ts AS DATE)) AS n_days
  FROM seen WHERE NOT early OR ts < TIMESTAMP '2024-01-17 00:00:00' GROUP BY user_id, week
)
SELECT d.raw_file_path, 'events' AS source, d.city, d.week AS ingested_at_utc, CAST(l.value AS DECIMAL(6,2)) AS temperature, CAST(l.n_days AS INTEGER) AS n_days
FROM docs d JOIN loaded l USING (user_id, week)"""),
    "view_current": _with(MARTS, "SELECT * FROM mart_current ORDER BY city"),
    "view_daily": _with(MARTS, "SELECT * FROM summary ORDER BY forecast_date, city"),
    "view_rankings": _with(MARTS, "SELECT * FROM rankings ORDER BY forecast_date, max_temperature_rank, city"),
    "view_rolling": _with(MARTS, "SELECT * FROM rolling ORDER BY city, forecast_date"),
    "view_json": _with(MARTS, """
SELECT city,
  strftime(current_time_utc, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(current_time_utc) % 1000000 <> 0 THEN strftime(current_time_utc, '.%f') ELSE '' END || '+00:00' AS current_time_utc,
  temperature_c, relative_humidity_pct, wind_speed_kmh,
  strftime(source_ingested_at_utc, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(source_ingested_at_utc) % 1000000 <> 0 THEN strftime(source_ingested_at_utc, '.%f') ELSE '' END || '+00:00' AS source_ingested_at_utc
FROM mart_current ORDER BY city"""),
}
