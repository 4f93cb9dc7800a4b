"""DuckDB SQL equivalents of the testbed queries (the correctness gate).

Each statement runs over the driver's tables registered as views and must
give the same rows as ``testbed.QUERIES[name]`` (column names aliased alike).
"""

from __future__ import annotations

_SHAPE = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?$"
_OFF = r"(Z|[+-]\d{2}:?\d{2})$"

AREAS = """
areas AS (
  SELECT n.n_nationkey AS area_key, n.n_name AS area_map_code,
         'EIC-' || CAST(n.n_nationkey AS VARCHAR) AS area_code,
         lower(n.n_name) AS area_name, r.r_name AS area_type_code
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"""

RAW_PRICES = AREAS + """,
raw_prices AS (
  SELECT CAST(date_trunc('day', e.ts) AS TIMESTAMP) AS datetime,
         CASE WHEN e.event_id % 4 = 0 THEN 'PT15M' ELSE 'PT60M' END AS resolution_code,
         a.area_code, a.area_name, a.area_type_code, a.area_map_code,
         e.event_type AS contract_type,
         CASE WHEN e.event_id % 10 = 0 THEN '' WHEN e.event_id % 17 = 0 THEN 'n/e'
              WHEN e.event_id % 7 = 0 THEN ' ' || CAST(e.value AS VARCHAR) || ' '
              ELSE CAST(e.value AS VARCHAR) END AS price,
         'EUR' AS currency, e.ts AS update_time, e.event_id AS load_id
  FROM events e JOIN areas a ON a.area_key = CAST(e.user_id % 25 AS INTEGER))"""

STG_PRICES = RAW_PRICES + """,
stg_prices AS (
  SELECT datetime, resolution_code, area_code, area_name, area_type_code, area_map_code,
         contract_type, TRY_CAST(price AS DOUBLE) AS price, currency, update_time
  FROM (SELECT *, row_number() OVER (
          PARTITION BY datetime, resolution_code, area_map_code, contract_type
          ORDER BY load_id DESC) AS rn FROM raw_prices) t
  WHERE rn = 1),
fct_prices AS (
  SELECT datetime, area_map_code, resolution_code, contract_type, price, currency
  FROM stg_prices)"""

_IMB = ["positive_imbalance_price", "positive_scarcity_price", "positive_incentive_price",
        "positive_financial_neutrality_price", "negative_imbalance_price",
        "negative_scarcity_price", "negative_incentive_price",
        "negative_financial_neutrality_price"]

FCT_IMBALANCE = AREAS + """,
raw_imbalance AS (
  SELECT CAST(date_trunc('hour', e.ts) AS TIMESTAMP) AS datetime,
    CASE WHEN e.event_id % 4 = 0 THEN 'PT15M' ELSE 'PT60M' END AS resolution_code,
    a.area_code, a.area_name, a.area_type_code, a.area_map_code,
    CASE WHEN e.event_id % 5 = 0 THEN 'PLN' ELSE 'EUR' END AS currency,
    CASE WHEN e.event_type = 'error' THEN 'A' ELSE '' END AS status,
    CAST(e.value AS VARCHAR) AS positive_imbalance_price,
    CASE WHEN e.event_id % 3 = 0 THEN CAST(e.value / 4 AS VARCHAR) ELSE '' END
      AS positive_scarcity_price,
    '' AS positive_incentive_price,
    CASE WHEN e.event_id % 11 = 0 THEN 'n/e' ELSE CAST(e.value * CAST(0.1 AS DOUBLE) AS VARCHAR) END
      AS positive_financial_neutrality_price,
    CAST(-e.value AS VARCHAR) AS negative_imbalance_price,
    '' AS negative_scarcity_price,
    CASE WHEN e.event_type = 'click' THEN CAST(e.value * 2 AS VARCHAR) ELSE '' END
      AS negative_incentive_price,
    '' AS negative_financial_neutrality_price,
    e.ts AS update_time, e.event_id AS load_id
  FROM events e JOIN areas a ON a.area_key = CAST(e.user_id % 25 AS INTEGER)),
stg_imbalance AS (
  SELECT datetime, resolution_code, area_code, area_name, area_type_code, area_map_code,
    """ + ",\n    ".join(f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in _IMB) + """,
    currency, status, update_time
  FROM (SELECT *, row_number() OVER (
          PARTITION BY datetime, resolution_code, area_map_code, currency, status
          ORDER BY load_id DESC) AS rn FROM raw_imbalance) t
  WHERE rn = 1),
fct_imbalance AS (
  SELECT datetime, area_map_code, resolution_code, currency, status, update_time,
    CASE WHEN price_metric LIKE 'positive_%' THEN 'positive'
         WHEN price_metric LIKE 'negative_%' THEN 'negative' END AS direction,
    CASE WHEN price_metric LIKE '%_imbalance_price' THEN 'imbalance'
         WHEN price_metric LIKE '%_scarcity_price' THEN 'scarcity'
         WHEN price_metric LIKE '%_incentive_price' THEN 'incentive'
         WHEN price_metric LIKE '%_financial_neutrality_price' THEN 'financial_neutrality'
    END AS price_category,
    price_metric, price
  FROM (SELECT datetime, area_map_code, resolution_code, currency, status, update_time,
               """ + ", ".join(_IMB) + """ FROM stg_imbalance) w
  UNPIVOT (price FOR price_metric IN (""" + ", ".join(_IMB) + """)))"""

FCT_GENERATION = AREAS + """,
raw_generation AS (
  SELECT CAST(date_trunc('hour', e.ts) AS TIMESTAMP) AS datetime, 'PT60M' AS resolution_code,
    a.area_code, a.area_name, a.area_type_code, a.area_map_code,
    e.event_type AS production_type,
    CAST(e.value AS VARCHAR) AS actual_generation_output_mw,
    CASE WHEN e.event_id % 3 = 0 THEN '' ELSE CAST(e.value / 2 AS VARCHAR) END
      AS actual_consumption_mw,
    e.ts AS update_time, e.event_id AS load_id
  FROM events e JOIN areas a ON a.area_key = CAST(e.user_id % 25 AS INTEGER)),
stg_generation AS (
  SELECT datetime, resolution_code, area_code, area_name, area_type_code, area_map_code,
    production_type,
    TRY_CAST(actual_generation_output_mw AS DOUBLE) AS actual_generation_output_mw,
    TRY_CAST(actual_consumption_mw AS DOUBLE) AS actual_consumption_mw, update_time
  FROM (SELECT *, row_number() OVER (
          PARTITION BY datetime, resolution_code, area_code, production_type
          ORDER BY load_id DESC) AS rn FROM raw_generation) t
  WHERE rn = 1),
fct_generation AS (
  SELECT datetime, area_code, area_name, area_type_code, area_map_code, resolution_code,
    production_type, update_time,
    CASE WHEN measure_metric = 'actual_generation_output_mw' THEN 'generation_output'
         ELSE 'consumption' END AS measure_category,
    measure_metric, actual_mw
  FROM stg_generation
  UNPIVOT (actual_mw FOR measure_metric IN (actual_generation_output_mw, actual_consumption_mw)))"""

FCT_FORECASTS = AREAS + """,
raw_forecasts AS (
  SELECT o.o_orderdate AS datetime,
    CASE WHEN o.o_orderstatus = 'O' THEN 'PT15M' ELSE 'PT60M' END AS resolution_code,
    a.area_code, a.area_name, a.area_type_code, a.area_map_code,
    o.o_orderpriority AS production_type,
    CAST(o.o_totalprice AS VARCHAR) AS day_ahead_generation_forecast_mw,
    CASE WHEN o.o_orderstatus = 'F' THEN '' ELSE CAST(o.o_totalprice / 2 AS VARCHAR) END
      AS intraday_generation_forecast_mw,
    CASE WHEN o.o_orderstatus = 'P' THEN 'n/e' ELSE CAST(o.o_totalprice / 3 AS VARCHAR) END
      AS current_generation_forecast_mw,
    o.o_orderdate AS update_time, o.o_orderkey AS load_id
  FROM orders o JOIN areas a ON a.area_key = CAST(o.o_custkey % 25 AS INTEGER)),
stg_forecasts AS (
  SELECT datetime, resolution_code, area_code, area_name, area_type_code, area_map_code,
    production_type,
    TRY_CAST(day_ahead_generation_forecast_mw AS DOUBLE) AS day_ahead_generation_forecast_mw,
    TRY_CAST(intraday_generation_forecast_mw AS DOUBLE) AS intraday_generation_forecast_mw,
    TRY_CAST(current_generation_forecast_mw AS DOUBLE) AS current_generation_forecast_mw,
    update_time
  FROM (SELECT *, row_number() OVER (
          PARTITION BY datetime, resolution_code, area_code, production_type
          ORDER BY load_id DESC) AS rn FROM raw_forecasts) t
  WHERE rn = 1),
fct_forecasts AS (
  SELECT datetime, area_code, area_name, area_type_code, area_map_code, resolution_code,
    production_type, update_time,
    CASE WHEN forecast_metric = 'day_ahead_generation_forecast_mw' THEN 'day_ahead'
         WHEN forecast_metric = 'intraday_generation_forecast_mw' THEN 'intraday'
         ELSE 'current' END AS forecast_category,
    forecast_metric, forecast_mw
  FROM stg_forecasts
  UNPIVOT (forecast_mw FOR forecast_metric IN (day_ahead_generation_forecast_mw,
           intraday_generation_forecast_mw, current_generation_forecast_mw)))"""

_ZMB = ["zmb_fcrg", "zmb_fcrd", "zmb_frrg", "zmb_frrd", "zmb_afrrg", "zmb_afrrd",
        "zmb_rrg", "zmb_rrd"]

FCT_ZMB = """
raw_zmb AS (
  SELECT CAST(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS dtime_utc,
    strftime(o_orderdate, '%Y-%m-%d') AS business_date,
    o_totalprice AS zmb_fcrg,
    CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice / 2 END AS zmb_fcrd,
    CAST(o_custkey AS DOUBLE) AS zmb_frrg,
    CAST(NULL AS DOUBLE) AS zmb_frrd,
    o_totalprice / 4 AS zmb_afrrg,
    CASE WHEN o_orderstatus = 'O' THEN o_totalprice / 5 END AS zmb_afrrd,
    CAST(o_orderkey AS DOUBLE) AS zmb_rrg,
    CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice / 6 END AS zmb_rrd,
    CAST(strftime(o_orderdate, '%Y-%m-%d') || ' 12:00:00.265' AS TIMESTAMP) AS publication_ts_utc,
    o_orderkey AS load_id
  FROM orders),
stg_zmb AS (
  SELECT dtime_utc, CAST(business_date AS DATE) AS business_date, """ + ", ".join(_ZMB) + """,
    publication_ts_utc
  FROM (SELECT *, row_number() OVER (PARTITION BY dtime_utc, business_date
                                     ORDER BY load_id DESC) AS rn FROM raw_zmb) t
  WHERE rn = 1)"""

FCT_COR = """
raw_cor AS (
  SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS dtime_utc,
    strftime(ts, '%Y-%m-%d') AS business_date,
    value AS cor_cost,
    CASE WHEN event_type = 'error' THEN NULL ELSE value * CAST(1.5 AS DOUBLE) END AS cor_fcst,
    ts AS publication_ts_utc, event_id AS load_id
  FROM events),
stg_cor AS (
  SELECT dtime_utc, CAST(business_date AS DATE) AS business_date, cor_cost, cor_fcst,
    publication_ts_utc
  FROM (SELECT *, row_number() OVER (PARTITION BY dtime_utc, business_date
                                     ORDER BY load_id DESC) AS rn FROM raw_cor) t
  WHERE rn = 1)"""

REPLICA = """
remote AS (
  SELECT * FROM events
  WHERE ts < TIMESTAMP '2024-01-20'
    AND NOT (ts >= TIMESTAMP '2024-01-18' AND event_type = 'error')
    AND NOT (ts < TIMESTAMP '2024-01-10' AND event_type = 'signup'))"""

MANIFEST = r"""
manifest AS (
  SELECT (CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y_%m_%d')
               ELSE strftime(o_orderdate, '%Y_%m') END)
         || '_' ||
         (CASE WHEN o_orderpriority = '1-URGENT' THEN 'EnergyPrices_12.1.D_r3.1'
               WHEN o_orderpriority = '2-HIGH' THEN 'ImbalancePrices_17.1.G_r3.1'
               WHEN o_orderpriority = '3-MEDIUM' THEN 'GenerationForecastsForWindAndSolar_14.1.D_r3'
               WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'AggregatedGenerationPerType_16.1.B_C_r3'
               ELSE 'Unknown_1.A' END)
         || (CASE WHEN o_orderkey % 5 = 0 THEN '.CSV' WHEN o_orderkey % 5 = 1 THEN '.csv'
                  ELSE '' END) AS file_name,
         CASE WHEN o_orderstatus = 'P' THEN 'n/a'
              ELSE strftime(o_orderdate, '%Y-%m-%d') || 'T'
                   || lpad(CAST(o_custkey % 24 AS VARCHAR), 2, '0') || ':00:00' END AS updated,
         o_orderstatus AS status
  FROM orders),
annotated0 AS (
  SELECT *,
    regexp_replace(regexp_replace(file_name, '(?i)\.csv$', ''), '^\d{4}_\d{2}(_\d{2})?_', '')
      AS folder,
    CASE WHEN lower(file_name) LIKE '%.csv' THEN file_name ELSE file_name || '.csv' END
      AS filename
  FROM manifest),
annotated AS (SELECT *, substr(filename, 1, 4) AS year FROM annotated0)"""

UTC_TEXTS = """
texts AS (
  SELECT event_id,
    CASE WHEN event_type = 'click' THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
         WHEN event_type = 'view' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'
         WHEN event_type = 'purchase' THEN ' ' || strftime(ts, '%Y-%m-%d %H:%M') || 'Z '
         WHEN event_type = 'signup' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || '+02:00'
         WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%d')
         ELSE '' END AS ts_text
  FROM events),
stripped AS (SELECT event_id, trim(ts_text) AS s FROM texts),
parsed AS (
  SELECT event_id, s,
    regexp_matches(s, '""" + _SHAPE + """') AS shape_ok,
    regexp_extract(s, '""" + _OFF + """', 1) AS off,
    TRY_CAST(regexp_replace(regexp_replace(regexp_replace(s, '""" + _OFF + """', ''),
             'T', ' '), '^(\\S+ \\d{2}:\\d{2})$', '\\1:00') AS TIMESTAMP) AS naive
  FROM stripped),
judged AS (
  SELECT event_id, naive,
    CASE WHEN s = '' THEN 'missing'
         WHEN NOT shape_ok THEN 'malformed'
         WHEN naive IS NULL THEN 'malformed'
         WHEN off NOT IN ('', 'Z', '+00:00', '-00:00', '+0000', '-0000') THEN 'non-UTC offset'
    END AS reason
  FROM parsed)"""

_TS = "'%Y-%m-%d %H:%M:%S.%f'"

SQL = {
    "parse_double_try": "WITH " + RAW_PRICES + """
SELECT load_id, trim(price) AS price_text_clean, TRY_CAST(price AS DOUBLE) AS price
FROM raw_prices""",
    "dedupe_latest_prices": "WITH " + STG_PRICES + "\nSELECT * FROM stg_prices",
    "fct_prices": "WITH " + STG_PRICES + "\nSELECT * FROM fct_prices",
    "dim_area_distinct": "WITH " + STG_PRICES + """
SELECT DISTINCT area_map_code, area_code, area_name, area_type_code FROM stg_prices""",
    "fact_join_dim": "WITH " + STG_PRICES + """
SELECT f.*, a.area_code, a.area_name, a.area_type_code
FROM fct_prices f LEFT JOIN areas a ON f.area_map_code = a.area_map_code""",
    "unpivot_measures": """
SELECT l_orderkey, l_linenumber, l_shipdate, metric, value
FROM (SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity AS quantity,
             NULLIF(l_discount, 0) AS discount, NULLIF(l_tax, 0) AS tax FROM lineitem) w
UNPIVOT (value FOR metric IN (quantity, discount, tax))""",
    "unpivot_categories": "WITH " + FCT_IMBALANCE + "\nSELECT * FROM fct_imbalance",
    "fct_generation_long": "WITH " + FCT_GENERATION + "\nSELECT * FROM fct_generation",
    "fct_forecasts_long": "WITH " + FCT_FORECASTS + "\nSELECT * FROM fct_forecasts",
    "fct_pse_zmb": "WITH " + FCT_ZMB + """
SELECT dtime_utc, business_date, product, demand_mw
FROM stg_zmb UNPIVOT (demand_mw FOR product IN (""" + ", ".join(_ZMB) + "))",
    "fct_pse_cor": "WITH " + FCT_COR + """
SELECT dtime_utc, business_date, cor_cost, cor_fcst FROM stg_cor""",
    "metric_prices_by_area": "WITH " + STG_PRICES + """
SELECT f.area_map_code, a.area_type_code, ROUND(AVG(f.price), 6) AS average_price,
       MAX(f.price) AS max_price, MIN(f.price) AS min_price, COUNT(*) AS row_count
FROM fct_prices f LEFT JOIN areas a ON f.area_map_code = a.area_map_code
GROUP BY f.area_map_code, a.area_type_code""",
    "metric_totals_long": "WITH " + FCT_GENERATION + """
SELECT measure_category, production_type, resolution_code,
       ROUND(AVG(actual_mw), 4) AS average_actual_mw, MAX(actual_mw) AS max_actual_mw,
       ROUND(SUM(actual_mw), 4) AS total_actual_mw, COUNT(*) AS row_count
FROM fct_generation GROUP BY measure_category, production_type, resolution_code""",
    "metric_imbalance_daily": "WITH " + FCT_IMBALANCE + """
SELECT CAST(date_trunc('day', datetime) AS TIMESTAMP) AS datetime, direction, price_category,
       ROUND(AVG(price), 6) AS average_imbalance_price, MAX(price) AS max_imbalance_price,
       MIN(price) AS min_imbalance_price, COUNT(*) AS row_count
FROM fct_imbalance GROUP BY 1, 2, 3""",
    "price_series_filtered": "WITH " + STG_PRICES + """
SELECT datetime, price FROM fct_prices
WHERE area_map_code = 'NATION_7' AND contract_type = 'click' AND resolution_code = 'PT60M'
ORDER BY datetime""",
    "year_slice": """
SELECT * FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
ORDER BY o_orderdate""",
    "year_counts": """
SELECT CAST(y.year AS INTEGER) AS year, COUNT(o.o_orderkey) AS row_count
FROM range(1995, 2003) AS y(year)
LEFT JOIN orders o ON o.o_orderdate >= make_timestamp(y.year, 1, 1, 0, 0, 0)
                  AND o.o_orderdate < make_timestamp(y.year + 1, 1, 1, 0, 0, 0)
GROUP BY y.year""",
    "upsert_keyed": """
WITH target AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
source AS (
  SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice + CAST(1.0 AS DOUBLE) AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
SELECT t.* FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.o_orderkey = t.o_orderkey)
UNION ALL
SELECT * FROM source""",
    "replace_window_overlap": "WITH " + REPLICA + """,
cut AS (SELECT MAX(ts) - INTERVAL 2 DAY AS c FROM remote)
SELECT r.* FROM remote r WHERE NOT COALESCE(r.ts > (SELECT c FROM cut), FALSE)
UNION ALL
SELECT e.* FROM events e WHERE e.ts > (SELECT c FROM cut)""",
    "sync_signature": "WITH " + REPLICA + f"""
SELECT 'local' AS side, COUNT(*) AS row_count, strftime(MAX(ts), {_TS}) AS max_ts FROM events
UNION ALL
SELECT 'remote' AS side, COUNT(*) AS row_count, strftime(MAX(ts), {_TS}) AS max_ts FROM remote""",
    "sync_decision": "WITH " + REPLICA + f""",
rmax AS (SELECT MAX(ts) AS m FROM remote),
cand AS (SELECT COUNT(*) AS n FROM events WHERE ts > (SELECT m FROM rmax) - INTERVAL 2 DAY),
behind AS (SELECT COUNT(*) AS n FROM events
           WHERE ts < TIMESTAMP '2024-01-05' AND ts > (SELECT m FROM rmax)),
omax AS (SELECT MAX(o_orderdate) AS m FROM orders),
ocand AS (SELECT COUNT(*) AS n FROM orders WHERE o_orderdate > (SELECT m FROM omax) - INTERVAL 2 DAY)
SELECT 'events' AS table_name,
       CASE WHEN (SELECT n FROM cand) = 0 THEN 'skip' ELSE 'append' END AS action,
       (SELECT n FROM cand) AS candidates, strftime((SELECT m FROM rmax), {_TS}) AS remote_max
UNION ALL SELECT 'events_force', 'full-copy', CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR)
UNION ALL SELECT 'events_empty', 'full-copy', CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR)
UNION ALL SELECT 'events_missing', 'full-copy', CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR)
UNION ALL SELECT 'events_behind',
       CASE WHEN (SELECT n FROM behind) = 0 THEN 'skip' ELSE 'append' END,
       (SELECT n FROM behind), strftime((SELECT m FROM rmax), {_TS})
UNION ALL SELECT 'orders_same',
       CASE WHEN (SELECT n FROM ocand) = 0 THEN 'skip' ELSE 'append' END,
       (SELECT n FROM ocand), strftime((SELECT m FROM omax), {_TS})
UNION ALL SELECT 'nation_same', 'skip', CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR)
UNION ALL SELECT 'nation_changed',
       CASE WHEN (SELECT COUNT(*) FROM nation) = (SELECT COUNT(*) FROM nation WHERE n_regionkey <> 0)
            THEN 'skip' ELSE 'replace-small' END,
       CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR)
UNION ALL SELECT 'nation_missing', 'replace-small', CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR)""",
    "incremental_since": "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-25 00:00:00'",
    "watermark_advance": f"""
SELECT 'rows' AS case_name,
       strftime(greatest(TIMESTAMP '2024-01-25 00:00:00',
                         coalesce(MAX(ts), TIMESTAMP '2024-01-25 00:00:00')), {_TS}) AS watermark
FROM events WHERE ts > TIMESTAMP '2024-01-25 00:00:00'
UNION ALL
SELECT 'empty' AS case_name, strftime(TIMESTAMP '2024-01-25 00:00:00', {_TS}) AS watermark""",
    "business_dates_slice": """
SELECT * FROM events
WHERE CAST(ts AS DATE) IN (DATE '2024-01-03', DATE '2024-01-15', DATE '2024-01-27',
                           DATE '2024-01-28', DATE '2024-01-29', DATE '2024-01-30')""",
    "manifest_folder": "WITH " + MANIFEST + "\nSELECT file_name, folder FROM annotated",
    "manifest_normalize": "WITH " + MANIFEST + "\nSELECT file_name, filename, year FROM annotated",
    "manifest_select_years": "WITH " + MANIFEST + """
SELECT filename, updated FROM annotated
WHERE folder = 'ImbalancePrices_17.1.G_r3.1' AND year IN ('1996', '1998')""",
    "manifest_latest": "WITH " + MANIFEST + """,
keyed AS (
  SELECT folder, filename, updated,
    CASE WHEN regexp_matches(updated, '""" + _SHAPE + """')
         THEN TRY_CAST(replace(updated, 'T', ' ') AS TIMESTAMP) END AS ts
  FROM annotated),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY folder
    ORDER BY (ts IS NULL) DESC, ts DESC NULLS LAST, filename DESC, updated DESC) AS rn
  FROM keyed)
SELECT folder, filename, updated FROM ranked WHERE rn = 1""",
    "manifest_limit": "WITH " + MANIFEST + """,
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY folder, year ORDER BY filename, updated) AS rn
  FROM annotated)
SELECT folder, year, filename, updated FROM ranked WHERE rn <= 3""",
    "manifest_changed": "WITH " + MANIFEST + """,
state AS (SELECT filename, MIN(updated) AS updated FROM annotated WHERE status <> 'O'
          GROUP BY filename)
SELECT a.filename, a.updated FROM annotated a LEFT JOIN state s ON a.filename = s.filename
WHERE a.updated IS DISTINCT FROM s.updated""",
    "json_rows": """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
FROM events WHERE event_type <> 'error'""",
    "merge_monthly": "WITH " + RAW_PRICES + "\nSELECT * FROM raw_prices WHERE area_map_code = 'NATION_3'",
    "parse_utc_valid": "WITH " + UTC_TEXTS + """
SELECT event_id, naive AS ts_utc FROM judged WHERE reason IS NULL""",
    "parse_utc_rejects": "WITH " + UTC_TEXTS + """
SELECT event_id, 'ts_text' AS field, reason FROM judged WHERE reason IS NOT NULL""",
    "parse_utc_optional": "WITH " + UTC_TEXTS + """
SELECT event_id,
       CASE WHEN reason IS NULL THEN naive END AS ts_utc,
       CASE WHEN reason = 'missing' THEN NULL ELSE reason END AS reason
FROM judged""",
    "format_utc": f"SELECT event_id, strftime(ts, {_TS}) AS ts_text FROM events",
    "check_unique": """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
    "check_not_null": "WITH " + STG_PRICES + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count "
        f"FROM stg_prices"
        for c in ["datetime", "area_map_code", "contract_type", "price", "update_time"]),
    "distinct_values": "WITH " + STG_PRICES + "\nSELECT DISTINCT contract_type FROM fct_prices",
    "time_range": "WITH " + STG_PRICES + """
SELECT MIN(datetime) AS min_value, MAX(datetime) AS max_value, COUNT(*) AS row_count
FROM fct_prices""",
    "profile_tables": "\nUNION ALL\n".join(
        f"SELECT 'testdata' AS schema_name, '{t}' AS table_name, CAST({n} AS INTEGER) AS n_columns, "
        f"COUNT(*) AS row_count, "
        + (f"'{tc}' AS time_column, strftime(MIN({tc}), {_TS}) AS min_time, "
           f"strftime(MAX({tc}), {_TS}) AS max_time" if tc else
           "CAST(NULL AS VARCHAR) AS time_column, CAST(NULL AS VARCHAR) AS min_time, "
           "CAST(NULL AS VARCHAR) AS max_time")
        + f" FROM {t}"
        for t, n, tc in [("customer", 5, None), ("events", 6, "ts"), ("lineitem", 11, "l_shipdate"),
                         ("nation", 3, None), ("orders", 6, "o_orderdate")]),
    "load_progress": """
WITH expected(resource, expected) AS (
  VALUES ('click', 2000), ('view', 2500), ('purchase', 100), ('signup', 0), ('energy_prices', 21)),
per AS (
  SELECT event_type AS resource, COUNT(*) AS started,
         COUNT(*) FILTER (WHERE event_type <> 'error') AS done,
         SUM(CASE WHEN event_type <> 'error' THEN CAST(floor(value) AS BIGINT) END) AS rows,
         '2024_01_' || CAST(MAX(event_id) AS VARCHAR) || '.csv' AS last_file
  FROM events GROUP BY event_type)
SELECT e.resource, CAST(e.expected AS BIGINT) AS expected,
       CAST(COALESCE(p.started, 0) AS BIGINT) AS started,
       CAST(COALESCE(p.done, 0) AS BIGINT) AS done,
       CAST(COALESCE(p.rows, 0) AS BIGINT) AS rows, p.last_file
FROM expected e LEFT JOIN per p ON e.resource = p.resource
WHERE e.expected > 0""",
}

_NN = [("stg_entsoe_generation_forecasts", "stg_forecasts", ["datetime", "area_code", "production_type"], FCT_FORECASTS),
       ("stg_entsoe_imbalance_prices", "stg_imbalance", ["datetime", "area_map_code"], FCT_IMBALANCE),
       ("stg_entsoe_aggregated_generation", "stg_generation", ["datetime", "area_code", "production_type"], FCT_GENERATION)]


def _quality_sql() -> str:
    parts = []
    for model, cte, cols, body in _NN:
        for c in cols:
            parts.append(f"(WITH {body} SELECT '{model}' AS model, '{c}' AS column_name, "
                         f"'not_null' AS test, CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) "
                         f"AS failures FROM {cte})")
    parts.append("(WITH " + STG_PRICES + ", dim AS (SELECT DISTINCT area_map_code, area_code, "
                 "area_name, area_type_code FROM stg_prices) SELECT 'dim_area' AS model, "
                 "'area_map_code' AS column_name, 'not_null' AS test, CAST(COUNT(*) FILTER "
                 "(WHERE area_map_code IS NULL) AS BIGINT) AS failures FROM dim)")
    parts.append("(WITH " + STG_PRICES + ", dim AS (SELECT DISTINCT area_map_code, area_code, "
                 "area_name, area_type_code FROM stg_prices) SELECT 'dim_area' AS model, "
                 "'area_map_code' AS column_name, 'unique' AS test, CAST(COUNT(*) AS BIGINT) "
                 "AS failures FROM (SELECT area_map_code FROM dim WHERE area_map_code IS NOT NULL "
                 "GROUP BY area_map_code HAVING COUNT(*) > 1))")
    return "\nUNION ALL\n".join(parts)


SQL["quality_report"] = _quality_sql()
