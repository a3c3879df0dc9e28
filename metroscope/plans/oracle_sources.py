"""DuckDB oracle SQL for the file source / sink round trips and small serving operators."""
from __future__ import annotations

from metroscope.plans.oracle import F_BRONZE, F_HOURLY, F_MAPPING, F_SILVER, LAKE, ORACLE, _agg, final, with_
from metroscope.plans.oracle_daily import NEWS
from metroscope.plans.oracle_serving import CARDS, CARD_DOUBLES
from metroscope.plans.oracle_daily import SCORED  # noqa: F401

ORACLE["e1_bronze_jsonl"] = final(
    with_(F_BRONZE) + """SELECT 'open311' AS source, city, batch_id, service_request_id, status, service_name, service_code,
 lat, lon, requested_datetime FROM bronze_requests""",
    "lat", "lon",
)
ORACLE["e12_news_tsv"] = final(
    with_(*NEWS) + "SELECT * FROM gdelt", "avg_tone", "goldstein_avg", "avg_tone_7d", "polarity",
)
ORACLE["s9_news_csv"] = with_(*NEWS) + """SELECT CAST(obs_date AS TIMESTAMP) AS obs_date, city, strftime(obs_date, '%Y%m%d') AS "SQLDATE",
 root AS "EventRootCode", action_geo AS "ActionGeo_FullName", actor2_geo AS "Actor2Geo_FullName", url AS "SOURCEURL" FROM news_m"""
ORACLE["s6_silver_roundtrip"] = with_(F_MAPPING, F_BRONZE, F_SILVER) + """SELECT service_request_id, city, batch_id,
 normalized_category, is_infrastructure, is_emergency_type, requested_at_utc, ingested_at_utc FROM silver"""
ORACLE["s10_mapping_csv"] = with_(F_MAPPING, F_BRONZE, F_SILVER) + """SELECT normalized_category, is_infrastructure,
 is_emergency_type, count(*) AS n FROM silver GROUP BY 1, 2, 3"""
ORACLE["s12_date_range"] = """SELECT CAST(o_orderkey AS VARCHAR) AS service_request_id, o_orderdate AS requested_datetime
FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1996-02-01'"""
ORACLE["a16_run_summary"] = with_(*LAKE, F_HOURLY) + f"""SELECT 'hourly_rows' AS metric, count(*) AS n FROM hourly
UNION ALL SELECT 'daily_rows', count(*) FROM ({_agg('day_window')})
UNION ALL SELECT 'category_hourly_rows', count(*) FROM (SELECT DISTINCT city, ingest_year, ingest_month, ingest_day, hour_window, category FROM base)
UNION ALL SELECT 'valid_baselines', count(*) FROM (
 SELECT least(count(t) OVER w, count(i) OVER w, count(e) OVER w) >= 24 AS ok FROM (
  SELECT city, CAST(epoch(window_start) AS BIGINT) AS ep, sum(total_requests) AS t, sum(infrastructure_requests) AS i,
   sum(emergency_requests) AS e FROM hourly GROUP BY city, window_start)
 WINDOW w AS (PARTITION BY city ORDER BY ep RANGE BETWEEN 604800 PRECEDING AND 1 PRECEDING)) WHERE ok"""
ORACLE["t5_display_sample"] = ORACLE["w1_baseline_168h"].replace("SELECT * REPLACE", "SELECT * REPLACE", 1)
ORACLE["t5_display_sample"] = f"""SELECT city, window_start, total_requests_history_points, infrastructure_requests_history_points,
 emergency_ratio_history_points, baseline_history_points, baseline_is_valid
FROM ({ORACLE['w1_baseline_168h']}) AS b ORDER BY window_start, city LIMIT 50"""
ORACLE["f8_city_metrics"] = final(
    with_(*CARDS) + """SELECT metric_name, value_num, value_text, delta_pct, baseline FROM cards
WHERE city = 'boston' AND metric_date = (SELECT max(metric_date) FROM cards WHERE city = 'boston')""",
    *CARD_DOUBLES,
)

_P7 = """CASE WHEN event_id % 13 = 0 THEN '' WHEN event_id % 29 = 0 THEN 'garbage' WHEN event_id % 31 = 0 THEN '   '
 ELSE strftime({c}, '%Y-%m-%dT%H:%M:%S.%fZ') END"""
ORACLE["p7_timestamps"] = with_(
    f"""raw AS (SELECT CAST(event_id AS VARCHAR) AS service_request_id,
  {_P7.format(c='ts')} AS requested_datetime, {_P7.format(c='ts + to_hours(user_id)')} AS updated_datetime,
  CASE WHEN event_id % 3 = 1 THEN {_P7.format(c='ts + to_hours(user_id)')} END AS closed_datetime FROM events)"""
) + """SELECT service_request_id, TRY_CAST(nullif(trim(requested_datetime), '') AS TIMESTAMP) AS requested_at_utc,
 TRY_CAST(nullif(trim(updated_datetime), '') AS TIMESTAMP) AS updated_at_utc,
 TRY_CAST(nullif(trim(closed_datetime), '') AS TIMESTAMP) AS closed_at_utc FROM raw"""

_M = ("total_requests", "infrastructure_requests", "emergency_ratio")
ORACLE["w4_baseline_validity"] = f"""SELECT city, window_start,
 {", ".join(f"{m}_history_points, {m}_baseline_valid" for m in _M)}, baseline_history_points, baseline_is_valid
FROM ({ORACLE['w1_baseline_168h']}) AS b"""

ORACLE["s11_landing_json"] = """SELECT 'open311' AS source, CAST(ts AS DATE) AS date,
 CASE WHEN event_id % 23 = 0 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS service_request_id,
 CASE WHEN user_id % 10 = 0 THEN NULL WHEN user_id % 10 = 1 THEN 'dept' || CAST(user_id % 4 AS VARCHAR)
  ELSE 'dept' || CAST(user_id % 4 AS VARCHAR) || ':' || event_type END AS service_code,
 CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 'Open' WHEN event_id % 3 = 1 THEN 'closed' ELSE 'in progress' END AS status
FROM events"""
