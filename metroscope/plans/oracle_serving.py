"""DuckDB oracle SQL for metric cards, serving queries, merges, collectors and checks."""
from __future__ import annotations

from metroscope.plans.oracle import CITY, ORACLE, final, pyround, with_, xmean
from metroscope.plans.oracle_daily import (
    F_ALERTS, F_REQ_RAW, F_REQUESTS, F_STATIONS, F_WEATHER, NEWS, SCORED, _f1,
)

F_CARDS = f"""opens AS (SELECT city, CAST(requested_datetime AS DATE) AS d, count(*) AS n FROM requests WHERE status = 'open' GROUP BY 1, 2),
ob_u AS (SELECT city, d, sum(n) AS n, bool_or(sp) AS sp FROM (
  SELECT city, d, 0 AS n, true AS sp FROM spine UNION ALL SELECT city, d, n, false AS sp FROM opens) GROUP BY 1, 2),
ob AS (SELECT city, d, CAST(sum(n) OVER (PARTITION BY city ORDER BY d ROWS UNBOUNDED PRECEDING) AS BIGINT) AS open_backlog, sp FROM ob_u),
mc AS (SELECT city, CAST(requested_datetime AS DATE) AS d, {xmean('resolution_hrs', 2)} AS mean_close_hrs
 FROM requests WHERE status = 'closed' GROUP BY 1, 2),
tc AS (SELECT city, d, service_name AS top_category FROM (
  SELECT city, CAST(requested_datetime AS DATE) AS d, service_name, count(*) AS cnt FROM requests GROUP BY 1, 2, 3)
 QUALIFY row_number() OVER (PARTITION BY city, d ORDER BY cnt DESC, service_name) = 1),
tx AS (SELECT c.city, w.obs_date AS d, {pyround('max(w.tmax)', 1)} AS tmax FROM weather w JOIN stations c USING (station_id) GROUP BY 1, 2),
wr AS (SELECT station_id, obs_date, row_number() OVER (PARTITION BY station_id ORDER BY obs_date) AS rn,
  coalesce(heat_index_max > 40, false) OR coalesce(tmax > 35, false) AS hot FROM weather),
ws AS (SELECT station_id, obs_date, rn - coalesce(max(CASE WHEN NOT hot THEN rn END)
  OVER (PARTITION BY station_id ORDER BY obs_date ROWS UNBOUNDED PRECEDING), 0) AS streak FROM wr),
st_spine AS (SELECT s.city, s.d, c.station_id FROM spine s JOIN stations c USING (city)),
st_days AS (SELECT DISTINCT station_id, d FROM st_spine),
st_streak AS (SELECT sd.station_id, sd.d, coalesce(ws.streak, 0) AS streak
 FROM st_days sd ASOF LEFT JOIN ws ON sd.station_id = ws.station_id AND sd.d >= ws.obs_date),
streak AS (SELECT sp.city, sp.d, CAST(coalesce(max(st.streak), 0) AS INTEGER) AS heat_streak_days
 FROM st_spine sp LEFT JOIN st_streak st USING (station_id, d) GROUP BY 1, 2),
st_precip AS (SELECT sd.station_id, sd.d, (SELECT sum(w.precip_6hr_max) FROM weather w
  WHERE w.station_id = sd.station_id AND w.obs_date BETWEEN sd.d - 2 AND sd.d) AS p FROM st_days sd),
precip AS (SELECT sp.city, sp.d, {pyround('coalesce(max(pr.p), 0.0::DOUBLE)', 2)} AS precip_72hr_mm
 FROM st_spine sp LEFT JOIN st_precip pr USING (station_id, d) GROUP BY 1, 2),
wide AS (SELECT s.city, s.d, ob.open_backlog, mc.mean_close_hrs, tc.top_category, tx.tmax, st.heat_streak_days,
  {pyround('g.avg_tone_7d', 3)} AS media_tone_7d, g.protest_event_count AS protest_mentions, g.city IS NOT NULL AS has_news,
  pr.precip_72hr_mm
 FROM spine s LEFT JOIN ob USING (city, d) LEFT JOIN mc USING (city, d) LEFT JOIN tc USING (city, d)
  LEFT JOIN tx USING (city, d) LEFT JOIN streak st USING (city, d) LEFT JOIN precip pr USING (city, d)
  LEFT JOIN gdelt g ON g.city = s.city AND g.obs_date = s.d)"""


def _cards_sql(lo: str) -> str:
    """W10 baselines over earlier rows (``lo`` = UNBOUNDED or a row count) and the U2 stack."""
    w = f"(PARTITION BY city ORDER BY d ROWS BETWEEN {lo} PRECEDING AND 1 PRECEDING)"

    def ok(b: str) -> str:
        return f"({b} IS NOT NULL AND {b} <> 0)"

    def delta(x: str, b: str, need_x: bool) -> str:
        cond = ok(b) + (f" AND ({x} IS NOT NULL AND {x} <> 0)" if need_x else "")
        return f"CASE WHEN {cond} THEN {pyround(f'({x} - {b}) / {b} * 100', 2)} ELSE 0.0::DOUBLE END"

    def base(x: str, b: str) -> str:
        return f"CASE WHEN {ok(b)} THEN {b} ELSE CAST({x} AS DOUBLE) END"

    nd, ns = "CAST(NULL AS DOUBLE)", "CAST(NULL AS VARCHAR)"
    rows = [
        ("open_backlog", "CAST(open_backlog AS DOUBLE)", ns, delta("open_backlog", "b_ob", False), base("open_backlog", "b_ob")),
        ("mean_close_hrs", "mean_close_hrs", ns, delta("mean_close_hrs", "b_mc", True), base("mean_close_hrs", "b_mc")),
        ("top_category", nd, "coalesce(top_category, 'N/A')", nd, nd),
        ("tmax", "tmax", ns, delta("tmax", "b_tx", True), base("tmax", "b_tx")),
        ("heat_streak_days", "CAST(coalesce(heat_streak_days, 0) AS DOUBLE)", ns, nd, nd),
        ("media_tone_7d", "media_tone_7d", ns, nd, nd),
        ("protest_mentions", "CAST(CASE WHEN has_news THEN protest_mentions ELSE 0 END AS DOUBLE)", ns, nd, nd),
        ("precip_72hr_mm", "coalesce(precip_72hr_mm, 0.0::DOUBLE)", ns, nd, nd),
    ]
    based = (f"based AS (SELECT *, {xmean('open_backlog', 6, over=w)} AS b_ob, {xmean('mean_close_hrs', 6, over=w)} AS b_mc,"
             f" {xmean('tmax', 6, over=w)} AS b_tx FROM wide)")
    branches = [
        f"SELECT city, d AS metric_date, '{n}' AS metric_name, {num} AS value_num, {txt} AS value_text,"
        f" {dl} AS delta_pct, {bs} AS baseline FROM based"
        for n, num, txt, dl, bs in rows
    ]
    return based + ",\ncards AS (" + "\n UNION ALL ".join(branches) + ")"


CARDS = SCORED + (F_CARDS, _cards_sql("UNBOUNDED"))
CARD_DOUBLES = ("value_num", "delta_pct", "baseline")

ORACLE["u2_metric_cards"] = final(with_(*CARDS) + "SELECT * FROM cards", *CARD_DOUBLES)
ORACLE["a9_open_backlog"] = with_(*SCORED, F_CARDS) + "SELECT city, d, open_backlog FROM ob WHERE sp"
ORACLE["a10_mean_close"] = final(with_(*SCORED, F_CARDS) + "SELECT city, d, mean_close_hrs FROM mc", "mean_close_hrs")
ORACLE["a11_top_category"] = with_(*SCORED, F_CARDS) + "SELECT city, d, top_category FROM tc"
ORACLE["w10_card_baseline"] = final(
    with_(*SCORED, F_CARDS, _cards_sql("30"))
    + "SELECT * FROM cards WHERE metric_name IN ('open_backlog', 'mean_close_hrs', 'tmax')",
    *CARD_DOUBLES,
)
ORACLE["w11_heat_streak"] = with_(*SCORED, F_CARDS) + "SELECT city, d, heat_streak_days FROM streak"
ORACLE["w12_precip_72h"] = final(with_(*SCORED, F_CARDS) + "SELECT city, d, precip_72hr_mm FROM precip", "precip_72hr_mm")
ORACLE["f7_latest_metrics"] = final(
    with_(*CARDS) + """SELECT * FROM cards WHERE (city, metric_date) IN
 (SELECT city, max(metric_date) FROM cards GROUP BY city)""",
    *CARD_DOUBLES,
)
ORACLE["x12_delta_label"] = with_(*CARDS) + f"""SELECT city, metric_date, metric_name,
 CASE WHEN delta_pct >= 0 THEN '+' ELSE '' END || {_f1('delta_pct')} || '% vs 30d avg' AS delta_label,
 CASE WHEN delta_pct > 0 THEN 'metric-delta-up' WHEN delta_pct < 0 THEN 'metric-delta-down' ELSE 'metric-delta-neu' END AS delta_class
FROM cards WHERE delta_pct IS NOT NULL"""
ORACLE["x13_display_value"] = with_(*CARDS) + """SELECT city, metric_date, metric_name,
 coalesce(nullif(value_text, ''), CAST(CAST(nullif(value_num, 0.0) AS DECIMAL(18, 3)) AS VARCHAR), 'N/A') AS display
FROM cards"""

_T4 = """t4 AS (SELECT city, score_date, composite, composite_baseline_30d, composite - composite_baseline_30d AS delta,
 readiness_mode, anomaly_score, heat_score, alert_score, context_score FROM scored)"""
_SC = ("composite", "composite_baseline_30d", "delta", "anomaly_score", "heat_score", "alert_score", "context_score")
ORACLE["t4_composite_delta"] = final(with_(*SCORED, _T4) + "SELECT * FROM t4", *_SC)
ORACLE["e10_latest_composite"] = final(
    with_(*SCORED, _T4) + """SELECT city, score_date, composite, composite_baseline_30d, delta, readiness_mode
 FROM t4 QUALIFY row_number() OVER (PARTITION BY city ORDER BY score_date DESC) = 1""",
    "composite", "composite_baseline_30d", "delta",
)

from metroscope.plans.oracle_daily import F_DRIVER, F_VERDICT  # noqa: E402

ORACLE["e10_latest_verdict"] = final(
    with_(*SCORED, F_DRIVER, F_VERDICT) + """SELECT city, verdict_date, verdict_text, composite_score, readiness_mode, model_id
 FROM vt QUALIFY row_number() OVER (PARTITION BY city ORDER BY verdict_date DESC) = 1""",
    "composite_score",
)

F_RUN_EVENTS = """run_events AS (
 SELECT 'arn:exec:' || CAST(o_orderkey AS VARCHAR) AS executionArn,
  CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE 'a:b:c:pipe-' || substr(o_orderpriority, 1, 1) END AS stateMachineArn,
  CASE o_orderstatus WHEN 'F' THEN 'SUCCEEDED' WHEN 'O' THEN 'FAILED' ELSE 'TIMED_OUT' END AS status,
  epoch_ms(o_orderdate) AS startDate,
  CASE WHEN o_orderstatus <> 'F' AND o_orderkey % 40 = 0 THEN NULL ELSE epoch_ms(o_orderdate) + o_custkey * 997 END AS stopDate,
  CASE WHEN o_orderstatus <> 'F' AND o_custkey % 4 <> 0 THEN 'States.E' || CAST(o_custkey % 3 AS VARCHAR) END AS error,
  CASE WHEN o_orderstatus <> 'F' AND o_custkey % 3 <> 0 THEN 'cause ' || CAST(o_custkey % 7 AS VARCHAR) END AS cause
 FROM orders),
runs AS (
 SELECT CASE WHEN stateMachineArn IS NOT NULL AND stateMachineArn <> '' THEN string_split(stateMachineArn, ':')[-1]
   ELSE 'unknown' END AS pipeline_name,
  executionArn AS execution_arn,
  CASE WHEN stopDate IS NOT NULL AND stopDate <> 0 THEN make_timestamp(stopDate * 1000) END AS run_at,
  coalesce(status, 'UNKNOWN') AS status,
  CASE WHEN startDate IS NOT NULL AND startDate <> 0 AND stopDate IS NOT NULL AND stopDate <> 0
   THEN greatest(0, CAST(trunc((stopDate - startDate) / 1000) AS INTEGER)) END AS duration_secs,
  CASE WHEN status IN ('FAILED', 'TIMED_OUT', 'ABORTED') THEN
   CASE WHEN coalesce(error, '') <> '' OR coalesce(cause, '') <> ''
    THEN trim(coalesce(error, '') || ': ' || coalesce(cause, ''), ': ') ELSE status END END AS error_message
 FROM run_events)"""

ORACLE["p11_run_log"] = with_(F_RUN_EVENTS) + "SELECT * REPLACE (CAST(duration_secs AS DOUBLE) AS duration_secs) FROM runs"
ORACLE["e10_last_updated"] = with_(*SCORED, F_RUN_EVENTS) + """SELECT p.city,
 CASE WHEN r.last_run IS NOT NULL THEN strftime(r.last_run, '%Y-%m-%d %H:%M') || ' UTC'
  WHEN p.last_score IS NOT NULL THEN CAST(p.last_score AS VARCHAR) || ' (last scored date)' ELSE 'N/A' END AS last_updated,
 CASE WHEN r.last_run IS NOT NULL THEN strftime(r.last_run - INTERVAL 1 DAY, '%Y-%m-%d')
  ELSE CAST(p.last_score AS VARCHAR) END AS data_as_of
FROM (SELECT city, max(score_date) AS last_score FROM scored GROUP BY city) p,
 (SELECT max(run_at) AS last_run FROM runs WHERE status IN ('success', 'SUCCEEDED')) r"""

_CW = "cw AS (SELECT c.city, w.obs_date AS d, max(w.tmax) AS tmax FROM weather w JOIN stations c USING (station_id) GROUP BY 1, 2)"
_HIST = ("composite", "comp_base", "tmax", "tone", "base_311")
ORACLE["j2_history_month"] = final(
    with_(
        *SCORED, _CW,
        "s30 AS (SELECT city, score_date AS d, composite, composite_baseline_30d AS comp_base FROM scored"
        " QUALIFY row_number() OVER (PARTITION BY city ORDER BY score_date DESC) <= 30)",
        "w30 AS (SELECT * FROM cw QUALIFY row_number() OVER (PARTITION BY city ORDER BY d DESC) <= 30)",
        "g30 AS (SELECT city, obs_date AS d, avg_tone_7d AS tone FROM gdelt"
        " QUALIFY row_number() OVER (PARTITION BY city ORDER BY obs_date DESC) <= 30)",
        "v30 AS (SELECT city, CAST(requested_datetime AS DATE) AS d, count(*) AS vol_311 FROM requests GROUP BY 1, 2"
        " QUALIFY row_number() OVER (PARTITION BY city ORDER BY d DESC) <= 30)",
        "j AS (SELECT s.*, w.tmax, g.tone, v.vol_311 FROM s30 s LEFT JOIN w30 w USING (city, d)"
        " LEFT JOIN g30 g USING (city, d) LEFT JOIN v30 v USING (city, d))",
    )
    + """SELECT city, strftime(d, '%Y-%m-%d') AS date, coalesce(composite, 0.0::DOUBLE) AS composite,
 coalesce(comp_base, 0.0::DOUBLE) AS comp_base, coalesce(tmax, 0.0::DOUBLE) AS tmax, coalesce(tone, 0.0::DOUBLE) AS tone,
 coalesce(vol_311, 0) AS vol_311, coalesce(avg(vol_311) OVER (PARTITION BY city), 0.0::DOUBLE) AS base_311 FROM j""",
    *_HIST,
)


def _month(table: str, dcol: str, aggs: str, name: str) -> str:
    return (f"{name} AS (SELECT city, strftime({dcol}, '%b') AS month, CAST(month({dcol}) AS INTEGER) AS month_num, {aggs}"
            f" FROM {table} GROUP BY 1, 2, 3)")


ORACLE["j3_history_year"] = final(
    with_(
        *SCORED, _CW,
        _month("scored", "score_date", "avg(composite) AS composite, avg(composite_baseline_30d) AS comp_base", "sm"),
        _month("cw", "d", "avg(tmax) AS tmax", "wm"),
        _month("gdelt", "obs_date", "avg(avg_tone_7d) AS tone", "gm"),
        _month("requests", "requested_datetime", "count(*) AS vol_311", "vm"),
        "j AS (SELECT s.*, w.tmax, g.tone, v.vol_311 FROM sm s LEFT JOIN wm w USING (city, month, month_num)"
        " LEFT JOIN gm g USING (city, month, month_num) LEFT JOIN vm v USING (city, month, month_num))",
    )
    + """SELECT city, month, month_num, coalesce(composite, 0.0::DOUBLE) AS composite, coalesce(comp_base, 0.0::DOUBLE) AS comp_base,
 coalesce(tmax, 0.0::DOUBLE) AS tmax, coalesce(tone, 0.0::DOUBLE) AS tone, coalesce(vol_311, 0) AS vol_311,
 coalesce(avg(vol_311) OVER (PARTITION BY city), 0.0::DOUBLE) AS base_311 FROM j""",
    *_HIST,
)

# ---------------------------------------------------------------- merges

_EXIST_NEW_REQ = """existing AS (SELECT * FROM req_raw WHERE CAST(service_request_id AS BIGINT) % 2 = 0),
new AS (SELECT service_request_id, city, 'closed' AS status, service_name, requested_datetime,
 updated_datetime + INTERVAL 1 DAY AS updated_datetime FROM req_raw WHERE CAST(service_request_id AS BIGINT) % 3 = 0 OR CAST(service_request_id AS BIGINT) % 2 = 1)"""
ORACLE["m1_upsert"] = with_(F_REQ_RAW, _EXIST_NEW_REQ) + """SELECT * FROM existing
 WHERE service_request_id NOT IN (SELECT service_request_id FROM new) UNION ALL SELECT * FROM new"""

_EXIST_NEW_NEWS = """g2 AS (SELECT city, obs_date, avg_tone, protest_event_count, protest_mention_sum, goldstein_avg, num_articles,
 source_count, avg_tone_7d, 0.25::DOUBLE AS polarity FROM gdelt),
existing AS (SELECT * FROM g2 WHERE day(obs_date) % 2 = 0),
new AS (SELECT city, obs_date, avg_tone, protest_event_count, protest_mention_sum, goldstein_avg, num_articles + 1 AS num_articles,
 source_count, CAST(NULL AS DOUBLE) AS avg_tone_7d, CAST(NULL AS DOUBLE) AS polarity FROM g2 WHERE day(obs_date) % 3 = 0 OR day(obs_date) % 2 = 1)"""
_NEWS_DOUBLES = ("avg_tone", "goldstein_avg", "avg_tone_7d", "polarity")
ORACLE["m2_partial_upsert"] = final(
    with_(*NEWS, _EXIST_NEW_NEWS) + """SELECT coalesce(o.city, n.city) AS city, coalesce(o.obs_date, n.obs_date) AS obs_date,
 CASE WHEN n.city IS NOT NULL THEN n.avg_tone ELSE o.avg_tone END AS avg_tone,
 CASE WHEN n.city IS NOT NULL THEN n.protest_event_count ELSE o.protest_event_count END AS protest_event_count,
 CASE WHEN n.city IS NOT NULL THEN n.protest_mention_sum ELSE o.protest_mention_sum END AS protest_mention_sum,
 CASE WHEN n.city IS NOT NULL THEN n.goldstein_avg ELSE o.goldstein_avg END AS goldstein_avg,
 CASE WHEN n.city IS NOT NULL THEN n.num_articles ELSE o.num_articles END AS num_articles,
 CASE WHEN n.city IS NOT NULL THEN n.source_count ELSE o.source_count END AS source_count,
 CASE WHEN o.city IS NOT NULL THEN o.avg_tone_7d ELSE n.avg_tone_7d END AS avg_tone_7d,
 CASE WHEN o.city IS NOT NULL THEN o.polarity ELSE n.polarity END AS polarity
FROM existing o FULL OUTER JOIN new n ON o.city = n.city AND o.obs_date = n.obs_date""",
    *_NEWS_DOUBLES,
)
ORACLE["m3_insert_absent"] = final(
    with_(*NEWS, _EXIST_NEW_NEWS) + """SELECT * FROM existing UNION ALL
SELECT n.city, n.obs_date, CAST(NULL AS DOUBLE), 0, 0, CAST(NULL AS DOUBLE), 0, 0, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)
FROM new n ANTI JOIN existing e ON n.city = e.city AND n.obs_date = e.obs_date""",
    *_NEWS_DOUBLES,
)

# ---------------------------------------------------------------- collectors

F_BRONZE_API = f"""api AS (
 SELECT CASE WHEN event_id % 23 = 0 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS service_request_id,
  CASE WHEN user_id % 10 = 0 THEN NULL WHEN user_id % 10 = 1 THEN 'dept' || CAST(user_id % 4 AS VARCHAR)
   ELSE 'dept' || CAST(user_id % 4 AS VARCHAR) || ':' || event_type END AS service_code,
  CASE event_type WHEN 'click' THEN 'Pothole' WHEN 'view' THEN 'Illegal Parking' WHEN 'error' THEN 'Rodent Activity'
   WHEN 'signup' THEN 'Needle Cleanup' WHEN 'purchase' THEN 'Street Light Outage' END AS service_name,
  CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 'Open' WHEN event_id % 3 = 1 THEN 'closed' ELSE 'in progress' END AS status,
  ts AS requested_datetime, ts + to_hours(user_id) AS updated_datetime,
  42.0::DOUBLE + (user_id % 50) / 100.0::DOUBLE AS lat, -71.0::DOUBLE - (event_id % 50) / 100.0::DOUBLE AS long,
  CAST(NULL AS VARCHAR) AS description
 FROM events)"""
ORACLE["p2_parse_requests"] = final(
    with_(F_BRONZE_API) + """SELECT service_request_id, service_code, service_name,
 string_split(coalesce(service_code, ''), ':')[1] AS department,
 CASE WHEN len(string_split(coalesce(service_code, ''), ':')) > 1 THEN string_split(coalesce(service_code, ''), ':')[2] END AS category,
 lower(status) AS status, requested_datetime, updated_datetime, CAST(NULL AS DOUBLE) AS resolution_hrs, lat, long AS lon,
 CAST(NULL AS VARCHAR) AS neighbourhood, description
FROM api WHERE service_request_id IS NOT NULL AND service_request_id <> ''""",
    "lat", "lon",
)

F_SOCRATA = """soc AS (
 SELECT CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS case_enquiry_id,
  CASE WHEN o_orderkey % 26 = 0 THEN 'sr' || CAST(o_orderkey AS VARCHAR) END AS service_request_id,
  CASE WHEN o_custkey % 7 = 0 THEN '' ELSE 'reason' || CAST(o_custkey % 5 AS VARCHAR) END AS reason,
  CASE WHEN o_custkey % 11 = 0 THEN '' ELSE 'dept' || CAST(o_custkey % 4 AS VARCHAR) END AS department,
  CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderpriority END AS case_title,
  CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Open' ELSE 'In Progress' END AS case_status,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS open_dt,
  CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate + to_hours(CAST(o_custkey % 200 AS BIGINT)), '%Y-%m-%dT%H:%M:%S') ELSE '' END AS closed_dt,
  strftime(o_orderdate + INTERVAL 72 HOUR, '%Y-%m-%dT%H:%M:%S') AS target_dt,
  o_totalprice / 1e6 AS latitude, -o_totalprice / 1e6 AS longitude,
  'n' || CAST(o_custkey % 9 AS VARCHAR) AS neighborhood,
  CASE WHEN o_orderstatus = 'F' THEN 'resolved' ELSE '' END AS closure_reason
 FROM orders)"""
ORACLE["p3_parse_socrata"] = final(
    with_(F_SOCRATA) + """SELECT coalesce(nullif(case_enquiry_id, ''), service_request_id) AS service_request_id,
 CASE WHEN department <> '' AND reason <> '' THEN department || ':' || reason ELSE coalesce(nullif(department, ''), nullif(reason, '')) END AS service_code,
 coalesce(nullif(case_title, ''), reason) AS service_name, nullif(department, '') AS department, nullif(reason, '') AS category,
 lower(case_status) AS status, open_dt AS requested_datetime, coalesce(nullif(closed_dt, ''), target_dt) AS updated_datetime,
 CAST(NULL AS DOUBLE) AS resolution_hrs, latitude AS lat, longitude AS lon, neighborhood AS neighbourhood,
 coalesce(nullif(closure_reason, ''), case_title) AS description
FROM soc WHERE coalesce(nullif(case_enquiry_id, ''), service_request_id) IS NOT NULL
 AND coalesce(nullif(case_enquiry_id, ''), service_request_id) <> ''""",
    "lat", "lon",
)

ORACLE["p4_alerts"] = with_(F_ALERTS) + "SELECT * FROM alerts"

F_READINGS = """readings AS (
 SELECT 'STN' || CAST(user_id % 2 AS VARCHAR) AS station_id, CAST(ts AS DATE) AS obs_date,
  CASE WHEN day(ts) % 4 = 0 OR event_id % 11 = 0 THEN NULL
   ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS temp_c,
  CASE WHEN event_type IN ('click', 'purchase') THEN value END AS heat_index,
  CASE WHEN event_type = 'error' THEN value / 10 END AS precip_6hr,
  CASE WHEN event_type = 'view' THEN value END AS wind_gust,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) AS humidity,
  event_type AS "desc"
 FROM events),
obs_weather AS (
 SELECT station_id, obs_date, max(temp_c) AS tmax, min(temp_c) AS tmin, max(heat_index) AS heat_index_max,
  max(precip_6hr) AS precip_6hr_max, max(wind_gust) AS wind_gust_max, avg(humidity) AS humidity_avg,
  (SELECT r2."desc" FROM readings r2 WHERE r2.station_id = r.station_id AND r2.obs_date = r.obs_date AND r2.temp_c IS NOT NULL
   GROUP BY r2."desc" ORDER BY count(*) DESC, r2."desc" LIMIT 1) AS text_description
 FROM readings r WHERE temp_c IS NOT NULL GROUP BY station_id, obs_date)"""
_WX = ("tmax", "tmin", "heat_index_max", "precip_6hr_max", "wind_gust_max", "humidity_avg")
ORACLE["p5_json_props"] = final(with_(F_READINGS) + "SELECT * FROM readings", "temp_c", "heat_index", "precip_6hr", "wind_gust", "humidity")
ORACLE["a5_weather_daily"] = final(with_(F_READINGS) + "SELECT * FROM obs_weather", *_WX)

F_DAILY_VALUES = """dv AS (
 SELECT 'STN' || CAST(user_id % 2 AS VARCHAR) AS station_id, CAST(ts AS DATE) AS obs_date,
  CASE event_type WHEN 'click' THEN 'TMAX' WHEN 'view' THEN 'TMIN' WHEN 'error' THEN 'PRCP' WHEN 'signup' THEN 'AWND'
   WHEN 'purchase' THEN 'WSF5' END AS datatype, value - 10 AS value FROM events),
wide_dv AS (
 SELECT station_id, obs_date, max(value) FILTER (WHERE datatype = 'TMAX') AS TMAX, max(value) FILTER (WHERE datatype = 'TMIN') AS TMIN,
  max(value) FILTER (WHERE datatype = 'PRCP') AS PRCP, max(value) FILTER (WHERE datatype = 'AWND') AS AWND,
  max(value) FILTER (WHERE datatype = 'WSF5') AS WSF5 FROM dv GROUP BY 1, 2),
cdo_weather AS (
 SELECT station_id, obs_date, TMAX AS tmax, TMIN AS tmin, CAST(NULL AS DOUBLE) AS heat_index_max, PRCP AS precip_6hr_max,
  coalesce(WSF5, AWND) AS wind_gust_max, CAST(NULL AS DOUBLE) AS humidity_avg,
  CASE WHEN PRCP IS NOT NULL AND PRCP <> 0 AND PRCP > 5 THEN 'Rain' WHEN TMAX > 32 THEN 'Hot' WHEN TMAX < 0 THEN 'Freezing'
   ELSE 'Clear' END AS text_description
 FROM wide_dv WHERE TMAX IS NOT NULL AND TMIN IS NOT NULL)"""
ORACLE["a12_pivot_daily_values"] = final(with_(F_DAILY_VALUES) + "SELECT * FROM wide_dv", "TMAX", "TMIN", "PRCP", "AWND", "WSF5")
ORACLE["j4_source_fallback"] = final(
    with_(F_READINGS, F_DAILY_VALUES) + """SELECT * FROM obs_weather UNION ALL
SELECT c.* FROM cdo_weather c ANTI JOIN obs_weather o ON c.station_id = o.station_id AND c.obs_date = o.obs_date""",
    *_WX,
)

_F1 = """vc AS (
 SELECT 'requests_311' AS table_name, CAST(requested_datetime AS DATE) AS obs_date, count(*) AS rows_in,
  count(*) FILTER (WHERE service_request_id IS NULL OR status IS NULL OR requested_datetime IS NULL) AS rows_dropped
 FROM requests GROUP BY 1, 2
 UNION ALL SELECT 'weather_daily', obs_date, count(*), count(*) FILTER (WHERE station_id IS NULL OR obs_date IS NULL OR tmax IS NULL)
 FROM weather GROUP BY 1, 2
 UNION ALL SELECT 'gdelt_daily', obs_date, count(*), count(*) FILTER (WHERE city IS NULL OR obs_date IS NULL OR avg_tone IS NULL)
 FROM gdelt GROUP BY 1, 2)"""
_VAL = (F_REQ_RAW, F_REQUESTS, F_WEATHER) + NEWS + (_F1,)
ORACLE["f1_validate_counts"] = with_(*_VAL) + "SELECT table_name, obs_date, rows_in, rows_dropped, rows_in - rows_dropped AS rows_kept FROM vc"
ORACLE["d9_quality_report"] = final(
    with_(
        *_VAL,
        """z AS (SELECT *, CASE WHEN s > 0 THEN (rows_in - m) / s END AS drift_z FROM (
  SELECT *, avg(rows_in) OVER w AS m, stddev_samp(rows_in) OVER w AS s FROM vc
  WINDOW w AS (PARTITION BY table_name ORDER BY obs_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))""",
    )
    + """SELECT table_name, CAST(sum(rows_in) AS BIGINT) AS row_count, CAST(sum(rows_dropped) AS BIGINT) AS rows_missing_required,
 count(*) AS days, max(obs_date) AS last_day, arg_max(rows_in, obs_date) AS last_day_count, arg_max(drift_z, obs_date) AS drift_z
FROM z GROUP BY table_name""",
    "drift_z",
)
