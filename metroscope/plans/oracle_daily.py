"""DuckDB oracle SQL for the daily path (fixtures restated, then each operator)."""
from __future__ import annotations

from metroscope.plans.oracle import CITY, ORACLE, final, pyround, with_, xmean

F_REQ_RAW = f"""req_raw AS (
 SELECT CAST(o_orderkey AS VARCHAR) AS service_request_id, {CITY.format(k='o_custkey')} AS city,
  CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'O' THEN 'open' ELSE 'in progress' END AS status,
  o_orderpriority AS service_name, o_orderdate AS requested_datetime,
  o_orderdate + to_hours(CAST(o_custkey % 200 AS BIGINT)) AS updated_datetime
 FROM orders)"""

F_REQUESTS = """requests AS (
 SELECT *, CASE WHEN status = 'closed'
   THEN round_even((epoch_us(updated_datetime) - epoch_us(requested_datetime)) / 1e6 / 3600, 2) END AS resolution_hrs
 FROM (SELECT * FROM req_raw QUALIFY row_number() OVER (PARTITION BY service_request_id
   ORDER BY updated_datetime DESC NULLS LAST, city DESC, status DESC, service_name DESC, requested_datetime DESC) = 1))"""

F_WEATHER = """weather AS (
 SELECT 'STN' || CAST(o_custkey % 2 AS VARCHAR) AS station_id, CAST(o_orderdate AS DATE) AS obs_date,
  round_even(max(o_totalprice) / 12500, 2) AS tmax, round_even(min(o_totalprice) / 12500, 2) AS tmin,
  round_even(max(CASE WHEN o_orderstatus = 'F' THEN o_totalprice / 10000 END), 2) AS heat_index_max,
  round_even(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice / 100000 END), 2) AS precip_6hr_max
 FROM orders GROUP BY 1, 2)"""

F_STATIONS = """stations(station_id, city) AS (VALUES ('STN0', 'boston'), ('STN1', 'boston'), ('STN1', 'chicago'), ('STN0', 'new york'))"""
F_CITIES = """cities(city) AS (VALUES ('boston'), ('chicago'), ('new york'))"""

F_ALERTS = f"""alerts AS (
 SELECT CAST(o_orderkey AS VARCHAR) AS alert_id, {CITY.format(k='o_custkey')} AS city, CAST(o_orderdate AS DATE) AS obs_date,
  o_orderpriority AS event_type,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Extreme' WHEN '2' THEN 'Severe' WHEN '3' THEN 'Moderate'
   WHEN '4' THEN 'Minor' WHEN '5' THEN 'Unknown' END AS severity,
  CASE o_orderstatus WHEN 'F' THEN 'Immediate' WHEN 'O' THEN 'Expected' WHEN 'P' THEN 'Past' END AS urgency,
  CASE o_custkey % 4 WHEN 0 THEN 'Observed' WHEN 1 THEN 'Likely' WHEN 2 THEN 'Possible' WHEN 3 THEN 'Unlikely' END AS certainty,
  'Monitor' AS response_type, 'Met' AS category, o_orderdate AS onset, o_orderdate + INTERVAL 1 DAY AS expires,
  'alert ' || CAST(o_orderkey AS VARCHAR) AS headline, CAST(NULL AS VARCHAR) AS description,
  CAST(NULL AS VARCHAR) AS instruction, CAST(NULL AS VARCHAR) AS area_desc
 FROM orders)"""

_GEO = ("CASE {k} WHEN 0 THEN 'Boston, Massachusetts, United States' WHEN 1 THEN 'Chicago, Illinois, United States' "
        "ELSE 'New York, New York, United States' END")
F_NEWS = f"""news AS (
 SELECT CAST(l_shipdate AS DATE) AS obs_date,
  CASE WHEN l_linenumber = 4 THEN '14' ELSE lpad(CAST(l_linenumber AS VARCHAR), 2, '0') END AS root,
  (l_tax - l_discount) * 100 AS tone, l_quantity / 5 - 5 AS goldstein,
  CAST(CAST(l_quantity AS BIGINT) AS DOUBLE) AS mentions, CAST(l_linenumber AS DOUBLE) AS sources,
  CAST(CAST(l_quantity AS BIGINT) + l_linenumber AS DOUBLE) AS articles,
  CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE {_GEO.format(k='l_suppkey % 2')} END AS actor1_geo,
  CAST(NULL AS VARCHAR) AS actor2_geo, {_GEO.format(k='l_suppkey % 3')} AS action_geo,
  'u' || CAST(l_orderkey AS VARCHAR) AS url
 FROM lineitem)"""

F_NEWS_M = """news_m AS (
 SELECT n.*, c.city FROM news n JOIN cities c
  ON coalesce(contains(lower(n.action_geo), c.city), false) OR coalesce(contains(lower(n.actor1_geo), c.city), false)
   OR coalesce(contains(lower(n.actor2_geo), c.city), false))"""

F_GDELT = f"""news_agg AS (
 SELECT city, obs_date, {xmean('tone', 3)} AS avg_tone, count(*) FILTER (WHERE root = '14') AS pc,
  coalesce(sum(CASE WHEN root = '14' THEN mentions END), 0) AS pm, {xmean('goldstein', 3)} AS goldstein_avg,
  coalesce(sum(articles), 0) AS na, coalesce(sum(sources), 0) AS ns
 FROM news_m GROUP BY city, obs_date),
news_spine AS (SELECT c.city, d.obs_date FROM (SELECT DISTINCT obs_date FROM news WHERE obs_date IS NOT NULL) d CROSS JOIN cities c),
gd AS (
 SELECT s.city, s.obs_date, a.avg_tone, CAST(coalesce(a.pc, 0) AS INTEGER) AS protest_event_count,
  CAST(coalesce(a.pm, 0) AS INTEGER) AS protest_mention_sum, a.goldstein_avg,
  CAST(coalesce(a.na, 0) AS INTEGER) AS num_articles, CAST(coalesce(a.ns, 0) AS INTEGER) AS source_count
 FROM news_spine s LEFT JOIN news_agg a USING (city, obs_date)),
gdelt AS (
 SELECT *, {xmean('avg_tone', 3, over='(PARTITION BY city ORDER BY obs_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', py=False)} AS avg_tone_7d,
  CAST(NULL AS DOUBLE) AS polarity
 FROM gd)"""

NEWS = (F_CITIES, F_NEWS, F_NEWS_M, F_GDELT)

F_SCORES = f"""counts AS (SELECT city, CAST(requested_datetime AS DATE) AS d, count(*) AS cnt FROM requests GROUP BY 1, 2),
anomaly AS (
 SELECT city, d, CASE WHEN b IS NULL OR b = 0 THEN 50.0::DOUBLE
  ELSE {pyround('least(100.0::DOUBLE, greatest(0.0::DOUBLE, (cnt - b) / b * 80 + 50))', 2)} END AS anomaly_score
 FROM (SELECT *, avg(cnt) OVER (PARTITION BY city ORDER BY d ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS b FROM counts)),
hs AS (
 SELECT station_id, obs_date, coalesce(heat_index_max, tmax) AS v, heat_index_max IS NOT NULL AS use_hi,
  avg(heat_index_max) OVER w AS mh, stddev_samp(heat_index_max) OVER w AS sh,
  avg(tmax) OVER w AS mt, stddev_samp(tmax) OVER w AS st
 FROM weather WINDOW w AS (PARTITION BY station_id ORDER BY obs_date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)),
heat_station AS (
 SELECT station_id, obs_date,
  CASE WHEN v IS NULL OR m IS NULL OR s IS NULL OR s = 0 THEN 50.0::DOUBLE
   ELSE {pyround('least(100.0::DOUBLE, greatest(0.0::DOUBLE, (v - m) / s * 15 + 50))', 2)} END AS heat_score
 FROM (SELECT station_id, obs_date, v, CASE WHEN use_hi THEN mh ELSE mt END AS m, CASE WHEN use_hi THEN sh ELSE st END AS s FROM hs)),
heat AS (SELECT c.city, h.obs_date AS d, max(h.heat_score) AS heat_score FROM heat_station h JOIN stations c USING (station_id) GROUP BY 1, 2),
alert AS (
 SELECT city, obs_date AS d, {pyround('max(sev * urg * cer / 36 * 100)', 2)} AS alert_score FROM (
  SELECT city, obs_date,
   CASE severity WHEN 'Extreme' THEN 4 WHEN 'Severe' THEN 3 WHEN 'Moderate' THEN 2 WHEN 'Minor' THEN 1 ELSE 0 END AS sev,
   CASE urgency WHEN 'Immediate' THEN 3 WHEN 'Expected' THEN 2 WHEN 'Future' THEN 1 ELSE 0 END AS urg,
   CASE certainty WHEN 'Observed' THEN 3 WHEN 'Likely' THEN 2 WHEN 'Possible' THEN 1 ELSE 0 END AS cer
  FROM alerts) GROUP BY 1, 2),
context AS (
 SELECT city, obs_date AS d, CASE WHEN avg_tone_7d IS NULL THEN 50.0::DOUBLE
  ELSE {pyround('least(100.0::DOUBLE, abs(avg_tone_7d) / 8 * 100) * 0.7::DOUBLE + (CASE WHEN protest_event_count IS NOT NULL THEN least(100.0::DOUBLE, protest_event_count / 20 * 100) ELSE 0.0::DOUBLE END) * 0.3::DOUBLE', 2)} END AS context_score
 FROM gdelt),
alldays AS (SELECT city, d FROM counts UNION ALL SELECT city, d FROM heat UNION ALL SELECT city, d FROM alert
 UNION ALL SELECT city, d FROM context),
spine AS (SELECT city, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
 FROM (SELECT city, min(d) AS lo, max(d) AS hi FROM alldays GROUP BY city)),
sig AS (
 SELECT s.city, s.d, coalesce(a.anomaly_score, 50.0::DOUBLE) AS anomaly_score, coalesce(h.heat_score, 50.0::DOUBLE) AS heat_score,
  coalesce(al.alert_score, 0.0::DOUBLE) AS alert_score, coalesce(c.context_score, 50.0::DOUBLE) AS context_score
 FROM spine s LEFT JOIN anomaly a USING (city, d) LEFT JOIN heat h USING (city, d) LEFT JOIN alert al USING (city, d)
  LEFT JOIN context c USING (city, d)),
comp AS (SELECT *, {pyround('anomaly_score * 0.35::DOUBLE + heat_score * 0.30::DOUBLE + alert_score * 0.20::DOUBLE + context_score * 0.15::DOUBLE', 2)} AS composite FROM sig),
scores AS (
 SELECT city, d AS score_date, anomaly_score, heat_score, alert_score, context_score, composite,
  coalesce({xmean('composite', 2, over='(PARTITION BY city ORDER BY d ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)')}, composite)
   AS composite_baseline_30d
 FROM comp),
scored AS (
 SELECT *, CASE WHEN composite - composite_baseline_30d < 10 THEN 'Normal'
  WHEN composite - composite_baseline_30d < 25 THEN 'Elevated' ELSE 'High' END AS readiness_mode FROM scores)"""

DAILY = (F_REQ_RAW, F_REQUESTS, F_WEATHER, F_STATIONS, F_ALERTS) + NEWS
SCORED = DAILY + (F_SCORES,)

ORACLE["w13_dedup_latest"] = with_(
    F_REQ_RAW,
    """allrows AS (SELECT * FROM req_raw UNION ALL
  SELECT service_request_id, city, 'closed' AS status, service_name, requested_datetime, updated_datetime + INTERVAL 30 DAY
  FROM req_raw WHERE CAST(service_request_id AS BIGINT) % 3 = 0)""",
) + """SELECT * FROM allrows QUALIFY row_number() OVER (PARTITION BY service_request_id
 ORDER BY updated_datetime DESC NULLS LAST, city DESC, status DESC, service_name DESC, requested_datetime DESC) = 1"""

ORACLE["m4_resolution_hours"] = with_(F_REQ_RAW, F_REQUESTS) + "SELECT service_request_id, status, resolution_hrs FROM requests"

ORACLE["f2_city_filter"] = with_(F_CITIES, F_NEWS, F_NEWS_M) + """SELECT city, obs_date, url AS SOURCEURL,
 root AS EventRootCode, round_even(tone, 6) AS AvgTone, root = '14' AS is_protest FROM news_m"""

ORACLE["a6_news_daily"] = with_(*NEWS) + """SELECT city, obs_date, avg_tone, protest_event_count, protest_mention_sum,
 goldstein_avg, num_articles, source_count FROM gdelt"""

ORACLE["w6_tone_7d"] = with_(*NEWS) + "SELECT city, obs_date, avg_tone, avg_tone_7d FROM gdelt"

ORACLE["a7_news_daily_distinct"] = with_(
    F_NEWS,
    """strict(city, pat) AS (VALUES ('boston', 'Boston, Massachusetts'), ('chicago', 'Chicago, Illinois'),
  ('new york', 'New York, New York'))""",
) + """SELECT s.city, n.obs_date, round_even(avg(n.tone), 6) AS avg_tone, count(*) FILTER (WHERE n.root = '14') AS protest_event_count,
 CAST(coalesce(sum(CASE WHEN n.root = '14' THEN n.mentions END), 0) AS BIGINT) AS protest_mention_sum,
 round_even(avg(n.goldstein), 6) AS goldstein_avg, CAST(coalesce(sum(n.articles), 0) AS BIGINT) AS num_articles,
 count(DISTINCT n.url) AS source_count
FROM news n JOIN strict s ON coalesce(contains(n.action_geo, s.pat), false) GROUP BY s.city, n.obs_date"""

ORACLE["w7_anomaly_score"] = with_(*SCORED) + "SELECT a.city, a.d, a.anomaly_score, c.cnt FROM anomaly a JOIN counts c USING (city, d)"
ORACLE["w8_heat_score"] = with_(*SCORED) + "SELECT station_id, obs_date, heat_score FROM heat_station"
ORACLE["a13_alert_score"] = with_(*SCORED) + "SELECT city, d, alert_score FROM alert"
ORACLE["e7_signal_scores"] = with_(*SCORED) + """SELECT city, score_date, anomaly_score, heat_score, alert_score,
 context_score, composite, composite_baseline_30d, readiness_mode FROM scored"""
ORACLE["w9_composite_baseline"] = with_(*SCORED) + "SELECT city, score_date, composite, composite_baseline_30d FROM scored"
ORACLE["x7_readiness"] = with_(*SCORED) + "SELECT city, readiness_mode, count(*) AS days FROM scored GROUP BY 1, 2"

F_DRIVER = """drv AS (
 SELECT *, CASE
  WHEN round_even(abs(anomaly_score - 50), 2) >= round_even(abs(heat_score - 50), 2) AND round_even(abs(anomaly_score - 50), 2) >= round_even(abs(alert_score), 2)
   AND round_even(abs(anomaly_score - 50), 2) >= round_even(abs(context_score - 50), 2) THEN 'anomaly_score'
  WHEN round_even(abs(heat_score - 50), 2) >= round_even(abs(alert_score), 2) AND round_even(abs(heat_score - 50), 2) >= round_even(abs(context_score - 50), 2)
   THEN 'heat_score'
  WHEN round_even(abs(alert_score), 2) >= round_even(abs(context_score - 50), 2) THEN 'alert_score'
  ELSE 'context_score' END AS primary_driver
 FROM scored)"""

ORACLE["x10_primary_driver"] = with_(*SCORED, F_DRIVER) + "SELECT city, score_date, primary_driver FROM drv"


def _f1(x: str, signed: bool = False) -> str:
    return f"printf('{'%+.1f' if signed else '%.1f'}', round_even(CAST({x} AS DECIMAL(18,2)), 1))"


_OVERALL = {
    "High": "Urban stress conditions are significantly elevated — composite index is {c} ({d} pts above the 30-day baseline of {b}).",
    "Elevated": "Urban stress conditions are moderately above baseline — composite index is {c} ({d} pts above the 30-day baseline of {b}).",
    "Normal": "Urban stress conditions are within normal range — composite index is {c} ({d} pts relative to the 30-day baseline of {b}).",
}


def _overall_sql(t: str) -> str:
    head, rest = t.split("{c}")
    mid, rest = rest.split("{d}")
    mid2, tail = rest.split("{b}")
    return (f"'{head}' || {_f1('composite')} || '{mid}' || {_f1('composite - composite_baseline_30d', True)}"
            f" || '{mid2}' || {_f1('composite_baseline_30d')} || '{tail}'")


F_VERDICT = f"""vt AS (
 SELECT city, score_date AS verdict_date, composite AS composite_score, readiness_mode, 'rule-based-v1' AS model_id,
  concat_ws(' ',
   CASE readiness_mode WHEN 'High' THEN {_overall_sql(_OVERALL['High'])}
    WHEN 'Elevated' THEN {_overall_sql(_OVERALL['Elevated'])} ELSE {_overall_sql(_OVERALL['Normal'])} END,
   'Primary driver: ' || CASE primary_driver WHEN 'anomaly_score' THEN '311 service demand' WHEN 'heat_score' THEN 'heat index'
     WHEN 'alert_score' THEN 'NWS weather alerts' ELSE 'media and social context' END
    || ' (' || replace(primary_driver, '_', ' ') || ': '
    || {_f1("CASE primary_driver WHEN 'anomaly_score' THEN anomaly_score WHEN 'heat_score' THEN heat_score WHEN 'alert_score' THEN alert_score ELSE context_score END")}
    || '/100).',
   CASE WHEN anomaly_score >= 80 THEN '311 service demand is significantly above the 30-day baseline — unusually high citizen-reported activity.'
    WHEN anomaly_score >= 60 THEN '311 service demand is moderately above baseline — request volume trending upward.'
    WHEN anomaly_score <= 30 THEN '311 service demand is below baseline — quieter than usual for this period.'
    ELSE '311 service demand is within normal range.' END,
   CASE WHEN heat_score >= 80 THEN 'Heat index is significantly above seasonal average — population heat stress risk is elevated.'
    WHEN heat_score >= 60 THEN 'Heat index is above seasonal average — warmer than typical for this period.'
    WHEN heat_score <= 30 THEN 'Heat index is below seasonal average — cooler than typical, no heat stress risk.'
    ELSE 'Heat index is within normal seasonal range.' END,
   CASE WHEN alert_score >= 75 THEN 'Active NWS extreme or severe weather alert in effect — declared emergency conditions.'
    WHEN alert_score >= 40 THEN 'Active NWS moderate weather alert in effect — conditions exceed normal thresholds.'
    WHEN alert_score > 0 THEN 'Minor NWS advisory in effect — monitor conditions.'
    ELSE 'No active NWS weather alerts for the '
     || CASE city WHEN 'boston' THEN 'Boston' WHEN 'chicago' THEN 'Chicago' WHEN 'new york' THEN 'New York' END || ' area.' END,
   CASE WHEN context_score >= 70 THEN 'Media tone is strongly negative with elevated protest activity — significant social tension reported.'
    WHEN context_score >= 50 THEN 'Media tone is moderately negative — above-average tension in news coverage.'
    WHEN context_score <= 20 THEN 'Media tone is neutral to positive — no unusual social tension in coverage.'
    ELSE 'Media tone and protest activity are within normal range.' END,
   'Operator judgment required before adjusting staffing or resource positioning.') AS verdict_text
 FROM drv)"""

ORACLE["x11_verdict"] = with_(*SCORED, F_DRIVER, F_VERDICT) + """SELECT city, verdict_date, verdict_text, composite_score,
 readiness_mode, model_id FROM vt"""

_SC = ["anomaly_score", "heat_score", "alert_score", "context_score", "composite", "composite_baseline_30d"]
for _name, _cols in {
    "m4_resolution_hours": ["resolution_hrs"],
    "f2_city_filter": ["AvgTone"],
    "a6_news_daily": ["avg_tone", "goldstein_avg"],
    "w6_tone_7d": ["avg_tone", "avg_tone_7d"],
    "a7_news_daily_distinct": ["avg_tone", "goldstein_avg"],
    "w7_anomaly_score": ["anomaly_score"],
    "w8_heat_score": ["heat_score"],
    "a13_alert_score": ["alert_score"],
    "e7_signal_scores": _SC,
    "w9_composite_baseline": ["composite", "composite_baseline_30d"],
    "x11_verdict": ["composite_score"],
}.items():
    ORACLE[_name] = final(ORACLE[_name], *_cols)
