"""DuckDB oracle SQL for the documented-only operators (D-1..D-10)."""
from __future__ import annotations

from metroscope.plans.oracle import CITY, LAKE, ORACLE, _agg, final, with_, xmean
from metroscope.plans.oracle_daily import F_ALERTS, F_STATIONS, NEWS, SCORED

F_ARTICLES = """arts AS (
 SELECT ts AS article_ts, 'a' || CAST(event_id AS VARCHAR) AS SOURCEURL,
  CASE event_type WHEN 'error' THEN 'KILL;CRISISLEX_T03_DEAD' WHEN 'view' THEN 'POWER_OUTAGE;ECON' WHEN 'click' THEN 'TAX_X'
   WHEN 'signup' THEN 'CRISISLEX_C05_NEED_OF_SHELTERS' END AS V2Themes,
  CASE WHEN user_id % 4 = 0 THEN loc || ';Chicago' ELSE loc END AS V2Locations,
  CAST(k - 50 AS VARCHAR) || '.' || CAST(event_id % 10 AS VARCHAR) || ',1.5,2.5,' || CAST(user_id % 13 AS VARCHAR) || '.25,0,0' AS V15Tone,
  CASE event_type WHEN 'error' THEN 'PROTEST#' || CAST(k % 7 AS VARCHAR) || '#people#1#Boston;KILL#2#people#1#Boston'
   WHEN 'view' THEN 'PROTEST#3#crowd#1#Chicago;PROTEST#' || CAST(user_id % 5 AS VARCHAR) || '#crowd#1#Chicago'
   WHEN 'click' THEN 'ARREST#1#man#1#Boston' END AS V1Counts
 FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
  CASE user_id % 3 WHEN 0 THEN 'Boston' WHEN 1 THEN 'Chicago' ELSE 'New York' END AS loc FROM events))"""

F_STRESS = """stress AS (
 SELECT * FROM (SELECT *, array_to_string(list_filter(string_split(coalesce(V2Themes, ''), ';'),
   lambda t: t IN ('KILL', 'SHOOTING', 'ARREST', 'CRIME', 'FLOOD', 'DROUGHT', 'POWER_OUTAGE', 'WATER_SECURITY',
   'MANMADE_DISASTER', 'NATURAL_DISASTER') OR starts_with(t, 'CRISISLEX_')), ';') AS STRESS_THEMES FROM arts)
 WHERE STRESS_THEMES <> ''),
city_arts AS (
 SELECT DISTINCT article_ts, CITY, SOURCEURL, STRESS_THEMES FROM (
  SELECT article_ts, SOURCEURL, STRESS_THEMES,
   CASE lower(trim(unnest(string_split(coalesce(V2Locations, ''), ';')))) WHEN 'boston' THEN 'boston'
    WHEN 'chicago' THEN 'chicago' WHEN 'new york' THEN 'new york' END AS CITY
  FROM stress) WHERE CITY IS NOT NULL)"""

ORACLE["d1_theme_filter"] = with_(F_ARTICLES, F_STRESS) + "SELECT SOURCEURL, article_ts, V2Themes, STRESS_THEMES FROM stress"
ORACLE["d2_article_city"] = with_(F_ARTICLES, F_STRESS) + """SELECT strftime(article_ts, '%Y%m%d%H%M%S') AS DATE, CITY,
 SOURCEURL, STRESS_THEMES FROM city_arts"""
ORACLE["d3_articles_15min"] = with_(F_ARTICLES, F_STRESS) + """SELECT time_bucket(INTERVAL 15 MINUTE, article_ts) AS slice_start,
 CITY AS city, count(*) AS article_count FROM city_arts GROUP BY 1, 2"""
ORACLE["d4_tone_parse"] = final(
    with_(F_ARTICLES) + """SELECT SOURCEURL, TRY_CAST(string_split(coalesce(V15Tone, ''), ',')[1] AS DOUBLE) AS tone,
 TRY_CAST(string_split(coalesce(V15Tone, ''), ',')[4] AS DOUBLE) AS polarity,
 CAST(coalesce(list_sum(list_transform(list_filter(string_split(coalesce(V1Counts, ''), ';'),
   lambda e: string_split(e, '#')[1] = 'PROTEST'), lambda e: coalesce(TRY_CAST(string_split(e, '#')[2] AS BIGINT), 0))), 0) AS BIGINT)
  AS protest_count
FROM arts""",
    "tone", "polarity",
)

_HRS = "CASE WHEN status = 'closed' THEN (epoch_us(updated_datetime) - epoch_us(requested_datetime)) / 3.6e9 END"
ORACLE["d5_today_view"] = final(
    with_(
        *SCORED,
        f"""dayv AS (SELECT city, CAST(requested_datetime AS DATE) AS d, count(*) FILTER (WHERE status = 'open') AS open_backlog,
  {xmean(_HRS, 1)} AS mean_close_hrs FROM requests GROUP BY 1, 2)""",
        """modev AS (SELECT city, d, service_name AS top_category FROM (
  SELECT city, CAST(requested_datetime AS DATE) AS d, service_name, count(*) AS cnt FROM requests GROUP BY 1, 2, 3)
  QUALIFY row_number() OVER (PARTITION BY city, d ORDER BY cnt DESC, service_name) = 1)""",
        """wpick AS (SELECT c.city, w.obs_date AS d, w.tmax, w.precip_6hr_max AS prcp FROM weather w JOIN stations c USING (station_id)
  QUALIFY row_number() OVER (PARTITION BY c.city, w.obs_date ORDER BY w.station_id) = 1)""",
    )
    + """SELECT v.city, v.d, v.open_backlog, v.mean_close_hrs, m.top_category, w.tmax, w.prcp, g.avg_tone,
 g.protest_event_count AS protest_count
FROM dayv v JOIN modev m USING (city, d) JOIN wpick w USING (city, d) JOIN gdelt g ON g.city = v.city AND g.obs_date = v.d""",
    "mean_close_hrs", "tmax", "prcp", "avg_tone",
)

F_ZONES = """zones(zone_id, xs, ys) AS (VALUES
 ('Z1', [-71.495, -71.255, -71.255, -71.495]::DOUBLE[], [42.255, 42.255, 42.495, 42.495]::DOUBLE[]),
 ('Z2', [-71.245, -71.005, -71.245]::DOUBLE[], [42.255, 42.255, 42.495]::DOUBLE[]),
 ('Z3', [-71.495, -71.255, -71.205, -71.255, -71.495]::DOUBLE[], [42.005, 42.005, 42.125, 42.245, 42.245]::DOUBLE[]),
 ('Z4', [-71.195, -71.005, -71.005, -71.195]::DOUBLE[], [42.005, 42.005, 42.245, 42.205]::DOUBLE[])),
edges AS (SELECT zone_id, xs[i] AS xi, ys[i] AS yi, xs[CASE WHEN i = 1 THEN len(xs) ELSE i - 1 END] AS xj,
  ys[CASE WHEN i = 1 THEN len(ys) ELSE i - 1 END] AS yj
 FROM (SELECT zone_id, xs, ys, unnest(range(1, len(xs) + 1)) AS i FROM zones))"""
ORACLE["d6_zone_join"] = final(
    with_(
        F_ZONES,
        """pts AS (SELECT CAST(event_id AS VARCHAR) AS service_request_id, 42.0::DOUBLE + (user_id % 50) / 100.0::DOUBLE AS lat,
  -71.0::DOUBLE - (event_id % 50) / 100.0::DOUBLE AS lon FROM events)""",
        """inside AS (SELECT service_request_id, min(zone_id) AS zone_id FROM (
  SELECT p.service_request_id, e.zone_id FROM pts p CROSS JOIN edges e GROUP BY 1, 2
  HAVING sum(CASE WHEN (e.yi > p.lat) <> (e.yj > p.lat) AND p.lon < (e.xj - e.xi) * (p.lat - e.yi) / (e.yj - e.yi) + e.xi
   THEN 1 ELSE 0 END) % 2 = 1) GROUP BY 1)""",
    )
    + "SELECT p.service_request_id, p.lat, p.lon, i.zone_id FROM pts p LEFT JOIN inside i USING (service_request_id)",
    "lat", "lon",
)


def _ring(table: str, key: str, prefix: str, n: int, cx: str, cy: str, radius: str, wobble: float, part: int) -> str:
    """SELECT of one ring's vertices (``k``: the table's key as a double)."""
    turn = f"(i * {2 * 3.141592653589793 / n!r}::DOUBLE)"
    far = f"(({radius}) * (1.0::DOUBLE + {wobble!r}::DOUBLE * sin({turn} * 5)))"
    return (f"SELECT '{prefix}' || CAST(CAST(k AS INTEGER) AS VARCHAR) AS zone_id, {part} AS part, i, {n} AS n, {cx} + {far} * cos({turn}) AS x, "
            f"{cy} + {far} * sin({turn}) AS y FROM (SELECT CAST({key} AS DOUBLE) AS k FROM {table}), range({n}) r(i)")


_CX, _CY, _FAR = "(-71.48::DOUBLE + (k * 7 % 25) * 0.0197::DOUBLE)", "(42.02::DOUBLE + (k * 11 % 25) * 0.0189::DOUBLE)", "(0.013::DOUBLE + (k % 7) * 0.0131::DOUBLE)"
_RINGS = " UNION ALL ".join([
    _ring("region", "r_regionkey", "R", 400, "(-74.03::DOUBLE + k)", "(40.01::DOUBLE + k * 0.5::DOUBLE)", "3.7::DOUBLE", 0.1, 0),
    _ring("nation", "n_nationkey", "D", 90, _CX, _CY, _FAR, 0.3, 0),
    _ring("nation", "n_nationkey", "D", 24, _CX, _CY, f"{_FAR} * 0.4::DOUBLE", 0.0, 1),
    _ring("supplier", "s_suppkey", "B", 6, "(-71.4933::DOUBLE + (k * 37 % 499) * 0.00099::DOUBLE)", "(42.0023::DOUBLE + (k * 91 % 499) * 0.00097::DOUBLE)",
          "0.0061::DOUBLE", 0.0, 0)])
ORACLE["d6_nested_zones"] = final(
    f"""WITH v AS ({_RINGS}),
edges AS (SELECT a.zone_id, a.x AS xi, a.y AS yi, b.x AS xj, b.y AS yj FROM v a JOIN v b ON a.zone_id = b.zone_id AND a.part = b.part AND b.i = (a.i + a.n - 1) % a.n),
pts AS (SELECT CAST(event_id AS VARCHAR) AS service_request_id, 42.0::DOUBLE + (user_id % 50) / 100.0::DOUBLE AS lat,
  -71.0::DOUBLE - (event_id % 50) / 100.0::DOUBLE AS lon FROM events),
places AS (SELECT DISTINCT lat, lon FROM pts),
inside AS (SELECT lat, lon, min(zone_id) AS zone_id FROM (
  SELECT p.lat, p.lon, e.zone_id FROM places p CROSS JOIN edges e GROUP BY 1, 2, 3
  HAVING sum(CASE WHEN (e.yi > p.lat) <> (e.yj > p.lat) AND p.lon < (e.xj - e.xi) * (p.lat - e.yi) / (e.yj - e.yi) + e.xi THEN 1 ELSE 0 END) % 2 = 1)
  GROUP BY 1, 2)
SELECT p.service_request_id, p.lat, p.lon, i.zone_id FROM pts p LEFT JOIN inside i USING (lat, lon)""", "lat", "lon")


def _z(v: str) -> str:
    w = "(PARTITION BY city ORDER BY dn RANGE BETWEEN 30 PRECEDING AND 1 PRECEDING)"
    return (f"CASE WHEN {v} IS NOT NULL AND count({v}) OVER {w} >= 7 AND stddev_samp({v}) OVER {w} > 0 THEN "
            f"round_even(least(100.0::DOUBLE, greatest(0.0::DOUBLE, ({v} - avg({v}) OVER {w}) / stddev_samp({v}) OVER {w} * 15 + 50)), 2)"
            f" ELSE 50.0::DOUBLE END")


_FIVE = ("tone_spike", "theme_surge", "complaint_spike", "emergency_ratio_score", "alert_severity")
ORACLE["d7_five_signals"] = final(
    with_(
        *SCORED, F_ARTICLES, F_STRESS, *LAKE[:0],
        *[c for c in LAKE],
        f"lake_daily AS ({_agg('day_window')})",
        f"""tone AS (SELECT city, d, {_z('v')} AS tone_spike FROM (
  SELECT city, obs_date AS d, -avg_tone AS v, date_diff('day', DATE '1970-01-01', obs_date) AS dn FROM gdelt))""",
        f"""arts_n AS (SELECT city, d, {_z('v')} AS theme_surge FROM (
  SELECT lower(CITY) AS city, CAST(article_ts AS DATE) AS d, CAST(count(*) AS DOUBLE) AS v,
   date_diff('day', DATE '1970-01-01', CAST(article_ts AS DATE)) AS dn FROM city_arts GROUP BY 1, 2, 4))""",
        f"""lake_s AS (SELECT city, d, {_z('infra')} AS complaint_spike, {_z('er')} AS emergency_ratio_score FROM (
  SELECT city, window_start AS d, CAST(sum(infrastructure_requests) AS DOUBLE) AS infra,
   sum(emergency_requests) / sum(total_requests) AS er, date_diff('day', DATE '1970-01-01', window_start) AS dn
  FROM lake_daily GROUP BY city, window_start))""",
        """keys AS (SELECT city, d FROM tone UNION SELECT city, d FROM arts_n UNION SELECT city, d FROM lake_s
  UNION SELECT city, d FROM alert)""",
        """five AS (SELECT k.city, k.d, coalesce(t.tone_spike, 50.0::DOUBLE) AS tone_spike, coalesce(a.theme_surge, 50.0::DOUBLE) AS theme_surge,
  coalesce(l.complaint_spike, 50.0::DOUBLE) AS complaint_spike, coalesce(l.emergency_ratio_score, 50.0::DOUBLE) AS emergency_ratio_score,
  coalesce(al.alert_score, 0.0::DOUBLE) AS alert_severity
  FROM keys k LEFT JOIN tone t USING (city, d) LEFT JOIN arts_n a USING (city, d) LEFT JOIN lake_s l USING (city, d)
  LEFT JOIN alert al USING (city, d))""",
    )
    + """SELECT *, round_even((tone_spike + theme_surge + complaint_spike + emergency_ratio_score + alert_severity) / 5, 2) AS stress_score
FROM five""",
    *_FIVE, "stress_score",
)

_SC = ("anomaly_score", "heat_score", "alert_score", "context_score", "composite", "composite_baseline_30d")
ORACLE["d8_score_window"] = final(
    with_(*SCORED) + """SELECT city, score_date, anomaly_score, heat_score, alert_score, context_score, composite,
 composite_baseline_30d, readiness_mode FROM scored
WHERE city = 'boston' AND score_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'""",
    *_SC,
)

ORACLE["d10_legacy_profile"] = final(
    with_(
        *SCORED,
        "cw AS (SELECT c.city, w.obs_date AS d, max(w.tmax) AS tmax FROM weather w JOIN stations c USING (station_id) GROUP BY 1, 2)",
        """leg AS (SELECT s.city, s.d, s.anomaly_score,
  coalesce(CASE WHEN cw.tmax IS NOT NULL THEN least(100.0::DOUBLE, greatest(0.0::DOUBLE, (cw.tmax - 5) / 35 * 100)) END, 50.0::DOUBLE) AS heat,
  coalesce(CASE WHEN g.avg_tone IS NOT NULL THEN least(100.0::DOUBLE, greatest(0.0::DOUBLE, abs(g.avg_tone) / 8 * 100)) END, 50.0::DOUBLE) AS ctx
  FROM sig s LEFT JOIN cw USING (city, d) LEFT JOIN gdelt g ON g.city = s.city AND g.obs_date = s.d)""",
    )
    + """SELECT city, d AS score_date, anomaly_score, round_even(heat, 2) AS heat_score, round_even(ctx, 2) AS context_score,
 round_even(anomaly_score * 0.40::DOUBLE + heat * 0.35::DOUBLE + ctx * 0.25::DOUBLE, 2) AS composite FROM leg""",
    "anomaly_score", "heat_score", "context_score", "composite",
)
