"""DuckDB restatements of every catalog query (the correctness oracle).

Fixture CTEs restate ``metroscope.sources.fixtures`` in SQL. Doubles are rounded to
6 places and timestamps are plain TIMESTAMP, matching ``plans.common.finish``.
"""
from __future__ import annotations

import re

ORACLE: dict[str, str] = {}

CITY = "CASE {k} % 3 WHEN 0 THEN 'boston' WHEN 1 THEN 'chicago' ELSE 'new york' END"

F_MAPPING = """category_mapping(raw_category, normalized_category, is_infrastructure, is_emergency_type) AS (VALUES
 ('Broken Sidewalk','Sidewalk Infrastructure',1,0), ('Pothole','Road Infrastructure',1,0),
 ('Damaged Sign','Traffic Infrastructure',1,0), ('Requests for Street Cleaning','Sanitation',0,0),
 ('Residential Trash out Illegally','Sanitation Violation',0,0), ('Overflowing or Unkept Dumpster','Sanitation Violation',0,0),
 ('Rodent Activity','Public Health',0,1), ('Needle Cleanup','Public Health Hazard',0,1),
 ('Poor Conditions of Property','Property Violation',0,0), ('Unsatisfactory Living Conditions','Housing Violation',0,1),
 ('Illegal Parking','Traffic Violation',0,0), ('Abandoned Vehicle','Traffic Violation',0,0),
 ('Abandoned Bicycle','Public Space Issue',0,0), ('Other','General Request',0,0))"""

F_BRONZE = f"""bronze_requests AS (
 SELECT 'open311' AS source, {CITY.format(k='user_id')} AS city,
  strftime(date_trunc('day', ts) + INTERVAL 1 DAY, '%Y%m%d') || '-' || replace({CITY.format(k='user_id')}, ' ', '_') AS batch_id,
  CAST(date_trunc('day', ts) + INTERVAL 1 DAY AS TIMESTAMP) AS ingested_at_utc,
  CAST(event_id AS VARCHAR) AS service_request_id,
  CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 'Open' WHEN event_id % 3 = 1 THEN 'closed' ELSE 'in progress' END AS status,
  CASE event_type WHEN 'click' THEN 'Pothole' WHEN 'view' THEN 'Illegal Parking' WHEN 'error' THEN 'Rodent Activity'
   WHEN 'signup' THEN 'Needle Cleanup' WHEN 'purchase' THEN 'Street Light Outage' END AS service_name,
  CASE WHEN user_id % 10 = 0 THEN NULL WHEN user_id % 10 = 1 THEN 'dept' || CAST(user_id % 4 AS VARCHAR)
   ELSE 'dept' || CAST(user_id % 4 AS VARCHAR) || ':' || event_type END AS service_code,
  CAST(NULL AS VARCHAR) AS description,
  ts AS requested_datetime, ts + to_hours(user_id) AS updated_datetime,
  CASE WHEN event_id % 3 = 1 THEN ts + to_hours(user_id) END AS closed_datetime,
  42.0::DOUBLE + (user_id % 50) / 100.0::DOUBLE AS lat, -71.0::DOUBLE - (event_id % 50) / 100.0::DOUBLE AS lon
 FROM events)"""

F_SILVER = """silver AS (
 SELECT b.*, b.requested_datetime AS requested_at_utc, b.updated_datetime AS updated_at_utc,
  b.closed_datetime AS closed_at_utc, m.raw_category,
  coalesce(m.normalized_category, 'Other') AS normalized_category,
  coalesce(m.is_infrastructure, 0) AS is_infrastructure, coalesce(m.is_emergency_type, 0) AS is_emergency_type
 FROM bronze_requests b LEFT JOIN category_mapping m ON b.service_name = m.raw_category)"""

# Every third request is delivered again two days later, updated and closed; the latest counts.
F_DELIVERIES = """deliveries AS (SELECT * FROM silver UNION ALL
 SELECT * REPLACE (ingested_at_utc + INTERVAL 2 DAY AS ingested_at_utc, 'closed' AS status,
   updated_at_utc + INTERVAL 2 DAY AS updated_at_utc, updated_datetime + INTERVAL 2 DAY AS updated_datetime,
   strftime(ingested_at_utc + INTERVAL 2 DAY, '%Y%m%d') || substr(batch_id, 9) AS batch_id)
 FROM silver WHERE CAST(service_request_id AS BIGINT) % 3 = 0)"""
F_LATEST = """latest AS (SELECT * FROM deliveries
 QUALIFY row_number() OVER (PARTITION BY city, service_request_id ORDER BY updated_at_utc DESC, ingested_at_utc DESC) = 1)"""

F_BASE = """base AS (
 SELECT city, service_request_id, requested_at_utc AS requested_ts, ingested_at_utc AS ingested_ts,
  CASE WHEN lower(coalesce(status, '')) = 'open' THEN 1 ELSE 0 END AS is_open,
  CASE WHEN lower(coalesce(status, '')) = 'closed' THEN 1 ELSE 0 END AS is_closed,
  coalesce(is_infrastructure, 0) AS is_infrastructure_int, coalesce(is_emergency_type, 0) AS is_emergency_type_int,
  coalesce(normalized_category, 'Other') AS category,
  date_trunc('hour', requested_at_utc) AS hour_window, CAST(requested_at_utc AS DATE) AS day_window,
  strftime(ingested_at_utc, '%Y') AS ingest_year, strftime(ingested_at_utc, '%m') AS ingest_month,
  strftime(ingested_at_utc, '%d') AS ingest_day
 FROM silver WHERE requested_at_utc IS NOT NULL AND ingested_at_utc IS NOT NULL)"""


def _agg(window_col: str) -> str:
    return f"""SELECT city, ingest_year, ingest_month, ingest_day, {window_col} AS window_start,
  count(service_request_id) AS total_requests, CAST(sum(is_open) AS BIGINT) AS open_requests,
  CAST(sum(is_closed) AS BIGINT) AS closed_requests, CAST(sum(is_infrastructure_int) AS BIGINT) AS infrastructure_requests,
  CAST(sum(is_emergency_type_int) AS BIGINT) AS emergency_requests,
  round_even(CASE WHEN count(service_request_id) > 0 THEN sum(is_emergency_type_int) / count(service_request_id) ELSE 0.0 END, 6) AS emergency_ratio,
  count(DISTINCT category) AS distinct_categories
 FROM base GROUP BY city, ingest_year, ingest_month, ingest_day, {window_col}"""


def pyround(expr: str, digits: int) -> str:
    """Python's ``round`` in SQL: the same two-product expression as ``columns.pyround``."""
    from metroscope.functions.columns import _split

    m = float(10 ** digits)
    mh, ml = _split(m)
    x = f"CAST(({expr}) AS DOUBLE)"
    p = f"({x} * {m!r})"
    xh = f"(({x} * 134217729.0) - (({x} * 134217729.0) - {x}))"
    xl = f"({x} - {xh})"
    err = f"(((({xh} * {mh!r}) - {p}) + ({xh} * {ml!r}) + ({xl} * {mh!r})) + ({xl} * {ml!r}))"
    fl = f"CAST(floor({p}) AS DOUBLE)"
    return (f"((CASE WHEN ({p} - {fl}) = 0.5 AND {err} > 0 THEN {fl} + 1 "
            f"WHEN ({p} - {fl}) = 0.5 AND {err} < 0 THEN {fl} ELSE round_even({p}, 0) END) / {m!r})")


def xmean(col: str, digits: int, over: str | None = None, py: bool = True) -> str:
    """``round(avg(col), digits)`` from exact integer units (mirrors ``columns.mean_rounded``)."""
    units = f"CAST(round_even(({col}) * 1e12, 0) AS HUGEINT)"
    w = f" OVER {over}" if over else ""
    s, n = f"sum({units}){w}", f"count({col}){w}"
    mean = f"CAST({s} AS DOUBLE) / (CAST({n} AS DOUBLE) * 1e12)"
    rounded = pyround(mean, digits) if py else f"round_even({mean}, {digits})"
    return f"(CASE WHEN {n} > 0 THEN {rounded} END)"


def final(sql: str, *doubles: str) -> str:
    """Result edge: doubles rounded to 6 places with the sign of zero dropped."""
    if not doubles:
        return sql
    rep = ", ".join(f"round_even({c}, 6) + 0.0::DOUBLE AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) AS q"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


LAKE = (F_MAPPING, F_BRONZE, F_SILVER, F_DELIVERIES, F_LATEST, F_BASE.replace("FROM silver", "FROM latest"))
LAKE_ONCE = (F_MAPPING, F_BRONZE, F_SILVER, F_BASE)
F_HOURLY = f"hourly AS ({_agg('hour_window')})"

ORACLE["j1_category_mapping"] = with_(F_MAPPING, F_BRONZE, F_SILVER) + """SELECT service_request_id, service_name,
 raw_category, normalized_category, is_infrastructure, is_emergency_type FROM silver"""
ORACLE["a1_hourly"] = final(with_(*LAKE) + _agg("hour_window"), "emergency_ratio")
ORACLE["a2_daily"] = final(with_(*LAKE) + _agg("day_window"), "emergency_ratio")
ORACLE["a3_category_hourly"] = with_(*LAKE) + """SELECT city, ingest_year, ingest_month, ingest_day,
 hour_window AS window_start, category AS normalized_category, count(service_request_id) AS request_count
 FROM base GROUP BY ALL"""

_M = ("total_requests", "infrastructure_requests", "emergency_ratio")
_stats = ",\n".join(
    f"avg({m}) OVER w AS {m}_mean, stddev_samp({m}) OVER w AS {m}_std, count({m}) OVER w AS {m}_history_points"
    for m in _M
)
_valid = ",\n".join(
    f"({m}_history_points >= 24 AND {m}_std IS NOT NULL AND {m}_std > 0) AS {m}_baseline_valid" for m in _M
)
_z = ",\n".join(
    f"round_even(CASE WHEN {m}_baseline_valid THEN ({m} - {m}_mean) / {m}_std END, 6) AS {m}_zscore" for m in _M
)
_W1_DOUBLES = [f"{m}{x}" for m in _M for x in ("", "_mean", "_std", "_zscore")]
ORACLE["w1_baseline_168h"] = with_(
    *LAKE, F_HOURLY,
    """resum AS (SELECT city, window_start, CAST(sum(total_requests) AS DOUBLE) AS total_requests,
  CAST(sum(infrastructure_requests) AS DOUBLE) AS infrastructure_requests,
  CAST(sum(emergency_requests) AS DOUBLE) AS e,
  max(ingest_year || '-' || ingest_month || '-' || ingest_day) AS ing
  FROM hourly GROUP BY city, window_start)""",
    """prep AS (SELECT city, window_start, total_requests, infrastructure_requests,
  CASE WHEN total_requests > 0 THEN e / total_requests ELSE 0.0 END AS emergency_ratio,
  split_part(ing, '-', 1) AS ingest_year, split_part(ing, '-', 2) AS ingest_month, split_part(ing, '-', 3) AS ingest_day,
  CAST(epoch(window_start) AS BIGINT) AS ep FROM resum)""",
    f"""st AS (SELECT *, {_stats} FROM prep
  WINDOW w AS (PARTITION BY city ORDER BY ep RANGE BETWEEN 604800 PRECEDING AND 1 PRECEDING))""",
    f"""va AS (SELECT *, {_valid} FROM st)""",
) + f"""SELECT 'open311' AS source, city, ingest_year, ingest_month, ingest_day, window_start,
 {", ".join(f"round_even({m}, 6) AS {m}, round_even({m}_mean, 6) AS {m}_mean, round_even({m}_std, 6) AS {m}_std, {m}_history_points, {m}_baseline_valid" for m in _M)},
 {_z},
 least({", ".join(f"{m}_history_points" for m in _M)}) AS baseline_history_points,
 least({", ".join(f"{m}_history_points" for m in _M)}) >= 24 AS baseline_is_valid,
 168 AS baseline_window_hours, 24 AS baseline_min_history_points,
 'trailing_time_window' AS baseline_method, 'v1' AS baseline_version
FROM va"""
ORACLE["w1_baseline_168h"] = final(ORACLE["w1_baseline_168h"], *_W1_DOUBLES)

ORACLE["a15_duplicate_keys"] = with_(*LAKE, F_HOURLY) + """SELECT city, window_start, count(*) AS n_rows
 FROM hourly GROUP BY city, window_start HAVING count(*) > 1"""


from metroscope.plans import oracle_daily  # noqa: E402,F401  (registers daily-path SQL)
from metroscope.plans import oracle_serving  # noqa: E402,F401  (cards, serving, merges, collectors)
from metroscope.plans import oracle_media  # noqa: E402,F401  (documented-only operators)

ORACLE["r1_stream_hourly"] = with_(*LAKE_ONCE) + """SELECT city, hour_window AS window_start, count(service_request_id) AS total_requests,
 CAST(sum(is_open) AS BIGINT) AS open_requests, CAST(sum(is_closed) AS BIGINT) AS closed_requests,
 CAST(sum(is_infrastructure_int) AS BIGINT) AS infrastructure_requests, CAST(sum(is_emergency_type_int) AS BIGINT) AS emergency_requests,
 count(DISTINCT category) AS distinct_categories
FROM base GROUP BY city, hour_window"""
ORACLE["r1_stream_late_rows"] = ORACLE["r1_stream_hourly"]
ORACLE["r2_stream_dedup"] = with_(F_MAPPING, F_BRONZE, F_SILVER) + """SELECT service_request_id, city, status,
 requested_at_utc, is_infrastructure, is_emergency_type, normalized_category FROM silver"""
from metroscope.plans import oracle_sources  # noqa: E402,F401  (file round trips)
from metroscope.plans import oracle_jobs  # noqa: E402,F401  (jobs over several runs)

# Result edge: DATE columns leave as midnight TIMESTAMP (mirrors ``plans.common.finish``).
from metroscope.plans.oracle_dates import DATE_COLUMNS  # noqa: E402

for _name, _cols in DATE_COLUMNS.items():
    _rep = ", ".join(f"CAST({c} AS TIMESTAMP) AS {c}" for c in _cols)
    ORACLE[_name] = f"SELECT * REPLACE ({_rep}) FROM ({ORACLE[_name]}) AS dq"
