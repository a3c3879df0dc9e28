"""DuckDB oracle SQL for the queries that run a job several times."""
from __future__ import annotations

from metroscope.plans.oracle import F_BASE, F_BRONZE, F_DELIVERIES, F_LATEST, F_MAPPING, F_SILVER, ORACLE, _agg, final, with_
from metroscope.plans.oracle_daily import DAILY, F_ALERTS, F_REQ_RAW, NEWS
from metroscope.plans.oracle_serving import CARDS, CARD_DOUBLES, F_BRONZE_API, F_RUN_EVENTS

_LATE = F_DELIVERIES.replace("deliveries AS (", "deliveries AS (", 1)[:-1] + """ UNION ALL
 SELECT * REPLACE (ingested_at_utc + INTERVAL 12 DAY AS ingested_at_utc, 'open' AS status, updated_at_utc + INTERVAL 12 DAY AS updated_at_utc)
 FROM silver WHERE CAST(service_request_id AS BIGINT) % 5 = 1 UNION ALL
 SELECT * REPLACE (ingested_at_utc + INTERVAL 20 DAY AS ingested_at_utc, 'closed' AS status, updated_at_utc + INTERVAL 400 DAY AS updated_at_utc)
 FROM silver WHERE city = 'boston' AND ingested_at_utc = (SELECT min(ingested_at_utc) FROM silver WHERE city = 'boston'))"""
ORACLE["e3_incremental"] = final(
    with_(F_MAPPING, F_BRONZE, F_SILVER, _LATE, F_LATEST, F_BASE.replace("FROM silver", "FROM latest")) + _agg("hour_window"),
    "emergency_ratio")

ORACLE["m1_moving_key"] = with_(F_REQ_RAW) + """SELECT service_request_id, city,
 CASE WHEN CAST(service_request_id AS BIGINT) % 6 = 0 THEN 'reopened' ELSE status END AS status, service_name, requested_datetime, updated_datetime,
 strftime(requested_datetime, '%Y-%m') AS month FROM (SELECT * REPLACE (
  CASE WHEN CAST(service_request_id AS BIGINT) % 3 = 0 AND CAST(service_request_id AS BIGINT) % 6 <> 0
   THEN requested_datetime + INTERVAL 45 DAY ELSE requested_datetime END AS requested_datetime) FROM req_raw)"""

ORACLE["e14_alerts"] = with_(F_ALERTS) + """SELECT * REPLACE (CASE WHEN CAST(alert_id AS BIGINT) % 4 = 0
 THEN CAST(obs_date + INTERVAL 20 DAY AS DATE) ELSE obs_date END AS obs_date) FROM alerts"""

ORACLE["e15_requests"] = final(with_(
    F_BRONZE_API,
    """rows AS (SELECT c.city, service_request_id, CAST(service_request_id AS BIGINT) AS k, lower(status) AS status, requested_datetime, updated_datetime
 FROM api, (VALUES ('boston'), ('chicago')) AS c(city) WHERE service_request_id IS NOT NULL)""",
    """r AS (SELECT city, service_request_id, updated_datetime,
  CASE WHEN city = 'boston' AND k % 3 = 0 THEN 'open' ELSE status END AS status,
  CASE WHEN city = 'boston' AND k % 3 = 0 THEN requested_datetime + INTERVAL 40 DAY WHEN city = 'boston' AND k % 10 = 0 THEN NULL
   ELSE requested_datetime END AS requested_datetime FROM rows)""",
) + """SELECT *, CASE WHEN status = 'closed' THEN round_even((epoch_us(updated_datetime) - epoch_us(requested_datetime)) / 1e6 / 3600, 2) END AS resolution_hrs
 FROM r""", "resolution_hrs")

ORACLE["e16_run_log"] = with_(F_RUN_EVENTS) + """SELECT * REPLACE (CAST(duration_secs AS DOUBLE) AS duration_secs,
 coalesce(run_at, TIMESTAMP '2000-01-01') AS run_at) FROM runs"""

ORACLE["r1_resume"] = ORACLE["r1_stream_hourly"]
ORACLE["r2_two_cities"] = f"""SELECT * FROM ({ORACLE['r2_stream_dedup']}) AS a
UNION ALL SELECT * REPLACE ('twin of ' || city AS city) FROM ({ORACLE['r2_stream_dedup']}) AS b"""

_MIDDLE = "(SELECT CAST(min(CAST(l_shipdate AS DATE)) + CAST((max(CAST(l_shipdate AS DATE)) - min(CAST(l_shipdate AS DATE))) // 2 AS INTEGER) AS DATE) FROM lineitem)"
_HIGHER = [c.replace("(l_tax - l_discount) * 100 AS tone",
                     f"(l_tax - l_discount) * 100 + CASE WHEN CAST(l_shipdate AS DATE) = {_MIDDLE} THEN 1 ELSE 0 END AS tone") for c in NEWS]
ORACLE["e12_news_job"] = final(with_(*_HIGHER) + "SELECT * FROM gdelt", "avg_tone", "goldstein_avg", "avg_tone_7d", "polarity")

ORACLE["f2_many_cities"] = """WITH ev AS (SELECT row_number() OVER () AS r, l_orderkey, l_linenumber, lower(c_name || ', ' || cn.n_name) AS a,
  CASE WHEN l_partkey % 5 > 0 THEN lower(sn.n_name) END AS b
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation cn ON c_nationkey = cn.n_nationkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey),
names AS (SELECT c_name AS city FROM customer UNION SELECT n_name FROM nation UNION SELECT r_name FROM region UNION VALUES ('In'), ('a')),
texts AS (SELECT DISTINCT t FROM (SELECT a AS t FROM ev UNION SELECT b FROM ev) WHERE t IS NOT NULL),
found AS (SELECT t, city FROM texts JOIN names ON contains(t, lower(city))),
hits AS (SELECT DISTINCT r, l_orderkey, l_linenumber, city FROM (SELECT r, l_orderkey, l_linenumber, a AS t FROM ev UNION ALL SELECT r, l_orderkey, l_linenumber, b FROM ev)
 JOIN found USING (t))
SELECT city, count(*) AS events, CAST(sum(l_orderkey) AS BIGINT) AS order_sum, CAST(sum(l_linenumber) AS BIGINT) AS line_sum FROM hits GROUP BY city"""

# The last ingest says what the tables hold: the update must end where a full run would.
ORACLE["e17_window"] = final(with_(*CARDS) + """SELECT * FROM cards UNION ALL
SELECT city, score_date, 'composite', composite, readiness_mode, anomaly_score, composite_baseline_30d FROM scored""", *CARD_DOUBLES)

# ---- sources and checks
ORACLE["s3_bad_lines"] = """WITH rows AS (SELECT o_orderkey AS k, CAST(o_orderkey % 8 AS INTEGER) AS part,
  row_number() OVER (PARTITION BY o_orderkey % 8 ORDER BY o_orderkey) AS line,
  '{"service_request_id":' || CAST(o_orderkey AS VARCHAR) || ',"status":"' || o_orderstatus || '"}' AS good FROM orders)
SELECT part, line, CASE WHEN k % 97 = 0 THEN substr(good, 1, 12) ELSE '{"service_request_id":"x' || CAST(k AS VARCHAR) || '"}' END AS text
FROM rows WHERE k % 97 = 0 OR k % 89 = 0"""
ORACLE["s1_json_arrays"] = final(with_(F_BRONZE) + """SELECT service_request_id, status, service_name, lat, lon AS long, requested_datetime
FROM bronze_requests""", "lat", "long")
_READABLE = F_BASE.replace("WHERE", "WHERE CAST(service_request_id AS BIGINT) % 29 > 2 AND CAST(service_request_id AS BIGINT) % 37 > 2 AND")
ORACLE["f5_unreadable_times"] = final(with_(F_MAPPING, F_BRONZE, F_SILVER, _READABLE) + _agg("hour_window"), "emergency_ratio")
ORACLE["e2_two_batches"] = with_(F_MAPPING, F_BRONZE, F_SILVER) + """SELECT service_request_id, city,
 batch_id || CASE WHEN CAST(service_request_id AS BIGINT) % 2 = 1 THEN '-2' ELSE '-1' END AS batch_id, normalized_category, is_infrastructure,
 is_emergency_type, requested_at_utc FROM silver"""


def _bins(table: str, source: str, date: str, numbers: dict[str, float], texts: tuple[str, ...] = ()) -> str:
    cells = [(c, f"CAST(CAST(floor({c} / {w!r}::DOUBLE) AS BIGINT) AS VARCHAR)") for c, w in numbers.items()]
    cells += [(c, f"substr(md5({c}), 1, 1)") for c in texts]
    return " UNION ALL ".join(f"SELECT '{table}' AS table_name, '{c}' AS column_name, CAST({date} AS DATE) AS obs_date, {b} AS bin FROM {source}" for c, b in cells)


_SHIFTED = """shifted AS (SELECT * REPLACE (CASE WHEN obs_date >= (SELECT max(obs_date) FROM weather) - 2 THEN tmax + 25 ELSE tmax END AS tmax) FROM weather)"""
_PROFILES = " UNION ALL ".join([
    _bins("weather_daily", "shifted", "obs_date", {"tmax": 2.5, "heat_index_max": 5.0, "precip_6hr_max": 0.5}),
    _bins("requests_311", "requests", "requested_datetime", {"resolution_hrs": 24.0}, ("status", "service_name")),
    _bins("gdelt_daily", "gdelt", "obs_date", {"avg_tone": 0.5})])
ORACLE["d9_column_drift"] = final(with_(
    *DAILY, _SHIFTED,
    f"""held AS (SELECT table_name, column_name, obs_date, coalesce(bin, 'null') AS bin, count(*) AS n FROM ({_PROFILES}) GROUP BY ALL)""",
    """days AS (SELECT *, row_number() OVER (PARTITION BY table_name, column_name ORDER BY obs_date) AS place FROM (
  SELECT table_name, column_name, obs_date, CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(CASE WHEN bin = 'null' THEN n ELSE 0 END) AS BIGINT) AS n_null
  FROM held GROUP BY ALL))""",
    """grid AS (SELECT d.*, b.bin, coalesce(h.n, 0) AS n FROM days d JOIN (SELECT DISTINCT table_name, column_name, bin FROM held) b USING (table_name, column_name)
  LEFT JOIN held h ON h.table_name = d.table_name AND h.column_name = d.column_name AND h.obs_date = d.obs_date AND h.bin = b.bin)""",
    """refd AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY table_name, column_name, bin ORDER BY obs_date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING), 0) AS r FROM grid)""",
    """shares AS (SELECT *, (n + 0.5) / (sum(n) OVER w + count(*) OVER w * 0.5) AS p, (r + 0.5) / (sum(r) OVER w + count(*) OVER w * 0.5) AS q
  FROM refd WINDOW w AS (PARTITION BY table_name, column_name, obs_date))""",
    """psis AS (SELECT table_name, column_name, obs_date, n_rows, n_null, place, sum((CAST(p AS DOUBLE) - q) * ln(CAST(p AS DOUBLE) / q)) AS psi FROM shares GROUP BY ALL)""",
) + """SELECT table_name, column_name, obs_date, n_rows, n_null, CASE WHEN place > 7 THEN psi END AS psi, place > 7 AND psi > 0.25 AS drifted FROM psis""", "psi")

ORACLE["f8_stored"] = final(with_(*CARDS) + """SELECT c.*, s.composite, s.readiness_mode
FROM (SELECT * FROM cards QUALIFY metric_date = max(metric_date) OVER (PARTITION BY city)) c
JOIN (SELECT city, composite, readiness_mode FROM scored QUALIFY score_date = max(score_date) OVER (PARTITION BY city)) s USING (city)""",
                            *CARD_DOUBLES, "composite")

ORACLE["e13_weather"] = ORACLE["j4_source_fallback"]
