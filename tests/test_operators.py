"""Hand-made rows per operator: nulls, ties, boundaries."""
import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from metroscope.functions import verdict as vd
from metroscope.functions.columns import clip, mean_rounded, parse_timestamp, pyround, rnd
from metroscope.operators import baselines as bl
from metroscope.operators import cards as cd
from metroscope.operators import collectors as co
from metroscope.operators import geo
from metroscope.operators import merge as mg
from metroscope.operators import scoring as sc
from metroscope.session import scratch_path
from metroscope.sources import io


def one(df, col):
    return [r[col] for r in df.collect()]


def test_rounding_half_even_on_scaled_value(spark):
    df = spark.createDataFrame([(2.675,), (1.005,), (-0.0001,), (0.125,), (None,)], "x double")
    assert one(df.select(rnd(F.col("x"), 2).alias("r")), "r")[:2] == [2.68, 1.0]  # scaled double 267.5 -> even 268
    assert one(df.select(rnd(F.col("x"), 3).alias("r")), "r")[2] == 0.0
    assert one(df.select(rnd(F.col("x"), 2).alias("r")), "r")[3:] == [0.12, None]  # exact tie -> even


def test_pyround_equals_python_round(spark):
    import random

    random.seed(11)
    vals = ([round(random.uniform(-500, 500), random.choice([1, 2, 3, 4])) for _ in range(4000)]
            + [x / 100 for x in range(-2000, 2000)] + [random.uniform(-1e4, 1e4) for _ in range(2000)]
            + [27.85, 2.675, 13.25, 1.005, 0.125, -2.5, 2.5, 0.0, -0.0])
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for d in (0, 1, 2, 3):
        got = one(df.select(pyround(F.col("x"), d).alias("r")), "r")
        assert got == [round(v, d) for v in vals]


def test_exact_mean_resolves_decimal_ties(spark):
    df = spark.createDataFrame([("a", 1.25), ("a", 1.30), ("b", 2.675), ("c", None)], "k string, v double")
    out = {r.k: r.m for r in df.groupBy("k").agg(mean_rounded(F.col("v"), 2).alias("m")).collect()}
    assert out == {"a": 1.27, "b": 2.67, "c": None}  # float mean, then Python's round (exact binary value)


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(150.0,), (-3.0,), (None,)], "x double")
    assert one(df.select(clip(F.col("x")).alias("c")), "c") == [100.0, 0.0, None]


def test_parse_timestamp_bad_input_is_null(spark):
    df = spark.createDataFrame([("",), ("   ",), ("garbage",), ("2024-01-01T00:00:07Z",), (None,)], "s string")
    got = one(df.select(parse_timestamp(F.col("s")).alias("t")), "t")
    assert got[:3] == [None, None, None] and got[4] is None
    assert got[3] == dt.datetime(2024, 1, 1, 0, 0, 7)


def _hours(spark, n, start=dt.datetime(2024, 1, 1), value=lambda i: float(i % 5), step_h=1):
    rows = [("x", start + dt.timedelta(hours=i * step_h), value(i), float(i % 3), 0.1 * (i % 4)) for i in range(n)]
    return spark.createDataFrame(rows, "city string, window_start timestamp, total_requests double, "
                                       "infrastructure_requests double, emergency_ratio double")


@pytest.mark.parametrize("n,valid", [(24, False), (25, True), (26, True)])
def test_baseline_needs_24_points(spark, n, valid):
    out = bl.hourly_baselines(_hours(spark, n)).orderBy("window_start").collect()
    last = out[-1]
    assert last.total_requests_history_points == n - 1
    assert last.baseline_is_valid is (n - 1 >= 24)
    assert (last.total_requests_zscore is not None) is valid


def test_baseline_window_edge_and_ties(spark):
    # a row exactly 168 h earlier is inside the frame; a row at the same hour is not
    rows = [("x", dt.datetime(2024, 1, 1), 1.0, 0.0, 0.0), ("x", dt.datetime(2024, 1, 8), 5.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "city string, window_start timestamp, total_requests double, "
                                     "infrastructure_requests double, emergency_ratio double")
    out = bl.hourly_baselines(df, min_points=1).orderBy("window_start").collect()
    assert out[1].total_requests_history_points == 1
    assert out[1].total_requests_mean == 1.0
    assert out[1].total_requests_std is None and out[1].total_requests_baseline_valid is False


def test_baseline_zero_std_is_invalid(spark):
    out = bl.hourly_baselines(_hours(spark, 40, value=lambda i: 3.0)).orderBy("window_start").collect()
    assert out[-1].total_requests_std == 0.0
    assert out[-1].total_requests_baseline_valid is False and out[-1].total_requests_zscore is None
    assert out[-1].baseline_is_valid is True  # count-only overall validity (Q7)


def test_duplicate_city_windows_guard(spark):
    df = _hours(spark, 3).unionByName(_hours(spark, 1))
    with pytest.raises(RuntimeError, match="more than one baseline per city and hour"):
        bl.assert_unique_city_windows(df)


@pytest.mark.parametrize("comp,base,mode", [(40.0, 30.0, "Elevated"), (39.99, 30.0, "Normal"), (55.0, 30.0, "High"),
                                            (54.99, 30.0, "Elevated")])
def test_readiness_bands(spark, comp, base, mode):
    df = spark.createDataFrame([(comp, base)], "c double, b double")
    assert one(df.select(sc.readiness_expr(F.col("c"), F.col("b")).alias("m")), "m") == [mode]


def test_primary_driver_ties_go_to_first_signal(spark):
    df = spark.createDataFrame([(60.1, 39.9, 10.1, 50.0), (50.0, 50.0, 0.0, 50.0), (50.0, 70.0, 20.0, 30.0)],
                               "anomaly_score double, heat_score double, alert_score double, context_score double")
    assert one(df.select(vd.primary_driver().alias("p")), "p") == ["anomaly_score", "anomaly_score", "heat_score"]


@pytest.mark.parametrize("score,text", [(80.0, 0), (79.99, 1), (60.0, 1), (30.0, 2), (30.01, 3)])
def test_anomaly_bands(spark, score, text):
    df = spark.createDataFrame([(score,)], "s double")
    got = one(df.select(vd.band_anomaly_heat(F.col("s"), vd.ANOMALY_TEXT).alias("t")), "t")[0]
    assert got == vd.ANOMALY_TEXT[text]


@pytest.mark.parametrize("score,idx", [(75.0, 0), (40.0, 1), (0.01, 2), (0.0, 3)])
def test_alert_bands(spark, score, idx):
    df = spark.createDataFrame([(score,)], "s double")
    assert one(df.select(vd.band_alert(F.col("s")).alias("t")), "t")[0] == vd.ALERT_TEXT[idx].format(place="Boston")


@pytest.mark.parametrize("score,idx", [(70.0, 0), (50.0, 1), (20.0, 2), (20.01, 3)])
def test_context_bands(spark, score, idx):
    df = spark.createDataFrame([(score,)], "s double")
    assert one(df.select(vd.band_context(F.col("s")).alias("t")), "t")[0] == vd.CONTEXT_TEXT[idx]


def test_verdict_formats_half_even(spark):
    df = spark.createDataFrame([(40.25, 30.0, "Elevated", 90.0, 50.0, 0.0, 50.0)],
                               "composite double, composite_baseline_30d double, readiness_mode string, "
                               "anomaly_score double, heat_score double, alert_score double, context_score double")
    text = one(df.select(vd.verdict_text().alias("t")), "t")[0]
    assert text.startswith("Urban stress conditions are moderately above baseline — composite index is 40.2 (+10.2 pts")
    assert "Primary driver: 311 service demand (anomaly score: 90.0/100)." in text
    assert text.endswith(vd.CLOSING)


def test_signal_defaults_and_alert_scale(spark):
    spine = spark.createDataFrame([("x", dt.date(2024, 1, 1))], "city string, d date")
    empty = spark.createDataFrame([], "city string, d date, anomaly_score double")
    heat = spark.createDataFrame([], "city string, d date, heat_score double")
    alerts = spark.createDataFrame([("x", dt.date(2024, 1, 1), "Extreme", "Immediate", "Observed"),
                                    ("x", dt.date(2024, 1, 1), "Minor", "Past", "Likely")],
                                   "city string, obs_date date, severity string, urgency string, certainty string")
    ctx = spark.createDataFrame([], "city string, d date, context_score double")
    out = sc.assemble(spine, empty, heat, sc.alert_scores(alerts), ctx).collect()[0]
    assert (out.anomaly_score, out.heat_score, out.alert_score, out.context_score) == (50.0, 50.0, 100.0, 50.0)


def test_context_score_null_rules(spark):
    df = spark.createDataFrame([(None, 5), (-4.0, None), (-4.0, 10), (12.0, 40)], "t double, p int")
    got = one(df.select(sc.context_score_expr(F.col("t"), F.col("p")).alias("s")), "s")
    assert got == [50.0, 35.0, 50.0, 100.0]


def test_anomaly_uses_days_with_data(spark):
    rows = [("x", dt.date(2024, 1, d), c) for d, c in ((1, 10), (2, 10), (5, 20))]
    counts = spark.createDataFrame(rows, "city string, d date, cnt long")
    got = [r.anomaly_score for r in sc.anomaly_scores(counts).orderBy("d").collect()]
    assert got == [50.0, 50.0, 100.0]  # +100 % -> 130 clipped


def test_heat_streak_matches_loop(spark):
    import random

    random.seed(7)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(200) if random.random() > 0.2]
    rows = [("S", d, random.choice([None, 41.0, 30.0]), random.choice([36.0, 20.0, None])) for d in days]
    wx = spark.createDataFrame(rows, "station_id string, obs_date date, heat_index_max double, tmax double")
    spine_days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(200)]
    st = spark.createDataFrame([("S", "c", d) for d in spine_days], "station_id string, city string, d date")
    got = {r.d: r.heat_streak_days for r in cd.heat_streak(wx, st).collect()}

    def loop(day):
        n = 0
        for _, d, hi, tx in sorted((r for r in rows if r[1] <= day), key=lambda r: r[1], reverse=True):
            if (hi is not None and hi > 40) or (tx is not None and tx > 35):
                n += 1
            else:
                break
        return n

    assert all(got[d] == loop(d) for d in spine_days)


def test_parse_requests_service_code(spark):
    rows = [("1", None), ("2", "a"), ("3", "a:b:c"), ("", "x:y"), (None, "x")]
    raw = spark.createDataFrame(
        [(i, c, "n", "Open", None, None, 1.0, 2.0, None) for i, c in rows],
        "service_request_id string, service_code string, service_name string, status string, "
        "requested_datetime string, updated_datetime string, lat double, long double, description string",
    )
    out = {r.service_request_id: (r.department, r.category, r.status) for r in co.parse_requests(raw).collect()}
    assert out == {"1": ("", None, "open"), "2": ("a", None, "open"), "3": ("a", "b", "open")}


def test_run_log_error_text(spark):
    rows = [("FAILED", "", "x"), ("FAILED", "E", None), ("TIMED_OUT", "E", "x"), ("ABORTED", None, None), ("SUCCEEDED", "E", "x")]
    ev = spark.createDataFrame([("arn", "a:b:pipe", s, 1000, 5500, e, c) for s, e, c in rows],
                               "executionArn string, stateMachineArn string, status string, startDate long, "
                               "stopDate long, error string, cause string")
    out = co.normalize_runs(ev).collect()
    assert [r.error_message for r in out] == ["x", "E", "E: x", "ABORTED", None]
    assert {r.duration_secs for r in out} == {4} and {r.pipeline_name for r in out} == {"pipe"}


def test_upsert_is_idempotent_and_dedups_batch(spark):
    old = spark.createDataFrame([("1", 1, "a"), ("2", 1, "b")], "k string, v int, s string")
    new = spark.createDataFrame([("2", 2, "c"), ("2", 3, "d"), ("3", 1, "e")], "k string, v int, s string")
    once = mg.upsert(old, new, ["k"], ["v"])
    twice = mg.upsert(once, new, ["k"], ["v"])
    assert sorted(once.collect()) == sorted(twice.collect())
    assert {r.k: r.s for r in once.collect()} == {"1": "a", "2": "d", "3": "e"}


def test_partial_upsert_keeps_old_columns(spark):
    old = spark.createDataFrame([("1", 1.0, 0.5)], "k string, v double, keep double")
    new = spark.createDataFrame([("1", 2.0, None), ("2", 3.0, None)], "k string, v double, keep double")
    out = {r.k: (r.v, r.keep) for r in mg.partial_upsert(old, new, ["k"], ["keep"]).collect()}
    assert out == {"1": (2.0, 0.5), "2": (3.0, None)}


def test_merge_into_path_only_touches_batch_partitions(spark):
    root = scratch_path(spark, "merge-test")
    first = spark.createDataFrame([("1", "p1", 1), ("2", "p2", 1)], "k string, part string, v int")
    mg.merge_into_path(spark, root, first, ["k"], ["part"])
    mg.merge_into_path(spark, root, spark.createDataFrame([("1", "p1", 9), ("3", "p1", 1)], "k string, part string, v int"), ["k"], ["part"])
    got = {r.k: r.v for r in spark.read.parquet(root).collect()}
    assert got == {"1": 9, "2": 1, "3": 1}


def test_zone_contains(spark):
    zones = spark.createDataFrame([("sq", [0.0, 1.0, 1.0, 0.0], [0.0, 0.0, 1.0, 1.0]), ("tri", [2.0, 3.0, 2.0], [0.0, 0.0, 1.0])],
                                  "zone_id string, xs array<double>, ys array<double>")
    pts = spark.createDataFrame([("a", 0.5, 0.5), ("b", 2.2, 0.2), ("c", 2.9, 0.9), ("d", 5.0, 5.0)], "id string, lon double, lat double")
    out = {r.id: r.zone_id for r in geo.assign_zones(pts, zones).collect()}
    assert out == {"a": "sq", "b": "tri", "c": None, "d": None}


def test_json_batch_and_manifest_checks(spark, tmp_path):
    from pyspark.sql import types as T

    good = tmp_path / "good.json"
    good.write_text(json.dumps([{"service_request_id": "1", "lat": 1.5}, {"service_request_id": "2"}]))
    schema = T.StructType([T.StructField("service_request_id", T.StringType()), T.StructField("lat", T.DoubleType())])
    assert io.read_json_batch(spark, str(good), schema).count() == 2
    bad = tmp_path / "bad.json"
    bad.write_text('[{"service_request_id": "1"}, 7]')
    with pytest.raises(Exception):
        io.read_json_batch(spark, str(bad), schema).collect()
    man = tmp_path / "manifest.json"
    man.write_text(json.dumps({"city": "boston", "ingested_at_utc": "2024-01-01T00:00:00Z"}))
    with pytest.raises(ValueError, match="manifests without city, batch_id, ingested_at_utc"):
        io.read_manifests(spark, str(man))


def test_jsonl_bad_line_fails(spark, tmp_path):
    from pyspark.sql import types as T

    p = tmp_path / "part.jsonl"
    p.write_text('{"a": "1"}\n{not json\n')
    with pytest.raises(Exception):
        io.read_jsonl(spark, str(p), T.StructType([T.StructField("a", T.StringType())])).collect()


def test_required_columns_message(spark):
    df = spark.createDataFrame([(1,)], "city int")
    with pytest.raises(ValueError, match="no column batch_id, status"):
        io.require_columns(df, ["status", "city", "batch_id"], "Silver input")


def test_pyround_property(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=25, deadline=None)
    @given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False), min_size=1, max_size=200),
           st.integers(min_value=0, max_value=4))
    def check(values, digits):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        assert one(df.select(pyround(F.col("x"), digits).alias("r")), "r") == [round(v, digits) for v in values]

    check()


def test_zone_join_shuffle_path_matches_broadcast(spark):
    zones = spark.createDataFrame([("sq", [0.0, 1.0, 1.0, 0.0], [0.0, 0.0, 1.0, 1.0]), ("tri", [2.0, 3.0, 2.0], [0.0, 0.0, 1.0])],
                                  "zone_id string, xs array<double>, ys array<double>")
    pts = spark.range(400).select(F.col("id").cast("string").alias("id"), (F.col("id") % 40 / 10.0).alias("lon"),
                                  (F.floor(F.col("id") / 40) / 10.0).alias("lat"))
    a = sorted(geo.assign_zones(pts, zones).collect(), key=str)
    b = sorted(geo.assign_zones(pts, zones, max_broadcast_edges=-1).collect(), key=str)
    assert a == b and any(r.zone_id == "tri" for r in a) and any(r.zone_id is None for r in a)


def test_keep_latest_edges(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("a", 2, "y"), (None, 5, "z"), (None, 4, "z")], "k string, v int, t string")
    assert {tuple(r) for r in mg.keep_latest(df, ["k"], ("v",)).collect()} == {("a", 2, "y"), (None, 5, "z")}
    assert sorted(r.k or "" for r in mg.keep_latest(df.select("k"), ["k"]).collect()) == ["", "a"]
    plan = mg.keep_latest(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # before and after the exchange: a hot key leaves a task as one row


def test_means_keep_more_than_six_decimals(spark):
    from metroscope.functions.columns import mean_rounded

    for values, digits, want in (([0.0004999999], 3, 0.0), ([0.0005000001], 3, 0.001), ([1.00049, 1.00050, 1.000511], 3, round(3.001501 / 3, 3)),
                                 ([1e7, 1e7 + 0.25], 2, 10000000.12), ([None], 2, None)):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        assert one(df.agg(mean_rounded(F.col("x"), digits).alias("r")), "r") == [want]
