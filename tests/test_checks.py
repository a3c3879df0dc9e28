"""Bad lines by number, column drift, newest rows from stored tables, the command line."""
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metroscope import cli
from metroscope.operators import quality as qa
from metroscope.plans import daily, jobs, lake
from metroscope.plans import update as up
from metroscope.session import scratch_path
from metroscope.sources import fixtures, io
from metroscope.streaming import hourly as hs

from conftest import SMALL_SF

LINE = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])


def test_a_bad_line_in_a_later_split_is_named(spark, tmp_path):
    good = json.dumps({"a": 1, "b": "x" * 50})
    files = {"one.json": 5000, "two.json": 3000, "tiny.json": 1}
    bad = {("one.json", 1): "{", ("one.json", 4321): '{"a": "text"}', ("one.json", 5000): "nonsense", ("two.json", 2999): '{"a": 1,'}
    for name, n in files.items():
        lines = [bad.get((name, i), "" if i % 100 == 50 else good) for i in range(1, n + 1)]
        (tmp_path / name).write_text("\n".join(lines) + ("\n" if name == "two.json" else ""))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "20k")
    try:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
        got = {(r.file.rsplit("/", 1)[1], r.line): r.text for r in io.bad_json_lines(spark, str(tmp_path), LINE).collect()}
        with pytest.raises(ValueError, match="one.json, line 1: {; .*one.json, line 4321"):
            io.require_json_lines(spark, str(tmp_path), LINE)
    finally:
        spark.conf.set(key, before)
    assert got == bad
    assert io.bad_json_lines(spark, str(tmp_path / "tiny.json"), LINE).isEmpty()


def test_the_silver_job_names_the_bad_line(spark):
    bronze, mapping, silver = (scratch_path(spark, n) for n in ("bronze", "mapping", "silver"))
    fixtures.category_mapping(spark).coalesce(1).write.option("header", True).csv(mapping)
    folder = f"{bronze}/year=2024/month=01/day=02/city=boston/batch_id=b1"
    spark.createDataFrame([('{"service_request_id": "1"}',), ("{broken",)], "value string").coalesce(1).write.text(folder)
    with pytest.raises(ValueError, match="batch_id=b1/.*line 2: {broken"):
        jobs.silver_job(spark, bronze, mapping, silver)


def test_a_shifted_column_is_reported(spark):
    """Row counts and nulls stay; only one column's values move, another's nulls."""
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=d), float(i % 20) + (15 if d >= 25 else 0), None if d == 27 and i % 2 else "ab"[i % 2], 7.0)
            for d in range(30) for i in range(200)]
    df = spark.createDataFrame(rows, "day date, v double, t string, still double")
    profiles = qa.column_profiles(df, "x", F.col("day"), {"v": 2.0, "still": 1.0}, ["t"])
    got = {(r.column_name, r.obs_date): r for r in qa.column_drift(profiles).collect()}
    assert len(got) == 90 and all(r.n_rows == 200 for r in got.values())
    day = lambda i: dt.date(2024, 1, 1) + dt.timedelta(days=i)
    assert {d for (c, d), r in got.items() if r.drifted and c == "v"} >= {day(25), day(26)}
    assert not any(r.drifted for (c, d), r in got.items() if c == "v" and d < day(25)) and not any(r.drifted for (c, _), r in got.items() if c == "still")
    assert {d for (c, d), r in got.items() if r.drifted and c == "t"} == {day(27)} and got["t", day(27)].n_null == 100
    assert got["v", day(3)].psi is None
    # profiles of two halves merge to the profile of the whole
    halves = qa.column_profiles(df.filter("v % 2 = 0"), "x", F.col("day"), {"v": 2.0}).unionByName(qa.column_profiles(df.filter("v % 2 != 0"), "x", F.col("day"), {"v": 2.0}))
    assert sorted(map(str, qa.column_drift(halves).collect())) == sorted(str(r) for (c, _), r in got.items() if c == "v")
    odd = spark.createDataFrame([(None, 1.0), (day(1), float("nan")), (day(1), float("inf"))], "day date, v double")
    only, = qa.column_drift(qa.column_profiles(odd, "x", F.col("day"), {"v": 1.0})).collect()
    assert (only.n_rows, only.n_null, only.drifted) == (2, 2, False)


def test_newest_rows_come_from_one_partition(spark):
    root = scratch_path(spark, "stored")
    day = lambda m, d: dt.date(2024, m, d)
    scores = lambda rows: spark.createDataFrame(rows, "city string, score_date date, anomaly_score double, heat_score double, alert_score double, "  # noqa: E731
                                                      "context_score double, composite double, composite_baseline_30d double, readiness_mode string")
    cards = lambda rows: spark.createDataFrame(rows, "city string, metric_date date, metric_name string, value_num double")
    row = lambda c, d, x: (c, d, 50.0, 50.0, 0.0, 50.0, x, 40.0, "Normal")
    up.merge_outputs(spark, root, scores([row("boston", day(1, 5), 1.0), row("boston", day(3, 2), 2.0), row("chicago", day(2, 1), 3.0)]),
                     cards([("boston", day(3, 2), "tmax", 1.0), ("boston", day(3, 2), "open_backlog", 2.0), ("chicago", day(2, 1), "tmax", 3.0)]))
    up.merge_outputs(spark, root, scores([row("boston", day(1, 6), 9.0)]), cards([("chicago", day(4, 1), "tmax", 4.0)]))  # a backfill, and a new day
    assert sorted((r.city, r.composite) for r in up.newest_rows(spark, root, "signal_scores").collect()) == [("boston", 2.0), ("chicago", 3.0)]
    assert [(r.city, r.metric_date, r.value_num) for r in up.newest_rows(spark, root, "signal_metrics", "chicago").collect()] == [("chicago", day(4, 1), 4.0)]
    plan = up.newest_rows(spark, root, "signal_metrics", "boston")._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.split("\n") if "PartitionFilters" in x and "metric_name" in x)
    assert "boston" in scan and "2024-03" in scan and "chicago" not in scan and "2024-04" not in scan
    window = up.day_rows(spark, root, "signal_scores", "boston", "2024-01-01", "2024-01-31")
    assert sorted(r.composite for r in window.collect()) == [1.0, 9.0]
    assert "PartitionFilters: [isnotnull(city" in window._jdf.queryExecution().executedPlan().toString()
    assert up.newest_rows(spark, root, "signal_scores", "nowhere").count() == 0


def test_commands(spark, capsys):
    """The ingest and stream commands, twice each: a repeat adds nothing."""
    paths = {n: scratch_path(spark, f"cli-{n}") for n in ("obs", "tall", "weather", "feats", "alerts", "raw", "requests", "events", "log", "landing", "target", "check")}
    fixtures.observation_features(spark, SMALL_SF).write.parquet(paths["obs"])
    fixtures.daily_values(spark, SMALL_SF).write.parquet(paths["tall"])
    fixtures.alert_features(spark, SMALL_SF).filter("cast(id as long) % 10 = 0").write.parquet(paths["feats"])
    fixtures.open311_api_rows(spark, SMALL_SF).write.parquet(paths["raw"])
    fixtures.run_events(spark, SMALL_SF).filter("stopDate is not null").write.parquet(paths["events"])
    hs.land(lake.silver(spark, SMALL_SF), paths["landing"])
    commands = {
        "weather": ["--observations-path", paths["obs"], "--daily-values-path", paths["tall"], "--weather-root", paths["weather"]],
        "alerts": ["--features-path", paths["feats"], "--alerts-root", paths["alerts"]],
        "requests": ["--records-path", paths["raw"], "--city", "boston", "--requests-root", paths["requests"]],
        "run-log": ["--events-path", paths["events"], "--log-root", paths["log"]],
        "stream": ["--landing-root", paths["landing"], "--target", paths["target"], "--checkpoint", paths["check"]],
    }
    for name, args in commands.items():
        said = []
        for _ in range(2):
            cli.main(["--shuffle-partitions", "4", name, *args])
            said.append(json.loads(capsys.readouterr().out.strip().split("\n")[-1]))
        if name == "stream":
            assert said[0]["rows_read"] > 0 == said[1]["rows_read"]
        else:
            assert said[0] == said[1] and min(said[0].values()) > 0
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_update_command(spark, capsys, tmp_path):
    roots = {n: scratch_path(spark, f"cli-{n}") for n in ("requests", "weather", "alerts", "news", "out")}
    short = lambda df, c: df.filter(F.col(c).between("1995-01-01", "1995-03-01"))
    req = short(daily.requests(spark, SMALL_SF), "requested_datetime").withColumn("month", F.date_format("requested_datetime", "yyyy-MM"))
    io.write_partitioned(req, roots["requests"], ["city", "month"])
    al = short(daily.alerts(spark, SMALL_SF), "obs_date").withColumn("month", F.date_format("obs_date", "yyyy-MM"))
    io.write_partitioned(al, roots["alerts"], ["month"])
    short(daily.weather(spark, SMALL_SF), "obs_date").write.parquet(roots["weather"])
    short(daily.gdelt(spark, SMALL_SF), "obs_date").write.parquet(roots["news"])
    stations = tmp_path / "stations.csv"
    stations.write_text("station_id,city\n" + "\n".join(f"{s},{c}" for s, c in fixtures.STATION_CITIES))
    args = [x for n in ("requests", "weather", "alerts", "news") for x in (f"--{n}-root", roots[n])] + ["--stations-csv", str(stations), "--output-root", roots["out"]]
    cli.main(["daily", *args])
    first = json.loads(capsys.readouterr().out.strip().split("\n")[-1])
    before = sorted(map(str, spark.read.parquet(f"{roots['out']}/signal_scores").collect()))
    cli.main(["update", *args, "--days", "1995-02-01", "1995-02-03"])
    assert json.loads(capsys.readouterr().out.strip().split("\n")[-1]) == first
    assert sorted(map(str, spark.read.parquet(f"{roots['out']}/signal_scores").collect())) == before
