"""The batch jobs end to end on small inputs: written outputs, re-runs are idempotent."""
import json

import pytest
from pyspark.sql import functions as F

from metroscope.operators import baselines as bl
from metroscope.operators import lake as lk
from metroscope.operators import merge as mg
from metroscope.operators import news as nw
from metroscope.operators import serving as sv
from metroscope.plans import daily, jobs, lake
from metroscope.session import scratch_path
from metroscope.sources import fixtures, io

from conftest import SMALL_SF


@pytest.fixture()
def static_overwrite(spark):
    """Spark's default overwrite mode, as a plain session has it."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "static")
    yield
    spark.conf.set(key, before)


def test_lake_jobs_write_and_rerun(spark, static_overwrite):
    silver_path = scratch_path(spark, "silver-job")
    io.write_partitioned(lk.bronze_partition_columns(lake.deliveries(spark, SMALL_SF)), silver_path, ["year", "month", "day", "city"])
    roots = [scratch_path(spark, n) for n in ("hourly", "daily", "cat")]
    first = jobs.aggregate_job(spark, silver_path, *roots)
    again = jobs.aggregate_job(spark, silver_path, *roots)
    assert first == again and first["hourly"] == lake.hourly(spark, SMALL_SF).count() == spark.read.parquet(roots[0]).count()
    out = scratch_path(spark, "baselines")
    b1 = jobs.baseline_job(spark, roots[0], out)
    b2 = jobs.baseline_job(spark, roots[0], out)
    assert b1 == b2 and b1["rows"] == spark.read.parquet(out).count() > 0


def test_incremental_runs_equal_the_full_run(spark, static_overwrite):
    silver_path = scratch_path(spark, "silver-inc")
    io.write_partitioned(lk.bronze_partition_columns(lake.deliveries(spark, SMALL_SF)), silver_path, ["year", "month", "day", "city"])
    full, inc = ([scratch_path(spark, f"{k}-{n}") for n in ("h", "d", "c", "b")] for k in ("full", "inc"))
    jobs.aggregate_job(spark, silver_path, *full[:3])
    jobs.baseline_job(spark, full[0], full[3])
    days = sorted(r.d for r in spark.read.parquet(silver_path).select(F.to_date("ingested_at_utc").alias("d")).distinct().collect())
    middle = str(days[len(days) // 2])
    jobs.aggregate_job(spark, silver_path, *inc[:3])  # an earlier full state, then a partial run over it
    jobs.aggregate_job(spark, silver_path, *inc[:3], from_day=middle)
    for a, b in zip(full[:3], inc[:3]):
        assert sorted(spark.read.parquet(a).collect(), key=str) == sorted(spark.read.parquet(b).collect(), key=str)
    jobs.baseline_job(spark, inc[0], inc[3], from_day=middle)
    cols = [c for c in bl.OUTPUT_COLUMNS if c not in ("baseline_computed_at_utc", "ingest_year", "ingest_month", "ingest_day")]
    want = spark.read.parquet(full[3]).filter(F.col("window_start") >= middle).select(*cols)
    assert sorted(want.collect(), key=str) == sorted(spark.read.parquet(inc[3]).select(*cols).collect(), key=str)


def test_a_request_delivered_twice_counts_once(spark):
    rows = [("boston", "1", "Open", "2024-01-01 10:05:00", "2024-01-01 10:05:00", "2024-01-02 00:00:00"),
            ("boston", "1", "closed", "2024-01-01 10:05:00", "2024-01-03 09:00:00", "2024-01-04 00:00:00"),
            ("boston", None, "open", "2024-01-01 10:06:00", None, "2024-01-02 00:00:00"),
            ("boston", None, "open", "2024-01-01 10:06:00", None, "2024-01-02 00:00:00"),
            ("boston", "2", "open", "garbage", None, "2024-01-02 00:00:00"), ("boston", "3", "open", "2024-01-01 11:00:00", None, "")]
    silver = spark.createDataFrame(rows, "city string, service_request_id string, status string, requested_at_utc string, "
                                         "updated_at_utc string, ingested_at_utc string").withColumns(
        {"normalized_category": F.lit(None).cast("string"), "is_infrastructure": F.lit(1), "is_emergency_type": F.lit(0), "batch_id": F.lit("b")})
    cells = lk.category_cells(lk.latest_deliveries(lk.request_facts(silver)))
    got = {(r.ingest_day, r.total_requests, r.open_requests, r.closed_requests, r.infrastructure_requests, r.distinct_categories)
           for r in lk.hourly(cells).collect()}
    assert got == {("04", 1, 0, 1, 1, 1), ("02", 0, 2, 0, 2, 1)}


def test_hours_are_summed_over_ingest_days(spark):
    base = [("boston", "2024-01-01 10:00:00", 100, 5, 0.01, 1, "2024", "01", "02"), ("boston", "2024-01-01 10:00:00", 1, 0, 1.0, 1, "2024", "01", "04")]
    df = spark.createDataFrame(base, "city string, window_start string, total_requests long, infrastructure_requests long, "
                                     "emergency_ratio double, emergency_requests long, ingest_year string, ingest_month string, ingest_day string")
    for t in (df, df.drop("emergency_requests")):
        r, = bl.city_hours(t).collect()
        assert (r.total_requests, r.infrastructure_requests, r.ingest_day) == (101.0, 5.0, "04")
        assert abs(r.emergency_ratio - 2 / 101) < 1e-9
    assert bl.city_hours(df.drop("ingest_year")).first().ingest_day == "01"
    empty = scratch_path(spark, "no-hours")
    df.withColumn("window_start", F.lit("garbage")).write.parquet(empty)
    with pytest.raises(RuntimeError, match="readable hour"):
        jobs.baseline_job(spark, empty, scratch_path(spark, "never"))


def _own_tables(spark):
    return (fixtures.requests_daily(spark, SMALL_SF), daily.weather(spark, SMALL_SF), daily.alerts(spark, SMALL_SF),
            daily.gdelt(spark, SMALL_SF), daily.stations(spark))


def test_daily_job_windows_equal_the_full_run(spark, static_overwrite):
    full, part = scratch_path(spark, "datamart"), scratch_path(spark, "datamart-window")
    tables = _own_tables(spark)
    first = {k: v.count() for k, v in jobs.daily_job(spark, *tables, full).items()}
    second = jobs.daily_job(spark, *tables, full)
    assert {k: v.count() for k, v in second.items()} == first
    scores = second["signal_scores"]
    assert scores.groupBy("city", "score_date").count().filter("count > 1").count() == 0
    bounds = scores.agg(*[F.min(c).alias(f"lo_{c}") for c in ("composite", "anomaly_score", "heat_score")],
                        *[F.max(c).alias(f"hi_{c}") for c in ("composite", "anomaly_score", "heat_score")]).first()
    assert all(0 <= bounds[f"lo_{c}"] and bounds[f"hi_{c}"] <= 100 for c in ("composite", "anomaly_score", "heat_score"))
    lo, hi = "1996-02-10", "1996-03-20"
    window = jobs.daily_job(spark, *tables, part, lo, hi)
    for name, date in (("signal_scores", "score_date"), ("signal_metrics", "metric_date"), ("verdicts", "verdict_date")):
        cols = [c for c in second[name].columns if c != "generated_at"]
        want = second[name].filter(F.col(date).between(lo, hi)).select(*cols)
        assert sorted(window[name].select(*cols).collect(), key=str) == sorted(want.collect(), key=str)


def _land(root, batch, city, ingested, records, manifest=True):
    folder = root / f"city={city}" / f"batch_id={batch}"
    folder.mkdir(parents=True)
    (folder / "response.json").write_text(json.dumps(records))
    if manifest:
        (folder / "manifest.json").write_text(json.dumps({"city": city, "batch_id": batch, "ingested_at_utc": ingested}))


def _record(i, **kw):
    return {"service_request_id": str(i), "service_name": "Pothole", "status": "Open", "requested_datetime": "2024-01-01T10:00:00Z"} | kw


def test_bronze_and_silver_keep_every_batch(spark, tmp_path, static_overwrite):
    bronze, silver, mapping = (scratch_path(spark, n) for n in ("bronze-job", "silver-job2", "mapping"))
    fixtures.category_mapping(spark).coalesce(1).write.option("header", True).csv(mapping)
    day1, day2 = tmp_path / "one", tmp_path / "two"
    _land(day1, "01", "boston", "2024-01-01T11:00:00Z", [_record(1, latitude=42.3), _record(2, service_name="Unknown thing", requested_datetime="garbage", long=-71.1)])
    assert jobs.bronze_job(spark, str(day1), bronze, io.OPEN311_SCHEMA) == 2
    assert jobs.silver_job(spark, bronze, mapping, silver) == 2
    _land(day2, "02", "boston", "2024-01-01T15:00:00Z", [_record(3)])   # a second batch of the same day
    _land(day2, "03", "chicago", "2024-01-02T15:00:00Z", [_record(4)])
    assert jobs.bronze_job(spark, str(day2), bronze, io.OPEN311_SCHEMA) == 2
    assert jobs.bronze_job(spark, str(day2), bronze, io.OPEN311_SCHEMA) == 2  # a re-run changes nothing
    assert jobs.silver_job(spark, bronze, mapping, silver, from_day="2024-01-01") == 4
    rows = {r.service_request_id: r for r in spark.read.parquet(silver).collect()}
    assert sorted(rows) == ["1", "2", "3", "4"] and {r.batch_id for r in rows.values()} == {"01", "02", "03"}
    assert rows["1"].normalized_category == "Road Infrastructure" and rows["1"].lat == 42.3
    assert rows["2"].normalized_category == "Other" and rows["2"].requested_at_utc is None and rows["2"].lon == -71.1


def test_landing_faults_fail_by_name(spark, tmp_path):
    lost = tmp_path / "lost"
    _land(lost, "b1", "boston", "2024-01-01T11:00:00Z", [_record(1)])
    _land(lost, "b2", "boston", "2024-01-01T11:00:00Z", [_record(2)], manifest=False)
    with pytest.raises(Exception, match="without a manifest, batch b2"):
        jobs.bronze_job(spark, str(lost), scratch_path(spark, "never"), io.OPEN311_SCHEMA)
    twice = tmp_path / "twice"
    _land(twice / "x", "b1", "boston", "2024-01-01T11:00:00Z", [_record(1)])
    _land(twice / "y", "b1", "boston", "2024-01-01T12:00:00Z", [_record(1)])
    with pytest.raises(ValueError, match="more than one for a batch: b1"):
        jobs.bronze_job(spark, str(twice), scratch_path(spark, "never"), io.OPEN311_SCHEMA)
    single = tmp_path / "single"
    _land(single, "b1", "boston", "2024-01-01T11:00:00Z", _record(1))
    with pytest.raises(ValueError, match="not a JSON list"):
        jobs.bronze_job(spark, str(single), scratch_path(spark, "never"), io.OPEN311_SCHEMA)
    with pytest.raises(ValueError, match="not a JSON list"):
        io.read_json_batch(spark, str(single / "city=boston" / "batch_id=b1" / "response.json"), io.OPEN311_SCHEMA)


def test_json_lines_of_another_day_stay(spark, static_overwrite):
    root = scratch_path(spark, "landing")
    df = spark.createDataFrame([("a", "2024-01-01", 1)], "source string, date string, x int")
    io.write_jsonl(df, root, ["source", "date"])
    io.write_jsonl(df.withColumn("date", F.lit("2024-01-02")), root, ["source", "date"])
    assert spark.read.json(root).count() == 2


def test_tsv_rows_do_not_depend_on_the_columns_asked_for(spark, tmp_path):
    line = lambda n, day="20240101": "\t".join([f"id{n}", day] + ["x"] * (n - 2))
    path = tmp_path / "export.tsv"
    path.write_text("\n".join([line(58), line(57), line(59), line(10), "", '"q ""r"""\t20240101']) + "\n")
    read = io.read_news_tsv(spark, str(path))
    assert read.count() == 4 == read.select("SQLDATE").count() == len(read.collect())
    rows = {r.GLOBALEVENTID: r for r in read.collect()}
    assert set(rows) == {"id58", "id57", "id10", 'q "r"'} and rows["id57"].SOURCEURL is None and rows["id58"].SOURCEURL == "x"


def test_hot_partition_is_split_over_files(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "256k")
    try:
        root = scratch_path(spark, "hot-day")
        io.write_partitioned(spark.range(400_000).select(F.lit("d").alias("day"), F.xxhash64("id").alias("v")), root, ["day"])
    finally:
        spark.conf.set(key, before)
    assert len(spark.read.parquet(root).inputFiles()) > 1 and spark.read.parquet(root).count() == 400_000


def test_merge_keeps_text_keys_and_reports_unreadable_tables(spark, tmp_path, static_overwrite):
    root = scratch_path(spark, "merge-text")
    rows = lambda v: spark.createDataFrame([("1", "01", v), ("1", "01", v - 1), ("2", "1", v)], "k string, m string, v int")
    mg.merge_into_path(spark, root, rows(1), ["k"], ["m"], ("v",))
    mg.merge_into_path(spark, root, rows(5).filter("m = '01'"), ["k"], ["m"], ("v",))
    got = {(r.k, r.m, r.v) for r in spark.read.schema("k string, m string, v int").parquet(root).collect()}
    assert got == {("1", "01", 5), ("2", "1", 1)}
    broken = tmp_path / "broken" / "m=01"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_text("this is no parquet file")
    with pytest.raises(Exception):
        mg.merge_into_path(spark, str(tmp_path / "broken"), rows(1), ["k"], ["m"])
    assert (broken / "part-0.parquet").read_text().startswith("this is no")


def test_ingest_jobs_are_idempotent(spark, tmp_path, static_overwrite):
    export = tmp_path / "export.tsv"
    line = lambda i, city, tone, root: "\t".join(
        {"GLOBALEVENTID": str(i), "SQLDATE": "20240101", "EventRootCode": root, "AvgTone": str(tone), "NumMentions": "3",
         "NumSources": "1", "NumArticles": "2", "GoldsteinScale": "1", "ActionGeo_FullName": city}.get(c, "") for c in io.NEWS_COLUMNS)
    export.write_text("\n".join([line(1, "Boston, MA", -2, "14"), line(2, "boston", 4, "01"), line(3, "Paris", 9, "01")]))
    root, events = scratch_path(spark, "news"), scratch_path(spark, "events")
    for _ in range(2):
        table = {(r.city, str(r.obs_date)): r for r in jobs.news_job(spark, str(export), ["boston", "chicago"], events, root).collect()}
        assert len(table) == 2 and table["boston", "2024-01-01"].avg_tone == 1.0 and table["boston", "2024-01-01"].protest_event_count == 1
        assert table["chicago", "2024-01-01"].num_articles == 0 and io.read_news_csv(spark, events).count() == 2
    log = scratch_path(spark, "runs")
    runs = fixtures.run_events(spark, SMALL_SF).filter("stopDate is not null")
    n = jobs.run_log_job(spark, runs, log).count()
    assert jobs.run_log_job(spark, runs, log).count() == n == runs.count()
    alerts = scratch_path(spark, "alerts")
    feats = fixtures.alert_features(spark, SMALL_SF)
    collections = feats.groupBy("city", "obs_date").agg(F.collect_list(F.struct("id", "properties")).alias("features"))
    assert jobs.alerts_job(spark, collections, alerts).count() == feats.count() == jobs.alerts_job(spark, feats, alerts).count()
    requests = scratch_path(spark, "requests")
    raw = fixtures.open311_api_rows(spark, SMALL_SF)
    n = jobs.requests_job(spark, raw, "boston", requests).count()
    assert n == raw.filter("service_request_id is not null").count() == jobs.requests_job(spark, raw, "boston", requests).count()
    weather = scratch_path(spark, "weather")
    obs, tall = fixtures.observation_features(spark, SMALL_SF), fixtures.daily_values(spark, SMALL_SF)
    n = jobs.weather_job(spark, obs, tall, weather).count()
    assert n == jobs.weather_job(spark, obs, tall, weather).count() > 0


def test_serving_a_city_without_scores(spark):
    runs = daily.runs(spark, SMALL_SF)
    none = daily.scores(spark, SMALL_SF).limit(0)
    cities = daily.city_list(spark)
    assert {r.city for r in sv.last_updated(runs, none, cities).collect()} == set(daily.CITIES)
    assert {r.last_updated for r in sv.last_updated(runs.limit(0), none, cities).collect()} == {"N/A"}
    rows = sv.latest_composite(none, cities).collect()
    assert {r.city for r in rows} == set(daily.CITIES) and all((r.composite, r.delta, r.readiness_mode) == (0.0, 0.0, "Normal") for r in rows)


def _export(spark, rows):
    path = scratch_path(spark, "export")
    spark.createDataFrame([("\t".join(r.get(c, "") for c in io.NEWS_COLUMNS),) for r in rows], "value string").coalesce(1).write.text(path)
    return path


def test_news_lines_are_cut_once_and_read_once(spark):
    event = {"GLOBALEVENTID": "1", "SQLDATE": "20240101", "EventRootCode": "14", "NumMentions": "3", "ActionGeo_FullName": "Boston, MA"}
    path = _export(spark, [event, event | {"SQLDATE": "20240102", "ActionGeo_FullName": "Paris"}, event | {"SQLDATE": "soon"}])
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    events = nw.coerce(io.read_news_tsv(spark, path))
    matched = nw.match_cities(nw.with_obs_date(events), ["boston", "chicago"])
    assert plan(matched).count("split(") <= 2  # one for lines with a quote, one for the others
    assert {(r.city, str(r.obs_date)) for r in matched.collect()} == {("boston", "2024-01-01"), ("boston", "None")}
    days = nw.rollup_with_empty_days(events, ["boston", "chicago"])
    assert plan(days).count("Relation [") == 1
    assert {(r.city, str(r.obs_date), r.protest_mention_sum) for r in days.collect()} == {
        ("boston", "2024-01-01", 3), ("boston", "2024-01-02", 0), ("chicago", "2024-01-01", 0), ("chicago", "2024-01-02", 0), ("boston", "None", 3)}


def test_news_csv_is_packed_and_reads_back(spark):
    rows = [("2024-01-01", "boston", *['a "b", c' if i % 2 else None for i in range(len(io.NEWS_COLUMNS))])]
    table = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ("obs_date", "city", *io.NEWS_COLUMNS)))
    root = scratch_path(spark, "packed")
    io.write_news_csv(table.withColumn("obs_date", F.to_date("obs_date")), root)
    back = io.read_news_csv(spark, root)
    assert all(f.endswith(".csv.gz") for f in back.inputFiles())
    assert [tuple(r) for r in back.select("city", *io.NEWS_COLUMNS).collect()] == [rows[0][1:]]
