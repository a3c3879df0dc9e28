"""Batch jobs a user runs, each as one Spark application for every city and date at once.

Outputs are written with dynamic partition overwrite or keyed merges, so a re-run for
the same input replaces exactly what it recomputes. Counts that a job returns are those
of the rows it wrote in this run.
"""
from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metroscope.operators import baselines as bl
from metroscope.operators import collectors as co
from metroscope.operators import lake as lk
from metroscope.operators import ledger as lg
from metroscope.operators import merge as mg
from metroscope.operators import news as nw
from metroscope.operators import staged
from metroscope.plans import daily
from metroscope.plans import update as up
from metroscope.session import remove_scratch, scratch_path
from metroscope.sources import io

INGEST_PARTITIONS = ["ingest_year", "ingest_month", "ingest_day", "city"]
BRONZE_PARTITIONS = ["year", "month", "day", "city", "batch_id"]
SILVER_PARTITIONS = ["year", "month", "day", "city"]
MONTH_TAILS = "_tails"  # beside the daily news table


# ---------------------------------------------------------------- lake path


def bronze_job(spark: SparkSession, landing_root: str, bronze_root: str, record_schema: T.StructType) -> int:
    """The landing folders (``batch_id=<id>/response.json`` beside ``manifest.json``,
    at any depth) -> flattened bronze records (P1) as JSON lines under
    year/month/day/city/batch_id (S3, S4). Batches written before stay."""
    raw, manifests = io.read_landing(spark, landing_root, record_schema)
    bronze = lk.flatten_records(raw, manifests, manifests.count())
    rows = lk.bronze_partition_columns(bronze.withColumn("ingested_at_utc", F.to_timestamp("ingested_at_utc")))
    stage = scratch_path(spark, "bronze")
    try:
        rows.write.parquet(stage)  # the records are flattened once, for the count and the write
        staged = spark.read.schema(rows.schema).parquet(stage)
        io.write_jsonl(staged, bronze_root, BRONZE_PARTITIONS)
        return staged.count()
    finally:
        remove_scratch(spark, stage)


def _bronze_schema() -> T.StructType:
    keys = [T.StructField(c, T.StringType()) for c in BRONZE_PARTITIONS]
    return T.StructType([*lk.BRONZE_SCHEMA.fields, *keys])


def _day(*cols: str) -> Column:
    return F.make_date(*[F.col(c).cast("int") for c in cols])


def silver_job(spark: SparkSession, bronze_root: str, mapping_csv: str, silver_root: str, from_day: str | None = None) -> int:
    """Bronze JSON lines (S3, FAILFAST) + mapping CSV (S10) -> silver parquet
    partitioned by ingest day and city. A bad line fails the job, named by file and line.

    Every partition it writes is rebuilt from **all** bronze rows of that day and city, so
    a later batch of a day never erases an earlier one (Q3). ``from_day`` (yyyy-mm-dd) limits
    the run to ingest days from there on; partition pruning keeps the rest unread."""
    bronze = io.read_jsonl(spark, bronze_root, _bronze_schema())  # explicit: text keys such as 01 stay text
    if from_day:
        bronze = bronze.filter(_day("year", "month", "day") >= F.lit(from_day).cast("date"))
    mapping = io.read_mapping_csv(spark, mapping_csv)
    silver = lk.to_silver(bronze, mapping, mapping.count())
    try:
        io.write_partitioned(silver, silver_root, SILVER_PARTITIONS)
    except (PySparkException, Py4JError):
        io.require_json_lines(spark, bronze_root, _bronze_schema())  # says which line, if that was it
        raise
    return bronze.count()


def aggregate_job(spark: SparkSession, silver_path: str, hourly_root: str, daily_root: str, category_root: str,
                  from_day: str | None = None, state_root: str | None = None) -> dict[str, int]:
    """Silver parquet -> hourly, daily and category-hourly aggregates (S6, P8, F5, Q20,
    A1-A4, S7). Silver is read once, into the small cell table behind all three.

    ``from_day`` reads the ingest days from there on. A request delivered again then moves
    from the count of its earlier day, however old, to that of the later one: the delivery
    ledger under ``state_root`` (beside the hourly table unless given) knows where it counted
    (``operators.ledger``). Any sequence of runs that read every day equals one full run."""
    silver = io.read_parquet_required(spark, silver_path, lk.SILVER_REQUIRED, "Silver input")
    if from_day:
        silver = silver.filter(_day("year", "month", "day") >= F.lit(from_day).cast("date"))
    state = state_root or f"{hourly_root.rstrip('/')}/_state"
    outputs = (hourly_root, daily_root, category_root)
    run = lg.apply_deliveries(spark, silver, state, outputs, whole=from_day is None)
    names = ("hourly", "daily", "category_hourly")
    return {n: spark.read.parquet(r).count() for n, r in zip(names, outputs)} | run


def baseline_job(spark: SparkSession, hourly_root: str, out_root: str, lookback_hours: int = bl.DEFAULT_LOOKBACK_HOURS,
                 min_points: int = bl.DEFAULT_MIN_POINTS, output_partitions: int = 0, from_day: str | None = None) -> dict[str, int]:
    """Hourly aggregates -> trailing baselines (S6, Q4 re-sum, W1-W5, P10, A15, S7).

    With ``from_day`` only hours from there on are written; only the history that their
    windows reach is read (an hour is never ingested before it happened, so the ingest
    partitions prune). ``output_partitions`` 0 clusters by partition."""
    hourly = io.read_parquet_required(spark, hourly_root, bl.HOURLY_REQUIRED, "Hourly aggregate input")
    start = F.lit(from_day).cast("timestamp") if from_day else None
    if start is not None:
        reach = start - F.make_interval(hours=F.lit(lookback_hours))
        hourly = hourly.filter((F.col("window_start") >= reach)
                               & (_day("ingest_year", "ingest_month", "ingest_day") >= F.to_date(reach)))
    out = bl.hourly_baselines(hourly, lookback_hours, min_points)
    if start is not None:
        out = out.filter(F.col("window_start") >= start)
    path = scratch_path(spark, "baselines")
    try:
        out.write.parquet(path)
        out = spark.read.schema(out.schema).parquet(path)
        if out.isEmpty():
            raise RuntimeError("the hourly input has no row with a readable hour")
        bl.assert_unique_city_windows(out)
        io.write_partitioned(out, out_root, INGEST_PARTITIONS, output_partitions or None)
        return out.agg(F.count(F.lit(1)).alias("rows"), F.count_if("baseline_is_valid").alias("valid")).first().asDict()
    finally:
        remove_scratch(spark, path)


# ---------------------------------------------------------------- daily path


def daily_job(spark: SparkSession, requests: DataFrame, weather: DataFrame, alerts: DataFrame, news: DataFrame,
              stations: DataFrame, out_root: str, start: str | None = None, end: str | None = None) -> dict[str, DataFrame]:
    """E5-E9 + E17 on a user's own tables (``requests_311``, ``weather_daily``, ``nws_alerts``,
    ``gdelt_daily`` and the station -> city dimension): scores, metric cards and verdicts of
    all dates, or of ``start`` to ``end`` (both included), merged by key into
    ``out_root/<table>``, which is partitioned by city and month.

    Reads the raw tables whole and keeps their folded days beside the outputs; a later run for
    some changed days is ``update.update_job``, which reads only their raw partitions."""
    latest = mg.resolution_hours(mg.keep_latest(requests, ["city", "service_request_id"], ["updated_datetime"]))
    di = daily.inputs_of(spark, latest, weather, alerts, news, stations)
    up.keep_days(spark, out_root, di.days, di.alert_daily)

    def window(df: DataFrame, date: str) -> DataFrame:
        if start:
            df = df.filter(F.col(date) >= F.lit(start).cast("date"))
        return df.filter(F.col(date) <= F.lit(end).cast("date")) if end else df

    return up.merge_outputs(spark, out_root, window(daily.scores_of(di), "score_date"), window(daily.cards_of(di), "metric_date"))


# ---------------------------------------------------------------- ingest jobs


def news_job(spark: SparkSession, export_path: str, cities: Sequence[str], events_root: str, news_root: str) -> DataFrame:
    """The daily news export (S8) -> city events as CSV (S9) and the daily news table
    (P6, F2-F4, A6), merged so that a known day keeps its polarity (M2) and the 7-day tone is
    set anew on the days it covers (M5, W6).

    Stored by city and month. Beside the table stand each month's row count and last six
    tones (``news.month_tails``), so a run reads and writes only the months of its own days and
    those their six following rows reach; all other files stay as they are."""
    events = nw.coerce(io.read_news_tsv(spark, export_path))
    io.write_news_csv(nw.match_cities(nw.with_obs_date(events), cities).select("obs_date", "city", *io.NEWS_COLUMNS), events_root)
    news_root = news_root.rstrip("/")
    staged.recover(spark, news_root)
    path = scratch_path(spark, "news-days")
    try:
        days = nw.rollup_with_empty_days(events, cities).withColumns(
            {"avg_tone_7d": F.lit(None).cast("double"), "polarity": F.lit(None).cast("double"), "month": F.date_format("obs_date", "yyyy-MM")})
        days.filter("obs_date is not null").write.parquet(path)
        batch = spark.read.schema(days.schema).parquet(path)
        if not batch.isEmpty():
            stored = staged.stored(spark, news_root, batch)
            tails = staged.stored(spark, f"{news_root}/{MONTH_TAILS}", nw.month_tails(batch))
            if stored is not None and tails is None:
                tails = nw.month_tails(stored)  # a table from before the tails were kept
            rows, new_tails = nw.rewritten_months(stored, tails, batch)
            staged.commit(spark, news_root, [
                staged.Change("rows", news_root, ("city", "month"), rows),
                staged.Change("tails", f"{news_root}/{MONTH_TAILS}", ("city",), new_tails)])
    finally:
        remove_scratch(spark, path)
    return spark.read.schema(days.schema).parquet(news_root)


def weather_job(spark: SparkSession, observations: DataFrame, daily_values: DataFrame, weather_root: str) -> DataFrame:
    """Station observations (P5, F6, A5), the daily climate values where a day has none
    (A12, P12, J4), merged by station and day (M1)."""
    primary = daily.materialize(spark, co.weather_from_observations(co.parse_observations(observations)), "observations")
    fallback = co.weather_from_daily_values(co.pivot_daily_values(daily_values))
    rows = co.prefer_primary(primary, fallback).withColumn("month", F.date_format("obs_date", "yyyy-MM"))
    mg.merge_into_path(spark, weather_root, rows, ["station_id", "obs_date"], ["month"])
    return spark.read.parquet(weather_root)


def alerts_job(spark: SparkSession, collections: DataFrame, alerts_root: str) -> DataFrame:
    """Feature collections (one row each: ``city``, ``obs_date``, ``features`` array) or
    single features -> alert rows (P4), merged by alert id (M1): an alert that is seen again in
    another month moves there."""
    features = co.explode_features(collections) if "features" in collections.columns else collections
    rows = co.parse_alerts(features).withColumn("month", F.date_format("obs_date", "yyyy-MM"))
    mg.merge_into_path(spark, alerts_root, rows, ["alert_id"], ["month"], ["obs_date"], moving=True)
    return spark.read.parquet(alerts_root)


def requests_job(spark: SparkSession, records: DataFrame, city: str, requests_root: str, socrata: bool = False) -> DataFrame:
    """Service requests of one source (P2, or P3 for Socrata rows), the latest delivery
    of an id, merged by city and id (M1), resolution hours set (M4). Stored by request month;
    a request whose request time changes moves to its new month."""
    parsed = (co.parse_socrata if socrata else co.parse_requests)(records).withColumns(
        {c: F.col(c).try_cast("timestamp") for c in ("requested_datetime", "updated_datetime")})
    rows = mg.resolution_hours(parsed).withColumns(
        {"city": F.lit(city), "month": F.ifnull(F.date_format("requested_datetime", "yyyy-MM"), F.lit("unknown"))})
    mg.merge_into_path(spark, requests_root, rows, ["city", "service_request_id"], ["city", "month"], ["updated_datetime"], moving=True)
    return spark.read.parquet(requests_root)


def run_log_job(spark: SparkSession, events: DataFrame, log_root: str, now: Column | None = None) -> DataFrame:
    """Pipeline status events (P11) added to the run log. An execution's status is logged
    once: of repeats in the batch the latest run time counts, and one that is there already is
    not added again. The new rows are put in place in one step, by partition of the run's
    month, so a run that dies half-way leaves nothing or everything."""
    rows = co.normalize_runs(events, now).withColumn("month", F.date_format("run_at", "yyyy-MM"))
    keys = ["execution_arn", "status"]
    log_root = log_root.rstrip("/")
    staged.recover(spark, log_root)
    path = scratch_path(spark, "run-log")
    try:
        mg.keep_latest(rows, keys, ["run_at"]).write.parquet(path)
        once = spark.read.schema(rows.schema).parquet(path)
        log = staged.stored(spark, log_root, rows)
        if log is not None:
            known = log.select(*keys)
            fresh = once.join(known, staged.same(once, known, keys), "left_anti")
            months = fresh.select("month").distinct()
            once = staged.in_scope(log, months, ["month"]).unionByName(fresh)
        staged.commit(spark, log_root, [staged.Change("runs", log_root, ("month",), once)])
    finally:
        remove_scratch(spark, path)
    return spark.read.parquet(log_root)
