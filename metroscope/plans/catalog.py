"""Query catalog used by ``__spark_entry__``: name -> (spark, sf_dir) -> DataFrame.

Every entry reads the given tables (through ``metroscope.sources.fixtures``) in full.
Names follow the SURVEY operator ids.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metroscope.operators import baselines as bl
from metroscope.operators import lake as lk
from metroscope.plans import lake
from metroscope.plans.common import finish
from metroscope.sources import fixtures, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn

    return deco


# ---------------------------------------------------------------- lake path


@query("j1_category_mapping")
def j1_category_mapping(spark, sf):
    s = lake.silver(spark, sf)
    return finish(s.select("service_request_id", "service_name", "raw_category", "normalized_category",
                           "is_infrastructure", "is_emergency_type"))


@query("a1_hourly")
def a1_hourly(spark, sf):
    return finish(lk.sorted_for_read(lake.hourly(spark, sf)))


@query("a2_daily")
def a2_daily(spark, sf):
    return finish(lk.sorted_for_read(lake.daily(spark, sf)))


@query("a3_category_hourly")
def a3_category_hourly(spark, sf):
    return finish(lk.sorted_for_read(lake.category_hourly(spark, sf), "normalized_category"))


@query("w1_baseline_168h")
def w1_baseline_168h(spark, sf):
    out = lake.hourly_baselines(spark, sf)
    return finish(out.drop("baseline_computed_at_utc"))


@query("a15_duplicate_keys")
def a15_duplicate_keys(spark, sf):
    """Duplicate (city, hour) keys in the raw hourly output (one hour ingested on two days, Q4)."""
    return finish(bl.duplicate_city_windows(lake.hourly(spark, sf)).withColumnRenamed("count", "n_rows"))


# ---------------------------------------------------------------- daily path

from metroscope.functions import verdict as vd  # noqa: E402
from metroscope.operators import cards as cd  # noqa: E402
from metroscope.operators import collectors as co  # noqa: E402
from metroscope.operators import merge as mg  # noqa: E402
from metroscope.operators import news as nw  # noqa: E402
from metroscope.operators import scoring as sc  # noqa: E402
from metroscope.operators import staged  # noqa: E402
from metroscope.operators import serving as sv  # noqa: E402
from metroscope.plans import daily  # noqa: E402


@query("w13_dedup_latest")
def w13_dedup_latest(spark, sf):
    """Re-delivered requests: every third order arrives again later with a new status."""
    base = fixtures.requests_daily(spark, sf)
    again = base.filter(F.col("service_request_id").cast("long") % 3 == 0).withColumns(
        {"status": F.lit("closed"), "updated_datetime": F.col("updated_datetime") + F.expr("INTERVAL 30 DAYS")}
    )
    return finish(mg.keep_latest(base.unionByName(again), ["service_request_id"], ["updated_datetime"]))


@query("m4_resolution_hours")
def m4_resolution_hours(spark, sf):
    return finish(daily.requests(spark, sf).select("service_request_id", "status", "resolution_hrs"))


@query("f2_city_filter")
def f2_city_filter(spark, sf):
    ev = nw.with_obs_date(nw.coerce(fixtures.news_events(spark, sf)))
    m = nw.match_cities(ev, fixtures.CITIES)
    return finish(m.select("city", "obs_date", "SOURCEURL", "EventRootCode", "AvgTone", nw.is_protest().alias("is_protest")))


@query("f2_many_cities")
def f2_many_cities(spark, sf):
    """F2 with every customer, nation and region as a name: matches per name through the gram
    index over the distinct geo texts."""
    m = nw.match_city_names(fixtures.place_events(spark, sf), fixtures.place_names(spark, sf))
    return finish(m.groupBy("city").agg(F.count(F.lit(1)).alias("events"), F.sum("l_orderkey").alias("order_sum"),
                                        F.sum("l_linenumber").cast("long").alias("line_sum")))


@query("a6_news_daily")
def a6_news_daily(spark, sf):
    return finish(daily.gdelt(spark, sf).drop("avg_tone_7d", "polarity"))


@query("w6_tone_7d")
def w6_tone_7d(spark, sf):
    return finish(daily.gdelt(spark, sf).select("city", "obs_date", "avg_tone", "avg_tone_7d"))


@query("a7_news_daily_distinct")
def a7_news_daily_distinct(spark, sf):
    ev = nw.with_obs_date(nw.coerce(fixtures.news_events(spark, sf)))
    return finish(nw.daily_rollup_distinct(nw.match_cities_strict(ev, fixtures.STRICT_GEO)))


@query("w7_anomaly_score")
def w7_anomaly_score(spark, sf):
    counts = daily.materialize(spark, cd.daily_counts(cd.request_days(daily.requests(spark, sf))), "request-counts")
    return finish(sc.anomaly_scores(counts).join(counts, ["city", "d"]))


@query("w8_heat_score")
def w8_heat_score(spark, sf):
    return finish(sc.heat_scores_by_station(daily.weather(spark, sf)))


@query("a13_alert_score")
def a13_alert_score(spark, sf):
    return finish(sc.alert_scores(daily.alerts(spark, sf)))


@query("e7_signal_scores")
def e7_signal_scores(spark, sf):
    return finish(daily.scores(spark, sf))


@query("w9_composite_baseline")
def w9_composite_baseline(spark, sf):
    return finish(daily.scores(spark, sf).select("city", "score_date", "composite", "composite_baseline_30d"))


@query("x7_readiness")
def x7_readiness(spark, sf):
    return finish(daily.scores(spark, sf).groupBy("city", "readiness_mode").agg(F.count(F.lit(1)).alias("days")))


@query("x10_primary_driver")
def x10_primary_driver(spark, sf):
    return finish(daily.scores(spark, sf).select("city", "score_date", vd.primary_driver().alias("primary_driver")))


@query("x11_verdict")
def x11_verdict(spark, sf):
    return finish(daily.verdicts(spark, sf))


# ---------------------------------------------------------------- cards and serving

from metroscope.operators import quality as qa  # noqa: E402


def _card_inputs(spark, sf):
    di = daily.inputs(spark, sf)
    return di.spine, di.days, di.weather, di.stations


@query("u2_metric_cards")
def u2_metric_cards(spark, sf):
    return finish(daily.cards(spark, sf))


@query("a9_open_backlog")
def a9_open_backlog(spark, sf):
    spine, days, _, _ = _card_inputs(spark, sf)
    return finish(cd.open_backlog(spine, days))


@query("a10_mean_close")
def a10_mean_close(spark, sf):
    return finish(cd.mean_close_hours(cd.request_days(daily.requests(spark, sf))))


@query("a11_top_category")
def a11_top_category(spark, sf):
    return finish(cd.top_category(cd.request_days(daily.requests(spark, sf))))


@query("w10_card_baseline")
def w10_card_baseline(spark, sf):
    """Card baselines with the 30-day option (Q6): delta and baseline of the three baseline cards."""
    c = daily.cards(spark, sf, baseline_rows=30)
    return finish(c.filter(F.col("metric_name").isin("open_backlog", "mean_close_hrs", "tmax")))


@query("w11_heat_streak")
def w11_heat_streak(spark, sf):
    spine, _, wx, st = _card_inputs(spark, sf)
    return finish(cd.heat_streak(wx, cd.station_spine(spine, st)))


@query("w12_precip_72h")
def w12_precip_72h(spark, sf):
    spine, _, wx, st = _card_inputs(spark, sf)
    return finish(cd.precip_72h(wx, cd.station_spine(spine, st)))


@query("f7_latest_metrics")
def f7_latest_metrics(spark, sf):
    return finish(sv.latest_metrics(daily.cards(spark, sf)))


@query("x12_delta_label")
def x12_delta_label(spark, sf):
    c = daily.cards(spark, sf).filter(F.col("delta_pct").isNotNull())
    return finish(c.select("city", "metric_date", "metric_name", vd.delta_label(F.col("delta_pct")).alias("delta_label"),
                           vd.delta_class(F.col("delta_pct")).alias("delta_class")))


@query("x13_display_value")
def x13_display_value(spark, sf):
    c = daily.cards(spark, sf)
    return finish(c.select("city", "metric_date", "metric_name", vd.display_value(F.col("value_text"), F.col("value_num")).alias("display")))


@query("t4_composite_delta")
def t4_composite_delta(spark, sf):
    return finish(sv.newest_first(sv.composite_view(daily.scores(spark, sf))))


@query("e10_latest_composite")
def e10_latest_composite(spark, sf):
    return finish(sv.latest_composite(daily.scores(spark, sf), daily.city_list(spark)))


@query("e10_latest_verdict")
def e10_latest_verdict(spark, sf):
    return finish(sv.latest_per_city(daily.verdicts(spark, sf), "verdict_date"))


@query("e10_last_updated")
def e10_last_updated(spark, sf):
    return finish(sv.last_updated(daily.runs(spark, sf), daily.scores(spark, sf), daily.city_list(spark)))


@query("j2_history_month")
def j2_history_month(spark, sf):
    di = daily.inputs(spark, sf)
    cw = daily.city_weather_of(di.weather, di.stations)
    return finish(sv.history_month(daily.scores(spark, sf, di), cw, di.gdelt, di.counts))


@query("j3_history_year")
def j3_history_year(spark, sf):
    di = daily.inputs(spark, sf)
    cw = daily.city_weather_of(di.weather, di.stations)
    return finish(sv.history_year(daily.scores(spark, sf, di), cw, di.gdelt, di.counts))


# ---------------------------------------------------------------- merges


def _existing_and_new_requests(spark, sf):
    base = fixtures.requests_daily(spark, sf)
    key = F.col("service_request_id").cast("long")
    existing = base.filter(key % 2 == 0)
    new = base.filter((key % 3 == 0) | (key % 2 == 1)).withColumns(
        {"status": F.lit("closed"), "updated_datetime": F.col("updated_datetime") + F.expr("INTERVAL 1 DAY")}
    )
    return existing, new


@query("m1_upsert")
def m1_upsert(spark, sf):
    existing, new = _existing_and_new_requests(spark, sf)
    return finish(mg.upsert(existing, new, ["service_request_id"], ["updated_datetime"]))


def _existing_and_new_news(spark, sf):
    g = daily.materialize(spark, daily.gdelt(spark, sf), "news-days").withColumn("polarity", F.lit(0.25))
    dom = F.dayofmonth("obs_date")
    existing = g.filter(dom % 2 == 0)
    new = g.filter((dom % 3 == 0) | (dom % 2 == 1)).withColumns(
        {"num_articles": F.col("num_articles") + 1, "avg_tone_7d": F.lit(None).cast("double"),
         "polarity": F.lit(None).cast("double")}
    )
    return existing, new


@query("m2_partial_upsert")
def m2_partial_upsert(spark, sf):
    existing, new = _existing_and_new_news(spark, sf)
    return finish(mg.partial_upsert(existing, new, ["city", "obs_date"], ["avg_tone_7d", "polarity"]))


@query("m3_insert_absent")
def m3_insert_absent(spark, sf):
    existing, new = _existing_and_new_news(spark, sf)
    sentinel = new.select(
        "city", "obs_date", *[F.lit(None).cast("double").alias(c) for c in ("avg_tone", "avg_tone_7d", "polarity")],
        *[F.lit(0).alias(c) for c in ("protest_event_count", "protest_mention_sum", "num_articles", "source_count")],
        F.lit(None).cast("double").alias("goldstein_avg"),
    )
    return finish(mg.insert_absent(existing, sentinel, ["city", "obs_date"]))


# ---------------------------------------------------------------- collectors


@query("p2_parse_requests")
def p2_parse_requests(spark, sf):
    return finish(co.parse_requests(fixtures.open311_api_rows(spark, sf)))


@query("p3_parse_socrata")
def p3_parse_socrata(spark, sf):
    return finish(co.parse_socrata(fixtures.socrata_rows(spark, sf)))


@query("p4_alerts")
def p4_alerts(spark, sf):
    return finish(daily.alerts(spark, sf))


@query("p5_json_props")
def p5_json_props(spark, sf):
    return finish(co.parse_observations(fixtures.observation_features(spark, sf)))


@query("a5_weather_daily")
def a5_weather_daily(spark, sf):
    return finish(co.weather_from_observations(co.parse_observations(fixtures.observation_features(spark, sf))))


@query("a12_pivot_daily_values")
def a12_pivot_daily_values(spark, sf):
    return finish(co.pivot_daily_values(fixtures.daily_values(spark, sf)))


@query("j4_source_fallback")
def j4_source_fallback(spark, sf):
    obs = co.weather_from_observations(co.parse_observations(fixtures.observation_features(spark, sf)))
    cdo = co.weather_from_daily_values(co.pivot_daily_values(fixtures.daily_values(spark, sf)))
    return finish(co.prefer_primary(obs, cdo))


@query("p11_run_log")
def p11_run_log(spark, sf):
    """Run log rows; the insert clock used for events without a stop time is masked (null).
    ``duration_secs`` is nullable, so it leaves as double (one value type in every client)."""
    r = co.normalize_runs(fixtures.run_events(spark, sf), now=F.lit(None).cast("timestamp"))
    return finish(r.withColumn("duration_secs", F.col("duration_secs").cast("double")))


def _validation_counts(spark, sf):
    parts = [
        qa.validate_counts(daily.requests(spark, sf), "requests_311", F.to_date("requested_datetime")),
        qa.validate_counts(daily.weather(spark, sf), "weather_daily", F.col("obs_date")),
        qa.validate_counts(daily.gdelt(spark, sf), "gdelt_daily", F.col("obs_date")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("f1_validate_counts")
def f1_validate_counts(spark, sf):
    return finish(_validation_counts(spark, sf))


@query("d9_quality_report")
def d9_quality_report(spark, sf):
    return finish(qa.quality_report(_validation_counts(spark, sf)))


@query("d9_column_drift")
def d9_column_drift(spark, sf):
    """D-9 per column: nulls and drift of weather, requests and news. In the last three weather
    days every tmax reads 25 degrees higher - the row counts stay as they are."""
    wx = daily.weather(spark, sf)
    last = F.date_sub(F.lit(wx.agg(F.max("obs_date")).first()[0]), 2)
    wx = wx.withColumn("tmax", F.when(F.col("obs_date") >= last, F.col("tmax") + 25).otherwise(F.col("tmax")))
    profiles = [
        qa.column_profiles(wx, "weather_daily", F.col("obs_date"), {"tmax": 2.5, "heat_index_max": 5.0, "precip_6hr_max": 0.5}),
        qa.column_profiles(daily.requests(spark, sf), "requests_311", F.col("requested_datetime"), {"resolution_hrs": 24.0}, ["status", "service_name"]),
        qa.column_profiles(daily.gdelt(spark, sf), "gdelt_daily", F.col("obs_date"), {"avg_tone": 0.5}),
    ]
    return finish(qa.column_drift(profiles[0].unionByName(profiles[1]).unionByName(profiles[2])))


# ---------------------------------------------------------------- documented-only operators (D-1..D-10)

from metroscope.operators import geo  # noqa: E402
from metroscope.operators import media as md  # noqa: E402

# Article location names -> city keys.
LOCATION_TO_CITY = (("Boston", "boston"), ("Chicago", "chicago"), ("New York", "new york"))
# Zone polygons (lon, lat vertices in order) for the zone join.
ZONES = (
    ("Z1", [-71.495, -71.255, -71.255, -71.495], [42.255, 42.255, 42.495, 42.495]),
    ("Z2", [-71.245, -71.005, -71.245], [42.255, 42.255, 42.495]),
    ("Z3", [-71.495, -71.255, -71.205, -71.255, -71.495], [42.005, 42.005, 42.125, 42.245, 42.245]),
    ("Z4", [-71.195, -71.005, -71.005, -71.195], [42.005, 42.005, 42.245, 42.205]),
)


def _city_articles(spark, sf):
    return md.article_cities(md.theme_filter(fixtures.articles(spark, sf)), LOCATION_TO_CITY)


@query("d1_theme_filter")
def d1_theme_filter(spark, sf):
    a = md.theme_filter(fixtures.articles(spark, sf))
    return finish(a.select("SOURCEURL", "article_ts", "V2Themes", "STRESS_THEMES"))


@query("d2_article_city")
def d2_article_city(spark, sf):
    return finish(_city_articles(spark, sf).drop("article_ts"))


@query("d3_articles_15min")
def d3_articles_15min(spark, sf):
    return finish(md.articles_per_slice(_city_articles(spark, sf)))


@query("d4_tone_parse")
def d4_tone_parse(spark, sf):
    return finish(md.parse_tone(fixtures.articles(spark, sf)))


@query("d5_today_view")
def d5_today_view(spark, sf):
    return finish(sv.today_view(daily.requests(spark, sf), daily.weather(spark, sf), daily.stations(spark), daily.gdelt(spark, sf)))


@query("d6_zone_join")
def d6_zone_join(spark, sf):
    zones = spark.createDataFrame(list(ZONES), "zone_id string, xs array<double>, ys array<double>")
    pts = fixtures.bronze_requests(spark, sf).select("service_request_id", "lat", "lon")
    return finish(geo.assign_zones(pts, zones))


@query("d6_nested_zones")
def d6_nested_zones(spark, sf):
    """D-6 with zones from country to block size, districts with holes among them."""
    pts = fixtures.bronze_requests(spark, sf).select("service_request_id", "lat", "lon")
    return finish(geo.assign_zones(pts, fixtures.nested_zones(spark, sf)))


@query("d7_five_signals")
def d7_five_signals(spark, sf):
    out = md.five_signals(daily.gdelt(spark, sf), _city_articles(spark, sf), lake.daily(spark, sf),
                          sc.alert_scores(daily.alerts(spark, sf)))
    return finish(out)


@query("d8_score_window")
def d8_score_window(spark, sf, city: str = "boston", start: str = "1996-01-01", end: str = "1996-12-31"):
    """Scores for one city and a date window (the serving endpoint's parametrised filter)."""
    s = daily.scores(spark, sf, daily.inputs(spark, sf, city, end))
    return finish(s.filter((F.col("city") == city) & F.col("score_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))))


@query("d10_legacy_profile")
def d10_legacy_profile(spark, sf):
    di = daily.inputs(spark, sf)
    anomaly, heat = sc.anomaly_scores(di.counts), sc.heat_scores(di.weather, di.stations)
    context = sc.context_scores(di.gdelt)
    signals = sc.assemble(di.spine, anomaly, heat, di.alert_daily, context)
    return finish(sc.legacy_profile(signals, daily.city_weather_of(di.weather, di.stations), di.gdelt))


# ---------------------------------------------------------------- streaming (R1-R3, our extension)

from metroscope.session import scratch_path  # noqa: E402
from metroscope.streaming import hourly as hs  # noqa: E402


def _land_with_redeliveries(spark, sf):
    """Silver rows landed as files, plus a re-delivery of every 7th request (exact copies)."""
    silver = lake.silver(spark, sf)
    landing = scratch_path(spark, "landing")
    hs.land(silver, landing)
    hs.land(silver.filter(F.col("service_request_id").cast("long") % 7 == 0), landing)
    return landing, hs.stream_schema(silver)


@query("r1_stream_hourly")
def r1_stream_hourly(spark, sf):
    landing, schema = _land_with_redeliveries(spark, sf)
    # state store sized for the fixture-scale stream (a cluster job sizes it to its state)
    return finish(hs.run_hourly_pipeline(spark, landing, schema, state_partitions=8))


@query("r1_stream_late_rows")
def r1_stream_late_rows(spark, sf):
    """R1 over three triggers: the earlier half of the month, the later half with re-deliveries,
    and new requests far older than the watermark, which must not change any count."""
    silver = lake.silver(spark, sf)
    middle = silver.agg(F.date_trunc("day", F.timestamp_micros(
        ((F.unix_micros(F.min("requested_at_utc")) + F.unix_micros(F.max("requested_at_utc"))) / 2).cast("long")))).first()[0]
    early = F.col("requested_at_utc") < F.lit(middle)
    ids = F.col("service_request_id").cast("long")
    late = silver.filter((F.col("requested_at_utc") < F.lit(middle) - F.expr("INTERVAL 5 DAYS")) & (ids % 11 == 0))
    landing, target, checkpoint = (scratch_path(spark, n) for n in ("landing-late", "late-hourly", "late-checkpoint"))
    for batch in (silver.filter(early), silver.filter(~early).unionByName(silver.filter(~early & (ids % 7 == 0))),
                  late.withColumn("service_request_id", F.concat(F.lit("late-"), "service_request_id"))):
        hs.land(batch, landing)
        hs.run_hourly_stream(spark, landing, hs.stream_schema(silver), target, checkpoint, state_partitions=8)
    return finish(hs.merged_counts(spark, target))


@query("r1_resume")
def r1_resume(spark, sf):
    """R1-R3 resumed: the requests land in three parts by ingest day, each with re-deliveries of
    the day before it; the stream is started on the same checkpoint and target after each."""
    silver = lake.silver(spark, sf)
    day = F.to_date("ingested_at_utc")
    first, last = silver.agg(F.min(day), F.max(day)).first()
    third = (last - first) / 3
    cuts = [first, first + third, first + 2 * third, last + (last - first)]
    landing, target, checkpoint = (scratch_path(spark, n) for n in ("landing-resume", "resume-hourly", "resume-checkpoint"))
    for lo, hi in zip(cuts, cuts[1:]):
        part = silver.filter((day >= F.lit(lo)) & (day < F.lit(hi)))
        again = silver.filter((day == F.date_sub(F.lit(lo), 1)) & (F.col("service_request_id").cast("long") % 2 == 0))
        hs.land(part.unionByName(again), landing)
        hs.run_hourly_stream(spark, landing, hs.stream_schema(silver), target, checkpoint, delay="3 days", state_partitions=8)
    return finish(hs.merged_counts(spark, target))


@query("r2_two_cities")
def r2_two_cities(spark, sf):
    """R2 where two cities number their requests alike: every request also lands, under the
    same id, for a city of its own, and both are delivered twice."""
    silver = lake.silver(spark, sf)
    twin = silver.withColumn("city", F.concat(F.lit("twin of "), "city"))
    landing = scratch_path(spark, "landing-twins")
    for _ in range(2):
        hs.land(silver.unionByName(twin), landing)
    return finish(hs.run_dedup_pipeline(spark, landing, hs.stream_schema(silver), state_partitions=8))


@query("r2_stream_dedup")
def r2_stream_dedup(spark, sf):
    landing, schema = _land_with_redeliveries(spark, sf)
    return finish(hs.run_dedup_pipeline(spark, landing, schema, state_partitions=8))


# ---------------------------------------------------------------- sources and sinks on landed files

from pyspark.sql import types as T  # noqa: E402

from metroscope.sources import io  # noqa: E402

RAW_RECORD_SCHEMA = T.StructType([
    T.StructField(n, t) for n, t in (
        ("batch_id", T.StringType()), ("service_request_id", T.StringType()), ("status", T.StringType()),
        ("service_name", T.StringType()), ("service_code", T.StringType()), ("description", T.StringType()),
        ("requested_datetime", T.StringType()), ("updated_datetime", T.StringType()),
        ("closed_datetime", T.StringType()), ("address", T.StringType()), ("lat", T.DoubleType()),
        ("latitude", T.DoubleType()), ("long", T.DoubleType()), ("lon", T.DoubleType()),
        ("longitude", T.DoubleType()), ("media_url", T.StringType()),
    )
])
_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


@query("e1_bronze_jsonl")
def e1_bronze_jsonl(spark, sf):
    """Raw records landed as JSON lines (S3), manifests per batch (S2), flattened (P1),
    written partitioned by ingest day / city / batch (S4) and read back FAILFAST."""
    b = fixtures.bronze_requests(spark, sf)
    alt = F.col("service_request_id").cast("long") % 5 == 0
    raw = b.select(
        "batch_id", "service_request_id", "status", "service_name", "service_code", "description",
        F.date_format("requested_datetime", _ISO).alias("requested_datetime"),
        F.date_format("updated_datetime", _ISO).alias("updated_datetime"),
        F.date_format("closed_datetime", _ISO).alias("closed_datetime"), "address",
        F.when(~alt, F.col("lat")).alias("lat"), F.when(alt, F.col("lat")).alias("latitude"),
        F.when(~alt, F.col("lon")).alias("long"), F.when(alt, F.col("lon")).alias("longitude"), "media_url",
    )
    landing = scratch_path(spark, "raw-311")
    io.write_jsonl(raw, landing)
    manifest_root = scratch_path(spark, "manifests")
    b.select("city", "batch_id", F.date_format("ingested_at_utc", _ISO).alias("ingested_at_utc")).distinct().write.json(manifest_root)
    manifests = io.read_manifests(spark, manifest_root, one_document_per_file=False)
    n_manifests = manifests.count()  # one row per batch: the size check behind the broadcast
    bronze = lk.flatten_records(io.read_jsonl(spark, landing, RAW_RECORD_SCHEMA), manifests, n_manifests)
    out = scratch_path(spark, "bronze-311")
    io.write_jsonl(lk.bronze_partition_columns(bronze.withColumn("ingested_at_utc", F.to_timestamp("ingested_at_utc"))),
                   out, ["year", "month", "day", "city", "batch_id"])
    back = io.read_jsonl(spark, out, lk.BRONZE_SCHEMA)
    return finish(back.select(
        "source", "city", F.col("batch_id").cast("string").alias("batch_id"), F.col("service_request_id").cast("string").alias("service_request_id"),
        "status", "service_name", "service_code", F.col("lat").cast("double").alias("lat"),
        F.col("lon").cast("double").alias("lon"), F.to_timestamp("requested_datetime").alias("requested_datetime"),
    ))


_LINE_SCHEMA = T.StructType([T.StructField("service_request_id", T.LongType()), T.StructField("status", T.StringType())])


@query("s3_bad_lines")
def s3_bad_lines(spark, sf):
    """S3: requests as JSON lines in eight files, some lines cut short, some of the wrong type,
    some blank; every bad line is named by file and line, over splits of a few KB."""
    key = F.col("o_orderkey")
    good = F.to_json(F.struct(key.alias("service_request_id"), F.col("o_orderstatus").alias("status")))
    line = F.when(key % 97 == 0, F.substring(good, 1, 12)).when(key % 89 == 0, F.concat(F.lit('{"service_request_id":"x'), key.cast("string"), F.lit('"}'))).when(
        key % 31 == 0, F.lit("")).otherwise(good)
    rows = tables.read(spark, sf, "orders").select((key % 8).cast("int").alias("part"), "o_orderkey", line.alias("value"))
    root = scratch_path(spark, "json-lines")
    # partitioned writing keeps this order inside a file; each part is one task's
    rows.repartition(8, "part").sortWithinPartitions("part", "o_orderkey").select("part", "value").write.partitionBy("part").text(root)
    split = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(split)
    spark.conf.set(split, "16k")
    try:
        found = daily.materialize(spark, io.bad_json_lines(spark, root, _LINE_SCHEMA), "bad-lines")
    finally:
        spark.conf.set(split, before)
    return finish(found.select(F.regexp_extract("file", "part=([0-9]+)", 1).cast("int").alias("part"), "line", "text"))


@query("s1_json_arrays")
def s1_json_arrays(spark, sf):
    """Every batch landed as one JSON-array payload, read back with the payload check."""
    b = fixtures.bronze_requests(spark, sf)
    record = F.struct("service_request_id", "status", "service_name", "lat", F.col("lon").alias("long"),
                      F.date_format("requested_datetime", _ISO).alias("requested_datetime"))
    root = scratch_path(spark, "payloads")
    payloads = b.groupBy("batch_id").agg(F.to_json(F.collect_list(record)).alias("value"))  # a payload is one service response
    payloads.write.partitionBy("batch_id").text(root)
    back = io.read_json_batch(spark, root, io.OPEN311_SCHEMA)
    return finish(back.select("service_request_id", "status", "service_name", "lat", "long", F.to_timestamp("requested_datetime").alias("requested_datetime")))


def _some_unreadable(rows: DataFrame) -> DataFrame:
    """Request and ingest times as text, some empty, blank or garbage."""
    eid = F.col("service_request_id").cast("long")
    spoil = lambda c, n: F.when(eid % n == 0, F.lit("")).when(eid % n == 1, F.lit("garbage")).when(
        eid % n == 2, F.lit("  ")).otherwise(F.date_format(c, _ISO))
    return rows.withColumns({"requested_at_utc": spoil("requested_at_utc", 29), "ingested_at_utc": spoil("ingested_at_utc", 37)})


@query("f5_unreadable_times")
def f5_unreadable_times(spark, sf):
    """silver rows whose request or ingest time cannot be read take no part in the counts."""
    facts = lk.request_facts(_some_unreadable(lake.silver(spark, sf)))
    return finish(lk.hourly(lk.category_cells(lk.latest_deliveries(facts))))


@query("e2_two_batches")
def e2_two_batches(spark, sf):
    """E2 twice: half of every day's requests are in a first batch, silver is built, then a second
    batch of the same days lands and silver is built again."""
    b = fixtures.bronze_requests(spark, sf)
    bronze, silver, mapping = (scratch_path(spark, n) for n in ("two-bronze", "two-silver", "two-mapping"))
    fixtures.category_mapping(spark).coalesce(1).write.option("header", True).csv(mapping)
    second = F.col("service_request_id").cast("long") % 2 == 1
    for rows, number in ((b.filter(~second), "-1"), (b.filter(second), "-2")):
        stamped = rows.withColumns({"batch_id": F.concat("batch_id", F.lit(number)), "raw_payload": F.lit(None).cast("string")} | {
            c: F.date_format(c, _ISO) for c in ("requested_datetime", "updated_datetime", "closed_datetime")})
        io.write_jsonl(lk.bronze_partition_columns(stamped), bronze, jobs.BRONZE_PARTITIONS)
        jobs.silver_job(spark, bronze, mapping, silver)
    back = io.read_parquet_required(spark, silver, lk.SILVER_REQUIRED, "Silver input")
    return finish(back.select("service_request_id", "city", "batch_id", "normalized_category", "is_infrastructure", "is_emergency_type", "requested_at_utc"))


@query("e12_news_tsv")
def e12_news_tsv(spark, sf):
    """E12 on files: the export landed as headerless 58-column TSV (S8), city rows written
    as CSV by day (S9), then P6 / F2 / F4 / A6 / W6 into the daily news table."""
    ev = fixtures.news_events(spark, sf)
    full = ev.select(*[(F.col(c).cast("string") if c in ev.columns else F.lit(None).cast("string")).alias(c)
                       for c in io.NEWS_COLUMNS])
    landing = scratch_path(spark, "news-tsv")
    full.write.option("sep", "\t").option("header", False).csv(landing)
    read = io.read_news_tsv(spark, landing)
    matched = nw.match_cities(nw.with_obs_date(nw.coerce(read)), fixtures.CITIES)
    io.write_news_csv(matched.select("obs_date", "city", *io.NEWS_COLUMNS), scratch_path(spark, "news-csv"))
    return finish(nw.gdelt_daily(read, fixtures.CITIES))


@query("s9_news_csv")
def s9_news_csv(spark, sf):
    """City events written as CSV with all export columns under ``obs_date=`` and read back."""
    ev = fixtures.news_events(spark, sf)
    full = ev.select(*[(F.col(c).cast("string") if c in ev.columns else F.lit(None).cast("string")).alias(c)
                       for c in io.NEWS_COLUMNS])
    matched = nw.match_cities(nw.with_obs_date(full), fixtures.CITIES)
    events = scratch_path(spark, "news-csv")
    io.write_news_csv(matched.select("obs_date", "city", *io.NEWS_COLUMNS), events)
    back = io.read_news_csv(spark, events)
    return finish(back.select("obs_date", "city", "SQLDATE", "EventRootCode", "ActionGeo_FullName", "Actor2Geo_FullName", "SOURCEURL"))


@query("s6_silver_roundtrip")
def s6_silver_roundtrip(spark, sf):
    """S5 + S7 + S6: silver written as parquet partitioned by ingest day and city (dynamic
    overwrite), read back with the required-column check."""
    s = lake.silver(spark, sf)
    root = scratch_path(spark, "silver")
    io.write_partitioned(lk.bronze_partition_columns(s), root, ["year", "month", "day", "city"])
    back = io.read_parquet_required(spark, root, lk.SILVER_REQUIRED, "Silver input")
    return finish(back.select("service_request_id", "city", "batch_id", "normalized_category", "is_infrastructure",
                              "is_emergency_type", "requested_at_utc", "ingested_at_utc"))


@query("s10_mapping_csv")
def s10_mapping_csv(spark, sf):
    """The category mapping read from CSV (header + schema check) drives J1."""
    path = scratch_path(spark, "mapping-csv")
    fixtures.category_mapping(spark).coalesce(1).write.option("header", True).csv(path)
    mapping = io.read_mapping_csv(spark, path)
    s = lk.to_silver(fixtures.bronze_requests(spark, sf), mapping, mapping_rows=len(fixtures.CATEGORY_MAPPING))
    return finish(s.groupBy("normalized_category", "is_infrastructure", "is_emergency_type").agg(F.count(F.lit(1)).alias("n")))


@query("s12_date_range")
def s12_date_range(spark, sf, start: str = "1996-01-01", end: str = "1996-02-01"):
    """One window of request days as a range predicate on the raw timestamp (the
    predicate reaches the parquet scan as a pushed filter)."""
    o = tables.read(spark, sf, "orders")
    window = io.date_range_filter(o, "o_orderdate", F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"))
    return finish(window.select(F.col("o_orderkey").cast("string").alias("service_request_id"),
                                F.col("o_orderdate").alias("requested_datetime")))


@query("a16_run_summary")
def a16_run_summary(spark, sf):
    """Row counts of the three aggregates and the number of valid baselines, all from the
    one written cell table."""
    cells = daily.materialize(spark, lake.cells(spark, sf), "lake-cells")
    h, d, c = lk.hourly(cells), lk.daily(cells), lk.category_hourly(cells)
    b = bl.hourly_baselines(h)
    parts = [
        h.agg(F.count(F.lit(1)).alias("n")).select(F.lit("hourly_rows").alias("metric"), "n"),
        d.agg(F.count(F.lit(1)).alias("n")).select(F.lit("daily_rows").alias("metric"), "n"),
        c.agg(F.count(F.lit(1)).alias("n")).select(F.lit("category_hourly_rows").alias("metric"), "n"),
        b.agg(F.count_if("baseline_is_valid").alias("n")).select(F.lit("valid_baselines").alias("metric"), "n"),
    ]
    return finish(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]))


@query("t5_display_sample")
def t5_display_sample(spark, sf):
    """T5: the first 50 baseline rows by window (a top-k: TakeOrderedAndProject, no full sort)."""
    b = lake.hourly_baselines(spark, sf)
    return finish(b.orderBy("window_start", "city").limit(50).select(
        "city", "window_start", "total_requests_history_points", "infrastructure_requests_history_points",
        "emergency_ratio_history_points", "baseline_history_points", "baseline_is_valid"))


@query("f8_city_metrics")
def f8_city_metrics(spark, sf, city: str = "boston"):
    """F8: one city's cards on its newest metric date (scalar max, then filter)."""
    c = sv.latest_metrics(daily.cards(spark, sf, di=daily.inputs(spark, sf, city)))
    return finish(c.select("metric_name", "value_num", "value_text", "delta_pct", "baseline"))


@query("p7_timestamps")
def p7_timestamps(spark, sf):
    """The three 311 timestamps as landed text (ISO with Z; some empty, blank or garbage)
    parsed to UTC timestamps; anything unparsable becomes null."""
    b = fixtures.bronze_requests(spark, sf)
    eid = F.col("service_request_id").cast("long")

    def text(c):
        iso = F.date_format(c, _ISO)
        return F.when(eid % 13 == 0, F.lit("")).when(eid % 29 == 0, F.lit("garbage")).when(eid % 31 == 0, F.lit("   ")).otherwise(iso)

    raw = b.select("service_request_id", *[text(F.col(c)).alias(c) for c in ("requested_datetime", "updated_datetime", "closed_datetime")])
    from metroscope.functions.columns import parse_timestamp

    return finish(raw.select("service_request_id", *[parse_timestamp(F.col(c)).alias(c.replace("_datetime", "_at_utc"))
                                                     for c in ("requested_datetime", "updated_datetime", "closed_datetime")]))


@query("w4_baseline_validity")
def w4_baseline_validity(spark, sf):
    """W2 + W4: per-metric validity (count and std) and the overall count-only validity."""
    b = lake.hourly_baselines(spark, sf)
    return finish(b.select("city", "window_start", *[f"{m}_{x}" for m in bl.METRICS for x in ("history_points", "baseline_valid")],
                           "baseline_history_points", "baseline_is_valid"))


@query("s11_landing_json")
def s11_landing_json(spark, sf):
    """Raw payloads landed as JSON under ``source=/date=`` folders and read back."""
    b = fixtures.open311_api_rows(spark, sf)
    root = scratch_path(spark, "landing-json")
    rows = b.select(F.lit("open311").alias("source"), F.to_date("requested_datetime").alias("date"),
                    "service_request_id", "service_code", "status")
    io.write_jsonl(rows, root, ["source", "date"])
    back = io.read_jsonl(spark, root, T.StructType([rows.schema[c] for c in ("service_request_id", "service_code", "status", "source", "date")]))
    return finish(back.select(F.col("source").cast("string").alias("source"), F.col("date").cast("date").alias("date"),
                              "service_request_id", "service_code", "status"))


# ---------------------------------------------------------------- jobs over several runs

from metroscope.plans import jobs, update  # noqa: E402


@query("e3_incremental")
def e3_incremental(spark, sf):
    """E3 over three runs: silver lands by ingest day in three parts, some requests delivered
    again 2, 12 and 20 days later; each run reads only its own days (``from_day``), and the
    stored hourly table must hold what one run over everything holds."""
    mapping = fixtures.category_mapping(spark)
    rows = daily.materialize(spark, lk.bronze_partition_columns(lk.to_silver(
        fixtures.late_deliveries(spark, sf), mapping, mapping_rows=len(fixtures.CATEGORY_MAPPING))), "late-silver")
    day = F.to_date("ingested_at_utc")
    first, last = rows.agg(F.min(day), F.max(day)).first()
    third = (last - first) / 3
    cuts = [first, first + third, first + 2 * third, last + (last - first)]
    silver, *roots = (scratch_path(spark, f"e3-{n}") for n in ("silver", "hourly", "daily", "category"))
    for lo, hi in zip(cuts, cuts[1:]):
        io.write_partitioned(rows.filter((day >= F.lit(lo)) & (day < F.lit(hi))), silver, jobs.SILVER_PARTITIONS)
        jobs.aggregate_job(spark, silver, *roots, from_day=str(lo))
    keys = ["ingest_year", "ingest_month", "ingest_day"]  # 01 stays text
    out = spark.read.schema(lk.hourly(lake.cells(spark, sf)).schema).parquet(roots[0])
    return finish(out.select(*lk.AGG_COLUMNS).withColumns({k: F.col(k).cast("string") for k in keys}))


@query("m1_moving_key")
def m1_moving_key(spark, sf):
    """M1 on files where a key changes its partition: requests stored by request month; a
    second batch moves every third by 45 days, a third batch moves every sixth back."""
    base = fixtures.requests_daily(spark, sf)
    key = F.col("service_request_id").cast("long")
    root = scratch_path(spark, "moving-requests")
    moved = base.filter(key % 3 == 0).withColumn("requested_datetime", F.col("requested_datetime") + F.expr("INTERVAL 45 DAYS"))
    back = base.filter(key % 6 == 0).withColumn("status", F.lit("reopened"))
    for batch in (base, moved, back):
        monthly = batch.withColumn("month", F.date_format("requested_datetime", "yyyy-MM"))
        mg.merge_into_path(spark, root, monthly, ["service_request_id"], ["month"], ["updated_datetime"], moving=True)
    return finish(spark.read.schema(monthly.schema).parquet(root))


def _middle_news_day(events: DataFrame) -> str:
    """The day in the middle of the export, as text."""
    days = events.agg(F.min("SQLDATE").alias("lo"), F.max("SQLDATE").alias("hi")).select(
        *[F.to_date(c, "yyyyMMdd").alias(c) for c in ("lo", "hi")])
    return days.select(F.date_format(F.expr("date_add(lo, cast(datediff(hi, lo) / 2 as int))"), "yyyyMMdd")).first()[0]


@query("e12_news_job")
def e12_news_job(spark, sf):
    """E12 three times: the export without its middle day, that day alone, and that day again
    with every tone one higher."""
    ev = fixtures.news_events(spark, sf)
    middle = F.col("SQLDATE") == _middle_news_day(ev)
    root, events_root = scratch_path(spark, "news-table"), scratch_path(spark, "news-events")
    higher = ev.filter(middle).withColumn("AvgTone", F.col("AvgTone") + 1)
    for batch in (ev.filter(~middle), ev.filter(middle), higher):
        landing = scratch_path(spark, "news-export")
        batch.select(*[(F.col(c).cast("string") if c in ev.columns else F.lit(None).cast("string")).alias(c)
                       for c in io.NEWS_COLUMNS]).write.option("sep", "\t").option("header", False).csv(landing)
        out = jobs.news_job(spark, landing, fixtures.CITIES, events_root, root)
    return finish(out.drop("month"))


@query("e17_window")
def e17_window(spark, sf):
    """E17 for one changed day: the datamart is built while the middle request day is still
    incomplete (all its requests open, none of its alerts there), then that day is ingested
    and only its cells are brought up to date. Returns all cards and, as one more, the scores."""
    requests, alerts = fixtures.requests_daily(spark, sf), fixtures.alert_features(spark, sf)
    day = requests.agg(F.to_date(F.timestamp_micros(((F.unix_micros(F.min("requested_datetime")) + F.unix_micros(F.max("requested_datetime"))) / 2
                                                     ).cast("long")))).first()[0]
    roots = {n: scratch_path(spark, f"e17-{n}") for n in ("requests", "alerts", "datamart")}

    def ingest(rows, feats):
        monthly = mg.resolution_hours(rows).withColumn("month", F.date_format("requested_datetime", "yyyy-MM"))
        merge = lambda: mg.merge_into_path(
            spark, roots["requests"], monthly, ["city", "service_request_id"], ["city", "month"], ["updated_datetime"], moving=True)
        staged.at_once(merge, lambda: jobs.alerts_job(spark, feats, roots["alerts"]))
        return [spark.read.parquet(roots["requests"]), spark.read.parquet(roots["alerts"])]

    on_day = F.to_date("requested_datetime") == F.lit(day)
    r, a = ingest(requests.withColumn("status", F.when(on_day, "open").otherwise(F.col("status"))), alerts.filter(F.col("obs_date") != F.lit(day)))
    weather, news = staged.at_once(*[lambda t=t: daily.materialize(spark, t, "e17-days") for t in (daily.weather(spark, sf), daily.gdelt(spark, sf))])
    jobs.daily_job(spark, r, weather, a, news, daily.stations(spark), roots["datamart"])
    r, a = ingest(requests.filter(on_day), alerts.filter(F.col("obs_date") == F.lit(day)))
    changed = daily.city_list(spark).withColumn("d", F.lit(day))
    done = update.update_job(spark, r, weather, a, news, daily.stations(spark), roots["datamart"], changed)
    scores = done["signal_scores"].select(
        "city", F.col("score_date").alias("metric_date"), F.lit("composite").alias("metric_name"), F.col("composite").alias("value_num"),
        F.col("readiness_mode").alias("value_text"), F.col("anomaly_score").alias("delta_pct"), F.col("composite_baseline_30d").alias("baseline"))
    return finish(done["signal_metrics"].select(*scores.columns).unionByName(scores))


@query("f8_stored")
def f8_stored(spark, sf):
    """F8 and E10 from the stored tables: every city's newest cards, read from the one partition
    each that the newest-day pointer names."""
    di = daily.inputs(spark, sf)
    root = scratch_path(spark, "stored-datamart")
    update.merge_outputs(spark, root, daily.scores_of(di), daily.cards_of(di))
    scores = update.newest_rows(spark, root, "signal_scores").select("city", "composite", "readiness_mode")
    return finish(update.newest_rows(spark, root, "signal_metrics").join(scores, "city"))


@query("e13_weather")
def e13_weather(spark, sf):
    """E13 twice: the readings and climate values of odd days of the month, then of all days."""
    obs, tall = fixtures.observation_features(spark, sf), fixtures.daily_values(spark, sf)
    odd = F.dayofmonth("obs_date") % 2 == 1
    root = scratch_path(spark, "weather")
    jobs.weather_job(spark, obs.filter(odd), tall.filter(odd), root)
    return finish(jobs.weather_job(spark, obs, tall, root).drop("month"))


@query("e14_alerts")
def e14_alerts(spark, sf):
    """E14 twice: all alerts as feature collections, then every fourth seen again 20 days later
    (many of them in another month)."""
    feats = fixtures.alert_features(spark, sf)
    root = scratch_path(spark, "alerts")
    jobs.alerts_job(spark, feats.groupBy("city", "obs_date").agg(F.collect_list(F.struct("id", "properties")).alias("features")), root)
    again = feats.filter(F.col("id").cast("long") % 4 == 0).withColumn("obs_date", F.date_add("obs_date", 20))
    return finish(jobs.alerts_job(spark, again, root).drop("month"))


@query("e15_requests")
def e15_requests(spark, sf):
    """E15 for two cities that number their requests alike; in Boston every third request is
    delivered again with another request time, and some have none at first."""
    raw = fixtures.open311_api_rows(spark, sf).withColumns(
        {c: F.date_format(c, _ISO) for c in ("requested_datetime", "updated_datetime")})
    eid = F.col("service_request_id").cast("long")
    root = scratch_path(spark, "requests")
    unread = F.when(eid % 10 == 0, F.lit("soon")).otherwise(F.col("requested_datetime"))
    jobs.requests_job(spark, raw.withColumn("requested_datetime", unread), "boston", root)
    jobs.requests_job(spark, raw, "chicago", root)
    later = F.date_format(F.to_timestamp("requested_datetime") + F.expr("INTERVAL 40 DAYS"), _ISO)
    again = raw.filter(eid % 3 == 0).withColumns({"requested_datetime": later, "status": F.lit("open")})
    out = jobs.requests_job(spark, again, "boston", root)
    return finish(out.select("city", F.col("service_request_id").cast("string").alias("service_request_id"), "status", "requested_datetime",
                             "updated_datetime", "resolution_hrs"))


@query("e16_run_log")
def e16_run_log(spark, sf):
    """E16 twice: a batch that holds every event twice, then all events again. Events without a
    stop time take a fixed clock."""
    events = fixtures.run_events(spark, sf)
    root, clock = scratch_path(spark, "run-log"), F.lit("2000-01-01 00:00:00").cast("timestamp")
    first = events.filter(F.col("status") != "TIMED_OUT")
    jobs.run_log_job(spark, first.unionByName(first), root, clock)
    out = jobs.run_log_job(spark, events, root, clock)
    return finish(out.drop("month").withColumn("duration_secs", F.col("duration_secs").cast("double")))
