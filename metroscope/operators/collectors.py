"""Collector payload -> table rows.

Payloads arrive as landed files (JSON / text); every parser is a column expression
over the whole batch. Nothing is looped in Python.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metroscope.functions.columns import falsy_or
from metroscope.operators.merge import insert_absent

# ------------------------------------------------------------------ 311


def _truthy(c: Column) -> Column:
    return c.isNotNull() & (c != F.lit(""))


def parse_requests(raw: DataFrame) -> DataFrame:
    """Open311 API rows -> ``requests_311``; rows without an id are dropped;
    ``service_code`` split on ':' (missing code -> department '' and category null);
    status lower-cased at ingest (Q12)."""
    parts = F.split(F.coalesce(F.col("service_code"), F.lit("")), ":")
    return raw.filter(_truthy(F.col("service_request_id"))).select(
        "service_request_id",
        "service_code",
        "service_name",
        F.get(parts, 0).alias("department"),
        F.get(parts, 1).alias("category"),
        F.lower(F.col("status")).alias("status"),
        "requested_datetime",
        "updated_datetime",
        F.lit(None).cast("double").alias("resolution_hrs"),
        F.col("lat").cast("double").alias("lat"),
        F.col("long").cast("double").alias("lon"),
        F.lit(None).cast("string").alias("neighbourhood"),
        "description",
    )


def parse_socrata(raw: DataFrame) -> DataFrame:
    """Socrata rows -> the same table. Falsy-or chains as in Python (``a or b``);
    ``service_code`` = ``dept:reason`` when both are set, else whichever is set."""
    dept, reason, title = F.col("department"), F.col("reason"), F.col("case_title")
    req_id = falsy_or(F.col("case_enquiry_id"), F.col("service_request_id"))
    code = F.when(_truthy(dept) & _truthy(reason), F.concat(dept, F.lit(":"), reason)).otherwise(
        F.coalesce(F.nullif(dept, F.lit("")), F.nullif(reason, F.lit("")))
    )
    return raw.filter(_truthy(req_id)).select(
        req_id.cast("string").alias("service_request_id"),
        code.alias("service_code"),
        falsy_or(title, reason).alias("service_name"),
        F.nullif(dept, F.lit("")).alias("department"),
        F.nullif(reason, F.lit("")).alias("category"),
        F.lower(F.col("case_status")).alias("status"),
        F.col("open_dt").alias("requested_datetime"),
        falsy_or(F.col("closed_dt"), F.col("target_dt")).alias("updated_datetime"),
        F.lit(None).cast("double").alias("resolution_hrs"),
        F.col("latitude").cast("double").alias("lat"),
        F.col("longitude").cast("double").alias("lon"),
        F.col("neighborhood").alias("neighbourhood"),
        falsy_or(F.col("closure_reason"), title).alias("description"),
    )


# ------------------------------------------------------------------ alerts

# Alert table column and the feature property it comes from.
ALERT_COLUMNS = (
    ("event_type", "event"), ("severity", "severity"), ("urgency", "urgency"), ("certainty", "certainty"),
    ("response_type", "response"), ("category", "category"), ("onset", "onset"), ("expires", "expires"),
    ("headline", "headline"), ("description", "description"), ("instruction", "instruction"),
    ("area_desc", "areaDesc"),
)


def explode_features(collections: DataFrame) -> DataFrame:
    """One row per feature of a FeatureCollection (``features``: array of id + properties);
    an empty or missing array gives none."""
    rest = [c for c in collections.columns if c != "features"]
    return collections.select(*rest, F.explode("features").alias("f")).select(*rest, "f.id", "f.properties")


def parse_alerts(features: DataFrame) -> DataFrame:
    """Alert features (``id`` + nested ``properties``) -> 15-column ``nws_alerts`` rows;
    features without an id are dropped."""
    return features.filter(_truthy(F.col("id"))).select(
        F.col("id").alias("alert_id"), "city", "obs_date",
        *[F.col(f"properties.{src}").alias(dst) for dst, src in ALERT_COLUMNS],
    )


# ------------------------------------------------------------------ observations

_VALUE = T.StructType([T.StructField("value", T.DoubleType())])
OBSERVATION_FIELDS = (
    ("temp_c", "temperature"), ("heat_index", "heatIndex"), ("precip_6hr", "precipitationLast6Hours"),
    ("wind_gust", "windGust"), ("humidity", "relativeHumidity"),
)


def parse_observations(features: DataFrame, json_col: str = "feature_json") -> DataFrame:
    """P5: ``properties.<field>.value`` of each reading; a field that is not an object
    (or has no value) gives null. ``from_json`` with a fixed schema maps a non-object
    field to null, like the reference's ``isinstance(v, dict)`` test."""
    schema = T.StructType([
        T.StructField("properties", T.StructType(
            [T.StructField(src, T.StringType()) for _, src in OBSERVATION_FIELDS]
            + [T.StructField("textDescription", T.StringType())]
        ))
    ])
    parsed = features.withColumn("_f", F.from_json(F.col(json_col), schema))

    def val(src: str) -> Column:
        raw = F.col(f"_f.properties.{src}")
        return F.when(F.trim(raw).startswith("{"), F.from_json(raw, _VALUE)["value"])

    return parsed.select(
        *[c for c in features.columns if c != json_col],
        *[val(src).alias(dst) for dst, src in OBSERVATION_FIELDS],
        F.col("_f.properties.textDescription").alias("desc"),
    )


def weather_from_observations(readings: DataFrame) -> DataFrame:
    """F6 + A5: keep readings with a temperature; daily max/min temperature, max heat
    index / precipitation / gust, mean humidity, most frequent description (ties: the
    smallest text)."""
    kept = readings.filter(F.col("temp_c").isNotNull())
    return kept.groupBy("station_id", "obs_date").agg(
        F.max("temp_c").alias("tmax"),
        F.min("temp_c").alias("tmin"),
        F.max("heat_index").alias("heat_index_max"),
        F.max("precip_6hr").alias("precip_6hr_max"),
        F.max("wind_gust").alias("wind_gust_max"),
        F.avg("humidity").alias("humidity_avg"),
        F.mode("desc", deterministic=True).alias("text_description"),
    )


# ------------------------------------------------------------------ daily climate

DATATYPES = ("TMAX", "TMIN", "PRCP", "AWND", "WSF5")


def pivot_daily_values(tall: DataFrame) -> DataFrame:
    """Tall (datatype, value) -> one row per station-day. The pivot values are
    listed, so Spark runs no extra job to discover them; a repeated datatype resolves
    to its largest value."""
    return tall.groupBy("station_id", "obs_date").pivot("datatype", list(DATATYPES)).agg(F.max("value"))


def weather_from_daily_values(wide: DataFrame) -> DataFrame:
    """A weather row from TMAX/TMIN/PRCP/AWND/WSF5; no row without TMAX and TMIN;
    gust = WSF5 unless null, else AWND (null test, Q15); label Rain > 5 mm, Hot > 32,
    Freezing < 0, else Clear."""
    prcp, tmax = F.col("PRCP"), F.col("TMAX")
    desc = (
        F.when(prcp.isNotNull() & (prcp != 0) & (prcp > 5), "Rain")
        .when(tmax > 32, "Hot").when(tmax < 0, "Freezing").otherwise("Clear")
    )
    return wide.filter(tmax.isNotNull() & F.col("TMIN").isNotNull()).select(
        "station_id", "obs_date",
        tmax.alias("tmax"), F.col("TMIN").alias("tmin"),
        F.lit(None).cast("double").alias("heat_index_max"),
        prcp.alias("precip_6hr_max"),
        F.coalesce(F.col("WSF5"), F.col("AWND")).alias("wind_gust_max"),
        F.lit(None).cast("double").alias("humidity_avg"),
        desc.alias("text_description"),
    )


def prefer_primary(primary: DataFrame, fallback: DataFrame, keys=("station_id", "obs_date")) -> DataFrame:
    """The observation row where there is one, otherwise the daily-climate row."""
    return insert_absent(primary, fallback, list(keys))


# ------------------------------------------------------------------ run log


def normalize_runs(events: DataFrame, now: Column | None = None) -> DataFrame:
    """Pipeline name = last ARN part ('unknown' without ARN); duration =
    max(0, trunc((stop-start)/1000)) when both are set; run_at from stop (else now);
    error text ``error: cause`` stripped of ': ' on failure states only."""
    arn = F.col("stateMachineArn")
    start, stop = F.col("startDate"), F.col("stopDate")
    both = start.isNotNull() & (start != 0) & stop.isNotNull() & (stop != 0)
    dur = F.when(both, F.greatest(F.lit(0), ((stop - start) / 1000).cast("int")))
    err, cause = F.coalesce(F.col("error"), F.lit("")), F.coalesce(F.col("cause"), F.lit(""))
    failed = F.col("status").isin("FAILED", "TIMED_OUT", "ABORTED")
    msg = F.when(
        failed,
        F.when((err != "") | (cause != ""), F.expr("trim(BOTH ': ' FROM concat(coalesce(error, ''), ': ', coalesce(cause, '')))"))
        .otherwise(F.col("status")),
    )
    clock = F.current_timestamp() if now is None else now
    run_at = F.when(stop.isNotNull() & (stop != 0), F.timestamp_millis(stop)).otherwise(clock)
    return events.select(
        F.when(_truthy(arn), F.element_at(F.split(arn, ":"), -1)).otherwise(F.lit("unknown")).alias("pipeline_name"),
        F.col("executionArn").alias("execution_arn"),
        run_at.alias("run_at"),
        F.coalesce(F.col("status"), F.lit("UNKNOWN")).alias("status"),
        dur.alias("duration_secs"),
        msg.alias("error_message"),
    )
