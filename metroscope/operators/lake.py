"""Open311 lake path: silver normalisation (P7, J1), base derivation (P8, F5) and
hourly / daily / category aggregates (A1-A4).

All set-based; the category mapping is a fixed 14-row dimension and is broadcast.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metroscope.functions.columns import safe_ratio, timestamp_of
from metroscope.operators.merge import keep_latest
from metroscope.sources.io import require_columns

# The columns that a silver table and a category mapping must carry.
SILVER_REQUIRED = (
    "city", "status", "service_request_id", "normalized_category", "is_infrastructure",
    "is_emergency_type", "requested_at_utc", "ingested_at_utc", "batch_id",
)
MAPPING_REQUIRED = ("raw_category", "normalized_category", "is_infrastructure", "is_emergency_type")
# Mapping rows are a small configured dimension; refuse to broadcast anything larger.
MAX_BROADCAST_MAPPING_ROWS = 100_000


def to_silver(bronze: DataFrame, mapping: DataFrame, mapping_rows: int | None = None) -> DataFrame:
    """Parse the three timestamps (P7) and attach the category mapping.

    Unmapped services get category ``Other`` and 0 flags. The mapping is broadcast
    when its row count (``mapping_rows`` if the caller knows it) is within bound,
    otherwise Spark shuffles both sides on the service name.
    """
    require_columns(mapping, MAPPING_REQUIRED, "Mapping file")
    df = bronze.select(
        "*",
        timestamp_of(bronze, "requested_datetime").alias("requested_at_utc"),
        timestamp_of(bronze, "updated_datetime").alias("updated_at_utc"),
        timestamp_of(bronze, "closed_datetime").alias("closed_at_utc"),
    )
    m = mapping.select(*MAPPING_REQUIRED)
    if mapping_rows is not None and mapping_rows <= MAX_BROADCAST_MAPPING_ROWS:
        m = F.broadcast(m)
    joined = df.join(m, df["service_name"] == m["raw_category"], "left")
    return joined.select(
        *[df[c] for c in df.columns],
        m["raw_category"],
        F.coalesce(m["normalized_category"], F.lit("Other")).alias("normalized_category"),
        F.coalesce(m["is_infrastructure"].cast("int"), F.lit(0)).alias("is_infrastructure"),
        F.coalesce(m["is_emergency_type"].cast("int"), F.lit(0)).alias("is_emergency_type"),
    )


# Measures of the aggregates -> the 0/1 (or id) column that they count up.
_COUNTED = {
    "total_requests": "has_id",
    "open_requests": "opened",
    "closed_requests": "closed",
    "infrastructure_requests": "infrastructure",
    "emergency_requests": "emergency",
}
# Output columns of the hourly and daily aggregates, in order.
AGG_COLUMNS = (
    "city", "ingest_year", "ingest_month", "ingest_day", "window_start", "total_requests",
    "open_requests", "closed_requests", "infrastructure_requests", "emergency_requests",
    "emergency_ratio", "distinct_categories",
)


def request_facts(silver: DataFrame) -> DataFrame:
    """P8 + F5: one narrow typed row per delivery - city, id, category, request hour, ingest
    date and 0/1 measures. Deliveries without a readable request or ingest time go."""
    require_columns(silver, SILVER_REQUIRED, "Silver input")

    def flag(c: Column) -> Column:
        return F.coalesce(c.cast("int"), F.lit(0))

    status = F.lower("status")
    updated = timestamp_of(silver, "updated_at_utc") if "updated_at_utc" in silver.columns else F.lit(None).cast("timestamp")
    facts = silver.select(
        "city", "service_request_id", updated.alias("updated_ts"), timestamp_of(silver, "ingested_at_utc").alias("ingested_ts"),
        F.date_trunc("hour", timestamp_of(silver, "requested_at_utc")).alias("hour"),
        F.ifnull("normalized_category", F.lit("Other")).alias("category"),
        flag(F.col("service_request_id").isNotNull()).alias("has_id"),
        flag(status == "open").alias("opened"), flag(status == "closed").alias("closed"),
        flag(F.col("is_infrastructure")).alias("infrastructure"), flag(F.col("is_emergency_type")).alias("emergency"),
    )
    return facts.dropna(subset=["hour", "ingested_ts"])


def latest_deliveries(facts: DataFrame) -> DataFrame:
    """Q20: a request that was delivered again counts once, as its latest update says
    (then the latest ingest). Deliveries without an id cannot be matched and all stay."""
    loose = F.when(F.col("service_request_id").isNull(), F.monotonically_increasing_id())
    keyed = facts.withColumn("loose", loose)
    return keep_latest(keyed, ["city", "service_request_id", "loose"], ["updated_ts", "ingested_ts"]).drop("loose")


def category_cells(facts: DataFrame) -> DataFrame:
    """The one aggregate behind A1-A3: measures per (city, ingest date, hour, category).

    Small (bounded by cities x hours x categories x ingest days), so the hourly, daily and
    category tables are all roll-ups of it and the raw rows are read and shuffled once."""
    return facts.groupBy("city", F.to_date("ingested_ts").alias("ingest_date"), "hour", "category").agg(
        *[F.sum(c).alias(m) for m, c in _COUNTED.items()])


def _ingest_parts() -> list[Column]:
    return [F.date_format("ingest_date", p).alias(n) for n, p in (("ingest_year", "yyyy"), ("ingest_month", "MM"), ("ingest_day", "dd"))]


def _rolled_up(cells: DataFrame, window: Column) -> DataFrame:
    per_window = cells.groupBy("city", "ingest_date", window.alias("window_start")).agg(
        *[F.sum(m).alias(m) for m in _COUNTED], F.count_distinct("category").alias("distinct_categories"))
    ratio = safe_ratio(F.col("emergency_requests"), F.col("total_requests")).alias("emergency_ratio")
    return per_window.select("*", *_ingest_parts(), ratio).select(*AGG_COLUMNS)


def hourly(cells: DataFrame) -> DataFrame:
    """A1 + A4: per (city, ingest day, hour)."""
    return _rolled_up(cells, F.col("hour"))


def daily(cells: DataFrame) -> DataFrame:
    """A2 + A4: per (city, ingest day, request day)."""
    return _rolled_up(cells, F.to_date("hour"))


def category_hourly(cells: DataFrame) -> DataFrame:
    """A3: requests per (city, ingest day, hour, category)."""
    return cells.select("city", *_ingest_parts(), F.col("hour").alias("window_start"),
                        F.col("category").alias("normalized_category"), F.col("total_requests").alias("request_count"))


def sorted_for_read(df: DataFrame, *extra: str) -> DataFrame:
    """Reader-side order (city, window_start[, category]); writes never sort globally."""
    return df.orderBy("city", "window_start", *extra)


# Columns of a bronze record, in order.
BRONZE_COLUMNS = (
    "source", "city", "batch_id", "ingested_at_utc", "service_request_id", "status", "service_name",
    "service_code", "description", "requested_datetime", "updated_datetime", "closed_datetime", "address",
    "lat", "lon", "media_url", "raw_payload",
)


MAX_BROADCAST_MANIFESTS = 1_000_000


def flatten_records(raw: DataFrame, manifests: DataFrame, manifest_rows: int | None = None) -> DataFrame:
    """E1 / P1 + S2: one bronze row per raw record, stamped with its batch manifest.

    Alternative keys resolve first-present-wins (``lat``/``latitude``,
    ``long``/``lon``/``longitude``); with a fixed schema a present null cannot be told
    from an absent key, so this is ``coalesce`` (Q18). The original record is kept as
    JSON text in ``raw_payload``. Manifests are one row per batch (``read_manifests`` checks
    it) and are joined on ``batch_id``; a record whose batch has no manifest fails the job
    by name instead of disappearing. With a known manifest count within bound they are broadcast, so a batch
    holding a third of all records never lands in one shuffle partition."""
    def pick(*names: str):
        cols = [F.col(n) for n in names if n in raw.columns]
        return F.coalesce(*cols) if cols else F.lit(None)

    payload = F.to_json(F.struct(*[F.col(c) for c in raw.columns if c != "batch_id"]))
    rec = raw.select(
        "batch_id",
        pick("service_request_id").cast("string").alias("service_request_id"),
        pick("status").alias("status"), pick("service_name").alias("service_name"),
        pick("service_code").alias("service_code"), pick("description").cast("string").alias("description"),
        pick("requested_datetime").alias("requested_datetime"), pick("updated_datetime").alias("updated_datetime"),
        pick("closed_datetime").alias("closed_datetime"), pick("address").cast("string").alias("address"),
        pick("lat", "latitude").cast("double").alias("lat"), pick("long", "lon", "longitude").cast("double").alias("lon"),
        pick("media_url").cast("string").alias("media_url"), payload.alias("raw_payload"),
    )
    if manifest_rows is not None and manifest_rows <= MAX_BROADCAST_MANIFESTS:
        manifests = F.broadcast(manifests)
    found = manifests.select(F.col("batch_id").alias("m_batch"), F.col("city").alias("m_city"),
                             F.col("ingested_at_utc").alias("m_ingested"))
    joined = rec.join(found, F.col("batch_id") == F.col("m_batch"), "left")
    lost = F.raise_error(F.concat(F.lit("records without a manifest, batch "), F.coalesce("batch_id", F.lit("(null)"))))
    stamped = lambda c: F.when(F.col("m_batch").isNull(), lost).otherwise(F.col(c))
    return joined.select(
        F.lit("open311").alias("source"), stamped("m_city").alias("city"), stamped("batch_id").alias("batch_id"),
        stamped("m_ingested").alias("ingested_at_utc"), *BRONZE_COLUMNS[4:],
    )


BRONZE_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in (
        "source", "ingested_at_utc", "service_request_id", "status", "service_name", "service_code",
        "description", "requested_datetime", "updated_datetime", "closed_datetime", "address")]
    + [T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())]
    + [T.StructField(c, T.StringType()) for c in ("media_url", "raw_payload")]
)


def bronze_partition_columns(bronze: DataFrame) -> DataFrame:
    """Year / month / day from the ingest time, plus city and batch_id, as partition keys."""
    ing = F.col("ingested_at_utc").cast("timestamp")
    return bronze.withColumns({
        "year": F.date_format(ing, "yyyy"), "month": F.date_format(ing, "MM"), "day": F.date_format(ing, "dd"),
    })
