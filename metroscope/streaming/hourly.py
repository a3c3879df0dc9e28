"""Structured Streaming form of the hourly 311 counts (R1-R3, our extension).

Landed silver files are read as a file stream; request ids are de-duplicated within the
event-time watermark (R2); hourly counts per city are kept as windowed state and each
micro-batch's updated windows are merged into a parquet table by key (R3), so the table
always holds the current count of every window and a replayed batch changes nothing.

The caller owns the checkpoint and the target: a stream that is started again on both goes on
where it stopped and reads only files that landed since. The target keeps a ledger of the last
epoch of each stream merged into it (by the stream's id from its checkpoint), written in the
same step as the epoch's rows, so an epoch that is replayed after a crash is left out.
"""
from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metroscope.operators import staged
from metroscope.operators.merge import merge_into_path
from metroscope.session import scratch_path

STREAM_COLUMNS = (
    "service_request_id", "city", "status", "requested_at_utc", "is_infrastructure", "is_emergency_type",
    "normalized_category",
)
KEYS = ["city", "window_start", "category"]
COUNTS = ("total_requests", "open_requests", "closed_requests", "infrastructure_requests", "emergency_requests")


def stream_schema(silver: DataFrame) -> T.StructType:
    return T.StructType([silver.schema[c] for c in STREAM_COLUMNS])


def land(silver: DataFrame, root: str) -> None:
    """Append a batch of silver rows to the landing folder the stream watches."""
    silver.select(*STREAM_COLUMNS).write.mode("append").parquet(root)


def request_stream(spark: SparkSession, root: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(root)


def dedup_requests(stream: DataFrame, delay: str = "2 days") -> DataFrame:
    """R2: a request that is delivered again inside the watermark delay is dropped (exactly
    once). Ids are a city's own: the same id in two cities is two requests."""
    return stream.withWatermark("requested_at_utc", delay).dropDuplicatesWithinWatermark(["city", "service_request_id"])


def hourly_counts(stream: DataFrame) -> DataFrame:
    """Per (city, event-time hour, category) counts; watermark-bounded state.

    ``countDistinct`` is not allowed in a streaming aggregate; with the category as a key the
    merged table holds the category counts (A3), and the hourly counts with their number
    of categories (A1) are its roll-up, ``roll_up``."""
    st = F.lower(F.coalesce(F.col("status"), F.lit("")))
    g = stream.groupBy(F.window("requested_at_utc", "1 hour").alias("w"), "city",
                       F.ifnull("normalized_category", F.lit("Other")).alias("category")).agg(
        F.count("service_request_id").alias("total_requests"),
        F.sum(F.when(st == "open", 1).otherwise(0)).cast("long").alias("open_requests"),
        F.sum(F.when(st == "closed", 1).otherwise(0)).cast("long").alias("closed_requests"),
        F.sum(F.coalesce(F.col("is_infrastructure").cast("int"), F.lit(0))).cast("long").alias("infrastructure_requests"),
        F.sum(F.coalesce(F.col("is_emergency_type").cast("int"), F.lit(0))).cast("long").alias("emergency_requests"),
    )
    return g.select("city", F.col("w.start").alias("window_start"), "category", *COUNTS)


def roll_up(cells: DataFrame) -> DataFrame:
    """Hourly counts and the number of categories from the merged category table."""
    return cells.groupBy("city", "window_start").agg(
        *[F.sum(c).alias(c) for c in COUNTS], F.count_distinct("category").alias("distinct_categories"))


EPOCHS = "_epochs"  # folder of the epoch ledger inside a target (Spark's readers skip it)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave the stream when it first started on this checkpoint."""
    text = "".join(r.value for r in spark.read.text(f"{checkpoint}/metadata").collect())
    return json.loads(text)["id"]


def last_epoch(spark: SparkSession, target: str, stream: str) -> int:
    """The last epoch of ``stream`` that is merged into ``target`` (-1: none)."""
    ledger = staged.stored(spark, f"{target}/{EPOCHS}", spark.createDataFrame([], "epoch long, stream string"))
    found = ledger.filter(F.col("stream") == stream).agg(F.max("epoch")).first()[0] if ledger is not None else None
    return -1 if found is None else found


def upsert_sink(spark: SparkSession, target: str, checkpoint: str):
    """foreachBatch body - keyed merge of the batch's updated windows into ``target``
    (partitioned by city and window day; only touched partitions are rewritten). The epoch is
    entered in the target's ledger in the same step; one that is there already is skipped."""

    def merge(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        staged.recover(spark, target)
        stream = stream_id(spark, checkpoint)
        if epoch_id <= last_epoch(spark, target, stream):
            return
        entry = spark.createDataFrame([(epoch_id, stream)], "epoch long, stream string")
        # the merge stages the batch as its first action, so the stateful plan runs once
        rows = batch.withColumn("window_day", F.date_format("window_start", "yyyy-MM-dd"))
        merge_into_path(spark, target, rows, KEYS, ["city", "window_day"],
                        also=[staged.Change("epochs", f"{target}/{EPOCHS}", ("stream",), entry)])

    return merge


def run_hourly_stream(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    delay: str = "2 days",
    max_files: int | None = None,
    state_partitions: int | None = None,
) -> dict[str, int]:
    """R1 + R2 + R3 with ``availableNow``: take up the stream on ``checkpoint`` (or start it),
    merge everything that landed since into ``target``, stop. Returns the rows read and the
    triggers of this run.

    ``delay`` and ``state_partitions`` hold from the first start on (Spark keeps the number of
    state partitions in the checkpoint; it defaults to the session's shuffle partitions)."""
    target, checkpoint = target.rstrip("/"), checkpoint.rstrip("/")
    counts = hourly_counts(dedup_requests(request_stream(spark, landing, schema, max_files), delay))
    writer = (counts.writeStream.outputMode("update").foreachBatch(upsert_sink(spark, target, checkpoint))
              .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    q = _start(spark, writer, state_partitions)
    q.awaitTermination()
    progress = q.recentProgress
    return {"rows_read": sum(p["numInputRows"] for p in progress), "triggers": len(progress)}


def merged_counts(spark: SparkSession, target: str) -> DataFrame:
    """The hourly table that a stream's target holds now (none before its first epoch)."""
    windows = T.StructType([T.StructField("city", T.StringType()), T.StructField("window_start", T.TimestampType()),
                            T.StructField("category", T.StringType()), *[T.StructField(c, T.LongType()) for c in COUNTS],
                            T.StructField("window_day", T.StringType())])
    like = spark.createDataFrame([], windows)
    found = staged.stored(spark, target, like)
    return roll_up(like if found is None else found)


def run_hourly_pipeline(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    target: str | None = None,
    checkpoint: str | None = None,
    delay: str = "2 days",
    max_files: int | None = None,
    state_partitions: int | None = None,
) -> DataFrame:
    """``run_hourly_stream``, then the merged hourly table. A target and a checkpoint belong
    together; without them both are fresh and the whole landing folder is read."""
    if (target is None) != (checkpoint is None):
        raise ValueError("a target and its checkpoint are given together")
    target, checkpoint = target or scratch_path(spark, "r1-hourly"), checkpoint or scratch_path(spark, "r1-checkpoint")
    run_hourly_stream(spark, landing, schema, target, checkpoint, delay, max_files, state_partitions)
    return merged_counts(spark, target)


def _start(spark: SparkSession, writer, state_partitions: int | None):
    """Start a stream with a chosen state partition count; the session setting is restored."""
    if not state_partitions:
        return writer.start()
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, before)


def run_dedup_pipeline(spark: SparkSession, landing: str, schema: T.StructType, delay: str = "2 days",
                       state_partitions: int | None = None) -> DataFrame:
    """R2 alone into an append-only parquet sink; returns what the sink holds."""
    out, ckpt = scratch_path(spark, "r2-dedup"), scratch_path(spark, "r2-checkpoint")
    writer = (dedup_requests(request_stream(spark, landing, schema), delay).writeStream.outputMode("append")
              .format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True))
    q = _start(spark, writer, state_partitions)
    q.awaitTermination()
    return spark.read.schema(schema).parquet(out)
