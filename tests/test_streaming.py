"""Batch = stream: hourly counts from a multi-trigger file stream equal the batch job."""
from pyspark.sql import functions as F

from metroscope.operators import lake as lk
from metroscope.plans import lake
from metroscope.session import scratch_path
from metroscope.streaming import hourly as hs

from conftest import SMALL_SF


def test_stream_equals_batch_over_several_triggers(spark):
    silver = lake.silver(spark, SMALL_SF)
    landing = scratch_path(spark, "landing-test")
    day = F.dayofmonth("requested_at_utc")
    # three landings in event-time order, one re-delivery of earlier rows in the last one
    for lo, hi in ((1, 10), (11, 20), (21, 31)):
        chunk = silver.filter(day.between(lo, hi))
        if lo == 21:
            chunk = chunk.unionByName(silver.filter(day.between(18, 20) & (F.col("service_request_id").cast("long") % 5 == 0)))
        hs.land(chunk, landing)
    got = hs.run_hourly_pipeline(spark, landing, hs.stream_schema(silver), delay="4 days", max_files=1)
    want = lk.hourly(lk.category_cells(lk.request_facts(silver))).groupBy("city", "window_start").agg(
        F.sum("total_requests").alias("total_requests"), F.sum("open_requests").alias("open_requests"),
        F.sum("closed_requests").alias("closed_requests"),
        F.sum("infrastructure_requests").alias("infrastructure_requests"),
        F.sum("emergency_requests").alias("emergency_requests"),
    )
    cols = ["city", "window_start", "total_requests", "open_requests", "closed_requests",
            "infrastructure_requests", "emergency_requests"]
    assert sorted(got.select(*cols).collect()) == sorted(want.select(*cols).collect())


def _rows(spark, n, city, day, start=0):
    return spark.range(start, start + n).select(
        F.col("id").cast("string").alias("service_request_id"), F.lit(city).alias("city"), F.lit("open").alias("status"),
        (F.lit(f"2024-01-{day:02d} 10:00:00").cast("timestamp") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("requested_at_utc"),
        F.lit(0).alias("is_infrastructure"), F.lit(0).alias("is_emergency_type"), F.lit("A").alias("normalized_category"))


def test_a_stream_goes_on_where_it_stopped(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / n) for n in ("landing", "target", "checkpoint"))
    schema = hs.stream_schema(_rows(spark, 1, "boston", 1))
    run = lambda: hs.run_hourly_stream(spark, landing, schema, target, checkpoint, state_partitions=2)
    hs.land(_rows(spark, 30, "boston", 1), landing)
    assert run()["rows_read"] == 30
    assert run()["rows_read"] == 0  # nothing landed
    hs.land(_rows(spark, 40, "boston", 1, start=20), landing)  # ten known, thirty new, one window grows
    hs.land(_rows(spark, 10, "chicago", 1), landing)           # ids of Boston
    assert run()["rows_read"] == 50  # the new files only
    got = {(r.city, r.window_start.hour): r.total_requests for r in hs.merged_counts(spark, target).collect()}
    assert sum(n for (c, _), n in got.items() if c == "boston") == 60 and got["chicago", 10] == 10
    assert hs.last_epoch(spark, target, hs.stream_id(spark, checkpoint)) >= 1


def test_an_epoch_is_merged_once(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / n) for n in ("landing", "target", "checkpoint"))
    rows = _rows(spark, 30, "boston", 1)
    hs.land(rows, landing)
    hs.run_hourly_stream(spark, landing, hs.stream_schema(rows), target, checkpoint, state_partitions=2)
    merge = hs.upsert_sink(spark, target, checkpoint)
    before = sorted(map(tuple, hs.merged_counts(spark, target).collect()))
    stale = hs.hourly_counts(rows.limit(1))
    merge(stale, 0)  # replayed after a crash: it is in the ledger
    assert sorted(map(tuple, hs.merged_counts(spark, target).collect())) == before
    merge(stale, 99)
    assert sorted(map(tuple, hs.merged_counts(spark, target).collect())) != before


def test_a_target_needs_its_checkpoint(spark, tmp_path):
    import pytest

    schema = hs.stream_schema(_rows(spark, 1, "boston", 1))
    with pytest.raises(ValueError, match="together"):
        hs.run_hourly_pipeline(spark, str(tmp_path), schema, target=str(tmp_path / "t"))
    (tmp_path / "empty").mkdir()
    assert hs.run_hourly_pipeline(spark, str(tmp_path / "empty"), schema).count() == 0
