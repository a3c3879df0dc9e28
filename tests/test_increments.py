"""Jobs run again and again: ledgers, moving keys and half-finished steps."""
import random
import re

import pytest
from pyspark.sql import functions as F

from metroscope.operators import lake as lk
from metroscope.operators import ledger as lg
from metroscope.operators import merge as mg
from metroscope.operators import staged
from metroscope.plans import jobs
from metroscope.session import scratch_path
from metroscope.sources import fixtures

from conftest import SMALL_SF

SILVER = ("city string, service_request_id string, status string, requested_at_utc string, updated_at_utc string, "
          "ingested_at_utc string, normalized_category string, is_infrastructure int, is_emergency_type int, batch_id string")


def silver(spark, rows):
    """(city, id, status, requested, updated, ingested[, category]) -> silver rows."""
    full = [(*r[:6], r[6] if len(r) > 6 else None, 1, 0, "b") for r in rows]
    return lk.bronze_partition_columns(spark.createDataFrame(full, SILVER))


def hours(spark, root):
    t = spark.read.schema("city string, ingest_year string, ingest_month string, ingest_day string, window_start timestamp, "
                          "total_requests long, open_requests long, closed_requests long, distinct_categories long").parquet(root)
    return sorted((r.city or "", r.ingest_day, str(r.window_start), r.total_requests, r.open_requests, r.closed_requests, r.distinct_categories)
                  for r in t.collect())


def roots(spark, n=4):
    return [scratch_path(spark, "led") for _ in range(n)]


def test_a_delivery_moves_its_count_and_empties_its_day(spark, tmp_path):
    first = [("boston", "1", "open", "2024-01-01 10:05:00", "2024-01-01 10:05:00", "2024-01-02 00:00:00"),
             ("chicago", "1", "open", "2024-01-01 10:05:00", "2024-01-01 10:05:00", "2024-01-02 00:00:00")]
    again = [("boston", "1", "closed", "2024-01-01 10:05:00", "2024-03-01 00:00:00", "2024-03-02 00:00:00")]
    h, d, c, state = (str(tmp_path / n) for n in "hdcs")
    lg.apply_deliveries(spark, silver(spark, first), state, (h, d, c), whole=True)
    assert (tmp_path / "h" / "ingest_year=2024" / "ingest_month=01" / "ingest_day=02" / "city=boston").exists()
    for _ in range(2):  # the second time everything is known
        out = lg.apply_deliveries(spark, silver(spark, again), state, (h, d, c), whole=False)
        assert hours(spark, h) == [("boston", "02", "2024-01-01 10:00:00", 1, 0, 1, 1), ("chicago", "02", "2024-01-01 10:00:00", 1, 1, 0, 1)]
        for table in "hdc":
            days = tmp_path / table / "ingest_year=2024"
            assert not (days / "ingest_month=01" / "ingest_day=02" / "city=boston").exists()
            assert (days / "ingest_month=03" / "ingest_day=02" / "city=boston").exists()
    assert out == {"new_keys": 0, "superseded": 0, "known_keys": 1}
    # an older delivery that comes late changes nothing
    late = [("boston", "1", "open", "2024-01-01 10:05:00", "2024-02-01 00:00:00", "2024-04-01 00:00:00")]
    lg.apply_deliveries(spark, silver(spark, late), state, (h, d, c), whole=False)
    assert hours(spark, h)[0][1:] == ("02", "2024-01-01 10:00:00", 1, 0, 1, 1)


@pytest.mark.parametrize("seed", [1, 2])
def test_any_runs_equal_one_full_run(spark, seed):
    """Random deliveries - ids null, cities null, equal times, days re-read in any order."""
    rng = random.Random(seed)
    rows = []
    for _ in range(250):
        day = rng.randint(1, 9)
        rows.append((rng.choice(["boston", "chicago", None]), rng.choice([None, *map(str, range(30))]), rng.choice(["open", "closed", None]),
                     f"2024-01-01 {rng.randint(0, 3):02d}:10:00", rng.choice([None, f"2024-01-{rng.randint(1, 9):02d} 00:00:00"]),
                     f"2024-02-{day:02d} 0{rng.randint(0, 1)}:00:00", rng.choice(["A", "B", None])))
    everything = silver(spark, rows).cache()
    full, steps = roots(spark), roots(spark)
    lg.apply_deliveries(spark, everything, full[3], full[:3], whole=True)
    day = F.dayofmonth("ingested_at_utc")
    for lo, hi in ((4, 6), (1, 4), (5, 9), (1, 2)):
        lg.apply_deliveries(spark, everything.filter(day.between(lo, hi)), steps[3], steps[:3], whole=False)
    for a, b in zip(full, steps):
        read = lambda r: sorted((tuple(x) for x in spark.read.parquet(r).collect()), key=repr)
        assert [tuple(map(str, x)) for x in (read(a) if a != full[3] else [])] == [tuple(map(str, x)) for x in (read(b) if b != steps[3] else [])]
    cells = lambda r: sorted((tuple(x) for x in spark.read.parquet(f"{r}/cells").select(*lg.CELL, "deliveries").collect()), key=repr)
    assert cells(full[3]) == cells(steps[3])
    # a whole run over fewer days drops what is gone
    lg.apply_deliveries(spark, everything.filter(day <= 3), steps[3], steps[:3], whole=True)
    fewer = roots(spark)
    lg.apply_deliveries(spark, everything.filter(day <= 3), fewer[3], fewer[:3], whole=True)
    assert hours(spark, steps[0]) == hours(spark, fewer[0]) and cells(steps[3]) == cells(fewer[3])


def test_counts_without_a_ledger_are_not_continued(spark):
    r = roots(spark)
    rows = silver(spark, [("boston", "1", "open", "2024-01-01 10:05:00", None, "2024-01-02 00:00:00")])
    lg.apply_deliveries(spark, rows, r[3], r[:3], whole=True)
    with pytest.raises(RuntimeError, match="no delivery ledger"):
        lg.apply_deliveries(spark, rows, scratch_path(spark, "other"), r[:3], whole=False)
    with pytest.raises(RuntimeError, match="no row with a readable"):
        lg.apply_deliveries(spark, rows.limit(0), r[3], r[:3], whole=False)


def keyed(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, m string, v int")


def table(spark, root):
    return sorted((r.k or "", r.m or "", r.v) for r in spark.read.schema("k string, m string, v int").parquet(root).collect())


def test_a_key_that_changes_partition_is_one_row(spark, tmp_path):
    root = str(tmp_path / "t")
    put = lambda *rows: mg.merge_into_path(spark, root, keyed(spark, *rows), ["k"], ["m"], ["v"], moving=True)
    put(("1", "unknown", 1), ("2", "2026-01", 1), (None, "2026-01", 1))
    put(("1", "2026-01", 2), (None, None, 2), ("3", None, 2))
    assert table(spark, root) == [("", "", 2), ("1", "2026-01", 2), ("2", "2026-01", 1), ("3", "", 2)]
    assert not (tmp_path / "t" / "m=unknown").exists()
    put(("1", "x/y=z", 3), ("2", "x/y=z", 3))
    assert table(spark, root) == [("", "", 2), ("1", "x/y=z", 3), ("2", "x/y=z", 3), ("3", "", 2)]
    put(("1", "2026-01", 4), ("1", "2026-02", 5))  # twice in one batch: the greater order wins
    assert ("1", "2026-02", 5) in table(spark, root) and len(table(spark, root)) == 4


def test_the_index_of_an_older_table_is_built_from_it(spark):
    root = scratch_path(spark, "old-table")
    mg.merge_into_path(spark, root, keyed(spark, ("1", "a", 1), ("2", "b", 1)), ["k"], ["m"])
    mg.merge_into_path(spark, root, keyed(spark, ("1", "b", 2)), ["k"], ["m"], moving=True)
    mg.merge_into_path(spark, root, keyed(spark, ("2", "a", 3)), ["k"], ["m"], moving=True)
    assert table(spark, root) == [("1", "b", 2), ("2", "a", 3)]


def test_a_merge_reads_only_the_partitions_it_touches(spark, tmp_path):
    root = str(tmp_path / "pruned")
    mg.merge_into_path(spark, root, keyed(spark, *[(str(i), f"m{i % 5}", 1) for i in range(20)]), ["k"], ["m"], moving=True)
    scoped = staged.in_scope(spark.read.schema("k string, m string, v int").parquet(root), keyed(spark, ("1", "m1", 2)), ["m"])
    plan = scoped._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*m1", plan)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "pruned" / "m=m2").iterdir()}
    mg.merge_into_path(spark, root, keyed(spark, ("1", "m3", 2)), ["k"], ["m"], moving=True)
    assert before == {p: p.stat().st_mtime_ns for p in (tmp_path / "pruned" / "m=m2").iterdir()}


def test_a_step_that_was_decided_is_finished_by_the_next_run(spark, monkeypatch, tmp_path):
    root = str(tmp_path / "t")
    merge = lambda *rows: mg.merge_into_path(spark, root, keyed(spark, *rows), ["k"], ["m"], moving=True)
    merge(("1", "a", 1), ("2", "a", 1))
    real = staged._apply
    monkeypatch.setattr(staged, "_apply", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        merge(("1", "b", 2))
    monkeypatch.setattr(staged, "_apply", real)
    assert table(spark, root) == [("1", "a", 1), ("2", "a", 1)]  # nothing of it shows yet
    assert staged.recover(spark, root) == 1 and staged.recover(spark, root) == 0
    assert table(spark, root) == [("1", "b", 2), ("2", "a", 1)]
    merge(("1", "c", 3))  # the index was finished too
    assert table(spark, root) == [("1", "c", 3), ("2", "a", 1)]


def test_keys_that_stay_leave_the_index_alone(spark, tmp_path):
    merge = lambda *rows: mg.merge_into_path(spark, str(tmp_path / "t"), keyed(spark, *rows), ["k"], ["m"], moving=True)
    times = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "_keys").rglob("*.parquet")}
    merge(*[(str(i), "a" if i % 2 else None, 1) for i in range(40)], (None, "a", 1))
    first = times()
    merge(*[(str(i), "a" if i % 2 else None, 2) for i in range(40)], (None, "a", 2))
    assert times() == first
    merge(*[(str(i), "a" if i % 2 else None, 3) for i in range(40)], ("1000", "a", 3))
    assert len({p.parent for p in times() if p not in first}) == 1  # the new key's bucket
    merge(("1000", "b", 4), (None, "b", 4))
    want = sorted([*[(str(i), "a" if i % 2 else "", 3) for i in range(40)], ("1000", "b", 4), ("", "b", 4)])
    assert table(spark, str(tmp_path / "t")) == want


def test_a_first_batch_is_staged_once_and_finished_by_the_next_run(spark, monkeypatch, tmp_path):
    root = str(tmp_path / "t")
    merge = lambda *rows: mg.merge_into_path(spark, root, keyed(spark, *rows), ["k"], ["m"], ["v"], moving=True)
    real = staged._apply
    monkeypatch.setattr(staged, "_apply", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        merge(("1", "b", 2), ("1", "a", 1), ("2", "a", 1), (None, None, 1))
    monkeypatch.setattr(staged, "_apply", real)
    here = next((tmp_path / "t" / "_pending").iterdir())
    assert {p.name for p in here.iterdir() if p.is_dir()} == {"rows"}  # the index is taken from them
    merge(("2", "c", 2))
    assert table(spark, root) == [("", "", 1), ("1", "b", 2), ("2", "c", 2)]
    merge((None, "b", 3), ("1", "c", 3))
    assert table(spark, root) == [("", "b", 3), ("1", "c", 3), ("2", "c", 2)]


def test_an_empty_first_batch_leaves_no_table(spark, tmp_path):
    mg.merge_into_path(spark, str(tmp_path / "t"), keyed(spark, ("1", "a", 1)).limit(0), ["k"], ["m"], moving=True)
    assert not (tmp_path / "t").exists()


def test_a_step_that_was_not_decided_leaves_nothing(spark, monkeypatch, tmp_path):
    root = str(tmp_path / "t")
    mg.merge_into_path(spark, root, keyed(spark, ("1", "a", 1)), ["k"], ["m"], moving=True)
    real = staged._together
    monkeypatch.setattr(staged, "_together", lambda do, items: (real(do, items[:1]), 1 / 0))
    with pytest.raises(ZeroDivisionError):
        mg.merge_into_path(spark, root, keyed(spark, ("1", "b", 2)), ["k"], ["m"], moving=True)
    monkeypatch.setattr(staged, "_together", real)
    assert staged.recover(spark, root) == 0 and table(spark, root) == [("1", "a", 1)]
    assert not list((tmp_path / "t" / "_pending").iterdir())


def test_alerts_and_requests_over_a_month_end(spark):
    alerts = scratch_path(spark, "alerts")
    feats = fixtures.alert_features(spark, SMALL_SF).limit(1)
    for day in ("2024-01-31", "2024-02-01", "2024-02-01"):
        got = jobs.alerts_job(spark, feats.withColumn("obs_date", F.lit(day).cast("date")), alerts)
        assert [str(r.obs_date) for r in got.collect()] == [day]
    requests = scratch_path(spark, "requests")
    raw = fixtures.open311_api_rows(spark, SMALL_SF).filter("service_request_id is not null").limit(1)
    for when, month in (("soon", "unknown"), ("2024-01-31T10:00:00Z", "2024-01"), ("2024-02-01T10:00:00Z", "2024-02")):
        for city in ("boston", "chicago"):
            got = jobs.requests_job(spark, raw.withColumn("requested_datetime", F.lit(when)), city, requests)
    assert sorted((r.city, r.month) for r in got.collect()) == [("boston", "2024-02"), ("chicago", "2024-02")]


def test_an_event_twice_in_a_batch_is_logged_once(spark):
    log = scratch_path(spark, "runs")
    events = fixtures.run_events(spark, SMALL_SF)
    n = events.count()
    assert jobs.run_log_job(spark, events.limit(100).unionByName(events.limit(100)), log).count() == 100
    assert jobs.run_log_job(spark, events.unionByName(events), log).count() == n == jobs.run_log_job(spark, events, log).count()
    other = events.withColumn("status", F.lit("ABORTED"))
    assert jobs.run_log_job(spark, other, log).count() == 2 * n  # another status of an execution is another row


def test_one_large_partition_of_a_change_is_split(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    root = scratch_path(spark, "one-month")
    rows = spark.range(0, 500_000, 1, 8).select(F.lit("m").alias("m"), "id", *[F.xxhash64("id", F.lit(i)).alias(f"v{i}") for i in range(3)])
    spark.conf.set(key, "2m")
    try:
        staged.commit(spark, root, [staged.Change("rows", root, ("m",), rows)])
    finally:
        spark.conf.set(key, before)
    assert len(spark.read.parquet(root).inputFiles()) > 2 and spark.read.parquet(root).count() == 500_000
