"""E3 run by run: hourly, daily and category counts kept by signed differences.

Two tables stand behind the three aggregates:

- the delivery ledger: per (city, request id) its latest delivery - the order values, the cell
  it counts in (ingest date, hour, category) and its 0/1 measures - in buckets by key hash;
- the cells: measures per (city, ingest date, hour, category), deliveries without an id apart,
  since nothing can supersede them.

A run reads the deliveries of the ingest days it is given. Against the ledger each is new, newer
than the entry, or known. A new one adds its measures to its cell; a newer one also takes the
entry's measures from the cell it counted in, however long ago that day was. Cells that no
delivery is left in go, partitions without a cell are deleted, and the aggregates of the
touched (city, ingest day) partitions are rolled up from the cells. The order between deliveries
is total (update time, ingest time, then the whole row), so any sequence of runs that has read
every day ends with the counts of one full run, and a run that is repeated changes nothing. All
tables change in one step (``staged.commit``).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metroscope.operators import lake as lk
from metroscope.operators import staged
from metroscope.operators.merge import key_bucket, keep_latest
from metroscope.session import remove_scratch, scratch_path

KEY = ["city", "service_request_id"]
ORDER = ["updated_ts", "ingested_ts"]
CELL = ["city", "ingest_date", "hour", "category", "loose"]
MEASURES = tuple(lk._COUNTED.values())
BUCKETS = 64  # of the ledger, fixed for its life
CELL_PARTITIONS = ["ingest_date", "city"]
OUTPUT_PARTITIONS = ["ingest_year", "ingest_month", "ingest_day", "city"]
Outputs = Sequence[str]  # roots of the hourly, daily and category aggregates


def _entries(facts: DataFrame) -> DataFrame:
    """Ledger rows of deliveries with an id: the latest of each key."""
    keyed = facts.filter("service_request_id is not null").withColumn("ingest_date", F.to_date("ingested_ts"))
    return keep_latest(keyed, KEY, ORDER).withColumn("bucket", key_bucket(KEY, BUCKETS))


def _rank(df: DataFrame) -> Column:
    """The order of deliveries as one comparable value (nulls lowest, as ``keep_latest`` has it)."""
    rest = [c for c in df.columns if c not in (*KEY, *ORDER, "bucket")]
    return F.struct(*[f(F.col(c)) for c in (*ORDER, *rest) for f in (F.isnotnull, lambda x: x)])


def _signed(rows: DataFrame, sign: int) -> DataFrame:
    return rows.select(*CELL[:-1], F.lit(False).alias("loose"), F.lit(sign).cast("long").alias("deliveries"),
                       *[(F.col(m) * sign).cast("long").alias(m) for m in MEASURES])


def _loose_cells(facts: DataFrame) -> DataFrame:
    """Deliveries without an id, counted in their own cells."""
    return facts.filter("service_request_id is null").select(
        "city", F.to_date("ingested_ts").alias("ingest_date"), "hour", "category", F.lit(True).alias("loose"),
        F.lit(1).cast("long").alias("deliveries"), *[F.col(m).cast("long").alias(m) for m in MEASURES])


def _summed(cells: DataFrame) -> DataFrame:
    return cells.groupBy(*CELL).agg(*[F.sum(m).alias(m) for m in ("deliveries", *MEASURES)])


def roll_ups(cells: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Hourly, daily and category aggregates (A1-A4) of stored cells."""
    named = cells.groupBy("city", "ingest_date", "hour", "category").agg(
        *[F.sum(c).alias(m) for m, c in lk._COUNTED.items()])
    return lk.hourly(named), lk.daily(named), lk.category_hourly(named)


def apply_deliveries(spark: SparkSession, silver: DataFrame, state_root: str, outputs: Outputs, whole: bool) -> dict[str, int]:
    """Count the deliveries of ``silver`` into the tables under ``state_root`` and ``outputs``.

    ``whole`` says that ``silver`` is everything there is: tables are built anew, and partitions
    that got no row go. Otherwise ``silver`` holds all deliveries of some ingest days. Returns the
    number of new, superseded and known keys of the run."""
    state_root = state_root.rstrip("/")
    staged.recover(spark, state_root)
    scratch = scratch_path(spark, "ledger-run")
    try:
        lk.request_facts(silver).write.parquet(f"{scratch}/facts")
        facts = spark.read.parquet(f"{scratch}/facts")
        if facts.isEmpty():
            raise RuntimeError("the silver input has no row with a readable request and ingest time")
        batch = _entries(facts)
        batch.write.parquet(f"{scratch}/batch")
        batch = spark.read.schema(batch.schema).parquet(f"{scratch}/batch")
        ledger = staged.stored(spark, f"{state_root}/ledger", batch)
        cells_like = _signed(batch, 1)
        cells = staged.stored(spark, f"{state_root}/cells", cells_like)
        if not whole and ledger is None and staged.exists(spark, outputs[0]):
            raise RuntimeError(f"no delivery ledger under {state_root}: count all days once, without from_day")
        if whole or ledger is None:
            judged = batch.select("*", F.lit(None).cast("boolean").alias("newer"))
            entries, gone = batch, None
            old_cells, old_days = None, cells
        else:
            touched = staged.in_scope(ledger, batch.select("bucket").distinct(), ["bucket"])
            was = touched.select(*KEY, _rank(touched).alias("was"), F.struct(*touched.columns).alias("entry"))
            ranked = batch.withColumn("rank", _rank(batch))
            met = ranked.join(was, staged.same(ranked, was, KEY), "left")
            judged = met.select(*[ranked[c] for c in batch.columns], "entry",
                                F.when(F.col("was").isNotNull(), F.col("rank") > F.col("was")).alias("newer"))
            judged.write.parquet(f"{scratch}/judged")
            judged = spark.read.parquet(f"{scratch}/judged")
            gone = judged.filter("newer").select("entry.*")
            fresh = judged.filter("newer or newer is null").select(*batch.columns)
            replaced = fresh.select(*KEY)
            entries = touched.join(replaced, staged.same(touched, replaced, KEY), "left_anti").unionByName(fresh)
            old_cells, old_days = cells, None
        fresh = judged.filter("newer or newer is null").select(*batch.columns)
        moves = _signed(fresh, 1) if gone is None else _signed(fresh, 1).unionByName(_signed(gone, -1))
        loose = _loose_cells(facts)
        days = facts.select(F.to_date("ingested_ts").alias("ingest_date"), "city").distinct()
        scope = moves.select(*CELL_PARTITIONS).union(days.select(*CELL_PARTITIONS)).distinct()
        if old_days is not None:
            scope = scope.union(old_days.select(*CELL_PARTITIONS)).distinct()
        scope.write.parquet(f"{scratch}/scope")
        scope = spark.read.schema(scope.schema).parquet(f"{scratch}/scope")
        total = moves.unionByName(loose)
        if old_cells is not None:
            stored = staged.in_scope(old_cells, scope, CELL_PARTITIONS)
            # the loose deliveries of the days read are counted again, from all of them
            again = stored.join(days, staged.same(stored, days, CELL_PARTITIONS), "left_anti").unionByName(
                stored.filter("not loose").join(days, staged.same(stored, days, CELL_PARTITIONS), "left_semi"))
            total = total.unionByName(again)
        summed = _summed(total).filter("deliveries > 0")
        summed.write.parquet(f"{scratch}/cells")
        summed = spark.read.schema(summed.schema).parquet(f"{scratch}/cells")
        parts = scope.select(F.date_format("ingest_date", "yyyy").alias("ingest_year"), F.date_format("ingest_date", "MM").alias("ingest_month"),
                             F.date_format("ingest_date", "dd").alias("ingest_day"), "city")
        changes = [
            staged.Change("ledger", f"{state_root}/ledger", ("bucket",), entries),
            staged.Change("cells", f"{state_root}/cells", tuple(CELL_PARTITIONS), summed, scope),
        ]
        changes += [staged.Change(name, root.rstrip("/"), tuple(OUTPUT_PARTITIONS), rows, parts)
                    for name, rows, root in zip(("hourly", "daily", "category_hourly"), roll_ups(summed), outputs)]
        if whole and ledger is not None:
            old = ledger.select("bucket").distinct()
            changes[0] = staged.Change("ledger", f"{state_root}/ledger", ("bucket",), entries, old)
        out = judged.agg(F.count_if(F.col("newer").isNull()).alias("new_keys"), F.count_if("newer").alias("superseded"),
                         F.count_if(~F.col("newer")).alias("known_keys")).first().asDict()
        staged.commit(spark, state_root, changes)
        return out
    finally:
        remove_scratch(spark, scratch)
