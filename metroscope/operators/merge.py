"""Keyed merges (M1-M5) and keep-latest dedup.

Without a table format, a merge is: dedup the batch, anti-join the old rows on the
key, union, and (for files) stage before an overwrite of only the touched partitions.
Reading and overwriting one path in the same plan is never done.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metroscope.functions.columns import rnd
from metroscope.operators import staged
from metroscope.session import remove_scratch, scratch_path

LOCATOR = "_keys"      # folder of the key -> partition index beside a table (Spark's readers skip it)
LOCATOR_BUCKETS = 64   # fixed for the life of a table


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key, the greatest ``order`` wins (nulls lose); remaining ties are
    broken by the rest of the row so the pick is deterministic under task retries.

    ``row_number() = 1`` plans as a group limit before and after the shuffle: a key that
    holds a third of all rows leaves each task as one row."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not rest and not order:
        return df.dropDuplicates(list(keys))  # the key is the whole row
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in (*order, *rest)])
    place = next(n for n in ("place", "place_", "place__") if n not in df.columns)
    return df.withColumn(place, F.row_number().over(newest)).filter(F.col(place) == 1).drop(place)


def _first_side(sides: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key over several tables, taken from the first table that has the key."""
    rank = next(n for n in ("rank", "rank_", "rank__") if n not in sides[0].columns)
    ranked = [df.withColumn(rank, F.lit(-i)) for i, df in enumerate(sides)]
    return keep_latest(reduce(DataFrame.unionByName, ranked), keys, [rank, *order]).drop(rank)


def upsert(existing: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """M1: a new row replaces every non-key column of the old row with the same key.

    A key repeated inside the batch is reduced to one row (W13 rule). ``existing`` holds a key
    once. One exchange: both sides are one union, the batch ahead of the table."""
    return _first_side([new.select(*existing.columns), existing], keys, order or ())


def partial_upsert(existing: DataFrame, new: DataFrame, keys: Sequence[str], keep_old: Sequence[str]) -> DataFrame:
    """M2: like M1, but on a match the ``keep_old`` columns keep the old value."""
    values = [c for c in existing.columns if c not in keys]
    side = lambda df, name: df.select(*keys, F.struct(*values).alias(name))
    # one exchange: the two sides of a key meet in one group
    both = side(existing, "old").unionByName(side(new, "new"), allowMissingColumns=True)
    met = both.groupBy(*keys).agg(F.max("old").alias("old"), F.max("new").alias("new"))
    pick = lambda c: (("old", "new") if c in keep_old else ("new", "old"))
    return met.select(*[
        F.col(c) if c in keys else F.when(F.col(pick(c)[0]).isNotNull(), F.col(f"{pick(c)[0]}.{c}")).otherwise(
            F.col(f"{pick(c)[1]}.{c}")).alias(c) for c in existing.columns])


def insert_absent(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """M3: add only rows whose key is not there yet (``ON CONFLICT DO NOTHING``)."""
    return _first_side([existing, new.select(*existing.columns)], keys)


def resolution_hours(requests: DataFrame) -> DataFrame:
    """M4: closed requests get ``round((updated - requested) / 3600 s, 2)``; others keep
    their old value (null when there is none). Microsecond exact, no row loop."""
    secs = (F.unix_micros(F.col("updated_datetime")) - F.unix_micros(F.col("requested_datetime"))) / 1e6
    old = F.col("resolution_hrs") if "resolution_hrs" in requests.columns else F.lit(None).cast("double")
    return requests.withColumn(
        "resolution_hrs", F.when(F.col("status") == "closed", rnd(secs / 3600, 2)).otherwise(old)
    )


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _locator(spark: SparkSession, root: str, table: DataFrame | None, keys: list[str], parts: list[str], like: DataFrame) -> DataFrame | None:
    """The stored key -> partition index (``bucket``, keys, ``at``); built from the table where
    a table has none yet."""
    empty = like.select(*keys, F.struct(*parts).alias("at")).withColumn("bucket", key_bucket(keys, LOCATOR_BUCKETS))
    found = staged.stored(spark, f"{root}/{LOCATOR}", empty)
    if found is not None or table is None:
        return found
    return table.select(*keys, F.struct(*parts).alias("at")).withColumn("bucket", key_bucket(keys, LOCATOR_BUCKETS))


def merge_into_path(
    spark: SparkSession,
    root: str,
    new: DataFrame,
    keys: Sequence[str],
    partition_cols: Sequence[str],
    order: Sequence[str] | None = None,
    moving: bool = False,
    also: Sequence[staged.Change] = (),
) -> None:
    """M1 on files: merge ``new`` into the partitioned parquet table at ``root``.

    The batch is computed once, reduced to one row per key and staged under the shared
    checkpoint folder. Only partitions it touches are read (with the batch's schema, so
    a text key ``01`` stays text), merged, staged and then overwritten as one step
    (``staged.commit``), clustered by partition.

    ``moving`` says that a key's partition can change between deliveries (a month taken
    from a date that is no part of the key). The table then keeps an index from key to
    partition beside it, in buckets by key hash: the partitions where the batch's keys stand
    now are touched too, and the old rows go. Of an indexed table only the buckets of the
    batch's keys are read, and only those with a key that is new or moves are rewritten.

    The first batch of a table is the table: it is staged as it is computed, and the index is
    taken from it when both are put in place."""
    keys, parts, root = list(keys), list(partition_cols), root.rstrip("/")
    staged.recover(spark, root)
    if not staged.exists(spark, root):
        _first_batch(spark, root, new, keys, parts, order, moving, also)
        return
    path = scratch_path(spark, "merge-batch")
    try:
        keep_latest(new, keys, order or ()).write.parquet(f"{path}/batch")
        batch = spark.read.schema(new.schema).parquet(f"{path}/batch")
        touched = batch.select(*parts).distinct()
        if touched.isEmpty():
            if also:
                staged.commit(spark, root, also)
            return
        current = staged.stored(spark, root, new)
        changes = list(also)
        if moving:
            index = _locator(spark, root, current, keys, parts, new)
            entries = batch.select(*keys, F.struct(*parts).alias("at")).withColumn("bucket", key_bucket(keys, LOCATOR_BUCKETS))
            first = current is not None and staged.stored(spark, f"{root}/{LOCATOR}", entries) is None
            merged = entries
            if index is not None:
                # an index built just now is written whole
                scope = index if first else staged.in_scope(index, entries.select("bucket").distinct(), ["bucket"])
                known = batch.select(*keys)
                standing = scope.join(known, staged.same(scope, known, keys), "left_semi")
                standing.write.parquet(f"{path}/standing")
                standing = spark.read.schema(standing.schema).parquet(f"{path}/standing")
                if not first:
                    fresh = entries.join(standing, staged.same(entries, standing, [*keys, "at"]), "left_anti")
                    buckets = fresh.select("bucket").distinct()
                    scope, entries = (staged.in_scope(t, buckets, ["bucket"]) for t in (index, entries))
                stay = scope.join(known, staged.same(scope, known, keys), "left_anti")
                merged = stay.unionByName(entries)
                touched = touched.union(standing.select(*[F.col(f"at.{p}").alias(p) for p in parts])).distinct()
            if index is None or first or not entries.isEmpty():
                changes.append(staged.Change("keys", f"{root}/{LOCATOR}", ("bucket",), merged))
        rows = batch
        if current is not None:
            known = batch.select(*keys)
            scope = staged.in_scope(current, touched, parts)
            rows = scope.join(known, staged.same(scope, known, keys), "left_anti").unionByName(batch)
        changes.append(staged.Change("rows", root, tuple(parts), rows.select(*new.columns), touched if moving else None))
        staged.commit(spark, root, changes)
    finally:
        remove_scratch(spark, path)


def _first_batch(spark: SparkSession, root: str, new: DataFrame, keys: list[str], parts: list[str], order: Sequence[str] | None,
                 moving: bool, also: Sequence[staged.Change]) -> None:
    """``merge_into_path`` where there is nothing at ``root`` yet."""
    here = staged.begin(root)
    try:
        keep_latest(new, keys, order or ()).select(*new.columns).write.parquet(f"{here}/rows")
        batch = spark.read.schema(new.schema).parquet(f"{here}/rows")
        empty = batch.isEmpty()
    except BaseException:
        remove_scratch(spark, root)  # it holds this draft alone
        raise
    if empty:
        remove_scratch(spark, root)
        if also:
            staged.commit(spark, root, also)
        return
    changes = [*also, staged.Change("rows", root, tuple(parts), batch, written=True)]
    if moving:
        quoted = lambda cols: ", ".join(f"`{c}`" for c in cols)
        view = (*[f"`{k}`" for k in keys], f"struct({quoted(parts)}) AS at", f"CAST(pmod(xxhash64({quoted(keys)}), {LOCATOR_BUCKETS}) AS INT) AS bucket")
        changes.append(staged.Change("keys", f"{root}/{LOCATOR}", ("bucket",), batch.selectExpr(*view), of="rows", view=view))
    staged.commit(spark, root, changes, here)
