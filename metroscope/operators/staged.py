"""Several partitioned tables changed as one step, and keys that may move between partitions.

A job that keeps an index or a ledger beside its table must change both or neither. All
new partitions are first written to a folder of their own below ``<state>/_pending``; a plan
file makes the step final; then the partitions are copied into place and those left without
rows are deleted. A run that dies before the plan file has changed nothing; one that dies
after it is finished by the next run (``recover``), because putting the same staged partitions
in place twice changes nothing. One job writes a table at a time.
"""
from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from metroscope.session import remove_scratch

PENDING = "_pending"
PRUNE_LIMIT = 1000  # partitions named in a scan's filters
SMALL_BYTES = 8 << 20  # of a change that needs no splitting: as parquet, several times that in a shuffle


@dataclass(frozen=True)
class Change:
    """``rows`` are the new contents of their partitions, and of those that ``scope`` lists:
    one that is listed and gets no row is deleted (None: there is no such partition).

    ``written``: the rows stand under ``name`` in the step's folder (``begin``) already. ``of`` and
    ``view``: the rows are these expressions over the rows of another change, and are not staged
    by themselves."""

    name: str
    root: str
    partitions: tuple[str, ...]
    rows: DataFrame
    scope: DataFrame | None = None
    written: bool = False
    of: str | None = None
    view: tuple[str, ...] = ()


def absent(error: AnalysisException) -> bool:
    """The path does not exist, or holds nothing yet. Anything else must surface."""
    return (error.getCondition() or "") in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def stored(spark: SparkSession, root: str, like: DataFrame) -> DataFrame | None:
    """The table at ``root`` in ``like``'s schema; None where there is none yet."""
    try:
        table = spark.read.schema(like.schema).parquet(root).select(*like.columns)
        table.isEmpty()  # an unreadable table surfaces here, not after an overwrite
        return table
    except AnalysisException as e:
        if not absent(e):
            raise
        return None


def same(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> Column:
    """Equal in all of ``cols``; nulls match each other."""
    out = F.lit(True)
    for c in cols:
        out = out & left[c].eqNullSafe(right[c])
    return out


def in_scope(table: DataFrame, scope: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows of ``table`` whose partition ``scope`` lists. Up to ``PRUNE_LIMIT`` listed partitions
    become literal filters, so that Spark's scan skips the others' files."""
    listed = scope.select(*cols).distinct().limit(PRUNE_LIMIT + 1).collect()
    if len(listed) <= PRUNE_LIMIT:
        for c in cols:
            values = {r[c] for r in listed}
            inside = F.col(c).isin([v for v in values if v is not None])
            table = table.filter(inside | F.col(c).isNull() if None in values else inside)
    return table.join(scope, same(table, scope, cols), "left_semi")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def begin(state_root: str) -> str:
    """The folder of a new step."""
    return f"{state_root.rstrip('/')}/{PENDING}/{uuid.uuid4().hex}"


def commit(spark: SparkSession, state_root: str, changes: Sequence[Change], here: str | None = None) -> None:
    """Apply all ``changes`` or none. Reads of the same tables inside ``changes`` are safe:
    everything is staged before anything is overwritten. ``here``: the step's folder, where it
    has been begun."""
    here = here or begin(state_root)

    def stage(c: Change) -> dict:
        scope = None if c.scope is None else c.scope.select(*c.partitions).distinct()
        if not (c.written or c.of):
            c.rows.write.parquet(f"{here}/{c.name}")
        if scope is not None:
            scope.write.parquet(f"{here}/{c.name}-scope")
        return {"name": c.name, "root": c.root, "partitions": list(c.partitions), "rows": c.rows.schema.json(),
                "of": c.of or c.name, "view": list(c.view), "scope": scope is not None and scope.schema.json()}

    plan = _together(stage, changes)
    fs, draft = _fs(spark, f"{here}/plan.draft")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(plan).encode()))
    out.close()
    fs.rename(draft, _fs(spark, f"{here}/plan.json")[1])  # from here on the step will be finished
    _apply(spark, here, plan)


def recover(spark: SparkSession, state_root: str) -> int:
    """Finish steps that were decided on and not carried out; drop the others. Returns how
    many were finished."""
    fs, pending = _fs(spark, f"{state_root.rstrip('/')}/{PENDING}")
    if not fs.exists(pending):
        return 0
    done = 0
    for entry in fs.listStatus(pending):
        here = entry.getPath().toString()
        plan = _fs(spark, f"{here}/plan.json")[1]
        if fs.exists(plan):
            text = "".join(r.value for r in spark.read.option("wholetext", True).text(plan.toString()).collect())
            _apply(spark, here, json.loads(text))
            done += 1
        else:
            remove_scratch(spark, here)
    return done


def _together(do, items: Sequence) -> list:
    """Independent Spark jobs, submitted from driver threads."""
    with ThreadPoolExecutor(max_workers=max(1, len(items))) as pool:
        return list(pool.map(do, items))


def at_once(*jobs) -> list:
    """Results of independent jobs (callables), run side by side."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [f.result() for f in [pool.submit(j) for j in jobs]]


def _apply(spark: SparkSession, here: str, plan: list[dict]) -> None:
    schemas = {p["name"]: p["rows"] for p in plan}

    def put(p: dict) -> None:
        parts, of = p["partitions"], p.get("of", p["name"])
        rows = spark.read.schema(StructType.fromJson(json.loads(schemas[of]))).parquet(f"{here}/{of}")
        if p.get("view"):
            rows = rows.selectExpr(*p["view"])
        if p["scope"]:
            scope = spark.read.schema(StructType.fromJson(json.loads(p["scope"]))).parquet(f"{here}/{p['name']}-scope")
            _drop_emptied(spark, p["root"], parts, rows, scope)
        (_clustered(rows, _bytes(spark, f"{here}/{of}"), parts).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(p["root"]))

    _together(put, plan)
    remove_scratch(spark, here)


def _bytes(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength()


def _clustered(rows: DataFrame, size: int, parts: list[str]) -> DataFrame:
    """Rows by table partition before a partitioned write. ``rebalance`` splits large partitions
    over several files; of a small change it would make one task that opens every file in turn,
    so that is dealt out by partition."""
    if size > SMALL_BYTES:
        return rows.hint("rebalance", *parts)
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism, *parts)


def _drop_emptied(spark: SparkSession, root: str, parts: list[str], rows: DataFrame, scope: DataFrame) -> None:
    """Delete the folders of partitions in ``scope`` that get no row (dynamic overwrite
    leaves those alone). The folder names come from the table's own files."""
    filled = rows.select(*parts).distinct()
    emptied = scope.join(filled, same(scope, filled, parts), "left_anti")
    table = stored(spark, root, rows)
    if table is None:
        return
    files = spark.read.schema(rows.schema).parquet(root).select(*parts, F.col("_metadata.file_path").alias("file")).distinct()
    gone = in_scope(files, emptied, parts).select(F.regexp_replace("file", "/[^/]*$", "").alias("folder")).distinct()
    for r in gone.toLocalIterator():  # folders, a few at a time
        remove_scratch(spark, r.folder)
