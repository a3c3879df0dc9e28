"""Helpers shared by the operators: written tables, free column names, word rules."""
from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metroscope.session import scratch_path

# The two word rules of the query contracts, as Java / RE2 pattern text.
SPACE_WORD = r"[^\x20\x09-\x0D]+"
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ALNUM_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20

UPPER_ASCII = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER_ASCII = UPPER_ASCII.lower()


def written(df: DataFrame, name: str, partition_by: Iterable[str] = ()) -> DataFrame:
    """Write ``df`` to a fresh folder below the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame, marked: str = "") -> None:
    """Delete the folders behind tables that ``written`` made and nothing reads any more: all
    that ``df`` reads, or those whose path holds ``marked``."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles() if marked in f}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, base: str) -> str:
    """``base``, or ``base_1``, ... - a column name ``df`` does not have (case ignored)."""
    taken = {c.lower() for c in df.columns}
    name, i = base, 0
    while name.lower() in taken:
        i += 1
        name = f"{base}_{i}"
    return name


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z only; every other character stays (``lower`` would fold all scripts)."""
    return F.translate(col, UPPER_ASCII, LOWER_ASCII)


def crc_mod(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % n


def space_words(text: str | None) -> list[bytes]:
    """Words of the SPACE_WORD rule over UTF-8, A-Z lower-cased (null: none).

    ``bytes.split`` cuts at exactly x20 and x09-x0D, ``bytes.lower`` folds exactly A-Z."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def map_batches(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow(run, schema)`` with small Arrow batches.

    Spark cuts batches by rows (10,000 unless set), which for long texts is far more memory
    than a task needs, on both sides of the pipe. The session's limits are lowered to
    ``BATCH_ROWS`` rows and ``BATCH_BYTES`` bytes where they are higher, never raised."""
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
                      ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = conf.get(key).rstrip("b")
        if now.lstrip("-").isdigit() and not 0 < int(now) <= most:
            conf.set(key, str(most))
    return df.mapInArrow(run, schema)


def bounded(batches: Iterator[pa.RecordBatch], text_col: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Re-cut Arrow batches so that each holds at most about ``limit`` bytes of text (one
    row at least), so that memory does not depend on how long the documents are."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lengths = [0 if x is None else x for x in _byte_lengths(batch.column(text_col))]
        start, size = 0, 0
        for i, n in enumerate(lengths):
            if i > start and size + n > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        yield batch.slice(start)


def _byte_lengths(col: pa.Array) -> list[Any]:
    import pyarrow.compute as pc

    return pc.binary_length(col).to_pylist()


def rows_to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    from metroscope.sources.tables import read

    return read(spark, sf_dir, name)
