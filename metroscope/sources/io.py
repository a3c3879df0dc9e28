"""Sources and sinks (S1-S12): JSON batches, JSONL, TSV, CSV and partitioned parquet.

Readers take explicit schemas (no inference on the hot path); writers partition by
the keys downstream jobs prune on and use dynamic partition overwrite.
"""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def require_columns(df: DataFrame, required: Iterable[str], what: str) -> DataFrame:
    """Fail with the sorted list of missing columns (schema only, no job)."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{what}: no column {', '.join(missing)}")
    return df


def read_json_batch(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON-array payload files; a non-list payload or non-object record fails.

    Spark reads a top-level array as one row per element, but also takes a single object
    for one row, so the first character of every payload is checked before (an action; a
    payload is one service response). Elements that do not fit the schema fail the read."""
    not_a_list = _whole_files(spark, path).filter(~F.ltrim(F.regexp_replace("value", r"[\s\uFEFF]+", " ")).startswith("["))
    wrong = [r.file for r in not_a_list.select("file").limit(10).collect()]
    if wrong:
        raise ValueError("payload is not a JSON list: " + ", ".join(wrong))
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def _whole_files(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    reader = spark.read.option("wholetext", True)
    if name:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", name)
    return reader.text(path).withColumn("file", F.input_file_name())


def read_landing(spark: SparkSession, root: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """S1 + S2 on the landing layout: below ``root``, every ``batch_id=<id>`` folder holds the
    payload ``response.json`` beside its ``manifest.json``. Returns the records, stamped
    with the folder's batch id, and the manifests."""
    files = _whole_files(spark, root, "response.json").filter(
        ~F.ltrim(F.regexp_replace("value", r"[\s\uFEFF]+", " ")).startswith("["))
    wrong = [r.file for r in files.select("file").limit(10).collect()]
    if wrong:
        raise ValueError("payload is not a JSON list: " + ", ".join(wrong))
    batch = F.url_decode(F.regexp_extract(F.input_file_name(), "batch_id=([^/]+)/", 1))
    records = (spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").option("recursiveFileLookup", True)
               .option("pathGlobFilter", "response.json").json(root).withColumn("batch_id", batch))
    return records, read_manifests(spark, root, name="manifest.json")


# Fields of a 311 API record, with their alternative names.
OPEN311_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in (
        "service_request_id", "status", "service_name", "service_code", "description", "requested_datetime",
        "updated_datetime", "closed_datetime", "address", "media_url")]
    + [T.StructField(c, T.DoubleType()) for c in ("lat", "latitude", "long", "lon", "longitude")]
)

# The fields of a manifest.
MANIFEST_FIELDS = ("city", "batch_id", "ingested_at_utc")


def read_manifests(spark: SparkSession, path: str, one_document_per_file: bool = True, name: str | None = None) -> DataFrame:
    """Manifest files (one JSON document per file, or JSON lines; only files called
    ``name``, at any depth, if given). Each must carry its three fields, and a batch has one
    manifest: two different ones fail, exact repeats count once."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in MANIFEST_FIELDS])
    reader = spark.read.schema(schema).option("multiLine", one_document_per_file)
    if name:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", name)
    m = reader.json(path).distinct()
    incomplete = F.greatest(*[F.col(c).isNull() for c in MANIFEST_FIELDS])
    checks = m.groupBy("batch_id").agg(F.max(incomplete).alias("incomplete"), F.count(F.lit(1)).alias("n"))
    wrong = checks.filter("incomplete or n > 1").limit(10).collect()
    if wrong:
        raise ValueError("manifests without " + ", ".join(MANIFEST_FIELDS) + " or more than one for a batch: "
                         + ", ".join(str(r.batch_id) for r in wrong))
    return m


def write_jsonl(df: DataFrame, path: str, partition_cols: Iterable[str] = ()) -> None:
    """One JSON object per line, partitioned (year/month/day/city/batch_id).

    With partition columns only the partitions in ``df`` are replaced, whatever the
    session's overwrite mode; without, the folder is."""
    cols = list(partition_cols)
    w = (df.hint("rebalance", *cols) if cols else df).write.mode("overwrite")
    if cols:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*cols)
    w.json(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S3: a malformed line fails the read (FAILFAST). ``require_json_lines`` names it."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def bad_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``file``, ``line`` (from 1) and ``text`` of every line that does not fit ``schema``.

    A file is read in splits, on many machines at once, and no split knows how many lines stand
    before it. So lines are counted per split, the counts of a file's earlier splits are
    added up (one row a split), and a line's number is that sum plus its place in its split."""
    corrupt = "_unread"
    read = T.StructType([f for f in schema.fields if f.name != corrupt] + [T.StructField(corrupt, T.StringType())])
    place = F.monotonically_increasing_id()  # rows of a split are neighbours, in order
    split = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")]
    lines = spark.read.text(path).select(*split, "value", place.alias("place"))
    parsed = F.from_json("value", read, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    wrong = lines.withColumn("bad", F.ifnull((F.trim("value") != "") & parsed[corrupt].isNotNull(), F.lit(False)))
    splits = wrong.groupBy("file", "start").agg(
        F.count(F.lit(1)).alias("n"), F.min("place").alias("first"), F.collect_list(F.when(F.col("bad"), F.struct("place", "value"))).alias("bad"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    counted = splits.select("file", "first", F.ifnull(F.sum("n").over(earlier), F.lit(0)).alias("before"), "bad")
    return counted.select("file", "before", "first", F.explode("bad").alias("b")).select(
        "file", (F.col("before") + F.col("b.place") - F.col("first") + 1).alias("line"), F.col("b.value").alias("text"))


def require_json_lines(spark: SparkSession, path: str, schema: T.StructType, most: int = 10) -> None:
    """S3: fail with the file and line of the first ``most`` bad lines, if there are any."""
    wrong = bad_json_lines(spark, path, schema).orderBy("file", "line").limit(most).collect()
    if wrong:
        raise ValueError("bad JSON lines: " + "; ".join(f"{r.file}, line {r.line}: {r.text[:80]}" for r in wrong))


def write_partitioned(df: DataFrame, root: str, partition_cols: Iterable[str], files_per_partition: int | None = None) -> None:
    """Parquet, dynamic partition overwrite (only touched partitions replaced).

    Rows are clustered by the partition columns first so each task writes few files; a
    partition that holds a third of all rows is split over several tasks and files
    (``rebalance``). No global sort is used. ``files_per_partition`` merges into that many
    output tasks instead.
    """
    cols = list(partition_cols)
    out = df.hint("rebalance", *cols) if files_per_partition is None else df.coalesce(files_per_partition)
    (
        out.sortWithinPartitions(*cols)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*cols)
        .parquet(root)
    )


def read_parquet_required(spark: SparkSession, path: str, required: Iterable[str], what: str) -> DataFrame:
    """Parquet + required-column check."""
    return require_columns(spark.read.parquet(path), required, what)


# The 58 tab-separated columns of the news-event export, in file order.
NEWS_COLUMNS = (
    "GLOBALEVENTID", "SQLDATE", "MonthYear", "Year", "FractionDate",
    "Actor1Code", "Actor1Name", "Actor1CountryCode", "Actor1KnownGroupCode",
    "Actor1EthnicCode", "Actor1Religion1Code", "Actor1Religion2Code",
    "Actor1Type1Code", "Actor1Type2Code", "Actor1Type3Code",
    "Actor2Code", "Actor2Name", "Actor2CountryCode", "Actor2KnownGroupCode",
    "Actor2EthnicCode", "Actor2Religion1Code", "Actor2Religion2Code",
    "Actor2Type1Code", "Actor2Type2Code", "Actor2Type3Code",
    "IsRootEvent", "EventCode", "EventBaseCode", "EventRootCode",
    "QuadClass", "GoldsteinScale", "NumMentions", "NumSources", "NumArticles", "AvgTone",
    "Actor1Geo_Type", "Actor1Geo_FullName", "Actor1Geo_CountryCode", "Actor1Geo_ADM1Code",
    "Actor1Geo_Lat", "Actor1Geo_Long", "Actor1Geo_FeatureID",
    "Actor2Geo_Type", "Actor2Geo_FullName", "Actor2Geo_CountryCode", "Actor2Geo_ADM1Code",
    "Actor2Geo_Lat", "Actor2Geo_Long", "Actor2Geo_FeatureID",
    "ActionGeo_Type", "ActionGeo_FullName", "ActionGeo_CountryCode", "ActionGeo_ADM1Code",
    "ActionGeo_Lat", "ActionGeo_Long", "ActionGeo_FeatureID",
    "DATEADDED", "SOURCEURL",
)
NEWS_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in NEWS_COLUMNS])


def read_news_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Headerless 58-column TSV, all text: a line with fewer fields is padded with nulls,
    a line with more is skipped, a blank line is no row. Lines are cut here rather than by
    the CSV reader, whose idea of a malformed line changes with the selected columns. A
    field may be quoted as a whole (no tab inside). Files are split by Spark, so no chunking
    is needed for 1-2 GB daily exports.

    A line is cut, and its fields are cleaned, once: the exploded array of one element keeps the
    optimizer from copying that into every column and filter that uses a field, and 58 plain
    look-ups stay small enough for the JVM to compile. Quotes are looked for only in lines that
    have one.
    """
    quoted = r'^"(.*)"$'
    present = lambda c: F.nullif(c, F.lit(""))

    def plain(c: Column) -> Column:
        return F.when(c.rlike(quoted), F.replace(F.regexp_extract(c, quoted, 1), F.lit('""'), F.lit('"'))).otherwise(c)

    cut = F.split("value", "\t", -1)
    clean = F.when(F.contains("value", F.lit('"')), F.transform(cut, lambda c: present(plain(c)))).otherwise(F.transform(cut, present))
    lines = spark.read.text(path).filter(F.trim("value") != "").select(F.explode(F.array(clean)).alias("fields"))
    return lines.filter(F.size("fields") <= len(NEWS_COLUMNS)).select(
        *[F.get("fields", F.lit(i)).alias(c) for i, c in enumerate(NEWS_COLUMNS)])


def write_news_csv(df: DataFrame, root: str) -> None:
    """Filtered events as CSV with header under ``obs_date=`` partitions.

    Rows are clustered by day, and a large day is split over several files. The files are
    gzipped: most of the 58 columns of a line repeat from row to row."""
    (df.hint("rebalance", "obs_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("header", True).option("compression", "gzip").partitionBy("obs_date").csv(root))


def read_news_csv(spark: SparkSession, root: str) -> DataFrame:
    """The files of ``write_news_csv``: ``obs_date``, ``city`` and the export columns."""
    schema = T.StructType([T.StructField("city", T.StringType()), *NEWS_SCHEMA.fields, T.StructField("obs_date", T.DateType())])
    return spark.read.schema(schema).option("header", True).csv(root)


def read_mapping_csv(spark: SparkSession, path: str) -> DataFrame:
    """Mapping CSV with header and the four required columns."""
    schema = "raw_category string, normalized_category string, is_infrastructure int, is_emergency_type int"
    df = spark.read.option("header", True).schema(schema).csv(path)
    return require_columns(df, ("raw_category", "normalized_category", "is_infrastructure", "is_emergency_type"), "Mapping file")


def date_range_filter(df: DataFrame, ts_col: str, start, end_exclusive) -> DataFrame:
    """``ts >= start AND ts < end`` keeps parquet pushdown (never ``to_date(ts) = d``)."""
    return df.filter((F.col(ts_col) >= F.lit(start)) & (F.col(ts_col) < F.lit(end_exclusive)))
