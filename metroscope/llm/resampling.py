"""Importance resampling towards a target distribution over hashed word n-grams.

A 256-byte table lower-cases A-Z and blanks every separator byte of the UTF-8 text;
``bytes.split`` yields the words. The bucket of an n-gram is the crc32 of its bytes modulo
the number of buckets: crc32 of the first word, extended word by word with the value so far as
seed. ``Counter`` objects reduce the buckets of a text, and of a task before anything is
shuffled. The corpus and the target are each counted once by Spark; what reaches the driver is
one count per bucket and side (20,000 numbers at 10,000 buckets, whatever the corpus).

A text's weight is the sum of its buckets' log-ratio gains; a Gumbel number drawn from the
seed and the id is added, and the highest scores among the texts of enough words are drawn:
sampling without replacement in proportion to the weights. Ranks come from a range
exchange and the position inside each range, never from one task.

Defined results: null, empty and word-free texts have no features and weight 0; an empty target
or corpus counts zero in every bucket; a null id draws its Gumbel number from the empty text
and comes last among equal scores; repeated rows each take a rank of their own (equal ids
and scores are ordered by weight and number of features); a very long text is counted in one
pass in its task. Other columns are not read.
"""
from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroscope.llm.common import bounded, map_batches, rows_to_batch, written

BUCKETS = 10_000
MAX_N = 1
MIN_WORDS = 20
PERCENT = 10
SEED = 2024


def _byte_table() -> bytes:
    lowered = bytes(range(256)).lower()
    word = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
    return bytes(b if b in word else 0x20 for b in lowered)


TABLE = _byte_table()


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(TABLE).split() if text else []


def bucket_counts(words: list[bytes], max_n: int = MAX_N, buckets: int = BUCKETS) -> Counter:
    """Occurrences of each bucket over all runs of 1 to ``max_n`` words."""
    out: Counter = Counter()
    for word, n in Counter(words).items():
        out[zlib.crc32(word) % buckets] += n
    if max_n > 1:
        crcs = [zlib.crc32(w) for w in words]
        for size in range(2, max_n + 1):  # crcs[i]: the run of size - 1 words from word i
            crcs = [zlib.crc32(w, zlib.crc32(b" ", c)) for c, w in zip(crcs, words[size - 1:])]
            out.update(c % buckets for c in crcs)
    return out


def gumbel(seed: int, doc_id: object) -> int:
    """floor(-1000 ln(-ln u)) with u from the first 8 hex digits of sha256(``seed:id``)."""
    name = "" if doc_id is None else str(doc_id)
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def corpus_counts(texts: DataFrame, text_col: str = "text", max_n: int = MAX_N, buckets: int = BUCKETS) -> list[int]:
    """Feature occurrences per bucket over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in bounded(batches, "text"):
            for text in b.column("text"):
                total.update(bucket_counts(words_of(text.as_py()), max_n, buckets))
        yield pa.RecordBatch.from_arrays([pa.array(list(total.keys()), pa.int32()), pa.array(list(total.values()), pa.int64())],
                                         ["bucket", "n"])

    counted = map_batches(texts.select(F.col(text_col).alias("text")), run, "bucket int, n long")
    out = [0] * buckets
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket
        out[r.bucket] = r.n
    return out


def bucket_gains(source: list[int], target: list[int]) -> list[int]:
    """floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))) per bucket, in doubles."""
    b = float(len(source))
    s_all, t_all = float(sum(source)) + b, float(sum(target)) + b
    return [math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(source, target)]


def scores(docs: DataFrame, gains: list[int], seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
           max_n: int = MAX_N) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score`` of every row."""
    schema = pa.schema([("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in bounded(batches, "text"):
            rows = []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                words = words_of(text.as_py())
                counts = bucket_counts(words, max_n, len(gains))
                weight = sum(gains[k] * n for k, n in counts.items())
                rows.append((len(words), counts.total(), weight, weight + gumbel(seed, doc_id)))
            rest = rows_to_batch(rows, schema)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *rest.columns], ["doc_id", *schema.names])

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = src.schema["doc_id"].dataType.simpleString()
    return map_batches(src, run, f"doc_id {id_type}, n_words long, n_features long, weight long, score long")


def ranked(rows: DataFrame, keep: int, order: list) -> DataFrame:
    """``rows`` with ``rank`` 1, 2, 3 ... of the first ``keep`` in ``order`` (null after).

    A range exchange sorts; each row's position inside its range is written beside it, and
    the ranges' sizes (one number a range on the driver) give the offsets."""
    spark = rows.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    # the id holds the partition above 33 bits of position
    placed = written(spread.withColumn("at", F.monotonically_increasing_id()), "resample-order")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = {r.part: r.n for r in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, total = {}, 0
    for p in sorted(sizes):
        before[p], total = total, total + sizes[p]
    offsets = spark.createDataFrame(list(before.items()) or [(0, 0)], "part long, before long")
    rank = F.col("before") + place + 1
    return placed.withColumn("part", part).join(F.broadcast(offsets), "part").select(
        *rows.columns, F.when(rank <= keep, rank).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
             buckets: int = BUCKETS, max_n: int = MAX_N, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score``
    and ``rank`` among the drawn floor(percent * N / 100) of the N rows with at least
    ``min_words`` words (null: not drawn)."""
    gains = bucket_gains(corpus_counts(docs, text_col, max_n, buckets), corpus_counts(target, target_col, max_n, buckets))
    scored = written(scores(docs, gains, seed, id_col, text_col, max_n), "resample-scores")
    able = F.col("n_words") >= min_words
    n = scored.filter(able).count()
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight").desc(), F.col("n_features")]
    drawn = ranked(scored.filter(able), percent * n // 100, order)
    return drawn.unionByName(scored.filter(~able).withColumn("rank", F.lit(None).cast("long")))


def drawn_texts(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose id was drawn, all columns as they were."""
    found = resample(docs, target, id_col=id_col, **options).filter("rank is not null").select(F.col("doc_id").alias("drawn_id"))
    return docs.join(found.distinct(), docs[id_col].eqNullSafe(found["drawn_id"]), "left_semi")
