"""SimHash near-dedup by a segment-popcount embedding.

1. Fingerprint: 64 bit votes over the XXH64 of all word shingles (one pass, no shuffle).
2. Embedding: the 64 bits are cut into 32 segments of two bits; a fingerprint maps to
   the vector of its 32 segment bit counts (0, 1 or 2). One differing bit moves the vector
   by one, so the Manhattan distance of two vectors is a lower bound of the bit distance.
3. Grid range-join: two vectors within Manhattan distance 4 are within 2 on the first or
   on the second 16 segments, hence both lie within 1 of a common grid point of that half.
   Each distinct fingerprint is listed in the (at most 2 x 33) grid cells around it, and
   an equi-join of cells meets all pairs in range. A pair is taken in one agreed cell only.
4. Exact check: ``bit_count(a ^ b) <= 4``, inside the join condition.
5. Components by star contraction.

Equal fingerprints meet as one row. A dense knot of *different* near fingerprints would
still fill its cells with all pairs, so cells that hold many more rows than the embedding
spreads there by chance are not joined: their fingerprints are listed at all
bit strings within 2 flips and neighbours in each such list are chained. Two fingerprints
share a list exactly when they differ in 4 bits or fewer, and all members of a list
are linked pairwise or through its centre's list order (see ``_dense_links``), so the
way is exact and linear in the rows.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metroscope.llm.common import bounded, free_name, map_batches, space_words, written
from metroscope.llm.components import connected_components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
LISTED_ROWS = 50_000       # fingerprints listed by one task
DENSE_ROWS = 64            # a cell is dense above this many rows plus 4 times its chance load

_LOW = 0x55555555          # the low bit of each two-bit field
_HIGH = 0xAAAAAAAA
_HALF = 0xFFFFFFFF


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """SimHash of one text, unsigned. No words: zero."""
    words = space_words(text)
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - size + 1].tolist()
    ends = ends[size - 1:].tolist()
    votes, n = np.zeros(64, np.int64), len(starts)
    for at in range(0, n, 1 << 16):  # a very long text is counted in blocks
        part = slice(at, at + (1 << 16))
        h = np.array([xxhash.xxh64_intdigest(joined[s:e], seed) for s, e in zip(starts[part], ends[part])], "<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * votes > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id``, ``text_hash``, ``fp`` (signed) for every row."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"),
                      F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in bounded(batches, "text"):
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column("text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array(fps)],
                                             ["doc_id", "text_hash", "fp"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return map_batches(src, run, f"doc_id {kind}, text_hash long, fp long")


def _half(fp: Column, which: int) -> Column:
    """The 32 bits of one half as a non-negative long."""
    return (fp if which == 0 else F.shiftrightunsigned(fp, 32)).bitwiseAND(F.lit(_HALF))


def _counts(half: Column) -> Column:
    """Bit counts of the 16 two-bit segments, packed two bits a segment."""
    return half - F.shiftright(half, 1).bitwiseAND(F.lit(_LOW))


def _cells(fp: Column) -> Column:
    """Grid points within Manhattan distance 1 of the vector, for both halves (null: none)."""
    out = []
    for which in (0, 1):
        c, tag = _counts(_half(fp, which)), which << 32
        out.append(c + F.lit(tag))
        for s in range(0, 32, 2):
            one = F.shiftright(c, s).bitwiseAND(F.lit(3))
            out.append(F.when(one < 2, c + F.lit(tag + (1 << s))))
            out.append(F.when(one > 0, c + F.lit(tag - (1 << s))))
    return F.array(*out)


def _manhattan(x: Column) -> Column:
    """Manhattan distance of two packed vectors, from their XOR: fields 01 and 11 are a
    step of one, 10 is a step of two."""
    return F.bit_count(x.bitwiseAND(F.lit(_LOW))) + 2 * F.bit_count(
        F.shiftright(x, 1).bitwiseAND(F.bitwise_not(x)).bitwiseAND(F.lit(_LOW)))


def _meeting_cell(ca: Column, cb: Column) -> Column:
    """One step from ``ca`` towards ``cb`` along their lowest differing segment."""
    x = ca.bitwiseXOR(cb)
    low = x.bitwiseAND(-x)
    step = low.bitwiseAND(F.lit(_LOW)).bitwiseOR(F.shiftright(low.bitwiseAND(F.lit(_HIGH)), 1))
    field = step * 3
    return F.when(ca.bitwiseAND(field) < cb.bitwiseAND(field), ca + step).otherwise(ca - step)


def _chance(cell: Column) -> Column:
    """Share of evenly random fingerprints listed in a cell: 16 fields, a field is 1 with
    probability 1/2, 0 or 2 with 1/4 each; 33 - ones listings round a point."""
    ones = F.bit_count(cell.bitwiseAND(F.lit(_LOW)))
    return F.pow(F.lit(2.0), ones - 32) * (33 - ones)


def links(distinct_fps: DataFrame, total: int, dense_rows: int = DENSE_ROWS) -> DataFrame:
    """Pairs (``a``, ``b``) of different fingerprints (column ``fp``, no repeats) at 4 or
    fewer differing bits: every such pair outside the dense cells; inside, enough pairs
    to connect the same fingerprints."""
    # eight bytes become some fifty cells: spread by rows, not by the small size before
    # (two tasks at least: a single one would also take the whole join)
    spread = distinct_fps.repartition(2 + total // LISTED_ROWS, "fp")
    listed = spread.select("fp", F.explode(_cells(F.col("fp"))).alias("cell")).filter("cell is not null")
    listed = listed.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("cell"))).filter("n > 1")
    dense = F.col("n") > F.lit(dense_rows) + F.lit(4.0 * total) * _chance(F.col("cell"))
    a = listed.filter(~dense).select(F.col("cell"), F.col("fp").alias("a"))
    b = listed.filter(~dense).select(F.col("cell").alias("cell_b"), F.col("fp").alias("b"))
    ca, cb = F.col("a"), F.col("b")
    packed = [(_counts(_half(ca, w)), _counts(_half(cb, w))) for w in (0, 1)]
    first, second = (_manhattan(p.bitwiseXOR(q)) for p, q in packed)
    agreed = F.when(first <= MAX_BITS // 2, _meeting_cell(*packed[0])).otherwise(
        _meeting_cell(*packed[1]) + F.lit(1 << 32))
    pairs = a.join(b, (F.col("cell") == F.col("cell_b")) & (ca < cb)
                   & (F.bit_count(ca.bitwiseXOR(cb)) <= MAX_BITS)
                   & (first + second <= MAX_BITS) & (F.col("cell") == agreed)).select("a", "b")
    return pairs.unionByName(_dense_links(listed.filter(dense).select("fp").distinct()))


def _dense_links(fps: DataFrame) -> DataFrame:
    """Chains through all lists of fingerprints within 2 flips of a common bit string.

    Any two members of a list differ in at most 4 bits, so each chained pair is a link; any
    two fingerprints at 4 or fewer bits share a list, so each link is bridged by a chain."""
    flip = lambda c: F.when(F.col(c) < 64, F.expr(f"shiftleft(1L, {c})")).otherwise(F.lit(0).cast("long"))
    balls = (
        fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("i"))
        .select("fp", "i", F.explode(F.sequence(F.col("i"), F.lit(64))).alias("j"))
        .filter((F.col("i") < F.col("j")) | (F.col("i") == 64))
        .select("fp", F.col("fp").bitwiseXOR(flip("i")).bitwiseXOR(flip("j")).alias("centre"))
    )
    before = F.lag("fp").over(Window.partitionBy("centre").orderBy("fp"))
    return balls.select(before.alias("a"), F.col("fp").alias("b")).filter("a is not null").distinct()


def fingerprint_components(prints: DataFrame) -> DataFrame:
    """``fp`` -> ``root`` (a fingerprint) for all fingerprints that have a link."""
    fps = prints.select("fp").distinct()
    total = fps.count()
    return connected_components(links(fps, total)).select(F.col("node").alias("fp"), "root")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE_WORDS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``text_hash``, ``fingerprint`` (16 hex
    digits), ``component_id`` (smallest id reachable), ``root`` (smallest fingerprint of the
    component as a signed number; tells components apart where ids repeat).

    Null, empty and word-free texts have fingerprint zero and link like any other.
    Repeated rows share their fingerprint. A null id takes part and never becomes a
    component id, unless all ids of the component are null."""
    prints = written(fingerprints(docs, id_col, text_col, shingle), "simhash-prints")
    roots = written(fingerprint_components(prints), "simhash-roots")
    per_fp = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    rooted = per_fp.join(roots, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    by_fp = rooted.select("fp", "root").join(lowest, "root").select("fp", "root", "component_id")
    return prints.join(by_fp, "fp").select(
        "doc_id", "text_hash", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "root")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = SHINGLE_WORDS) -> DataFrame:
    """All columns of ``docs``, one row of each component: the one with the smallest id
    (a null id only where there is no other), of repeated ids the smallest text hash."""
    found = near_duplicates(docs, id_col, text_col, shingle)
    kept = found.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "text_hash")).alias("k"))
    ident, th = free_name(docs, "kept_id"), free_name(docs, "kept_hash")
    kept = kept.select(F.col("k.doc_id").alias(ident), F.col("k.text_hash").alias(th))
    row_hash = free_name(docs, "row_hash")
    marked = docs.withColumn(row_hash, F.xxhash64(F.col(text_col)))
    joined = marked.join(kept, F.col(id_col).eqNullSafe(F.col(ident)) & (F.col(row_hash) == F.col(th)))
    once = joined.dropDuplicates([ident, th])
    return once.select(*[F.col(f"`{c}`") for c in docs.columns])
