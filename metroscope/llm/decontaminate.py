"""Benchmark decontamination by winnowing.

Both sides keep, of every window of 9 consecutive 5-word hashes (13 words), the smallest
hash (the rightmost of equal ones). A span of 13 words that occurs on both sides is the
same window there, so both keep the same hash at the same place: the join of the
fingerprints cannot miss it. Items of fewer than 13 words are one window each and are
looked up by the hash of the whole item at every document position.

A fixed-size bitmap of the benchmark's hashes (512 KiB whatever the benchmark's size)
travels with the tasks and drops document fingerprints that surely have no partner before
the Spark join. Hits are then extended: every 13-word window round a hit is compared word
by word with the windows of the items that hit, and the marked windows are merged.

Defined results: null or empty texts have no words and are never contaminated; repeated
rows are judged alike; items with equal words are compared once and reported one by one;
items without words never occur; a null item id marks words but is not reported.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroscope.llm.common import bounded, free_name, map_batches, written
from metroscope.llm.wordhash import ALNUM, grams, hash_words

SPAN = 13                 # words in a window
GRAM = 5                  # words in a fingerprint
FILTER_BITS = 1 << 22     # size of the bitmap
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    """Words of the ALNUM_WORD rule, A-Z lower-cased."""
    return _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


def winnow(hashes: np.ndarray, bounds: np.ndarray, span: int = SPAN, k: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(word index, hash) of the kept k-grams of all texts; windows never cross a text."""
    g, w = grams(hashes, k), span - k + 1
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    n = len(g) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    best, at = g[:n].copy(), np.arange(n)
    for i in range(1, w):
        later = g[i:i + n]
        take = later <= best
        best = np.where(take, later, best)
        at = np.where(take, np.arange(i, i + n), at)
    at = np.unique(at[owner[:n] == owner[span - 1:span - 1 + n]])
    return at, g[at]


def short_grams(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(word index, hash) of all runs of ``size`` words within a text."""
    g = grams(hashes, size)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at = np.flatnonzero(owner[:len(g)] == owner[size - 1:]) if len(g) else np.zeros(0, np.int64)
    return at, g[at] ^ np.uint64(size)


def item_classes(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item_id``, ``class`` (digest of the words), ``words`` (space-joined), ``size``."""
    src = benchmark.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in bounded(batches, "text"):
            words = [words_of(t.as_py()) for t in b.column("text")]
            joined = [b" ".join(w) for w in words]
            yield pa.RecordBatch.from_arrays(
                [b.column("item_id"), pa.array([hashlib.sha256(j).hexdigest() for j in joined]),
                 pa.array(joined, pa.binary()), pa.array([len(w) for w in words], pa.int32())],
                ["item_id", "class", "words", "size"])

    return map_batches(src, run, "item_id string, class string, words binary, size int").filter("size > 0")


def class_prints(classes: DataFrame, span: int, k: int) -> DataFrame:
    """``hash``, ``class`` of every fingerprint of every item class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, joined in zip(b.column("class").to_pylist(), b.column("words").to_pylist()):
                w = hash_words([joined.decode("utf-8", "surrogatepass")], ALNUM)
                n = len(w.hashes)
                _, h = winnow(w.hashes, w.bounds, span, k) if n >= span else short_grams(w.hashes, w.bounds, n)
                h = np.unique(h).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array([name] * len(h), pa.string())], ["hash", "class"])

    return map_batches(classes, run, "hash long, class string")


def hash_bitmap(prints: DataFrame) -> np.ndarray:
    """One bit for each of the low FILTER_BITS hash values that occurs, as bytes. Spark
    builds it in pieces of 4 KiB; only the finished pieces (512 KiB in all) are fetched."""
    low = F.col("hash").bitwiseAND(F.lit(FILTER_BITS - 1))
    pieces = prints.groupBy(F.shiftright(low, 15).alias("piece")).agg(
        F.bitmap_construct_agg(low.bitwiseAND(F.lit(32767))).alias("bits")).collect()
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for p in pieces:
        out[p.piece * 4096:(p.piece + 1) * 4096] = np.frombuffer(p.bits, np.uint8)
    return out


def candidates(docs: DataFrame, id_col: str, text_col: str, bitmap: np.ndarray, sizes: list[int],
               span: int, k: int) -> DataFrame:
    """Per document: ``doc_id``, ``text_hash``, ``n_words``, ``spots`` (fingerprints that
    may have a partner: hash, word index, window size) and, only where there is a spot,
    the text."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"),
                      F.col(text_col).alias("text"))
    kind = pa.list_(pa.struct([("hash", pa.int64()), ("pos", pa.int32()), ("size", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in bounded(batches, "text", 2 << 20):
            texts = b.column("text").to_pylist()
            w = hash_words(texts, ALNUM)
            found = [(*winnow(w.hashes, w.bounds, span, k), span)]
            found += [(*short_grams(w.hashes, w.bounds, s), s) for s in sizes]
            pos, hsh, size = [], [], []
            for at, h, s in found:
                low = h & np.uint64(FILTER_BITS - 1)
                ok = (bitmap[low >> np.uint64(3)] >> (low & np.uint64(7)).astype(np.uint8)) & 1 > 0
                pos.append(at[ok])
                hsh.append(h[ok])
                size.append(np.full(int(ok.sum()), s, np.int32))
            pos, hsh, size = map(np.concatenate, (pos, hsh, size))
            order = np.argsort(pos, kind="stable")
            pos, hsh, size = pos[order], hsh[order], size[order]
            cuts = np.searchsorted(pos, w.bounds)
            start = np.repeat(w.bounds[:-1], np.diff(cuts))
            spots = pa.StructArray.from_arrays(
                [pa.array(hsh.view(np.int64)), pa.array((pos - start).astype(np.int32)), pa.array(size)],
                ["hash", "pos", "size"])
            kept = [t if n else None for t, n in zip(texts, np.diff(cuts))]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_hash"), pa.array(np.diff(w.bounds)),
                 pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), spots).cast(kind), pa.array(kept, pa.string())],
                ["doc_id", "text_hash", "n_words", "spots", "text"])

    doc_kind = src.schema["doc_id"].dataType.simpleString()
    return map_batches(src, run, f"doc_id {doc_kind}, text_hash long, n_words long, "
                               "spots array<struct<hash:long,pos:int,size:int>>, text string")


def extend(text: str, spots: list[dict], classes: list[dict], span: int, k: int) -> tuple[int, list[str]]:
    """Words of ``text`` inside an occurring window, and the classes that occur.

    Every window that contains a hit is compared; neighbouring windows merge into longer
    spans through the marks they share."""
    words = words_of(text)
    windows: dict[bytes, set[str]] = {}
    for c in classes:
        own = c["words"].split(b" ")
        size = min(span, len(own))
        for i in range(len(own) - size + 1):
            windows.setdefault(b" ".join(own[i:i + size]), set()).add(c["class"])
    marked, seen, found = np.zeros(len(words) + 1, np.int32), set(), set()
    for s in spots:
        size = s["size"]
        first = max(0, s["pos"] - (span - k)) if size == span else s["pos"]
        for at in range(first, min(s["pos"], len(words) - size) + 1):
            if (at, size) in seen:
                continue
            seen.add((at, size))
            if hit := windows.get(b" ".join(words[at:at + size])):
                found |= hit
                marked[at] += 1
                marked[at + size] -= 1
    return int((np.cumsum(marked) > 0).sum()), sorted(found)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", span: int = SPAN, k: int = GRAM) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``text_hash``, ``n_words``, ``n_hit``,
    ``n_items``, ``items_sha256``, ``contaminated`` (a hit, and 5 % of the words at least)."""
    items = written(item_classes(benchmark, item_id, item_text), "decon-items")
    classes = items.groupBy("class").agg(F.first("words").alias("words"), F.first("size").alias("size"))
    prints = written(class_prints(classes.select("class", "words"), span, k), "decon-prints")
    bitmap = hash_bitmap(prints)
    sizes = sorted(r["size"] for r in classes.filter(F.col("size") < span).select("size").distinct().collect())  # < span
    base = written(candidates(docs, id_col, text_col, bitmap, sizes, span, k), "decon-docs")

    ident = ["doc_id", "text_hash"]
    spots = base.select(*ident, F.explode("spots").alias("s")).select(*ident, "s.hash", "s.pos", "s.size")
    per_doc = (
        spots.join(prints, "hash").join(classes.select("class", "words"), "class")
        .groupBy(*ident).agg(F.collect_set(F.struct("pos", "size")).alias("spots"),
                             F.collect_set(F.struct("class", "words")).alias("classes"))
    )
    texts = base.filter(F.col("text").isNotNull()).select(*ident, "text").dropDuplicates(ident)
    p, t = per_doc.alias("p"), texts.alias("t")
    both = p.join(t, F.col("p.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("p.text_hash") == F.col("t.text_hash")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = [extend(t, s, c, span, k) for t, s, c in zip(
                b.column("text").to_pylist(), b.column("spots").to_pylist(), b.column("classes").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_hash"), pa.array([d[0] for d in done], pa.int64()),
                 pa.array([d[1] for d in done], pa.list_(pa.string()))], [*ident, "n_hit", "found"])

    doc_kind = base.schema["doc_id"].dataType.simpleString()
    hit = map_batches(
        both.select("p.doc_id", "p.text_hash", "spots", "classes", "text"), run, f"doc_id {doc_kind}, text_hash long, n_hit long, found array<string>").filter("n_hit > 0")
    hit = written(hit, "decon-hits")
    listed = (
        hit.select(*ident, F.explode("found").alias("class"))
        .join(items.filter("item_id is not null").select("class", "item_id").distinct(), "class")
        .groupBy(*ident).agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    )
    h, i = hit.select(*ident, "n_hit").alias("h"), listed.alias("i")
    judged = h.join(i, F.col("h.doc_id").eqNullSafe(F.col("i.doc_id")) & (F.col("h.text_hash") == F.col("i.text_hash")), "left")
    judged = judged.select(F.col("h.doc_id").alias("hit_id"), F.col("h.text_hash").alias("hit_hash"), "n_hit", "ids")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return base.select(*ident, "n_words").join(
        judged, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash")), "left",
    ).select(
        *ident, "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) that are not contaminated."""
    ident, th = free_name(docs, "bad_id"), free_name(docs, "bad_hash")
    bad = contamination(docs, benchmark, id_col, text_col).filter("contaminated").select(
        F.col("doc_id").alias(ident), F.col("text_hash").alias(th)).distinct()
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col(ident)) & (F.xxhash64(F.col(text_col)) == F.col(th)), "left_anti")
