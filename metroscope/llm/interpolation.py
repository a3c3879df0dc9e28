"""Language-model scoring by deleted interpolation.

A word bigram model: ``P(w | v) = l2(b) c(vw) / c(v) + l1(b) c(w) / N + l0(b) / (V + 1)``,
where ``b`` is the frequency bucket of the context ``v`` (powers of two) and the weights of
each bucket come from expectation-maximisation: the training documents are parted, the
maximum-likelihood estimates of the larger part predict the tokens of the deleted part, and
the weights that explain those held-out counts best are kept. The final estimates use the
counts of all training documents. Unseen words share the one class behind the V known ones.

How it runs. Documents are tokenised once into blocks (a few megabytes of text each: the
block's distinct word hashes and, for each token, its place among them), written to the
shared folder. A block then asks for the corpus counts of its distinct words and word
pairs: the questions, already summed within the block, are shuffled by hash range, counted
there, and the answers go back to the block, which scores its documents. No task holds
more than its block or its hash range, a frequent word is one question per block, and
nothing but the bucketed held-out histogram reaches the driver. Counts cover every
training document; words and pairs are told apart by 64-bit hashes.

Defined results: a null or empty text is one end token; a null id is not held out and
counts as training; repeated rows count and are scored one by one; without training
documents N and V are zero and every token has the uniform probability of one class.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from metroscope.llm.common import crc_mod, map_batches, written
from metroscope.llm.wordhash import SPACE, combine, hash_words

BLOCK_BYTES = 4 << 20        # text in a block (one document at least)
HASH_BYTES = 2 << 20         # text hashed at once
RANGE_BYTES = 8 << 20       # questions counted at once
DEV_PART = 1                 # training documents with this remainder are the deleted part
END = np.uint64(0x1D8E4E27C47D124F)
START = np.uint64(0xEB44ACCAB455D165)
BUCKETS = 32
STEPS = 8                    # histogram steps per power of two
EM_ROUNDS = 100


# --- compact arrays --------------------------------------------------------------------
def pack(a: np.ndarray) -> bytes:
    """Bytes by significance, so that the many zero bytes lie together and compress."""
    return a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes()


def unpack(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).reshape(-1).view(kind)


def pack_sorted(a: np.ndarray) -> bytes:
    return pack(np.diff(a, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


# --- blocks ----------------------------------------------------------------------------
def block_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct token hashes, place of every token among them, first token of each
    text and the total). Every text ends with the end token."""
    hashes, bounds, at = [], [0], 0
    while at < len(texts):
        size, stop = 0, at
        while stop < len(texts) and (stop == at or size + len(texts[stop] or "") <= HASH_BYTES):
            size += len(texts[stop] or "")
            stop += 1
        w = hash_words(texts[at:stop], SPACE)
        hashes.append(np.insert(w.hashes, w.bounds[1:], END))
        bounds.extend((bounds[-1] + np.cumsum(np.diff(w.bounds) + 1)).tolist())
        at = stop
    words, tokens = np.unique(np.concatenate(hashes), return_inverse=True)
    return words, tokens.astype(np.uint32), np.array(bounds, np.int64)


def make_blocks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``block``, ``dev`` (block of the deleted part), ``n_train`` tokens and documents, and
    the block's ids, remainders, bounds, words and tokens."""
    key = F.col(id_col)
    src = docs.select(key.alias("doc_id"), F.coalesce(crc_mod(key, 10), F.lit(2)).cast("int").alias("part"),
                      F.col(text_col).alias("text"))
    id_type = to_arrow_type(src.schema["doc_id"].dataType)
    names = ["block", "dev", "train_tokens", "train_docs", "ids", "parts", "bounds", "words", "tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = 0
        waiting: dict[bool, list[tuple]] = {False: [], True: []}
        size = {False: 0, True: 0}

        def flush(dev: bool) -> pa.RecordBatch:
            nonlocal serial
            rows, waiting[dev], size[dev] = waiting[dev], [], 0
            words, tokens, bounds = block_of([r[2] for r in rows])
            parts = np.array([r[1] for r in rows], np.uint8)
            lengths = np.diff(bounds)
            serial += 1
            return pa.RecordBatch.from_arrays([
                pa.array([(TaskContext.get().partitionId() << 24) + serial], pa.int64()), pa.array([dev]),
                pa.array([int(lengths[parts != 0].sum())], pa.int64()), pa.array([int((parts != 0).sum())], pa.int64()),
                pa.array([[r[0] for r in rows]], pa.list_(id_type)), pa.array([parts.tobytes()], pa.binary()),
                pa.array([bounds.tobytes()], pa.binary()), pa.array([pack_sorted(words)], pa.binary()),
                pa.array([pack(tokens)], pa.binary())], names)

        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("doc_id", "part", "text"))):
                dev, n = row[1] == DEV_PART, len(row[2] or "")
                if waiting[dev] and size[dev] + n > BLOCK_BYTES:
                    yield flush(dev)
                waiting[dev].append(row)
                size[dev] += n
        for dev in (False, True):
            if waiting[dev]:
                yield flush(dev)

    kind = src.schema["doc_id"].dataType.simpleString()
    return map_batches(src, run, f"block long, dev boolean, train_tokens long, train_docs long, ids array<{kind}>, "
                               "parts binary, bounds binary, words binary, tokens binary")


class Block:
    """One block row, with its distinct word pairs."""

    def __init__(self, row: dict) -> None:
        self.words = unpack_sorted(row["words"])
        self.tokens = unpack(row["tokens"], np.uint32).astype(np.int64)
        self.bounds = np.frombuffer(row["bounds"], np.int64)
        self.parts = np.frombuffer(row["parts"], np.uint8)
        self.owner = np.repeat(np.arange(len(self.parts)), np.diff(self.bounds))
        self.before = np.concatenate([[0], self.tokens[:-1]])
        self.opens = np.zeros(len(self.tokens), bool)
        self.opens[self.bounds[:-1]] = True
        context = np.where(self.opens, START, self.words[self.before])
        self.pairs, self.pair_of = np.unique(combine(context, self.words[self.tokens]), return_inverse=True)

    def counts(self, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences in the kept and in the deleted part of the block's training texts."""
        part = self.parts[self.owner]
        kept, dev = (part != 0) & (part != DEV_PART), part == DEV_PART
        return np.bincount(of[kept], minlength=n), np.bincount(of[dev], minlength=n)


# --- questions and answers -------------------------------------------------------------
def questions(blocks: DataFrame, ranges: int) -> DataFrame:
    """``kind`` (0 words, 1 pairs), ``range``, ``block``, keys and their block counts."""
    shift = np.uint64(64 - (ranges - 1).bit_length()) if ranges > 1 else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                block = Block(row)
                for kind, keys, of in ((0, block.words, block.tokens), (1, block.pairs, block.pair_of)):
                    kept, dev = block.counts(of, len(keys))
                    home = (keys >> shift).astype(np.int64) if shift is not None else np.zeros(len(keys), np.int64)
                    cuts = np.searchsorted(home, np.arange(ranges + 1))
                    some = np.flatnonzero(np.diff(cuts))
                    parts = [slice(cuts[r], cuts[r + 1]) for r in some]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(some), kind, np.int32)), pa.array(some.astype(np.int32)),
                        pa.array([row["block"]] * len(some), pa.int64()),
                        pa.array([pack_sorted(keys[p]) for p in parts], pa.binary()),
                        pa.array([pack(kept[p].astype(np.uint32)) for p in parts], pa.binary()),
                        pa.array([pack(dev[p].astype(np.uint32)) for p in parts], pa.binary())],
                        ["kind", "range", "block", "keys", "kept", "dev"])

    return map_batches(blocks, run, "kind int, range int, block long, keys binary, kept binary, dev binary")


def answers(asked: DataFrame) -> DataFrame:
    """Corpus counts for every question, in the question's order: ``block``, ``kind``,
    ``range``, ``kept`` (without the deleted part), ``whole``, and ``types`` (distinct training
    keys, told once a range)."""

    def count(group: pa.Table) -> pa.Table:
        blocks = group.column("block").to_pylist()
        keys = [unpack_sorted(k) for k in group.column("keys").to_pylist()]
        sizes = np.cumsum([0, *map(len, keys)])
        _, where = np.unique(np.concatenate(keys), return_inverse=True)
        total = {}
        for part in ("kept", "dev"):
            own = np.concatenate([unpack(c, np.uint32) for c in group.column(part).to_pylist()])
            total[part] = np.bincount(where, weights=own).astype(np.uint32)
        whole = total["kept"] + total["dev"]
        slices = [where[sizes[i]:sizes[i + 1]] for i in range(len(blocks))]
        return pa.table({
            "block": pa.array(blocks, pa.int64()), "kind": group.column("kind"), "range": group.column("range"),
            "kept": pa.array([pack(total["kept"][s]) for s in slices], pa.binary()),
            "whole": pa.array([pack(whole[s]) for s in slices], pa.binary()),
            "types": pa.array([int((whole > 0).sum())] + [0] * (len(blocks) - 1), pa.int64())})

    return asked.groupBy("kind", "range").applyInArrow(
        count, "block long, kind int, range int, kept binary, whole binary, types long")


def _answered(answer: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the block's words and of its pairs, in key order."""
    rows = sorted(answer.select(["kind", "range", "n"]).to_pylist(), key=lambda r: (r["kind"], r["range"]))
    words, pairs = (np.concatenate([unpack(r["n"], np.uint32) for r in rows if r["kind"] == k]).astype(np.float64) for k in (0, 1))
    return words, pairs


def _bucket(contexts: np.ndarray) -> np.ndarray:
    return np.minimum(np.ceil(np.log2(contexts + 1)).astype(np.int64), BUCKETS - 1)


def _divided(a: np.ndarray, b: np.ndarray | float) -> np.ndarray:
    return np.divide(a, b, out=np.zeros(len(a)), where=np.asarray(b) > 0)


def _step(p: np.ndarray) -> np.ndarray:
    """Histogram step of a probability (0 for zero)."""
    logs = np.log2(p, out=np.full(len(p), -np.inf), where=p > 0)
    return np.where(p > 0, 1 + np.round(-logs * STEPS), 0).astype(np.int32)


def held_out_histogram(blocks: DataFrame, answer: DataFrame, kept_tokens: int, kept_docs: int) -> DataFrame:
    """``bucket``, ``s2``, ``s1`` (steps of the two estimates), ``n`` tokens of the deleted
    part. At most BUCKETS * (64 * STEPS) ** 2 rows, in practice some thousands."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = left.to_pylist()
        if not rows:
            return pa.table({c: pa.array([], t) for c, t in (("bucket", pa.int32()), ("s2", pa.int32()), ("s1", pa.int32()), ("n", pa.int64()))})
        block, (words, pairs) = Block(rows[0]), _answered(right)
        context = np.where(block.opens, float(kept_docs), words[block.before])
        p2 = _divided(pairs[block.pair_of], context)
        p1 = _divided(words[block.tokens], float(kept_tokens))
        cells, n = np.unique(np.stack([_bucket(context), _step(p2), _step(p1)], axis=1), axis=0, return_counts=True)
        return pa.table({"bucket": pa.array(cells[:, 0].astype(np.int32)), "s2": pa.array(cells[:, 1].astype(np.int32)),
                         "s1": pa.array(cells[:, 2].astype(np.int32)), "n": pa.array(n.astype(np.int64))})

    dev = blocks.filter("dev")
    mine = answer.join(dev.select("block"), "block", "left_semi").select("block", "kind", "range", F.col("kept").alias("n"))
    return dev.groupBy("block").cogroup(mine.groupBy("block")).applyInArrow(
        run, "bucket int, s2 int, s1 int, n long").groupBy("bucket", "s2", "s1").agg(F.sum("n").alias("n"))


def learn_weights(cells: np.ndarray, classes: float, rounds: int = EM_ROUNDS) -> np.ndarray:
    """(BUCKETS, 3) weights of pair, word and uniform estimate by expectation-maximisation.

    ``cells`` rows are (bucket, s2, s1, n). A bucket without held-out tokens takes the
    weights of all buckets together; one pseudo-token spread evenly keeps them positive."""

    def value(step: np.ndarray) -> np.ndarray:
        return np.where(step > 0, 2.0 ** (-(step - 1) / STEPS), 0.0)

    def run(rows: np.ndarray) -> np.ndarray:
        w = np.full(3, 1 / 3)
        if not len(rows):
            return w
        p = np.stack([value(rows[:, 1]), value(rows[:, 2]), np.full(len(rows), 1 / classes)], axis=1)
        n = rows[:, 3:4].astype(np.float64)
        for _ in range(rounds):
            mixed = p * w
            share = (n * mixed / mixed.sum(axis=1, keepdims=True)).sum(axis=0) + 1 / 3
            w = share / share.sum()
        return w

    overall = run(cells)
    return np.stack([run(own) if len(own := cells[cells[:, 0] == b]) else overall for b in range(BUCKETS)])


def score_blocks(blocks: DataFrame, answer: DataFrame, id_type: str, n: int, n_docs: int, types: int,
                 weights: np.ndarray) -> DataFrame:
    """One row per document of every block."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        block, (words, pairs) = Block(row), _answered(right)
        context = np.where(block.opens, float(n_docs), words[block.before])
        w = weights[_bucket(context)]
        own = words[block.tokens]
        p = w[:, 0] * _divided(pairs[block.pair_of], context) + w[:, 1] * _divided(own, float(n)) + w[:, 2] / (types + 1)
        base = np.log10((own + 0.1) / (n + 0.1 * (types + 1)))
        first = block.bounds[:-1]
        size = len(block.parts)
        return pa.table({
            "doc_id": left.column("ids").combine_chunks().flatten(), "held_out": pa.array(block.parts == 0),
            "n_tokens": pa.array(np.diff(block.bounds)), "n_known": pa.array(np.add.reduceat((own > 0).astype(np.int64), first)),
            "train_tokens": pa.array(np.full(size, n, np.int64)), "base_score": pa.array(np.add.reduceat(base, first)),
            "score": pa.array(np.add.reduceat(np.log10(p), first))})

    mine = answer.select("block", "kind", "range", F.col("whole").alias("n"))
    return blocks.groupBy("block").cogroup(mine.groupBy("block")).applyInArrow(
        run, f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score``, ``score`` (log10 probability under the model)."""
    blocks = written(make_blocks(docs, id_col, text_col), "lm-blocks")
    t = blocks.agg(F.sum("train_tokens"), F.sum("train_docs"),
                   F.sum(F.when(F.col("dev"), F.col("train_tokens"))), F.sum(F.when(F.col("dev"), F.col("train_docs")))).first()
    n, n_docs, dev_tokens, dev_docs = (x or 0 for x in t)
    ranges = 1 << max(3, (n * 16 // RANGE_BYTES).bit_length())
    answer = written(answers(questions(blocks, ranges)), "lm-answers")
    types = answer.filter("kind = 0").agg(F.sum("types")).first()[0] or 0
    cells = held_out_histogram(blocks, answer, n - dev_tokens, n_docs - dev_docs).collect()  # bounded histogram
    weights = learn_weights(np.array([tuple(r) for r in cells], np.int64).reshape(-1, 4), types + 1.0)
    return score_blocks(blocks, answer, docs.schema[id_col].dataType.simpleString(), n, n_docs, types, weights)
