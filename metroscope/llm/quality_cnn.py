"""Quality classifier: a byte-level convolutional network in numpy.

Every byte of the document becomes a small learned vector; learned filters slide over
all byte positions; each overlapping chunk keeps the maximum of every filter
(max-pooling); the chunk vectors are combined by their mean and maximum over the whole
document into one logit. Scores use nothing but the text.

Fitting runs on the driver over a bounded sample (``MAX_TRAIN_DOCS`` labelled documents of the
table, all chunks of their whole texts), ``EPOCHS`` times, whatever the table's size. Its memory is
that of the sampled texts; passes go in segments of ``SEGMENT_CHUNKS`` chunks. Scoring runs in
Spark tasks over every byte of every document, in the same segments, so a very long text needs
no more memory than a short one.

Defined results: a null or empty text is scored as a document of one padding chunk; a null
id is not held out and never used for fitting; repeated rows are scored one by one; labels of
ids that the table does not hold are not counted; with no labelled rows (or one class only)
nothing can be told apart: the model is the smoothed label mean for every text, and ``keep_good``
keeps every row.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroscope.llm.common import bounded, crc_mod, map_batches

MAX_TRAIN_DOCS = 3000      # documented bound of the labelled sample
EPOCHS = 20                # passes over the sample
THRESHOLD = 0.7

PAD = 256                  # the symbol after the end of a text
BLOCK = 64                 # pooling block
CHUNK_BLOCKS = 8           # a chunk is 8 blocks (512 bytes) ...
STRIDE_BLOCKS = 7          # ... and starts every 7 blocks, so neighbours overlap by one block
CHUNK = BLOCK * CHUNK_BLOCKS
STRIDE = BLOCK * STRIDE_BLOCKS
SEGMENT_CHUNKS = 32        # chunks convolved at once


@dataclass
class ByteCnn:
    """Weights and numpy forward / backward passes."""

    dims: int = 8
    width: int = 5
    filters: int = 32
    seed: int = 7
    emb: np.ndarray = field(init=False)
    conv: np.ndarray = field(init=False)
    bias: np.ndarray = field(init=False)
    head: np.ndarray = field(init=False)
    head_bias: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        rng = np.random.default_rng(self.seed)
        f32 = np.float32
        self.emb = rng.normal(0, 0.5, (PAD + 1, self.dims)).astype(f32)
        self.conv = rng.normal(0, (2 / (self.width * self.dims)) ** 0.5, (self.width * self.dims, self.filters)).astype(f32)
        self.bias = np.zeros(self.filters, f32)
        self.head = rng.normal(0, 0.1, 2 * self.filters).astype(f32)
        self.head_bias = np.zeros(1, f32)

    def windows(self, symbols: np.ndarray) -> np.ndarray:
        """(positions, width * dims) windows of the embedded symbols; the last
        ``width - 1`` symbols are context only."""
        x = self.emb[symbols]
        view = np.lib.stride_tricks.sliding_window_view(x, self.width, axis=0)
        return view.transpose(0, 2, 1).reshape(len(symbols) - self.width + 1, self.width * self.dims)

    def block_max(self, symbols: np.ndarray) -> np.ndarray:
        """Filter maxima of each 64-position block (``symbols`` ends with the context)."""
        out = self.windows(symbols) @ self.conv
        return out.reshape(-1, BLOCK, self.filters).max(axis=1)

    def chunk_features(self, data: bytes) -> Iterator[np.ndarray]:
        """Rectified chunk vectors of the whole text, a bounded number of chunks at a time."""
        n = chunk_count(len(data))
        raw = np.frombuffer(data, np.uint8)
        for first in range(0, n, SEGMENT_CHUNKS):
            last = min(n, first + SEGMENT_CHUNKS)
            start, stop = first * STRIDE, (last - 1) * STRIDE + CHUNK + self.width - 1
            part = raw[start:stop]
            symbols = np.full(stop - start, PAD, np.int16)
            symbols[: len(part)] = part
            blocks = self.block_max(symbols)
            idx = np.arange(last - first)[:, None] * STRIDE_BLOCKS + np.arange(CHUNK_BLOCKS)
            yield np.maximum(blocks[idx].max(axis=1) + self.bias, 0)

    def score(self, text: str | None) -> float:
        data = (text or "").encode("utf-8", "surrogatepass")
        total, top, n = np.zeros(self.filters, np.float64), np.zeros(self.filters, np.float32), 0
        for h in self.chunk_features(data):
            total += h.sum(axis=0)
            top = np.maximum(top, h.max(axis=0))
            n += len(h)
        z = float(np.concatenate([total / n, top]) @ self.head.astype(np.float64) + self.head_bias[0])
        return 1 / (1 + np.exp(-min(max(z, -60.0), 60.0)))

    def fit(self, chunks: np.ndarray, doc_of: np.ndarray, labels: np.ndarray,
            epochs: int = EPOCHS, batch_docs: int = 32, rate: float = 0.004) -> None:
        """Adam on the log loss. ``chunks`` (n, CHUNK + width - 1) symbols sorted by
        ``doc_of``; gradients of a max go to the position that won it."""
        params = ["emb", "conv", "bias", "head", "head_bias"]
        m = {k: np.zeros_like(getattr(self, k)) for k in params}
        v = {k: np.zeros_like(getattr(self, k)) for k in params}
        rng, step = np.random.default_rng(self.seed), 0
        bounds = np.searchsorted(doc_of, np.arange(len(labels) + 1))
        for epoch in range(epochs):
            order = rng.permutation(len(labels))
            for at in range(0, len(order), batch_docs):
                docs = order[at:at + batch_docs]
                grads = self._gradients([chunks[bounds[d]:bounds[d + 1]] for d in docs], labels[docs])
                step += 1
                lr = rate * (0.2 if epoch >= epochs * 0.7 else 1.0)
                for k in params:
                    g = grads[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    mh, vh = m[k] / (1 - 0.9 ** step), v[k] / (1 - 0.99 ** step)
                    setattr(self, k, (getattr(self, k) - lr * mh / (np.sqrt(vh) + 1e-7)).astype(np.float32))

    def _gradients(self, docs: list[np.ndarray], labels: np.ndarray) -> dict[str, np.ndarray]:
        x = np.concatenate(docs)
        owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        n, nf, wd = len(x), self.filters, self.width * self.dims
        arg, pre = np.zeros((n, nf), np.int64), np.zeros((n, nf), self.conv.dtype)
        for s in range(0, n, SEGMENT_CHUNKS):
            part = x[s:s + SEGMENT_CHUNKS]
            view = np.lib.stride_tricks.sliding_window_view(self.emb[part], self.width, axis=1).transpose(0, 1, 3, 2)
            out = (view.reshape(len(part) * CHUNK, wd) @ self.conv).reshape(len(part), CHUNK, nf)
            arg[s:s + SEGMENT_CHUNKS] = out.argmax(axis=1)
            pre[s:s + SEGMENT_CHUNKS] = out.max(axis=1) + self.bias
        h = np.maximum(pre, 0)
        firsts = np.searchsorted(owner, np.arange(len(docs)))
        counts = np.bincount(owner, minlength=len(docs))[:, None]
        mean, top = np.add.reduceat(h, firsts) / counts, np.maximum.reduceat(h, firsts)
        z = np.concatenate([mean, top], axis=1) @ self.head + self.head_bias
        dz = ((1 / (1 + np.exp(-z)) - labels) / len(docs)).astype(np.float32)
        g_head = np.concatenate([mean, top], axis=1).T @ dz + 1e-4 * self.head
        is_top = (h == top[owner]).astype(np.float32)
        ties = np.maximum(np.add.reduceat(is_top, firsts)[owner], 1)
        dh = dz[owner][:, None] * (self.head[:nf] / counts[owner] + self.head[nf:] * is_top / ties)
        dh *= pre > 0
        g_conv, g_emb = np.zeros((wd, nf), self.conv.dtype), np.zeros_like(self.emb)
        for s in range(0, n, SEGMENT_CHUNKS):
            some = slice(s, s + SEGMENT_CHUNKS)
            rows, d = x[some], dh[some]
            at = arg[some][:, :, None] + np.arange(self.width)                  # the windows that won
            sym = rows[np.arange(len(rows))[:, None, None], at]
            won = self.emb[sym].reshape(len(rows), nf, wd)
            g_conv += np.einsum("nfk,nf->kf", won, d)
            flat = (d[:, :, None] * self.conv.T[None]).reshape(-1, self.dims)
            for k in range(self.dims):
                g_emb[:, k] += np.bincount(sym.ravel(), weights=flat[:, k], minlength=PAD + 1)
        return {"emb": g_emb, "conv": g_conv, "bias": dh.sum(axis=0), "head": g_head, "head_bias": dz.sum(keepdims=True)}


@dataclass
class ConstantModel:
    """What is fitted when the labelled sample has fewer than two classes."""

    value: float

    def score(self, text: str | None) -> float:
        return self.value


def chunk_count(n_bytes: int) -> int:
    """Chunks that cover a text of ``n_bytes`` bytes (one at least)."""
    return 1 if n_bytes <= CHUNK else 1 + -(-(n_bytes - CHUNK) // STRIDE)


def all_chunks(data: bytes, width: int) -> np.ndarray:
    """(chunks, CHUNK + width - 1) symbols that cover the whole text."""
    n = chunk_count(len(data))
    symbols = np.full((n - 1) * STRIDE + CHUNK + width - 1, PAD, np.int16)
    symbols[:len(data)] = np.frombuffer(data, np.uint8)[:len(symbols)]
    return np.lib.stride_tricks.sliding_window_view(symbols, CHUNK + width - 1)[::STRIDE]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", held_out_mod: int = 4, held_out_is: int = 2,
          max_docs: int = MAX_TRAIN_DOCS) -> ByteCnn | ConstantModel:
    """Fit on at most ``max_docs`` labelled documents outside the held-out remainder.

    The sample is the smallest keyed hashes of the labelled ids, so it does not depend on
    row order or partitioning. An id with several labels counts with its smallest one, an
    id with several texts with the one of the smallest hash."""
    key = F.col(id_col)
    here = docs.select(key.alias("_id")).distinct()
    picked = (
        labels.filter(key.isNotNull() & F.col(label_col).isNotNull() & (crc_mod(key, held_out_mod) != held_out_is))
        .groupBy(key.alias("_id")).agg(F.min(label_col).alias("_y")).join(here, "_id", "left_semi")
        .orderBy(F.xxhash64(F.lit("sample"), "_id"), "_id").limit(max_docs)
    )
    rows = docs.select(key.alias("_id"), F.ifnull(F.col(text_col), F.lit("")).alias("_t")).join(F.broadcast(picked), "_id")  # <= max_docs rows
    sample = rows.groupBy("_id").agg(F.min("_y").alias("_y"), F.min_by("_t", F.xxhash64("_t")).alias("_t")).toPandas()
    if sample["_y"].nunique() < 2:
        return ConstantModel(float((sample["_y"].sum() + 1) / (len(sample) + 1)) if len(sample) else 0.5)
    sample = sample.sort_values("_id")
    model = ByteCnn()
    texts = [all_chunks(t.encode("utf-8", "surrogatepass"), model.width) for t in sample["_t"]]
    model.fit(np.concatenate(texts), np.repeat(np.arange(len(texts)), [len(t) for t in texts]), sample["_y"].to_numpy(np.float32))
    return model


def score_documents(docs: DataFrame, model: ByteCnn | ConstantModel, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1), ``predicted`` for every row; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in bounded(batches, "text"):
            scores = [model.score(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(scores, pa.float64()),
                 pa.array([int(s >= threshold) for s in scores], pa.int32())], ["doc_id", "score", "predicted"])

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(src, run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, score double, predicted int")


def keep_good(docs: DataFrame, model: ByteCnn | ConstantModel, text_col: str = "text",
              threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all columns) whose text the model accepts (all, if it could learn nothing)."""
    if isinstance(model, ConstantModel):
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in bounded(batches, text_col):
            yield b.filter(pa.array([model.score(t.as_py()) >= threshold for t in b.column(text_col)], pa.bool_()))

    return map_batches(docs, run, docs.schema)
