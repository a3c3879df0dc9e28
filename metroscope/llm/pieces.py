"""SentencePiece encoding and decoding on the tokenizers library.

The model protobuf is parsed here (wire format, no generated classes): pieces with scores
and types, the trainer's model type and byte fallback, and the normaliser's character map
and whitespace flags. From it an equal ``tokenizers.Tokenizer`` is built: normaliser,
metaspace marker, unigram scores or the merge order that the BPE scores imply, byte
fallback, and the matching decoder. Batches are encoded with the library's threads.

Parity: every text is also encoded by the sentencepiece library, which defines the right
ids, and ``parity`` says whether the two agree. The ids returned are always those of the
tokenizer built here. They can differ only where one piece can be merged from overlapping
neighbours in two ways (equal scores: sentencepiece takes the left one), or where a text spells
out a byte piece of a unigram model.

Defined results: a null text has null ids and no tokens; an empty text has an empty list;
repeated rows are encoded alike; the texts of control pieces (``<s>``) in a document are
ordinary text.
"""
from __future__ import annotations

import os
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroscope.llm.common import bounded, map_batches

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
THREADS = 2
KNOWN_WORDS = 600_000     # words that a task remembers
BATCH_TEXTS = 10_000      # texts or words given to the library at once
# Piece types and model types of the model format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


@dataclass
class PieceModel:
    """What the protobuf says. Defaults are those of the format."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    suffix_marker: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze_spaces: bool = True
    escape_spaces: bool = True


def _fields(data: bytes) -> Iterator[tuple[int, Any]]:
    """(field number, value) of one message: int, bytes, or 4 / 8 raw bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        number, wire = tag >> 3, tag & 7
        if wire == 0:
            yield number, varint()
            continue
        if wire not in (1, 2, 5):
            raise ValueError(f"unsupported wire type {wire}")
        size = {1: 8, 5: 4}.get(wire) or varint() if wire != 2 else varint()
        if at + size > len(data):
            raise ValueError("truncated model")
        yield number, data[at:at + size]
        at += size


def parse_model(data: bytes) -> PieceModel:
    """Parse a serialised model."""
    m = PieceModel()
    for number, value in _fields(data):
        if number == 1:
            text, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    text = v.decode("utf-8")
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            m.pieces.append((text, score, kind))
        elif number == 2:
            for n, v in _fields(value):
                if n == 3:
                    m.model_type = v
                elif n == 24:
                    m.suffix_marker = bool(v)
                elif n == 35:
                    m.byte_fallback = bool(v)
        elif number == 3:
            for n, v in _fields(value):
                if n == 2:
                    m.charsmap = v
                elif n == 3:
                    m.dummy_prefix = bool(v)
                elif n == 4:
                    m.squeeze_spaces = bool(v)
                elif n == 5:
                    m.escape_spaces = bool(v)
    return m


def merges_of(m: PieceModel) -> list[tuple[str, str]]:
    """All pairs of pieces that join to a piece, best-scored result first."""
    usable = {p: i for i, (p, _, kind) in enumerate(m.pieces) if kind in (NORMAL, USER_DEFINED)}
    found = []
    for p, i in usable.items():
        for cut in range(1, len(p)):
            left, right = p[:cut], p[cut:]
            if left in usable and right in usable:
                found.append((-m.pieces[i][1], i, usable[left], usable[right], left, right))
    return [(x[4], x[5]) for x in sorted(found)]


def words_stand_alone(m: PieceModel) -> bool:
    """No piece reaches over the start of a word."""
    return not any(MARK in p.lstrip(MARK) for p, _, kind in m.pieces if kind in (NORMAL, USER_DEFINED))


def build_tokenizer(m: PieceModel):
    """The equal ``tokenizers.Tokenizer``."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    if m.model_type not in (UNIGRAM, BPE) or m.suffix_marker or not m.escape_spaces:
        raise ValueError("only unigram and BPE models with a metaspace prefix marker are supported")
    unk = next((i for i, p in enumerate(m.pieces) if p[2] == UNKNOWN), None)
    if m.model_type == UNIGRAM:
        # pieces that a text can never match get a name that texts do not hold; byte pieces
        # must keep theirs, so a text that spells one out can differ (``parity`` is then false)
        lowest = min((s for _, s, kind in m.pieces if kind in (NORMAL, USER_DEFINED)), default=0.0)
        vocab = [(p, s) if kind in (NORMAL, USER_DEFINED) else (p, lowest) if kind == BYTE
                 else (f"\U0010FFFE{i}\U0010FFFE", lowest) for i, (p, s, kind) in enumerate(m.pieces)]
        model = models.Unigram(vocab, unk, byte_fallback=m.byte_fallback)
    else:
        model = models.BPE({p: i for i, (p, _, _) in enumerate(m.pieces)}, merges_of(m),
                           unk_token=m.pieces[unk][0] if unk is not None else None, fuse_unk=True,
                           byte_fallback=m.byte_fallback)
    t = Tokenizer(model)
    steps = [normalizers.Precompiled(m.charsmap)] if m.charsmap else []
    if m.squeeze_spaces:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ | $"), "")]
    if m.dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    t.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
    if words_stand_alone(m):
        t.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*|[^{MARK}]+"), "isolated")
    if own := [p for p, _, kind in m.pieces if kind == USER_DEFINED]:
        t.add_tokens([AddedToken(p, normalized=True) for p in own])
    strip = [decoders.Strip(" ", 1, 0)] if m.dummy_prefix else []
    t.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *strip])
    return t


class Coder:
    """Encoder and decoder of one task (building it takes a fraction of a second).

    Where no piece can reach over the start of a word and the normaliser leaves characters
    alone, the ids of a text are those of its words one after another. Then only words not
    met before are encoded (in batches, on the library's threads) and checked against
    sentencepiece and decoded again; a bounded table remembers them. Other texts - with runs of spaces or the
    marker itself - and other models are encoded whole."""

    def __init__(self, model: bytes, threads: int = THREADS) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        self.threads = threads
        parsed = parse_model(model)
        self.tokenizer = build_tokenizer(parsed)
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.by_word = (words_stand_alone(parsed) and parsed.dummy_prefix and not parsed.squeeze_spaces
                        and not parsed.charsmap and parsed.byte_fallback)
        self.bare = Tokenizer(self.tokenizer.model)  # for single words, marker put on by hand
        self.known: dict[str, bytes] = {}            # ids as little-endian 32-bit numbers
        self.odd: set[str] = set()                   # known words without parity
        self.lossy: set[str] = set()                 # known words that do not read back

    def _run(self, texts: list[str], words: bool) -> Iterator[tuple[bytes, bool, bool]]:
        """(ids, parity, round trip) of each text or word."""
        for at in range(0, len(texts), BATCH_TEXTS):
            part = texts[at:at + BATCH_TEXTS]
            coder, given = (self.bare, [MARK + w for w in part]) if words else (self.tokenizer, part)
            ours = coder.encode_batch_fast(given, add_special_tokens=False)
            truth = self.reference.encode(part, num_threads=self.threads)
            ids = [e.ids for e in ours]
            for text, own, right, again in zip(part, ids, truth, self.decode(ids)):
                yield array("i", own).tobytes(), own == right, again == text

    def encode(self, texts: list[str]) -> list[tuple[bytes, bool, bool]]:
        """(ids as little-endian 32-bit numbers, parity, round trip) of each text."""
        plain = [self.by_word and bool(t) and t[0] != " " and t[-1] != " " and "  " not in t and MARK not in t for t in texts]
        split = [t.split(" ") if p else None for t, p in zip(texts, plain)]
        if len(self.known) > KNOWN_WORDS:
            for table in (self.known, self.odd, self.lossy):
                table.clear()
        new = list({w for words in split if words for w in words} - self.known.keys())
        for word, (ids, same, back) in zip(new, self._run(new, True)):
            self.known[word] = ids
            if not same:
                self.odd.add(word)
            if not back:
                self.lossy.add(word)
        rest = self._run([t for t, p in zip(texts, plain) if not p], False)
        get, odd, lossy = self.known.__getitem__, self.odd, self.lossy
        return [next(rest) if words is None else
                (b"".join(map(get, words)), not odd or odd.isdisjoint(words), not lossy or lossy.isdisjoint(words))
                for words in split]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)


def read_model(path: str = MODEL_PATH) -> bytes:
    """The model file (a driver-side parameter file of under a megabyte; it travels with
    the tasks, so executors need no copy)."""
    with open(path, "rb") as f:
        return f.read()


def encode_documents(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = True) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_tokens``, ``parity`` with sentencepiece,
    ``round_trip`` (decoding gives the text back), ``ids_xxh64`` (of the ids as
    little-endian 32-bit numbers) and, if asked, ``token_ids``. No shuffle."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one file of bounded size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        for b in bounded(batches, "text", 1 << 20):
            texts = b.column("text").to_pylist()
            some = [t for t in texts if t is not None]
            coded = coder.encode(some)
            done = iter(coded)
            rows = [(None, None, None, None) if t is None else
                    (np.frombuffer((c := next(done))[0], "<i4"), c[1], c[2], xxhash.xxh64_hexdigest(c[0])) for t in texts]
            cols = [b.column("doc_id"), pa.array([0 if r[0] is None else len(r[0]) for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.bool_()), pa.array([r[2] for r in rows], pa.bool_()),
                    pa.array([r[3] for r in rows], pa.string())]
            names = ["doc_id", "n_tokens", "parity", "round_trip", "ids_xxh64"]
            if with_ids:
                cols.append(pa.array([r[0] for r in rows], pa.list_(pa.int32())))
                names.append("token_ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    kind = src.schema["doc_id"].dataType.simpleString()
    return map_batches(src, run, f"doc_id {kind}, n_tokens long, parity boolean, round_trip boolean, ids_xxh64 string"
                          + (", token_ids array<int>" if with_ids else ""))


def decode_documents(encoded: DataFrame, model: bytes, ids_col: str = "token_ids") -> DataFrame:
    """``doc_id``, ``text`` from the ids (null ids: null text)."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        for b in batches:
            ids = b.column("ids").to_pylist()
            back = iter(coder.decode([x for x in ids if x is not None]))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([None if x is None else next(back) for x in ids], pa.string())],
                ["doc_id", "text"])

    src = encoded.select("doc_id", F.col(ids_col).alias("ids"))
    return map_batches(src, run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, text string")
