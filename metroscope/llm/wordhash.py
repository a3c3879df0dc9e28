"""Words of many texts and their 64-bit hashes, in numpy over one byte buffer.

Hash equality is only ever used to find candidates or to group counts; operators that
promise exact matches compare the words themselves afterwards."""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_ROOT = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


def byte_table(pattern: str) -> np.ndarray:
    """True for bytes that belong to a word: ``alnum`` is 0-9, a-z and all of a non-ASCII
    character's bytes (after A-Z are lower-cased), ``space`` is all but x20 and x09-x0D."""
    table = np.zeros(256, bool)
    if pattern == "alnum":
        table[0x30:0x3A] = table[0x61:0x7B] = table[0x80:] = True
    else:
        table[:] = True
        table[[0x20, *range(0x09, 0x0E)]] = False
    return table


ALNUM, SPACE = byte_table("alnum"), byte_table("space")


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * _MIX[0]
    h = h ^ (h >> np.uint64(29))
    h = h * _MIX[1]
    return h ^ (h >> np.uint64(32))


def combine(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hash of an ordered pair."""
    return mix(first * _ROOT + (second ^ np.uint64(0x5851F42D4C957F2D)))


@dataclass
class Words:
    """Word hashes of a run of texts; text ``i`` owns ``hashes[bounds[i]:bounds[i + 1]]``."""

    hashes: np.ndarray
    bounds: np.ndarray


def hash_words(texts: list[str | None], table: np.ndarray) -> Words:
    """Hash all words of all texts (null: no words)."""
    parts = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    buf = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
    inside = table[buf]
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    text_ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    bounds = np.concatenate([[0], np.searchsorted(starts, text_ends)]).astype(np.int64)
    if not len(starts):
        return Words(np.zeros(0, np.uint64), bounds)
    lengths = ends - starts
    firsts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(int(lengths.sum()), dtype=np.int32) - np.repeat(firsts.astype(np.int32), lengths)
    powers = np.cumprod(np.full(int(lengths.max()), _ROOT | np.uint64(1), np.uint64))
    values = (buf[inside].astype(np.uint64) + np.uint64(1)) * powers[place]
    return Words(mix(np.add.reduceat(values, firsts) + lengths.astype(np.uint64)), bounds)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words (the caller leaves out runs that cross texts)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, np.uint64(k), np.uint64)
    for i in range(k):
        h = (h * _ROOT) ^ hashes[i:i + n]
        h = h * _MIX[0] + (h >> np.uint64(31))
    return mix(h)
