"""Periodic runs of words: a suffix automaton with link-cut access.

A run is a stretch of consecutive words with smallest period q, of length at least
max(``min_length``, 2q), that no neighbouring word extends keeping the period.

The suffix automaton of the words has a state for every class of strings that end at the
same places; its suffix links form a tree in which the strings ending at word i are the path
from the root to the state of prefix i. Words are appended in order, and an access (the
link-cut tree operation, on splay trees) paints that path with i, its last occurrence. The path
before was made of segments of one colour each; a segment of colour e whose deepest state has
length m says: the last m words up to e stand again, latest, at the end of word i. With
p = i - e <= m the words i - p - m + 1 .. i have smallest period p, and 2p of them form a square.
All accesses together visit O(n log n) segments. Within a run with period q every word from its
2q-th on shows a segment of colour i - q that starts at the run's own start, so the pairs (start,
period) are the runs and the last word that shows one is its end.

Words that cannot belong to a run are left out beforehand, exactly: a run repeats at least
``min_length`` // 2 consecutive words inside itself, so both of its halves are covered by
grams of that many words that occur twice in the same stretch of covered words. Stretches
are narrowed by this rule until nothing changes (equal grams have equal hashes, so nothing
is lost), and each goes through its own automaton.

Defined results: null, empty and word-free texts have no words and no runs; repeated rows are
judged alike; a null id is kept (and never planted, see ``planted``); a very long text takes
memory in proportion to its longest stretch that may hold a run. Other columns are not read.
"""
from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroscope.llm.common import bounded, map_batches, rows_to_batch
from metroscope.llm.wordhash import grams, mix

MIN_LENGTH = 12

Run = tuple[int, int, int]  # start, length, period


def words_of(text: str | None) -> list[bytes]:
    """Words between x20 and x09-x0D, as they are."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def planted(doc_id: object, words: list[bytes]) -> list[bytes]:
    """Every tenth id's words with a periodic tail, as the query's contract lays down."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


class SuffixAutomaton:
    """States of all substrings; ``link`` is the suffix-link tree, ``ends`` the prefixes' states."""

    def __init__(self, symbols: list[int]):
        self.length, self.link, self.ends = [0], [-1], []
        step: list[dict[int, int]] = [{}]
        length, link = self.length, self.link
        last = 0
        for c in symbols:
            cur = len(length)
            length.append(length[last] + 1)
            link.append(0)
            step.append({})
            p = last
            while p != -1 and c not in step[p]:
                step[p][c] = cur
                p = link[p]
            if p != -1:
                q = step[p][c]
                if length[q] == length[p] + 1:
                    link[cur] = q
                else:
                    copy = len(length)
                    length.append(length[p] + 1)
                    link.append(link[q])
                    step.append(step[q].copy())
                    while p != -1 and step[p].get(c) == q:
                        step[p][c] = copy
                        p = link[p]
                    link[q] = link[cur] = copy
            self.ends.append(cur)
            last = cur


class LinkCutPaths:
    """Preferred paths of a rooted tree as splay trees ordered by depth, one colour a path.

    ``access(v, colour)`` repaints the path from the root to v and yields, from the deepest
    upwards, (deepest node on the path, colour before) of each segment it replaces."""

    def __init__(self, parent: list[int]):
        n = len(parent)
        self.up = [p + 1 for p in parent]  # numbered from 1; 0 is no node
        self.up.insert(0, 0)
        self.left, self.right, self.colour = [0] * (n + 1), [0] * (n + 1), [-1] * (n + 1)

    def _splay(self, x: int) -> None:
        """Bring ``x`` to the root of its splay tree; the colour stands at the root."""
        up, left, right = self.up, self.left, self.right
        top = x
        p = up[top]
        while p and (left[p] == top or right[p] == top):
            top, p = p, up[p]
        if top == x:
            return
        self.colour[x] = self.colour[top]
        while True:
            p = up[x]
            if not p or (left[p] != x and right[p] != x):
                return
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                self._rotate(p if (left[g] == p) == (left[p] == x) else x)
            self._rotate(x)

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        p = up[x]
        g = up[p]
        if left[p] == x:
            b = left[p] = right[x]
            right[x] = p
        else:
            b = right[p] = left[x]
            left[x] = p
        if b:
            up[b] = p
        up[p], up[x] = x, g
        if g:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    def access(self, v: int, colour: int) -> list[tuple[int, int]]:
        seen = []
        below, x = 0, v + 1
        while x:
            self._splay(x)
            before = self.colour[x]
            seen.append((x - 1, before))
            deeper = self.right[x]
            if deeper:  # the part below x leaves the path and keeps its colour
                self.colour[deeper] = before
            self.right[x] = below
            below, x = x, self.up[x]
        self._splay(v + 1)
        self.colour[v + 1] = colour
        return seen


def runs_of(symbols: list[int], min_length: int = MIN_LENGTH) -> list[Run]:
    """All runs of a sequence, by start, then period."""
    automaton = SuffixAutomaton(symbols)
    paths, length = LinkCutPaths(automaton.link), automaton.length
    last: dict[tuple[int, int], int] = {}
    for i, state in enumerate(automaton.ends):
        for deepest, e in paths.access(state, i):
            if e >= 0 and i - e <= length[deepest]:
                last[i - (i - e) - length[deepest] + 1, i - e] = i
    found = [(start, end - start + 1, period) for (start, period), end in last.items()]
    return sorted(r for r in found if r[1] >= max(min_length, 2 * r[2]))


def _symbols(words: list[bytes]) -> np.ndarray:
    numbers: dict[bytes, int] = {}
    return np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))


def stretches(symbols: np.ndarray, min_length: int = MIN_LENGTH) -> list[tuple[int, int]]:
    """(start, end) of the stretches that hold all runs."""
    k = max(1, min_length // 2)
    out, todo = [], [(0, len(symbols))]
    hashes = mix(symbols.astype(np.uint64) + np.uint64(1))
    gram = grams(hashes, k)
    while todo:
        start, end = todo.pop()
        if end - start < min_length:
            continue
        g = gram[start:end - k + 1]
        _, which, n = np.unique(g, return_inverse=True, return_counts=True)
        again = n[which] > 1
        if again.all():
            out.append((start, end))
            continue
        edge = np.zeros(end - start + 1, np.int64)  # a gram from word i covers i .. i + k - 1
        at = np.flatnonzero(again)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + k, -1)
        covered = np.cumsum(edge[:-1]) > 0
        if covered.all():  # grams across a seam of two squares may occur once
            out.append((start, end))
            continue
        turns = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0))
        todo += [(start + int(a), start + int(b)) for a, b in zip(turns[::2], turns[1::2])]
    return sorted(out)


def word_runs(words: list[bytes], min_length: int = MIN_LENGTH) -> list[Run]:
    if len(words) < min_length:
        return []
    symbols = _symbols(words)
    found = []
    for start, end in stretches(symbols, min_length):
        found += [(start + s, n, p) for s, n, p in runs_of(symbols[start:end].tolist(), min_length)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that a run repeats: of each run the first period stays."""
    drop = np.zeros(len(words), bool)
    for start, n, period in runs:
        drop[start + period:start + n] = True
    return [w for w, d in zip(words, drop.tolist()) if not d] if runs else words


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                  prepare: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_runs``, ``start``, ``length``,
    ``period`` of the longest run (ties: smallest start, then period; null without runs),
    ``exponent_milli``, ``runs_sha256`` and ``collapsed_sha256``.

    ``prepare`` may change the words of a row before they are searched."""
    names = ["n_words", "n_runs", "start", "length", "period", "exponent_milli"]
    schema = pa.schema([(n, pa.int64()) for n in names] + [("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])

    def judged(doc_id: object, text: str | None) -> tuple:
        words = words_of(text)
        if prepare:
            words = prepare(doc_id, words)
        runs = word_runs(words, min_length)
        start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        return (len(words), len(runs), start, length, period, 1000 * length // period if runs else None,
                hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in bounded(batches, "text"):
            ids = b.column("doc_id")
            rest = rows_to_batch([judged(i.as_py(), t.as_py()) for i, t in zip(ids, b.column("text"))], schema)
            yield pa.RecordBatch.from_arrays([ids, *rest.columns], ["doc_id", *schema.names])

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = src.schema["doc_id"].dataType.simpleString()
    longs = ", ".join(f"{n} long" for n in names)
    return map_batches(src, run, f"doc_id {id_type}, {longs}, runs_sha256 string, collapsed_sha256 string")


def collapsed_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """All rows and columns of ``docs``; texts with runs lose the repeats (their kept words,
    joined by one space), other texts stay as they are."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in bounded(batches, text_col):
            texts = []
            for t in b.column(at).to_pylist():
                words = words_of(t)
                runs = word_runs(words, min_length)
                texts.append(b" ".join(collapsed(words, runs)).decode("utf-8", "surrogatepass") if runs else t)
            yield b.set_column(at, b.schema.field(at).name, pa.array(texts, b.schema.field(at).type))

    return map_batches(docs, run, docs.schema)
