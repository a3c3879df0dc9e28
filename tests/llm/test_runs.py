"""Periodic runs against all periods tried one by one."""
import hashlib
import random
import re
import zlib

import pytest

from metroscope.llm import runs as R
from metroscope.llm.queries import op13_runs


def plain_runs(w, min_length=12):
    n, out = len(w), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            s = w[i:j + q]
            if len(s) >= max(min_length, 2 * q) and not any(s[p:] == s[:-p] for p in range(1, q)):
                out.append((i, len(s), q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(i, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = (zlib.crc32(str(i).encode()), len(w))
    if i is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    runs = plain_runs(w)
    drop = {k for s, m, q in runs for k in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    sha = lambda t: hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest()
    return (i, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(x for k, x in enumerate(w) if k not in drop)))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_all_periods(seed):
    rng = random.Random(seed)
    for _ in range(400):
        n, k = rng.randrange(70), rng.choice([1, 2, 3, 5, 30])
        w = [b"%d" % rng.randrange(k) for _ in range(n)]
        if n and rng.random() < 0.6:
            a = rng.randrange(n)
            p = 1 + rng.randrange((n - a) // 2 + 1)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
        least = rng.choice([2, 3, 4, 12, 13])
        assert R.word_runs(w, least) == plain_runs(w, least)


def test_highly_periodic_words():
    fib = ["a", "ab"]
    while len(fib[-1]) < 600:
        fib.append(fib[-1] + fib[-2])
    for s in (fib[-1], "ab" * 300 + "a", "a" * 500, ("abc" * 20 + "abd" * 20) * 4):
        w = [c.encode() for c in s]
        assert R.word_runs(w) == plain_runs(w)


def test_stretches_hold_all_runs():
    rng = random.Random(3)
    line = [b"l%d" % i for i in range(9)]
    w = [b"u%d" % i for i in range(500)] + line * 3 + [b"v%d" % i for i in range(500)] + line + [b"x%d" % rng.randrange(4) for _ in range(90)]
    assert R.word_runs(w) == plain_runs(w)
    assert sum(b - a for a, b in R.stretches(R._symbols(w))) < 200


def test_whole_table(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if len(r.text or "") < 30_000]
    got = {r.doc_id: tuple(r) for r in op13_runs(spark, sf).select(*COLUMNS).collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(got[i] == plain_row(i, t) for i, t in docs)
    assert sum(r[1] > 0 for r in got.values()) > 10


def test_awkward_rows(spark, docs_of, awkward):
    rows = awkward + [(10, "ab ab " * 8), (10, "ab ab " * 8), (None, "q\x0br " * 9), (8, "Aa aA " * 7)]
    small = [r for r in rows if r[0] != 5]
    for extra in (False, True):
        docs = docs_of(rows, extra)
        got = R.periodic_runs(docs, prepare=R.planted).select(*COLUMNS).collect()
        assert len(got) == len(rows)
        assert sorted(map(tuple, (r for r in got if r.doc_id != 5)), key=repr) == sorted((plain_row(*r) for r in small), key=repr)
        out = R.collapsed_text(docs)
        assert out.columns == docs.columns
        texts = [(r.doc_id, r.text) for r in out.collect()]
        assert (10, "ab") in texts and (None, "q r") in texts and (4, " \t\n\r\x0b\x0c ") in texts and (2, None) in texts
    assert R.periodic_runs(docs_of([])).count() == 0 and R.collapsed_text(docs_of([])).count() == 0


def test_very_long_periodic_text():
    w = [b"%d" % (i % 40_000) for i in range(120_000)]
    assert R.word_runs(w) == [(0, 120_000, 40_000)]
