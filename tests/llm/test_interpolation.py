"""Op 9: counts, EM and scores against a plain version; awkward rows."""
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from metroscope.llm import interpolation as I


def remainder(i):
    return 2 if i is None else zlib.crc32(str(i).encode()) % 10


def brute(rows):
    """Exact counts, the module's EM on plainly counted cells, plain scoring."""
    texts = [(i, [*(t or "").encode().lower().split(), None]) for i, t in rows]
    kept, kept2, full, full2 = Counter(), Counter(), Counter(), Counter()
    n_docs = n_kept = 0
    for i, w in texts:
        if remainder(i) == 0:
            continue
        n_docs += 1
        full.update(w)
        full2.update(zip(["<s>", *w], w))
        if remainder(i) != I.DEV_PART:
            n_kept += 1
            kept.update(w)
            kept2.update(zip(["<s>", *w], w))
    cells = Counter()
    bucket = lambda c: min(math.ceil(math.log2(c + 1)), I.BUCKETS - 1)
    step = lambda p: 0 if p <= 0 else 1 + int(np.round(-np.log2(p) * I.STEPS))
    total = sum(kept.values())
    for i, w in texts:
        if remainder(i) == I.DEV_PART:
            for v, x in zip(["<s>", *w], w):
                c = n_kept if v == "<s>" else kept[v]
                cells[bucket(c), step(kept2[v, x] / c if c else 0), step(kept[x] / total if total else 0)] += 1
    n, types = sum(full.values()), len(full)
    weights = I.learn_weights(np.array([(*k, c) for k, c in sorted(cells.items())], np.int64).reshape(-1, 4), types + 1.0)
    out = []
    for i, w in texts:
        base = sum(math.log10((full[x] + 0.1) / (n + 0.1 * (types + 1))) for x in w)
        score = 0.0
        for v, x in zip(["<s>", *w], w):
            c = n_docs if v == "<s>" else full[v]
            l2, l1, l0 = weights[bucket(c)]
            score += math.log10((l2 * full2[v, x] / c if c else 0) + (l1 * full[x] / n if n else 0) + l0 / (types + 1))
        out.append((i, i is not None and remainder(i) == 0, len(w), sum(full[x] > 0 for x in w), n, base, score))
    return out


def same(got, want):
    rows = sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got], key=str)
    want = sorted(want, key=str)
    assert [r[:5] for r in rows] == [w[:5] for w in want]
    for r, w in zip(rows, want):
        assert r[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)


def test_matches_brute_force(spark, docs_of, monkeypatch):
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(60)] + ["É", "日本"]
    rows = [(i, " ".join(rng.choice(vocab[: 1 + rng.randint(0, 61)]).upper() for _ in range(rng.randint(0, 40)))) for i in range(200)]
    want = brute(rows)
    same(I.score_documents(docs_of(rows)).collect(), want)
    # many small blocks and many hash ranges give the same
    monkeypatch.setattr(I, "BLOCK_BYTES", 300)
    monkeypatch.setattr(I, "HASH_BYTES", 50)
    monkeypatch.setattr(I, "RANGE_BYTES", 1000)
    same(I.score_documents(docs_of(rows)).collect(), want)


def test_weights_find_the_true_mixture():
    """Tokens drawn from a known mixture give its weights back."""
    rng = np.random.default_rng(1)
    truth = np.array([0.6, 0.3, 0.1])
    # three outcomes told apart by their estimates
    p = np.array([[0.5, 0.25, 0.01], [0.25, 0.5, 0.01], [0.0, 0.0, 0.01]])
    mass = p @ truth
    n = rng.multinomial(200_000, mass / mass.sum())
    rows = np.array([(3, I._step(np.array([a]))[0], I._step(np.array([b]))[0], c) for (a, b, _), c in zip(p, n)], np.int64)
    w = I.learn_weights(rows, 100.0, rounds=500)
    grid = [np.array([a, b, 1 - a - b]) for a in np.linspace(0, 1, 51) for b in np.linspace(0, 1 - a, 51)]
    like = lambda x: float((n * np.log(np.maximum(p @ x, 1e-300))).sum())
    assert like(w[3]) >= max(map(like, grid)) - 1.0
    assert np.allclose(w.sum(axis=1), 1) and (w > 0).all()


def test_probabilities_sum_to_one():
    """Over the known words and the one class of unknown words, in every bucket."""
    weights = I.learn_weights(np.array([(2, 9, 30, 50), (2, 0, 40, 5), (0, 0, 33, 7)], np.int64), 11.0)
    pair, word = np.array([0.5, 0.5, 0, 0]), np.array([0.4, 0.3, 0.2, 0.1])
    for w in weights:
        known = w[0] * pair + w[1] * word + w[2] / 5
        assert known.sum() + w[2] / 5 == pytest.approx(1)


def test_held_out_texts_are_likelier_than_under_the_base(spark):
    from metroscope.llm.queries import QUERIES

    got = QUERIES["op9_interpolation"](spark, "/root/testdata/sf0.01").filter("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert got.s > got.b


def test_compact_arrays():
    a = np.sort(np.random.default_rng(0).integers(0, 2**63, 1000).astype(np.uint64))
    assert (I.unpack_sorted(I.pack_sorted(a)) == a).all() and len(I.unpack_sorted(I.pack_sorted(a[:0]))) == 0
    b = np.arange(70_000, dtype=np.uint32)
    assert (I.unpack(I.pack(b), np.uint32) == b).all()


def test_awkward_rows(docs_of, awkward):
    for extra in (False, True):
        same(I.score_documents(docs_of(awkward, extra)).collect(), brute(awkward))
    assert I.score_documents(docs_of([])).count() == 0
    only_held_out = [(i, "a b") for i in range(60) if remainder(i) == 0]
    same(I.score_documents(docs_of(only_held_out)).collect(), brute(only_held_out))
