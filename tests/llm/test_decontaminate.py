"""Op 5: the winnowing guarantee, brute force over all windows, awkward rows."""
import hashlib
import random

import numpy as np
import pytest

from metroscope.llm import decontaminate as D
from metroscope.llm.wordhash import ALNUM, SPACE, hash_words


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = D.words_of(t)
        n = min(13, len(w))
        for at in range(len(w) - n + 1 if w else 0):
            windows.setdefault((n, tuple(w[at:at + n])), set()).add(i)
    sizes = {n for n, _ in windows}
    out = []
    for i, t in docs:
        w, hit, found = D.words_of(t), set(), set()
        for n in sizes:
            for at in range(len(w) - n + 1):
                if own := windows.get((n, tuple(w[at:at + n]))):
                    found |= own
                    hit |= set(range(at, at + n))
        ids = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return out


def judged(docs, items):
    return [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
            for r in D.contamination(docs, items).collect()]


def order(rows):
    return sorted(rows, key=str)


def test_matches_brute_force(spark, docs_of):
    """Small vocabulary, so that windows repeat, overlap and share words; short items too."""
    rng = random.Random(4)
    text = lambda n: " ".join(rng.choice("ab cd ef gh é1 z".split()) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 8, 12, 13, 14, 20, 40]))) for i in range(40)] + [(None, "qq rr ss"), (50, None), (51, "!!")]
    items += [(60, items[8][1]), (61, "tick " * 30)]
    docs = [(i, text(rng.randint(0, 60))) for i in range(30)]
    docs += [(100 + i, text(20) + " X, " + (items[i][1] or "").upper() + "! " + text(15)) for i in range(len(items))]
    docs += [(200, "tick " * 500), (201, "qq-rr/ss"), (None, items[8][1]), (101, docs[31][1]), (202, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert order(judged(docs_of(docs), bench)) == order(brute(docs, items))


@pytest.mark.parametrize("seed", range(5))
def test_guarantee(seed):
    """Every shared span of 13 words shares a kept fingerprint at the same place."""
    rng = random.Random(seed)
    word = lambda: rng.choice("a b c d e f g h".split())
    span = [word() for _ in range(13)]
    kept = []
    for _ in range(2):
        before, after = [word() for _ in range(rng.randint(0, 30))], [word() for _ in range(rng.randint(0, 30))]
        w = hash_words([" ".join(before + span + after)], ALNUM)
        at, h = D.winnow(w.hashes, w.bounds)
        inside = (at >= len(before)) & (at <= len(before) + 13 - D.GRAM)
        kept.append({(int(a) - len(before), int(x)) for a, x in zip(at[inside], h[inside])})
    assert kept[0] & kept[1]


def test_awkward_rows(spark, docs_of, awkward):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon"), (2, "日本語"), (3, None)], "item_id long, text string")
    for extra in (False, True):
        docs = docs_of(awkward, extra)
        assert order(judged(docs, bench)) == order(brute(awkward, [(1, "alpha beta gamma delta epsilon"), (2, "日本語")]))
        kept = D.drop_contaminated(docs, bench)
        assert kept.columns == docs.columns
        assert kept.count() == len(awkward) - 3
    empty = bench.limit(0)
    assert D.drop_contaminated(docs_of(awkward), empty).count() == len(awkward)
    assert D.contamination(docs_of([]), bench).count() == 0


def test_word_hashes_follow_the_word_rules():
    texts = ["Ab,cd  éÉ\x00x", None, "", "a b　c", "x" * 5000 + " y"]
    for table, words in ((ALNUM, D.words_of), (SPACE, lambda t: (t or "").encode().lower().split())):
        w = hash_words(texts, table)
        lists = [words(t) for t in texts]
        assert np.diff(w.bounds).tolist() == [len(x) for x in lists]
        flat = [x for own in lists for x in own]
        assert len(set(w.hashes.tolist())) == len(set(flat))
        assert [w.hashes[flat.index(x)] for x in flat] == w.hashes.tolist()
