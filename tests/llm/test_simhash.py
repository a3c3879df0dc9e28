"""Op 7 against brute force over all pairs, the dense way, and awkward rows."""
import random

import numpy as np
import pytest
import xxhash

from metroscope.llm import simhash
from metroscope.llm.components import connected_components


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    k = min(4, len(words))
    hs = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def roots(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def near_pairs(fps, most=4):
    a = np.array(fps, np.int64).view(np.uint64)
    return [(fps[i], fps[j]) for i in range(len(a)) for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= most) if i != j]


@pytest.mark.parametrize("text", [None, "", "  ", "One", "a b c", "A b c D e", "é É à la carte  x\ny z", "q " * 300])
def test_fingerprint_matches_definition(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_query_matches_brute_force(spark, sf):
    from metroscope.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    fps = {r.doc_id: slow_fingerprint(r.text) for r in docs}
    ids = sorted(fps)
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if (fps[a] ^ fps[b]).bit_count() <= 4]
    want = roots(pairs, ids)
    got = QUERIES["op7_simhash_dedup"](spark, sf).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{fps[i]:016x}", want[i]) for i in ids}
    assert len(got) == len(docs)


def clustered(seed, centres, copies, flips):
    rng = random.Random(seed)
    out = set()
    for _ in range(centres):
        c = rng.getrandbits(64)
        for _ in range(copies):
            x = c
            for b in rng.sample(range(64), rng.randint(0, flips)):
                x ^= 1 << b
            out.add(x - (1 << 63))
    return sorted(out)


@pytest.mark.parametrize("dense_rows,total", [(64, None), (1, 0), (10, 0)])
def test_links_connect_what_all_pairs_connect(spark, dense_rows, total):
    """Also when (almost) every cell goes the dense way."""
    fps = clustered(5, 60, 12, 5)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    pairs = near_pairs(fps)
    found = [(r.a, r.b) for r in simhash.links(df, len(fps) if total is None else total, dense_rows).collect()]
    assert set(found) <= set(pairs)
    assert roots(found, fps) == roots(pairs, fps)


def test_every_link_at_four_bits_is_found(spark):
    rng = random.Random(9)
    fps = set()
    for bits in (1, 2, 3, 4):
        for _ in range(150):
            x = y = rng.getrandbits(64)
            for b in rng.sample(range(64), bits):
                y ^= 1 << b
            fps |= {x - (1 << 63), y - (1 << 63)}
    fps = sorted(fps)
    got = {frozenset((r.a, r.b)) for r in simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), len(fps)).collect()}
    assert got == {frozenset(p) for p in near_pairs(fps)}


def test_awkward_rows(docs_of, awkward):
    for extra in (False, True):
        docs = docs_of(awkward, extra)
        got = simhash.near_duplicates(docs).collect()
        assert len(got) == len(awkward)
        zero = {r.component_id for r in got if r.fingerprint == "0" * 16}
        assert zero == {2}  # null, empty and blank texts link, the null id takes their component
        kept = simhash.keep_one(docs)
        assert kept.columns == docs.columns
        rows = kept.collect()
        assert sorted(str(r.doc_id) for r in rows) == ["1", "1", "2", "5", "6", "7", "None"]
    assert simhash.near_duplicates(docs_of([])).count() == 0 and simhash.keep_one(docs_of([])).count() == 0


def test_keep_one_keeps_one_of_repeated_rows(docs_of):
    text = "the same long text of more than four words"
    rows = simhash.keep_one(docs_of([(9, text), (9, text), (4, text), (4, text)])).collect()
    assert [r.doc_id for r in rows] == [4]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(1, i) for i in range(2, 60)] + [(7, 7), (None, 3)]
    got = {(r.node, r.root) for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(i, 100) for i in range(100, 141)} | {(i, 1) for i in range(1, 60)}
    none = spark.createDataFrame([], "a long, b long")
    assert connected_components(none).count() == 0
    words = spark.createDataFrame([("b", "a"), ("c", "b")], "x string, y string")
    assert {tuple(r) for r in connected_components(words).collect()} == {("a", "a"), ("b", "a"), ("c", "a")}
