"""Importance resampling against plain Python over all features."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter

from metroscope.llm import resampling as S
from metroscope.llm.queries import op11_resampling


def plain(docs, bench, percent=10, min_words=20, max_n=1, buckets=10_000):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    feats = lambda w: [zlib.crc32(" ".join(w[i:i + n]).encode("utf-8", "surrogatepass")) % buckets
                       for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(feats(words(x)))
    for x in bench:
        t.update(feats(words(x)))
    gain = lambda k: math.floor(1000 * math.log((t[k] + 1) * (s.total() + buckets) / ((s[k] + 1) * (t.total() + buckets))))
    rows = []
    for i, x in docs:
        w = words(x)
        weight = sum(map(gain, feats(w)))
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(feats(w)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(w)])
    able = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[2], r[1]))
    for place, r in enumerate(able[:percent * len(able) // 100], 1):
        r[4] = place
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def rows_of(df):
    return sorted(map(tuple, df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def test_whole_table(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    bench = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = rows_of(op11_resampling(spark, sf))
    assert got == plain(docs, bench)
    assert sum(r[4] is not None for r in got) > 10


def test_longer_runs_and_few_buckets(spark, docs_of):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choice("Ab,c ä日 7 x-Y z".split()) for _ in range(rng.randrange(60)))) for i in range(300)]
    bench = spark.createDataFrame([("Ab c 7 z z",), (None,), ("",)], "text string")
    got = S.resample(docs_of(docs), bench, max_n=3, buckets=50, percent=40, min_words=5)
    assert rows_of(got) == plain(docs, ["Ab c 7 z z"], 40, 5, 3, 50)


def test_chained_seeds_equal_the_joined_bytes():
    words = S.words_of("One two-THREE über 日本 five")
    want = Counter(zlib.crc32(b" ".join(words[i:i + n])) % 997 for n in (1, 2, 3) for i in range(len(words) - n + 1))
    assert S.bucket_counts(words, 3, 997) == want


def test_awkward_rows(spark, docs_of, awkward):
    bench = spark.createDataFrame([("alpha beta",)], "text string")
    for extra in (False, True):
        docs = docs_of(awkward + [(None, "w " * 30)] * 3, extra)
        got = S.resample(docs, bench, percent=100)
        assert rows_of(got) == plain(awkward + [(None, "w " * 30)] * 3, ["alpha beta"], 100)
        ranks = sorted(r.rank for r in got.collect() if r.rank)
        assert ranks == [1, 2, 3, 4]  # repeated rows each have a rank
        assert S.drawn_texts(docs, bench, percent=100).columns == docs.columns
    assert S.resample(docs_of([]), bench).count() == 0
    none = bench.limit(0)
    assert rows_of(S.resample(docs_of(awkward), none)) == plain(awkward, [])


def test_ties_go_to_the_smaller_id(spark, docs_of, monkeypatch):
    monkeypatch.setattr(S, "gumbel", lambda seed, doc_id: 0)
    got = S.resample(docs_of([(i, "same " * 25) for i in (9, 3, 5, 7)]), spark.createDataFrame([("same",)], "text string"), percent=50)
    assert sorted((r.rank, r.doc_id) for r in got.collect() if r.rank) == [(1, 3), (2, 5)]
