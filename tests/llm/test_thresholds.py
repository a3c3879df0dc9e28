"""Op 3: counts against a plain version, sketches that merge, thresholds that adapt."""
import random

import pytest
from pyspark.sql import functions as F

from metroscope.llm import thresholds as T


def slow_counts(text):
    text = text or ""
    words = text.encode().split()
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    repeat = set()
    for i, g in enumerate(grams):
        if grams.count(g) >= 2:
            repeat |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (len(words), sum(len(w.decode()) for w in words), sum(text.count(c) for c in "#*$%&|<>"),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(repeat))


@pytest.mark.parametrize("text", [None, "", " \n ", "a", "a b c a b c", "é ß\né ß\n\n \n#|\n#|", "x x x x", "a b a b a b", "日本 語#\x0b日本 語"])
def test_counts(text):
    assert T.line_and_word_counts(text) == slow_counts(text)


def test_counts_at_random():
    rng = random.Random(3)
    for _ in range(200):
        t = "".join(rng.choice(["a ", "b ", "é ", "\n", "# ", "  "]) for _ in range(rng.randint(0, 60)))
        assert T.line_and_word_counts(t) == slow_counts(t)


def measured(spark, rows):
    """(lang, source, symbols in 100 words) -> a measured table."""
    data = [(i, lang, src, 100, 500, s, 0, 0, False) for i, (lang, src, s) in enumerate(rows)]
    return spark.createDataFrame(data, "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, "
                                       "n_dup_lines long, n_repeat_words long, base_failed boolean")


def test_thresholds_adapt_to_the_group(spark):
    """A source of code keeps its symbols, a source of prose does not."""
    rows = [("en", "code", 40 + i % 9) for i in range(400)] + [("en", "prose", 0) for _ in range(400)] + [("en", "prose", 45)] * 40
    rows += [("en", "tiny", 45), ("en", "tiny", 0), ("xx", None, 0), (None, None, 300)]
    got = {(r.doc_id, r.lang, r.source): r for r in T.judge(measured(spark, rows)).collect()}
    assert len(got) == len(rows)
    kept = lambda src, n: {r.kept for r in got.values() if r.source == src and r.n_symbols == n}
    assert kept("code", 45) == {True} and kept("prose", 45) == {False} and kept("prose", 0) == {True}
    tiny = [r for r in got.values() if r.source == "tiny"]
    everything = [r for r in got.values() if r.lang in (None, "xx")]
    assert len({r.symbol_rate_max for r in tiny}) == 1 and len({r.symbol_rate_max for r in everything}) == 1
    assert all(r.kept is not None for r in got.values())


def test_sketches_merge(spark):
    """Merged per-source sketches are the sketch of all rows, and hold its quantiles to a bin."""
    rows = [("en", f"s{i % 7}", i * i % 311) for i in range(7000)]
    parts = T.group_sketches(measured(spark, rows))
    whole = T.group_sketches(measured(spark, [(lang, "one", s) for lang, _, s in rows]))
    add = lambda df: sorted(map(tuple, df.groupBy("rate", "bin").agg(F.sum("n"), F.sum("words")).collect()))
    assert add(parts) == add(whole)
    bins = sorted((b, n) for r, b, n, _ in add(whole) if r == "symbol_rate")
    rates = sorted(s / 100 for _, _, s in rows)
    low, high = T.edges(F.col("b"))
    for share in (25, 50, 75, 95):
        seen, at = 0, None
        for at, n in bins:
            seen += n
            if seen * 100 >= len(rows) * share:
                break
        lo, hi = spark.createDataFrame([(at,)], "b int").select(low, high).first()
        assert lo <= rates[-(-len(rows) * share // 100) - 1] <= hi + 1e-12


def test_bins_hold_their_values(spark):
    values = [0.0, 1e-9, 0.5, 0.4999999, 0.999999, 1.0, 1.5, 7.25, 2000.0, 3e7]
    low, high = T.edges(T.bin_of(F.col("v")))
    for r in spark.createDataFrame([(v,) for v in values], "v double").select("v", low.alias("lo"), high.alias("hi")).collect():
        assert r.lo - 1e-12 <= r.v <= r.hi * (1 + 1e-12) and r.hi - r.lo <= max(1 / 1024, r.v / 60)


def test_verdicts_are_repeatable(spark):
    rng = random.Random(8)
    rows = [(rng.choice(["en", "de", None]), rng.choice(["a", "b"]), rng.choice([0, 0, 0, 1, 2, rng.randint(50, 90)])) for _ in range(3000)]
    verdicts = lambda df: sorted((r.doc_id, r.kept) for r in T.judge(df).collect())
    first = verdicts(measured(spark, rows))
    assert first == verdicts(measured(spark, rows).repartition(7)) and {k for _, k in first} == {True, False}


def test_a_group_without_gaps_has_no_threshold(spark):
    rows = [("en", "smooth", i % 100) for i in range(1000)] + [("en", "split", i % 10) for i in range(900)] + [("en", "split", 200)] * 30
    got = T.judge(measured(spark, rows)).collect()
    assert all(r.kept and r.symbol_rate_max is None for r in got if r.source == "smooth")
    assert {r.kept for r in got if r.source == "split" and r.n_symbols < 10} == {True}
    assert {r.kept for r in got if r.source == "split" and r.n_symbols == 200} == {False}
    assert all(0.1 < r.symbol_rate_max < 2 for r in got if r.source == "split")


def test_awkward_rows(docs_of, awkward):
    for extra in (False, True):
        got = T.adaptive_rules(docs_of(awkward, extra)).collect()
        want = sorted((str(i), *slow_counts(t)) for i, t in awkward if t is None or len(t) < 1000)
        assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
                      for r in got if r.n_words < 1000) == want
        assert len(got) == len(awkward) and all(r.base_failed and not r.kept for r in got if r.n_words < 50)
    assert T.adaptive_rules(docs_of([])).count() == 0


def test_clean_documents_are_kept(spark, sf):
    from metroscope.llm.queries import QUERIES

    got = QUERIES["op3_adaptive_rules"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    assert got.filter("quality = 1 and not base_failed and not kept").count() == 0
