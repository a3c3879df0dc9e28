"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Per document: counts over its words and lines. Per language and source: a quantile sketch of
the repeat, symbol, duplicate-line and word-length rates - exact counts in fixed value bins (1/1024
wide below 1, one 64th of a natural logarithm above), so sketches merge by adding counts, in any
order and with the same result, whichever task is lost and repeated. Tasks pre-aggregate; one row
a group, rate and bin travels. A group with few documents takes its language's sketch, and a small
language the sketch of everything, by merging the same bins again.

A group's thresholds lie where its sketch ends: from the upper quartile upwards, the first gap
between occupied bins that is at least ``GAP`` times as wide as the distance from the median to the
gap's lower edge (plus one word per text, so that a group without any spread is not cut at every
crumb). Everything above the middle of that gap is detached from the group and fails; without
such a gap the rate has no threshold there. The word length has a lower threshold the same way.
No cutoff and no distance is fixed: all follow from the group's own quantiles and spread. Documents
are then joined with their group's thresholds (written once, one row a group) and filtered.

Defined results: null and empty texts have zero counts and fail the base rule; a null
language or source is a group of its own; repeated rows are judged alike and each counts
in the sketches; equal rates get equal verdicts within a group (a threshold lies between bins,
never on a value); the same table always gives the same verdicts; an empty table gives an empty
result.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metroscope.llm.common import bounded, map_batches, written

MIN_WORDS = 50
MIN_GROUP = 200           # documents from which a group's own sketch is used
GAP = 3.0                 # width of a detaching gap, in distances from the median
LINEAR = 1024             # bins below 1
LOG = 64                  # bins in a unit of the natural logarithm from 1 on
ABOVE = ("repeat_rate", "symbol_rate", "dup_line_rate", "mean_word")  # rates with an upper threshold
BELOW = ("mean_word",)                                                 # and with a lower one
_SYMBOLS = b"#*$%&|<>"
_NOT_CONTINUATION = bytes(b for b in range(256) if b & 0xC0 != 0x80)


def line_and_word_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of one text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return 0, 0, sum(data.count(c) for c in _SYMBOLS), 0, 0
    chars = sum(map(len, words)) - len(data.translate(None, _NOT_CONTINUATION))
    seen: set[bytes] = set()
    dup = 0
    for line in data.split(b"\n"):
        if line in seen:
            dup += 1
        elif line.strip():
            seen.add(line)
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    repeat = 0
    if len(words) >= 3:
        pairs = np.unique(codes[:-1] * len(ids) + codes[1:], return_inverse=True)[1]
        _, inverse, counts = np.unique(pairs[:-1] * len(ids) + codes[2:], return_inverse=True, return_counts=True)
        marks = np.zeros(len(words) + 1, np.int64)
        at = np.flatnonzero(counts[inverse] >= 2)
        np.add.at(marks, at, 1)
        np.add.at(marks, at + 3, -1)
        repeat = int((np.cumsum(marks) > 0).sum())
    return len(words), chars, sum(data.count(bytes([c])) for c in _SYMBOLS), dup, repeat


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: ids, the base counts and ``base_failed``."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"),
                      F.col(source_col).alias("source"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in bounded(batches, "text"):
            counts = np.array([line_and_word_counts(t.as_py()) for t in b.column("text")], np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("lang"), b.column("source"), *[pa.array(counts[:, i]) for i in range(5)]],
                ["doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"])

    kinds = ", ".join(f"{c} {src.schema[c].dataType.simpleString()}" for c in ("doc_id", "lang", "source"))
    out = map_batches(src, run, f"{kinds}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long")
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                          | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50))


def _rates() -> dict[str, Column]:
    n = F.col("n_words")
    per_word = lambda c: F.when(n > 0, F.col(c) / n).otherwise(0.0)
    return {"repeat_rate": per_word("n_repeat_words"), "symbol_rate": per_word("n_symbols"),
            "dup_line_rate": per_word("n_dup_lines"), "mean_word": per_word("word_chars")}


def bin_of(rate: Column) -> Column:
    """Number of a rate's bin: 0 for zero, then 1/1024 wide, from 1 on by logarithm."""
    return F.when(rate <= 0, F.lit(0)).when(rate < 1, F.floor(rate * LINEAR) + 1).otherwise(
        F.lit(LINEAR + 1) + F.floor(F.log(F.greatest(rate, F.lit(1.0))) * LOG)).cast("int")


def edges(b: Column) -> tuple[Column, Column]:
    """Lower and upper edge of a bin."""
    low = F.when(b <= 1, F.lit(0.0)).when(b <= LINEAR, (b - 1) / LINEAR).otherwise(F.exp((b - (LINEAR + 1)) / LOG))
    high = F.when(b <= 0, F.lit(0.0)).when(b <= LINEAR, b / LINEAR).otherwise(F.exp((b - LINEAR) / LOG))
    return low, high


def group_sketches(measured: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``rate``, ``bin``, ``n`` documents and their ``words``, over documents
    that pass the base rule. Adding ``n`` and ``words`` merges sketches."""
    binned = F.array(*[F.struct(F.lit(r).alias("rate"), bin_of(c).alias("bin")) for r, c in _rates().items()])
    ok = measured.filter(~F.col("base_failed")).select("lang", "source", "n_words", F.explode(binned).alias("b"))
    return ok.groupBy("lang", "source", "b.rate", "b.bin").agg(F.count(F.lit(1)).alias("n"), F.sum("n_words").alias("words"))


def quantile_bin(share: int) -> Column:
    """Within the windows of ``limits``: the first bin that holds ``share`` percent with those below."""
    return F.min(F.when(F.col("upto") * 100 >= F.col("total") * share, F.col("bin")))


def limits(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """One row per ``keys``: ``docs``, ``<rate>_max`` and ``<rate>_min`` (null: no threshold).

    The windows run over bins, of which a group has a few thousand at most."""
    merged = sketches.groupBy(*keys, "rate", "bin").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    group = Window.partitionBy(*keys, "rate")
    rising = group.orderBy("bin")
    rows = merged.select("*", F.sum("n").over(rising.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
                         F.sum("n").over(group).alias("total"), (F.sum("n").over(group) / F.sum("words").over(group)).alias("one_word"),
                         F.lead("bin").over(rising).alias("next"), F.lag("bin").over(rising).alias("before"))
    rows = rows.select("*", *[quantile_bin(p).over(group).alias(f"q{p}") for p in (25, 50, 75)])
    (low, high), (next_low, _), (_, before_high) = edges(F.col("bin")), edges(F.col("next")), edges(F.col("before"))
    middle = sum(edges(F.col("q50")), F.lit(0.0)) / 2
    room = lambda far: (far + F.col("one_word")) * GAP
    above = (F.col("bin") >= F.col("q75")) & (next_low - high >= room(F.greatest(high - middle, F.lit(0.0))))
    below = (F.col("bin") <= F.col("q25")) & (low - before_high >= room(F.greatest(middle - low, F.lit(0.0))))
    rows = rows.select(*keys, "rate", "total", F.when(above, (high + next_low) / 2).alias("top"), F.when(below, (low + before_high) / 2).alias("bottom"))
    of = lambda r, c: F.when(F.col("rate") == r, F.col(c))
    return rows.groupBy(*keys).agg(
        F.max("total").alias("docs"), *[F.min(of(r, "top")).alias(f"{r}_max") for r in ABOVE],
        *[F.max(of(r, "bottom")).alias(f"{r}_min") for r in BELOW])


def thresholds(sketches: DataFrame) -> DataFrame:
    """One row per (lang, source) with ``<rate>_max`` / ``<rate>_min``, from the group's own sketch,
    its language's or everything's."""
    names = [f"{r}_max" for r in ABOVE] + [f"{r}_min" for r in BELOW]
    packed = lambda df, name: df.select(*[c for c in df.columns if c not in (*names, "docs")], F.struct("docs", *names).alias(name))
    own = packed(limits(sketches, ["lang", "source"]), "g")
    by_lang = packed(limits(sketches, ["lang"]), "l").withColumnRenamed("lang", "l_lang")
    overall = packed(limits(sketches.withColumn("any", F.lit(1)), ["any"]), "o").drop("any")  # one row
    joined = own.join(by_lang, F.col("lang").eqNullSafe(F.col("l_lang")), "left").join(F.broadcast(overall))
    pick = F.when(F.col("g.docs") >= MIN_GROUP, F.col("g")).when(F.col("l.docs") >= MIN_GROUP, F.col("l")).otherwise(F.col("o"))
    return joined.select("lang", "source", pick.alias("t")).select("lang", "source", *[f"t.{n}" for n in names])


def judge(measured: DataFrame) -> DataFrame:
    """``measured`` plus the group's thresholds and ``kept``."""
    bounds = written(thresholds(written(group_sketches(measured), "quality-sketches")), "quality-thresholds")
    bounds = bounds.select(F.col("lang").alias("t_lang"), F.col("source").alias("t_source"),
                           *[f"{r}_max" for r in ABOVE], *[f"{r}_min" for r in BELOW])
    rates = _rates()
    inside = F.lit(True)
    for r in ABOVE:
        inside = inside & F.ifnull(rates[r] <= F.col(f"{r}_max"), F.lit(True))
    for r in BELOW:
        inside = inside & F.ifnull(rates[r] >= F.col(f"{r}_min"), F.lit(True))
    return measured.join(
        bounds, F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")), "left",
    ).withColumn("kept", ~F.col("base_failed") & inside).drop("t_lang", "t_source")


def adaptive_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                   source_col: str = "source") -> DataFrame:
    """One row per row of ``docs`` with counts, thresholds and the verdict. The counts are
    written once, so the text is read once."""
    return judge(written(measure(docs, id_col, text_col, lang_col, source_col), "quality-counts"))
