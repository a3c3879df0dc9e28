import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 977}x{i}" for i in range(60_000))  # about 0.7 MB

# Columns whose names the operators also use inside or return.
CLASHING = {
    "k_id": 1, "k_hash": 2, "renames": "r", "row_hash": 3, "kept_id": 4, "kept_hash": 5, "bad_id": 6, "bad_hash": 7,
    "score": 0.5, "fp": 8, "text_hash": 9, "fingerprint": "f", "component_id": 10, "hash": 11, "mention": "m", "n_words": 12,
    "labels": "l", "words": "w", "kept": True, "block": 13, "_id": 14,
}


@pytest.fixture(scope="session")
def sf() -> str:
    return SF


@pytest.fixture()
def docs_of(spark):
    """Documents table from (doc_id, text) pairs; ``extra`` adds clashing columns."""
    from pyspark.sql import functions as F

    def make(rows, extra=False):
        data = [(i, t, "en" if i is None or i % 2 else None, None if i == 3 else "src0", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
        return df.withColumns({k: F.lit(v) for k, v in CLASHING.items()}) if extra else df

    return make


@pytest.fixture()
def awkward():
    """Rows every operator has to bear."""
    return [(1, "alpha beta gamma delta epsilon"), (1, "alpha beta gamma delta epsilon"), (1, "other text of the same id"),
            (2, None), (3, ""), (4, " \t\n\r\x0b\x0c "), (5, LONG), (None, "no id here at all"), (None, None), (6, "é ß ñ 日本語 🎉"), (7, "x")]
