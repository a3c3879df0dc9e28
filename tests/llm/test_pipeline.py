"""The pipeline against plain versions of its stages, stage by stage."""
import importlib.util

import sentencepiece
from llm.test_decontaminate import brute as slow_contamination
from llm.test_simhash import roots, slow_fingerprint

import corpus_pipeline as C
from metroscope.llm import pieces, quality_cnn
from metroscope.llm.surrogates import PATTERN


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    names = [n for n, _ in C.STAGES]
    assert names == ["quality", "near_dedup", "decontaminate", "surrogates", "encode"]
    columns = docs.columns

    model = quality_cnn.train(docs, labels)
    stage, before = {}, docs
    for name, f in C.STAGES:
        stage[name] = f(spark, before, sf).cache()
        if name != "encode":
            assert stage[name].columns == columns
        before = stage[name]
    rows = {n: {r.doc_id: r for r in d.collect()} for n, d in stage.items()}

    texts = {r.doc_id: r.text for r in docs.collect()}
    want = {i for i, t in texts.items() if model.score(t) >= 0.7}
    assert rows["quality"].keys() == want and 0 < len(want) < len(texts)

    ids = sorted(want)
    fps = {i: slow_fingerprint(texts[i]) for i in ids}
    pairs = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1:] if (fps[a] ^ fps[b]).bit_count() <= 4]
    want = set(roots(pairs, ids).values())
    assert rows["near_dedup"].keys() == want

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    bad = {r[0] for r in slow_contamination([(i, texts[i]) for i in want], items) if r[5]}
    assert rows["decontaminate"].keys() == want - bad

    replaced = rows["surrogates"]
    assert replaced.keys() == rows["decontaminate"].keys()
    assert all(r.n_chars == len(r.text) for r in replaced.values())
    assert any(r.text != texts[i] for i, r in replaced.items()) and PATTERN

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_PATH)
    assert {i: r.token_ids for i, r in rows["encode"].items()} == {i: sp.encode(r.text) for i, r in replaced.items()}


def test_run_applies_the_stages(spark, sf):
    out = C.run(spark, sf)
    assert out.count() > 0 and {"doc_id", "token_ids"} <= set(out.columns)
    assert C.ORACLE_SQL is None


def test_registered():
    spec = importlib.util.find_spec("__spark_entry__")
    assert spec
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert len([q for q in names if q.startswith(f"op{n}_")]) == 1


def test_empty_documents(spark, docs_of, sf):
    docs = docs_of([])
    for _, f in C.STAGES:
        docs = f(spark, docs, sf)
    assert docs.count() == 0


def test_awkward_rows_through_run(spark, docs_of, awkward, sf, tmp_path, monkeypatch):
    """Null ids and texts, repeats, very long texts and clashing columns; with the table's labels and with none."""
    import shutil

    for name, labelled in (("with", True), ("without", False)):
        folder = tmp_path / name
        folder.mkdir()
        docs = docs_of(awkward + [(20, "mail a@b.org now please"), (None, "mail a@b.org now please")], extra=labelled)
        docs.write.parquet(str(folder / "documents.parquet"))
        shutil.copy(f"{sf}/benchmark.parquet", folder / "benchmark.parquet")
        labels = spark.read.parquet(f"{sf}/labels.parquet")
        (labels if labelled else labels.limit(0)).write.parquet(str(folder / "labels.parquet"))
        out = C.run(spark, str(folder)).collect()
        if not labelled:  # nothing learnt: every text stays but for its copies
            assert {r.doc_id for r in out} >= {1, 2, 5, 6, 7, 20}
            assert all(r.n_tokens > 0 for r in out if r.doc_id in (1, 5, 6, 7, 20))
        assert len(out) <= len(awkward) + 2
