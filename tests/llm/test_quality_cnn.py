"""Op 10: gradients, whole-document scoring, held-out accuracy, awkward rows."""
import zlib

import numpy as np
import pytest

from metroscope.llm import quality_cnn as Q


def small_model():
    return Q.ByteCnn(dims=3, width=3, filters=4, seed=1)


def test_gradients_match_finite_differences():
    m = small_model()
    for k in ("emb", "conv", "bias", "head", "head_bias"):
        setattr(m, k, getattr(m, k).astype(np.float64))
    rng = np.random.default_rng(2)
    docs = [rng.integers(97, 103, (n, Q.CHUNK + 2)).astype(np.int16) for n in (2, 1)]
    y = np.array([1.0, 0.0])

    def loss():
        total = 0.0
        for d, label in zip(docs, y):
            h = np.stack([np.maximum((m.windows(c) @ m.conv).max(axis=0) + m.bias, 0) for c in d])
            z = np.concatenate([h.mean(axis=0), h.max(axis=0)]) @ m.head + m.head_bias[0]
            total += np.log1p(np.exp(-z if label else z)) / len(docs)
        return total + 0.5e-4 * (m.head ** 2).sum()

    grads = m._gradients(docs, y)
    for k in ("conv", "bias", "head", "head_bias", "emb"):
        a = getattr(m, k)
        for at in list(np.ndindex(a.shape))[:: max(1, a.size // 12)]:
            old = a[at]
            a[at] = old + 1e-5
            up = loss()
            a[at] = old - 1e-5
            down = loss()
            a[at] = old
            assert grads[k][at] == pytest.approx((up - down) / 2e-5, abs=2e-3)


def test_score_covers_the_whole_text():
    """Chunk features equal a plain convolution over every position, however long."""
    m = small_model()
    rng = np.random.default_rng(3)
    for n in (0, 1, 511, 512, 513, 960, 961, 5000, Q.STRIDE * Q.SEGMENT_CHUNKS * 2 + 77):
        data = rng.integers(0, 256, n).astype(np.uint8).tobytes()
        got = np.concatenate(list(m.chunk_features(data)))
        count = Q.chunk_count(n)
        assert len(got) == count and (count - 1) * Q.STRIDE + Q.CHUNK >= n
        padded = np.full(count * Q.STRIDE + Q.CHUNK + m.width, Q.PAD, np.int16)
        padded[:n] = np.frombuffer(data, np.uint8)
        out = m.windows(padded) @ m.conv
        want = np.stack([np.maximum(out[c * Q.STRIDE:c * Q.STRIDE + Q.CHUNK].max(axis=0) + m.bias, 0) for c in range(count)])
        assert np.allclose(got, want, atol=1e-5)


def test_fit_sees_every_byte():
    for n in (0, 1, 511, 512, 513, 960, 961, 5000, 60_000):
        data = bytes(i % 251 for i in range(n))
        chunks = Q.all_chunks(data, 5)
        assert len(chunks) == Q.chunk_count(n)
        joined = np.concatenate([c[:Q.STRIDE] for c in chunks[:-1]] + [chunks[-1]])
        assert joined[:n].astype(np.uint8).tobytes() == data and (joined[n:] == Q.PAD).all()


def test_labels_of_other_tables_take_no_places(spark, docs_of):
    docs = docs_of([(i, ("fine words here " if i % 3 else "### $$$ ") * 20) for i in range(60)])
    own = [(i, int(i % 3 > 0)) for i in range(60)]
    a = Q.train(docs, spark.createDataFrame(own, "doc_id long, quality int"), max_docs=40)
    b = Q.train(docs, spark.createDataFrame(own + [(10_000 + i, i % 2) for i in range(3000)], "doc_id long, quality int"), max_docs=40)
    assert isinstance(a, Q.ByteCnn) and a.score("fine words") == b.score("fine words")


def test_nothing_to_learn_keeps_everything(spark, docs_of, awkward):
    docs = docs_of(awkward)
    for rows in ([], [(1, 0), (6, 0), (7, 0)], [(99, 1), (98, 0)]):
        model = Q.train(docs, spark.createDataFrame(rows, "doc_id long, quality int"))
        assert isinstance(model, Q.ConstantModel) and Q.keep_good(docs, model).count() == len(awkward)


def test_whole_scorer_against_a_plain_one(spark, sf):
    """Train, score and threshold by plain loops over positions."""
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = Q.train(docs, labels)
    got = {r.doc_id: r for r in Q.score_documents(docs, model).collect()}
    some = [r for r in docs.collect() if len(r.text or "") < 1500][:25]
    for r in some:
        data = list((r.text or "").encode())
        n = Q.chunk_count(len(data))
        padded = data + [Q.PAD] * (n * Q.CHUNK + model.width)
        vectors = []
        for c in range(n):
            best = np.full(model.filters, -np.inf)
            for p in range(c * Q.STRIDE, c * Q.STRIDE + Q.CHUNK):
                window = np.concatenate([model.emb[s] for s in padded[p:p + model.width]])
                best = np.maximum(best, window @ model.conv)
            vectors.append(np.maximum(best + model.bias, 0))
        z = np.concatenate([np.mean(vectors, axis=0), np.max(vectors, axis=0)]) @ model.head + model.head_bias[0]
        assert got[r.doc_id].score == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-4)


def test_held_out_accuracy(spark):
    from metroscope.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op10_quality_cnn"](spark, sf).collect()}
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    test = [i for i in truth if got[i].held_out]
    assert np.mean([got[i].predicted == truth[i] for i in test]) >= 0.92


def test_fit_uses_no_held_out_label(spark, docs_of):
    """Flipping every held-out label changes nothing."""
    from pyspark.sql import functions as F

    from metroscope.llm.common import crc_mod

    docs = docs_of([(i, ("fine words here " if i % 3 else "### $$$ ") * 20) for i in range(60)])
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)], "doc_id long, quality int")
    flipped = labels.withColumn("quality", F.when(crc_mod(F.col("doc_id"), 4) == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = Q.train(docs, labels), Q.train(docs, flipped)
    assert a.score("fine words") == b.score("fine words")


def test_awkward_rows(spark, docs_of, awkward):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 0), (None, 1), (5, None), (6, 1), (99, 1), (7, 1)], "doc_id long, quality int")
    for extra in (False, True):
        docs = docs_of(awkward, extra)
        model = Q.train(docs, labels)
        got = Q.score_documents(docs, model).collect()
        assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in awkward)
        assert all(0 <= r.score <= 1 for r in got)
        kept = Q.keep_good(docs, model, threshold=0.0)
        assert kept.columns == docs.columns and kept.count() == len(awkward)
    none = labels.limit(0)
    assert isinstance(Q.train(docs_of(awkward), none), Q.ConstantModel)
    assert Q.score_documents(docs_of([]), Q.train(docs_of([]), labels)).count() == 0
