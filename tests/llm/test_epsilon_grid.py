"""Embedding near-duplicates against all pairs."""
import contextlib
import math
import os
import random
import threading

import numpy as np
import pytest

from metroscope.llm import epsilon_grid as E
from metroscope.llm.queries import op12_epsilon_grid


def plain(rows, limit=0.95, dim=None):
    """(id, vector) rows -> sorted (id, links, component, kept) from all pairs."""
    ok = [i for i, (_, v) in enumerate(rows) if v is not None and all(x is not None and math.isfinite(x) for x in v)
          and any(v) and (dim is None or len(v) == dim)]
    u = {i: np.asarray(rows[i][1], float) / np.linalg.norm(np.asarray(rows[i][1], float)) for i in ok}
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    n = [0] * len(rows)
    m = np.array([u[i] for i in ok]) if ok else np.zeros((0, 1))
    near = m @ m.T >= limit
    for a, i in enumerate(ok):
        for b in np.flatnonzero(near[a]):
            if b != a:
                n[i] += 1
                up[root(max(i, ok[b]))] = root(min(i, ok[b]))
    low = {}
    for i, (x, _) in enumerate(rows):
        low.setdefault(root(i), []).append(x)
    comp = [min((x for x in low[root(i)] if x is not None), default=None) for i in range(len(rows))]
    return sorted(((x, n[i], comp[i], x == comp[i]) for i, (x, _) in enumerate(rows)), key=repr)


def rows_of(df):
    return sorted(map(tuple, df.select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)


def table(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return df.selectExpr("*", "1 node", "2 k1", "3 copies", "'x' v", "4 id", "5 root", "6 links", "7 block") if extra else df


def test_whole_table(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert rows_of(op12_epsilon_grid(spark, sf)) == plain(rows)


@pytest.mark.parametrize("block_bytes,dims", [(1, 3), (1 << 20, 8), (1, 1)])
def test_clusters_copies_and_chains(spark, block_bytes, dims):
    """Many blocks (256 rows each at the least), a third of all rows one vector, near groups, chains."""
    rng = np.random.default_rng(7)
    d, rows = 6, []
    centres = rng.normal(size=(400, d))
    for c in centres:
        rows += [c + rng.normal(size=d) * s for s in rng.uniform(0, 0.5, rng.integers(1, 9))]
    rows += [rows[0]] * 900
    rows += [[math.cos(t), math.sin(t), 0, 0, 0, 0] for t in np.arange(0, 3, 0.2)]  # a chain of links
    ids = rng.permutation(len(rows)).tolist()
    data = [(i, [float(np.float32(x)) for x in v]) for i, v in zip(ids, rows)]
    got = E.near_duplicates(table(spark, data), block_bytes=block_bytes, grid_dims=dims)
    assert rows_of(got) == plain(data)


def test_leaves_skip_only_distant_rows():
    rng = np.random.default_rng(1)
    a = E.unit_rows(np.concatenate([rng.normal(size=(700, 4)), rng.normal(size=(1, 4)) + rng.normal(size=(300, 4)) * 0.05]))
    b = E.unit_rows(rng.normal(size=(500, 4)))
    axes = np.eye(4)[:, :2]
    eps = math.sqrt(2 - 2 * 0.95)
    order = lambda m: m[np.lexsort((m[:, 1], np.floor(m[:, 0] / eps)))]
    a, b = order(a), order(b)
    copies = np.arange(1, len(a) + len(b) + 1)
    counts, _ = E.block_links(a, b, copies, axes, eps, 0.95)
    near = a @ b.T >= 0.95
    assert counts.tolist() == [*(near @ copies[len(a):]), *(copies[:len(a)] @ near)]
    counts, roots = E.block_links(a, None, copies[:len(a)], axes, eps, 0.95)
    near = a @ a.T >= 0.95
    np.fill_diagonal(near, False)
    assert counts.tolist() == (near @ copies[:len(a)]).tolist()
    assert all(roots[i] == roots[j] for i, j in np.argwhere(near))


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0, 0.0]), (1, [1.0, 0.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0, 0.0]), (5, [nan, 1.0, 0.0]), (6, [inf, 0.0, 0.0]),
            (7, [None, 1.0, 0.0]), (None, [2.0, 0.0, 0.0]), (None, None), (8, [0.0, 1.0, 0.0]), (9, [1.0, 0.0]), (1, [0.0, 0.0, 5.0]),
            (11, [-1.0, 0.0, 0.0]), (12, [1e-30, 0.0, 0.0]), (None, [-1.0, -0.9, 1.0]), (13, [3e38, 3e38, 0.0])]
    for extra in (False, True):
        assert rows_of(E.near_duplicates(table(spark, rows, extra))) == plain(rows, dim=3)
    assert E.near_duplicates(table(spark, [])).count() == 0
    assert rows_of(E.near_duplicates(table(spark, [(1, None), (2, [0.0])]))) == [(1, 0, 1, True), (2, 0, 2, True)]
    # the limit itself links
    edge = [(1, [1.0, 0.0]), (2, [0.6, 0.8])]
    assert [r[1] for r in rows_of(E.near_duplicates(table(spark, edge), min_cosine=0.6 / math.hypot(np.float32(0.6), np.float32(0.8))))] == [1, 1]


def test_order_is_free(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(3)]) for i in range(300)]
    got = rows_of(E.near_duplicates(table(spark, rows)))
    assert got == rows_of(E.near_duplicates(table(spark, rows[::-1]).repartition(5)))


@pytest.mark.parametrize("kind", ["float", "double"])
def test_disk_does_not_grow_with_the_block_pairs(spark, kind):
    """Vectors without structure: no pair of the 16 blocks is distant, and none is shipped or kept twice."""
    rng = np.random.default_rng(5)
    m = rng.normal(size=(4000, 48)).astype(np.float32)
    m[3000:3500] = m[:500] + rng.normal(size=(500, 48)).astype(np.float32) * 0.1
    data = [(i, [float(x) for x in v]) for i, v in enumerate(m)]
    df = spark.createDataFrame(data, f"vec_id long, embedding array<{kind}>")
    dirs = [d.getPath() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    before, most, seen, ended = on_disk(dirs), spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), [0], threading.Event()

    def watch():  # Spark deletes the files of a shuffle once its query ends
        while not ended.wait(0.02):
            seen.append(on_disk(dirs))

    watcher = threading.Thread(target=watch)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for blocks beyond it
    watcher.start()
    try:
        got = E.near_duplicates(df, block_bytes=1)
    finally:
        ended.set()
        watcher.join()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    assert max(seen) - before < (4 if kind == "float" else 8) * m.nbytes
    assert rows_of(got) == plain(data)


def on_disk(dirs):
    size = 0
    for top in dirs:
        for d, _, names in os.walk(top):
            for name in names:
                with contextlib.suppress(OSError):  # a file may go meanwhile
                    size += os.path.getsize(os.path.join(d, name))
    return size


def test_shipped_and_stored_blocks_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(300, 5))
    data = [(i, [float(np.float32(x)) for x in centres[i % 300] + rng.normal(size=5) * 0.2]) for i in range(2500)]
    for most in (0, 10**6):
        monkeypatch.setattr(E, "SHIPPED_PAIRS", most)
        assert rows_of(E.near_duplicates(table(spark, data), block_bytes=1)) == plain(data)
