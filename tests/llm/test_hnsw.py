"""Nearest neighbours against brute force."""

import numpy as np
import pytest

from roadlens.llm import hnsw

SCHEMA = "vec_id bigint, embedding array<float>, rank int, shard int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 1) for i, v in rows], SCHEMA)


def brute(rows, every, k):
    ids = np.array([i for i, _ in rows])
    vecs = np.array([v for _, v in rows], np.float32).astype(np.float64)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = vecs @ vecs[i]
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


@pytest.mark.parametrize("shard_rows", [10_000, 250])
def test_recall_and_scores(spark, shard_rows):
    rng = np.random.default_rng(4)
    vecs = rng.standard_normal((1500, 24)) * rng.uniform(0.5, 2, (1500, 1))
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(vecs)]
    got, want = {}, brute(rows, 20, 20)
    for r in hnsw.search(table(spark, rows), shard_rows=shard_rows, query_block=30).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert got.keys() == want.keys()
    hits = sum(len({v for _, v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.95 * 20 * len(want)
    exact = np.array([v for _, v in rows], np.float32).astype(np.float64)
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert all(abs(s - exact[q] @ exact[v]) < 1e-9 for _, v, s in found)
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)


def test_ties_copies_and_unusable_rows(spark):
    one, two = [1.0, 0.0], [0.0, 1.0]
    nan, inf = float("nan"), float("inf")
    rows = [(i, one) for i in range(1, 60)] + [(60, one), (60, one), (80, two), (81, two), (100, [0.0, 0.0]), (120, None),
            (140, [None, 1.0]), (160, [nan, 1.0]), (180, [inf, 1.0]), (200, []), (220, [1.0, 2.0, 3.0]), (None, one)]
    got = {}
    for r in hnsw.search(table(spark, rows)).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(got) == [20, 40, 60, 80]
    assert [v for _, v, _ in sorted(got[20])] == [i for i in range(1, 22) if i != 20]
    assert [v for _, v, _ in sorted(got[60])] == list(range(1, 21))
    assert sorted(got[80])[0][1:] == (81, 1.0) and len(got[80]) == 20
    assert hnsw.search(table(spark, [])).count() == 0
    assert hnsw.search(table(spark, [(20, one)])).count() == 0
    assert hnsw.search(table(spark, [(21, one), (22, two)])).count() == 0


def test_stored_graph_is_the_built_one(spark):
    import pandas as pd
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"vec_id": range(300), "vec": [v for v in rng.standard_normal((300, 8))]})
    rows = hnsw._build_shard((8, 0), pdf)
    graph, vecs, starts, ids = hnsw.load_graph(rows)
    assert len(rows) == 1 and sorted(ids.tolist()) == list(range(300)) and starts[-1] == 300
    stamp = np.zeros(300, np.int64)
    found, _ = graph.search(graph.vecs[5], 50, stamp, 0)
    assert found[0][1] == 5
    links, degree = graph.layers[0]
    assert degree.max() <= 2 * hnsw.LINKS and all(i not in links[i, :degree[i]] for i in range(300))
