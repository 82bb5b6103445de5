"""The vector index against all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from marginalia.operators import vectors as V


def exact(ids, m, k):
    m = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
    out = {}
    for n, i in enumerate(ids):
        s = np.round(m @ m[n], 9)
        order = sorted((j for j in range(len(ids)) if j != n), key=lambda j: (-s[j], ids[j]))[:k]
        out[i] = [ids[j] for j in order]
    return out


def found(held, queries, centroids, k, probes):
    got = {}
    for r in sorted(V.nearest(held, queries, centroids, k, probes).collect(), key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append(r.vec_id)
    return got


@pytest.mark.parametrize("piece", [2048, 7])
def test_index(spark, monkeypatch, piece):
    monkeypatch.setattr(V, "PIECE", piece)
    rng = np.random.default_rng(2)
    m = np.concatenate([rng.normal(c, 0.6, (60, 8)) for c in rng.normal(0, 1, (5, 8))] + [np.zeros((1, 8)), np.ones((3, 8))])
    ids = [int(x) for x in rng.permutation(len(m)) * 7]
    df = spark.createDataFrame([(i, v.tolist(), "x") for i, v in zip(ids, m, strict=True)] + [(9001, None, "x"), (9002, [], "x")], "vec_id long, embedding array<double>, list string").repartition(3)
    queries = df.selectExpr("vec_id AS query_id", "embedding")
    centroids, probes = V.fit(df, 12)
    held = V.index(df.select("vec_id", "embedding"), centroids)
    assert held.count() == len(m) and 1 <= probes <= 12
    want = exact(ids, m, 10)
    assert found(held, queries, centroids, 10, 12) == want  # all lists: all pairs
    some = found(held, queries, centroids, 10, probes)
    assert sum(len(set(some[i]) & set(want[i])) for i in ids) >= 0.9 * sum(map(len, want.values()))


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    centroids, probes = V.fit(none, 4)
    assert V.nearest(V.index(none, centroids), none.selectExpr("vec_id AS query_id", "embedding"), centroids, 3, probes).count() == 0


def test_recall_on_the_given_vectors(spark):
    from marginalia.plans.retrieval import catalog

    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    want = exact([r.vec_id for r in rows], np.array([r.embedding for r in rows], "f8"), 10)
    got = {}
    for r in catalog.queries["cosine_index_topk"](spark, sf).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert sum(len(got[i] & set(w)) for i, w in want.items()) >= 0.9 * 10 * len(want)


@pytest.mark.parametrize("best", [None, 3])
def test_all_pairs_as_matrices(spark, monkeypatch, best):
    """Blocks and pieces of few rows, copies, zeros, other lengths and nulls, against plain pairs; no pair is scored row by row in the plan."""
    from marginalia.operators import retrieval as R

    for name, value in (("BLOCK", 4), ("AT_ONCE", 3), ("PIECE", 5), ("PIECES", 2)):
        monkeypatch.setattr(R, name, value)
    rng = np.random.default_rng(5)
    m = rng.normal(0.2, 1, (60, 6)).astype("f4")
    m[10:14] = m[9]
    m[20] = 0
    rows = [(int(i), v.tolist()) for i, v in enumerate(m)] + [(100, None), (101, []), (102, [1.0, 2.0]), (103, [1.0, 2.0]), (104, [None] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = R.cosine(df, df.where("vec_id % 3 = 0 OR vec_id > 99").selectExpr("vec_id AS query_id", "embedding"), best=best)
    assert "MapInArrow" in got._jdf.queryExecution().toString() and "aggregate(zip_with" not in got._jdf.queryExecution().toString()
    plain = lambda a, b: float(np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b) + 1e-8))
    own = {i: np.array(v, "f8") for i, v in rows if v and None not in v}
    want = [(i, j, round(x, 9)) for i in own if i % 3 == 0 or i > 99 for j in own if i != j and len(own[i]) == len(own[j]) and (x := plain(own[i], own[j])) > 0.3]
    top = lambda p: sorted(x for i in {i for i, _, _ in p} for x in sorted((x for x in p if x[0] == i), key=lambda x: (-x[2], x[1]))[:best])
    assert top([(r[0], r[1], round(r[2], 9)) for r in got.collect()]) == top(want)


def test_a_query_meets_a_list_of_thousands_once(spark):
    """Copies, zeros and nulls; queries and lists meet as matrices, not row by row, and a list of some thousand vectors is one piece."""
    rng = np.random.default_rng(8)
    m = rng.normal(0, 1, (3000, 4))
    m[10:20] = m[9]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<double>")
    centroids, _ = V.fit(df, 1)
    held = V.index(df, centroids)
    assert held.select("piece").distinct().count() == 1
    queries = df.where("vec_id % 100 = 9 OR vec_id = 12").selectExpr("vec_id AS query_id", "embedding")
    got = V.nearest(held, queries, centroids, 5, 1)
    assert "MapInArrow" in got._jdf.queryExecution().toString() and "MapInPandas" not in got._jdf.queryExecution().toString()
    want = exact(range(3000), m, 5)
    assert found(held, queries, centroids, 5, 1) == {i: want[i] for i in [12, *range(9, 3000, 100)]}
