import numpy as np
import pytest

from civiclake.llm import neighbours


def brute(rows, k=20, divisor=20):
    ids, points = [i for i, _ in rows], np.array([v for _, v in rows], np.float64)
    out = {}
    for i, v in rows:
        if i % divisor == 0:
            scores = (points * np.array(v, np.float64)).sum(1)
            out[i] = sorted(((-s, j) for s, j in zip(scores, ids) if j != i))[:k]
    return out


def clustered(n, seed=0, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dim))
    points = centres[rng.integers(0, 12, n)] + 0.5 * rng.standard_normal((n, dim))
    return [(int(i), p.astype(np.float32).tolist()) for i, p in enumerate(points)]


def test_recall_and_exact_scores(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_VECTORS", 300)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 90)
    rows = clustered(4000)
    expected = brute(rows)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS part", "2 AS score", "3 AS id")
    got: dict = {}
    for r in neighbours.nearest(df).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        assert r.rank == len(got[r.query_id])
    assert got.keys() == expected.keys()
    points = dict(rows)
    for key, found in got.items():
        assert len(found) == 20 and found == sorted(found) and key not in [j for _, j in found]
        for score, other in found[:3]:
            assert -score == pytest.approx(np.dot(np.array(points[key], float), np.array(points[other], float)), abs=1e-12)
    hits = sum(len({j for _, j in got[q]} & {j for _, j in expected[q]}) for q in expected)
    assert hits >= 0.95 * 20 * len(expected)


def test_odd_vectors_ties_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [None, 1.0]), (5, [inf, 0.0]), (6, [1.0, 2.0, 3.0])]
    rows += [(20, [1.0, 0.0]), (20, [1.0, 0.0]), (None, [1.0, 1.0])] + [(100 + i, [1.0, 0.0]) for i in range(30)] + [(7, [0.5, 0.5]), (40, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df).orderBy("query_id", "rank").collect()
    of = lambda q: [(r.vec_id, r.score) for r in got if r.query_id == q]
    assert of(0) == [(20, 1.0)] + [(100 + i, 1.0) for i in range(19)]
    assert of(20) == [(0, 1.0)] + [(100 + i, 1.0) for i in range(19)]
    assert of(40)[0] == (7, -0.5) and of(40)[1] == (0, -1.0)
    few = neighbours.nearest(df.where("vec_id IN (0, 7, 40)")).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in few] == [(0, 1, 7), (0, 2, 40), (40, 1, 7), (40, 2, 0)]


def test_empty_table(spark):
    got = neighbours.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert got.columns == ["query_id", "rank", "vec_id", "score"] and got.isEmpty()


def test_parts_are_balanced():
    points = np.array([v for _, v in clustered(1000, 3)])
    assert set(np.bincount(neighbours.balanced_parts(points, 3, 8))) == {125}
