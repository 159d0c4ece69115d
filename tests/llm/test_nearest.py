"""Nearest neighbours: recall against brute force, exact distances, edge rows."""

import math

import numpy as np
import pytest

from folioscope.llm import nearest
from folioscope.llm.queries import QUERIES


def brute(rows, k=10, every=100):
    good = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in good:
        if q % every == 0:
            near = {}
            for i, x in good:
                if i != q:
                    near[i] = min(near.get(i, math.inf), float(np.sqrt(((x - v) ** 2).sum())))
            out[q] = sorted((d, i) for i, d in near.items())[:k]
    return out


def check(got, want, recall):
    answers = {}
    for r in got:
        answers.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert answers.keys() == want.keys()
    right = 0
    for q, rows in answers.items():
        rows.sort()
        assert [r for r, _, _ in rows] == list(range(1, len(rows) + 1)) and len(rows) == len(want[q])
        assert [(s, i) for _, i, s in rows] == sorted((s, i) for _, i, s in rows)
        right += len({i for _, i, _ in rows} & {i for _, i in want[q]})
    assert right >= recall * sum(map(len, want.values()))


def test_query_recall(spark):
    folder = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = QUERIES["op8_nearest"](spark, folder).collect()
    want = brute(rows)
    check(got, want, 0.9)
    vectors = dict(rows)
    for r in got:
        a, b = (np.array(vectors[i], np.float64) for i in (r.query_id, r.vec_id))
        assert r.score == pytest.approx(float(np.sqrt(((a - b) ** 2).sum())), rel=1e-12)


def test_clustered_vectors_with_a_hot_one(spark, monkeypatch):
    """A third of all rows share a vector; lists and queries are dealt to several tasks."""
    monkeypatch.setattr(nearest, "LIST_ROWS", 20)
    monkeypatch.setattr(nearest, "QUERY_ROWS", 3)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 8)) * 5
    x = np.round(centres[rng.integers(30, size=1200)] + rng.normal(size=(1200, 8)), 3)
    x[:400] = x[0]
    rows = [(int(i), x[i].tolist()) for i in rng.permutation(1200)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    plan = nearest.Plan(cluster=16)
    got = nearest.search(vectors, vectors.where("vec_id % 20 = 0"), plan=plan).collect()
    check(got, brute(rows, every=20), 0.95)
    first = [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == 20]
    assert first == list(range(10))


def test_short_lists_are_made_up_for(spark):
    """Vectors that are centroids themselves, far from all others: their own list holds too few."""
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(size=3) * 10 ** (i % 7)).tolist()) for i in range(120)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    plan = nearest.Plan(cluster=2, steady=1, reach=0.0, copies=1)
    got = nearest.search(vectors, vectors.where("vec_id % 10 = 0"), plan=plan).collect()
    check(got, brute(rows, every=10), 0.0)


def test_graph_walk_finds_the_nearest():
    rng = np.random.default_rng(1)
    graph = nearest.Graph(rng.normal(size=(200, 6)), 16)
    x = rng.normal(size=(50, 6))
    ids, dist = graph.search(x, 40)
    true = np.sqrt(nearest.squared(x, graph.centroids))
    assert np.allclose(dist, np.take_along_axis(true, ids, axis=1), atol=1e-6) and (np.diff(dist, axis=1) >= 0).all()
    assert np.mean(ids[:, 0] == true.argmin(axis=1)) > 0.95


def test_clusters_are_balanced():
    x = np.random.default_rng(2).normal(size=(1000, 4))
    assert 1000 / 64 <= len(nearest.balanced_centroids(x, 64)) <= 32
    assert len(nearest.balanced_centroids(np.ones((100, 3)), 10)) == 16


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (2, [1.0, 0.5]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [1.0, inf])]
    rows += [(7, [1.0, None]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]), (100, [1.0, 0.0]), (0, [1.0, 0.0]), (9, []), (200, None)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'x' AS rank", "1 AS score")
    got = nearest.search(vectors, vectors.where("vec_id % 100 = 0")).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, round(r.score, 3)) for r in got) == [
        (0, 1, 1, 0.0), (0, 2, 100, 0.0), (0, 3, 2, 0.5), (100, 1, 0, 0.0), (100, 2, 1, 0.0), (100, 3, 2, 0.5),
    ]
    for few in (vectors.limit(0), vectors.where("vec_id = 3")):
        assert nearest.search(few, few).collect() == []
    one = vectors.where("vec_id = 100")
    assert nearest.search(one, one).collect() == []
