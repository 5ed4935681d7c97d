import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.vamana import Graph, nearest

SCHEMA = "vec_id long, embedding array<float>, score string, point int"


def brute_force(rows, queries, k):
    out = {}
    for q in queries:
        d = np.sqrt(((np.array([rows[v] for v in rows]) - rows[q]) ** 2).sum(axis=1))
        order = sorted((s, v) for s, v in zip(d, rows) if v != q)
        out[q] = order[:k]
    return out


@pytest.mark.parametrize("shift, scale", [(0, 1), (1e4, 1), (-1e6, 1), (0, 1e25), (0, 1e-25), (3e30, 1e25)])
def test_graph_finds_what_a_scan_finds(shift, scale):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 48)) * scale + shift
    graph = Graph(x).build()
    q = x[::30] + rng.normal(size=(100, 48)) * 0.3 * scale
    found = graph.search(q, 128)[:, :10]
    exact = ((x[None] - q[:, None]) ** 2).sum(axis=2).argsort(axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(found, exact)]) >= 0.95


def test_clusters_far_apart_and_queries_from_afar():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(2000, 24)) + np.where(np.arange(2000) % 2, 1e4, -1e4)[:, None]
    graph = Graph(x).build()
    q = np.concatenate((x[::40] + 0.1, rng.normal(size=(20, 24)) * 1e9))
    found = graph.search(q, 128)[:, :10]
    exact = ((x[None] - q[:, None]) ** 2).sum(axis=2).argsort(axis=1)[:, :10]
    hits = [len(set(a) & set(b)) / 10 for a, b in zip(found, exact)]
    assert np.mean(hits[:50]) >= 0.9 and np.mean(hits[50:]) >= 0.9


@pytest.mark.parametrize("shard_points", [60, 600])
def test_recall_ties_and_copies(spark, shard_points):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    x[200:600] = x[7]  # more equal vectors than anyone asks for
    rows = {i: v.astype(float) for i, v in enumerate(x)}
    table = [(i, [float(c) for c in v], "", 0) for i, v in enumerate(x)]
    table += [table[10]] * 30
    docs = spark.createDataFrame(table, SCHEMA).repartition(5)
    got = {}
    for r in nearest(docs, F.col("vec_id") % 100 == 0, 10, shard_points).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"], r["rank"]))
    want = brute_force(rows, range(0, 1500, 100), 10)
    assert set(got) == set(want)
    hits = 0
    for q, own in want.items():
        assert [r for _, _, r in got[q]] == list(range(1, 11))
        assert [(s, v) for s, v, _ in got[q]] == sorted((s, v) for s, v, _ in got[q])
        hits += len({v for _, v in own} & {v for _, v, _ in got[q]})
        for s, v, _ in got[q]:
            assert s == pytest.approx(np.sqrt(((rows[v] - rows[q]) ** 2).sum()), rel=1e-12)
    assert hits >= 0.95 * 10 * len(want)
    assert [v for _, v, _ in got[200]] == [v for _, v in want[200]]


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (3, [1.0, 1.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]),
            (8, [1.0, inf]), (9, [None, 1.0]), (None, [1.0, 0.5]), (200, [1.0, 2.0, 3.0]), (300, None), (400, [0.0, -0.0])]
    docs = spark.createDataFrame([(i, v, "", 0) for i, v in rows], SCHEMA)
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in nearest(docs, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 3), (0, 2, 100), (100, 1, 3), (100, 2, 0)]
    assert nearest(docs.limit(0), F.col("vec_id") % 100 == 0).count() == 0
