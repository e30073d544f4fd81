"""The forest against brute force, and its rules for odd vectors and ties."""

import numpy as np
from pyspark.sql import functions as F

from pledgeflow.llm import neighbours, queries

SF = "/root/testdata/sf0.01"


def asks():
    return F.coalesce(F.pmod("vec_id", F.lit(50)) == 0, F.lit(False))



def brute(rows, asked, k=5):
    """(vec_id, score) of the k nearest of each query, over rows of (vec_id, vector)."""
    rows = [(i, np.array(v, float)) for i, v in rows]
    out = {}
    for i, v in asked:
        v = np.array(v, float)
        scored = [(-(w @ v) / np.sqrt(w @ w) / np.sqrt(v @ v), j) for j, w in rows if j != i and len(w) == len(v)]
        out[i] = [(j, -s) for s, j in sorted((round(s, 12), j) for s, j in scored)[:k]]
    return out


def test_recall_on_the_whole_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    want = brute(rows, [(i, v) for i, v in rows if i % 50 == 0])
    got = {}
    for r in queries.QUERIES["op5_hash_prefix_forest"](spark, SF).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert set(got) == set(want)
    assert all(sorted(found) == [1, 2, 3, 4, 5] for found in got.values())
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q].values()}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    vectors = dict(rows)
    for q, found in got.items():
        for i, score in found.values():
            v, w = np.array(vectors[q], float), np.array(vectors[i], float)
            assert abs(score - v @ w / np.sqrt(v @ v) / np.sqrt(w @ w)) < 1e-12


def test_odd_vectors(spark):
    rng = np.random.default_rng(1)
    some = [(i, [float(x) for x in rng.standard_normal(4)]) for i in range(1, 30)]
    copies = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(100, 120)]  # 100 asks
    other = [(200, [1.0, 0.0]), (201, [1.0, 1.0])]  # of another length
    odd = [(50, None), (150, [0.0] * 4), (250, [1.0, None, 0.0, 0.0]), (300, [float("nan")] * 4), (31, [float("inf"), 1.0, 1.0, 1.0]), (None, [1.0] * 4), (350, [])]
    schema = "vec_id long, embedding array<float>, label int, `class` string, `query` string"
    rows = [(i, v, 0, "x", "y") for i, v in [*some, (0, some[3][1]), *copies, *other, *odd]]
    table = spark.createDataFrame(rows, schema)
    got = {}
    for r in neighbours.nearest(table, asks(), trees=8).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    exact = [(i, np.float32(v)) for i, v in [*some, (0, some[3][1]), *copies, *other]]
    want = brute(exact, [(i, v) for i, v in exact if i % 50 == 0])
    assert set(got) == {0, 100, 200}
    for q, found in got.items():
        found.sort()
        assert [i for _, i, _ in found] == [i for i, _ in want[q]]
        assert np.allclose([s for *_, s in found], [s for _, s in want[q]])


def test_blocks_change_nothing(spark, monkeypatch):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").limit(200)
    whole = sorted(map(tuple, neighbours.nearest(table, asks(), trees=4).collect()))
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 30)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 2)
    assert sorted(map(tuple, neighbours.nearest(table, asks(), trees=4).collect())) == whole


def test_every_query_gets_its_neighbours(spark):
    """An outlier and a rare vector length in a table whose trees are cut at a prefix."""
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.standard_normal(8) * 0.1 + 1]) for i in range(9000)]
    rows += [(9000, [-1.0 - 0.01 * i for i in range(8)])]
    rows += [(9050, [1.0, 0.0, 0.0, 0.0]), (9051, [-1.0, 0.01, 0.0, 0.0])]
    got = {}
    for r in neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), asks()).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    assert set(got) == set(range(0, 9051, 50))
    assert {q for q, found in got.items() if len(found) != 5} == {9050}
    assert got[9050] == [(1, 9051)]


def test_empty_and_single(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.nearest(empty, asks()).collect() == []
    single = spark.createDataFrame([(0, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert neighbours.nearest(single, asks()).collect() == []


def test_common_prefix():
    a = np.array([0, 1, 1 << 63, 5], np.uint64)
    assert neighbours._common_prefix(a, np.zeros(4, np.uint64)).tolist() == [64, 63, 0, 61]
