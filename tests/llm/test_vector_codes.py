"""Vector codes against plain arithmetic on whole integers."""

import hashlib
import math
import random
from collections import defaultdict

from pledgeflow.llm import queries, vector_codes

SF = "/root/testdata/sf0.001"


def brute(rows, dims, parts=8, entries=16, rounds=6, scale=4096):
    """({position: (code, error)}, digest) of rows (key, vector) of one length; positions index ``rows``."""
    whole = [[math.floor(scale * x) for x in v] for _, v in rows]
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, whole[i]))[:entries]
    edges = [dims * i // parts for i in range(parts + 1)]
    cut = [[w[a:b] for w in whole] for a, b in zip(edges, edges[1:])]
    books = [[part[i] for i in first] for part in cut]

    def nearest(vector, book):
        return min((sum((x - y) ** 2 for x, y in zip(vector, entry)), i) for i, entry in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            groups = defaultdict(list)
            for vector in cut[p]:
                groups[nearest(vector, book)[1]].append(vector)
            books[p] = [[sum(c) // len(groups[i]) for c in zip(*groups[i])] if groups[i] else entry for i, entry in enumerate(book)]
    out = {}
    for i in range(len(rows)):
        found = [nearest(cut[p][i], books[p]) for p in range(parts)]
        out[i] = "".join(f"{j:02x}" for _, j in found), sum(d for d, _ in found)
    shown = ",".join(str(x) for book in books for entry in book for x in entry)
    return out, hashlib.sha256(shown.encode()).hexdigest()


def test_query(spark):
    rows = [r for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    kept = [r for r in rows if r.embedding is not None and all(x is not None and math.isfinite(x) for x in r.embedding)]
    want, digest = brute([(r.vec_id, r.embedding) for r in kept], len(kept[0].embedding))
    per_label = defaultdict(int)
    for i, r in enumerate(kept):
        per_label[r.label] += want[i][1]
    got = queries.QUERIES["op13_value_dictionaries"](spark, SF).collect()
    expected = [(r.vec_id, *want[i], per_label[r.label], digest) for i, r in enumerate(kept)]
    assert sorted(map(tuple, got)) == sorted(expected)


def odd_vectors():
    rng = random.Random(8)
    rows = [(i, [rng.choice([-1.0, -0.3, 0.0, 0.1 * rng.random(), 0.25]) for _ in range(11)], rng.choice([None, 1, 2])) for i in range(150)]
    rows += rows[:3] + [(None, rows[5][1], 3), (7, rows[9][1], 1)]
    odd = [(200, None, 1), (201, [], 1), (202, [1.0], 2), (203, [float("nan")] * 11, 1), (204, [float("inf")] + [0.0] * 10, 1), (205, [None] + [0.0] * 10, 1), (206, [1e300] + [0.0] * 10, 2)]
    return rows, odd


SCHEMA = "vec_id long, embedding array<double>, label int, kept string"


def test_odd_vectors(spark, monkeypatch):
    rows, odd = odd_vectors()
    want, digest = brute([(r[0], r[1]) for r in rows], 11)
    df = spark.createDataFrame([(*r, "x") for r in rows + odd], SCHEMA).repartition(3)
    coded, books = vector_codes.compress(df, passed=("label", "kept"))
    assert vector_codes.digest(books) == digest
    expected = [(r[0], r[2], *want[i]) for i, r in enumerate(rows)] + [(i, label, None, None) for i, label in ((201, 1), (202, 2), (206, 2))]
    got = vector_codes.with_label_error(coded, "label").collect()
    assert sorted(((r.kept.vec_id, r.kept.label, r.code, r.error) for r in got), key=repr) == sorted(expected, key=repr)
    totals = defaultdict(int)
    for _, label, _, error in expected:
        totals[label] += error or 0
    assert {r.kept.label: r.label_error for r in got} == dict(totals)


def test_small_chunks_change_nothing(spark, monkeypatch):
    rows, _ = odd_vectors()
    want, digest = brute([(r[0], r[1]) for r in rows], 11, 4, 5, 3, 100)
    monkeypatch.setattr(vector_codes, "CHUNK_ROWS", 7)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").coalesce(1)
    chunks = vector_codes.chunked(df.selectExpr("struct(vec_id) kept", "embedding"), "embedding", 11, 100)
    assert chunks.count() == -(-len(rows) // 7)
    coded, books = vector_codes.compress(df, parts=4, entries=5, rounds=3, scale=100)
    assert vector_codes.digest(books) == digest
    assert sorted((repr(r.kept.vec_id), r.code, r.error) for r in coded.collect()) == sorted((repr(r[0]), *want[i]) for i, r in enumerate(rows))


def test_few_vectors_and_none(spark):
    df = spark.createDataFrame([(5, [0.5] * 8, 1), (6, [0.25] * 8, 1)], "vec_id long, embedding array<double>, label int")
    coded, books = vector_codes.compress(df)
    assert sorted((r.kept.vec_id, r.code, r.error) for r in coded.collect()) == [(5, "00" * 8, 0), (6, "01" * 8, 0)]
    assert len(books) == 8 and books[0].tolist() == [[2048], [1024]]
    coded, books = vector_codes.compress(df.limit(0))
    assert vector_codes.with_label_error(vector_codes.compress(df.limit(0), passed=("label",))[0], "label").collect() == []
    assert coded.collect() == [] and vector_codes.digest(books) == hashlib.sha256(b"").hexdigest()
