"""Counts against brute force, the forest on planted anomalies, the threshold on labels."""

import math
import re
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from pledgeflow.llm import quality, queries

SF = "/root/testdata/sf0.01"


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    at = defaultdict(list)
    for i in range(len(words) - 7):
        at[tuple(words[i : i + 8])].append(i)
    covered = {j for found in at.values() if len(found) > 1 for i in found for j in range(i, i + 8)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), len(set(words)))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "é#", "中", " ", "\n", "\t", "\x0b", "\x1c", " "]), max_size=80).map(" ".join))
def test_counts_on_any_text(text):
    assert quality.text_counts(text.encode()) == brute(text)


def test_odd_documents(spark, odd):
    labels = spark.createDataFrame([(6, 1, 0), (6, 0, 0), (None, 0, 0), (8, None, 1)], "doc_id long, quality int, toxic int")
    rows = quality.judge(odd, labels, passed=("text", "kept")).collect()
    assert len(rows) == odd.count()
    for r in rows:
        want = brute(r.kept.text or "")
        assert tuple(r[c] for c in quality.COUNTS) == want
        failed = want[0] < 20 or 100 * want[4] > 30 * want[0]
        assert (r.base_failed, r["keep"]) == (failed, not failed)  # no bad label passes the rules: nothing more goes


def test_empty_tables(spark, no_documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.judge(no_documents, labels).collect() == []


def test_query_keeps_good_documents_and_drops_bad(spark):
    rows = {r.doc_id: r for r in queries.QUERIES["op6_isolation_forest"](spark, SF).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert set(rows) == set(texts)
    for i in list(texts)[:150]:
        assert (rows[i].n_words, rows[i].word_chars, rows[i].n_symbols, rows[i].n_dup_lines, rows[i].n_repeat_words) == brute(texts[i])[:5]
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    passed = [x for x in labels if not rows[x.doc_id].base_failed]
    good = [rows[x.doc_id].kept for x in passed if x.quality]
    bad = [rows[x.doc_id].kept for x in passed if not x.quality]
    assert np.mean(good) >= 0.995 and np.mean(bad) <= 0.4


def test_held_out_labels(spark):
    """The threshold set on half of the labels holds on the other half."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    judged = quality.judge(docs, labels.filter("doc_id % 2 = 0")).filter("not base_failed").selectExpr("kept.doc_id", "keep")
    rows = judged.join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    assert np.mean([r["keep"] for r in rows if r.quality]) >= 0.99
    assert np.mean([r["keep"] for r in rows if not r.quality]) <= 0.1


def test_forest_isolates_outliers():
    rng = np.random.default_rng(0)
    usual, odd = rng.normal(size=(2000, 3)), np.array([[9.0, 9.0, -9.0], [0, -9.0, 9.0]])
    forest = []
    for seed in range(50):
        rows = usual[rng.permutation(2000)[:256]]
        nodes = quality.grow_tree(rows, seed, 10)
        forest.append(np.array([[*node, 256] for node in nodes], float))
    assert quality.isolation(odd, forest).min() > np.quantile(quality.isolation(usual, forest), 0.99)
    assert quality.isolation(usual, []).max() == 0


def statistics(spark, rows):
    return spark.createDataFrame([tuple(map(int, r)) for r in rows], ", ".join(f"{c} long" for c in quality.COUNTS))


def clean(rng, n):
    """Counts of clean texts of 30 to 30,000 words, whose distinct words grow as a power of their length."""
    words = np.exp(rng.uniform(np.log(30), np.log(30_000), n)).round()
    distinct = words ** rng.uniform(0.93, 0.97, n)
    none = np.zeros(n)
    return np.c_[words, words * rng.uniform(4.5, 5.5, n), none, none, none, distinct]


def test_every_tree_takes_its_own_sample_at_every_size(spark):
    rng = np.random.default_rng(1)
    for n in (200, 300, 5000):
        table = statistics(spark, clean(rng, n))
        points = table.select(*quality.features()).distinct().count()
        forest = quality.grow_forest(table.unionAll(table), trees=8, sample=128)
        assert [int(tree[0, 5]) for tree in forest] == [min(points, 128)] * 8
        assert len({tuple(tree[0, :2]) for tree in forest}) == 8
        again = quality.grow_forest(table.repartition(3), trees=8, sample=128)
        assert all(np.array_equal(a, b) for a, b in zip(forest, again, strict=True))


def test_repetition_counts_and_length_does_not(spark):
    rng = np.random.default_rng(2)
    usual = statistics(spark, clean(rng, 3000))
    forest = quality.grow_forest(usual)
    score = lambda rows: np.array([r.score for r in quality.scored(statistics(spark, rows), forest).collect()])
    plain = score(clean(rng, 500))
    bound = np.quantile(plain, 0.99)
    words, characters, distinct = 400, 2000, 400**0.95
    assert score([(w, 5 * w, 0, 0, 0, w**0.95) for w in (50, 400, 20_000)]).max() < bound
    few_words, many_lines = (words, characters, 0, 0, 0, 40), (words, characters, 0, 60, 0, distinct)
    repeats, some = (words, characters, 0, 25, 110, distinct), (words, characters, 0, 0, 40, distinct)
    assert score([few_words, many_lines, repeats]).min() > bound > score([some])[0]


def test_mean_path():
    assert [quality.mean_path(n) for n in (0, 1, 2)] == [0, 0, 1]
    assert math.isclose(quality.mean_path(256), 10.2448, rel_tol=1e-3)
