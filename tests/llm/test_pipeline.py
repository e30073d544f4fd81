"""The pipeline's stages against brute force on their own input, and the registered queries."""

import corpus_pipeline
import pytest
from oracle import compare, duck
from test_line_dedup import brute as brute_lines
from test_quality import brute as brute_counts
from test_simhash import brute_groups, brute_print

import __spark_entry__
from pledgeflow.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), duck(SF), queries.ORACLES[name]) is None


def test_all_are_registered():
    names = set(__spark_entry__.queries())
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names
    assert set(queries.ORACLES) <= set(__spark_entry__.oracle_sql())


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before, columns = docs.collect(), docs.columns
    after = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(i))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        after[name] = docs.collect()
        if i < 3:
            assert docs.columns == columns
    first = after["quality rules"]
    assert set(first) <= set(before)
    for r in set(before) - set(first):  # nothing labelled good goes unless it fails the fixed rules
        n = brute_counts(r.text)
        label = spark.read.parquet(f"{SF}/labels.parquet").filter(f"doc_id = {r.doc_id}").first()
        assert n[0] < 20 or 100 * n[4] > 30 * n[0] or label is None or label.quality == 0
    lines = brute_lines([(r.doc_id, r.text) for r in first])
    assert sorted((r.doc_id, r.text, r.n_chars) for r in after["line dedup"]) == sorted((r.doc_id, k, len(k)) for r, (k, _, _) in zip(first, lines))
    deduped = sorted(after["line dedup"])
    groups = brute_groups([brute_print(r.text) for r in deduped])
    assert sorted(after["simhash near-dedup"]) == [r for i, r in enumerate(deduped) if groups[i] == i]
    packed = after["best-fit packing"]
    assert {r.doc_id for r in packed} == {r.doc_id for r in after["simhash near-dedup"]}
    same = corpus_pipeline.run(spark, SF).collect()
    key = lambda rows: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert key(same) == key(packed)


def test_stages_on_odd_documents(spark, odd, tmp_path):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    # good labels only: nothing but the fixed rules may reject
    spark.createDataFrame([(i, 1, 0) for i in (3, 6, 7, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = docs.collect()

    def passes(text):
        n = brute_counts(text or "")
        return n[0] >= 20 and 100 * n[4] <= 30 * n[0]

    lines = brute_lines([(r.doc_id, r.text) for r in rows])
    groups = brute_groups([brute_print(r.text) for r in rows])
    members = [[r.doc_id for r, g in zip(rows, groups) if g == group and r.doc_id is not None] for group in set(groups)]
    expected = [
        [tuple(r) for r in rows if passes(r.text)],
        [(r.doc_id, k, r.lang, r.source, len(k)) if dropped else tuple(r) for r, (k, _, dropped) in zip(rows, lines)],
        [min(ids) if ids else None for ids in members],
    ]
    assert 0 < len(expected[0]) < len(rows) and any(dropped for _, _, dropped in lines) and len(members) < len(rows)
    for (name, stage), want in zip(corpus_pipeline.STAGES[:3], expected):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.schema["text"].dataType == docs.schema["text"].dataType
        got = out.collect()
        if name == "simhash near-dedup":
            assert set(got) <= set(rows)
            assert sorted(map(repr, (r.doc_id for r in got))) == sorted(map(repr, want))
        else:
            assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
        assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []
