"""The external shuffle: one place per row, shards one row apart, seeded and not in key order."""

import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from pledgeflow.llm import queries, sharding

SF = "/root/testdata/sf0.001"


def test_query_places_every_document_once(spark):
    rows = queries.QUERIES["op2_external_shuffle"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    slots = defaultdict(list)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_order_is_shuffled_and_repeatable(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")

    def ids(seed):
        rows = sharding.shuffled_shards(docs, seed=seed, bucket_bytes=40_000).collect()
        return [r.record.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]

    once, again, other = ids(1), ids(1), ids(2)
    assert once == again != other
    rises = sum(a < b for a, b in zip(once, once[1:]))
    assert 0.35 < rises / len(once) < 0.65
    # few records keep their distance to the record before
    assert sum(b - a == 1 for a, b in zip(once, once[1:])) < 10


def test_odd_rows(odd):
    rows = sharding.shuffled_shards(odd, bucket_bytes=500).collect()
    assert len(rows) == odd.count()
    assert sorted(map(repr, odd.collect())) == sorted(repr(r.record) for r in rows)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_fewer_rows_than_shards_and_none(odd, no_documents):
    assert sharding.shuffled_shards(odd.limit(3)).count() == 3
    assert sharding.shuffled_shards(no_documents).collect() == []


def test_no_python_in_the_plan(spark, odd):
    placed = sharding.shuffled_shards(odd, row_id=F.col("doc_id"))
    assert "Python" not in placed._jdf.queryExecution().executedPlan().toString()


def test_equal_rows_in_many_files_spread(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    spark.range(400).select(F.lit(7).alias("doc_id"), F.lit("same text").alias("text")).repartition(8).write.parquet(path)
    docs = spark.read.parquet(path)
    assert docs.select(sharding.file_row()).distinct().count() == 400
    rows = queries.QUERIES["op2_external_shuffle"](spark, str(tmp_path)).collect()
    places = Counter(r.shard for r in rows)
    assert len(rows) == 400 and set(places.values()) == {25}
    assert len({(r.shard, r.slot) for r in rows}) == 400


def test_few_partitions_hold_runs_of_buckets(spark, odd, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    by_hash = spark.conf.get("spark.sql.execution.useObjectHashAggregateExec")
    path = str(tmp_path / "shards")
    rows = sharding.shuffled_shards(docs, bucket_bytes=2_000, partitions=3, path=path).collect()
    tasks = {file.name.split("-")[1] for file in (tmp_path / "shards").glob("shard=*/*.parquet")}
    assert tasks == {"00000", "00001", "00002"}
    assert spark.conf.get("spark.sql.execution.useObjectHashAggregateExec") == by_hash
    assert sorted(r.record.doc_id for r in rows) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert sharding.shuffled_shards(odd, bucket_bytes=100, partitions=2).count() == odd.count()


def test_groups_are_laid_out_in_order(spark, odd):
    with sharding.groups_in_order(spark):
        grouped = odd.sortWithinPartitions("lang").groupBy("lang").agg(F.collect_list("text"))
        plan = grouped._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" in plan and "ObjectHashAggregate" not in plan
