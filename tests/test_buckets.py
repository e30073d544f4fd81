"""Merges into a table stored by bucket, seen on its files."""

import os

from helpers import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pledgeflow.operators import merge
from pledgeflow.operators.buckets import BucketTable, merge_into

TABLE = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])


def _files(path):
    return {(folder, f): os.path.getmtime(os.path.join(path, folder, f)) for folder in os.listdir(path) if "=" in folder for f in os.listdir(os.path.join(path, folder))}


def _replace(stored, batch):
    return merge.upsert_replace(stored, batch, ["id"], merge.greatest_first(batch))


def _table(spark, tmp_path, buckets=16):
    table = BucketTable(str(tmp_path / "table"), TABLE, ["id"], buckets)
    table.write(spark.range(400).select("id", F.lit("old").alias("v")))
    return table


def test_one_key_rewrites_one_bucket(spark, tmp_path):
    table = _table(spark, tmp_path)
    before = _files(table.path)
    touched = merge_into(table, spark.createDataFrame([(7, "new")], "id int, v string"), _replace)
    after = _files(table.path)
    changed = {folder for (folder, _), _ in set(before.items()) ^ set(after.items())}
    assert len(touched) == 1 and changed == {f"bucket={touched[0]}"}
    got = {r.id: r.v for r in table.read(spark).collect()}
    assert got == {i: "new" if i == 7 else "old" for i in range(400)}


def test_only_touched_buckets_are_read(spark, tmp_path):
    table = _table(spark, tmp_path)
    files = table.read(spark, [3]).select(F.input_file_name().alias("f")).distinct().collect()
    assert files and all("/bucket=3/" in r.f for r in files)
    assert 0 < table.read(spark, [3]).count() < 400 == table.read(spark).count()


def test_every_merge_equals_that_of_whole_tables(spark, tmp_path):
    batch = spark.createDataFrame([(5, "b"), (5, "a"), (401, "c"), (402, None), (6, "")], TABLE)
    ways = {
        "replace": _replace,
        "ignore": lambda stored, new: merge.insert_ignore(stored, new, ["id"], merge.greatest_first(new)),
        "staged": lambda stored, new: merge.upsert_staged(stored, new, ["id"], merge.greatest_first(new)),
        "partial": lambda stored, new: merge.upsert_partial(stored, new, "id", ["v"]),
    }
    for name, way in ways.items():
        table = BucketTable(str(tmp_path / name), TABLE, ["id"], 8)
        table.write(spark.range(400).select("id", F.lit("old").alias("v")))
        whole = rows(way(table.read(spark), batch))
        merge_into(table, batch, way)
        assert rows(table.read(spark)) == whole
        merge_into(table, batch, way)  # a replay changes nothing
        assert rows(table.read(spark)) == whole


def test_empty_table_and_empty_batch(spark, tmp_path):
    table = BucketTable(str(tmp_path / "none"), TABLE, ["id"], 4)
    assert table.read(spark).collect() == []
    assert merge_into(table, spark.createDataFrame([], TABLE), _replace) == []
    merge_into(table, spark.createDataFrame([(1, "a"), (None, "n")], TABLE), _replace)
    assert rows(table.read(spark)) == [(1, "a"), (None, "n")]
