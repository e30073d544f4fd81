"""Late and repeated states, empty stores, compaction."""

import datetime as dt

from helpers import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pledgeflow.operators import filters
from pledgeflow.operators.buckets import BucketTable
from pledgeflow.streaming import landing

STATE = "id long, modified timestamp, status string"


def test_late_states_are_stored_once(spark, tmp_path):
    old, new = dt.datetime(2020, 1, 1), dt.datetime(2024, 1, 1)
    folder = str(tmp_path / "landing")

    def drain():
        stream = landing.json_stream(spark, folder, STATE, 1)
        landing.append_new_states(stream, ["id", "modified"], ["status"], str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()

    for batch in ([(1, new, "b"), (1, new, "a")], [(1, old, "x"), (1, new, "c")], [(2, old, "y"), (1, old, "x")]):
        spark.createDataFrame(batch, STATE).coalesce(1).write.mode("append").json(folder)
        drain()
    stored = landing.read_deltas(spark, str(tmp_path / "out"), spark.createDataFrame([], STATE).schema)
    assert rows(stored.select("id", "modified", "status")) == [(1, old, "x"), (1, new, "b"), (2, old, "y")]


def test_a_batch_reads_its_own_rows_only(spark, tmp_path):
    """The rows that a micro-batch reads don't grow with the states stored before it."""
    read, folder = [], str(tmp_path / "landing")
    for batch in range(4):
        rows_ = spark.range(batch * 500, batch * 500 + 500).select("id", F.lit("2024-01-01").cast("timestamp").alias("modified"), F.lit("s").alias("status"))
        again = rows_.limit(3).withColumn("id", F.lit(0).cast("long"))
        rows_.unionByName(again).coalesce(1).write.mode("append").json(folder)
        stream = landing.json_stream(spark, folder, STATE, 1)
        query = landing.append_new_states(stream, ["id", "modified"], ["status"], str(tmp_path / "out"), str(tmp_path / "check"))
        query.awaitTermination()
        read += [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
        assert "RocksDB" in str(query.lastProgress["stateOperators"][0]["customMetrics"]) or "rocksdb" in str(query.lastProgress["stateOperators"])
    assert read == [503] * 4
    stored = landing.read_deltas(spark, str(tmp_path / "out"), spark.createDataFrame([], STATE).schema)
    assert stored.count() == stored.select("id").distinct().count() == 2000


def test_empty_store_takes_rows_before_1970(spark):
    df = spark.createDataFrame([(1, dt.datetime(1969, 5, 1)), (2, dt.datetime(1970, 1, 1)), (3, dt.datetime(2000, 1, 1))], "id long, at timestamp_ntz")
    assert filters.newer_than_stored(df, "at", df.limit(0), "at").count() == 3
    assert rows(filters.newer_than_stored(df, "at", df.filter("id = 2"), "at").select("id")) == [(3,)]


def test_compaction_equals_merge_on_read(spark, tmp_path):
    table = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])
    base = spark.createDataFrame([(1, "old"), (2, "old")], table)
    for batch, data in enumerate([[(2, "a"), (3, "a")], [(3, "b")], [(1, "c"), (4, "c")]]):
        spark.createDataFrame(data, table).write.parquet(f"{tmp_path}/deltas/batch={batch}")
    deltas = landing.read_deltas(spark, f"{tmp_path}/deltas", table)
    whole = landing.merged(base, deltas, ["id"])
    stored = BucketTable(f"{tmp_path}/base", table, ["id"], 8)
    stored.write(base)
    last = landing.compacted(stored, deltas.filter("batch < 2"))
    part = stored.read(spark)
    assert last == 1
    later = landing.read_deltas(spark, f"{tmp_path}/deltas", table, last)
    assert later.count() == 2
    assert rows(landing.merged(part, later, ["id"])) == rows(whole) == [(1, "c"), (2, "a"), (3, "b"), (4, "c")]
