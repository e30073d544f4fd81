"""Incremental landing with Structured Streaming.

Micro-batches are appended as deltas rather than rewriting the table: a batch writes its own
folder (replayed batches overwrite it, so each takes effect once), reads merge the newest
delta row per key over the base, and a compaction rewrites the buckets of the base that they touch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pledgeflow.operators.buckets import BucketTable, merge_into
from pledgeflow.operators.merge import align, greatest_first, upsert_replace
from pledgeflow.operators.reconcile import first_per_key


def json_stream(spark: SparkSession, folder: str, schema: str | T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """New JSON files of a landing folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(folder)


def land_deltas(
    stream: DataFrame, table: T.StructType, keys: Sequence[str], order: Sequence[Column], deltas: str, checkpoint: str
) -> StreamingQuery:
    """Drain what has arrived: one delta folder per micro-batch, one row per key in each.

    ``order`` puts the winning row of a batch first and may use columns the table lacks.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        last = align(first_per_key(batch, keys, order), table)
        last.write.mode("overwrite").parquet(f"{deltas}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_deltas(spark: SparkSession, deltas: str, table: T.StructType, after: int = -1) -> DataFrame:
    """Delta rows with their batch number; batches up to ``after`` are not read."""
    schema = T.StructType([*table.fields, T.StructField("batch", T.LongType())])
    return spark.read.schema(schema).parquet(deltas).filter(F.col("batch") > after)


def merged(base: DataFrame, deltas: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table as of all landed batches, later batches winning."""
    return upsert_replace(base, deltas, keys, [F.desc("batch")])


def compacted(base: BucketTable, deltas: DataFrame) -> int | None:
    """Fold deltas into a stored base, later batches winning; returns the last batch it then holds.

    Only the buckets with a delta row are rewritten. Later reads merge only the batches after that
    one, so the rows ranked on a read don't grow with all that ever landed. The batches held
    may be removed once no read uses them.
    """
    last = deltas.agg(F.max("batch")).first()[0]
    newest = first_per_key(deltas, base.keys, [F.desc("batch")])
    merge_into(base, newest, lambda stored, batch: upsert_replace(stored, batch, base.keys, greatest_first(batch)))
    return last


_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def append_new_states(stream: DataFrame, keys: Sequence[str], greatest: Sequence[str], out: str, checkpoint: str) -> StreamingQuery:
    """Append each (entity, modified) state once, however late it arrives.

    Of a micro-batch's rows with one key the one with the greatest ``greatest`` columns counts, then the
    greatest of the others. The keys seen are Spark's keyed state on RocksDB, so a micro-batch looks up its
    own keys and never reads what is stored: a key is new if the first and last time it was met are
    this batch's, which a replay keeps. Every batch is a folder of its own, which a replay overwrites.
    """
    spark, columns = stream.sparkSession, stream.columns
    now = F.unix_micros(F.current_timestamp())
    rest = [f.name for f in stream.schema.fields if f.name not in greatest and "map<" not in f.dataType.simpleString()]
    winner = F.max_by(F.struct(*columns), F.struct(*greatest, *rest))
    met = stream.withColumn("__met", now).groupBy(*[F.col(k).alias(f"__key_{k}") for k in keys])
    seen = met.agg(F.min("__met").alias("__first"), F.max("__met").alias("__last"), winner.alias("__row"))
    fresh = seen.filter((F.col("__first") == now) & (F.col("__last") == now)).select("__row.*")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    before = spark.conf.get(_STATE_STORE)
    spark.conf.set(_STATE_STORE, _ROCKS)
    try:
        return (
            fresh.writeStream.outputMode("update")
            .foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(_STATE_STORE, before)
