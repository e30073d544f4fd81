"""Tables stored by hash bucket of their key, so that a merge rewrites only the buckets it touches.

A table is a folder with one sub-folder per bucket. A batch is merged with the stored rows of its own
buckets (the others are pruned) and written over them by Spark's dynamic partition overwrite. Replaying
a batch gives the same table, so a job that is cut off while it commits is simply run again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pledgeflow.operators.merge import align
from pledgeflow.session import materialise, path_exists

BUCKET = "bucket"


class BucketTable(NamedTuple):
    """Where a table lies, its columns and key, and the number of its buckets, which never changes."""

    path: str
    schema: T.StructType
    keys: Sequence[str]
    buckets: int = 1024

    def bucket(self) -> Column:
        """Bucket of a row; key columns are cast to the table's types, as a hash depends on them."""
        keys = [F.col(k).cast(self.schema[k].dataType) for k in self.keys]
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")

    def read(self, spark: SparkSession, buckets: Sequence[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets: only their folders are read. No rows before the first write."""
        if not path_exists(spark, self.path):
            return spark.createDataFrame([], self.schema)
        stored = spark.read.schema(T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(self.path)
        stored = stored if buckets is None else stored.filter(F.col(BUCKET).isin(list(buckets)))
        return stored.select(*[f"`{c}`" for c in self.schema.names])

    def write(self, rows: DataFrame) -> None:
        """Write rows over the buckets they fall into; other buckets stay as they are."""
        dealt = rows.withColumn(BUCKET, self.bucket()).hint("rebalance", BUCKET)
        writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(BUCKET).parquet(self.path)


def merge_into(table: BucketTable, batch: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
    """Merge a batch into a stored table and return the buckets that were rewritten.

    ``merge`` takes stored rows and batch and returns the rows to store, as the operators of
    :mod:`pledgeflow.operators.merge` do; it sees the rows of the batch's buckets only, among which are all
    with a key of the batch. The batch is written once, without columns the table lacks.
    """
    spark = batch.sparkSession
    batch = materialise(align(batch, table.schema))
    # at most one number per bucket
    touched = sorted(r[0] for r in batch.select(table.bucket()).distinct().collect())
    if touched:
        table.write(materialise(merge(table.read(spark, touched), batch)))
    return touched
