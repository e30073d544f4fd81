"""Two-pass external shuffle into numbered shards, in DataFrame operations only.

Pass one scatters whole records into buckets small enough for one task's memory, by a seeded
hash. Pass two lays each bucket out as one array, permutes it with Spark's seeded Fisher-Yates
``shuffle`` and writes it. Buckets follow each other, so a record's global position is its
bucket's offset plus its place in the bucket; shards are equal runs of positions. A reduce
partition holds a run of buckets, sorted by bucket, and lays them out one after the other, so
neither the partitions of the shuffle nor a task's memory grow with the number of buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pledgeflow.session import materialise, work_path

# hash cells of which buckets are runs; bounds the table of offsets that is broadcast
CELLS = 1 << 20
# most reduce partitions of the scatter
PARTITIONS = 1 << 14
_BY_HASH = "spark.sql.execution.useObjectHashAggregateExec"


@contextmanager
def groups_in_order(spark: SparkSession) -> Iterator[None]:
    """Plans made inside collect sorted groups one at a time; a hash table would hold many of them."""
    before = spark.conf.get(_BY_HASH)
    spark.conf.set(_BY_HASH, "false")
    try:
        yield
    finally:
        spark.conf.set(_BY_HASH, before)


def byte_size(text: Column) -> Column:
    """UTF-8 bytes of a text, none for null, plus one."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def file_row() -> Column:
    """Identity of a scanned row: row numbers start again in every file."""
    return F.xxhash64("_metadata.file_path", "_metadata.row_index")


def shuffled_shards(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    shards: int = 16,
    seed: int = 20,
    bucket_bytes: int = 16 << 20,
    row_id: Column | None = None,
    path: str | None = None,
    partitions: int = PARTITIONS,
) -> DataFrame:
    """Write every record to a uniformly random place and read the shards back.

    Returns ``shard`` (0 to shards - 1), ``slot`` (gapless from 0 within the shard) and
    ``record``, a struct of all columns of ``df``, so that no column name can clash. Shards
    differ by one row at most. The same seed, files and row ids give the same placement.

    Null keys and texts are hashed like any value; an empty table gives no rows; with fewer
    rows than shards some shards are empty. Rows equal in key and text are kept apart by
    ``row_id`` (``file_row()`` for a file scan); without it all copies of one row
    share a bucket. A record larger than ``bucket_bytes`` makes its bucket as large as itself.
    At most ``partitions`` tasks take the buckets, each a run of them.
    """
    spark = df.sparkSession
    salt = F.lit(0).cast("long") if row_id is None else row_id
    hashed = F.xxhash64(F.lit(seed), F.col(key), F.col(text), salt)
    keyed = df.select(
        F.struct("*").alias("record"),
        F.shiftrightunsigned(hashed, 44).alias("cell"),
        hashed.alias("order"),
        byte_size(F.col(text)).alias("bytes"),
    )
    cells = materialise(keyed.groupBy("cell").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")))
    rows, size = cells.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    buckets = min(CELLS, max(1, -(-size // bucket_bytes)))
    bucket = F.floor(F.col("cell") * buckets / CELLS).cast("int")
    parts = min(buckets, partitions)
    run = F.floor(F.col("bucket").cast("long") * parts / buckets).cast("int")
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cells.groupBy(bucket.alias("bucket"))
        .agg(F.sum("n").alias("n"))
        .select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    scattered = (
        keyed.select(bucket.alias("bucket"), "order", "record")
        .withColumn("run", run)
        .repartitionById(parts, F.col("run"))
        .sortWithinPartitions("run", "bucket", "order")
    )
    permuted = (
        scattered.groupBy("run", "bucket")
        .agg(F.collect_list("record").alias("records"))
        .select("bucket", F.posexplode(F.shuffle("records", seed)).alias("place", "record"))
        .join(F.broadcast(offsets), "bucket")
        .select((F.col("offset") + F.col("place")).alias("position"), "record")
    )
    total = F.lit(max(rows, 1)).cast("long")
    shard = F.expr(f"position * {shards} div {max(rows, 1)}")
    first = F.ceil(shard * total / shards)
    placed = permuted.select((F.col("position") - first).cast("long").alias("slot"), "record", shard.cast("int").alias("shard"))
    target = path or work_path(spark, "shards")
    with groups_in_order(spark):
        placed.write.partitionBy("shard").parquet(target)
    schema = placed.schema
    return spark.read.schema(schema).parquet(target).select("shard", "slot", "record")
