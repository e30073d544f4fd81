"""Session settings, work folders and size checks shared by all jobs."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_session(app: str = "pledgeflow", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs expect; cluster sizes stay with spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's checkpoint dir.

    Only a local session may fall back to a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        if context._jsc.sc().getCheckpointDir().isEmpty():
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return os.path.dirname(current.get().rstrip("/"))
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    own = tempfile.mkdtemp(prefix="pledgeflow-")
    context.setCheckpointDir(own)
    return own


_scopes: list[list[str]] = []


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, removed at the end of a :func:`scratch` around it."""
    path = f"{shared_dir(spark)}/pledgeflow/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store the path names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


@contextmanager
def scratch(spark: SparkSession, *paths: str) -> Iterator[None]:
    """Remove at the end the work paths taken inside, those of :func:`materialise` too; results must be consumed by then.

    ``paths`` are removed with them.
    """
    _scopes.append(list(paths))
    try:
        yield
    finally:
        for path in _scopes.pop():
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def materialise(df: DataFrame, *partition_by: str) -> DataFrame:
    """Compute once into a parquet table below the shared folder and read it back.

    Lost executors then re-read files instead of recomputing, later scans prune columns,
    and the optimizer knows the real size. (A checkpoint would run a map-only plan twice.)
    With ``partition_by`` a filter on those columns reads only the folders it names.
    """
    spark = df.sparkSession
    path = work_path(spark, "kept")
    df.write.partitionBy(*partition_by).parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    return kept.select(*[f"`{c}`" for c in df.columns]) if partition_by else kept


def sized(df: DataFrame, max_rows: int = 200_000) -> tuple[DataFrame, bool]:
    """Materialise a summary table and tell whether its counted size allows a broadcast.

    For narrow tables whose plan-time size estimate is useless because they are
    aggregates of something huge.
    """
    kept = materialise(df)
    return kept, kept.count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = 200_000) -> DataFrame:
    """Broadcast hint up to ``max_rows``; above, a shuffle join with AQE skew handling."""
    kept, small = sized(df, max_rows)
    return F.broadcast(kept) if small else kept


# bytes of stored input that make one task of CPU-heavy work
_SHARE = 4 << 20


def spread(df: DataFrame, *key: str) -> DataFrame:
    """Use every core for CPU-heavy work on an input too small to be split by the scan.

    Measured by the files that are read, not by the optimizer's estimate, which multiplies the sides of a
    join and counts a built text like any other. There are more parts than cores as the input grows, so
    that a part stays small. Inputs of at least one full split per core are returned as they are: large
    tables are never shuffled for this.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return df.repartition(max(cores, -(-size // _SHARE)), *key) if size < split * cores else df
