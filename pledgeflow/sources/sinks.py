"""Table and file outputs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pledgeflow.session import work_path


def write_version(df: DataFrame, base: str, version: str, *partitions: str) -> str:
    """Write a new version folder; the version being read stays untouched."""
    path = f"{base.rstrip('/')}/version={version}"
    df.write.mode("errorifexists").partitionBy(*partitions).parquet(path)
    return path


def write_csv_tables(tables: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    """One CSV folder with header per table."""
    paths = {name: f"{folder.rstrip('/')}/{name}" for name in tables}
    for name, df in tables.items():
        df.write.mode("overwrite").option("header", True).option("escape", '"').csv(paths[name])
    return paths


def write_chunked(df: DataFrame, folder: str, rows_per_file: int = 500_000) -> None:
    """CSV files of at most ``rows_per_file`` rows each."""
    df.write.mode("overwrite").option("header", True).option("maxRecordsPerFile", rows_per_file).csv(folder)


def write_partitioned_json(df: DataFrame, folder: str, *partitions: str) -> DataFrame:
    """JSON files in one folder per partition value; returns the manifest of folders."""
    df.write.mode("overwrite").partitionBy(*partitions).json(folder)
    parts = [F.concat(F.lit(f"{p}="), F.col(p).cast("string")) for p in partitions]
    return df.select(*partitions, F.concat_ws("/", *parts).alias("path")).distinct()


def replace_table(df: DataFrame, name: str, index: Sequence[str] = (), buckets: int = 64) -> None:
    """Replace a catalog table; index columns become its bucketing, so joins on them need no shuffle."""
    writer = df.write.mode("overwrite").option("path", work_path(df.sparkSession, name))
    if index:
        writer = writer.bucketBy(buckets, *index).sortBy(*index)
    writer.saveAsTable(name)
