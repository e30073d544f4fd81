"""Name -> callable and name -> oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Lazy access to the parquet tables of one scale factor: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, oracle: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(Tables(spark, folder))

        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register
