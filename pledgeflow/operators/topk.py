"""Top-k, skip-k and take-until reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def newest(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The single newest row."""
    return df.orderBy(*order).limit(1)


def kth_newest(df: DataFrame, order: Sequence[Column], skip: int) -> DataFrame:
    """The row after skipping ``skip`` newest ones; empty when there are too few."""
    return df.orderBy(*order).offset(skip).limit(1)


def page(df: DataFrame, order: Sequence[Column], offset: int, limit: int) -> DataFrame:
    """One page of a total order."""
    return df.orderBy(*order).offset(offset).limit(limit)


def after_key(df: DataFrame, key: str, last: int, limit: int) -> DataFrame:
    """The next page by key range, which prunes instead of sorting what was skipped."""
    return df.filter(F.col(key) > last).orderBy(key).limit(limit)


def take_until(df: DataFrame, page_column: str, hit: Column) -> DataFrame:
    """Pages up to and including the first that holds a hit; every page when none does."""
    stop = df.filter(hit).agg(F.min(page_column)).scalar()
    return df.filter((F.col(page_column) <= stop) | stop.isNull())


def shuffled(df: DataFrame, key: str, seed: int) -> DataFrame:
    """A repeatable random order."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key)
