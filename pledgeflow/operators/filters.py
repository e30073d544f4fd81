"""Row filters whose predicates reach the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pledgeflow.functions.dates import in_quarter_of, moment


def open_and_stale(
    df: DataFrame, status: str, statuses: Sequence[str], seen: str, as_of: str | None, hours: int = 12
) -> DataFrame:
    """Rows still open that were last seen more than ``hours`` ago."""
    limit = moment(as_of) - F.make_interval(hours=F.lit(hours))
    return df.filter(F.col(status).isin(*statuses) & (F.col(seen) < limit.cast("timestamp_ntz")))


def finished_quarters(df: DataFrame, date: str, as_of: str | None) -> DataFrame:
    """Drop the quarter still running at ``as_of`` and rows without a date."""
    return df.filter(F.col(date).isNotNull() & ~in_quarter_of(F.col(date), as_of))


def between_dates(df: DataFrame, date: str, start: str, end: str) -> DataFrame:
    """Inclusive on both sides, compared as dates."""
    first = F.lit(start).cast("date").cast("timestamp_ntz")
    after = F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz")
    return df.filter((F.col(date) >= first) & (F.col(date) < after))


def newer_than_stored(df: DataFrame, time: str, stored: DataFrame, stored_time: str) -> DataFrame:
    """High watermark: rows later than the latest stored one; all rows when none is stored."""
    mark = stored.agg(F.max(stored_time)).scalar()
    return df.filter(mark.isNull() | (F.col(time) > mark))


def needs_refresh(listed: DataFrame, fetched: DataFrame, key: str, modified: str, fetched_at: str) -> DataFrame:
    """Listed pages never fetched, modified since, or dated while our copy is undated."""
    have = fetched.select(F.col(key), F.col(fetched_at).alias("__at"), F.lit(True).alias("__have"))
    joined = listed.join(have, key, "left")
    stale = (
        F.col("__have").isNull()
        | (F.col(modified) > F.col("__at"))
        | (F.col("__at").isNull() & F.col(modified).isNotNull())
    )
    return joined.filter(F.coalesce(stale, F.lit(False))).drop("__at", "__have")


def flat_path(url: Column) -> Column:
    """Segment 4 equals segment 6, or there is no segment 6."""
    fourth = F.split_part(url, F.lit("/"), F.lit(4))
    sixth = F.split_part(url, F.lit("/"), F.lit(6))
    return (fourth == sixth) | (sixth == "")


def holds(array: Column, value) -> Column:
    return F.array_contains(array, value)


def only_holds(array: Column, value) -> Column:
    """Every element equals ``value`` (true for an empty array)."""
    return F.forall(array, lambda x: x == value)


def mask_dropna(df: DataFrame, keep: Column) -> DataFrame:
    """Rows that pass ``keep`` and have no NULL in any column."""
    return df.filter(keep).dropna("any")


def like_escaped(column: str, pattern: str) -> Column:
    """LIKE with ``/`` as the escape character."""
    return F.like(F.col(column), F.lit(pattern), F.lit("/"))


def safe_url(url: Column, host_pattern: str) -> Column:
    """A host matched whole, then only letters, digits and ``-/_.``, without two dots in a row."""
    shape = f"(?i)\\A{host_pattern}[-a-z0-9/_.]*\\z"
    return url.rlike(shape) & ~F.contains(url, F.lit(".."))
