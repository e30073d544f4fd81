"""Date and time expressions. Timestamps are zone-less and mean UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(as_of: str | None) -> Column:
    """The reference point of 'now' comparisons: a fixed text or the current time."""
    return F.localtimestamp() if as_of is None else F.to_timestamp_ntz(F.lit(as_of))


def quarter_label(date: Column) -> Column:
    """2015Q2"""
    return F.concat(F.year(date).cast("string"), F.lit("Q"), F.quarter(date).cast("string"))


def quarter_start(date: Column) -> Column:
    return F.trunc(F.to_date(date), "quarter")


def in_quarter_of(date: Column, as_of: str | None) -> Column:
    """Whether a date lies in the quarter of ``as_of``, as a range so scans can prune."""
    first = quarter_start(moment(as_of)).cast("timestamp_ntz")
    after = F.add_months(quarter_start(moment(as_of)), 3).cast("timestamp_ntz")
    return (date >= first) & (date < after)


def duration_days(start: Column, end: Column) -> Column:
    return F.datediff(F.to_date(end), F.to_date(start))


def iso_timestamp(text: Column) -> Column:
    """ISO text with or without a trailing Z; anything else becomes NULL."""
    bare = F.regexp_replace(F.trim(text), "Z$", "")
    return bare.try_cast("timestamp_ntz")


def iso_date(text: Column) -> Column:
    """Date part of an ISO datetime text."""
    return F.split_part(text, F.lit("T"), F.lit(1)).try_cast("date")


def long_date(text: Column) -> Column:
    """``Jun 05, 2015``, falling back to forms that carry a time or are ISO."""
    clean = F.trim(text)
    return F.coalesce(
        F.to_date(F.try_to_timestamp(clean, F.lit("MMM d, yyyy"))),
        F.to_date(F.try_to_timestamp(clean, F.lit("MMM d, yyyy H:mm"))),
        F.to_date(F.try_to_timestamp(clean, F.lit("MMM d, yyyy h:mm a"))),
        F.substring(clean, 1, 10).try_cast("date"),
    )


def slash_date(text: Column) -> Column:
    """``6/5/2015`` (month first); empty text is NULL."""
    return F.to_date(F.try_to_timestamp(F.nullif(F.trim(text), F.lit("")), F.lit("M/d/yyyy")))


def from_unix(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")


def to_unix(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def valid_lastmod(text: Column) -> Column:
    """A modification date must start with 1 or 2, else it is no date."""
    clean = F.trim(text)
    return F.when(F.substring(clean, 1, 1).isin("1", "2"), clean)
