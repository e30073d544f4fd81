"""Grouped reports. Every aggregate here combines map-side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pledgeflow.functions.dates import quarter_label
from pledgeflow.session import broadcast_if_small

_SIMPLE = {"avg", "count", "max", "min", "stddev_pop", "stddev_samp", "sum"}


def count_per_day(df: DataFrame, date: str) -> DataFrame:
    return df.groupBy(F.to_date(date).alias("day")).agg(F.count(F.lit(1)).alias("n")).orderBy("day")


def by_quarter(df: DataFrame, date: str, **aggregates: Column) -> DataFrame:
    """Named aggregates per quarter label."""
    named = [agg.alias(name) for name, agg in aggregates.items()]
    return df.groupBy(quarter_label(F.col(date)).alias("quarter")).agg(*named)


def daily_moments(df: DataFrame, date: str, measures: Mapping[str, Column], counts: Mapping[str, Column]) -> DataFrame:
    """A row per day: its rows, those that meet each condition of ``counts``, and for each measure the number of
    values, their sum, mean and sum of squared deviations, from which longer spans can be put together."""
    found = [F.count(F.lit(1)).alias("n"), *[F.count_if(test).alias(name) for name, test in counts.items()]]
    for name, value in measures.items():
        number = value.cast("double")
        deviation = F.var_pop(number) * F.count(number)
        found += [F.count(value).alias(f"{name}_n"), F.sum(value).alias(f"{name}_sum"), F.avg(number).alias(f"{name}_mean"), deviation.alias(f"{name}_m2")]
    return df.groupBy(F.to_date(date).alias("day")).agg(*found)


def quarterly_moments(daily: DataFrame, measures: Sequence[str], counts: Sequence[str]) -> DataFrame:
    """Quarters of :func:`daily_moments`: ``n``, the counts, and for each measure its sum, mean and population deviation.

    Squared deviations of a quarter are those inside its days and those of the days' means.
    """
    days = daily.withColumn("quarter", quarter_label(F.col("day")))
    sums = [F.sum(c).alias(c) for c in ("n", *counts)]
    for m in measures:
        sums += [F.sum(f"{m}_n").alias(f"{m}_n"), F.sum(f"{m}_sum").alias(f"{m}_sum")]
        sums += [(F.sum(F.col(f"{m}_mean") * F.col(f"{m}_n")) / F.sum(f"{m}_n")).alias(f"{m}_mean")]
    quarters = days.groupBy("quarter").agg(*sums)
    centres = quarters.select("quarter", *[F.col(f"{m}_mean").alias(f"{m}_centre") for m in measures])
    # a row per quarter: equal null quarters meet too
    joined = days.join(centres.withColumnRenamed("quarter", "__q"), F.col("quarter").eqNullSafe(F.col("__q")))
    spreads = []
    for m in measures:
        between = F.col(f"{m}_n") * F.pow(F.col(f"{m}_mean") - F.col(f"{m}_centre"), 2)
        spreads.append(F.sqrt(F.sum(F.col(f"{m}_m2") + between) / F.sum(f"{m}_n")).alias(f"{m}_std"))
    deviations = joined.groupBy("quarter").agg(*spreads).withColumnRenamed("quarter", "__q")
    return quarters.join(deviations, F.col("quarter").eqNullSafe(F.col("__q"))).drop("__q")


def simple_aggregates(df: DataFrame, columns: Sequence[str], function: str) -> DataFrame:
    """One allowed aggregate over several columns."""
    if function not in _SIMPLE:
        raise ValueError(f"unsupported aggregate {function}")
    apply = getattr(F, function)
    return df.agg(*[apply(c).alias(f"{function}_{c}") for c in columns])


def min_per_key(df: DataFrame, keys: Sequence[str], *columns: str) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.min(c).alias(f"min_{c}") for c in columns])


def max_per_key(df: DataFrame, keys: Sequence[str], *columns: str) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.max(c).alias(f"max_{c}") for c in columns])


def distinct_values(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Sorted array of the distinct non-null values per key.

    Deduplicated before collecting, so an array holds the value domain, not the rows.
    """
    pairs = df.filter(F.col(value).isNotNull()).select(*keys, value).distinct()
    return pairs.groupBy(*keys).agg(F.sort_array(F.collect_list(value)).alias(name))


def find_duplicates(df: DataFrame, value: str, id_column: str) -> DataFrame:
    """Values seen more than once, with their count and first id.

    Groups by a 256-bit digest so long texts are not shuffled; the text is then
    fetched for the first id of each repeated value only.
    """
    digest = F.sha2(F.col(value), 256)
    repeated = (
        df.filter(F.col(value).isNotNull())
        .groupBy(digest.alias("__digest"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(id_column).alias("first_id"))
        .filter("n > 1")
        .select("first_id", "n")
    )
    texts = df.select(F.col(id_column).alias("first_id"), value)
    return texts.join(broadcast_if_small(repeated), "first_id")


def owner_distribution(
    df: DataFrame, owner: str, status: str, won: str, lost: str, cap: int | None = None
) -> DataFrame:
    """How many owners have n projects, and how those projects ended.

    ``cap`` folds everything above it into one bucket ``cap + 1``.
    """
    n = F.count(F.lit(1))
    per_owner = df.groupBy(owner).agg(
        n.alias("projects"),
        F.sum((F.col(status) == won).cast("long")).alias("won"),
        F.sum((F.col(status) == lost).cast("long")).alias("lost"),
        F.sum((~F.col(status).isin(won, lost)).cast("long")).alias("other"),
    )
    bucket = F.col("projects") if cap is None else F.least(F.col("projects"), F.lit(cap + 1))
    return per_owner.groupBy(bucket.alias("projects_by_owner")).agg(
        F.sum("won").alias("num_won"),
        F.sum("lost").alias("num_lost"),
        F.sum("other").alias("num_other"),
        F.try_divide(F.sum("won"), F.sum("projects")).alias("success_rate"),
        F.count(F.lit(1)).alias("num_owners"),
    )


def before_first(df: DataFrame, date: str, reference: DataFrame, reference_date: str) -> DataFrame:
    """Rows earlier than the first reference row."""
    return df.filter(F.col(date) < reference.agg(F.min(reference_date)).scalar())


def unique_elements(df: DataFrame, document: str, element: str) -> DataFrame:
    """Elements that occur in exactly one document.

    min = max replaces a distinct count, so nothing but two ids per element is shuffled.
    """
    return (
        df.groupBy(element)
        .agg(F.min(document).alias(document), F.max(document).alias("__last"))
        .filter(F.col(document) == F.col("__last"))
        .select(document, element)
    )


def last_location(df: DataFrame, key: str, location: str, position: str) -> DataFrame:
    """For each key the location with the highest position."""
    return df.groupBy(key).agg(F.max_by(location, position).alias(location))


def log_histogram_2d(
    df: DataFrame, x: str, y: str, decades: int = 8, per_decade: int = 5
) -> DataFrame:
    """Counts on a log10 grid from 1 to 10**decades; inputs are shifted by one.

    The last edge is inclusive, values outside are dropped.
    """
    last = decades * per_decade

    def edge(i: Column) -> Column:
        return F.pow(F.lit(10.0), i / per_decade)

    def bin_of(value: Column) -> Column:
        # the logarithm may land one bin off next to an edge
        guess = F.floor(F.log10(value) * per_decade)
        fixed = F.when(value < edge(guess), guess - 1).when(value >= edge(guess + 1), guess + 1).otherwise(guess)
        return F.when(value == F.lit(10.0**decades), F.lit(last - 1)).otherwise(fixed)

    shifted = df.select((F.col(x) + 1).alias("x"), (F.col(y) + 1).alias("y")).filter(
        F.col("x").between(1.0, 10.0**decades) & F.col("y").between(1.0, 10.0**decades)
    )
    return shifted.groupBy(
        bin_of(F.col("x")).cast("long").alias("x_bin"), bin_of(F.col("y")).cast("long").alias("y_bin")
    ).agg(F.count(F.lit(1)).alias("n"))
