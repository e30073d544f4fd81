"""Daily interpolation of sparse funding observations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pledgeflow.operators.quantiles import group_quantiles
from pledgeflow.session import materialise


def latest_per_day(
    df: DataFrame, entity: str, day: str, order: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """One row per entity and day (or date), the latest by ``order``.

    Combined map-side, so an entity contributes at most one row per day afterwards.
    """
    last = F.max_by(F.struct(*values), F.struct(*order))
    return (
        df.groupBy(entity, day)
        .agg(last.alias("__last"))
        .select(entity, day, *[F.col(f"__last.{v}").alias(v) for v in values])
    )


def interpolate_daily(
    daily: DataFrame,
    entity: str,
    day: str,
    values: Sequence[str],
    counts: Sequence[str] = (),
    min_points: int = 4,
) -> DataFrame:
    """Every day from 0 to the entity's last observation, linear in between.

    ``daily`` has one row per entity and day; negative days go. Entities start at zero on
    day 0 unless observed then; those with no more than ``min_points`` points are dropped. Columns in ``counts`` are rounded half-even.

    Each observation fills the days since the one before it, so one window per entity
    (over at most one row per day) replaces the join to a calendar.
    """
    in_order = Window.partitionBy(entity).orderBy(day)
    whole = Window.partitionBy(entity)
    columns = [*values, *counts]
    points = F.count(F.lit(1)).over(whole) + (F.min(day).over(whole) > 0).cast("int")
    spans = daily.filter(F.col(day) >= 0).select(
        entity,
        day,
        *columns,
        F.lag(day).over(in_order).alias("__d0"),
        *[F.coalesce(F.lag(c).over(in_order), F.lit(0)).alias(f"__v0_{c}") for c in columns],
        points.alias("__points"),
    ).filter(F.col("__points") > min_points)
    first = F.when(F.col("__d0").isNull(), F.lit(0)).otherwise(F.col("__d0") + 1)
    filled = spans.withColumn("__at", F.explode(F.sequence(first.cast("int"), F.col(day).cast("int"))))
    start = F.coalesce("__d0", F.lit(0))

    def at(c: str) -> Column:
        run = F.try_divide(F.col("__at") - start, F.col(day) - start)
        between = F.col(f"__v0_{c}") + (F.col(c) - F.col(f"__v0_{c}")) * run
        value = F.when(F.col("__at") == F.col(day), F.col(c)).otherwise(between)
        return (F.bround(value) if c in counts else value).alias(c)

    return filled.select(entity, F.col("__at").alias(day), *[at(c) for c in columns])


def funding_curve(filled: DataFrame, day: str, measures: Sequence[str]) -> DataFrame:
    """Exact median of every measure per day, with the number of entities."""
    kept = materialise(filled.select(day, *[F.col(m).cast("double").alias(m) for m in measures]))
    long = kept.unpivot([day], list(measures), "measure", "value")
    medians = group_quantiles(long, [day, "measure"], "value", {"median": 0.5})
    wide = [F.max(F.when(F.col("measure") == m, F.col("median"))).alias(m) for m in measures]
    sizes = kept.groupBy(day).agg(F.count(F.lit(1)).alias("count"))
    return medians.groupBy(day).agg(*wide).join(sizes, day)
