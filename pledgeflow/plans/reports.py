"""Descriptive, quarterly and funding-curve reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pledgeflow.functions.numbers import pretty_number, to_precision
from pledgeflow.functions.text import label, or_none
from pledgeflow.operators import aggregates, curves, filters, money, quantiles
from pledgeflow.operators.scale import choose_scale, scaled_label
from pledgeflow.session import materialise

_STATS = ("mean", "median", "min", "max", "std_dev", "sum")


class Variable(NamedTuple):
    """A column to describe; with ``currency`` (a column name) it is converted to USD first."""

    name: str
    column: str
    units: str | None = None
    currency: str | None = None
    date: str | None = None


def converted(df: DataFrame, variables: Sequence[Variable], rates: DataFrame | None) -> DataFrame:
    """Money columns in USD, all that share currency and date columns by one lookup."""
    groups: dict[tuple[str, str | None], list[str]] = {}
    for v in variables:
        if v.currency:
            groups.setdefault((v.currency, v.date), []).append(v.column)
    for (currency, date), columns in groups.items():
        df = money.to_usd(df, columns, currency, rates, date)
    return df


def _long_stats(df: DataFrame, variables: Sequence[Variable], rates: DataFrame | None) -> DataFrame:
    usd = converted(df, variables, rates).select(*[F.col(v.column).alias(v.name) for v in variables])
    # a row per variable, used twice by the choice of scale: compute it once
    described = materialise(quantiles.describe_wide(usd, [v.name for v in variables]))
    return described.unpivot(["variable"], list(_STATS), "stat", "value")


def _wide(long: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    columns = [F.max(F.when(F.col("stat") == s, F.col(text))).alias(s) for s in _STATS]
    return long.groupBy(*keys).agg(*columns)


def describe_report(df: DataFrame, variables: Sequence[Variable], rates: DataFrame | None = None) -> DataFrame:
    """One printed row per variable, scaled to its most readable unit, in label order."""
    scaled = choose_scale(_long_stats(df, variables, rates), ["variable"])
    units = F.lit(None).cast("string")
    for v in variables:
        units = F.when(F.col("variable") == v.name, F.lit(v.units).cast("string")).otherwise(units)
    labelled = scaled.withColumn("label", scaled_label(F.col("variable"), F.col("unit"), units))
    return _wide(labelled, ["label"], "text").orderBy("label")


def describe_words(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Descriptive statistics printed with word prefixes, one row per labelled column."""
    long = _long_stats(df, [Variable(c, c) for c in columns], None)
    worded = long.withColumns({"text": pretty_number(F.col("value")), "label": label(F.col("variable"))})
    return _wide(worded, ["label"], "text").orderBy("label")


def describe_digits(df: DataFrame, columns: Sequence[str], digits: int = 3) -> DataFrame:
    """Count, mean, population deviation, min and max printed to some significant digits."""
    stats = quantiles.column_stats(df, columns, digits=12)
    printed = [to_precision(F.col(c).cast("double"), digits).alias(c) for c in ("n", "mean", "sd", "min", "max")]
    return stats.select("variable", *printed)


def quarterly_report(
    projects: DataFrame,
    date: str,
    as_of: str | None,
    sums: Sequence[str],
    amount: str,
    currency: str,
    rates: DataFrame,
    category: Column | None = None,
) -> dict[str, DataFrame]:
    """The tables behind the quarterly charts, without the quarter still running.

    The facts are read once, into a row per day with what all charts need (:func:`aggregates.daily_moments`);
    the charts are rolled up from those rows.
    """
    done = filters.finished_quarters(projects, date, as_of)
    if category is not None:
        done = done.filter(category)
    usd = money.to_usd(done.withColumn("__usd", F.col(amount)), ["__usd"], currency, rates, date)
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in sums])
    measures = {c: F.when(whole, F.col(c)) for c in sums} | {"__usd": F.col("__usd"), "__first": F.col(sums[0])}
    counts = {"__split": whole, "__amounts": F.col(amount).isNotNull()}
    daily = materialise(aggregates.daily_moments(usd, date, measures, counts))
    quarters = aggregates.quarterly_moments(daily, list(measures), list(counts))
    spread = {c: F.col(f"{c}_sum") for c in sums} | {f"{c}_std": F.col(f"{c}_std") for c in sums}

    def named(rows: DataFrame, **columns: Column) -> DataFrame:
        return rows.select("quarter", *[value.alias(name) for name, value in columns.items()])

    return {
        "split": named(quarters.filter("__split > 0"), **spread),
        "amount": named(quarters.filter("__amounts > 0"), total=F.col("__usd_sum"), mean=F.col("__usd_mean")),
        "first_measure": named(quarters, mean=F.col("__first_mean"), total=F.col("__first_sum")),
        "projects": named(quarters, count=F.col("n")),
        "daily": daily.select("day", "n").orderBy("day"),
    }


def funding_curve_report(
    trend: DataFrame, projects: DataFrame, rates: DataFrame, status: str = "successful", min_points: int = 4
) -> DataFrame:
    """Median funding by day since launch over all projects of one status.

    ``trend(projectid, added, amount_pledged, update_count, comment_count, backer_count)``,
    ``projects(id, status, start_date, currency, goal)``.
    """
    counts = ["update_count", "comment_count", "backer_count"]
    # one row per project and date first, so a heavily observed project is cut down before the join
    dated = trend.withColumn("date", F.to_date("added"))
    order = ["added", "amount_pledged", *counts]
    latest = curves.latest_per_day(dated, "projectid", "date", order, ["amount_pledged", *counts])
    chosen = projects.filter(F.col("status") == status).select("id", "start_date", "currency", "goal")
    joined = latest.join(chosen, latest["projectid"] == chosen["id"])
    usd = money.to_usd(joined, ["amount_pledged", "goal"], "currency", rates)
    amounts = ["amount_pledged", "percent_of_goal"]
    daily = usd.withColumns(
        {
            "day": F.datediff("date", F.to_date("start_date")),
            "percent_of_goal": money.percent_of_goal(F.col("amount_pledged"), F.col("goal")),
        }
    )
    filled = curves.interpolate_daily(daily, "projectid", "day", amounts, counts, min_points)
    return curves.funding_curve(filled, "day", [*amounts, *counts])


def analyst_export(
    projects: DataFrame, rewards: DataFrame, key: str, reward_key: str, columns: Sequence[str]
) -> DataFrame:
    """Flat text export with the number of rewards; whatever is missing reads ``none``."""
    counts = rewards.groupBy(F.col(reward_key).alias(key)).agg(F.count(F.lit(1)).alias("num_perks"))
    joined = projects.join(counts, key, "left")
    return joined.select(*[or_none(F.col(c)).alias(c) for c in (*columns, "num_perks")])
