"""Currency conversion with dated rates."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pledgeflow.session import sized


# a rate row is some 40 bytes; every currency and day on record stays far below this
_MAX_BROADCAST_RATES = 2_000_000


class Rates(NamedTuple):
    """Rates written once, and whether their counted size allows a broadcast."""

    table: DataFrame
    small: bool


def prepared_rates(rates: DataFrame) -> Rates:
    """One rate per currency and day, the highest of repeated ones; reusable in many conversions."""
    unique = rates.groupBy("currency", "rate_date").agg(F.max("usd_rate").alias("usd_rate"))
    return Rates(*sized(unique, _MAX_BROADCAST_RATES))


def latest_rates(rates: DataFrame) -> DataFrame:
    return rates.groupBy("currency").agg(F.max_by("usd_rate", "rate_date").alias("__latest"))


def to_usd(
    df: DataFrame,
    amounts: list[str],
    currency: str,
    rates: DataFrame | Rates,
    date: str | None = None,
    suffix: str = "",
) -> DataFrame:
    """Convert amount columns with ``rates(currency, rate_date, usd_rate)``, prepared or not.

    The rate of the row's date applies; where that day has none, or no date column is
    given, the currency's latest. NULL amounts stay NULL.

    A handful of currencies hold most rows, so the fact side must not be shuffled by
    currency: the rates are materialised, counted, and broadcast. Only a rate table
    beyond the limit is joined by shuffle, where AQE splits the hot currencies.
    """
    kept, small = rates if isinstance(rates, Rates) else prepared_rates(rates)

    def side(lookup: DataFrame) -> DataFrame:
        return F.broadcast(lookup) if small else lookup

    latest = side(latest_rates(kept).withColumnRenamed("currency", "__cur"))
    joined = df.join(latest, F.col(currency) == F.col("__cur"), "left").drop("__cur")
    rate = F.col("__latest")
    if date is not None:
        dated = kept.select(
            F.col("currency").alias("__cur"),
            F.col("rate_date").alias("__day"),
            F.col("usd_rate").alias("__dated"),
        )
        on_day = (F.col(currency) == F.col("__cur")) & (F.to_date(date) == F.col("__day"))
        joined = joined.join(side(dated), on_day, "left").drop("__cur", "__day")
        rate = F.coalesce("__dated", "__latest")
    converted = {f"{a}{suffix}": F.col(a) * rate for a in amounts}
    return joined.withColumns(converted).drop("__latest", "__dated")


def percent_of_goal(amount: Column, goal: Column) -> Column:
    """Percent raised; NULL for a goal of zero."""
    return F.try_divide(amount, goal) * 100
