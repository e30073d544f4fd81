"""One readable unit per variable."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pledgeflow.functions.numbers import four_digits, grouped_text

# fixed values: power of ten and how a variable scaled by it is labelled
SCALES = {0: None, 3: "1000s", 6: "Millions", 9: "Billions"}


def choose_scale(stats: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Pick per key the scale that leaves the fewest awkward numbers, the smaller on ties.

    A number is awkward below 0.1 or from 1000 on. Adds ``unit`` and the printed ``text``.
    """
    options = F.array(
        *[F.struct(F.lit(e).alias("exp"), F.lit(u).cast("string").alias("unit")) for e, u in SCALES.items()]
    )
    scaled = (
        stats.filter(F.col(value).isNotNull())
        .select("*", F.inline(options).alias("exp", "unit"))
        .withColumn("__scaled", F.col(value) / F.pow(F.lit(10.0), F.col("exp").cast("double")))
    )
    shown = four_digits(F.col("__scaled"))["value"]
    awkward = ((shown < 0.1) | (shown >= 1000)).cast("int")
    best = (
        scaled.groupBy(*keys, "exp")
        .agg(F.sum(awkward).alias("__bad"))
        .groupBy(*keys)
        .agg(F.min_by("exp", F.struct("__bad", "exp")).alias("exp"))
    )
    return scaled.join(best, [*keys, "exp"]).withColumn("text", grouped_text(F.col("__scaled"))).drop("__scaled")


def scaled_label(name, unit, units):
    """``Goal``, ``Goal ($)``, ``Goal (Millions)`` or ``Goal (Millions of $)``."""
    inner = (
        F.when(unit.isNull(), units).when(units.isNull(), unit).otherwise(F.concat(unit, F.lit(" of "), units))
    )
    return F.when(inner.isNull(), name).otherwise(F.concat(name, F.lit(" ("), inner, F.lit(")")))
