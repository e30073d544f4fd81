"""Exact grouped quantiles by selection instead of collecting a group's values.

One scan sketches every group (KLL, combined map-side) and takes its moments. The sketch bounds
each wanted rank by two values; a second scan counts what lies below and between them exactly and
ranks the distinct values in between. Where bounds still hold too many rows for one task, a scan
sketches them again, which leaves a share of them that does not depend on how values lie. Counts
are exact in every scan, so a bound that missed its rank is seen and replaced. No task ever holds
a whole group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pledgeflow.session import materialise

# items a sketch keeps on its lowest level; groups up to this size are sketched exactly
SKETCH_K = 4096
# equal shares of a group at which its sketch is asked
SHARES = 512
# rows between two bounds that one task may rank
RANKED_ROWS = 200_000
# groups whose bounds may be broadcast
MAX_BROADCAST = 200_000


def _slack() -> float:
    """Twice the rank error that a KLL sketch of this size keeps in 99 of 100 cases, as a share of the rows."""
    return 2 * 2.296 / SKETCH_K**0.9021


def _number(value: str | Column) -> Column:
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    return F.when(~F.isnan(v), v)


def _rows_of(df: DataFrame, by: Sequence[str], value: str) -> tuple[DataFrame, list[str]]:
    """Group keys and the value as ``__v``, without NULL and NaN."""
    keys = list(by) or ["__all"]
    rows = df if by else df.withColumn("__all", F.lit(0))
    return rows.select(*keys, _number(value).alias("__v")).filter(F.col("__v").isNotNull()), keys


def _first_look(v: Column) -> dict[str, Column]:
    """What the first scan takes of a group: bounds and sketch for the ranks, and the moments."""
    return {
        "__n": F.count(v),
        "__lo": F.min(v),
        "__hi": F.max(v),
        "__sketch": F.kll_sketch_agg_double(v, F.lit(SKETCH_K)),
        "sum": F.sum(v),
        "mean": F.avg(v),
        "sd_pop": F.stddev_pop(v),
        "sd_samp": F.stddev_samp(v),
    }


def summarised(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per group with count, bounds, moments and sketch."""
    return materialise(rows.groupBy(*keys).agg(*[c.alias(name) for name, c in _first_look(F.col("__v")).items()]))


def _wanted(total: Column, points: Sequence[float]) -> Column:
    position = [F.lit(float(p)) * (total - 1) for p in points]
    return F.array_distinct(F.array(*[f(x).cast("long") for x in position for f in (F.floor, F.ceil)]))


def _located(parts: DataFrame, keys: list[str], points: Sequence[float]) -> DataFrame:
    """The parts of each group, disjoint ranges of values, that hold a wanted rank."""
    group = Window.partitionBy(*keys)
    before = group.orderBy("__lo").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.withColumns(
        {"__total": F.sum("__n").over(group), "__below": F.coalesce(F.sum("__n").over(before), F.lit(0))}
    )
    held = F.filter(
        _wanted(F.col("__total"), points),
        lambda r: (r >= F.col("__below")) & (r < F.col("__below") + F.col("__n")),
    )
    return placed.withColumn("__ranks", held).filter(F.size("__ranks") > 0)


def _cuts(located: DataFrame, keys: list[str]) -> DataFrame:
    """Per group the bounds of its wanted ranks, ``__cuts``: ascending, overlapping ones joined."""
    share = F.lit(SHARES) / F.col("__n")
    slack = F.when(F.col("__n") > SKETCH_K, F.lit(SHARES * _slack())).otherwise(F.lit(0.0))
    # a sketch answers fixed shares only
    asked = F.expr("array(" + ", ".join(f"{i / SHARES}D" for i in range(SHARES + 1)) + ")")

    def bound(place: Column) -> Column:
        return F.get("__grid", F.least(F.lit(SHARES), F.greatest(F.lit(0), place)).cast("int"))

    def bounds(rank: Column) -> Column:
        middle = (rank - F.col("__below") + 0.5) * share
        return F.struct(bound(F.floor(middle - slack)).alias("lo"), bound(F.ceil(middle + slack)).alias("hi"))

    one = F.array(F.struct(F.col("__lo").alias("lo"), F.col("__hi").alias("hi")))
    known = (F.col("__lo") == F.col("__hi")) | F.col("__sketch").isNull()
    grids = located.withColumn("__grid", F.when(~known, F.kll_sketch_get_quantile_double("__sketch", asked)))
    found = grids.select(*keys, F.when(known, one).otherwise(F.transform("__ranks", bounds)).alias("cut"))
    cuts = found.groupBy(*keys).agg(F.array_sort(F.flatten(F.collect_list("cut"))).alias("__cuts"))

    def joined(done: Column, cut: Column) -> Column:
        last = F.element_at(done, -1)
        wider = F.struct(last["lo"].alias("lo"), F.greatest(last["hi"], cut["hi"]).alias("hi"))
        # the first cut meets itself
        apart = F.concat(done, F.array(cut))
        return F.when(last["hi"] < cut["lo"], apart).otherwise(F.concat(F.slice(done, 1, F.size(done) - 1), F.array(wider)))

    return cuts.withColumn("__cuts", F.aggregate("__cuts", F.slice("__cuts", 1, 1), joined))


def _counted(rows: DataFrame, keys: list[str], cuts: DataFrame, small: bool, ranked: bool) -> DataFrame:
    """Scan the rows: exact counts of the parts into which the cuts split each group.

    Parts are the gaps around the cuts and, inside, every distinct value (``ranked``) or the two
    ends and what is between them, sketched again.
    """
    v = F.col("__v")
    if ranked and not small:  # many groups: reduce equal values map-side before they travel to the join
        rows = rows.groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__k"))
    else:
        rows = rows.withColumn("__k", F.lit(1).cast("long"))
    # every value lies in one range: a cut with the gap below it, or the gap above them all
    above = F.struct(F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"))
    ranges = cuts.select(*keys, "__cuts", F.posexplode(F.concat("__cuts", F.array(above))).alias("__passed", "__cut"))
    side = ranges.select(
        *[F.col(k).alias(f"__key_{k}") for k in keys],
        "__passed",
        F.get("__cuts", F.col("__passed") - 1)["hi"].alias("__after"),
        F.col("__cut.lo").alias("__from"),
        F.col("__cut.hi").alias("__to"),
    )
    lo, hi, after = F.col("__from"), F.col("__to"), F.col("__after")
    inside = (after.isNull() | (v > after)) & (hi.isNull() | (v <= hi))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys])
    at = rows.join(F.broadcast(side) if small else side, same & inside)
    part = F.when(lo.isNull() | (v < lo), 0).when(v == lo, 1).when(v == hi, 3).otherwise(2)
    cell = F.when(part > 0, v) if ranked else part
    sketch = F.lit(None).cast("binary") if ranked else F.kll_sketch_agg_double("__v", F.lit(SKETCH_K))
    counts = at.groupBy(*keys, "__passed", cell.alias("__cell")).agg(
        F.sum("__k").alias("__n"), F.min(v).alias("__lo"), F.max(v).alias("__hi"), sketch.alias("__sketch")
    )
    return materialise(counts.drop("__passed", "__cell"))


def _selected(
    rows: DataFrame, keys: list[str], summary: DataFrame, quantiles: Mapping[str, float], floors: Mapping[str, float]
) -> DataFrame:
    points = sorted({*quantiles.values(), *floors.values()})
    parts = summary.filter(F.col("__n") > 0).select(*keys, "__n", "__lo", "__hi", "__sketch")
    open_ = F.col("__lo") < F.col("__hi")
    between = F.when(F.col("__n") > SKETCH_K, 2 * (_slack() + 1 / SHARES) * F.col("__n")).otherwise(0)
    while True:
        located = _located(parts, keys, points)
        left, crowded, groups = located.agg(
            F.coalesce(F.bool_or(open_), F.lit(False)),
            # a part that was not to hold a rank has no sketch yet
            F.coalesce(F.bool_or(open_ & (F.col("__sketch").isNull() | (between > RANKED_ROWS))), F.lit(False)),
            F.count(F.lit(1)),
        ).first()
        if not left:
            break
        parts = _counted(rows, keys, _cuts(located, keys), groups <= MAX_BROADCAST, ranked=not crowded)
    hits = located.select(*keys, "__total", F.col("__lo").alias("__v"), F.explode("__ranks").alias("__rank"))

    def position(p: float) -> Column:
        return F.lit(float(p)) * (F.col("__total") - 1)

    def at(p: float, side) -> Column:
        return F.max(F.when(F.col("__rank") == side(position(p)).cast("long"), F.col("__v")))

    def interpolated(p: float) -> Column:
        low, high = at(p, F.floor), at(p, F.ceil)
        share = F.max(position(p)) - F.max(F.floor(position(p)))
        return low + (high - low) * share

    return hits.groupBy(*keys).agg(
        F.max("__total").alias("n"),
        *[interpolated(p).alias(name) for name, p in quantiles.items()],
        *[at(p, F.floor).alias(name) for name, p in floors.items()],
    )


def group_quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    quantiles: Mapping[str, float],
    floors: Mapping[str, float] | None = None,
) -> DataFrame:
    """Per group: row count ``n``, interpolated quantiles, and for ``floors`` the largest
    value at or below the quantile. NULL and NaN are left out; NULL keys are a group.

    Order statistics follow position ``p * (n - 1)``, interpolated linearly.
    """
    rows, keys = _rows_of(df, by, value)
    result = _selected(rows, keys, summarised(rows, keys), quantiles, floors or {})
    return result if by else result.drop("__all")


def middle_rows_median(df: DataFrame, value: str) -> DataFrame:
    """Median of one column as the mean of the rows numbered ⌊(n+1)/2⌋ and ⌊(n+2)/2⌋."""
    return group_quantiles(df, [], value, {"median_val": 0.5}).select("median_val")


def unpivoted(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(by…, variable, value) with one row per column."""
    return df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        list(by), list(columns), "variable", "value"
    )


def _described(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Moments and median of each column, over non-null values; a column without values keeps its row."""
    names = list(dict.fromkeys(columns))
    looks = [F.struct(*[c.alias(k) for k, c in _first_look(_number(f"`{name}`")).items()]) for name in names]
    # the first scan needs no row per column: all columns are looked at in one aggregate
    whole = df.agg(F.array(*[F.struct(F.lit(n).alias("variable"), x.alias("look")) for n, x in zip(names, looks)]).alias("all"))
    summary = materialise(whole.select(F.inline("all")).select("variable", "look.*"))
    rows, keys = _rows_of(unpivoted(df, [], names), ["variable"], "value")
    medians = _selected(rows, keys, summary, {"median": 0.5}, {}).select("variable", "median")
    moments = summary.select(
        "variable", F.col("__n").alias("n"), "mean", "sum", F.col("__lo").alias("min"), F.col("__hi").alias("max"), "sd_pop", "sd_samp"
    )
    return moments.join(medians, "variable", "left")


def column_stats(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """One row per variable: N, mean, population deviation, median, min, max over non-null values."""
    mean, sd = F.round("mean", digits).alias("mean"), F.round("sd_pop", digits).alias("sd")
    return _described(df, columns).select("variable", "n", mean, sd, "min", "max", "median")


def describe_wide(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per variable: mean, median, min, max, sample deviation and sum."""
    return _described(df, columns).select("variable", "mean", "min", "max", F.col("sd_samp").alias("std_dev"), "sum", "median")


def box_stats(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Box-plot numbers per group: quartiles, mean, and whiskers at the 0th and 90th percentile.

    A whisker ends on a data point, hence the floor of the 90th percentile.
    """
    rows, keys = _rows_of(df, by, value)
    summary = summarised(rows, keys)
    spots = _selected(
        rows, keys, summary, {"q25": 0.25, "q50": 0.5, "q75": 0.75}, {"whisker_low": 0.0, "whisker_high": 0.9}
    )
    means = summary.select(*[F.col(k).alias(f"__key_{k}") for k in keys], "mean")
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys])
    return spots.join(means, same).drop(*[f"__key_{k}" for k in keys])
