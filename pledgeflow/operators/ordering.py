"""Exact running totals, row numbers and buckets over sorted ranges.

Rows are written once with an identity. Their order columns alone are then dealt to ranges of
(group, order, identity), so a group with very many rows, or with very many equal ones, spans
several ranges and small groups share one. Sums per range and group give each range its start;
rows are numbered inside their range only, and what is found joins the written rows by identity.
One form serves every size, type and skew.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pledgeflow.session import materialise


def _hashable(kind: T.DataType) -> bool:
    return not any(name in kind.simpleString() for name in ("map<", "variant"))


def _ranges(df: DataFrame, order: Sequence[str], by: Sequence[str], **added: Column) -> tuple[DataFrame, DataFrame]:
    """``df`` written with an identity ``__row``, and its order columns with the number ``__part`` of their sorted range.

    The second frame has ``by``, ``order`` and the ``added`` columns. Rows equal in ``by`` and ``order`` are told
    apart by a hash of all their columns, equal rows by their identity. NULLs sort first.
    """
    tie = [F.col(f"`{f.name}`") for f in df.schema.fields if _hashable(f.dataType)]
    # written before the ranges: the identity must not change when a lost task is run again
    written = materialise(df.withColumns({**added, "__tie": F.xxhash64(*tie), "__row": F.monotonically_increasing_id()}))
    names = list(dict.fromkeys([*by, *order, *added, "__tie", "__row"]))
    dealt = written.select(*names).repartitionByRange(*by, *order, "__tie", "__row")
    return written, materialise(dealt.withColumn("__part", F.spark_partition_id()))


def _with_result(written: DataFrame, found: DataFrame, columns: Sequence[str], out: Sequence[str]) -> DataFrame:
    """``columns`` of the written rows and those of ``out``, without a join where the order columns are all there is."""
    shown = [f"`{c}`" for c in columns if c not in out]
    if set(columns) <= set(found.columns):
        return found.select(*shown, *out)
    return written.select("__row", *shown).join(found.select("__row", *out), "__row").select(*shown, *out)


def _inside(order: Sequence[str], by: Sequence[str]):
    return Window.partitionBy(*by, "__part").orderBy(*order, "__tie", "__row")


def _with_start(rows: DataFrame, per_range: DataFrame, by: Sequence[str], start: Column, name: str) -> DataFrame:
    """Join to each row what the earlier ranges of its group hand on, NULL in a group's first range.

    Only the group that crosses a range's lower edge is handed something, so there is at most
    one row per range to broadcast, whatever the number of groups.
    """
    carried = per_range.select(*[F.col(c).alias(f"__by_{c}") for c in by], F.col("__part").alias("__at"), start.alias(name))
    carried = carried.filter(F.col(name).isNotNull())
    same = F.col("__part") == F.col("__at")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__by_{c}"))
    return rows.join(F.broadcast(carried), same, "left").drop("__at", *[f"__by_{c}" for c in by])


def running_totals(df: DataFrame, order: Sequence[str], by: Sequence[str], weights: Mapping[str, Column]) -> DataFrame:
    """Sums of several weights over this row and all before it, in one pass; order as in :func:`running_total`."""
    names = {out: f"__w{i}" for i, out in enumerate(weights)}
    written, rows = _ranges(df, order, by, **{names[o]: F.coalesce(w.cast("long"), F.lit(0)) for o, w in weights.items()})
    earlier = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    per_range = rows.groupBy(*by, "__part").agg(*[F.sum(w).alias(f"__n{w}") for w in names.values()])
    before = [F.sum(f"__n{w}").over(earlier) for w in names.values()]
    start = F.when(before[0].isNotNull(), F.struct(*[total.alias(w) for total, w in zip(before, names.values(), strict=True)]))
    started = _with_start(rows, per_range, by, start, "__start")
    inside = _inside(order, by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = {o: F.coalesce(F.col("__start").getField(w), F.lit(0)) + F.sum(w).over(inside) for o, w in names.items()}
    return _with_result(written, started.withColumns(found), df.columns, list(found))


def running_total(
    df: DataFrame, order: Sequence[str], by: Sequence[str] = (), weight: Column | None = None, out: str = "row_number"
) -> DataFrame:
    """Sum of ``weight`` over this row and all before it in ``order``, within ``by``.

    Without a weight this is the row number. Columns of ``order`` may be of any orderable type;
    NULLs come first, ties follow a hash of the row, equal rows any order; NULLs in ``by`` form a group of their own.
    """
    return running_totals(df, order, by, {out: F.lit(1) if weight is None else weight})


def _with_earlier(rows: DataFrame, per_part: DataFrame, by: Sequence[str], parts: Sequence[str], start: Column, name: str) -> DataFrame:
    """Join to each row what the earlier of the given parts of its group hand on, NULL if nothing."""
    names = [*by, *parts]
    carried = per_part.select(*[F.col(c).alias(f"__by_{c}") for c in names], start.alias(name)).filter(F.col(name).isNotNull())
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__by_{c}")) for c in names])
    return rows.join(F.broadcast(carried), same, "left").drop(*[f"__by_{c}" for c in names])


def previous_value(
    df: DataFrame, value: str, order: Sequence[str], by: Sequence[str], out: str, parts: Sequence[str] = ()
) -> DataFrame:
    """The last non-null ``value`` before each row, within ``by``; order as in :func:`running_total`.

    ``parts`` names columns that already cut each group into stretches of the order, ascending with it and of a
    bounded number of rows, as those of a stored file; ``order`` must then be unique within a part, and no rows
    are dealt or written.
    """
    if parts:
        at = F.when(F.col(value).isNotNull(), F.struct(*order))
        per_part = df.groupBy(*by, *parts).agg(F.max_by(value, at).alias("__last"))
        earlier = Window.partitionBy(*by).orderBy(*parts).rowsBetween(Window.unboundedPreceding, -1)
        started = _with_earlier(df, per_part, by, parts, F.last("__last", ignorenulls=True).over(earlier), "__carry")
        inside = Window.partitionBy(*by, *parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        found = F.coalesce(F.last(value, ignorenulls=True).over(inside), F.col("__carry"))
        return started.withColumn(out, found).drop("__carry")
    written, rows = _ranges(df, order, by, __v=F.col(value))
    at = F.when(F.col("__v").isNotNull(), F.struct(*order, "__tie", "__row"))
    per_range = rows.groupBy(*by, "__part").agg(F.max_by("__v", at).alias("__last"))
    earlier = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    started = _with_start(rows, per_range, by, F.last("__last", ignorenulls=True).over(earlier), "__carry")
    within = F.last("__v", ignorenulls=True).over(_inside(order, by).rowsBetween(Window.unboundedPreceding, -1))
    return _with_result(written, started.withColumn(out, F.coalesce(within, F.col("__carry"))), df.columns, [out])


def round_robin(df: DataFrame, key: str, n: int) -> DataFrame:
    """Bucket ``i % n`` by position in key order."""
    numbered = running_total(df, [key], out="__rn")
    return numbered.withColumn("bucket", F.pmod(F.col("__rn") - 1, F.lit(n))).drop("__rn")


def balanced_parts(df: DataFrame, key: str, n: int) -> DataFrame:
    """Contiguous parts whose sizes differ by at most one, remainders spread evenly."""
    total = df.agg(F.count(F.lit(1))).scalar()
    numbered = running_total(df, [key], out="__rn")
    part = F.floor((F.col("__rn") * n - 1) / total)
    return numbered.withColumn("part", part).drop("__rn")


def fixed_chunks(df: DataFrame, key: str, size: int) -> DataFrame:
    """Chunk index with ``size`` rows per chunk, the last one possibly short."""
    numbered = running_total(df, [key], out="__rn")
    return numbered.withColumn("chunk", F.floor((F.col("__rn") - 1) / size)).drop("__rn")


def skip_first(df: DataFrame, key: str, n: int) -> DataFrame:
    """All rows after the first n in the order of a unique key; rows without a key come last and always stay.

    Only the skipped keys are sorted; the rest is filtered by the last of them.
    """
    if n <= 0:
        return df
    last = df.filter(F.col(key).isNotNull()).select(key).orderBy(key).limit(n).agg(F.max(key)).scalar()
    return df.filter(F.col(key).isNull() | (F.col(key) > last))


def _folded(rows: DataFrame, by: Sequence[str], order: Sequence[str], keep: Sequence[str], separator: str) -> DataFrame:
    """One row per group: its first place, the kept columns of that row, its pieces joined and counted."""
    item = F.struct(*order, F.col("__piece").alias("piece"))
    place = F.struct(*order)
    return (
        rows.groupBy(*by)
        .agg(
            F.min(place).alias("first"),
            *[F.min_by(c, place).alias(c) for c in keep],
            F.sort_array(F.collect_list(F.when(F.col("__piece").isNotNull(), item))).alias("__items"),
        )
        .select(
            *by,
            "first",
            *keep,
            F.array_join(F.transform("__items", lambda x: x["piece"]), separator).alias("chain"),
            F.size("__items").cast("long").alias("pieces"),
        )
    )


def _part_segments(
    df: DataFrame,
    by: str,
    order: Sequence[str],
    starts: Column,
    piece: Column,
    keep: Sequence[str],
    separator: str,
    size: int,
    parts: Sequence[str],
) -> DataFrame:
    """The segments of :func:`fold_segments`, a segment ending with its part too."""
    inside = Window.partitionBy(by, *parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = df.withColumns({"__opens": F.coalesce(starts.cast("long"), F.lit(0)), "__piece": piece})
    seen = F.sum(F.col("__piece").isNotNull().cast("long")).over(inside)
    counted = marked.withColumns({"__run": F.sum("__opens").over(inside), "segment": F.floor((seen - 1) / size)})
    # one row per run or part of one: from here on little is left to move
    local = materialise(_folded(counted, [by, *parts, "__run", "segment"], order, keep, separator))
    earlier = Window.partitionBy(by).orderBy(*parts).rowsBetween(Window.unboundedPreceding, -1)
    per_part = local.groupBy(by, *parts).agg(F.max("__run").alias("__runs"))
    started = _with_earlier(local, per_part, [by], parts, F.sum("__runs").over(earlier), "__start")
    run = F.coalesce(F.col("__start"), F.lit(0)) + F.col("__run")
    return started.withColumn("run", run).filter("run > 0").select(by, "run", "first", *keep, "chain", "pieces")


def fold_segments(
    df: DataFrame,
    by: str,
    order: Sequence[str],
    starts: Column,
    piece: Column,
    keep: Sequence[str] = (),
    separator: str = " > ",
    size: int = 1000,
) -> DataFrame:
    """Start a new run at each ``starts`` row and join the pieces of a run into segments of a chain.

    (by, run, segment, first, keep, chain, pieces): a segment has at most ``size`` pieces, so a run of any
    length is folded in bounded memory; ``first`` is the order of its first row and ``keep`` columns come from
    that row. Segments of a run ascend, but need not begin at 0 or be full. Rows before the first
    start are not part of any run.
    """
    marked = df.withColumns({"__opens": starts.cast("int"), "__piece": piece})
    totals = {"run": F.col("__opens"), "__seen": F.col("__piece").isNotNull().cast("int")}
    runs = running_totals(marked, order, [by], totals).filter("run > 0")
    segment = F.floor((F.col("__seen") - 1) / size)
    return _folded(runs.withColumn("segment", segment), [by, "run", "segment"], order, keep, separator)


def fold_runs(
    df: DataFrame,
    by: str,
    order: Sequence[str],
    starts: Column,
    piece: Column,
    keep: Sequence[str] = (),
    separator: str = " > ",
    size: int = 1000,
    parts: Sequence[str] = (),
) -> DataFrame:
    """Runs of :func:`fold_segments` with their whole chain: the segments of a run joined on read.

    A chain is one cell; a reader of runs that may not fit one takes the segments. With ``parts``, as in
    :func:`previous_value`, rows are folded inside their part, and only the segments are numbered and joined.
    """
    if parts:
        segments = _part_segments(df, by, order, starts, piece, keep, separator, size, parts)
    else:
        segments = fold_segments(df, by, order, starts, piece, keep, separator, size)
    held = F.collect_list(F.when(F.col("pieces") > 0, F.struct("first", "chain")))
    return (
        segments.groupBy(by, "run")
        .agg(
            F.min(F.col("first").getField(order[0])).alias("started"),
            *[F.min_by(c, "first").alias(c) for c in keep],
            F.array_join(F.transform(F.sort_array(held), lambda x: x["chain"]), separator).alias("chain"),
            F.sum("pieces").alias("pieces"),
        )
        .select(by, "run", "started", *keep, "chain", "pieces")
    )
