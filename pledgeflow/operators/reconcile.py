"""Anti-joins, ordered lookups and other ways to find what is missing or different."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``.

    A rank filter of 1 lets Spark cut every map task to one row per key before
    the shuffle (WindowGroupLimit), so a hot key does not travel.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def missing(df: DataFrame, known: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows of ``df`` whose key is absent from ``known``; ``on`` maps df key -> known key."""
    right = known.select(*[F.col(k).alias(f"__{i}") for i, k in enumerate(on.values())])
    cond = [df[left] == F.col(f"__{i}") for i, left in enumerate(on)]
    return df.join(right, cond, "left_anti")


def present(df: DataFrame, known: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``known`` (each row once)."""
    right = known.select(*[F.col(k).alias(f"__{i}") for i, k in enumerate(on.values())])
    cond = [df[left] == F.col(f"__{i}") for i, left in enumerate(on)]
    return df.join(right, cond, "left_semi")


def first_url_per_id(df: DataFrame, id_column: str, url: str) -> DataFrame:
    """Work list: one representative url (the smallest) per id."""
    return df.groupBy(id_column).agg(F.min(url).alias(url))


def child_summary(children: DataFrame, parent: str, child_id: str) -> DataFrame:
    """Per parent: number of children and the highest child id."""
    return children.groupBy(parent).agg(
        F.count(F.lit(1)).alias("stored_count"), F.max(child_id).alias("last_child_id")
    )


def count_mismatch(
    parents: DataFrame,
    children: DataFrame,
    parent_id: str,
    declared: str,
    deleted: str,
    child_parent: str,
    child_id: str,
) -> DataFrame:
    """Parents whose declared child count (less known deletions) differs from what is stored.

    Carries the last stored child id as the cursor to resume from (0 when none).
    """
    stored = child_summary(children, child_parent, child_id).withColumnRenamed(child_parent, parent_id)
    expected = F.col(declared) - F.coalesce(F.col(deleted), F.lit(0))
    return (
        parents.join(stored, parent_id, "left")
        .withColumn("stored_count", F.coalesce("stored_count", F.lit(0)))
        .withColumn("last_child_id", F.coalesce("last_child_id", F.lit(0)))
        .withColumn("expected_count", expected)
        .filter((F.col("expected_count") > 0) & (F.col("expected_count") != F.col("stored_count")))
    )


def latest_child(parents: DataFrame, children: DataFrame, key: str, child_key: str, child_id: str) -> DataFrame:
    """Every parent with its highest child id, NULL when it has none."""
    newest = children.groupBy(F.col(child_key).alias(key)).agg(F.max(child_id).alias("latest_child_id"))
    return parents.join(newest, key, "left")


def child_counts(
    parents: DataFrame, counted: Sequence[tuple[DataFrame, str, str, int]], key: str
) -> DataFrame:
    """Add one count column per ``(children, child key, name, default)``."""

    def attach(df: DataFrame, item) -> DataFrame:
        children, child_key, name, default = item
        counts = children.groupBy(F.col(child_key).alias(key)).agg(F.count(F.lit(1)).alias(name))
        return df.join(counts, key, "left").withColumn(name, F.coalesce(F.col(name), F.lit(default)))

    return reduce(attach, counted, parents)


def ordered_lookup(requests: DataFrame, store: DataFrame, key: str, position: str) -> DataFrame:
    """Look every requested key up, keep the caller's order, NULL where nothing is stored."""
    return requests.join(store, key, "left").orderBy(position)


def first_match_merge(
    primary: DataFrame, secondary: DataFrame, key: str, order: Sequence[Column]
) -> DataFrame:
    """Join each primary row to the first secondary row of its key; unmatched rows go.

    Shared columns take the primary value unless it is NULL.
    """
    first = first_per_key(secondary, [key], order)
    shared = [c for c in primary.columns if c in first.columns and c != key]
    extra = [c for c in first.columns if c not in primary.columns]
    p, s = primary.alias("p"), first.alias("s")
    columns = [F.col(f"p.{key}")]
    for c in primary.columns:
        if c == key:
            continue
        columns.append(F.coalesce(F.col(f"p.{c}"), F.col(f"s.{c}")).alias(c) if c in shared else F.col(f"p.{c}"))
    columns += [F.col(f"s.{c}") for c in extra]
    return p.join(s, F.col(f"p.{key}") == F.col(f"s.{key}"), "inner").select(*columns)


def with_placeholders(keys: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """One row per distinct requested key; keys not found keep NULL details."""
    return keys.select(key).distinct().join(found, key, "left")


def union_lookup(requests: DataFrame, tables: dict[str, DataFrame], key: str) -> DataFrame:
    """Requested keys found in any of several entity tables, tagged by the table."""
    tagged = [df.withColumn("entity", F.lit(name)) for name, df in tables.items()]
    return requests.join(reduce(DataFrame.unionByName, tagged), key, "inner")


def in_both_categories(df: DataFrame, key: str, category: str, first: str, second: str) -> DataFrame:
    """Keys listed under two categories, by one grouping instead of a self-join."""
    return (
        df.filter(F.col(category).isin(first, second))
        .groupBy(key)
        .agg(
            F.max(F.col(category) == first).alias("__a"),
            F.max(F.col(category) == second).alias("__b"),
        )
        .filter(F.col("__a") & F.col("__b"))
        .select(key)
    )


def table_count_diff(left: dict[str, DataFrame], right: dict[str, DataFrame]) -> DataFrame:
    """Row counts of same-named tables in two schemas, only where they differ."""

    def counts(tables: dict[str, DataFrame], name: str) -> DataFrame:
        parts = [
            df.agg(F.count(F.lit(1)).alias(name)).select(F.lit(table).alias("table_name"), name)
            for table, df in sorted(tables.items())
        ]
        return reduce(DataFrame.unionByName, parts)

    return (
        counts(left, "left_count")
        .join(counts(right, "right_count"), "table_name", "full")
        .filter(~F.col("left_count").eqNullSafe(F.col("right_count")))
    )


def except_ids(df: DataFrame, known: DataFrame, key: str, known_key: str) -> DataFrame:
    """Full rows whose id is not in the known set."""
    return missing(df, known, {key: known_key})


def union_distinct(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames).distinct()


def parameter_grid(roots: DataFrame, **sizes: int) -> DataFrame:
    """Every root with every combination of small parameter ranges 0..n-1."""
    for name, size in sizes.items():
        values = F.explode(F.sequence(F.lit(0), F.lit(size - 1)))
        roots = roots.select("*", values.alias(name))
    return roots
