"""Insert, upsert and snapshot semantics on plain parquet tables.

Results are new frames: write them to a new version folder (see sources.sinks),
never over the files they were read from. The stored table is only ever anti- or
left-joined with the batch, so a small batch is broadcast and the table does not
move.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pledgeflow.functions.dates import moment
from pledgeflow.operators.reconcile import first_per_key, missing, present

log = logging.getLogger(__name__)


def align(batch: DataFrame, table: T.StructType) -> DataFrame:
    """Project a batch onto a table: extra columns go (with a warning), missing ones are NULL."""
    extra = [c for c in batch.columns if c not in table.names]
    lacking = [c for c in table.names if c not in batch.columns]
    if extra:
        log.warning("columns not in the table are dropped: %s", extra)
    if lacking:
        log.info("columns missing from the data become NULL: %s", lacking)
    # types by name: a cast must not tighten the nullability of nested values
    return batch.select(
        *[
            (F.col(f.name) if f.name in batch.columns else F.lit(None)).cast(f.dataType.simpleString()).alias(f.name)
            for f in table.fields
        ]
    )


def append_aligned(table: DataFrame, batch: DataFrame) -> DataFrame:
    return table.unionByName(align(batch, table.schema))


def _pairs(keys: Sequence[str]) -> dict[str, str]:
    return {k: k for k in keys}


def new_rows(batch: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows whose key the table lacks.

    The table's keys are first cut down to those of the batch, so that a small batch is
    broadcast twice and the keys of a large table are never shuffled.
    """
    touched = present(table.select(*keys), batch, _pairs(keys))
    return missing(batch, touched, _pairs(keys))


def upsert_replace(
    table: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    touch: str | None = None,
    as_of: str | None = None,
) -> DataFrame:
    """Replace whole rows by key; ``order`` puts the winning batch row first.

    Columns the batch lacks become NULL on replaced rows. ``touch`` names a
    modification time set to ``as_of`` on every written row.
    """
    written = align(first_per_key(batch, keys, order), table.schema)
    if touch:
        written = written.withColumn(touch, moment(as_of).cast(table.schema[touch].dataType))
    return missing(table, written, _pairs(keys)).unionByName(written)


def insert_ignore(
    table: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Add rows whose key is new; ``order`` puts the batch row to keep first."""
    fresh = new_rows(first_per_key(batch, keys, order), table, keys)
    return table.unionByName(align(fresh, table.schema))


def empty_to_null(df: DataFrame) -> DataFrame:
    """Empty text counts as missing, in every text column."""
    return df.withColumns(
        {
            f.name: F.nullif(F.col(f.name), F.lit(""))
            for f in df.schema.fields
            if isinstance(f.dataType, T.StringType)
        }
    )


def upsert_staged(
    table: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column], update: bool = True
) -> DataFrame:
    """Clean a staged batch and replace by key, or only insert new keys."""
    cleaned = empty_to_null(batch)
    merge = upsert_replace if update else insert_ignore
    return merge(table, cleaned, keys, order)


def greatest_first(df: DataFrame, *columns: str) -> list[Column]:
    """A total order of rows by value, descending: the given columns, then all others."""
    kinds = dict(df.dtypes)
    names = [*columns, *[c for c in df.columns if c not in columns]]
    # maps have no order of their own
    return [F.desc(F.sort_array(F.map_entries(c)) if kinds[c].startswith("map") else F.col(c)) for c in names]


def upsert_if_newer(
    table: DataFrame, batch: DataFrame, key: str, modified: str, merged_arrays: Sequence[str]
) -> DataFrame:
    """Update a row only when the batch row is modified later; array columns become unions.

    An undated row on either side is never updated. Of batch rows with one key the latest counts.
    """
    batch = align(first_per_key(batch, [key], greatest_first(batch, modified)), table.schema)
    old, new = table.alias("old"), batch.alias("new")
    newer = F.coalesce(F.col(f"old.{modified}") < F.col(f"new.{modified}"), F.lit(False))
    columns = []
    for c in table.columns:
        if c == key:
            columns.append(F.col(f"old.{key}"))
            continue
        update = F.col(f"new.{c}")
        if c in merged_arrays:
            empty = F.array().cast(table.schema[c].dataType)
            update = F.array_union(F.coalesce(f"old.{c}", empty), F.coalesce(f"new.{c}", empty))
        columns.append(F.when(newer, update).otherwise(F.col(f"old.{c}")).alias(c))
    kept = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "left").select(*columns)
    return kept.unionByName(new_rows(batch, table, [key]))


def upsert_partial(
    table: DataFrame, batch: DataFrame, key: str, update: Sequence[str], order: Sequence[Column] | None = None
) -> DataFrame:
    """On conflict set only the ``update`` columns; unknown keys are inserted whole.

    ``order`` puts the batch row of a key that counts first; the greatest row by default.
    """
    batch = align(first_per_key(batch, [key], order or greatest_first(batch)), table.schema)
    old, new = table.alias("old"), batch.alias("new")
    hit = F.col(f"new.{key}").isNotNull()
    columns = [
        F.when(hit, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) if c in update else F.col(f"old.{c}")
        for c in table.columns
    ]
    kept = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "left").select(*columns)
    return kept.unionByName(new_rows(batch, table, [key]))


def update_from_set(
    table: DataFrame,
    chosen: DataFrame,
    key: str,
    chosen_key: str,
    children: DataFrame,
    child_key: str,
    target: str,
    declared: str,
) -> DataFrame:
    """For keys in ``chosen`` set ``target`` to declared minus the stored child count."""
    marks = chosen.select(F.col(chosen_key).alias(key)).distinct().withColumn("__chosen", F.lit(True))
    counts = children.groupBy(F.col(child_key).alias(key)).agg(F.count(F.lit(1)).alias("__stored"))
    value = F.col(declared) - F.coalesce("__stored", F.lit(0))
    return (
        table.join(marks, key, "left")
        .join(counts, key, "left")
        .withColumn(target, F.when(F.col("__chosen"), value).otherwise(F.col(target)))
        .select(*table.columns)
    )


def quarantine(df: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and the distinct invalid ones (a NULL verdict is invalid)."""
    verdict = F.coalesce(ok, F.lit(False))
    return df.filter(verdict), df.filter(~verdict).distinct()


def merge_tables(
    tables: Mapping[str, DataFrame],
    batches: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]],
    first: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """Upsert several tables at once, those in ``first`` leading.

    Batches are normalised documents, in which one key can appear again; all
    columns together decide which of the repeats stays.
    """
    names = [*first, *[n for n in batches if n not in first]]
    result = {}
    for name in names:
        batch = batches[name]
        result[name] = upsert_replace(tables[name], batch, keys[name], greatest_first(batch))
    return result


def snapshot(
    store: DataFrame, current: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None
) -> DataFrame:
    """Append the current rows whose (entity, time) key is not stored yet, one per key.

    ``order`` puts the row of a repeated key that counts first; the greatest row by default.
    """
    unique = first_per_key(current, keys, order or greatest_first(current))
    return store.unionByName(align(new_rows(unique, store, keys), store.schema))
