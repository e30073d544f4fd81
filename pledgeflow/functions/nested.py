"""Arrays, maps and structs: exploding, zipping, flattening."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pledgeflow.functions.numbers import bind


def explode_scalars(df: DataFrame, keep: dict[str, str], array: str, name: str) -> DataFrame:
    """One row per element; a NULL array gives none. ``keep`` maps column -> new name."""
    kept = [F.col(c).alias(n) for c, n in keep.items()]
    return df.select(*kept, F.explode(array).alias(name))


def explode_structs(
    df: DataFrame, keep: dict[str, str], array: str, ordinal: str | None = None, rename: dict[str, str] | None = None
) -> DataFrame:
    """Child rows with the parent's key, optionally a 1-based position and renamed fields."""
    kept = [F.col(c).alias(n) for c, n in keep.items()]
    fields = df.select(F.col(array)).schema[0].dataType.elementType.names
    items = [F.col(f"__item.{f}").alias((rename or {}).get(f, f)) for f in fields]
    if ordinal is None:
        return df.select(*kept, F.explode(array).alias("__item")).select(*keep.values(), *items)
    return df.select(*kept, F.posexplode(array).alias("__pos", "__item")).select(
        *keep.values(), (F.col("__pos") + 1).alias(ordinal), *items
    )


def explode_listed(df: DataFrame, keep: dict[str, str], keys: str, values: str, key: str, value: str) -> DataFrame:
    """Rows of a map for the keys listed in an array."""
    kept = [F.col(c).alias(n) for c, n in keep.items()]
    return df.select(*kept, F.explode(keys).alias(key), F.col(values).alias("__map")).select(
        *keep.values(), key, F.try_element_at("__map", F.col(key)).alias(value)
    )


def split_zip(df: DataFrame, index: Sequence[str], split: Sequence[str]) -> DataFrame:
    """Comma lists of several columns zipped to rows, trimmed, cut to the shortest."""
    parts = {c: F.transform(F.split(F.col(c), ","), lambda p: F.trim(p)) for c in split}
    shortest = F.size(parts[split[0]]) if len(split) == 1 else F.least(*[F.size(p) for p in parts.values()])
    zipped = F.arrays_zip(*[F.slice(p, 1, shortest).alias(c) for c, p in parts.items()])
    return df.select(*index, F.inline(zipped).alias(*split))


def _leaves(kind: T.StructType, path: Column, prefix: str) -> list[tuple[str, Column]]:
    leaves = []
    for field in kind.fields:
        name = f"{prefix}_{field.name}" if prefix else field.name
        value = path.getField(field.name)
        if isinstance(field.dataType, T.StructType):
            leaves += _leaves(field.dataType, value, name)
        else:
            leaves.append((name, value))
    return leaves


def flatten(df: DataFrame, struct: str) -> DataFrame:
    """Columns ``parent_child`` for every leaf of a struct column; other columns stay.

    Two leaves of the same name must agree in every row, else the job fails.
    """
    columns: dict[str, Column] = {}
    for name, value in _leaves(df.schema[struct].dataType, F.col(struct), ""):
        if name in columns:
            clash = F.raise_error(F.lit(f"values of {name} differ"))
            value = F.when(columns[name].eqNullSafe(value), columns[name]).otherwise(clash)
        columns[name] = value
    others = [c for c in df.columns if c != struct]
    return df.select(*others, *[v.alias(n) for n, v in columns.items()])


def script_fields(script: Column) -> Column:
    """``key: value`` pieces of script text as a map, the last value of a key winning.

    N/Y read as false/true, ``none`` and empty values as NULL.
    """

    def last_of_each(entries: Column) -> Column:
        def pick(keys: Column) -> Column:
            return F.filter(entries, lambda e, i: F.array_position(keys, e["key"]) == F.size(entries) - i)

        return bind(F.reverse(F.transform(entries, lambda e: e["key"])), pick)

    return F.map_from_entries(bind(_script_entries(script), last_of_each))


def script_fields_conflict(script: Column) -> Column:
    """Whether some key appears with two different values."""

    def differs(entries: Column) -> Column:
        keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
        return F.size(F.array_distinct(entries)) > F.size(keys)

    return bind(_script_entries(script), differs)


# a piece between separators that holds one colon: key, then value
_PAIR = r"(?:^|[,;{}\n])([^,;{}\n:]*):([^,;{}\n:]*)(?=[,;{}\n]|$)"
# quotes, backslashes and blanks around a key or value
_EDGES = r"""^[\s'"\\]+|[\s'"\\]+$"""


def _script_entries(script: Column) -> Column:
    """All ``key: value`` pairs of a script as typed entries."""

    def bare(part: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(part, _EDGES, ""), r"""\\(['"])""", "$1")

    def typed(value: Column) -> Column:
        flag = F.when(value.isin("Y", "N"), (value == "Y").cast("string"))
        return F.coalesce(flag, F.nullif(F.nullif(value, F.lit("none")), F.lit("")))

    keys, values = (F.regexp_extract_all(script, F.lit(_PAIR), F.lit(group)) for group in (1, 2))
    return F.zip_with(
        keys, values, lambda key, value: F.struct(bare(key).alias("key"), bind(bare(value), typed).alias("value"))
    )
