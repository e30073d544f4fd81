"""Fields and sections from a page's array of selected elements.

Everything here is a column of the page's own row: a value is a function of one element, a
field picks elements by selector and applies it. Nothing is grouped or shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Value = Callable[[Column], Column]


def attr(name: str) -> Value:
    return lambda e: F.try_element_at(e["attrs"], F.lit(name))


def own_text(number: int = 0) -> Value:
    """One of the element's own text nodes; NULL when there are fewer."""
    return lambda e: F.get(e["texts"], F.lit(number))


def own_texts(separator: str) -> Value:
    return lambda e: F.array_join(e["texts"], separator)


def all_text() -> Value:
    return lambda e: e["text"]


def path() -> Value:
    return lambda e: e["path"]


def of(sel: str) -> Column:
    """A selector's elements in document order."""
    return F.filter("elements", lambda e: e["sel"] == sel)


def first(sel: str, value: Value) -> Column:
    """Value from the first element of a selector, NULL when there is none."""
    return nth(sel, value, 0)


def nth(sel: str, value: Value, number: int) -> Column:
    """Value from the n-th element (0-based)."""
    return value(F.get(of(sel), F.lit(number)))


def listed(sel: str, value: Value) -> Column:
    """Values of all elements of a selector that have one."""
    return F.array_compact(F.transform(of(sel), value))


def joined(sel: str, value: Value, separator: str = "\n") -> Column:
    return F.array_join(listed(sel, value), separator)


def number_of(sel: str) -> Column:
    return F.size(of(sel)).cast("long")


def exists(sel: str) -> Column:
    return F.exists("elements", lambda e: e["sel"] == sel)


def at_most_one(sel: str, value: Value) -> Column:
    """Value of the single element of a selector; the job fails when there are several."""
    several = F.raise_error(F.lit(f"too many elements for {sel}")).cast("string")
    return F.when(number_of(sel) > 1, several).otherwise(first(sel, value).cast("string"))


def page_fields(elements: DataFrame, key: str, fields: Mapping[str, Column]) -> DataFrame:
    """One row per page that has selected elements."""
    return elements.select(key, *[value.alias(name) for name, value in fields.items()])


def section_fields(elements: DataFrame, key: str, section: str, fields: Mapping[str, Column]) -> DataFrame:
    """One row per repeated section, with the position of its element in the page.

    ``elements`` lists the section (``in_<section>``), so that every section has an array of its own and
    a page of many sections costs no more than their elements. The section element itself belongs
    to its section: its own attributes are fields too.
    """
    sections = elements.select(key, F.explode(f"in_{section}").alias("__s"))
    rows = sections.select(key, F.col("__s.pos").alias("section_pos"), F.col("__s.elements").alias("elements"))
    return rows.select(key, "section_pos", *[value.alias(name) for name, value in fields.items()])


def each(elements: DataFrame, sel: str, *kept: str | Column, **values: Value) -> DataFrame:
    """One row per element of a selector: the kept columns of its page and named values."""
    rows = elements.select("*", F.explode(of(sel)).alias("__e"))
    return rows.select(*kept, *[value(F.col("__e")).alias(name) for name, value in values.items()])


def table_rows(elements: DataFrame, key: str, table: str, header: str, row: str, cell: str) -> DataFrame:
    """Body rows of tables as (key, row_pos, table_pos, header array, cell array, valid).

    ``elements`` lists the tables as sections, and in them the rows. A row is valid when it is as
    wide as the header; empty cells count as ''.
    """

    def texts(found: Column, sel: str) -> Column:
        return F.transform(F.filter(found, lambda e: e["sel"] == sel), lambda e: F.coalesce(own_text()(e), F.lit("")))

    tables = elements.select(key, F.explode(f"in_{table}").alias("__t"))
    headed = tables.select(
        key, F.col("__t.pos").alias("table_pos"), texts(F.col("__t.elements"), header).alias("headers"), F.col(f"__t.in_{row}").alias("__rows")
    )
    rows = headed.select(key, "table_pos", "headers", F.explode("__rows").alias("__r"))
    found = rows.select(key, F.col("__r.pos").alias("row_pos"), "table_pos", "headers", texts(F.col("__r.elements"), cell).alias("cells"))
    return found.filter("size(headers) > 0 and size(cells) > 0").withColumn("valid", F.size("headers") == F.size("cells"))


def classify(pages: DataFrame, html: str, markers: Mapping[str, str]) -> DataFrame:
    """Add ``page_type``: the one marker pattern found, ``unknown`` or ``conflict``.

    Patterns run in the JVM on the whole page without its comments.
    """
    from pledgeflow.functions.text import strip_comments

    found = F.array_compact(
        F.array(*[F.when(F.col("__clean").rlike(pattern), F.lit(name)) for name, pattern in markers.items()])
    )
    kind = (
        F.when(F.size("__found") == 1, F.get("__found", F.lit(0)))
        .when(F.size("__found") == 0, "unknown")
        .otherwise("conflict")
    )
    return (
        pages.withColumn("__clean", strip_comments(F.col(html)))
        .withColumn("__found", found)
        .withColumn("page_type", kind)
        .drop("__clean", "__found")
    )


def embedded_json(pages: DataFrame, key: str, html: str, pattern: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """JSON held in a script string: parsed documents, and pages without exactly one.

    ``pattern`` captures the string literal. Finding it stays in the JVM; only the literal
    goes through the escape decoder.
    """
    from pledgeflow.functions.text import script_literal

    found = pages.select(key, F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(1)).alias("__hits"))
    single = found.filter(F.size("__hits") == 1)
    parsed = single.select(key, F.from_json(script_literal(F.get("__hits", F.lit(0))), schema).alias("document"))
    rejected = found.filter(F.size("__hits") != 1).select(key, F.size("__hits").alias("hits"))
    return parsed, rejected


def attribute_json(elements: DataFrame, key: str, name: str, schema: str) -> DataFrame:
    """JSON held in an element attribute, one row per element."""
    rows = elements.select(key, F.explode("elements").alias("__e"))
    found = rows.select(key, F.col("__e.pos").alias("pos"), attr(name)(F.col("__e")).alias("__json"))
    return found.filter(F.col("__json").isNotNull()).select(key, "pos", F.from_json("__json", schema).alias("document"))
