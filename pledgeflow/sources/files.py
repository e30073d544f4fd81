"""File scans. Each returns a lazy frame; nothing is read on the driver."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pledgeflow.functions import text, urls
from pledgeflow.operators.ordering import skip_first
from pledgeflow.operators.reconcile import missing, present

_FILE = "_metadata.file_path"


def csv_json_path(spark: SparkSession, folder: str, schema: str, id_column: str, json_column: str, path: str) -> DataFrame:
    """(id, url) from all CSVs below a folder, the url taken from a JSON-valued column.

    The query string is cut and the scheme becomes https.
    """
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("recursiveFileLookup", True)
        .option("escape", '"')
        .option("multiLine", True)
        .csv(folder)
    )
    url = urls.to_https(urls.strip_query(F.get_json_object(json_column, path)))
    return rows.select(F.col(id_column).alias("id"), url.alias("url")).filter(F.col("url").isNotNull())


def recursive_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """(path, text) of every whole file below a folder."""
    return (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .option("wholetext", True)
        .text(folder)
        .select(F.col(_FILE).alias("path"), F.col("value").alias("text"))
    )


def json_pages(spark: SparkSession, folder: str, schema: str, key: str, indented: bool = False) -> DataFrame:
    """Documents listed under ``key`` of each JSON page file, with the file they came from.

    A page is one line of JSON unless the files are ``indented``.
    """
    pages = (
        spark.read.schema(f"{key} array<struct<{_fields(schema)}>>")
        .option("multiLine", indented)
        .option("recursiveFileLookup", True)
        .json(folder)
    )
    return pages.select(F.col(_FILE).alias("file"), F.inline(key))


def _fields(ddl: str) -> str:
    from pledgeflow.schemas import layout

    return ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in layout(ddl).fields)


def json_categories(spark: SparkSession, folder: str, categories: Mapping[str, str]) -> dict[str, DataFrame]:
    """One frame per category sub-folder of JSON page files, each with its own layout."""
    return {name: json_pages(spark, f"{folder}/{name}", schema, name) for name, schema in categories.items()}


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """(url, path) from a text file of urls."""
    url = F.rtrim(F.col("value"), F.lit("\r"))
    return spark.read.text(path).select(url.alias("url"), urls.relative_path(url).alias("path"))


def stored_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, content, modified) of raw files, path relative to the folder.

    Contents are only read where the plan uses them.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    root = folder.split(":", 1)[-1].rstrip("/") + "/"
    return files.select(
        F.substring_index("path", root, -1).alias("path"), "content", F.col("modificationTime").alias("modified")
    )


def remaining_paths(listing: DataFrame, stored: DataFrame, skip: int) -> DataFrame:
    """Rows of an ordered listing (position, id, url) after the first ``skip`` whose page is stored."""
    later = skip_first(listing, "position", skip).withColumn("path", urls.relative_path(F.col("url")))
    return present(later, stored, {"path": "path"})


def new_binary_files(stored: DataFrame, loaded: DataFrame) -> DataFrame:
    """(url, html, last_scrape) of raw files not loaded yet."""
    fresh = missing(stored.withColumnRenamed("path", "url"), loaded, {"url": "url"})
    html = F.make_valid_utf8(F.col("content").cast("string"))
    return fresh.select("url", html.alias("html"), F.col("modified").alias("last_scrape"))


def control_delimited(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Bulk file with the shift-out separator, backslash escapes and empty for NULL."""
    return (
        spark.read.schema(schema)
        .option("sep", "\x0e")
        .option("quote", "")
        .option("escape", "\\")
        .option("nullValue", "")
        .csv(path)
    )


def encoded_pages(spark: SparkSession, path: str) -> DataFrame:
    """``url|code|time|html`` lines whose html had newline, pipe and CR replaced."""
    rows = (
        spark.read.schema("loc string, server_code string, last_modified timestamp_ntz, html string")
        .option("sep", "|")
        .option("quote", "\x01")
        .option("escape", "\x02")
        .option("nullValue", "")
        .csv(path)
    )
    return rows.withColumns(
        {"loc": urls.strip_slash(F.col("loc")), "html": text.decode_controls(F.col("html"))}
    )


def tsv_parts(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """Many TSV chunks, each with its header."""
    return spark.read.schema(schema).option("sep", "\t").option("header", True).csv(pattern)


def documents_by_marker(spark: SparkSession, path: str, marker: str) -> DataFrame:
    """Documents of a concatenated file, one row each, split while reading.

    The marker acts as record separator, so a file of any size is read in splits.
    """
    rows = spark.read.option("lineSep", marker).text(path)
    return rows.select(F.rtrim(F.col("value"), F.lit("\r\n")).alias("document")).filter("document <> ''")


def bodies(page: Column) -> Column:
    """The ``<body`` … ``/body>`` stretches inside one text."""
    return F.regexp_extract_all(page, F.lit("(?s)<body.*?/body>"), F.lit(0))


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, line_id, line) in file order without reading a file whole.

    Lines are ordered by the start of their file block, then by their id in the task
    that reads it.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_id"),
        F.col("value").alias("line"),
    )
