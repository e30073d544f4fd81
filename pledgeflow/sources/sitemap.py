"""Sitemap XML scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pledgeflow.functions.dates import valid_lastmod
from pledgeflow.functions.urls import strip_slash, to_https
from pledgeflow.schemas import SITEMAP_URL


def sitemap_urls(spark: SparkSession, folder: str) -> DataFrame:
    """Entries of all sitemap files below a folder, values trimmed, missing ones NULL.

    ``category`` is the folder of the file, as ``<category>/<file>``.
    """
    rows = (
        spark.read.format("xml")
        .option("rowTag", "url")
        .option("recursiveFileLookup", True)
        .schema(SITEMAP_URL)
        .load(folder)
    )
    return rows.select(
        F.coalesce(F.trim("loc"), F.lit("")).alias("loc"),
        F.element_at(F.split("_metadata.file_path", "/"), -2).alias("category"),
        valid_lastmod(F.col("lastmod")).try_cast("timestamp_ntz").alias("lastmod"),
        F.trim("changefreq").alias("changefreq"),
        F.trim("priority").try_cast("decimal(38,10)").alias("priority"),
        F.col("_metadata.file_path").alias("origin_file"),
    )


def sitemap_index(spark: SparkSession, path: str, below: str, root: str) -> DataFrame:
    """Sitemap locations of an index file that lie under ``below``, without the site root."""
    rows = spark.read.format("xml").option("rowTag", "sitemap").schema("loc string").load(path)
    loc = to_https(strip_slash(F.trim("loc")))
    return (
        rows.filter(F.contains("loc", F.lit(below))).select(loc.alias("loc")).filter(F.col("loc") != root)
    )
