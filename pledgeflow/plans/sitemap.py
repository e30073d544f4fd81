"""Sitemap entries into the table of known pages."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pledgeflow.functions.urls import fundraiser_page, strip_slash
from pledgeflow.operators import merge
from pledgeflow.operators import reconcile as rec
from pledgeflow.operators.filters import safe_url
from pledgeflow.session import materialise


class SitemapResult(NamedTuple):
    table: DataFrame
    rejected: DataFrame


def split_valid(scanned: DataFrame, host_pattern: str) -> tuple[DataFrame, DataFrame]:
    """Well-formed pages of the host, and the distinct other entries.

    The files are parsed once: entries are written by verdict, and each result reads its own folder.
    """
    verdict = F.coalesce(safe_url(F.col("loc"), host_pattern), F.lit(False))
    written = materialise(scanned.withColumn("__valid", verdict), "__valid")
    valid, rejected = merge.quarantine(written, F.col("__valid"))
    return valid.drop("__valid"), rejected.drop("__valid")


def rewrite_fundraisers(entries: DataFrame, root: str) -> DataFrame:
    """A fundraiser listed under its owner's profile url moves to its own page."""
    shared = rec.in_both_categories(entries, "loc", "category", "users", "fundraisers")
    marks = shared.withColumn("__shared", F.lit(True))
    moved = F.col("__shared") & (F.col("category") == "fundraisers")
    loc = F.when(moved, fundraiser_page(F.col("loc"), root)).otherwise(F.col("loc"))
    return entries.join(marks, "loc", "left").withColumn("loc", loc).drop("__shared")


def pages_to_download(entries: DataFrame, root: str) -> DataFrame:
    """Every listed page plus the fundraiser page of each profile that is also a fundraiser."""
    shared = rec.in_both_categories(entries, "loc", "category", "users", "fundraisers")
    own = shared.select(fundraiser_page(F.col("loc"), root).alias("loc"))
    return rec.union_distinct(own, entries.select("loc"))


def merge_sitemap(stored: DataFrame, scanned: DataFrame, host_pattern: str, root: str) -> SitemapResult:
    """Reject bad urls, reduce to one row per page, and merge where the listing is newer.

    The first grouping leaves one row per (page, category), so a page's arrays hold its
    categories and one file for each, never its raw entries.
    """
    valid, rejected = split_valid(scanned, host_pattern)
    per_category = valid.groupBy("loc", "category").agg(
        *[F.max(c).alias(c) for c in ("lastmod", "changefreq", "priority", "origin_file")]
    )
    rewritten = rewrite_fundraisers(per_category, root).withColumn("loc", strip_slash(F.col("loc")))
    per_page = rewritten.groupBy("loc").agg(
        F.sort_array(F.collect_list("category")).alias("categories"),
        *[F.max(c).alias(c) for c in ("lastmod", "changefreq", "priority")],
        F.sort_array(F.collect_list("origin_file")).alias("origin_files"),
    )
    # the batch is joined twice below; parse and group the files once
    per_page = materialise(per_page)
    table = merge.upsert_if_newer(stored, per_page, "loc", "lastmod", ["categories", "origin_files"])
    return SitemapResult(table, rejected)
