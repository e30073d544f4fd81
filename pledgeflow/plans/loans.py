"""Loans: documents to tables, work lists and snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pledgeflow.functions.dates import iso_timestamp
from pledgeflow.functions.nested import explode_listed, explode_scalars, explode_structs
from pledgeflow.operators import filters, merge
from pledgeflow.operators import reconcile as rec
from pledgeflow.session import materialise

OPEN = ("in_repayment", "inactive", "fundraising")


def _dates(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: iso_timestamp(F.col(c)) for c in columns})


def loan_rows(docs: DataFrame, scrape_time: Column) -> DataFrame:
    """One flat row per loan document; absent sub-documents give NULLs."""
    nested = ("borrowers", "description", "image", "journal_totals", "location", "payments")
    nested += ("tags", "themes", "terms", "translator", "video")
    terms = (
        "disbursal_amount disbursal_currency disbursal_date loan_amount repayment_interval repayment_term".split()
    )
    losses = ("currency_exchange", "currency_exchange_coverage_rate", "nonpayment")
    rows = docs.select(
        *[c for c in docs.columns if c not in nested],
        F.col("image.id").alias("image_id"),
        F.col("image.template_id").alias("image_template_id"),
        F.col("journal_totals.entries").alias("journal_total_entries"),
        F.col("journal_totals.bulkEntries").alias("journal_total_bulk_entries"),
        "location.country",
        "location.country_code",
        "location.town",
        *[F.col(f"location.geo.{g}").alias(f"geo_{g}") for g in ("pairs", "type", "level")],
        *[F.col(f"terms.{c}").alias(f"terms_{c}") for c in terms],
        *[F.col(f"terms.loss_liability.{c}").alias(f"terms_loss_liability_{c}") for c in losses],
        F.col("translator.byline").alias("translator_byline"),
        F.col("translator.image").alias("translator_image_id"),
        F.col("video.id").alias("video_id"),
        F.col("video.youtubeId").alias("video_youtube_id"),
        F.col("video.title").alias("video_title"),
        F.col("video.thumbnailImageId").alias("video_thumbnail_image_id"),
        scrape_time.alias("scrape_time"),
    )
    return _dates(
        rows, "posted_date", "planned_expiration_date", "terms_disbursal_date", "funded_date", "paid_date"
    )


def loan_tables(docs: DataFrame, scrape_time: Column, landed: bool = False) -> dict[str, DataFrame]:
    """Loan documents to the loan table and its seven child tables.

    All tables are selects on the same parsed frame. ``landed`` writes that frame once, so that
    the JSON is parsed once for all tables and each of them reads only its columns.
    """
    docs = materialise(docs) if landed else docs
    key = {"id": "loan_id"}
    lifted = docs.withColumns(
        {
            "local_payments": F.col("terms.local_payments"),
            "scheduled_payments": F.col("terms.scheduled_payments"),
            "languages": F.col("description.languages"),
            "texts": F.col("description.texts"),
        }
    )
    payments = explode_structs(docs, key, "payments", rename={"payment_id": "id"})
    local = explode_structs(lifted, key, "local_payments", "order_number")
    scheduled = explode_structs(lifted, key, "scheduled_payments", "order_number")
    return {
        "loan": loan_rows(docs, scrape_time),
        "borrower": explode_structs(docs, key, "borrowers", "order_number"),
        "description": explode_listed(lifted, key, "languages", "texts", "language", "text"),
        "payment": _dates(payments, "processed_date", "settlement_date"),
        "local_payment": _dates(local, "due_date"),
        "scheduled_payment": _dates(scheduled, "due_date"),
        "tag": explode_structs(docs, key, "tags"),
        "theme": explode_scalars(docs, key, "themes", "theme"),
    }


def lender_links(docs: DataFrame) -> DataFrame:
    """(loan_id, lender_id); a loan without a list gives no row."""
    return explode_scalars(docs, {"id": "loan_id"}, "lender_ids", "lender_id")


def lender_rows(docs: DataFrame) -> DataFrame:
    flat = docs.select(
        *[c for c in docs.columns if c != "image"],
        F.col("image.id").alias("image_id"),
        F.col("image.template_id").alias("image_template_id"),
    )
    return _dates(flat, "member_since")


def merge_details(detailed: DataFrame, listed: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Detailed loans completed by their first listing; non-null detail wins."""
    return rec.first_match_merge(detailed, listed, "id", order)


def loans_to_refresh(loans: DataFrame, as_of: str | None) -> DataFrame:
    return filters.open_and_stale(loans, "status", OPEN, "scrape_time", as_of, hours=12)


def loans_without_lenders(loans: DataFrame, links: DataFrame) -> DataFrame:
    """Loans that declare lenders but have no link stored."""
    return rec.missing(loans.filter("lender_count > 0"), links, {"id": "loan_id"}).select("id")


def unknown_lenders(links: DataFrame, lenders: DataFrame) -> DataFrame:
    """Distinct linked lenders without a lender row."""
    return rec.missing(links, lenders, {"lender_id": "lender_id"}).select("lender_id").distinct()


def append_snapshot(
    store: DataFrame, loans: DataFrame, statuses: Sequence[str] = OPEN, keys: Sequence[str] = ("loan_id", "scrape_time")
) -> DataFrame:
    """Add the open loans scraped after the last snapshot; everything when there is none.

    A loan listed twice with one scrape time is stored once, as its greatest row.
    """
    fresh = filters.newer_than_stored(
        loans.filter(F.col("status").isin(*statuses)), "scrape_time", store, "scrape_time"
    )
    return merge.append_aligned(store, rec.first_per_key(fresh, keys, merge.greatest_first(fresh)))
