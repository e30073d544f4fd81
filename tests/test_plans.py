"""Physical plans and streaming restarts."""

import datetime as dt
import re

from helpers import SF, plan
from pyspark.sql import functions as F

from pledgeflow.queries import all_queries
from pledgeflow.queries.registry import Tables
from pledgeflow.schemas import layout
from pledgeflow.streaming import landing


def _plan(spark, name):
    return plan(all_queries()[name](spark, SF))


def test_filters_and_columns_reach_the_scan(spark):
    text = _plan(spark, "filter_live")
    assert "EqualTo(o_orderstatus,O)" in text
    assert "o_totalprice" not in text
    stale = _plan(spark, "filter_in_stale")
    assert "In(event_type" in stale and "LessThan(ts" in stale
    between = _plan(spark, "export_between")
    assert "GreaterThanOrEqual(o_orderdate" in between and "LessThan(o_orderdate" in between


def test_max_per_key_is_one_shuffle_with_partial_aggregation(spark):
    text = _plan(spark, "max_per_key")
    assert text.count("Exchange") == 1 and "partial_max" in text


def test_no_pairwise_joins(spark):
    for name in ("self_join_category", "take_until", "founder_distribution", "param_grid", "scale_choice", "high_watermark"):
        text = _plan(spark, name)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_upsert_does_not_shuffle_the_stored_table(spark):
    from pledgeflow.operators import merge

    t = Tables(spark, SF)
    table = t.orders
    batch = t.orders.limit(10)
    text = plan(merge.upsert_replace(table, batch, ["o_orderkey"], [F.desc("o_orderdate")]))
    anti = text[text.index("LeftAnti") :].splitlines()
    assert "BroadcastHashJoin" in text and "FileScan" in anti[1] + anti[2] + anti[3]


def test_interpolation_needs_no_calendar_join(spark):
    assert not re.search(r"\bJoin\b|SortMergeJoin|BroadcastHashJoin", _plan(spark, "interpolate_daily"))


def test_replayed_micro_batch_changes_nothing(spark, tmp_path):
    table = layout("id bigint, v string")
    data = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "id long, v string, seq int")
    folder = str(tmp_path)
    data.write.json(f"{folder}/landing")

    def drain(checkpoint):
        stream = landing.json_stream(spark, f"{folder}/landing", "id bigint, v string, seq int")
        landing.land_deltas(stream, table, ["id"], [F.desc("seq")], f"{folder}/deltas", checkpoint).awaitTermination()

    drain(f"{folder}/c1")
    base = spark.createDataFrame([(2, "old"), (3, "old")], table)
    first = landing.merged(base, landing.read_deltas(spark, f"{folder}/deltas", table), ["id"]).collect()
    drain(f"{folder}/c2")  # a lost checkpoint replays the batch under the same id
    again = landing.merged(base, landing.read_deltas(spark, f"{folder}/deltas", table), ["id"]).collect()
    assert sorted(first) == sorted(again) == [(1, "b"), (2, "c"), (3, "old")]


def test_landed_documents_are_parsed_once(spark):
    """Eight tables of landed documents read columns; none parses JSON again."""
    from pledgeflow.plans import loans
    from pledgeflow.queries.documents import _loan_documents
    from pledgeflow.queries.registry import Tables

    docs = _loan_documents(Tables(spark, SF))
    assert "from_json" in plan(docs)
    for table in loans.loan_tables(docs, F.current_timestamp(), landed=True).values():
        assert "from_json" not in plan(table)


def test_sitemaps_are_parsed_once(spark, tmp_path):
    """The valid and the rejected entries read what one scan of the files has written."""
    from pledgeflow.plans import sitemap as plans
    from pledgeflow.sources import sitemap

    (tmp_path / "users").mkdir()
    urls = "".join(f"<url><loc>{u}</loc></url>" for u in ("https://site.example/a", "https://site.example/b", "ftp://x", "ftp://x"))
    (tmp_path / "users" / "m.xml").write_text(f"<urlset>{urls}</urlset>")
    valid, rejected = plans.split_valid(sitemap.sitemap_urls(spark, str(tmp_path)), r"https://site\.example")
    assert valid.count() == 2 and rejected.count() == 1
    assert valid.columns == rejected.columns == ["loc", "category", "lastmod", "changefreq", "priority", "origin_file"]
    for result in (valid, rejected):
        assert all("/kept-" in f and not f.endswith(".xml") for f in result.inputFiles())


def test_quarterly_report_reads_the_facts_once(spark):
    """All five tables are rolled up from the written rows of a day."""
    from pledgeflow.plans import reports

    day = "timestamp_ntz'2024-01-01' + make_dt_interval(cast(id as int) % 400)"
    facts = spark.range(3000).selectExpr(f"{day} as at", "if(id % 7 = 0, null, id * 0.5) as a", "if(id % 5 = 0, null, id + 1e6) as b", "'EUR' as cur")
    rates = spark.createDataFrame([("EUR", dt.date(2023, 1, 1), 2.0)], "currency string, rate_date date, usd_rate double")
    tables = reports.quarterly_report(facts, "at", "2030-01-01 00:00:00", ["a", "b"], "b", "cur", rates)
    assert all("/kept-" in f for t in tables.values() for f in t.inputFiles())
    rows = facts.collect()
    quarter = lambda r: f"{r.at.year}-Q{(r.at.month - 1) // 3 + 1}"
    both = [r for r in rows if r.a is not None and r.b is not None]
    split = {r.quarter: r for r in tables["split"].collect()}
    assert len(split) == len({quarter(r) for r in both})
    values = {}
    for r in both:
        values.setdefault((r.at.year, (r.at.month - 1) // 3), []).append(r.b)
    got = sorted((round(r.b, 3), round(r.b_std, 6)) for r in split.values())
    mean = lambda v: sum(v) / len(v)
    want = [(round(sum(v), 3), round(mean([(x - mean(v)) ** 2 for x in v]) ** 0.5, 6)) for v in values.values()]
    assert got == sorted(want)
    assert sum(r["count"] for r in tables["projects"].collect()) == 3000 == sum(r.n for r in tables["daily"].collect())
    assert sum(r.total for r in tables["amount"].collect()) == 2 * sum(r.b for r in rows if r.b is not None)
