"""Urls against the SQL oracle, and terms against a scan at every position."""

import re

import duckdb
from oracle import compare

from pledgeflow.llm import queries, url_filter

ODD = [
    None,
    "",
    "no scheme/en/",
    "http://",
    "http://net",
    "http://NET/x",
    "http://a.b.net/en/",
    "https://Example.NET/en/1#net/",
    "https://x.example.net/EN/1",
    "https://notexample.com/de/",
    "https://www.example.com/de/?u=http://x.org/fr/",
    "https://example.com/deutsch/",
    "https://a.org/fr/",
    "https://a.org/casino-free",
    "https://a.org/casinos",
    "https://a.org/free/free",
    "https://a.org/free_bonus",
    "https://a.org/FREE.bonus",
    "https://ÀCASINOé.org/",
    "https://a.org?x=://b.net/",
    "ftp://a.org#free-bets",
]


def test_odd_urls_equal_the_oracle(spark):
    rows = [(i, url, None, "h", "r") for i, url in enumerate([*ODD, ODD[3]])] + [(None, ODD[4], None, "h", "r")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, rule string")
    con = duckdb.connect()
    con.register("frame", pages.select("page_id", "url").toArrow())
    con.execute("create view pages as select page_id, url from frame")
    got = url_filter.judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")
    assert compare(got, con, queries.ORACLES["op7_weighted_url_terms"]) is None


def test_terms_by_brute_force():
    for url in ODD:
        text = "".join(c.lower() if c.isascii() else c for c in url or "")

        def found(term):
            return [m for m in re.finditer(f"(?={re.escape(term)})", text) if not re.search("[a-z0-9]$", text[: m.start()]) and not re.match("[a-z0-9]", text[m.start() + len(term) :])]

        want = sum(len(found(t)) for t in url_filter.STRICT), sum(bool(found(t)) for t in url_filter.SOFT)
        assert url_filter.term_counts(url, url_filter.STRICT, url_filter.SOFT) == want, url


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert url_filter.judge_urls(pages).collect() == []
