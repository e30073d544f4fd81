"""The element scan on broken markup, and page jobs the tables cannot cover."""

import time

import pyarrow as pa
import pytest
from helpers import plan, rows
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from pledgeflow import session
from pledgeflow.operators import extract as x
from pledgeflow.plans import page_specs, pages
from pledgeflow.session import spread
from pledgeflow.sources import html
from pledgeflow.sources.html import Selector, elements


def _pages(spark, *sources):
    return spark.createDataFrame(list(enumerate(sources)), "page long, html string")


def test_unclosed_and_stray_tags(spark):
    html = "<ul><li>a<li>b <b>c</ul></i><p>x<p>y<br>z</div><img src=q><p>w"
    found = elements(_pages(spark, html, None), "page", "html", {"li": Selector("li"), "p": Selector("p")})
    assert [(r.sel, r.text) for r in found.first().elements] == [
        ("li", "a"), ("li", "b c"), ("p", "x"), ("p", "yz"), ("p", "w"),
    ]


def test_scripts_comments_and_entities(spark):
    html = "<!-- <p>no</p> --><script>if (a<b) '<p>no</p>'</script><p title='&lt;t&gt;'>1 &amp; 2</p>"
    found = elements(_pages(spark, html), "page", "html", {"p": Selector("p"), "s": Selector("script")})
    got = [(r.sel, r.text, r.attrs) for r in found.first().elements]
    assert got == [("s", "if (a<b) '<p>no</p>'", {}), ("p", "1 & 2", {"title": "<t>"})]


def test_plain_markup_needs_no_tolerant_parser(monkeypatch):
    """One pattern reads plain markup, and reads it as HTMLParser does; the rest is left to HTMLParser."""
    plain = (
        '<!DOCTYPE html><!-- <p> --><div class="a b" id=x><P title="&lt;t&gt;">1 &amp; 2<br/><img src=\'q\'>3</p>'
        "<ul><li>a<li>b <b>c</b></ul></i><x-y hidden/>z</div><script>if (a<b) '&amp;'</script><style></style>w"
    )
    selectors = {"any": Selector(), "p": Selector("p"), "b": Selector("b", inside="li"), "li": Selector("li"), "sub": Selector("ul", child_of="div"), "div": Selector("div", cls_has="b")}

    def read(source):
        page = html._Page(html._Choice(selectors))
        page.read(source)
        return [(r.sel, r.pos, r.attrs, r.texts, page.pieces[r.first : r.last], r.within, r.path) for r in page.rows]

    tolerant = []
    feed = html.HTMLParser.feed
    monkeypatch.setattr(html.HTMLParser, "feed", lambda self, source: (tolerant.append(source), feed(self, source)))
    got = read(plain)
    assert tolerant == [] and len(got) == 17
    for odd in ("<a href=x/>", "1 < 2", "<p", "<!-- a-b -->", "<![CDATA[x]]>", "<script>'</p>'</script>"):
        read(odd)
        assert tolerant.pop() == odd
    monkeypatch.setattr(html, "_TOKEN", html.re.compile(r"()()()()()()()()(<)"))
    assert read(plain) == got and tolerant == [plain]


def test_page_elements_are_not_shuffled(spark):
    """Between the tokeniser and the fields or sections of a page there is no exchange."""
    big = _pages(spark, "<p>x</p>").repartition(2)
    for made in (pages.events(big, "page", "html").rows, pages.comments(big, "page", "html"), pages.project_states(big, "page", "html")):
        assert "Exchange" not in plan(made).split("MapInArrow")[0]


def test_many_sections_on_one_page(spark):
    item = '<li id="comment-{0}"><a class="author" href="/profile/u{0}">U{0}</a><p>b{0}</p><time datetime="2014-01-02T"></time></li>'
    html = '<li class="page"><ol class="comments">' + "".join(item.format(i) for i in range(500)) + "</ol></li>"
    got = pages.comments(_pages(spark, html), "page", "html")
    assert got.count() == 500
    assert got.filter("user_id = concat('u', id) and body = concat('b', id)").count() == 500


def test_cost_of_sections_is_in_proportion(spark):
    """Four times as many comments on a page take no more than about four times as long."""
    item = '<li id="comment-{0}"><a class="author" href="/profile/u{0}">U{0}</a><p>b{0}</p><time datetime="2014-01-02T"></time></li>'
    seconds = {}
    for n in (1000, 1000, 4000):  # the first run compiles
        html = '<li class="page"><ol class="comments">' + "".join(item.format(i) for i in range(n)) + "</ol></li>"
        start = time.monotonic()
        assert pages.comments(_pages(spark, html), "page", "html").filter("body = concat('b', id)").count() == n
        seconds[n] = time.monotonic() - start
    assert seconds[4000] < 6 * max(seconds[1000], 0.7)


def test_nested_sections_and_tables(spark):
    """An element belongs to the nearest section around it, also behind a section inside its own."""
    html = "<ul><li id=a><i>1</i><ul><li id=b><i>2</i></li></ul><i>3</i></li></ul><i>4</i>"
    found = elements(_pages(spark, html), "page", "html", {"li": Selector("li"), "i": Selector("i")}, ["li"])
    got = x.section_fields(found, "page", "li", {"id": x.first("li", x.attr("id")), "texts": x.joined("i", x.own_text(), ",")})
    assert sorted((r.id, r.texts) for r in got.collect()) == [("a", "1,3"), ("b", "2")]
    html = "<table><tr><th>h</th></tr><tr><td>x<table><tr><th>k</th></tr><tr><td>y</td></tr></table></td></tr><tr><td>z</td></tr></table><tr><td>q</td></tr>"
    chosen = {"table": Selector("table"), "th": Selector("th"), "tr": Selector("tr"), "td": Selector("td")}
    tables = elements(_pages(spark, html), "page", "html", chosen, {"table": ["tr"]})
    got = x.table_rows(tables, "page", "table", "th", "tr", "td").collect()
    assert sorted((r.headers, r.cells, r.valid) for r in got) == [(["h"], ["x"], True), (["h"], ["z"], True), (["k"], ["y"], True)]


def test_batches_of_elements_are_bounded(spark):
    """However many pages come in one batch, their elements go on in batches of a bounded number."""
    source = "<p>x</p>" * 10
    batch = pa.record_batch({"page": pa.array(range(2000)), "html": pa.array([source] * 1999 + [None])})
    types = to_arrow_schema(elements(_pages(spark, source), "page", "html", {"p": Selector("p")}).schema)
    sizes = [b.num_rows for b in html._scan(iter([batch, batch]), {"p": Selector("p")}, types, {})]
    assert sum(sizes) == 2 * 1999 and max(sizes) <= html._ELEMENTS / 10


def test_pages_from_a_join_use_every_core(spark, tmp_path):
    """The optimizer takes a join for the product of its sides; few files are dealt out all the same, equal keys too."""
    for name in ("a", "b"):
        made = spark.range(20_000).select((F.col("id") % 5000).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias(name))
        made.coalesce(1).write.parquet(str(tmp_path / name))
    a, b = (spark.read.parquet(str(tmp_path / name)) for name in ("a", "b"))
    made = a.join(b, "k").select(F.lit(None).cast("long").alias("page"), F.concat(F.lit("<p>"), "a", "b").alias("html"))
    dealt = spread(made, "page", "html")
    assert "RepartitionByExpression" in dealt._jdf.queryExecution().optimizedPlan().toString()
    assert dealt.select(F.spark_partition_id()).distinct().count() >= spark.sparkContext.defaultParallelism
    found = elements(made, "page", "html", {"p": Selector("p")})
    assert "RepartitionByExpression" in found._jdf.queryExecution().optimizedPlan().toString()


def test_parts_grow_with_the_input(spark, tmp_path, monkeypatch):
    spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h")).write.parquet(str(tmp_path / "t"))
    monkeypatch.setattr(session, "_SHARE", 1 << 14)
    assert spread(spark.read.parquet(str(tmp_path / "t")), "id").rdd.getNumPartitions() > 20


def test_two_bio_locations_fail(spark):
    spot = '<p class="f5 bold mb0">x</p>'
    with pytest.raises(Exception, match="too many elements"):
        pages.creator_bios(_pages(spark, spot + spot), "page", "html").rows.collect()


def test_conflicting_markers(spark):
    both = '<div id="event_page"></div><div id="custom_share"></div>'
    hidden = '<!--<div id="event_page">--><div id="custom_share"></div>'
    got = x.classify(_pages(spark, both, hidden, ""), "html", page_specs.PAGE_MARKERS)
    assert [r.page_type for r in got.orderBy("page").collect()] == ["conflict", "special_user", "unknown"]


def test_timeline_rejects_unknown_entries(spark):
    html = '<div class="timeline"><div class="timeline__new"><h2>t</h2></div></div>'
    with pytest.raises(Exception, match="unknown or untitled entry"):
        pages.timeline(_pages(spark, html), "page", "html").collect()


def test_table_width_is_checked(spark):
    html = (
        '<table id="proxylisttable"><thead><tr><th>IP Address</th><th>Port</th><th>Anonymity</th></tr></thead><tbody>'
        "<tr><td>1.1.1.1</td><td>80</td><td>anonymous</td></tr><tr><td>short</td></tr></tbody></table>"
    )
    good, bad = pages.proxies(_pages(spark, html), "page", "html")
    assert rows(good) == [(0, "1.1.1.1:80")]
    assert bad.select(F.size("cells")).collect()[0][0] == 1


def test_parse_batch_routes_and_reports(spark):
    store = spark.createDataFrame(
        [
            ("s/a", "<body><div id='custom_share'></div>", None),
            ("s/b", '<body><div id="custom_share"></div>\xe9', None),
            ("s/c", "<p>x</p>", None),
            ("s/d", '<div id="custom_share"></div>', "2024-01-05"),
            ("s/e", None, None),
        ],
        "loc string, html string, last_scrape string",
    ).withColumn("last_scrape", F.col("last_scrape").cast("timestamp_ntz"))
    listed = store.select("loc", F.lit("2024-01-04").cast("timestamp_ntz").alias("lastmod"), F.array(F.lit("users")).alias("categories"))
    batch = pages.parse_batch(store, listed, "s", "s", F.lit("2024-02-01").cast("timestamp_ntz"))
    assert rows(batch.tables["special_user"]) == [("s/b",)]
    assert rows(batch.bad_encoding) == [("s/b",)]
    assert rows(batch.unknown) == [("s/a",), ("s/c",)]
    assert [r.loc for r in batch.done.collect()] == ["s/b"]
