"""File scans and sinks: tables are written out by Spark in the source's format and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pledgeflow.functions import text
from pledgeflow.functions.urls import relative_path
from pledgeflow.operators.ordering import running_total
from pledgeflow.plans import sitemap as sitemap_plan
from pledgeflow.queries.registry import query
from pledgeflow.session import work_path
from pledgeflow.sources import fetchlog, files, sinks, sitemap


@query(
    "scan_csv_json_path",
    """select event_id as id, 'https://site.example/projects/' || user_id || '/' || event_type as url from events""",
)
def scan_csv_json_path(t):
    url = F.concat(
        F.when(F.col("event_id") % 2 == 0, "http").otherwise("https"),
        F.lit("://site.example/projects/"),
        F.col("user_id").cast("string"),
        F.lit("/"),
        "event_type",
        F.lit("?ref=a,b"),
    )
    urls = F.to_json(F.struct(F.struct(url.alias("project")).alias("web")))
    folder = work_path(t.spark, "csv")
    t.events.select(F.col("event_id").alias("id"), urls.alias("urls")).write.option("header", True).option(
        "escape", '"'
    ).csv(f"{folder}/2024/a")
    return files.csv_json_path(t.spark, folder, "id bigint, urls string", "id", "urls", "$.web.project")


@query(
    "scan_recursive",
    """select lang, count(*) as n, sum(octet_length(encode(source))) ::bigint as bytes from documents group by 1""",
)
def scan_recursive(t):
    folder = work_path(t.spark, "tree")
    t.documents.select("lang", "source").write.partitionBy("lang").text(folder)
    found = files.recursive_files(t.spark, folder, "*.txt")
    return (
        found.select(
            F.regexp_extract("path", "lang=([^/]*)", 1).alias("lang"), F.explode(F.split("text", "\n")).alias("line")
        )
        .filter("line <> ''")
        .groupBy("lang")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("line")).alias("bytes"))
    )


@query(
    "scan_json_pages",
    """select o_orderkey as id, o_orderstatus as status, o_totalprice as funded_amount from orders""",
)
def scan_json_pages(t):
    folder = work_path(t.spark, "pages")
    loan = F.struct(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("funded_amount"),
    )
    t.orders.select(F.array(loan).alias("loans")).write.json(f"{folder}/loans")
    found = files.json_categories(t.spark, folder, {"loans": "id bigint, status string, funded_amount double"})
    return found["loans"].drop("file")


_SITEMAP_SQL = """select o_orderkey as k, 'https://site.example/' || o_custkey as loc,
        case o_orderstatus when 'O' then 'users' when 'F' then 'fundraisers' else 'static' end as category,
        case when o_orderkey % 5 <> 0 then o_orderdate end as lastmod,
        case when o_orderkey % 3 = 0 then 'daily' end as changefreq from orders"""


def _write_xml(entries, root, folder, *partitions):
    """XML files with one root each, of at most 5000 entries (keys are unique)."""
    document = F.concat(
        F.lit(f'<?xml version="1.0"?><{root} xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'),
        F.array_join(F.collect_list("entry"), ""),
        F.lit(f"</{root}>"),
    )
    number = F.expr("o_orderkey div 5000").alias("number")
    documents = entries.groupBy(*partitions, number).agg(document.alias("value")).drop("number")
    documents.write.partitionBy(*partitions).option("maxRecordsPerFile", 1).text(folder)


def _write_sitemaps(t):
    category = (
        F.when(F.col("o_orderstatus") == "O", "users")
        .when(F.col("o_orderstatus") == "F", "fundraisers")
        .otherwise("static")
    )
    lastmod = F.when(F.col("o_orderkey") % 5 == 0, F.lit("-0001-11-30")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    )
    bad = F.when(F.col("o_orderkey") % 11 == 0, F.lit("&amp;bad")).otherwise(F.lit(""))
    entry = F.concat(
        F.lit("<url><loc> https://site.example/"),
        F.col("o_custkey").cast("string"),
        bad,
        F.lit("</loc><lastmod>"),
        lastmod,
        F.lit("</lastmod>"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit("<changefreq> daily </changefreq>")).otherwise(F.lit("")),
        F.lit("</url>"),
    )
    folder = work_path(t.spark, "sitemap")
    entries = t.orders.select(category.alias("category"), "o_orderkey", entry.alias("entry"))
    _write_xml(entries, "urlset", folder, "category")
    return folder


@query(
    "scan_sitemap_xml",
    f"""with s as ({_SITEMAP_SQL})
    select case when k % 11 = 0 then loc || '&bad' else loc end as loc, category, lastmod, changefreq,
        count(*) as n from s group by all""",
)
def scan_sitemap_xml(t):
    rows = sitemap.sitemap_urls(t.spark, _write_sitemaps(t))
    category = F.replace("category", F.lit("category="), F.lit(""))
    return (
        rows.withColumn("category", category)
        .groupBy("loc", "category", "lastmod", "changefreq")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "sitemap_index",
    """select 'https://site.example/sitemap/xml/' || o_orderkey as loc from orders where o_orderkey % 3 = 0""",
)
def sitemap_index(t):
    path = F.when(F.col("o_orderkey") % 3 == 0, F.lit("sitemap/xml/")).otherwise(F.lit("other/"))
    entry = F.concat(
        F.lit("<sitemap><loc>http://site.example/"), path, F.col("o_orderkey").cast("string"), F.lit("/</loc></sitemap>")
    )
    folder = work_path(t.spark, "index")
    _write_xml(t.orders.select("o_orderkey", entry.alias("entry")), "sitemapindex", folder)
    return sitemap.sitemap_index(t.spark, folder, "site.example/sitemap/xml", "https://site.example")


@query(
    "sitemap_merge",
    f"""with s as ({_SITEMAP_SQL} where o_orderkey % 11 <> 0),
    g as (select loc, category, max(lastmod) as lastmod, max(changefreq) as changefreq from s group by 1, 2),
    both_listed as (select a.loc from g a join g b on a.loc = b.loc and a.category = 'users' and b.category = 'fundraisers'),
    r as (select case when category = 'fundraisers' and loc in (select loc from both_listed)
            then loc || '/fundraiser/' || replace(loc, 'https://site.example/', '') else loc end as loc,
            category, lastmod, changefreq from g),
    n as (select loc, list_sort(list(category)) as categories, max(lastmod) as lastmod, max(changefreq) as changefreq
        from r group by 1),
    old as (select 'https://site.example/' || c_custkey as loc, ['old'] as categories,
        timestamp '2000-06-01' as lastmod, 'weekly' as changefreq from customer where c_acctbal < 3000)
    select coalesce(old.loc, n.loc) as loc,
        array_to_string(list_sort(case when old.loc is null then n.categories when old.lastmod < n.lastmod
            then list_distinct(list_concat(old.categories, n.categories)) else old.categories end), ',') as categories,
        case when old.loc is null or old.lastmod < n.lastmod then n.lastmod else old.lastmod end as lastmod,
        case when old.loc is null or old.lastmod < n.lastmod then n.changefreq else old.changefreq end as changefreq
    from old full join n on old.loc = n.loc""",
)
def sitemap_merge(t):
    scanned = sitemap.sitemap_urls(t.spark, _write_sitemaps(t)).withColumn(
        "category", F.replace("category", F.lit("category="), F.lit(""))
    )
    stored = t.customer.filter("c_acctbal < 3000").select(
        F.concat(F.lit("https://site.example/"), F.col("c_custkey").cast("string")).alias("loc"),
        F.array(F.lit("old")).alias("categories"),
        F.to_timestamp_ntz(F.lit("2000-06-01 00:00:00")).alias("lastmod"),
        F.lit("weekly").alias("changefreq"),
        F.lit(None).cast("decimal(38,10)").alias("priority"),
        F.array(F.lit("old.xml")).alias("origin_files"),
    )
    merged = sitemap_plan.merge_sitemap(stored, scanned, r"https://site\.example", "https://site.example/").table
    return merged.select("loc", F.array_join(F.array_sort("categories"), ",").alias("categories"), "lastmod", "changefreq")


@query(
    "pages_to_download",
    """with s as (select distinct 'https://site.example/' || o_custkey as loc, o_orderstatus as c from orders)
    select distinct loc from s union select a.loc || '/fundraiser/' || replace(a.loc, 'https://site.example/', '')
    from s a join s b on a.loc = b.loc and a.c = 'O' and b.c = 'F'""",
)
def pages_to_download(t):
    category = F.when(F.col("o_orderstatus") == "O", "users").when(F.col("o_orderstatus") == "F", "fundraisers")
    listed = t.orders.select(
        F.concat(F.lit("https://site.example/"), F.col("o_custkey").cast("string")).alias("loc"),
        category.alias("category"),
    )
    return sitemap_plan.pages_to_download(listed, "https://site.example/")


@query(
    "sitemap_bad_urls",
    "select distinct 'https://site.example/' || o_custkey || '&bad' as loc from orders where o_orderkey % 11 = 0",
)
def sitemap_bad_urls(t):
    scanned = sitemap.sitemap_urls(t.spark, _write_sitemaps(t))
    rejected = sitemap_plan.split_valid(scanned, r"https://site\.example")[1]
    return rejected.select("loc").distinct()


@query(
    "scan_url_list",
    "select url, replace(url, 'https://', '') as path from pages",
)
def scan_url_list(t):
    folder = work_path(t.spark, "urls")
    t.pages.select("url").write.text(folder)
    return files.url_list(t.spark, folder)


@query(
    "skip_first_n",
    """with r as (select page_id, url, row_number() over (order by page_id) as rn from pages)
    select page_id as id, 'https://site.example/k=' || page_id % 16 as url from r
    where rn > 20 and page_id % 16 not in (3, 5)""",
)
def skip_first_n(t):
    folder = work_path(t.spark, "skip")
    bucket = (F.col("page_id") % 16).cast("string")
    url = F.concat(F.lit("https://site.example/k="), bucket)
    numbered = running_total(t.pages.select("page_id"), ["page_id"], out="position")
    numbered.select("position", F.col("page_id").alias("id"), url.alias("url")).write.csv(f"{folder}/listing")
    some = t.pages.filter("page_id % 16 not in (3, 5)").select(bucket.alias("k"), F.md5("html").alias("value"))
    some.write.partitionBy("k").text(f"{folder}/pages/site.example")
    listing = t.spark.read.schema("position bigint, id bigint, url string").csv(f"{folder}/listing")
    stored = files.stored_files(t.spark, f"{folder}/pages")
    pages = stored.select(F.regexp_replace("path", "/[^/]*$", "").alias("path"))
    return files.remaining_paths(listing, pages, 20).select("id", "url")


@query(
    "scan_binary_new",
    """select lang, cast(sum(octet_length(encode(source)) + 1) as bigint) as bytes from documents
    where lang <> 'en' group by 1""",
)
def scan_binary_new(t):
    folder = work_path(t.spark, "raw")
    t.documents.select("lang", "source").write.partitionBy("lang").text(folder)
    stored = files.stored_files(t.spark, folder)
    loaded = stored.filter(F.col("path").startswith("lang=en")).select(F.col("path").alias("url"))
    fresh = files.new_binary_files(stored, loaded).filter("last_scrape is not null")
    lang = F.regexp_extract("url", "lang=([^/]*)/", 1)
    return (
        fresh.groupBy(lang.alias("lang")).agg(F.sum(F.octet_length("html")).alias("bytes")).filter("lang <> ''")
    )


@query(
    "scan_ctrl_delim",
    """select c_custkey, c_name, nullif(c_mktsegment, 'BUILDING') as segment, c_acctbal from customer""",
)
def scan_ctrl_delim(t):
    folder = work_path(t.spark, "ctrl")
    rows = t.customer.select(
        "c_custkey", "c_name", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"), "c_acctbal"
    )
    rows.write.option("sep", "\x0e").option("quote", "").option("escape", "\\").option("nullValue", "").csv(folder)
    return files.control_delimited(
        t.spark, folder, "c_custkey bigint, c_name string, segment string, c_acctbal double"
    )


@query(
    "decode_ctrl_text",
    """select 'https://site.example/' || doc_id as loc, '200 OK' as server_code,
        md5(replace(text, chr(13), '')) as body from documents""",
)
def decode_ctrl_text(t):
    folder = work_path(t.spark, "encoded")
    line = F.concat_ws(
        "|",
        F.concat(F.lit("https://site.example/"), F.col("doc_id").cast("string"), F.lit("/")),
        F.lit("200 OK"),
        F.lit("2024-01-02 03:04:05"),
        text.encode_controls(F.col("text")),
    )
    t.documents.select(line.alias("value")).write.text(folder)
    pages = files.encoded_pages(t.spark, folder)
    return pages.select("loc", "server_code", F.md5("html").alias("body"))


@query("scan_tsv_many", "select s_suppkey, s_name, s_acctbal from supplier")
def scan_tsv_many(t):
    folder = work_path(t.spark, "tsv")
    rows = t.supplier.select("s_suppkey", "s_name", "s_acctbal")
    rows.repartition(4).write.option("sep", "\t").option("header", True).csv(folder)
    return files.tsv_parts(t.spark, f"{folder}/*.csv", "s_suppkey bigint, s_name string, s_acctbal double")


@query("snapshot_roundtrip", "select o_orderkey, o_totalprice, o_orderdate from orders")
def snapshot_roundtrip(t):
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderdate")
    return t.spark.read.parquet(sinks.write_version(rows, work_path(t.spark, "versions"), "1")).drop("version")


@query(
    "split_concat_docs",
    """select md5(rtrim(replace(html, '<!DOCTYPE html>', ''), chr(10) || chr(13))) as digest, count(*) as n from pages
    group by 1""",
)
def split_concat_docs(t):
    folder = work_path(t.spark, "concat")
    t.pages.select(F.col("html").alias("value")).write.text(folder)
    docs = files.documents_by_marker(t.spark, folder, "<!DOCTYPE html>")
    return docs.groupBy(F.md5("document").alias("digest")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "split_bodies",
    r"""select page_id, cast(len(regexp_extract_all(html, '(?s)<body.*?/body>')) as bigint) as n,
        md5(array_to_string(regexp_extract_all(html, '(?s)<body.*?/body>'), '')) as digest from pages""",
)
def split_bodies(t):
    found = files.bodies(F.col("html"))
    return t.pages.select(
        "page_id", F.size(found).cast("long").alias("n"), F.md5(F.array_join(found, "")).alias("digest")
    )


_LOG_SQL = """select 'http://site.example/' || o_orderkey as url, strftime(o_orderdate, '%Y-%m-%d') || ' 10:00:00' as fetched_at,
        case when o_orderkey % 3 = 0 then '301 Moved > https://site.example/' || o_orderkey || ' > 200 OK'
            when o_orderkey % 3 = 1 then '404 Not Found'
            else '302 Found > http://site.example/again > 302 Found > Redirections Exceeded' end as chain,
        case when o_orderkey % 3 = 1 then 1 when o_orderkey % 3 = 0 then 3 else 4 end ::bigint as pieces
    from orders"""


@query("fetch_log", _LOG_SQL)
def fetch_log(t):
    key = F.col("o_orderkey").cast("string")
    stamp = F.concat(F.lit("--"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" 10:00:00--  "))
    opening = F.concat(stamp, F.lit("http://site.example/"), key)
    response = F.lit("HTTP request sent, awaiting response... ")
    secure = F.concat(F.lit("https://site.example/"), key)
    again = F.lit("http://site.example/again")

    def redirect(target):
        return F.concat(F.lit("Location: "), target, F.lit(" [following]"))

    moved = F.array(
        opening, F.concat(response, F.lit("301 Moved")), redirect(secure), F.concat(stamp, secure),
        F.concat(response, F.lit("200 OK")), F.lit("Length: unspecified [text/html]"),
    )
    gone = F.array(opening, F.concat(response, F.lit("404 Not Found")), F.lit("ERROR 404: Not Found."))
    loop = F.array(
        opening, F.concat(response, F.lit("302 Found")), redirect(again), F.concat(stamp, again),
        F.concat(response, F.lit("302 Found")), F.lit("20 redirections exceeded."),
    )
    lines = F.when(F.col("o_orderkey") % 3 == 0, moved).when(F.col("o_orderkey") % 3 == 1, gone).otherwise(loop)
    folder = work_path(t.spark, "log")
    t.orders.select(F.explode(lines).alias("value")).write.text(folder)
    return fetchlog.fetch_log(files.text_lines(t.spark, folder)).select("url", "fetched_at", "chain", "pieces")


@query(
    "fetch_log_brief",
    """select 'http://site.example/' || o_orderkey as url, case when o_orderkey % 4 <> 0 then 'page.' || o_orderkey end
        as output_file, case when o_orderkey % 4 = 0 then 404 end as error_code,
        strftime(o_orderdate, '%Y-%m-%d') || ' 10:00:00' as fetched_at from orders""",
)
def fetch_log_brief(t):
    key = F.col("o_orderkey").cast("string")
    url = F.concat(F.lit("http://site.example/"), key)
    stamp = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" 10:00:00"))
    stored = F.array(F.concat(stamp, F.lit(" URL:"), url, F.lit(' [88/88] -> "page.'), key, F.lit('" [1]')))
    failed = F.array(F.concat(url, F.lit(":")), F.concat(stamp, F.lit(" ERROR 404: Not Found.")))
    folder = work_path(t.spark, "brief")
    lines = F.when(F.col("o_orderkey") % 4 == 0, failed).otherwise(stored)
    t.orders.select(F.explode(lines).alias("value")).write.text(folder)
    rows = fetchlog.brief_log(files.text_lines(t.spark, folder))
    return rows.select("url", "output_file", "error_code", "fetched_at")


# --- sinks -------------------------------------------------------------------


@query("csv_tables", "select n_nationkey as k, n_name as name from nation union all select r_regionkey, r_name from region")
def csv_tables(t):
    folder = work_path(t.spark, "tables")
    paths = sinks.write_csv_tables({"nation": t.nation, "region": t.region}, folder)
    read = t.spark.read.option("header", True)
    nation = read.schema("n_nationkey int, n_name string, n_regionkey int").csv(paths["nation"])
    region = read.schema("r_regionkey int, r_name string").csv(paths["region"])
    return nation.select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name")).union(region)


@query("chunk_files", "select count(*) as n, 0::bigint as over_limit from lineitem")
def chunk_files(t):
    folder = work_path(t.spark, "chunks")
    sinks.write_chunked(t.lineitem.select("l_orderkey", "l_linenumber"), folder, 10_000)
    rows = t.spark.read.schema("l_orderkey bigint, l_linenumber int").option("header", True).csv(folder)
    per_file = rows.groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(
        F.sum("n").alias("n"), F.coalesce(F.sum((F.col("n") > 10_000).cast("long")), F.lit(0)).alias("over_limit")
    )


@query(
    "partition_manifest",
    """select cast(year(o_orderdate) as bigint) as start_year, o_orderstatus as category,
        'start_year=' || year(o_orderdate) || '/category=' || o_orderstatus as path, count(*) as n,
        round(sum(o_totalprice), 2) as pledged from orders group by all""",
)
def partition_manifest(t):
    folder = work_path(t.spark, "json")
    rows = t.orders.select(
        F.col("o_orderkey").alias("project_id"),
        F.col("o_totalprice").alias("pledged"),
        F.year("o_orderdate").alias("start_year"),
        F.col("o_orderstatus").alias("category"),
    )
    manifest = sinks.write_partitioned_json(rows, folder, "start_year", "category")
    schema = "project_id bigint, pledged double, start_year int, category string"
    stored = t.spark.read.schema(schema).json(folder).groupBy("start_year", "category")
    counted = stored.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("pledged"), 2).alias("pledged"))
    return manifest.join(counted, ["start_year", "category"]).withColumn(
        "start_year", F.col("start_year").cast("long")
    )


@query("replace_table", "select o_custkey, count(*) as n from orders group by 1")
def replace_table(t):
    name = f"loans_{uuid.uuid4().hex}"
    sinks.replace_table(t.orders.select("o_custkey", "o_orderkey"), name, ["o_custkey"], 8)
    return t.spark.table(name).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
