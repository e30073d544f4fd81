"""Projections, filters, joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from pledgeflow.operators import filters, ordering
from pledgeflow.operators import reconcile as rec
from pledgeflow.plans import loans
from pledgeflow.queries.common import US_SQL, us_projects
from pledgeflow.queries.registry import query

# --- projections and filters -------------------------------------------------


@query(
    "project_rename",
    """select o_orderkey as loan_id, o_orderstatus as loan_status, o_totalprice as funded_amount,
        cast(o_orderdate as date) as posted_date from orders""",
)
def project_rename(t):
    return t.orders.select(
        F.col("o_orderkey").alias("loan_id"),
        F.col("o_orderstatus").alias("loan_status"),
        F.col("o_totalprice").alias("funded_amount"),
        F.to_date("o_orderdate").alias("posted_date"),
    )


@query(
    "project_dynamic",
    "select l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice from lineitem",
)
def project_dynamic(t):
    wanted = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_quantity", "l_extendedprice"]
    columns = list(dict.fromkeys(wanted))
    return t.lineitem.select(*columns)


@query("filter_live", "select o_orderkey, o_custkey from orders where o_orderstatus = 'O'")
def filter_live(t):
    return t.orders.filter(F.col("o_orderstatus") == "O").select("o_orderkey", "o_custkey")


@query(
    "filter_in_stale",
    """select event_id, user_id from events where event_type in ('view', 'click', 'signup')
        and date_diff('microsecond', ts, timestamp '2024-01-20 12:00:00') / 86400e6 > 0.5""",
)
def filter_in_stale(t):
    stale = filters.open_and_stale(
        t.events, "event_type", ["view", "click", "signup"], "ts", "2024-01-20 12:00:00"
    )
    return stale.select("event_id", "user_id")


@query(
    "filter_nulls",
    """select o_orderkey, case when o_custkey % 5 = 0 then null else o_custkey end as owner from orders
    where (o_custkey % 5 = 0) <> (o_orderstatus = 'O')""",
)
def filter_nulls(t):
    df = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_custkey") % 5 != 0, F.col("o_custkey")).alias("owner"),
        "o_orderstatus",
    )
    live = F.col("o_orderstatus") == "O"
    kept = df.filter((F.col("owner").isNull() & ~live) | (F.col("owner").isNotNull() & live))
    return kept.select("o_orderkey", "owner")


@query(
    "export_between",
    """select l_orderkey, l_linenumber, l_extendedprice, o_orderdate, c_name, c_mktsegment
    from lineitem join (orders left join customer on o_custkey = c_custkey and c_acctbal > 0) on l_orderkey = o_orderkey
    where cast(o_orderdate as date) between date '1997-03-01' and date '1998-02-28'""",
)
def export_between(t):
    parents = filters.between_dates(t.orders, "o_orderdate", "1997-03-01", "1998-02-28").join(
        t.customer.filter("c_acctbal > 0"), F.col("o_custkey") == F.col("c_custkey"), "left"
    )
    joined = t.lineitem.join(parents, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "o_orderdate", "c_name", "c_mktsegment"
    )


@query(
    "finished_quarters",
    """select o_orderkey from orders where not (year(o_orderdate) = 2001 and quarter(o_orderdate) = 2)""",
)
def finished_quarters(t):
    return filters.finished_quarters(t.orders, "o_orderdate", "2001-05-05 00:00:00").select("o_orderkey")


@query(
    "like_filters",
    """select p_partkey, p_name from part where p_name like '%re%' and p_name not like 'small%'
        and replace(p_brand, '#', '_') like 'Brand/_1%' escape '/'""",
)
def like_filters(t):
    df = t.part.withColumn("code", F.replace("p_brand", F.lit("#"), F.lit("_")))
    kept = df.filter(
        F.col("p_name").like("%re%") & ~F.col("p_name").like("small%") & filters.like_escaped("code", "Brand/_1%")
    )
    return kept.select("p_partkey", "p_name")



@query(
    "array_any_all",
    """with a as (select p_partkey, list_filter([case when p_size > 25 then p_type end,
            case when p_size % 2 = 0 then 'static' end], lambda x: x is not null) as tags from part)
    select p_partkey, list_contains(tags, 'static') as has_static,
        len(list_filter(tags, lambda x: x <> 'static')) = 0 as only_static from a
    where not (len(list_filter(tags, lambda x: x <> 'static')) = 0 and len(tags) > 0)""",
)
def array_any_all(t):
    tags = F.filter(
        F.array(
            F.when(F.col("p_size") > 25, F.col("p_type")),
            F.when(F.col("p_size") % 2 == 0, F.lit("static")),
        ),
        lambda x: x.isNotNull(),
    )
    df = t.part.select("p_partkey", tags.alias("tags"))
    only = filters.only_holds(F.col("tags"), "static")
    return df.filter(~(only & (F.size("tags") > 0))).select(
        "p_partkey", filters.holds(F.col("tags"), "static").alias("has_static"), only.alias("only_static")
    )


@query(
    "high_watermark",
    """select event_id, ts from events
    where ts > coalesce((select max(ts) from events where event_type = 'view' and ts < timestamp '2024-01-15'),
        timestamp '1970-01-01')""",
)
def high_watermark(t):
    stored = t.events.filter("event_type = 'view' and ts < timestamp_ntz'2024-01-15'")
    return filters.newer_than_stored(t.events, "ts", stored, "ts").select("event_id", "ts")


@query(
    "high_watermark_empty",
    "select count(*) as n from events",
)
def high_watermark_empty(t):
    stored = t.events.filter("value < 0 and value > 0")
    return filters.newer_than_stored(t.events, "ts", stored, "ts").agg(F.count(F.lit(1)).alias("n"))


@query(
    "needs_refresh",
    """with listed as (select o_orderkey as loc, case when o_orderkey % 9 <> 0 then o_orderdate end as modified
            from orders),
    fetched as (select o_orderkey as loc, case when o_orderkey % 5 <> 0
            then o_orderdate + to_days(cast(o_custkey % 5 - 2 as integer)) end as fetched_at
            from orders where o_orderpriority <> '1-URGENT')
    select l.loc from listed l left join fetched f on l.loc = f.loc
    where f.loc is null or l.modified > f.fetched_at or (f.fetched_at is null and l.modified is not null)""",
)
def needs_refresh(t):
    listed = t.orders.select(
        F.col("o_orderkey").alias("loc"),
        F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderdate")).alias("modified"),
    )
    shifted = F.col("o_orderdate") + F.make_dt_interval(days=(F.col("o_custkey") % 5 - 2).cast("int"))
    fetched = t.orders.filter("o_orderpriority <> '1-URGENT'").select(
        F.col("o_orderkey").alias("loc"),
        F.when(F.col("o_orderkey") % 5 != 0, shifted).alias("fetched_at"),
    )
    return filters.needs_refresh(listed, fetched, "loc", "modified", "fetched_at").select("loc")


@query(
    "url_path_shape",
    """with u as (select doc_id, 'https://site.example/' || lang ||
            case when doc_id % 3 = 0 then '' else '/fundraiser/' || case when doc_id % 2 = 0 then lang else source end
            end as url from documents)
    select doc_id, url from u
    where split_part(url, '/', 4) = split_part(url, '/', 6) or split_part(url, '/', 6) = ''""",
)
def url_path_shape(t):
    tail = F.when(F.col("doc_id") % 2 == 0, F.col("lang")).otherwise(F.col("source"))
    suffix = F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("/fundraiser/"), tail))
    urls = t.documents.select(
        "doc_id", F.concat(F.lit("https://site.example/"), F.col("lang"), suffix).alias("url")
    )
    return urls.filter(filters.flat_path(F.col("url")))


@query(
    "mask_dropna",
    """select s_suppkey, s_name || ':' || cast(port as varchar) as proxy from (
        select s_suppkey, s_name, case when s_suppkey % 4 <> 0 then 8000 + s_nationkey end as port,
            case when s_suppkey % 3 = 0 then 'elite' when s_suppkey % 3 = 1 then 'anonymous' else 'open' end as kind
        from supplier) where kind in ('elite', 'anonymous') and port is not null""",
)
def mask_dropna(t):
    rows = t.supplier.select(
        "s_suppkey",
        "s_name",
        F.when(F.col("s_suppkey") % 4 != 0, F.lit(8000) + F.col("s_nationkey")).alias("port"),
        F.when(F.col("s_suppkey") % 3 == 0, "elite")
        .when(F.col("s_suppkey") % 3 == 1, "anonymous")
        .otherwise("open")
        .alias("kind"),
    )
    kept = filters.mask_dropna(rows, F.col("kind").isin("elite", "anonymous"))
    return kept.select("s_suppkey", F.concat_ws(":", "s_name", F.col("port").cast("string")).alias("proxy"))


# --- joins -------------------------------------------------------------------


@query("join_inner", f"select o_orderkey, c_name, n_name from {US_SQL}")
def join_inner(t):
    return us_projects(t).select("o_orderkey", "c_name", "n_name")


@query(
    "join_left",
    """select o_orderkey, c_name from orders left join customer on o_custkey = c_custkey and c_acctbal > 0""",
)
def join_left(t):
    solvent = t.customer.filter("c_acctbal > 0")
    return t.orders.join(solvent, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "c_name")


@query(
    "anti_left_null",
    "select o_orderkey, o_orderstatus from orders left join lineitem on o_orderkey = l_orderkey"
    " where l_orderkey is null",
)
def anti_left_null(t):
    return rec.missing(t.orders, t.lineitem, {"o_orderkey": "l_orderkey"}).select("o_orderkey", "o_orderstatus")


@query(
    "anti_not_exists",
    """select doc_id, n_chars from documents d
    where not exists (select 1 from labels l where l.doc_id = d.doc_id) and n_chars > 0""",
)
def anti_not_exists(t):
    docs = t.documents.filter("n_chars > 0")
    return rec.missing(docs, t.labels, {"doc_id": "doc_id"}).select("doc_id", "n_chars")


@query(
    "anti_first_url",
    """select o_custkey, min('https://site.example/' || o_orderkey) as url from orders
    where not exists (select 1 from customer where c_custkey = o_custkey and c_acctbal > 0)
    group by 1""",
)
def anti_first_url(t):
    bios = t.customer.filter("c_acctbal > 0")
    todo = rec.missing(t.orders, bios, {"o_custkey": "c_custkey"}).select(
        "o_custkey", F.concat(F.lit("https://site.example/"), F.col("o_orderkey").cast("string")).alias("url")
    )
    return rec.first_url_per_id(todo, "o_custkey", "url")


@query(
    "semi_grouped",
    """select o_orderkey, o_totalprice from orders join (select l_orderkey from lineitem
        join supplier on l_suppkey = s_suppkey where s_nationkey < 5 group by 1) on l_orderkey = o_orderkey""",
)
def semi_grouped(t):
    links = t.lineitem.join(
        t.supplier.filter("s_nationkey < 5"), F.col("l_suppkey") == F.col("s_suppkey"), "left_semi"
    )
    return rec.present(t.orders, links, {"o_orderkey": "l_orderkey"}).select("o_orderkey", "o_totalprice")


@query(
    "semi_links",
    """select distinct l_orderkey, l_suppkey from lineitem join supplier on l_suppkey = s_suppkey
    where s_nationkey < 5""",
)
def semi_links(t):
    links = rec.distinct_keys(t.lineitem, ["l_orderkey", "l_suppkey"])
    return rec.present(links, t.supplier.filter("s_nationkey < 5"), {"l_suppkey": "s_suppkey"})


@query(
    "self_join_category",
    """select distinct t2.o_custkey || '/fundraiser/' || t2.o_custkey as loc from orders t1
    join orders t2 on t1.o_custkey = t2.o_custkey and t1.o_orderpriority = '1-URGENT'
        and t2.o_orderpriority = '5-LOW'""",
)
def self_join_category(t):
    both = rec.in_both_categories(t.orders, "o_custkey", "o_orderpriority", "1-URGENT", "5-LOW")
    key = F.col("o_custkey").cast("string")
    return both.select(F.concat(key, F.lit("/fundraiser/"), key).alias("loc"))


@query(
    "count_mismatch",
    """with p as (select o_orderkey as id, o_custkey % 8 as declared,
            case when o_orderkey % 4 = 0 then o_custkey % 3 end as deleted from orders)
    select id, declared - coalesce(deleted, 0) as expected_count,
        coalesce((select count(*) from lineitem where l_orderkey = id), 0) as stored_count,
        coalesce((select max(l_partkey) from lineitem where l_orderkey = id), 0) as last_child_id
    from p where declared - coalesce(deleted, 0) > 0
        and declared - coalesce(deleted, 0) <> (select count(*) from lineitem where l_orderkey = id)""",
)
def count_mismatch(t):
    parents = t.orders.select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_custkey") % 8).alias("declared"),
        F.when(F.col("o_orderkey") % 4 == 0, F.col("o_custkey") % 3).alias("deleted"),
    )
    plan = rec.count_mismatch(parents, t.lineitem, "id", "declared", "deleted", "l_orderkey", "l_partkey")
    return plan.select("id", "expected_count", "stored_count", "last_child_id")


@query(
    "ordered_lookup",
    """with r as (select o_orderkey as id, row_number() over (order by o_orderkey) as row_num from orders)
    select row_num, id, quality from r left join labels on id = doc_id order by row_num""",
)
def ordered_lookup(t):
    ids = t.orders.select(F.col("o_orderkey").alias("id"))
    requests = ordering.running_total(ids, ["id"], out="row_num")
    store = t.labels.select(F.col("doc_id").alias("id"), "quality")
    return rec.ordered_lookup(requests, store, "id", "row_num").select("row_num", "id", "quality")


@query(
    "first_match_merge",
    """with p as (select o_orderkey as id, case when o_orderkey % 2 = 0 then o_totalprice end as amount,
            o_orderstatus as status from orders),
    s as (select l_orderkey as id, l_extendedprice as amount, l_returnflag as flag, row_number() over (
            partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) as rn from lineitem)
    select p.id, coalesce(p.amount, s.amount) as amount, p.status, s.flag
    from p join s on p.id = s.id and s.rn = 1""",
)
def first_match_merge(t):
    primary = t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_totalprice")).alias("amount"),
        F.col("o_orderstatus").alias("status"),
    )
    secondary = t.lineitem.select(
        F.col("l_orderkey").alias("id"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_returnflag").alias("flag"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
    )
    order = [F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "amount")]
    merged = loans.merge_details(primary, secondary, order)
    return merged.select("id", "amount", "status", "flag")


@query(
    "placeholder_rows",
    """select k.doc_id, quality, toxic from (select distinct doc_id from documents) k
    left join labels l on l.doc_id = k.doc_id""",
)
def placeholder_rows(t):
    return rec.with_placeholders(t.documents, t.labels, "doc_id")


@query(
    "union_lookup",
    """with e as (
        select c_name as url, 'customer' as entity from customer union all
        select s_name, 'supplier' from supplier union all
        select p_name, 'part' from part union all
        select n_name, 'nation' from nation union all
        select r_name, 'region' from region),
    r as (select distinct c_name as url from customer where c_acctbal > 0 union
        select distinct p_name from part where p_size < 10 union select s_name from supplier where s_acctbal > 0)
    select e.url, entity, count(*) as n from r join e on r.url = e.url group by 1, 2""",
)
def union_lookup(t):
    tables = {
        "customer": t.customer.select(F.col("c_name").alias("url")),
        "supplier": t.supplier.select(F.col("s_name").alias("url")),
        "part": t.part.select(F.col("p_name").alias("url")),
        "nation": t.nation.select(F.col("n_name").alias("url")),
        "region": t.region.select(F.col("r_name").alias("url")),
    }
    requests = rec.union_distinct(
        t.customer.filter("c_acctbal > 0").select(F.col("c_name").alias("url")),
        t.part.filter("p_size < 10").select(F.col("p_name").alias("url")),
        t.supplier.filter("s_acctbal > 0").select(F.col("s_name").alias("url")),
    )
    found = rec.union_lookup(requests, tables, "url")
    return found.groupBy("url", "entity").agg(F.count(F.lit(1)).alias("n"))


@query(
    "latest_child",
    """select c_custkey, latest_child_id from customer left join (select o_custkey, max(o_orderkey) as latest_child_id
        from orders where o_orderstatus = 'F' group by 1) on c_custkey = o_custkey""",
)
def latest_child(t):
    won = t.orders.filter("o_orderstatus = 'F'")
    return rec.latest_child(t.customer.select("c_custkey"), won, "c_custkey", "o_custkey", "o_orderkey")


@query(
    "child_counts",
    """select o_orderkey, o_totalprice, coalesce(n, 0) as donations, coalesce(m, 1) as team_members from orders
    left join (select l_orderkey, count(*) as n from lineitem where l_returnflag = 'A' group by 1) a
        on a.l_orderkey = o_orderkey
    left join (select l_orderkey, count(*) as m from lineitem where l_returnflag = 'R' group by 1) b
        on b.l_orderkey = o_orderkey""",
)
def child_counts(t):
    counted = [
        (t.lineitem.filter("l_returnflag = 'A'"), "l_orderkey", "donations", 0),
        (t.lineitem.filter("l_returnflag = 'R'"), "l_orderkey", "team_members", 1),
    ]
    df = rec.child_counts(t.orders.select("o_orderkey", "o_totalprice"), counted, "o_orderkey")
    return df.select("o_orderkey", "o_totalprice", "donations", "team_members")


@query(
    "param_grid",
    """select n_nationkey as category_id, cast(g as bigint) as goal, cast(r as bigint) as raised
    from nation, range(5) a(g), range(3) b(r)""",
)
def param_grid(t):
    grid = rec.parameter_grid(t.nation.select(F.col("n_nationkey").alias("category_id")), goal=5, raised=3)
    return grid.select("category_id", F.col("goal").cast("long").alias("goal"), F.col("raised").cast("long").alias("raised"))


@query(
    "table_count_diff",
    """select 'events' as table_name, (select count(*) from events) as left_count,
        (select count(*) from events where event_type <> 'error') as right_count
    union all select 'orders', (select count(*) from orders), (select count(*) from orders where o_orderstatus <> 'O')""",
)
def table_count_diff(t):
    return rec.table_count_diff(
        {"orders": t.orders, "events": t.events, "customer": t.customer},
        {
            "orders": t.orders.filter("o_orderstatus <> 'O'"),
            "events": t.events.filter("event_type <> 'error'"),
            "customer": t.customer,
        },
    )


# --- set operations ----------------------------------------------------------


@query(
    "union_distinct",
    """select o_orderkey as id from orders where o_orderstatus = 'O' union
    select l_orderkey from lineitem where l_returnflag = 'A'""",
)
def union_distinct(t):
    live = t.orders.filter("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("id"))
    returned = t.lineitem.filter("l_returnflag = 'A'").select(F.col("l_orderkey").alias("id"))
    return rec.union_distinct(live, returned)


@query(
    "except_ids",
    """select page_id, split_part(url, '?', 1) as url from pages
    where page_id not in (select doc_id from labels)""",
)
def except_ids(t):
    stripped = t.pages.select("page_id", F.split_part("url", F.lit("?"), F.lit(1)).alias("url"))
    return rec.except_ids(stripped, t.labels, "page_id", "doc_id")
