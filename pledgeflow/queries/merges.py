"""Upserts, inserts, quarantine and snapshots on old/new halves of the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pledgeflow.functions import urls
from pledgeflow.operators import filters, merge
from pledgeflow.plans import loans as loan_plans
from pledgeflow.plans import projects as project_plans
from pledgeflow.plans import snapshots
from pledgeflow.queries.registry import query


def _stored(t):
    """The orders that are already stored: all but one priority."""
    return t.orders.filter("o_orderpriority <> '1-URGENT'").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("state"),
        F.col("o_totalprice").alias("pledged"),
        F.col("o_orderpriority").alias("category"),
        F.col("o_orderdate").alias("modified"),
    )


def _batch(t):
    """Orders of two states, each twice, with changed amounts and without a category."""
    half = t.orders.filter("o_orderstatus <> 'P'")
    return half.select(
        F.col("o_orderkey").alias("id"),
        F.explode(F.array(F.lit(1), F.lit(2))).alias("seq"),
        F.col("o_orderstatus").alias("state"),
        "o_totalprice",
        "o_orderdate",
    ).select("id", "seq", "state", (F.col("o_totalprice") + F.col("seq")).alias("pledged"), "o_orderdate")


@query(
    "align_insert",
    """select o_orderkey as id, o_orderstatus as state, o_totalprice as pledged, o_orderpriority as category
    from orders where o_orderpriority <> '1-URGENT'
    union all select c_custkey, null, c_acctbal, null from customer""",
)
def align_insert(t):
    table = _stored(t).drop("modified")
    batch = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("pledged"), F.col("c_name").alias("unknown")
    )
    return merge.append_aligned(table, batch)


_UPSERT = """select o_orderkey as id, o_orderstatus as state, o_totalprice as pledged, o_orderpriority as category,
        o_orderdate as modified from orders where o_orderpriority <> '1-URGENT' and o_orderstatus = 'P'
    union all select o_orderkey, o_orderstatus, o_totalprice + {seq}, null, {touched}
        from orders where o_orderstatus <> 'P' {fresh}"""


@query("upsert_replace", _UPSERT.format(seq=2, touched="timestamp '2024-02-01'", fresh=""))
def upsert_replace(t):
    return merge.upsert_replace(
        _stored(t), _batch(t).drop("o_orderdate"), ["id"], [F.desc("seq")], touch="modified",
        as_of="2024-02-01 00:00:00",
    )


@query(
    "insert_ignore",
    """select o_orderkey as id, o_orderstatus as state, o_totalprice as pledged, o_orderpriority as category,
        o_orderdate as modified from orders where o_orderpriority <> '1-URGENT'
    union all select o_orderkey, o_orderstatus, o_totalprice + 1, null, null
        from orders where o_orderstatus <> 'P' and o_orderpriority = '1-URGENT'""",
)
def insert_ignore(t):
    return merge.insert_ignore(_stored(t), _batch(t), ["id"], [F.asc("seq")])


@query(
    "upsert_staged",
    """select o_orderkey as id, o_orderstatus as state, o_totalprice as pledged, o_orderpriority as category,
        o_orderdate as modified from orders where o_orderpriority <> '1-URGENT' and o_orderstatus = 'P'
    union all select o_orderkey, nullif(replace(o_orderstatus, 'O', ''), ''), o_totalprice + 2, null, o_orderdate
        from orders where o_orderstatus <> 'P'""",
)
def upsert_staged(t):
    batch = _batch(t).withColumnRenamed("o_orderdate", "modified")
    staged = batch.withColumns({"state": F.replace("state", F.lit("O"), F.lit("")), "category": F.lit("")})
    return merge.upsert_staged(_stored(t), staged, ["id"], [F.desc("seq")])


@query(
    "upsert_if_newer",
    """with old as (select o_orderkey as loc, case when o_orderkey % 7 <> 0 then o_orderdate end as lastmod,
            [o_orderpriority, o_orderstatus] as tags from orders where o_orderpriority <> '1-URGENT'),
    batch as (select o_orderkey as loc, case when o_orderkey % 5 <> 0
            then o_orderdate + to_days(cast(o_custkey % 5 - 2 + n as integer)) end as lastmod,
            [o_orderstatus, 'x' || (o_custkey + n) % 3] as tags
        from orders, (values (0), (1)) again(n) where o_orderstatus <> 'P' and (n = 0 or o_orderkey % 3 = 0)),
    new as (select * from batch
        qualify row_number() over (partition by loc order by lastmod desc nulls last, tags desc) = 1)
    select coalesce(old.loc, new.loc) as loc,
        case when old.loc is null or old.lastmod < new.lastmod then new.lastmod else old.lastmod end as lastmod,
        array_to_string(list_sort(case when old.loc is null then new.tags
            when old.lastmod < new.lastmod then list_distinct(list_concat(old.tags, new.tags))
            else old.tags end), ',') as tags
    from old full join new on old.loc = new.loc""",
)
def upsert_if_newer(t):
    old = t.orders.filter("o_orderpriority <> '1-URGENT'").select(
        F.col("o_orderkey").alias("loc"),
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate")).alias("lastmod"),
        F.array("o_orderpriority", "o_orderstatus").alias("tags"),
    )
    # every third location is listed twice
    listed = F.explode(F.when(F.col("o_orderkey") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    batch = t.orders.filter("o_orderstatus <> 'P'").withColumn("n", listed)
    shifted = F.col("o_orderdate") + F.make_dt_interval(days=(F.col("o_custkey") % 5 - 2 + F.col("n")).cast("int"))
    new = batch.select(
        F.col("o_orderkey").alias("loc"),
        F.when(F.col("o_orderkey") % 5 != 0, shifted).alias("lastmod"),
        F.array("o_orderstatus", F.concat(F.lit("x"), ((F.col("o_custkey") + F.col("n")) % 3).cast("string"))).alias("tags"),
    )
    merged = merge.upsert_if_newer(old, new, "loc", "lastmod", ["tags"])
    return merged.withColumn("tags", F.array_join(F.array_sort("tags"), ","))


@query(
    "upsert_partial",
    """with old as (select page_id as loc, html, 1 as code, url from pages where url like 'https:%'),
    new as (select page_id as loc, 404 as code, url || '#new' as url from pages where url like '%?%')
    select coalesce(old.loc, new.loc) as loc, md5(old.html) as body, coalesce(new.code, old.code) as code,
        coalesce(old.url, new.url) as url
    from old full join new on old.loc = new.loc""",
)
def upsert_partial(t):
    old = t.pages.filter("url like 'https:%'").select(
        F.col("page_id").alias("loc"), "html", F.lit(1).alias("code"), "url"
    )
    new = t.pages.filter("url like '%?%'").select(
        F.col("page_id").alias("loc"), F.lit(404).alias("code"), F.concat("url", F.lit("#new")).alias("url")
    )
    # a repeated location; the greater row counts
    again = new.filter("loc % 2 = 0").select("loc", F.lit(403).alias("code"), F.concat("url", F.lit("~")).alias("url"))
    merged = merge.upsert_partial(old, new.unionByName(again), "loc", ["code"])
    return merged.select("loc", F.md5("html").alias("body"), "code", "url")


@query(
    "update_from_set",
    """select o_orderkey as id, o_custkey % 8 as declared,
        case when exists (select 1 from labels where doc_id = o_orderkey)
            then o_custkey % 8 - (select count(*) from lineitem where l_orderkey = o_orderkey)
            when o_orderkey % 4 = 0 then 1 end as deleted
    from orders""",
)
def update_from_set(t):
    table = t.orders.select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_custkey") % 8).alias("declared"),
        F.when(F.col("o_orderkey") % 4 == 0, F.lit(1).cast("long")).alias("deleted"),
    )
    return merge.update_from_set(table, t.labels, "id", "doc_id", t.lineitem, "l_orderkey", "deleted", "declared")


_CLEAN = "regexp_replace(regexp_replace(split_part(split_part(url, '#', 1), '?', 1), '/$', ''), '^http:', 'https:')"


@query(
    "url_normalise",
    f"""select page_id, {_CLEAN} as loc, replace({_CLEAN}, 'https://', '') as path from pages
    where split_part({_CLEAN}, '/', 3) <> 'spam-farm.example.org'""",
)
def url_normalise(t):
    bare = urls.strip_query(urls.strip_fragment(F.col("url")))
    loc = urls.to_https(urls.strip_slash(bare))
    cleaned = t.pages.select("page_id", loc.alias("loc"), urls.strip_scheme(loc).alias("path"))
    return cleaned.filter(urls.segment(F.col("loc"), 3) != "spam-farm.example.org")


_URL_OK = r"regexp_full_match(url, '(?i)https://[a-z.\-]*example\.(com|net|org)([a-z0-9/_\-]|\.)*') and not contains(url, '..')"


@query("quarantine_urls_valid", f"select page_id, url from pages where {_URL_OK}")
def quarantine_urls_valid(t):
    ok = filters.safe_url(F.col("url"), r"https://[a-z.\-]*example\.(com|net|org)")
    return merge.quarantine(t.pages.select("page_id", "url"), ok)[0]


@query("quarantine_urls", f"select distinct url from pages where not ({_URL_OK})")
def quarantine_urls(t):
    ok = filters.safe_url(F.col("url"), r"https://[a-z.\-]*example\.(com|net|org)")
    return merge.quarantine(t.pages.select("url"), ok)[1]


@query(
    "snapshot_project",
    """select user_id as projectid, ts as modified, value as amount, event_type as status from events
        where value < 20 or event_type = 'view'
    union all select user_id, ts, value, event_type from events
        where not (value < 20 or event_type = 'view') and event_type in ('click', 'signup')""",
)
def snapshot_project(t):
    # events as projects, in the layout of the funding trend
    projects = t.events.select(
        F.col("user_id").alias("id"),
        F.col("ts").alias("last_modification"),
        F.col("value").alias("usd_pledged"),
        *[F.lit(0).alias(c) for c in ("backers_count", "updates_count", "comments_count")],
        F.col("event_type").alias("state"),
    )
    store = project_plans.trend_rows(projects.filter("usd_pledged < 20 or state = 'view'"))
    current = project_plans.trend_rows(projects.filter("state in ('click', 'signup', 'view')"))
    # every state is listed twice; the greater row counts
    current = current.unionByName(current.withColumn("amount_pledged_usd", F.col("amount_pledged_usd") - 1))
    added = project_plans.append_snapshot(store, current, "projectid", "project_last_modification")
    return added.select(
        "projectid",
        F.col("project_last_modification").alias("modified"),
        F.col("amount_pledged_usd").alias("amount"),
        "status",
    )


@query(
    "snapshot_loan",
    """with store as (select user_id as loan_id, event_type as status, value as funded_amount, ts as scrape_time
        from events where ts < timestamp '2024-01-20' and event_type <> 'click'),
    fresh as (select user_id as loan_id, event_type as status, value as funded_amount, ts as scrape_time
        from events where event_type in ('view', 'click', 'signup')
            and ts > (select max(scrape_time) from store))
    select * from store union all select * from fresh""",
)
def snapshot_loan(t):
    shape = [
        F.col("user_id").alias("loan_id"),
        F.col("event_type").alias("status"),
        F.col("value").alias("funded_amount"),
        F.col("ts").alias("scrape_time"),
    ]
    store = t.events.filter("ts < timestamp_ntz'2024-01-20' and event_type <> 'click'").select(*shape)
    loans = t.events.select(*shape)
    return loan_plans.append_snapshot(store, loans, ["view", "click", "signup"])


@query(
    "snapshot_union",
    """with recent as (select doc_id as id, 1704067200 + quality as seen from labels),
    teams as (select distinct l_orderkey as url, l_suppkey as member from lineitem)
    select o_orderkey as url, case when exists (select 1 from teams where teams.url = o_orderkey) then ''
            else cast(o_custkey as varchar) end as username, o_totalprice as amount_raised, null::double as goal,
        cast(seen as bigint) as scrape_time_unix, 'fundraiser' as type from orders join recent on id = o_orderkey
    union all select teams.url, cast(member as varchar), s_acctbal, s_acctbal * 2, cast(seen as bigint), 'team'
        from teams join supplier on s_suppkey = member join recent on id = teams.url
    union all select c_custkey, '', c_acctbal, null, cast(seen as bigint), 'charity'
        from customer join recent on id = c_custkey
    union all select p_partkey, '', p_retailprice, p_size, cast(seen as bigint), 'event'
        from part join recent on id = p_partkey
    union all select s_suppkey, s_name, s_acctbal, null, cast(seen as bigint), 'user'
        from supplier join recent on id = s_suppkey""",
)
def snapshot_union(t):
    recent = t.labels.select(
        F.col("doc_id").alias("url"), (F.lit(1704067200) + F.col("quality")).cast("long").alias("scrape_time_unix")
    )
    members = t.lineitem.select(F.col("l_orderkey").alias("url"), F.col("l_suppkey").alias("s_suppkey")).distinct()
    team = members.join(t.supplier, "s_suppkey").select(
        "url",
        F.col("s_suppkey").cast("string").alias("username"),
        F.col("s_acctbal").alias("amount_raised"),
        (F.col("s_acctbal") * 2).alias("goal"),
    )
    return snapshots.entity_snapshots(
        recent=recent,
        fundraiser=t.orders.select(
            F.col("o_orderkey").alias("url"),
            F.col("o_custkey").cast("string").alias("username"),
            F.col("o_totalprice").alias("total_raised"),
            F.lit(None).cast("double").alias("team_total_raised"),
        ),
        team=team,
        charity=t.customer.select(F.col("c_custkey").alias("url"), F.col("c_acctbal").alias("amount_raised")),
        event=t.part.select(
            F.col("p_partkey").alias("url"),
            F.col("p_retailprice").alias("amount_raised"),
            F.col("p_size").cast("double").alias("goal"),
        ),
        user=t.supplier.select(
            F.col("s_suppkey").alias("url"), F.col("s_name").alias("username"), F.col("s_acctbal").alias("amount_raised")
        ),
    )
