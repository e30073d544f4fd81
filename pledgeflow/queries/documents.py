"""Nested documents, built row by row from orders as JSON, and normalised to tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pledgeflow import schemas
from pledgeflow.operators import merge
from pledgeflow.plans import loans, projects
from pledgeflow.queries.registry import ORACLES, query
from pledgeflow.session import spread


def _key():
    return F.col("o_orderkey")


def _owner():
    return F.col("o_custkey")


def _upto(n, make):
    """Array of ``make(i)`` for i in 1..n, n at most 4."""
    return F.transform(F.filter(F.sequence(F.lit(1), F.lit(4)), lambda i: i <= n), make)


def _parsed(df, document, schema):
    """Through JSON text and back, as the documents arrive."""
    raw = df.select(F.to_json(document).alias("raw"))
    return raw.select(F.from_json("raw", schema).alias("d")).select("d.*")


def _iso(column):
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _loan_documents(t):
    joined = spread(t.orders, "o_orderkey").join(t.customer, _owner() == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    date = F.col("o_orderdate")
    payment = lambda i: F.struct(
        (_key() * 10 + i).alias("payment_id"),
        (F.col("o_totalprice") / i).alias("amount"),
        _iso(F.date_add(F.to_date(date), i.cast("int"))).alias("processed_date"),
        (_owner() + i).alias("rounded_local_amount"),
    )
    due = lambda i: F.struct(
        F.date_format(F.date_add(F.to_date(date), (i * 30).cast("int")), "yyyy-MM-dd'T'HH:mm:ss").alias("due_date"),
        (i * 1.5).cast("double").alias("amount"),
    )
    languages = F.when(_key() % 2 == 0, F.array(F.lit("en"), F.lit("es"))).otherwise(F.array(F.lit("en")))
    document = F.struct(
        _key().alias("id"),
        F.col("c_name").alias("name"),
        F.when(F.col("o_orderstatus") == "O", "fundraising").otherwise("ended").alias("status"),
        F.col("o_totalprice").alias("funded_amount"),
        F.col("o_orderpriority").alias("activity"),
        F.col("c_mktsegment").alias("sector"),
        (_key() % 10 == 0).alias("delinquent"),
        _iso(date).alias("posted_date"),
        F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss").alias("planned_expiration_date"),
        (_key() % 5).alias("lender_count"),
        _upto(
            _key() % 4,
            lambda i: F.struct(
                F.concat(F.lit("b"), i.cast("string")).alias("first_name"), (i % 2 == 0).alias("pictured")
            ),
        ).alias("borrowers"),
        F.struct(
            languages.alias("languages"),
            F.create_map(F.lit("en"), F.col("c_name"), F.lit("es"), F.col("n_name")).alias("texts"),
        ).alias("description"),
        F.struct((_key() + 1).alias("id"), F.lit(1).alias("template_id")).alias("image"),
        F.struct((_key() % 3).alias("entries"), (_key() % 2).alias("bulkEntries")).alias("journal_totals"),
        F.struct(
            F.col("n_name").alias("country"),
            F.struct(F.lit("1 2").alias("pairs"), F.lit("point").alias("type")).alias("geo"),
        ).alias("location"),
        _upto(_owner() % 3, payment).alias("payments"),
        F.when(_key() % 3 != 0, _upto(_key() % 3, lambda i: F.struct(F.concat(F.lit("#"), i.cast("string")).alias("name")))).alias(
            "tags"
        ),
        F.when(_key() % 5 != 0, F.array("c_mktsegment")).alias("themes"),
        F.struct(
            F.col("o_totalprice").alias("loan_amount"),
            (_key() % 24).alias("repayment_term"),
            F.struct(F.lit("shared").alias("currency_exchange"), F.lit(0.1).alias("currency_exchange_coverage_rate")).alias(
                "loss_liability"
            ),
            _upto(_owner() % 2, due).alias("local_payments"),
            _upto(_key() % 3, due).alias("scheduled_payments"),
        ).alias("terms"),
        F.when(_key() % 2 == 0, F.struct(F.col("c_name").alias("byline"), _owner().alias("image"))).alias("translator"),
        F.when(_key() % 4 == 0, F.struct(_key().alias("id"), F.lit("yt").alias("youtubeId"))).alias("video"),
    )
    return _parsed(joined, document, schemas.LOAN_DOCUMENT)


def _loan_tables(t, landed=False):
    scraped = F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00"))
    return loans.loan_tables(_loan_documents(t), scraped, landed)


_LOAN_SQL = "orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey"


@query(
    "normalise_loan",
    f"""select o_orderkey as id, c_name as name, case when o_orderstatus = 'O' then 'fundraising' else 'ended' end as status,
        o_totalprice as funded_amount, o_orderkey % 10 = 0 as delinquent, o_orderdate as posted_date,
        o_orderdate as planned_expiration_date, o_orderkey + 1 as image_id, o_orderkey % 3 as journal_total_entries,
        o_orderkey % 2 as journal_total_bulk_entries, n_name as country, null::varchar as town, '1 2' as geo_pairs,
        o_totalprice as terms_loan_amount, o_orderkey % 24 as terms_repayment_term,
        'shared' as terms_loss_liability_currency_exchange,
        case when o_orderkey % 2 = 0 then c_name end as translator_byline,
        case when o_orderkey % 2 = 0 then o_custkey end as translator_image_id,
        case when o_orderkey % 4 = 0 then o_orderkey end as video_id,
        case when o_orderkey % 4 = 0 then 'yt' end as video_youtube_id, timestamp '2024-01-01' as scrape_time
    from {_LOAN_SQL}""",
)
def normalise_loan(t):
    table = merge.align(_loan_tables(t)["loan"], schemas.layout(schemas.LOAN_TABLES["loan"]))
    return table.select(
        *"id name status funded_amount delinquent posted_date planned_expiration_date image_id".split(),
        *"journal_total_entries journal_total_bulk_entries country town geo_pairs terms_loan_amount".split(),
        *"terms_repayment_term terms_loss_liability_currency_exchange translator_byline".split(),
        *"translator_image_id video_id video_youtube_id scrape_time".split(),
    )


@query(
    "normalise_loan_borrower",
    """select o_orderkey as loan_id, cast(i as integer) as order_number, 'b' || i as first_name, i % 2 = 0 as pictured
    from (select o_orderkey, unnest(range(1, o_orderkey % 4 + 1)) as i from orders)""",
)
def normalise_loan_borrower(t):
    return _loan_tables(t)["borrower"].select("loan_id", "order_number", "first_name", "pictured")


@query(
    "normalise_loan_description",
    f"""select o_orderkey as loan_id, 'en' as language, c_name as text from {_LOAN_SQL}
    union all select o_orderkey, 'es', n_name from {_LOAN_SQL} where o_orderkey % 2 = 0""",
)
def normalise_loan_description(t):
    return _loan_tables(t)["description"]


@query(
    "normalise_loan_payment",
    """select o_orderkey * 10 + i as id, o_orderkey as loan_id, round(o_totalprice / i, 6) as amount,
        o_orderdate + to_days(cast(i as integer)) as processed_date, null::timestamp as settlement_date,
        o_custkey + i as rounded_local_amount
    from (select *, unnest(range(1, o_custkey % 3 + 1)) as i from orders)""",
)
def normalise_loan_payment(t):
    return _loan_tables(t)["payment"].select(
        "id", "loan_id", F.round("amount", 6).alias("amount"), "processed_date", "settlement_date", "rounded_local_amount"
    )


_DUE = """select o_orderkey as loan_id, cast(i as integer) as order_number,
        o_orderdate + to_days(cast(i * 30 as integer)) as due_date, i * 1.5::double as amount
    from (select *, unnest(range(1, {n} + 1)) as i from orders)"""


@query("normalise_loan_local_payment", _DUE.format(n="o_custkey % 2"))
def normalise_loan_local_payment(t):
    return _loan_tables(t)["local_payment"]


@query("normalise_loan_scheduled_payment", _DUE.format(n="o_orderkey % 3"))
def normalise_loan_scheduled_payment(t):
    return _loan_tables(t)["scheduled_payment"]


@query(
    "normalise_loan_tag",
    "select o_orderkey as loan_id, '#' || i as name from (select *, unnest(range(1, o_orderkey % 3 + 1)) as i from orders)",
)
def normalise_loan_tag(t):
    return _loan_tables(t)["tag"]


@query(
    "normalise_loan_theme",
    "select o_orderkey as loan_id, c_mktsegment as theme from orders join customer on o_custkey = c_custkey"
    " where o_orderkey % 5 <> 0",
)
def normalise_loan_theme(t):
    return _loan_tables(t)["theme"]


@query(
    "loan_lender_links",
    """select l_orderkey * 10 + l_linenumber as loan_id, 'lender' || l_suppkey as lender_id from lineitem
        where l_partkey % 3 <> 0
    union all select l_orderkey * 10 + l_linenumber, 'part' || l_partkey from lineitem where l_partkey % 3 <> 0""",
)
def loan_lender_links(t):
    ids = F.when(
        F.col("l_partkey") % 3 != 0,
        F.array(
            F.concat(F.lit("lender"), F.col("l_suppkey").cast("string")),
            F.concat(F.lit("part"), F.col("l_partkey").cast("string")),
        ),
    )
    document = F.struct((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), ids.alias("lender_ids"))
    return loans.lender_links(_parsed(t.lineitem, document, schemas.LENDER_LINK_DOCUMENT))


@query(
    "normalise_lender",
    """select s_name as lender_id, s_nationkey + 5 as image_id, 1 as image_template_id, s_suppkey as loan_count,
        timestamp '2010-05-06 07:08:09' as member_since, null::varchar as occupation from supplier""",
)
def normalise_lender(t):
    document = F.struct(
        F.col("s_name").alias("lender_id"),
        F.struct((F.col("s_nationkey") + 5).alias("id"), F.lit(1).alias("template_id")).alias("image"),
        F.col("s_suppkey").alias("loan_count"),
        F.lit("2010-05-06T07:08:09Z").alias("member_since"),
    )
    rows = loans.lender_rows(_parsed(t.supplier, document, schemas.LENDER_DOCUMENT))
    return rows.select("lender_id", "image_id", "image_template_id", "loan_count", "member_since", "occupation")


@query(
    "loan_work_lists",
    """select 'refresh' as list, o_orderkey as id from orders where o_orderstatus = 'O'
            and o_orderdate < timestamp '1998-01-01 12:00:00' - interval 12 hour
    union all select 'lenders', o_orderkey from orders where o_orderkey % 5 > 0
        and not exists (select 1 from lineitem where l_orderkey = o_orderkey)
    union all select distinct 'unknown', l_suppkey from lineitem
        where l_suppkey not in (select s_suppkey from supplier where s_acctbal > 0)""",
)
def loan_work_lists(t):
    table = t.orders.select(
        _key().alias("id"),
        F.when(F.col("o_orderstatus") == "O", "fundraising").otherwise("ended").alias("status"),
        F.col("o_orderdate").alias("scrape_time"),
        (_key() % 5).alias("lender_count"),
    )
    links = t.lineitem.select(F.col("l_orderkey").alias("loan_id"), F.col("l_suppkey").alias("lender_id"))
    lenders = t.supplier.filter("s_acctbal > 0").select(F.col("s_suppkey").alias("lender_id"))
    stale = loans.loans_to_refresh(table, "1998-01-01 12:00:00")
    return (
        stale.select(F.lit("refresh").alias("list"), "id")
        .union(loans.loans_without_lenders(table, links).select(F.lit("lenders"), "id"))
        .union(loans.unknown_lenders(links, lenders).select(F.lit("unknown"), "lender_id"))
    )


# --- projects ----------------------------------------------------------------


def _project_documents(t):
    joined = spread(t.orders, "o_orderkey").join(t.customer, _owner() == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    site = F.lit("https://site.example/projects/")
    url = F.concat(site, _key().cast("string"))

    def web(column):
        return F.concat(F.lit("https://site.example/"), column.cast("string"))

    def reward_item(i):
        return F.struct(
            (_key() * 100 + i).alias("id"),
            (_key() * 10 + i).alias("reward_id"),
            F.lit(2).alias("quantity"),
            F.struct((_key() * 1000 + i).alias("id"), F.lit("print").alias("name"), _key().alias("project_id")).alias("item"),
        )

    reward = lambda i: F.struct(
        F.when(i == 1, F.lit(0)).otherwise(_key() * 10 + i).alias("id"),
        F.concat(F.lit("reward "), i.cast("string")).alias("title"),
        (i * 5).cast("decimal(12,4)").alias("minimum"),
        F.struct(F.struct(web(_key() * 10 + i).alias("reward")).alias("api")).alias("urls"),
        F.when(i != 3, F.array(reward_item(i))).alias("rewards_items"),
    )
    document = F.struct(
        _key().alias("id"),
        F.concat(F.lit("project "), _key().cast("string")).alias("name"),
        F.col("o_totalprice").cast("decimal(20,4)").alias("goal"),
        F.when(F.col("o_orderstatus") == "O", "live").otherwise("successful").alias("state"),
        (_owner() % 50).alias("backers_count"),
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("launched_at"),
        F.struct(
            F.col("n_regionkey").alias("id"),
            F.concat(F.lit("cat"), F.col("n_regionkey").cast("string")).alias("name"),
            F.struct(F.struct(web(F.col("n_regionkey")).alias("discover")).alias("web")).alias("urls"),
        ).alias("category"),
        F.struct(
            _owner().alias("id"),
            F.col("c_name").alias("name"),
            F.struct(web(_owner()).alias("thumb")).alias("avatar"),
            F.struct(
                F.struct(web(_owner()).alias("user")).alias("web"), F.struct(web(_owner() + 1).alias("user")).alias("api")
            ).alias("urls"),
        ).alias("creator"),
        _upto(_key() % 3, lambda i: F.struct(i.alias("id"), F.lit("item").alias("name"), (i * 2).alias("amount"))).alias("items"),
        F.when(_key() % 6 == 0, F.array(F.struct(_key().alias("id"), F.lit("true").alias("live_now")))).alias("livestreams"),
        F.when(
            _key() % 7 != 0,
            F.struct(
                F.col("n_nationkey").alias("id"),
                F.col("n_name").alias("name"),
                F.lit("US").alias("country"),
                F.struct(F.struct(web(F.col("n_nationkey")).alias("location")).alias("web")).alias("urls"),
            ),
        ).alias("location"),
        _upto(_owner() % 4, reward).alias("rewards"),
        F.create_map(F.lit("1536x864"), F.concat(url, F.lit(".jpg")), F.lit("thumb"), url).alias("photo"),
        F.struct(F.lit(0.8).alias("background_image_opacity"), (_key() + 5).alias("id"), F.lit("active").alias("state")).alias(
            "profile"
        ),
        F.struct(
            F.struct(url.alias("project"), F.concat(url, F.lit("/rewards")).alias("rewards")).alias("web")
        ).alias("urls"),
        F.when(_key() % 2 == 0, F.struct(_key().alias("id"), F.lit("hi.mp4").alias("high"), F.lit(480).alias("height"))).alias(
            "video"
        ),
    )
    return _parsed(joined, document, schemas.PROJECT_DOCUMENT)


_PROJECT_URL = "'https://site.example/projects/' || o_orderkey"


@query(
    "normalise_project",
    f"""select o_orderkey as id, 'project ' || o_orderkey as name, round(o_totalprice, 4) as goal, null::varchar as blurb,
        case when o_orderstatus = 'O' then 'live' else 'successful' end as state, o_custkey % 50 as backers_count,
        cast(epoch(o_orderdate) as bigint) as launched_at, cast(n_regionkey as bigint) as category_id,
        o_custkey as creator_id, case when o_orderkey % 7 <> 0 then cast(n_nationkey as bigint) end as location_id,
        {_PROJECT_URL} || '.jpg' as photo_url, 0.8::double as profile_background_image_opacity,
        o_orderkey + 5 as profile_id, null::varchar as profile_blurb, 'active' as profile_state,
        {_PROJECT_URL} as url_project, null::varchar as url_updates, {_PROJECT_URL} || '/rewards' as url_rewards,
        case when o_orderkey % 2 = 0 then o_orderkey end as video_id,
        case when o_orderkey % 2 = 0 then 480::bigint end as video_height,
        'site.example/projects/' || o_orderkey as file_name
    from {_LOAN_SQL}""",
)
def normalise_project(t):
    rows = projects.project_tables(_project_documents(t))["project"]
    return rows.select(
        "id",
        "name",
        F.col("goal").cast("double").alias("goal"),
        *"blurb state backers_count launched_at category_id creator_id location_id photo_url".split(),
        *"profile_background_image_opacity profile_id profile_blurb profile_state url_project".split(),
        *"url_updates url_rewards video_id video_height file_name".split(),
    )


def _merged(t, name):
    """One row per key, the way the pipeline stores a table."""
    rows = projects.project_tables(_project_documents(t))[name]
    empty = rows.limit(0)
    return merge.merge_tables({name: empty}, {name: rows}, schemas.PROJECT_KEYS)[name]


@query(
    "normalise_project_category",
    """select distinct cast(n_regionkey as bigint) as id, 'cat' || n_regionkey as name, null::bigint as parent_id,
        'https://site.example/' || n_regionkey as urls_web_discover
    from nation join customer on c_nationkey = n_nationkey""",
)
def normalise_project_category(t):
    return _merged(t, "category").select("id", "name", "parent_id", "urls_web_discover")


@query(
    "normalise_project_creator",
    """select distinct c_custkey as id, c_name as name, 'https://site.example/' || c_custkey as avatar_thumb,
        'https://site.example/' || c_custkey as urls_web_user, 'https://site.example/' || (c_custkey + 1) as urls_api_user,
        null::varchar as avatar_small
    from customer join orders on o_custkey = c_custkey""",
)
def normalise_project_creator(t):
    rows = _merged(t, "creator")
    return rows.select("id", "name", "avatar_thumb", "urls_web_user", "urls_api_user", "avatar_small")


@query(
    "normalise_project_location",
    f"""select distinct cast(n_nationkey as bigint) as id, n_name as name, 'US' as country,
        'https://site.example/' || n_nationkey as urls_web_location from {_LOAN_SQL} where o_orderkey % 7 <> 0""",
)
def normalise_project_location(t):
    return _merged(t, "location").select("id", "name", "country", "urls_web_location")


@query(
    "normalise_project_item",
    """select o_orderkey as project_id, i as id, 'item' as name, i * 2 as amount
    from (select *, unnest(range(1, o_orderkey % 3 + 1)) as i from orders)""",
)
def normalise_project_item(t):
    rows = projects.project_tables(_project_documents(t))["item"]
    return rows.select("project_id", "id", "name", "amount")


@query(
    "normalise_project_livestream",
    "select o_orderkey as project_id, o_orderkey as id, 'true' as live_now from orders where o_orderkey % 6 = 0",
)
def normalise_project_livestream(t):
    rows = projects.project_tables(_project_documents(t))["livestream"]
    return rows.select("project_id", "id", "live_now")


@query(
    "normalise_project_reward",
    """select o_orderkey as project_id, o_orderkey * 10 + i as id, 'reward ' || i as title, (i * 5)::double as minimum,
        'https://site.example/' || (o_orderkey * 10 + i) as urls_api_reward
    from (select *, unnest(range(1, o_custkey % 4 + 1)) as i from orders) where i <> 1 and o_orderkey * 10 + i <> 0""",
)
def normalise_project_reward(t):
    rows = projects.project_tables(_project_documents(t))["reward"]
    return rows.select("project_id", "id", "title", F.col("minimum").cast("double").alias("minimum"), "urls_api_reward")


@query(
    "normalise_project_reward_item",
    """select o_orderkey * 100 + i as id, o_orderkey * 10 + i as reward_id, 2::bigint as quantity,
        o_orderkey * 1000 + i as item_id, 'print' as item_name, o_orderkey as item_project_id
    from (select *, unnest(range(1, o_custkey % 4 + 1)) as i from orders) where i = 2""",
)
def normalise_project_reward_item(t):
    rows = projects.project_tables(_project_documents(t))["reward_item"]
    return rows.select("id", "reward_id", "quantity", "item_id", "item_name", "item_project_id")


@query(
    "project_work_lists",
    f"""with known as (select o_orderkey as id, {_PROJECT_URL} as url from orders),
    stored as (select * from orders where o_orderpriority <> '1-URGENT')
    select 'download' as list, url as entry from known where id not in (select o_orderkey from stored)
    union select 'download', {_PROJECT_URL} from stored where o_orderstatus = 'O'
    union all select 'bio', cast(o_custkey as varchar) || ' ' || min({_PROJECT_URL}) || '/creator_bio' from stored
        where o_custkey not in (select c_custkey from customer where c_acctbal > 0) group by o_custkey""",
)
def project_work_lists(t):
    url = F.concat(F.lit("https://site.example/projects/"), _key().cast("string"))
    known = t.orders.select(_key().alias("project_id"), url.alias("url"))
    stored = t.orders.filter("o_orderpriority <> '1-URGENT'").select(
        _key().alias("id"),
        F.when(F.col("o_orderstatus") == "O", "live").otherwise("failed").alias("state"),
        url.alias("url_project"),
        _owner().alias("creator_id"),
    )
    bios = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("creator_id"))
    todo = projects.work_list(known, stored).select(F.lit("download").alias("list"), F.col("url").alias("entry"))
    lookups = projects.creators_without_bio(stored, bios)
    return todo.union(
        lookups.select(F.lit("bio"), F.concat_ws(" ", F.col("creator_id").cast("string"), "url"))
    )


@query(
    "comment_backfill",
    f"""with p as (select o_orderkey as id, o_custkey % 8 as comments_count,
            case when o_orderkey % 4 = 0 then o_custkey % 3 end as deleted_comments from orders),
    c as (select l_orderkey as projectid, count(*) as stored, max(l_orderkey * 10000 + l_partkey) as latest
        from lineitem group by 1),
    plan as (select p.*, coalesce(stored, 0) as stored, coalesce(latest, 0) as latest from p
        left join c on projectid = id)
    select id, {_PROJECT_URL.replace('o_orderkey', 'id')} as url_project, latest as cursor,
        case when id in (select doc_id from labels) then comments_count - stored else deleted_comments end as deleted_comments
    from plan where comments_count - coalesce(deleted_comments, 0) > 0
        and comments_count - coalesce(deleted_comments, 0) <> stored""",
)
def comment_backfill(t):
    table = t.orders.select(
        _key().alias("id"),
        F.concat(F.lit("https://site.example/projects/"), _key().cast("string")).alias("url_project"),
        (_owner() % 8).alias("comments_count"),
        F.when(_key() % 4 == 0, _owner() % 3).alias("deleted_comments"),
    )
    comments = t.lineitem.select(
        F.col("l_orderkey").alias("projectid"), (F.col("l_orderkey") * 10000 + F.col("l_partkey")).alias("id")
    )
    plan = projects.comment_backfill(table, comments)
    finished = t.labels.select(F.col("doc_id").alias("project_id"))
    marked = projects.mark_deleted_comments(table, comments, finished).select("id", "deleted_comments")
    return plan.join(marked, "id")


@query(
    "merge_tables",
    """with newest as (select o_orderkey as id, o_custkey % 3 as loan_id, o_totalprice as amount from orders
        where o_orderstatus <> 'P'),
    old as (select o_orderkey as id, 9 as loan_id, 0.5::double as amount from orders where o_orderpriority = '1-URGENT'),
    tags as (select distinct o_custkey as loan_id, o_orderpriority as name from orders)
    select 'payment' as name, count(*) as n, round(sum(amount), 2) as total from (
        select * from newest union all select * from old where id not in (select id from newest))
    union all select 'tag', count(*), round(sum(loan_id)::double, 2) from tags""",
)
def merge_tables(t):
    old = t.orders.filter("o_orderpriority = '1-URGENT'").select(
        _key().alias("id"), F.lit(9).cast("long").alias("loan_id"), F.lit(0.5).alias("amount")
    )
    newest = t.orders.filter("o_orderstatus <> 'P'").select(
        _key().alias("id"), (_owner() % 3).alias("loan_id"), F.col("o_totalprice").alias("amount")
    )
    tags = t.orders.select(_owner().alias("loan_id"), F.col("o_orderpriority").alias("name"))
    result = merge.merge_tables(
        {"payment": old, "tag": tags.filter("loan_id % 2 = 0").distinct()},
        {"tag": tags, "payment": newest},
        schemas.LOAN_KEYS,
        first=["payment"],
    )
    sums = [
        result["payment"].agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total")).withColumn("name", F.lit("payment")),
        result["tag"]
        .agg(F.count(F.lit(1)).alias("n"), F.sum("loan_id").cast("double").alias("total"))
        .withColumn("name", F.lit("tag")),
    ]
    return sums[0].unionByName(sums[1]).select("name", "n", F.round("total", 2).alias("total"))


# --- all tables of a batch, parsed once --------------------------------------


def _sizes(tables, names):
    """(name, n) of each table."""
    counts = [tables[n].agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("name"), "n") for n in names]
    return reduce(DataFrame.union, counts)


def _sizes_sql(prefix, names):
    oracles = {n: ORACLES[f"{prefix}_{n}"] for n in names}
    return " union all ".join(f"select '{n}' as name, count(*) as n from ({sql})" for n, sql in oracles.items())


_LOAN_CHILDREN = "borrower description payment local_payment scheduled_payment tag theme".split()
_PROJECT_CHILDREN = "item livestream reward reward_item".split()


@query("normalise_loan_all", _sizes_sql("normalise_loan", _LOAN_CHILDREN))
def normalise_loan_all(t):
    return _sizes(_loan_tables(t, landed=True), _LOAN_CHILDREN)


@query("normalise_project_all", _sizes_sql("normalise_project", _PROJECT_CHILDREN))
def normalise_project_all(t):
    return _sizes(projects.project_tables(_project_documents(t), landed=True), _PROJECT_CHILDREN)
