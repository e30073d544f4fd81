"""Grouped reports, statistics, windows and top-k."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pledgeflow.operators import aggregates as agg
from pledgeflow.operators import filters, money, ordering, quantiles, topk
from pledgeflow.operators import reconcile as rec
from pledgeflow.queries.common import (
    AS_OF,
    CURRENCY_SQL,
    NOT_CURRENT_SQL,
    QUARTER_SQL,
    RATES_SQL,
    US_SQL,
    currency_of,
    rates,
    us_projects,
)
from pledgeflow.queries.registry import query
from pledgeflow.session import materialise


@query(
    "quarter_sum_std",
    f"""select {QUARTER_SQL} as quarter,
        round(sum(o_totalprice), 2) as pledged, round(sum(c_acctbal), 2) as balance,
        round(stddev_pop(o_totalprice), 2) as pledged_std, round(stddev_pop(c_acctbal), 2) as balance_std
    from {US_SQL}
    where o_totalprice is not null and c_acctbal is not null and {NOT_CURRENT_SQL}
    group by 1""",
)
def quarter_sum_std(t):
    df = us_projects(t).filter("o_totalprice is not null and c_acctbal is not null")
    return agg.by_quarter(
        filters.finished_quarters(df, "o_orderdate", AS_OF),
        "o_orderdate",
        pledged=F.round(F.sum("o_totalprice"), 2),
        balance=F.round(F.sum("c_acctbal"), 2),
        pledged_std=F.round(F.stddev_pop("o_totalprice"), 2),
        balance_std=F.round(F.stddev_pop("c_acctbal"), 2),
    )


@query(
    "quarter_avg_sum",
    f"""select {QUARTER_SQL} as quarter,
        round(avg(o_totalprice), 2) as mean_pledged, round(sum(o_totalprice), 2) as total_pledged
    from {US_SQL} where {NOT_CURRENT_SQL} group by 1""",
)
def quarter_avg_sum(t):
    df = filters.finished_quarters(us_projects(t), "o_orderdate", AS_OF)
    return agg.by_quarter(
        df,
        "o_orderdate",
        mean_pledged=F.round(F.avg("o_totalprice"), 2),
        total_pledged=F.round(F.sum("o_totalprice"), 2),
    )


@query(
    "quarter_count",
    f"select {QUARTER_SQL} as quarter, count(*) as n from {US_SQL} where {NOT_CURRENT_SQL} group by 1",
)
def quarter_count(t):
    df = filters.finished_quarters(us_projects(t), "o_orderdate", AS_OF)
    return agg.by_quarter(df, "o_orderdate", n=F.count(F.lit(1)))


@query(
    "quarter_usd",
    f"""with {RATES_SQL},
    usd as (select {QUARTER_SQL} as quarter, o_totalprice * coalesce(r.usd_rate, l.usd_rate) as usd
        from orders join customer on o_custkey = c_custkey
            join nation on c_nationkey = n_nationkey and n_regionkey = 1
            left join rates r on r.currency = {CURRENCY_SQL} and r.rate_date = cast(o_orderdate as date)
            left join latest l on l.currency = {CURRENCY_SQL}
        where {NOT_CURRENT_SQL})
    select quarter, round(sum(usd), 2) as total_usd, round(avg(usd), 2) as mean_usd from usd group by 1""",
)
def quarter_usd(t):
    df = filters.finished_quarters(us_projects(t), "o_orderdate", AS_OF)
    df = df.withColumn("currency", currency_of(F.col("o_orderpriority")))
    usd = money.to_usd(df, ["o_totalprice"], "currency", rates(t.spark), "o_orderdate")
    return agg.by_quarter(
        usd,
        "o_orderdate",
        total_usd=F.round(F.sum("o_totalprice"), 2),
        mean_usd=F.round(F.avg("o_totalprice"), 2),
    )


@query(
    "to_usd",
    f"""with {RATES_SQL}
    select o_orderkey, {CURRENCY_SQL} as currency,
        round(case when o_orderkey % 10 = 0 then null else o_totalprice end
            * coalesce(r.usd_rate, l.usd_rate), 4) as amount_usd
    from orders
        left join rates r on r.currency = {CURRENCY_SQL} and r.rate_date = cast(o_orderdate as date)
        left join latest l on l.currency = {CURRENCY_SQL}""",
)
def to_usd(t):
    df = t.orders.select(
        "o_orderkey",
        "o_orderdate",
        currency_of(F.col("o_orderpriority")).alias("currency"),
        F.when(F.col("o_orderkey") % 10 != 0, F.col("o_totalprice")).alias("amount"),
    )
    usd = money.to_usd(df, ["amount"], "currency", rates(t.spark), "o_orderdate", suffix="_usd")
    return usd.select("o_orderkey", "currency", F.round("amount_usd", 4).alias("amount_usd"))


@query(
    "percent_of_goal",
    """select o_orderkey, round(o_totalprice / nullif(o_custkey % 7 * 1000, 0) * 100, 6) as percent
    from orders""",
)
def percent_of_goal(t):
    goal = (F.col("o_custkey") % 7 * 1000).cast("double")
    return t.orders.select(
        "o_orderkey", F.round(money.percent_of_goal(F.col("o_totalprice"), goal), 6).alias("percent")
    )


@query(
    "count_daily",
    "select cast(o_orderdate as date) as day, count(*) as n from orders group by 1 order by 1",
)
def count_daily(t):
    return agg.count_per_day(t.orders, "o_orderdate")


@query(
    "min_per_key",
    """select o_custkey, min(o_orderpriority) as min_o_orderpriority, min(o_totalprice) as min_o_totalprice
    from orders where o_orderstatus = 'O' group by 1 order by 1""",
)
def min_per_key(t):
    live = t.orders.filter("o_orderstatus = 'O'")
    return agg.min_per_key(live, ["o_custkey"], "o_orderpriority", "o_totalprice").orderBy("o_custkey")


@query(
    "max_per_key",
    """select l_orderkey, l_returnflag, max(l_shipdate) as max_l_shipdate,
        max(l_linestatus) as max_l_linestatus, max(l_extendedprice) as max_l_extendedprice,
        max(l_suppkey) as max_l_suppkey
    from lineitem group by 1, 2""",
)
def max_per_key(t):
    return agg.max_per_key(
        t.lineitem,
        ["l_orderkey", "l_returnflag"],
        "l_shipdate",
        "l_linestatus",
        "l_extendedprice",
        "l_suppkey",
    )


@query(
    "array_agg",
    """select o_custkey, array_to_string(list_sort(list(distinct p)), ',') as priorities
    from (select o_custkey, nullif(o_orderpriority, '5-LOW') as p from orders) where p is not null
    group by 1""",
)
def array_agg(t):
    df = t.orders.select(
        "o_custkey", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority")
    )
    arrays = agg.distinct_values(df, ["o_custkey"], "priority", "priorities")
    return arrays.select("o_custkey", F.array_join("priorities", ",").alias("priorities"))


_FOUNDERS_SQL = """with t1 as (
        select o_custkey, count(*) as projects,
            sum(case when o_orderstatus = 'F' then 1 else 0 end) as won,
            sum(case when o_orderstatus = 'P' then 1 else 0 end) as lost,
            sum(case when o_orderstatus not in ('F', 'P') then 1 else 0 end) as other
        from orders join customer on o_custkey = c_custkey
            join nation on c_nationkey = n_nationkey and n_regionkey = 1
        where o_orderdate < (select min(o_orderdate) from orders
            where o_orderstatus = 'O' and o_orderdate >= timestamp '2000-01-01')
        group by 1)
    select cast({bucket} as bigint) as projects_by_owner, cast(sum(won) as bigint) as num_won,
        cast(sum(lost) as bigint) as num_lost, cast(sum(other) as bigint) as num_other,
        round(sum(won) / sum(projects), 6) as success_rate, count(*) as num_owners
    from t1 group by 1"""


def _founders(t, cap):
    live = t.orders.filter("o_orderstatus = 'O' and o_orderdate >= timestamp_ntz'2000-01-01'")
    cohort = agg.before_first(us_projects(t), "o_orderdate", live, "o_orderdate")
    result = agg.owner_distribution(cohort, "o_custkey", "o_orderstatus", "F", "P", cap)
    return result.withColumn("success_rate", F.round("success_rate", 6))


@query("founder_distribution", _FOUNDERS_SQL.format(bucket="projects"))
def founder_distribution(t):
    return _founders(t, None)


@query("founder_distribution_capped", _FOUNDERS_SQL.format(bucket="least(projects, 11)"))
def founder_distribution_capped(t):
    return _founders(t, 10)


_LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "describe_wide",
    "select variable, round(mean, 4) as mean, round(median, 4) as median, min, max,"
    " round(std_dev, 4) as std_dev, round(sum, 2) as sum from ("
    + " union all ".join(
        f"select '{c}' as variable, avg({c}) as mean, median({c}) as median, min({c}) as min,"
        f" max({c}) as max, stddev_samp({c}) as std_dev, sum({c}) as sum from lineitem"
        for c in _LINE_COLUMNS
    )
    + ")",
)
def describe_wide(t):
    df = quantiles.describe_wide(t.lineitem, _LINE_COLUMNS)
    return df.select(
        "variable",
        F.round("mean", 4).alias("mean"),
        F.round("median", 4).alias("median"),
        "min",
        "max",
        F.round("std_dev", 4).alias("std_dev"),
        F.round("sum", 2).alias("sum"),
    )


@query(
    "column_stats",
    " union all ".join(
        f"select '{c}' as variable, count({c}) as n, round(avg({c}), 4) as mean,"
        f" round(stddev_pop({c}), 4) as sd, round(median({c}), 4) as median, min({c}) as min, max({c}) as max"
        f" from (select case when l_orderkey % 11 = 0 then null else {c} end as {c} from lineitem)"
        for c in _LINE_COLUMNS
    ),
)
def column_stats(t):
    sparse = t.lineitem.select(
        *[F.when(F.col("l_orderkey") % 11 != 0, F.col(c)).alias(c) for c in _LINE_COLUMNS]
    )
    df = quantiles.column_stats(sparse, _LINE_COLUMNS)
    return df.withColumn("median", F.round("median", 4))


@query(
    "agg_many",
    "select round(avg(l_quantity), 4) as avg_l_quantity, round(avg(l_extendedprice), 4) as avg_l_extendedprice,"
    " round(avg(l_discount), 6) as avg_l_discount from lineitem",
)
def agg_many(t):
    df = agg.simple_aggregates(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"], "avg")
    return df.select(
        F.round("avg_l_quantity", 4).alias("avg_l_quantity"),
        F.round("avg_l_extendedprice", 4).alias("avg_l_extendedprice"),
        F.round("avg_l_discount", 6).alias("avg_l_discount"),
    )


@query("median_rownum", "select round(median(o_totalprice), 4) as median_val from orders")
def median_rownum(t):
    df = quantiles.middle_rows_median(t.orders, "o_totalprice")
    return df.select(F.round("median_val", 4).alias("median_val"))


@query(
    "box_stats",
    f"""with d as (select {QUARTER_SQL} as quarter, o_totalprice as v from orders where o_orderkey % 13 <> 0),
    q as (select quarter, count(*) as n, quantile_cont(v, 0.25) as q25, quantile_cont(v, 0.5) as q50,
        quantile_cont(v, 0.75) as q75, quantile_cont(v, 0.9) as p90, min(v) as whisker_low, avg(v) as mean
        from d group by 1)
    select q.quarter, n, round(q25, 4) as q25, round(q50, 4) as q50, round(q75, 4) as q75,
        round(mean, 4) as mean, whisker_low, max(d.v) as whisker_high
    from q join d on d.quarter = q.quarter and d.v <= q.p90
    group by all""",
)
def box_stats(t):
    df = t.orders.select(
        F.concat(F.year("o_orderdate").cast("string"), F.lit("Q"), F.quarter("o_orderdate").cast("string")).alias(
            "quarter"
        ),
        F.when(F.col("o_orderkey") % 13 != 0, F.col("o_totalprice")).alias("pledged"),
    )
    box = quantiles.box_stats(df, ["quarter"], "pledged")
    rounded = [F.round(c, 4).alias(c) for c in ("q25", "q50", "q75", "mean")]
    return box.select("quarter", "n", *rounded, "whisker_low", "whisker_high")


@query(
    "hist2d_log",
    """with s as (select l_extendedprice + 1 as x, l_quantity * 100 * l_discount + 1 as y from lineitem),
    b as (select x, y, floor(log10(x) * 5) as gx, floor(log10(y) * 5) as gy from s
        where x between 1 and 1e8 and y between 1 and 1e8),
    f as (select
        case when x = 1e8 then 39 when x < pow(10::double, gx / 5) then gx - 1
            when x >= pow(10::double, (gx + 1) / 5) then gx + 1 else gx end as x_bin,
        case when y = 1e8 then 39 when y < pow(10::double, gy / 5) then gy - 1
            when y >= pow(10::double, (gy + 1) / 5) then gy + 1 else gy end as y_bin from b)
    select cast(x_bin as bigint) as x_bin, cast(y_bin as bigint) as y_bin, count(*) as n from f group by 1, 2""",
)
def hist2d_log(t):
    df = t.lineitem.select(
        F.col("l_extendedprice").alias("goal"),
        (F.col("l_quantity") * 100 * F.col("l_discount")).alias("pledged"),
    )
    return agg.log_histogram_2d(df, "goal", "pledged")


@query(
    "distinct_keys",
    "select distinct l_orderkey, l_suppkey from lineitem",
)
def distinct_keys(t):
    return rec.distinct_keys(t.lineitem, ["l_orderkey", "l_suppkey"])


@query(
    "first_row_per_id",
    """select l_orderkey, l_linenumber, l_partkey, l_extendedprice from (
        select *, row_number() over (partition by l_orderkey
            order by l_linenumber, l_partkey, l_extendedprice, l_suppkey) as rn from lineitem) where rn = 1""",
)
def first_row_per_id(t):
    order = [F.col(c) for c in ("l_linenumber", "l_partkey", "l_extendedprice", "l_suppkey")]
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    return rec.first_per_key(t.lineitem, ["l_orderkey"], order).select(*columns)


@query(
    "array_len",
    """select vec_id, cast(len(embedding) as bigint) as n_elements,
        cast(len(list_filter(embedding, lambda x: x > 0)) as bigint) as n_positive from embeddings""",
)
def array_len(t):
    return t.embeddings.select(
        "vec_id",
        F.size("embedding").cast("long").alias("n_elements"),
        F.size(F.filter("embedding", lambda x: x > 0)).cast("long").alias("n_positive"),
    )


@query(
    "unique_elements",
    """with e as (select distinct doc_id, unnest(regexp_split_to_array(text, '[ \\n]+')) as token from documents)
    select min(doc_id) as doc_id, token from e where token <> '' group by token having count(*) = 1""",
)
def unique_elements(t):
    tokens = t.documents.select("doc_id", F.explode(F.split("text", "[ \\n]+")).alias("token"))
    return agg.unique_elements(tokens.filter("token <> ''"), "doc_id", "token")


@query(
    "last_location",
    """select l_suppkey as loan_id, 'page' || cast(max(l_orderkey // 100) as varchar) as file from lineitem
    group by 1""",
)
def last_location(t):
    listing = t.lineitem.select(
        F.col("l_suppkey").alias("loan_id"),
        F.expr("l_orderkey div 100").alias("page"),
        F.concat(F.lit("page"), F.expr("l_orderkey div 100").cast("string")).alias("file"),
    )
    return agg.last_location(listing, "loan_id", "file", "page")


@query(
    "find_duplicates",
    """select text, count(*) as n, min(doc_id) as first_id from documents group by text having count(*) > 1""",
)
def find_duplicates(t):
    return agg.find_duplicates(t.documents, "text", "doc_id")


# --- windows -----------------------------------------------------------------


@query(
    "row_number",
    """select event_id, user_id, row_number() over (order by ts, event_id) as row_number from events""",
)
def row_number(t):
    numbered = ordering.running_total(t.events, ["ts", "event_id"])
    return numbered.select("event_id", "user_id", "row_number")


@query(
    "event_number",
    """select event_id, user_id, row_number() over (partition by user_id order by ts, event_id) as number
    from events where event_type <> 'error'""",
)
def event_number(t):
    entries = t.events.filter("event_type <> 'error'")
    numbered = ordering.running_total(entries, ["ts", "event_id"], ["user_id"], out="number")
    return numbered.select("event_id", "user_id", "number")


@query(
    "previous_value",
    """select event_id, lag(value) over (partition by user_id order by ts, event_id) as previous from events""",
)
def previous_value(t):
    df = ordering.previous_value(t.events, "value", ["ts", "event_id"], ["user_id"], "previous")
    return df.select("event_id", "previous")


@query(
    "bucket_round_robin",
    "select o_orderkey, (row_number() over (order by o_orderkey) - 1) % 7 as bucket from orders",
)
def bucket_round_robin(t):
    return ordering.round_robin(t.orders.select("o_orderkey"), "o_orderkey", 7)


@query(
    "bucket_balanced",
    """select o_orderkey, cast((row_number() over (order by o_orderkey) * 7 - 1)
        // (select count(*) from orders) as bigint) as part from orders""",
)
def bucket_balanced(t):
    return ordering.balanced_parts(t.orders.select("o_orderkey"), "o_orderkey", 7)


@query(
    "bucket_chunk",
    "select o_orderkey, (row_number() over (order by o_orderkey) - 1) // 100 as chunk from orders",
)
def bucket_chunk(t):
    return ordering.fixed_chunks(t.orders.select("o_orderkey"), "o_orderkey", 100)


@query(
    "log_fold",
    """with e as (select *, sum(case when event_type = 'signup' then 1 else 0 end)
            over (partition by user_id order by ts, event_id) as run from events)
    select user_id, cast(run as bigint) as run, min(ts) as started,
        string_agg(event_type, ' > ' order by ts, event_id) as chain, count(*) as pieces
    from e where run > 0 group by 1, 2""",
)
def log_fold(t):
    return ordering.fold_runs(
        t.events, "user_id", ["ts", "event_id"], F.col("event_type") == "signup", F.col("event_type")
    )


# --- sort, limit, top-k ------------------------------------------------------


@query(
    "top1_buffered",
    """select o_orderkey, o_orderdate - interval 1 day as stop_at from orders
    order by o_orderdate desc, o_orderkey desc limit 1""",
)
def top1_buffered(t):
    top = topk.newest(t.orders, [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return top.select("o_orderkey", (F.col("o_orderdate") - F.expr("interval 1 day")).alias("stop_at"))


@query(
    "kth_newest",
    "select o_orderkey, o_orderdate from orders order by o_orderdate desc, o_orderkey desc limit 1 offset 100",
)
def kth_newest(t):
    top = topk.kth_newest(t.orders, [F.desc("o_orderdate"), F.desc("o_orderkey")], 100)
    return top.select("o_orderkey", "o_orderdate")


@query("limit_sorted", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 50")
def limit_sorted(t):
    order = [F.desc("o_totalprice"), F.asc("o_orderkey")]
    return topk.page(t.orders.select("o_orderkey", "o_totalprice"), order, 0, 50)


@query("limit_offset", "select o_orderkey, o_custkey from orders order by o_orderkey limit 100 offset 200")
def limit_offset(t):
    return topk.page(t.orders.select("o_orderkey", "o_custkey"), [F.asc("o_orderkey")], 200, 100)


@query("limit_key_range", "select o_orderkey, o_custkey from orders where o_orderkey > 199 order by 1 limit 100")
def limit_key_range(t):
    return topk.after_key(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey", 199, 100)


@query(
    "groups_newest_first",
    """select event_type as category, event_id // 100 as num, count(*) as n from events
    where ts > (select max(ts) from events where event_type = 'view' and ts < timestamp '2024-01-15')
    group by 1, 2 order by 1, 2 desc""",
)
def groups_newest_first(t):
    stored = t.events.filter("event_type = 'view' and ts < timestamp_ntz'2024-01-15'")
    fresh = filters.newer_than_stored(t.events, "ts", stored, "ts")
    counted = fresh.groupBy(F.col("event_type").alias("category"), F.expr("event_id div 100").alias("num"))
    return counted.agg(F.count(F.lit(1)).alias("n")).orderBy("category", F.desc("num"))


# the comparison is of rows; their order is held by a unit test
@query("shuffle_seeded", "select o_orderkey, o_orderstatus from orders")
def shuffle_seeded(t):
    return topk.shuffled(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderkey", 1)


@query(
    "take_until",
    """with p as (select o_orderkey, (row_number() over (order by o_orderdate desc, o_orderkey desc) - 1) // 100
            as page from orders)
    select o_orderkey, page from p
    where page <= coalesce((select min(page) from p where o_orderkey % 1000 = 1), (select max(page) from p))""",
)
def take_until(t):
    newest_first = t.orders.select(
        "o_orderkey",
        (-F.unix_seconds(F.col("o_orderdate").cast("timestamp"))).alias("age"),
        (-F.col("o_orderkey")).alias("neg_key"),
    )
    numbered = ordering.running_total(newest_first, ["age", "neg_key"], out="rn")
    # numbered once: the stop page and the rows both come from it
    paged = materialise(numbered.select("o_orderkey", F.floor((F.col("rn") - 1) / 100).alias("page")))
    return topk.take_until(paged, "page", F.col("o_orderkey") % 1000 == 1)


@query(
    "window_row_in_group",
    """select o_custkey, o_orderkey from (select *, row_number() over (partition by o_custkey
        order by o_totalprice desc, o_orderkey) as rn from orders) where rn <= 3""",
)
def window_row_in_group(t):
    rank = F.row_number().over(
        Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    )
    return t.orders.withColumn("rn", rank).filter("rn <= 3").select("o_custkey", "o_orderkey")
