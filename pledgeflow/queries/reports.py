"""Printed reports and the analyst export."""

from __future__ import annotations

from pyspark.sql import functions as F

from pledgeflow.functions import text
from pledgeflow.plans import reports
from pledgeflow.queries.common import AS_OF, CURRENCY_SQL, NOT_CURRENT_SQL, QUARTER_SQL, RATES_SQL, US_SQL
from pledgeflow.queries.common import currency_of, rates, us_projects
from pledgeflow.queries.registry import query
from pledgeflow.queries.scalars import WORDS, four_digits_sql, precision_sql

_GROUPED = """case when e >= 3 then n * pow(10::double, e - 3) else n / pow(10::double, 3 - e) end"""
_FIXED = """case when lft <= 0 then '0.' || repeat('0', -lft) || dig
    when lft >= len(dig) then dig || repeat('0', lft - len(dig)) else dig[1:lft] || '.' || dig[lft + 1:] end"""

_VARIABLES = [
    reports.Variable("Duration", "duration", "days"),
    reports.Variable("Lines", "lines"),
    reports.Variable("Goal", "goal", "$", "currency", "o_orderdate"),
    reports.Variable("Amount pledged", "o_totalprice", "$", "currency", "o_orderdate"),
]


@query(
    "describe_report",
    f"""with {RATES_SQL},
    p as (select date_diff('day', date '1995-01-01', cast(o_orderdate as date)) as duration, o_custkey % 7 as lines,
            o_custkey * 1000 * coalesce(r.usd_rate, l.usd_rate) as goal,
            o_totalprice * coalesce(r.usd_rate, l.usd_rate) as amount
        from orders left join rates r on r.currency = {CURRENCY_SQL} and r.rate_date = cast(o_orderdate as date)
            left join latest l on l.currency = {CURRENCY_SQL}),
    u as (unpivot (select duration::double as "Duration", lines::double as "Lines", goal as "Goal",
        amount as "Amount pledged" from p) on * into name variable value v),
    st as (select variable, avg(v) as mean, median(v) as median, min(v) as min, max(v) as max,
        stddev_samp(v) as std_dev, sum(v) as sum from u group by 1),
    lg as (unpivot st on mean, median, min, max, std_dev, sum into name stat value v),
    s as (select *, ex from lg, (values (0), (3), (6), (9)) t(ex)),
    {four_digits_sql('s', 'v / pow(10::double, ex)')},
    k as (select *, {_GROUPED} as shown, {_FIXED} as fixed from h),
    bad as (select variable, ex, sum(case when shown < 0.1 or shown >= 1000 then 1 else 0 end) as bad from k group by 1, 2),
    best as (select variable, arg_min(ex, bad * 100 + ex) as ex from bad group by 1),
    tx as (select k.variable, k.stat, case k.ex when 3 then '1000s' when 6 then 'Millions' when 9 then 'Billions' end as unit,
        case k.variable when 'Duration' then 'days' when 'Lines' then null else '$' end as units,
        case when shown >= 1 and shown < 1000000 then format('{{:,}}', cast(split_part(fixed, '.', 1) as bigint))
            || case when contains(fixed, '.') then '.' || split_part(fixed, '.', 2) else '' end
            else mant || case when pw = 0 then '' else 'E' || case when pw > 0 then '+' else '' end || pw end end as text
        from k join best on k.variable = best.variable and k.ex = best.ex),
    lb as (select variable || case when unit is null and units is null then '' when unit is null then ' (' || units || ')'
        when units is null then ' (' || unit || ')' else ' (' || unit || ' of ' || units || ')' end as label, stat, text from tx)
    select label, max(case when stat = 'mean' then text end) as mean, max(case when stat = 'median' then text end) as median,
        max(case when stat = 'min' then text end) as min, max(case when stat = 'max' then text end) as max,
        max(case when stat = 'std_dev' then text end) as std_dev, max(case when stat = 'sum' then text end) as sum
    from lb group by 1""",
)
def describe_report(t):
    projects = t.orders.select(
        F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date")).alias("duration"),
        (F.col("o_custkey") % 7).alias("lines"),
        (F.col("o_custkey") * 1000).cast("double").alias("goal"),
        "o_totalprice",
        "o_orderdate",
        currency_of(F.col("o_orderpriority")).alias("currency"),
    )
    return reports.describe_report(projects, _VARIABLES, rates(t.spark))


_LINES = ["l_quantity", "l_extendedprice", "l_tax"]


_LONG_LINES = (
    "u as (unpivot (select l_quantity::double as l_quantity, l_extendedprice::double as l_extendedprice,"
    " l_tax::double as l_tax from lineitem) on * into name variable value v)"
)


def _per_stat(stats: tuple[str, ...]) -> str:
    return ", ".join(f"max(case when stat = '{s}' then text end) as {s}" for s in stats)


@query(
    "describe_words",
    f"""with {_LONG_LINES},
    st as (select variable, avg(v) as mean, median(v) as median, min(v) as min, max(v) as max,
        stddev_samp(v) as std_dev, sum(v) as sum from u group by 1),
    lg as (unpivot st on mean, median, min, max, std_dev, sum into name stat value v), {four_digits_sql('lg', 'v')},
    tx as (select upper(variable[1:1]) || replace(variable[2:], '_', ' ') as label, stat,
        case when x = 0 then '0.0' else mant || case pw when 0 then '' {WORDS} end end as text from h)
    select label, {_per_stat(("mean", "median", "min", "max", "std_dev", "sum"))} from tx group by 1""",
)
def describe_words(t):
    return reports.describe_words(t.lineitem, _LINES)


@query(
    "describe_digits",
    f"""with {_LONG_LINES},
    st as (select variable, count(v)::double as n, round(avg(v), 12) as mean, round(stddev_pop(v), 12) as sd,
        min(v) as min, max(v) as max from u group by 1),
    lg as (unpivot st on n, mean, sd, min, max into name stat value v), {precision_sql('lg', 'v')}
    select variable, {_per_stat(("n", "mean", "sd", "min", "max"))} from pr group by 1""",
)
def describe_digits(t):
    return reports.describe_digits(t.lineitem, _LINES)


@query(
    "quarterly_report",
    f"""with {RATES_SQL},
    p as (select *, {QUARTER_SQL} as quarter, {CURRENCY_SQL} as cur from {US_SQL}
        where {NOT_CURRENT_SQL} and o_orderstatus in ('F', 'P')),
    usd as (select quarter, o_totalprice * coalesce(r.usd_rate, l.usd_rate) as v from p
        left join rates r on r.currency = cur and r.rate_date = cast(o_orderdate as date)
        left join latest l on l.currency = cur)
    select 'amount' as report, quarter, round(sum(v), 2) as total, round(avg(v), 2) as mean from usd group by 2
    union all select 'first_measure', quarter, round(sum(c_acctbal), 2), round(avg(c_acctbal), 2) from p group by 2
    union all select 'projects', quarter, count(*)::double, null from p group by 2
    union all select 'split', quarter, round(sum(c_acctbal), 2), round(stddev_pop(o_totalprice), 2) from p group by 2""",
)
def quarterly_report(t):
    projects = us_projects(t).withColumn("currency", currency_of(F.col("o_orderpriority")))
    tables = reports.quarterly_report(
        projects,
        "o_orderdate",
        AS_OF,
        ["c_acctbal", "o_totalprice"],
        "o_totalprice",
        "currency",
        rates(t.spark),
        F.col("o_orderstatus").isin("F", "P"),
    )

    def rows(name, total, mean):
        return tables[name].select(F.lit(name).alias("report"), "quarter", total.alias("total"), mean.alias("mean"))

    def rounded(name):
        return rows(name, F.round("total", 2), F.round("mean", 2))

    return (
        rounded("amount")
        .union(rounded("first_measure"))
        .union(rows("projects", F.col("count").cast("double"), F.lit(None).cast("double")))
        .union(rows("split", F.round("c_acctbal", 2), F.round("o_totalprice_std", 2)))
    )


@query(
    "funding_curve_report",
    f"""with {RATES_SQL},
    o as (select user_id, event_id, ts, value * l.usd_rate as amount, cast(event_id % 7 as double) as updates,
            cast(event_id % 11 as double) as comments, cast(event_id % 13 as double) as backers,
            value * l.usd_rate / ((o_custkey % 50 + 1) * 10 * l.usd_rate) * 100 as percent
        from events join orders on user_id = o_orderkey
            left join latest l on l.currency = {CURRENCY_SQL}
        where o_orderstatus in ('F', 'O')),
    d as (select user_id, date_diff('day', date '2024-01-02', cast(ts as date)) as day,
            arg_max(amount, (ts, amount)) as amount_pledged, arg_max(percent, (ts, amount)) as percent_of_goal,
            arg_max(updates, (ts, amount)) as update_count, arg_max(comments, (ts, amount)) as comment_count,
            arg_max(backers, (ts, amount)) as backer_count from o group by 1, 2 having day >= 0),
    z as (select user_id, 0 as day, 0.0::double as amount_pledged, 0.0::double as percent_of_goal,
            0.0::double as update_count, 0.0::double as comment_count, 0.0::double as backer_count
            from d group by 1 having min(day) > 0 union all select * from d),
    k as (select * from z where user_id in (select user_id from z group by 1 having count(*) > 4)),
    s as (select *, lead(day) over w as d1, lead(amount_pledged) over w as a1, lead(percent_of_goal) over w as p1,
            lead(update_count) over w as u1, lead(comment_count) over w as c1, lead(backer_count) over w as b1
        from k window w as (partition by user_id order by day)),
    f as (select *, unnest(range(day, coalesce(d1, day + 1))) as pos from s),
    g as (select pos as day, case when d1 is null then 0.0 else (pos - day) / (d1 - day) end as r,
            * exclude (pos, day) from f),
    filled as (select day, case when r = 0 then amount_pledged else amount_pledged + (a1 - amount_pledged) * r end as a,
        case when r = 0 then percent_of_goal else percent_of_goal + (p1 - percent_of_goal) * r end as p,
        round_even(case when r = 0 then update_count else update_count + (u1 - update_count) * r end, 0) as u,
        round_even(case when r = 0 then comment_count else comment_count + (c1 - comment_count) * r end, 0) as c,
        round_even(case when r = 0 then backer_count else backer_count + (b1 - backer_count) * r end, 0) as b from g)
    select cast(day as bigint) as day, round(median(a), 5) as amount_pledged, round(median(p), 5) as percent_of_goal,
        median(u) as update_count, median(c) as comment_count, median(b) as backer_count, count(*) as count
    from filled group by 1""",
)
def funding_curve_report(t):
    trend = t.events.select(
        F.col("user_id").alias("projectid"),
        F.col("ts").alias("added"),
        F.col("value").alias("amount_pledged"),
        *[
            (F.col("event_id") % n).cast("double").alias(c)
            for c, n in (("update_count", 7), ("comment_count", 11), ("backer_count", 13))
        ],
    )
    projects = t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "P", "failed").otherwise("successful").alias("status"),
        F.lit("2024-01-02").cast("date").alias("start_date"),
        currency_of(F.col("o_orderpriority")).alias("currency"),
        ((F.col("o_custkey") % 50 + 1) * 10).cast("double").alias("goal"),
    )
    curve = reports.funding_curve_report(trend, projects, rates(t.spark))
    return curve.withColumns(
        {
            "day": F.col("day").cast("long"),
            "amount_pledged": F.round("amount_pledged", 5),
            "percent_of_goal": F.round("percent_of_goal", 5),
        }
    )


@query(
    "export_sentinel",
    f"""select cast(o_orderkey as varchar) as url, coalesce(case when o_orderkey % 6 <> 0 then o_orderpriority end, 'none')
        as category, cast(month(o_orderdate) as varchar) as month, cast(year(o_orderdate) as varchar) as year,
        case when o_orderstatus = 'F' then 'true' else 'false' end as success, 'none' as verified_name,
        trim(replace(c_name, '#', ' ')) as title, n_name as location_name,
        coalesce((select cast(nullif(count(*), 0) as varchar) from lineitem where l_orderkey = o_orderkey), 'none')
            as num_perks
    from {US_SQL} where year(o_orderdate) < 2000""",
)
def export_sentinel(t):
    projects = us_projects(t).filter("o_orderdate < timestamp_ntz'2000-01-01'").select(
        F.col("o_orderkey").alias("url"),
        F.when(F.col("o_orderkey") % 6 != 0, F.col("o_orderpriority")).alias("category"),
        F.month("o_orderdate").alias("month"),
        F.year("o_orderdate").alias("year"),
        (F.col("o_orderstatus") == "F").alias("success"),
        F.lit(None).cast("string").alias("verified_name"),
        text.single_line(F.concat(F.replace("c_name", F.lit("#"), F.lit("\t")), F.lit(" \r\n"))).alias("title"),
        F.col("n_name").alias("location_name"),
    )
    columns = [c for c in projects.columns]
    return reports.analyst_export(projects, t.lineitem, "url", "l_orderkey", columns)
