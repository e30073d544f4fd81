"""Interpolated funding curves over events per user."""

from __future__ import annotations

from pyspark.sql import functions as F

from pledgeflow.operators import curves
from pledgeflow.queries.registry import query

_DAILY = """d as (select user_id, date_diff('day', date '2024-01-01', cast(ts as date)) as day,
        arg_max(value, (ts, event_id)) as amount,
        arg_max(cast(json_extract_string(props, '$.k') as double), (ts, event_id)) as comments
    from events group by 1, 2),
    z as (select user_id, 0 as day, 0.0::double as amount, 0.0::double as comments from d
        group by 1 having min(day) > 0 union all select user_id, day, amount, comments from d),
    k as (select * from z where user_id in (select user_id from z group by 1 having count(*) > 4)),
    s as (select *, lead(day) over w as d1, lead(amount) over w as a1, lead(comments) over w as c1
        from k window w as (partition by user_id order by day)),
    f as (select user_id, unnest(range(day, coalesce(d1, day + 1))) as pos, * exclude (user_id) from s),
    filled as (select user_id, pos as day,
        case when pos = day then amount else amount + (a1 - amount) * ((pos - day) / (d1 - day)) end as amount,
        round_even(case when pos = day then comments else comments + (c1 - comments) * ((pos - day) / (d1 - day)) end, 0)
            as comments from f)"""


def _filled(t):
    days = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    observed = t.events.select(
        "user_id",
        "ts",
        "event_id",
        days.alias("day"),
        F.col("value").alias("amount"),
        F.get_json_object("props", "$.k").cast("double").alias("comments"),
    )
    daily = curves.latest_per_day(observed, "user_id", "day", ["ts", "event_id"], ["amount", "comments"])
    return curves.interpolate_daily(daily, "user_id", "day", ["amount"], ["comments"])


@query(
    "interpolate_daily",
    f"with {_DAILY} select user_id, cast(day as bigint) as day, round(amount, 6) as amount, comments from filled",
)
def interpolate_daily(t):
    return _filled(t).select(
        "user_id", F.col("day").cast("long").alias("day"), F.round("amount", 6).alias("amount"), "comments"
    )


@query(
    "funding_curve",
    f"""with {_DAILY} select cast(day as bigint) as day, round(median(amount), 6) as amount,
        round(median(comments), 6) as comments, count(*) as count from filled group by 1""",
)
def funding_curve(t):
    curve = curves.funding_curve(_filled(t), "day", ["amount", "comments"])
    return curve.select(
        F.col("day").cast("long").alias("day"),
        F.round("amount", 6).alias("amount"),
        F.round("comments", 6).alias("comments"),
        "count",
    )
