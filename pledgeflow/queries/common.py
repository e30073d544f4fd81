"""Bindings shared by several queries: tables renamed to the project vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AS_OF = "2001-08-01 00:00:00"

# order priority -> currency (fixed values of the binding)
CURRENCIES = {
    "1-URGENT": "USD",
    "2-HIGH": "EUR",
    "3-MEDIUM": "GBP",
    "4-NOT SPECIFIED": "CAD",
    "5-LOW": "AUD",
}


def currency_of(priority):
    expr = F.lit(None).cast("string")
    for text, code in CURRENCIES.items():
        expr = F.when(priority == text, code).otherwise(expr)
    return expr


CURRENCY_SQL = (
    "case o_orderpriority "
    + " ".join(f"when '{p}' then '{c}'" for p, c in CURRENCIES.items())
    + " end"
)


def rates(spark) -> DataFrame:
    """Daily rates 1995-1999 by a rule, so later dates take the latest rate.

    Every third day is quoted twice; the higher rate counts.
    """
    days = F.explode(F.sequence(F.lit("1995-01-01").cast("date"), F.lit("1999-12-31").cast("date")))
    step = F.datediff(F.col("rate_date"), F.lit("1995-01-01").cast("date"))
    once = (
        spark.range(len(CURRENCIES))
        .select(F.col("id").alias("k"), F.get(F.array(*map(F.lit, CURRENCIES.values())), F.col("id").cast("int")).alias("currency"))
        .select("currency", "k", days.alias("rate_date"))
        .select(
            "currency",
            "rate_date",
            (F.lit(0.5) + F.pmod(F.col("k") * 31 + step, F.lit(100)) / 100).alias("usd_rate"),
        )
    )
    again = once.filter(F.dayofyear("rate_date") % 3 == 0).withColumn("usd_rate", F.col("usd_rate") - 0.25)
    return once.unionByName(again)


RATES_SQL = (
    "rates as (select currency, cast(d as date) as rate_date,"
    " 0.5::double + ((k * 31 + date_diff('day', date '1995-01-01', cast(d as date))) % 100) / 100.0::double"
    " as usd_rate from (values "
    + ", ".join(f"('{c}', {i})" for i, c in enumerate(CURRENCIES.values()))
    + ") c(currency, k), generate_series(date '1995-01-01', date '1999-12-31', interval 1 day) g(d)),"
    " latest as (select currency, arg_max(usd_rate, rate_date) as usd_rate from rates group by currency)"
)


def us_projects(t) -> DataFrame:
    """orders as projects, customers as founders, nations of one region as the country."""
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .filter("n_regionkey = 1")
    )


US_SQL = (
    "orders join customer on o_custkey = c_custkey"
    " join nation on c_nationkey = n_nationkey and n_regionkey = 1"
)

QUARTER_SQL = "cast(year(o_orderdate) as varchar) || 'Q' || cast(quarter(o_orderdate) as varchar)"
NOT_CURRENT_SQL = (
    "not (year(o_orderdate) = year(timestamp '2001-08-01')"
    " and quarter(o_orderdate) = quarter(timestamp '2001-08-01'))"
)
