"""Snapshot rows of several entity types for recently refreshed pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pledgeflow.operators.reconcile import missing, present


def entity_snapshots(
    recent: DataFrame, fundraiser: DataFrame, team: DataFrame, charity: DataFrame, event: DataFrame, user: DataFrame
) -> DataFrame:
    """One row per entity refreshed in ``recent(url, scrape_time_unix)``, tagged by type.

    A fundraiser that has a team is reported without a username: its members follow
    as their own rows.
    """

    def rows(df: DataFrame, kind: str, username: Column, amount: Column, goal: Column) -> DataFrame:
        return df.join(recent, "url").select(
            "url",
            username.cast("string").alias("username"),
            amount.alias("amount_raised"),
            goal.cast("double").alias("goal"),
            "scrape_time_unix",
            F.lit(kind).alias("type"),
        )

    nobody, unset = F.lit(""), F.lit(None)
    raised = F.coalesce("team_total_raised", "total_raised")
    same_url = {"url": "url"}
    parts = [
        rows(present(fundraiser, team, same_url), "fundraiser", nobody, raised, unset),
        rows(missing(fundraiser, team, same_url), "fundraiser", F.col("username"), raised, unset),
        rows(team, "team", F.col("username"), F.col("amount_raised"), F.col("goal")),
        rows(charity, "charity", nobody, F.col("amount_raised"), unset),
        rows(event, "event", nobody, F.col("amount_raised"), F.col("goal")),
        rows(user, "user", F.col("username"), F.col("amount_raised"), unset),
    ]
    return reduce(DataFrame.unionByName, parts)
