"""Projects: documents to tables, snapshots and the comment work list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pledgeflow.functions.nested import explode_structs, flatten
from pledgeflow.functions.urls import strip_scheme
from pledgeflow.operators import merge
from pledgeflow.operators import reconcile as rec
from pledgeflow.session import materialise

# fixed values: scalar fields copied as they are
SCALARS = (
    "blurb comments_count country created_at currency currency_symbol currency_trailing_code deadline"
    " disable_communication goal id launched_at name pledged slug spotlight staff_pick state"
    " state_changed_at static_usd_rate successful_at updated_at updates_count usd_pledged backers_count"
).split()

_PHOTO = "1536x864"


def project_rows(docs: DataFrame) -> DataFrame:
    """One flat row per project document."""
    profile = docs.schema["profile"].dataType.names
    web = ("project", "rewards", "updates")
    url = F.col("urls.web.project")
    return docs.select(
        *SCALARS,
        F.col("category.id").alias("category_id"),
        F.col("creator.id").alias("creator_id"),
        F.col("location.id").alias("location_id"),
        F.try_element_at("photo", F.lit(_PHOTO)).alias("photo_url"),
        *[F.col(f"profile.{c}").alias(f"profile_{c}") for c in profile],
        *[F.col(f"urls.web.{w}").alias(f"url_{w}") for w in web],
        F.col("urls.web.project_short").alias("url_project_short"),
        F.col("video.id").alias("video_id"),
        F.col("video.high").alias("video_url_high"),
        F.col("video.webm").alias("video_url_webm"),
        *[F.col(f"video.{c}").alias(f"video_{c}") for c in ("height", "width", "status")],
        strip_scheme(url).alias("file_name"),
    )


def _sub_document(docs: DataFrame, name: str) -> DataFrame:
    """Flattened rows of an optional sub-document."""
    return flatten(docs.filter(F.col(name).isNotNull()).select(name), name)


def _children(docs: DataFrame, name: str) -> DataFrame:
    """Flattened child rows with the project's id."""
    rows = docs.select(F.col("id").alias("project_id"), F.explode(name).alias("child"))
    return flatten(rows.filter(F.col("child").isNotNull()), "child")


def project_tables(docs: DataFrame, landed: bool = False) -> dict[str, DataFrame]:
    """Project documents to the project table and seven related tables.

    Rewards with id 0 (no reward) are dropped, together with their items. ``landed`` writes the
    parsed documents once for all tables.
    """
    docs = materialise(docs) if landed else docs
    rewards = _children(docs, "rewards").filter("id <> 0")
    grandchildren = rewards.select(F.explode("rewards_items").alias("child"))
    return {
        "project": project_rows(docs),
        "category": _sub_document(docs, "category"),
        "creator": _sub_document(docs, "creator"),
        "location": _sub_document(docs, "location"),
        "item": explode_structs(docs, {"id": "project_id"}, "items"),
        "livestream": explode_structs(docs, {"id": "project_id"}, "livestreams"),
        "reward": rewards.drop("rewards_items"),
        "reward_item": flatten(grandchildren.filter(F.col("child").isNotNull()), "child").distinct(),
    }


def new_projects(known_urls: DataFrame, projects: DataFrame) -> DataFrame:
    """Listed projects not stored yet, one url each, in id order."""
    todo = rec.missing(known_urls, projects, {"project_id": "id"})
    return rec.first_url_per_id(todo, "project_id", "url").orderBy("project_id")


def live_projects(projects: DataFrame) -> DataFrame:
    live = projects.filter(F.col("state") == "live").select(
        F.col("id").alias("project_id"), F.col("url_project").alias("url")
    )
    return rec.first_url_per_id(live, "project_id", "url").orderBy("project_id")


def work_list(known_urls: DataFrame, projects: DataFrame) -> DataFrame:
    """Distinct urls of new and of live projects."""
    new = new_projects(known_urls, projects).select("url")
    return rec.union_distinct(new, live_projects(projects).select("url"))


def creators_without_bio(projects: DataFrame, bios: DataFrame) -> DataFrame:
    """Creators to look up, with the bio page below their first project."""
    todo = rec.missing(projects, bios, {"creator_id": "creator_id"})
    first = rec.first_url_per_id(todo, "creator_id", "url_project")
    return first.select("creator_id", F.concat("url_project", F.lit("/creator_bio")).alias("url")).orderBy(
        "creator_id"
    )


def append_snapshot(store: DataFrame, current: DataFrame, entity: str, modified: str) -> DataFrame:
    """Add (entity, modified) states not stored yet."""
    return merge.snapshot(store, current, [entity, modified])


def trend_rows(projects: DataFrame) -> DataFrame:
    """Project rows in the layout of the funding trend."""
    return projects.select(
        F.col("id").alias("projectid"),
        F.col("last_modification").alias("project_last_modification"),
        F.col("usd_pledged").alias("amount_pledged_usd"),
        F.col("backers_count").alias("backer_count"),
        F.col("updates_count").alias("update_count"),
        F.col("comments_count").alias("comment_count"),
        F.col("state").alias("status"),
    )


def comment_backfill(projects: DataFrame, comments: DataFrame) -> DataFrame:
    """Projects with missing comments and the stored comment to resume after."""
    plan = rec.count_mismatch(
        projects, comments, "id", "comments_count", "deleted_comments", "projectid", "id"
    )
    return plan.select("id", "url_project", F.col("last_child_id").alias("cursor")).orderBy("id")


def mark_deleted_comments(projects: DataFrame, comments: DataFrame, finished: DataFrame) -> DataFrame:
    """After a backfill, what is still missing counts as deleted."""
    return merge.update_from_set(
        projects, finished, "id", "project_id", comments, "projectid", "deleted_comments", "comments_count"
    )
