"""Page jobs: raw pages in, typed tables out."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pledgeflow.functions import dates, numbers, text, urls
from pledgeflow.functions.nested import script_fields
from pledgeflow.operators import extract as x
from pledgeflow.operators.extract import attr, first, own_text
from pledgeflow.operators.merge import greatest_first
from pledgeflow.operators.ordering import running_total
from pledgeflow.operators.reconcile import first_per_key
from pledgeflow.plans import page_specs as specs
from pledgeflow.session import materialise
from pledgeflow.sources.html import elements


def _site(host: str, href: Column) -> Column:
    return F.concat(F.lit(host), href)


# --- links, tables, attributes -----------------------------------------------


def links(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """Every link in page order: absolute, without its query, with its text."""
    page = pages.select(F.struct(key, url).alias("page"), html)
    found = elements(page, "page", html, specs.LINKS)
    rows = found.select("page", F.explode("elements").alias("e"))
    target = urls.strip_query(urls.absolute(attr("href")(F.col("e")), F.col(f"page.{url}")))
    return rows.select(f"page.{key}", "e.pos", target.alias("href"), "e.text")


def listed_projects(pages: DataFrame, key: str, html: str, schema: str) -> DataFrame:
    """Project data held in listing cards."""
    return x.attribute_json(elements(pages, key, html, specs.LISTING), key, "data-project", schema)


def listed_locations(pages: DataFrame, key: str, html: str, schema: str) -> DataFrame:
    """Locations held in links, one row per name; their state is kept as status."""
    found = x.attribute_json(elements(pages, key, html, specs.LOCATIONS), key, "data-location", schema)
    rows = found.select("document.*").withColumnRenamed("state", "status")
    rows = rows.drop("urls")
    return first_per_key(rows, ["displayable_name"], greatest_first(rows))


def proxies(pages: DataFrame, key: str, html: str) -> tuple[DataFrame, DataFrame]:
    """host:port of anonymous and elite proxies, and the rows not as wide as the header."""
    rows = x.table_rows(elements(pages, key, html, specs.PROXIES, {"table": ("row",)}), key, "table", "header", "row", "cell")
    cells = F.map_from_arrays("headers", "cells")
    typed = rows.filter("valid").select(key, cells.alias("c"))
    kept = typed.filter(F.col("c")["Anonymity"].isin("anonymous", "elite proxy"))
    address = F.concat_ws(":", F.col("c")["IP Address"], F.col("c")["Port"])
    return kept.select(key, address.alias("proxy")), rows.filter("not valid")


# --- charity-fundraising pages -----------------------------------------------


class Extracted(NamedTuple):
    rows: DataFrame
    children: dict[str, DataFrame]


def _true_url() -> Column:
    return urls.strip_scheme(first("og_url", attr("content")))


def fundraisers(pages: DataFrame, key: str, html: str, host: str) -> Extracted:
    """Fundraiser pages and their team members.

    A page whose team total differs from its own total belongs to the team and is left out.
    """
    found = materialise(elements(pages, key, html, specs.FUNDRAISER, ["member"]))
    team_text = F.nullif(
        F.trim(F.replace(first("team_title", own_text()), F.lit("The Team:"), F.lit(""))), F.lit("")
    )
    direct = first("type", own_text()).eqNullSafe(F.lit("direct to organizer")) | F.coalesce(
        F.contains(x.nth("type", own_text(), 1), F.lit("direct to organizer")), F.lit(False)
    )
    picture = F.split_part(first("profile_image", attr("alt")), F.lit("'s"), F.lit(1))
    shown = F.coalesce(
        urls.last_section(first("sponsor", attr("href"))),
        urls.last_section(first("registry", attr("href"))),
        picture,
    )
    organizer = first("organizer", attr("href"))
    rows = x.page_fields(
        found,
        key,
        {
            "total_raised": numbers.money(first("total", own_text())),
            "team_total_raised": numbers.money(team_text),
            "benefiting": _site(host, first("benefiting", attr("href"))),
            "event": _site(host, first("event", attr("href"))),
            "event_date": dates.long_date(first("event_date", own_text())),
            "parent_organizer_fundraiser_url": organizer,
            "parent_organizer_username": urls.last_section(organizer),
            "story": first("story", x.all_text()),
            "direct_to_organizer": direct,
            "profile": F.split_part(first("title_profile", attr("data-profile")), F.lit("|"), F.lit(2)),
            "shown_username": shown,
            "args": script_fields(x.joined("script", x.all_text())),
            "true_url": _true_url(),
        },
    )
    # fixed values: script fields copied to columns
    copied = (
        "about campaign_id fundraiser_id is_organizer member_type project_id project_name"
        " project_username owner_username"
    ).split()
    username = F.when(F.col("direct_to_organizer"), F.col("profile")).otherwise(F.col("shown_username"))
    rows = rows.withColumns(
        {c: F.try_element_at("args", F.lit(c)) for c in copied}
        | {
            "username": F.when(
                F.map_contains_key("args", "username"), F.try_element_at("args", F.lit("username"))
            ).otherwise(username),
            "num_comments": F.lit(0),
        }
    ).filter(
        F.col("team_total_raised").isNull() | F.col("team_total_raised").eqNullSafe(F.col("total_raised"))
    )
    return Extracted(rows.drop("args", "profile", "shown_username"), {"team": _team(found, key)})


def _team(found: DataFrame, key: str) -> DataFrame:
    """Team members of fundraiser pages that have a team."""
    tokens = F.split(first("member", attr("class")), " ")

    def numbered(prefix: str) -> Column:
        hit = F.filter(tokens, lambda c: c.startswith(prefix + "_"))
        return F.split_part(F.get(hit, F.lit(0)), F.lit("_"), F.lit(2)).try_cast("long")

    goal = F.replace(F.split_part(first("member_goal", own_text()), F.lit("Raised of"), F.lit(2)), F.lit("Goal"), F.lit(""))
    members = x.section_fields(
        found.filter(x.exists("team_title")),
        key,
        "member",
        {
            "username": urls.last_section(first("member_link", attr("href"))),
            "amount_raised": numbers.money(first("member_amount", own_text())),
            "goal": numbers.money(goal),
            "project_id": numbered("project"),
            "fundraiser_id": numbered("fundraiser"),
            "charity_id": numbered("charity"),
            "__blank": F.exists(tokens, lambda c: c == "project_"),
        },
    ).filter(~F.col("__blank") & F.col("username").isNotNull())
    return members.drop("__blank", "section_pos")


def users(pages: DataFrame, key: str, html: str, host: str) -> Extracted:
    """User pages and the fundraisers they list."""
    found = materialise(elements(pages, key, html, specs.USER))

    def spaced(e: Column) -> Column:
        return F.transform(e["texts"], lambda s: text.collapse_space(s))

    about = F.filter(F.flatten(x.listed("about_part", spaced)), lambda s: s != "")
    rows = x.page_fields(
        found,
        key,
        {
            "impact_points": numbers.plain_number(first("score", own_text())),
            "money_raised": numbers.money(first("raised", own_text())),
            "donate_link": _site(host, first("donate", attr("href"))),
            "username": urls.last_section(first("canonical", attr("href"))),
            "full_name": first("full_name", own_text()),
            "about_lines": about,
            "number_of_projects": x.number_of("project_link"),
            "true_url": _true_url(),
        },
    )
    since = "^[A-Z]+ SINCE: "
    joined_line = F.get(F.filter("about_lines", lambda s: s.rlike(since)), F.lit(0))
    about_at = F.array_position("about_lines", "Stuff About Me:")
    top = F.get("about_lines", F.lit(0))
    rows = rows.withColumns(
        {
            "join_date": dates.long_date(F.regexp_replace(joined_line, since, "")),
            "about": F.when(about_at > 0, F.get("about_lines", about_at)),
            "location": F.when(~top.rlike(since), F.replace(top, F.lit(" ,"), F.lit(","))),
        }
    ).drop("about_lines")
    owner = urls.last_section(first("canonical", attr("href"))).alias("username")
    projects = x.each(found, "project_link", owner, project=lambda e: _site(host, attr("href")(e)))
    return Extracted(rows, {"user_project": projects})


def charities(pages: DataFrame, key: str, html: str, host: str) -> Extracted:
    """Charity pages and their events."""
    found = materialise(elements(pages, key, html, specs.CHARITY))
    based = F.get(
        F.filter(
            F.transform(F.flatten(x.listed("based", lambda e: e["texts"])), lambda s: F.trim(F.translate(s, "\n\t", ""))),
            lambda s: s.startswith("BASED:"),
        ),
        F.lit(0),
    )
    rows = x.page_fields(
        found,
        key,
        {
            "has_video": x.exists("player"),
            "money_raised": numbers.money(first("raised", own_text())),
            "name": F.trim(first("name", own_text())),
            "mission": first("mission", x.all_text()),
            "location": F.trim(F.substr(based, F.lit(7))),
            "started": dates.long_date(first("started", own_text())),
            "ein": numbers.keep_ein(first("site_box", own_text())),
            "site": first("site", attr("href")),
            "num_events": x.number_of("event_link"),
            "true_url": _true_url(),
        },
    )
    events = x.each(found, "event_link", F.col(key).alias("charity"), event=lambda e: _site(host, attr("href")(e)))
    return Extracted(rows, {"charity_event": events})


def events(pages: DataFrame, key: str, html: str) -> Extracted:
    """Event pages."""
    found = elements(pages, key, html, specs.EVENT)
    goal = text.collapse_space(first("goal", own_text()))

    def dated(words: str) -> Column:
        """Text of the first date span whose line mentions the words."""
        lines = F.filter(x.of("date_line"), lambda e: F.contains(F.upper(x.own_texts(" ")(e)), F.lit(words)))
        marked = F.get(lines, F.lit(0))["pos"]
        spans = F.filter(x.of("date"), lambda e: F.try_element_at(e["within"], F.lit("date_line")) == marked)
        return own_text()(F.get(spans, F.lit(0)))

    rows = x.page_fields(
        found,
        key,
        {
            "amount_raised": numbers.money(first("raised", own_text())),
            "goal": numbers.money(F.split_part(F.split_part(goal, F.lit("Raised of "), F.lit(2)), F.lit(" Goal"), F.lit(1))),
            "event_date": dates.long_date(dated("EVENT DATE")),
            "deadline_to_give": dates.long_date(dated("DEADLINE TO GIVE")),
            "story": x.joined("story", own_text()),
            "has_video": x.exists("video"),
            "true_url": _true_url(),
        },
    )
    return Extracted(rows, {})


class PageBatch(NamedTuple):
    tables: dict[str, DataFrame]
    unknown: DataFrame
    bad_encoding: DataFrame
    done: DataFrame


def parse_batch(store: DataFrame, listed: DataFrame, host: str, site: str, scraped_at: Column) -> PageBatch:
    """Extract every stored page not parsed yet, or listed as modified since.

    ``store(loc, html, last_scrape)`` holds pages read as latin1, ``listed(loc, lastmod,
    categories)`` the sitemap. Static pages and the site root are skipped. Pages go to the
    extractor of their type; those of no type are reported, and so are badly encoded ones.
    """
    joined = store.join(listed, "loc").filter(
        F.col("html").isNotNull()
        & (F.col("last_scrape").isNull() | (F.col("lastmod") > F.col("last_scrape")))
        & ~(F.forall("categories", lambda c: c == "static") | (F.col("loc") == site))
    )
    repaired = joined.select("loc", text.redecode(F.col("html")).alias("html"), text.decodes(F.col("html")).alias("clean"))
    # a folder for each type, so that every extractor reads its own pages only
    typed = materialise(x.classify(repaired, "html", specs.PAGE_MARKERS), "page_type")
    conflicts = F.raise_error(F.concat(F.lit("several page types: "), F.col("loc"))).cast("boolean")
    typed = typed.filter(F.when(F.col("page_type") == "conflict", conflicts).otherwise(F.lit(True)))

    def of(kind: str) -> DataFrame:
        return typed.filter(F.col("page_type") == kind).select("loc", "html")

    parts = {
        "fundraiser": fundraisers(of("fundraiser"), "loc", "html", host),
        "user": users(of("user"), "loc", "html", host),
        "charity": charities(of("charity"), "loc", "html", host),
        "event": events(of("event"), "loc", "html"),
    }
    tables = {name: part.rows for name, part in parts.items()}
    for part in parts.values():
        tables |= part.children
    tables["special_user"] = of("special_user").select("loc")
    tables["front_page_redirect"] = of("front_page_redirect").select("loc")
    return PageBatch(
        tables,
        typed.filter("page_type = 'unknown'").select("loc").distinct(),
        typed.filter("not clean").select("loc").distinct(),
        typed.filter("page_type <> 'unknown'").select("loc", scraped_at.alias("last_scrape")),
    )


# --- project pages -----------------------------------------------------------


def project_states(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Project pages by state: live, failed, canceled, suspended, successful, purged, copyright, 404.

    Fields follow the layout of the state; purged, disputed and missing pages have none.
    """
    found = elements(pages, key, html, specs.PROJECT)
    main = F.split(first("main", attr("class")), " ")
    hidden = first("hidden_text", own_text())

    # elements placed relative to the share and pledge boxes are picked from these
    def placed(e: Column) -> Column:
        return F.struct(own_text()(e).alias("v"), e["path"].alias("path"))

    fields = x.page_fields(
        found,
        key,
        {
            "heading": first("h1", own_text()),
            "page_title": first("title", own_text()),
            "main": main,
            "hidden": hidden,
            "header_title": first("header_link", own_text()),
            "profile_title": first("profile_link", own_text()),
            "blurb": x.nth("blurb_text", own_text(), 1),
            "share_path": first("share", x.path()),
            "pledged_path": first("pledged", x.path()),
            "paragraphs": x.listed("paragraph", placed),
            "bolds": x.listed("bold", placed),
            "row_places": x.listed("row_place", own_text()),
            "money": x.listed("money", placed),
            "backers": first("backers", attr("data-backers-count")),
            "spotlight_backers": first("spotlight_backers", own_text()),
            "pledged": first("pledged_data", own_text()),
            "currency_class": first("money", attr("class")),
            "end": first("duration", attr("data-end_time")),
            "period_end": x.nth("period_time", attr("datetime"), 1),
            "launched": first("launched_time", attr("datetime")),
            "cancelled": first("cancelled", attr("data-value")),
        },
    )

    def above(path: Column, steps: int) -> Column:
        return F.try_element_at(path, F.lit(-steps))

    def values(items: Column) -> Column:
        return F.transform(items, lambda i: i["v"])

    beside_share = F.filter("bolds", lambda i: F.array_contains(i["path"], above(F.col("share_path"), 1)))
    over_share = F.filter("paragraphs", lambda i: above(i["path"], 1) == above(F.col("share_path"), 2))
    by_pledge = F.filter("money", lambda i: above(i["path"], 2) == above(F.col("pledged_path"), 1))
    shown = values(F.col("money"))
    disputed = F.contains("hidden", F.lit(specs.DISPUTED))
    listed_state = F.replace(F.get("main", F.lit(1)), F.lit("Project-state-"), F.lit(""))
    state = (
        F.when(F.trim("heading") == "404", "404")
        .when(F.col("page_title") == specs.OVERLOADED, "overloaded")
        .when(disputed, "copyright")
        .otherwise(listed_state)
    )
    full = F.col("state").isin("live", "failed", "canceled", "suspended", "successful")
    won = F.col("state") == "successful"
    end = F.when(won, dates.iso_date(F.col("period_end"))).otherwise(dates.iso_date(F.col("end")))
    places = F.when(won, F.col("row_places")).otherwise(values(beside_share))
    summary = F.get(values(over_share), F.lit(0))
    picked = {
        "title": F.when(won, F.col("profile_title")).otherwise(F.col("header_title")),
        "description": F.replace(F.when(won, F.col("blurb")).otherwise(summary), F.lit("\n"), F.lit("")),
        "backers_count": numbers.digits_only(F.when(won, F.col("spotlight_backers")).otherwise(F.col("backers"))),
        "amount_pledged": numbers.digits_only(F.when(won, F.get(shown, F.lit(0))).otherwise(F.col("pledged"))),
        "goal": numbers.digits_only(
            F.when(won, F.get(shown, F.lit(1))).otherwise(F.get(values(by_pledge), F.lit(0)))
        ),
        "currency": F.upper(F.get(F.split("currency_class", " "), F.lit(1))),
        "location": F.when(F.size(places) == 2, F.get(places, F.lit(0))).otherwise(F.lit("")),
        "category": F.when(F.size(places) == 2, F.get(places, F.lit(1))).otherwise(F.get(places, F.lit(0))),
        "start_date": dates.iso_date(F.col("launched")),
        "end_date": end,
        "state_changed_at": F.when(
            F.col("state") == "canceled", dates.iso_date(F.replace("cancelled", F.lit('"'), F.lit("")))
        ).otherwise(end),
    }
    staged = fields.withColumn("state", state)
    return staged.select(
        key,
        F.when(~F.col("state").isin("404", "overloaded"), numbers.digits_only(F.get("main", F.lit(0)))).alias("projectid"),
        "state",
        *[
            F.when(full, value).when(F.col("state") == "copyright", _title_only(name)).alias(name)
            for name, value in picked.items()
        ],
    )


def _title_only(name: str) -> Column:
    """Of a disputed project only the title is known."""
    if name == "title":
        return F.replace("hidden", F.lit(specs.DISPUTED), F.lit(""))
    return F.lit(None)


def comments(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Comments of project pages; a deleted author is NULL."""
    found = elements(pages, key, html, specs.COMMENTS, ["comment"])
    author = F.replace(first("author", attr("href")), F.lit("/profile/"), F.lit(""))
    return x.section_fields(
        found,
        key,
        "comment",
        {
            "id": numbers.digits_only(first("comment", attr("id"))),
            "user_id": F.nullif(author, F.lit("")),
            "user_name": first("author", own_text()),
            "author_deleted": (x.number_of("author") == 0) & first("gone", own_text()).eqNullSafe(F.lit("deleted")),
            "body": x.joined("body", x.own_texts("\n")),
            "post_date": F.coalesce(
                dates.iso_date(F.replace(first("time", attr("datetime")), F.lit('"'), F.lit(""))),
                dates.long_date(first("date", own_text())),
            ),
            "badge": text.token_suffix(first("badge", attr("class")), "-badge"),
        },
    ).drop("section_pos")


def community(pages: DataFrame, key: str, html: str) -> Extracted:
    """Community pages: new and repeat backers, or why there are none, and backers by place."""
    found = materialise(elements(pages, key, html, specs.COMMUNITY, ["country", "city"]))
    notice = F.trim(first("notice", own_text()))
    error = (
        F.when(notice == specs.NO_BACKERS, "No backers")
        .when(F.contains(notice, F.lit(specs.FEW_BACKERS)), "Few backers")
        .when(x.exists("purged"), "Purged")
        .when(x.exists("hidden"), "Hidden")
    )
    rows = x.page_fields(
        found,
        key,
        {
            "error_message": error,
            "new_backers": numbers.counted(first("new_count", own_text()), "backer"),
            "repeat_backers": numbers.counted(first("existing_count", own_text()), "backer"),
        },
    )

    def places(section: str, **more: Column) -> DataFrame:
        link = first("primary_link", attr("href"))
        fields = {
            "primary_location": F.trim(first("primary_link", own_text())),
            "location_id": urls.param(link, "woe_id").try_cast("long"),
            **more,
            "num_backers": numbers.counted(first("count", own_text()), "backer"),
        }
        return x.section_fields(found, key, section, fields).drop("section_pos")

    return Extracted(
        rows,
        {
            "backers_in_country": places("country"),
            "backers_in_city": places("city", secondary_location=F.trim(first("secondary_link", own_text()))),
        },
    )


def rewards(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Reward levels of pages that are not purged and list as many as they declare."""
    declared = first("list", attr("data-reward-count")).try_cast("long")
    sound = ~x.exists("purged") & (declared == x.number_of("reward"))
    found = elements(pages, key, html, specs.REWARDS, ["reward"]).filter(sound)
    limit = F.split_part(F.split_part(first("limit", own_text()), F.lit(" of"), F.lit(2)), F.lit(")"), F.lit(1))

    def filled(value: Column) -> Column:
        return F.nullif(F.trim(value), F.lit(""))

    return x.section_fields(
        found,
        key,
        "reward",
        {
            "amount_required": numbers.digits_only(first("amount", own_text())),
            "backer_count": numbers.digits_only(first("backers", own_text())),
            "description": filled(x.joined("description", x.own_texts(""), "")),
            "delivery": first("delivery", attr("datetime")),
            "backer_limit": numbers.plain_number(limit).cast("long"),
            "shipping_note": filled(x.joined("note", x.own_texts(""), "")),
        },
    ).drop("section_pos")


def timeline(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Update events of project pages, numbered per project; month and plain dividers do not count.

    Disputed projects are left out. An entry of unknown kind, or without a title, fails the job.
    """
    found = elements(pages, key, html, specs.TIMELINE, ["entry"])
    notices = x.listed("hidden_text", own_text())
    found = found.filter(~F.exists(notices, lambda t: F.contains(t, F.lit(specs.DISPUTED))))
    tokens = F.split(first("entry", attr("class")), " ")
    title, kind = F.lit(None).cast("string"), F.lit(None).cast("string")
    for token, holder in specs.TIMELINE_TITLES.items():
        held = F.trim(first(holder, own_text()))
        if holder == "success_title":
            held = F.coalesce(held, F.lit("Success"))
        title = F.when(F.array_contains(tokens, token), held).otherwise(title)
        kind = F.when(F.array_contains(tokens, token), F.lit(token)).otherwise(kind)
    divider = F.array_contains(tokens, "timeline__divider--month") | (
        first("entry", attr("class")) == "timeline__divider"
    )
    entries = x.section_fields(
        found,
        key,
        "entry",
        {
            "divider": divider,
            "kind": kind,
            "post_unix_timestamp": F.unix_seconds(F.try_to_timestamp(first("time", attr("datetime")))),
            "title": title,
        },
    ).filter(~F.col("divider"))
    bad = F.raise_error(F.concat(F.lit("unknown or untitled entry on page "), F.col(key).cast("string")))
    checked = entries.withColumn(
        "title", F.when(F.coalesce(F.col("title"), F.lit("")) == "", bad.cast("string")).otherwise(F.col("title"))
    )
    numbered = running_total(checked, ["section_pos"], [key], out="update_number")
    return numbered.select(key, "update_number", "kind", "post_unix_timestamp", "title")


def creator_bios(pages: DataFrame, key: str, html: str) -> Extracted:
    """Location and external links of creator pages; more than one location fails the job."""
    found = materialise(elements(pages, key, html, specs.CREATOR_BIO))
    rows = x.page_fields(found, key, {"location_name": x.at_most_one("location", own_text())})
    external = x.each(found, "link", key, href=attr("href"), target=attr("target"), link_text=own_text())
    return Extracted(rows, {"creator_external_url": first_per_key(external, [key, "href"], greatest_first(external))})
