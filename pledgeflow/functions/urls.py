"""URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_query(url: Column) -> Column:
    return F.split_part(url, F.lit("?"), F.lit(1))


def strip_fragment(url: Column) -> Column:
    return F.split_part(url, F.lit("#"), F.lit(1))


def strip_slash(url: Column) -> Column:
    return F.regexp_replace(url, "/$", "")


def to_https(url: Column) -> Column:
    return F.regexp_replace(url, "^http:", "https:")


def strip_scheme(url: Column) -> Column:
    return F.replace(F.replace(url, F.lit("https://"), F.lit("")), F.lit("http://"), F.lit(""))


def segment(url: Column, number: int) -> Column:
    """Part between slashes, counted from 1; empty beyond the end."""
    return F.split_part(url, F.lit("/"), F.lit(number))


def last_section(url: Column) -> Column:
    return F.substring_index(url, "/", -1)


def before(url: Column, marker: str) -> Column:
    """Cut at a marker segment."""
    return F.split_part(url, F.lit(marker), F.lit(1))


def with_suffix(url: Column, suffix: str) -> Column:
    """Add a path suffix with exactly one slash in between."""
    return F.concat(strip_slash(url), F.lit("/" + suffix))


def fundraiser_page(url: Column, root: str) -> Column:
    """The fundraiser page of a profile url: ``<url>/fundraiser/<profile>``."""
    return F.concat(url, F.lit("/fundraiser/"), F.replace(url, F.lit(root), F.lit("")))


def with_params(base: str, **params: Column) -> Column:
    """Append encoded parameters; NULL ones are left out."""
    parts = [
        F.concat(F.lit(name + "="), F.url_encode(value.cast("string"))) for name, value in params.items()
    ]
    return F.concat(F.lit(base + "?"), F.concat_ws("&", *parts))


def param(url: Column, name: str) -> Column:
    """Value of one query parameter, NULL when absent."""
    value = F.regexp_extract(url, r"[?&]" + name + r"=([^&#]*)", 1)
    return F.when(url.rlike(r"[?&]" + name + "="), value)


def absolute(href: Column, base: Column) -> Column:
    """Make a link absolute against its page."""
    origin = F.regexp_extract(base, r"^([a-zA-Z]+://[^/?#]*)", 1)
    folder = F.regexp_replace(strip_query(strip_fragment(base)), r"(?<=[^/:]/)[^/]*$", "")
    return (
        F.when(href.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, "^([a-zA-Z]+:)", 1), href))
        .when(href.startswith("/"), F.concat(origin, href))
        .when(href.startswith("#") | href.startswith("?"), F.concat(strip_query(strip_fragment(base)), href))
        .otherwise(F.concat(F.when(folder == origin, F.concat(origin, F.lit("/"))).otherwise(folder), href))
    )


def relative_path(url: Column) -> Column:
    """File path under which a page is stored."""
    return F.replace(url, F.lit("https://"), F.lit(""))
