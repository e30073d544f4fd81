"""URL filtering by host rules and a weighted vocabulary.

Rules are matched with string functions. Urls without a rule are judged by an Aho-Corasick
automaton over strict and soft terms: one strict term, or several distinct soft ones, at
word boundaries, block the url.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pledgeflow.llm.text_batches import ship

# fixed values of the binding: host, path, verdict
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
# vocabulary of unwanted pages; soft terms are harmless alone
STRICT = ("adult", "casino", "malware", "phishing", "porn", "sex", "spam", "viagra", "warez", "xxx")
SOFT = (
    "ads", "bet", "bets", "bonus", "buy", "cheap", "coupon", "deal", "escort", "farm", "free", "gambling", "jackpot",
    "loan", "lottery", "offer", "pills", "poker", "popup", "pharmacy", "slots", "torrent", "track", "tracker", "win",
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none fits."""
    name = verdict = F.lit(None).cast("string")
    for domain, prefix, ruling in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(prefix))
        name = F.when(fits, F.lit(domain + prefix)).otherwise(name)
        verdict = F.when(fits, F.lit(ruling)).otherwise(verdict)
    return name, verdict


@lru_cache(maxsize=4)
def _automaton(strict: tuple[str, ...], soft: tuple[str, ...]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for term in soft:
        found.add_word(term, (term, False))
    for term in strict:
        found.add_word(term, (term, True))
    found.make_automaton()
    return found


def term_counts(url: str | None, strict: tuple[str, ...], soft: tuple[str, ...]) -> tuple[int, int]:
    """Strict hits and distinct soft terms of a url; a hit has no ASCII letter or digit beside it."""
    if not url:
        return 0, 0
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in url)
    hits, terms = 0, set()

    def inside(c: str) -> bool:
        return "a" <= c <= "z" or "0" <= c <= "9"

    for end, (term, is_strict) in _automaton(strict, soft).iter(lowered):
        start = end - len(term) + 1
        if (start and inside(lowered[start - 1])) or (end + 1 < len(lowered) and inside(lowered[end + 1])):
            continue
        if is_strict:
            hits += 1
        else:
            terms.add(term)
    return hits, len(terms)


def judge_urls(
    df: DataFrame,
    url: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    strict: Sequence[str] = STRICT,
    soft: Sequence[str] = SOFT,
    soft_limit: int = 2,
    keep: Sequence[str] = ("page_id",),
) -> DataFrame:
    """``keep`` columns, host, path, rule, strict_hits, soft_terms and verdict (allow or block).

    A null url, or one without ``://``, has an empty host and path and no rule; a null or empty
    url has no terms and is allowed. Repeated rows are judged alike; an empty table gives no
    rows. Only ``keep`` and ``url`` are read, so other columns cannot clash.
    """
    strict, soft = tuple(strict), tuple(soft)
    kept = [F.col(c) for c in keep]
    base = df.select(F.struct(*kept).alias("kept"), F.col(url).alias("url"))
    schema = T.StructType([*base.schema.fields]).add("strict_hits", T.IntegerType()).add("soft_terms", T.IntegerType())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [term_counts(u, strict, soft) for u in batch.column("url").to_pylist()]
            columns = [*batch.columns, pa.array([p[0] for p in pairs], pa.int32()), pa.array([p[1] for p in pairs], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["kept", "url", "strict_hits", "soft_terms"])

    counted = ship(base).mapInArrow(count, schema)
    host, path = url_parts(F.col("url"))
    counted = counted.select("kept", "strict_hits", "soft_terms", host.alias("host"), path.alias("path"))
    rule, ruling = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when((F.col("strict_hits") > 0) | (F.col("soft_terms") >= soft_limit), "block").otherwise("allow")
    return counted.select(
        "kept.*", "host", "path", rule.alias("rule"), "strict_hits", "soft_terms", F.coalesce(ruling, own).alias("verdict")
    )
