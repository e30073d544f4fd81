"""The subpackage's operators over their whole tables, and SQL oracles where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pledgeflow.llm import byte_bpe, chat, direct_codes, line_dedup, neighbours, packing, phrases, quality, sharding, simhash
from pledgeflow.llm import token_counts, url_filter, vector_codes
from pledgeflow.session import work_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(name: str, table: str, oracle: str | None = None):
    """Register ``fn(table) -> DataFrame`` over a whole parquet table."""

    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet"))

        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


@query("op1_best_fit_packing", "documents")
def packed(documents: DataFrame) -> DataFrame:
    placed = packing.pack_documents(documents)
    return placed.select("kept.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op2_external_shuffle", "documents")
def shuffled(documents: DataFrame) -> DataFrame:
    placed = sharding.shuffled_shards(documents, row_id=sharding.file_row())
    text = F.col("record.text")
    return placed.select(
        "record.doc_id",
        sharding.byte_size(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op3_byte_level_bpe", "documents")
def round_trip(documents: DataFrame) -> DataFrame:
    return byte_bpe.round_trip(documents).select("kept.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query("op4_token_counts", "documents")
def token_histogram(documents: DataFrame) -> DataFrame:
    return token_counts.length_histogram(token_counts.encoded_lengths(documents))


def _url_oracle() -> str:
    url = _LOWER.format("coalesce(url, '')")
    edge = "(^|[^a-z0-9]){}([^a-z0-9]|$)"
    strict = edge.format("(" + "|".join(url_filter.STRICT) + ")")
    soft = " + ".join(f"regexp_matches(u, '{edge.format(term)}')::int" for term in url_filter.SOFT)
    rules = sorted(url_filter.RULES, key=lambda r: -len(r[0] + r[1]))
    fits = [
        f"when (host = '{d}' or ends_with(host, '.{d}')) and starts_with(path, '{p}') then '{{}}'" for d, p, _ in rules
    ]
    names = " ".join(f.format(r[0] + r[1]) for f, r in zip(fits, rules, strict=True))
    verdicts = " ".join(f.format(r[2]) for f, r in zip(fits, rules, strict=True))
    return f"""
    with r as (select page_id, {url} as u,
        case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
    p as (select page_id, u, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} as host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from r),
    j as (select page_id, host, path, case {names} end as rule, case {verdicts} end as ruling,
        regexp_matches(u, '{strict}') as bad, {soft} as soft_terms from p)
    select page_id, host, path, rule,
        coalesce(ruling, case when bad or soft_terms >= 2 then 'block' else 'allow' end) as verdict from j"""


@query("op7_weighted_url_terms", "pages", _url_oracle())
def judged(pages: DataFrame) -> DataFrame:
    return url_filter.judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")


@query(
    "op10_levelled_line_dedup",
    "documents",
    f"""
    with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
    l as (select doc_id, generate_subscripts(lines, 1) as i, unnest(lines) as line from d),
    k as (select *, {_LOWER.format(f"trim(line, {_SPACE})")} as key from l),
    hot as (select key, max(doc_id) as keeper from k where length(key) >= 40
        group by key having count(distinct doc_id) >= 5),
    m as (select k.*, hot.key is not null and doc_id <> keeper as gone from k left join hot using (key))
    select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
        sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256
    from m group by doc_id""",
)
def deduped_lines(documents: DataFrame) -> DataFrame:
    kept = line_dedup.dedup_lines(documents)
    return kept.select("record.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query("op8_simhash_pivots", "documents")
def simhash_components(documents: DataFrame) -> DataFrame:
    found = simhash.near_duplicates(documents)
    shown = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return found.select("kept.doc_id", shown.alias("fingerprint"), "component_id")


def whole_tables(name: str):
    """Register ``fn(spark, folder) -> DataFrame`` over several whole tables."""

    def register(fn):
        QUERIES[name] = fn
        return fn

    return register


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@whole_tables("op6_isolation_forest")
def judged_documents(spark: SparkSession, folder: str) -> DataFrame:
    rated = quality.judge(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    counts = [c for c in quality.COUNTS if c != "n_distinct_words"]
    return rated.select("kept.doc_id", *counts, "base_failed", F.col("keep").alias("kept"))


@query("op5_hash_prefix_forest", "embeddings")
def nearest_vectors(embeddings: DataFrame) -> DataFrame:
    return neighbours.nearest(embeddings, F.pmod("vec_id", F.lit(50)) == 0)


@query("op9_tool_call_linking", "conversations")
def linked_turns(conversations: DataFrame) -> DataFrame:
    calls, results, others = chat.turns_as_calls(conversations)
    found = chat.linked_calls(calls, results, passed=("conv_id", "turn"), others=others)
    return found.select("kept.conv_id", "kept.turn", "call_id", "place", "status", F.array_join("errors", "; ").alias("errors"), "line")


@query(
    "op11_phrase_tiles",
    "documents",
    f"""
    with d as (select row_number() over () as row, coalesce(lang, 'und') as lang,
        unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) as piece from documents),
    p as (select row_number() over () as piece_id, lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as words from d),
    w as (select piece_id, lang, unnest(words) as w1, generate_subscripts(words, 1) as i from p),
    o as (select lang, w1, lead(w1) over t as w2, lead(w1, 2) over t as w3 from w window t as (partition by piece_id order by i)),
    totals as (select lang, count(*) as n from w group by lang),
    f1 as (select lang, w1, count(*) as f from o group by all),
    f2 as (select lang, w1, w2, count(*) as f from o where w2 is not null group by all),
    f3 as (select lang, w1, w2, w3, count(*) as f from o where w3 is not null group by all having count(*) >= 10),
    c2 as (select p.lang, p.w1 || ' ' || p.w2 as phrase, p.f as a, x.f as l, y.f as r, 1 as k
        from f2 p join f1 x on x.lang = p.lang and x.w1 = p.w1 join f1 y on y.lang = p.lang and y.w1 = p.w2
        where p.f >= 10 and p.f > 2 * coalesce((select max(t.f) from f3 t
            where t.lang = p.lang and ((t.w1 = p.w1 and t.w2 = p.w2) or (t.w2 = p.w1 and t.w3 = p.w2))), 0)),
    c3 as (select t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3 as phrase, t.f as a, x.f as l, y.f as r, 1 as k
        from f3 t join f1 x on x.lang = t.lang and x.w1 = t.w1 join f2 y on y.lang = t.lang and y.w1 = t.w2 and y.w2 = t.w3
        union all
        select t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, x.f, y.f, 2
        from f3 t join f2 x on x.lang = t.lang and x.w1 = t.w1 and x.w2 = t.w2 join f1 y on y.lang = t.lang and y.w1 = t.w3),
    s as (select *, (1000000::hugeint * a * a // (l::hugeint * r))::bigint as score from (from c2 union all from c3)),
    b as (select * from s qualify row_number() over (partition by lang, phrase order by score, k) = 1)
    select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
    from b join totals using (lang) qualify rank <= 2000""",
)
def collocations(documents: DataFrame) -> DataFrame:
    return phrases.collocations(documents)


@query("op12_direct_codes", "documents")
def token_files(documents: DataFrame) -> DataFrame:
    path = work_path(documents.sparkSession, "token-files")
    direct_codes.write_tokens(documents, path)
    found = direct_codes.read_documents(documents.sparkSession, path)
    return found.select(F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32")


@query("op13_value_dictionaries", "embeddings")
def vector_codes_of(embeddings: DataFrame) -> DataFrame:
    coded, books = vector_codes.compress(embeddings, passed=("label",))
    summed = vector_codes.with_label_error(coded, "label")
    return summed.select("kept.vec_id", "code", "error", "label_error", F.lit(vector_codes.digest(books)).alias("codebooks_sha256"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
