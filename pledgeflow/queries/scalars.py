"""Scalar functions and nested-data functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from pledgeflow.functions import dates, nested, numbers, text, urls
from pledgeflow.operators.scale import choose_scale
from pledgeflow.queries.registry import query

# --- urls --------------------------------------------------------------------


@query(
    "url_parts",
    """select page_id, regexp_extract(url, '[^/]*$') as last_section, split_part(url, '/fr/', 1) as before_marker,
        split_part(url, '/', 3) as host, replace(replace(url, 'https://', ''), 'http://', '') as bare from pages""",
)
def url_parts(t):
    url = F.col("url")
    return t.pages.select(
        "page_id",
        urls.last_section(url).alias("last_section"),
        urls.before(url, "/fr/").alias("before_marker"),
        urls.segment(url, 3).alias("host"),
        urls.strip_scheme(url).alias("bare"),
    )


@query(
    "url_to_path",
    "select page_id, replace(url, 'https://', '') as path from pages",
)
def url_to_path(t):
    return t.pages.select("page_id", urls.relative_path(F.col("url")).alias("path"))


@query(
    "url_compose",
    """select p_partkey, 'https://site.example/discover?sort=newest&page=' || p_size || '&name='
            || replace(p_name, ' ', '+') || case when p_size % 2 = 0 then '&goal=' || p_size % 5 else '' end as listing,
        'https://site.example/' || p_type || '/updates' as updates,
        'https://site.example/' || p_type || '/fundraiser/' || p_type as fundraiser from part""",
)
def url_compose(t):
    profile = F.concat(F.lit("https://site.example/"), F.col("p_type"))
    with_slash = F.when(F.col("p_size") % 3 == 0, F.concat(profile, F.lit("/"))).otherwise(profile)
    return t.part.select(
        "p_partkey",
        urls.with_params(
            "https://site.example/discover",
            sort=F.lit("newest"),
            page=F.col("p_size"),
            name=F.col("p_name"),
            goal=F.when(F.col("p_size") % 2 == 0, F.col("p_size") % 5),
        ).alias("listing"),
        urls.with_suffix(with_slash, "updates").alias("updates"),
        urls.fundraiser_page(profile, "https://site.example/").alias("fundraiser"),
    )


@query(
    "url_param",
    """select page_id, case when regexp_matches(url, '[?&]page=') then regexp_extract(url, '[?&]page=([^&#]*)', 1) end
        as page, case when regexp_matches(url, '[?&]utm_source=') then
        regexp_extract(url, '[?&]utm_source=([^&#]*)', 1) end as utm_source from pages""",
)
def url_param(t):
    return t.pages.select(
        "page_id",
        urls.param(F.col("url"), "page").alias("page"),
        urls.param(F.col("url"), "utm_source").alias("utm_source"),
    )


# --- numbers -----------------------------------------------------------------


@query(
    "parse_numbers",
    """select o_orderkey, cast(floor(o_totalprice) as bigint) as whole,
        case when o_orderkey % 5 = 0 then null when o_orderkey % 7 = 0 then 0.0 else o_totalprice end as money,
        cast(o_custkey * 1000 as double) as plain, o_custkey * 1000 as backers from orders""",
)
def parse_numbers(t):
    grouped = F.format_number(F.col("o_totalprice"), 2)
    priced = (
        F.when(F.col("o_orderkey") % 5 == 0, grouped)
        .when(F.col("o_orderkey") % 7 == 0, F.lit(" 0 "))
        .otherwise(F.concat(F.lit(" $"), grouped))
    )
    thousands = F.format_number(F.col("o_custkey") * 1000, 0)
    return t.orders.select(
        "o_orderkey",
        numbers.digits_only(F.concat(F.lit("$"), grouped)).alias("whole"),
        numbers.money(priced).alias("money"),
        numbers.plain_number(F.concat(F.lit(" "), thousands)).alias("plain"),
        numbers.counted(F.concat(thousands, F.lit(" backers ")), "backer").alias("backers"),
    )


@query(
    "strip_chars",
    """select c_custkey, replace(replace(c_name, '#', ''), '0', '') as name,
        regexp_replace(c_name || '-' || c_mktsegment, '[^0-9-]', '', 'g') as ein from customer""",
)
def strip_chars(t):
    return t.customer.select(
        "c_custkey",
        numbers.strip_chars(F.col("c_name"), "#0").alias("name"),
        numbers.keep_ein(F.concat("c_name", F.lit("-"), "c_mktsegment")).alias("ein"),
    )


@query(
    "sig_figs",
    """with e as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice as v,
            cast(floor(log10(abs(l_extendedprice))) as integer) as e from lineitem where l_extendedprice > 0)
    select l_orderkey, l_linenumber, l_partkey, l_suppkey,
        case when e <= 1 then round_even(v * pow(10::double, 1 - e), 0) / pow(10::double, 1 - e)
            else round_even(v / pow(10::double, e - 1), 0) * pow(10::double, e - 1) end as two,
        (floor(v / pow(10::double, e)) + 1) * pow(10::double, e) as ceiling from e""",
)
def sig_figs(t):
    price = F.col("l_extendedprice")
    return t.lineitem.filter(price > 0).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        numbers.sig_figs(price, 2).alias("two"),
        numbers.ceil_first_figure(price).alias("ceiling"),
    )


# a spread of magnitudes and signs, the same text in both engines
_SPREAD = (
    "o_totalprice * (case o_orderkey % 9 when 0 then 0.0000001 when 1 then 0.00001 when 2 then 0.001"
    " when 3 then 0.01 when 4 then 1 when 5 then 1000 when 6 then 100000 when 7 then 10000000 else 0 end)"
    " * (case when o_custkey % 4 = 0 then -1 else 1 end)"
)


def _double_literals(sql: str, suffix: str) -> str:
    for number in ("0.0000001", "0.00001", "0.001", "0.01"):
        sql = sql.replace(f"then {number} ", f"then {suffix.format(number)} ")
    return sql


_SPREAD_SPARK = _double_literals(_SPREAD, "{}D")
_SPREAD_DUCK = _double_literals(_SPREAD, "{}::double")


def precision_sql(source: str, value: str) -> str:
    """CTE chain (pr) that adds ``text``: ``value`` of ``source`` printed with three significant digits."""
    return f"""pa as (select *, {value} as x from {source}),
    pb as (select *, abs(x) as s, cast(trunc(log10(abs(x))) as integer) as g from pa where x <> 0),
    pc as (select *, case when floor(s / pow(10::double, g - 2)) < 100 then g - 1 else g end as l from pb),
    pd as (select *, pow(10::double, l - 2) as u, floor(s / pow(10::double, l - 2)) as n3 from pc),
    pf as (select *, case when abs((n3 + 1) * u - s) <= abs(n3 * u - s) then n3 + 1 else n3 end as r from pd),
    ph as (select *, case when r >= 1000 then l + 1 else l end as e,
        cast(cast(case when r >= 1000 then r / 10 else r end as bigint) as varchar) as m from pf),
    pr as (select * exclude (s, g, l, u, n3, r, e, m), case when x < 0 then '-' else '' end || case
        when e < -2 or e >= 3 then m[1:1] || '.' || m[2:3] || 'e' || case when e > 0 then '+' else '' end || e
        when e = 2 then m when e >= 0 then m[1:e + 1] || '.' || m[e + 2:]
        else '0.' || repeat('0', -(e + 1)) || m end as text from ph
    union all select *, '0.00' from pa where x = 0)"""


@query("to_precision", f"with {precision_sql('orders', _SPREAD_DUCK)} select o_orderkey, text from pr")
def to_precision(t):
    return t.orders.select(
        "o_orderkey", numbers.to_precision(F.expr(_SPREAD_SPARK), 3).alias("text")
    )


@query(
    "axis_marks",
    """select o_orderkey,
        (select count(*) from range(0, 13) t(i) where pow(10::double, i / 2.0) <= o_totalprice) as edges,
        (select max(i * 50000.0::double) from range(0, 13) t(i) where i * 50000.0 <= o_totalprice) as tick
    from orders""",
)
def axis_marks(t):
    price = F.col("o_totalprice")
    edges = F.filter(numbers.log_edges(6, 2), lambda e: e <= price)
    ticks = F.filter(numbers.axis_ticks(0, 600_000, 12), lambda tick: tick <= price)
    return t.orders.select("o_orderkey", F.size(edges).cast("long").alias("edges"), F.array_max(ticks).alias("tick"))


def four_digits_sql(source: str, value: str) -> str:
    """CTE chain (f) with sign, digits and digits left of the point, for four significant digits."""
    return f"""a as (select *, {value} as x from {source}),
    b as (select *, case when x = 0 then 0 else cast(floor(log10(abs(x))) as integer) end as e0 from a),
    c as (select *, cast(round_even(case when e0 >= 3 then abs(x) / pow(10::double, e0 - 3)
        else abs(x) * pow(10::double, 3 - e0) end, 0) as bigint) as n0 from b),
    d as (select *, case when n0 = 10000 then 1000 else n0 end as n,
        case when n0 = 10000 then e0 + 1 else e0 end as e from c),
    f as (select *, case when x < 0 then '-' else '' end as sgn,
        case when x = 0 then '0' else rtrim(cast(n as varchar), '0') end as dig,
        case when x = 0 then 1 else e + 1 end as lft from d),
    g as (select *, case when lft - len(dig) <= 0 and lft > -6 then lft
        else ((lft - 1) % 3 + 3) % 3 + 1 end as pt from f),
    h as (select *, lft - pt as pw, sgn || case when pt <= 0 then '0.' || repeat('0', -pt) || dig
        when pt >= len(dig) then dig || repeat('0', pt - len(dig))
        else dig[1:pt] || '.' || dig[pt + 1:] end as mant from g)"""


WORDS = " ".join(f"when {p} then ' {names[0]}'" for p, names in numbers.PREFIXES.items())


@query(
    "pretty_number",
    f"""with {four_digits_sql('orders', _SPREAD_DUCK)}
    select o_orderkey, case when x = 0 then '0.0' else mant || case pw when 0 then '' {WORDS} end end as text from h""",
)
def pretty_number(t):
    return t.orders.select("o_orderkey", numbers.pretty_number(F.expr(_SPREAD_SPARK)).alias("text"))


_SCALE_STATS = """s1 as (select o_custkey % 40 as variable, o_orderpriority as stat, sum(o_totalprice) as total
        from orders group by 1, 2),
    s0 as (select variable, stat, total / (variable + 1) / (variable + 1) as v from s1),
    s as (select *, ex from s0, (values (0), (3), (6), (9)) t(ex))"""


@query(
    "scale_choice",
    f"""with {_SCALE_STATS}, {four_digits_sql('s', 'v / pow(10::double, ex)')},
    k as (select *, case when e >= 3 then n * pow(10::double, e - 3) else n / pow(10::double, 3 - e) end as shown from h),
    bad as (select variable, ex, sum(case when shown < 0.1 or shown >= 1000 then 1 else 0 end) as bad from k group by 1, 2),
    best as (select variable, arg_min(ex, bad * 100 + ex) as ex from bad group by 1)
    select k.variable, stat, case k.ex when 3 then '1000s' when 6 then 'Millions' when 9 then 'Billions' end as unit
    from k join best on k.variable = best.variable and k.ex = best.ex""",
)
def scale_choice(t):
    stats = (
        t.orders.withColumn("variable", F.col("o_custkey") % 40)
        .groupBy("variable", F.col("o_orderpriority").alias("stat"))
        .agg(F.sum("o_totalprice").alias("total"))
        .withColumn("value", F.col("total") / (F.col("variable") + 1) / (F.col("variable") + 1))
    )
    return choose_scale(stats, ["variable"]).select("variable", "stat", "unit")


# --- text --------------------------------------------------------------------


@query(
    "split_location",
    r"""with l as (select n_nationkey, n_name || ', ' || r_name || ', Republic of, ' || n_regionkey || ', x' as place
            from nation join region on n_regionkey = r_regionkey)
    select n_nationkey, array_to_string(list_transform(string_split(regexp_replace(place, ', ([^,]* of)(,|$)', '@\1\2', 'g'),
        ', '), lambda p: replace(p, '@', ', ')), '|') as parts,
        cast(len(string_split(place, ', ')) - 1 as bigint) as n from l""",
)
def split_location(t):
    place = F.concat_ws(", ", "n_name", "r_name", F.lit("Republic of"), F.col("n_regionkey").cast("string"), F.lit("x"))
    parts = text.split_location(F.col("place"))
    return (
        t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", place.alias("place"))
        .select("n_nationkey", F.array_join(parts, "|").alias("parts"), F.size(parts).cast("long").alias("n"))
    )


@query(
    "clean_text",
    r"""select doc_id, md5(trim(regexp_replace(text, '[\r\n\t]', ' ', 'g'))) as single_line,
        md5(trim(regexp_replace(text, '[ \t\n\r]+', ' ', 'g'))) as collapsed from documents""",
)
def clean_text(t):
    return t.documents.select(
        "doc_id",
        F.md5(text.single_line(F.col("text"))).alias("single_line"),
        F.md5(text.collapse_space(F.col("text"))).alias("collapsed"),
    )


@query(
    "label_case",
    """select p_partkey, upper(p_name[1:1]) || p_name[2:] || ' ' || lower(p_type) as label from part""",
)
def label_case(t):
    name = F.concat_ws("_", F.replace("p_name", F.lit(" "), F.lit("_")), F.lower("p_type"))
    return t.part.select("p_partkey", text.label(name).alias("label"))


@query(
    "strip_comments",
    r"""select page_id, len(html) as before, len(regexp_replace(html, '(?s)<!--.*?-->', '', 'g')) as after,
        md5(regexp_replace(html, '(?s)<!--.*?-->', '', 'g')) as digest from pages""",
)
def strip_comments(t):
    stripped = text.strip_comments(F.col("html"))
    return t.pages.select(
        "page_id",
        F.length("html").cast("long").alias("before"),
        F.length(stripped).cast("long").alias("after"),
        F.md5(stripped).alias("digest"),
    )


@query(
    "redecode",
    """select doc_id, md5(text || 'x') as digest, doc_id % 5 <> 0 as clean from documents""",
)
def redecode(t):
    utf8 = F.encode("text", "UTF-8")
    broken = F.when(F.col("doc_id") % 5 == 0, F.unhex(F.lit("E978"))).otherwise(F.unhex(F.lit("78")))
    misread = F.decode(F.concat(utf8, broken), "ISO-8859-1")
    docs = t.documents.select("doc_id", misread.alias("text"))
    return docs.select(
        "doc_id", F.md5(text.redecode(F.col("text"))).alias("digest"), text.decodes(F.col("text")).alias("clean")
    )


@query(
    "token_suffix",
    """select p_partkey, case when p_size % 3 = 0 then null when p_size % 2 = 0 then lower(p_type) || ' creator'
        else lower(p_type) end as badge from part""",
)
def token_suffix(t):
    kind = F.lower("p_type")
    classes = (
        F.when(F.col("p_size") % 3 == 0, F.concat_ws(" ", F.lit("comment"), kind))
        .when(F.col("p_size") % 2 == 0, F.concat(F.lit("main "), kind, F.lit("-badge creator-badge")))
        .otherwise(F.concat(kind, F.lit("-badge tail")))
    )
    return t.part.select("p_partkey", text.token_suffix(classes, "-badge").alias("badge"))


@query(
    "html_script_literal",
    r"""select doc_id, md5(text) as digest from documents""",
)
def html_script_literal(t):
    escaped = F.replace(
        F.replace(F.replace("text", F.lit("\\"), F.lit("\\\\")), F.lit("&"), F.lit("&amp;")), F.lit("\n"), F.lit("\\n")
    )
    escaped = F.replace(F.replace(escaped, F.lit('"'), F.lit('\\"')), F.lit("é"), F.lit("\\u00e9"))
    return t.documents.select("doc_id", F.md5(text.script_literal(escaped)).alias("digest"))


# --- dates -------------------------------------------------------------------


@query(
    "duration_days",
    "select l_orderkey, l_partkey, l_linenumber, date_diff('day', cast(o_orderdate as date), cast(l_shipdate as date)) as days"
    " from lineitem join orders on l_orderkey = o_orderkey",
)
def duration_days(t):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    days = dates.duration_days(F.col("o_orderdate"), F.col("l_shipdate"))
    return joined.select("l_orderkey", "l_partkey", "l_linenumber", days.cast("long").alias("days"))


@query(
    "parse_dates",
    """select event_id, date_trunc('second', ts) as iso, cast(ts as date) as iso_day, cast(ts as date) as long_form,
        case when event_id % 4 <> 0 then cast(ts as date) end as slashed, cast(epoch(date_trunc('second', ts)) as bigint)
        as unix, date_trunc('second', ts) as back, case when event_id % 3 <> 0 then strftime(ts, '%Y-%m-%d') end as guarded
    from events""",
)
def parse_dates(t):
    ts = F.col("ts")
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    zoned = F.when(F.col("event_id") % 2 == 0, F.concat(iso, F.lit("Z"))).otherwise(iso)
    long_form = (
        F.when(F.col("event_id") % 3 == 0, F.date_format(ts, "MMM dd, yyyy HH:mm"))
        .when(F.col("event_id") % 3 == 1, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format(ts, "MMM dd, yyyy"))
    )
    slashed = F.when(F.col("event_id") % 4 == 0, F.lit("")).otherwise(F.date_format(ts, "M/d/yyyy"))
    guarded = F.when(F.col("event_id") % 3 == 0, F.lit("-0001-11-30")).otherwise(F.date_format(ts, " yyyy-MM-dd "))
    unix = dates.to_unix(dates.iso_timestamp(zoned))
    return t.events.select(
        "event_id",
        dates.iso_timestamp(zoned).alias("iso"),
        dates.iso_date(zoned).alias("iso_day"),
        dates.long_date(long_form).alias("long_form"),
        dates.slash_date(slashed).alias("slashed"),
        unix.alias("unix"),
        dates.from_unix(unix).alias("back"),
        dates.valid_lastmod(guarded).alias("guarded"),
    )


# --- nested data -------------------------------------------------------------


@query(
    "json_props",
    "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events",
)
def json_props(t):
    parsed = F.from_json("props", "k bigint, absent struct<x: string>")
    return t.events.select("event_id", parsed.alias("p")).select("event_id", F.col("p.k").alias("k"))


@query(
    "json_variant",
    "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, null::varchar as absent from events",
)
def json_variant(t):
    parsed = F.parse_json("props")
    return t.events.select(
        "event_id",
        F.variant_get(parsed, "$.k", "bigint").alias("k"),
        F.try_variant_get(parsed, "$.absent.x", "string").alias("absent"),
    )


@query(
    "explode_links",
    """select vec_id as loan_id, unnest(case when vec_id % 10 <> 0 then embedding[1:vec_id % 7] end) as lender
    from embeddings""",
)
def explode_links(t):
    some = F.when(F.col("vec_id") % 10 != 0, F.slice("embedding", 1, (F.col("vec_id") % 7).cast("int")))
    links = t.embeddings.select("vec_id", some.alias("lenders"))
    return nested.explode_scalars(links, {"vec_id": "loan_id"}, "lenders", "lender")


@query(
    "explode_ordinal",
    """with w as (select conv_id, turn, string_split(text, ' ') as words from conversations)
    select conv_id, turn, cast(i as bigint) as order_number, words[i] as word
    from (select *, unnest(range(1, len(words) + 1)) as i from w)""",
)
def explode_ordinal(t):
    words = F.transform(F.split("text", " "), lambda x: F.struct(x.alias("word")))
    df = t.conversations.select("conv_id", "turn", words.alias("words"))
    rows = nested.explode_structs(df, {"conv_id": "conv_id", "turn": "turn"}, "words", "order_number")
    return rows.withColumn("order_number", F.col("order_number").cast("long"))


@query(
    "explode_map",
    """select doc_id, language, text from (
        select doc_id, unnest(['en', lang]) as language, unnest([source, cast(n_chars as varchar)]) as text
        from documents where lang <> 'en') union all
    select doc_id, 'en', cast(n_chars as varchar) from documents where lang = 'en'""",
)
def explode_map(t):
    english = F.col("lang") == "en"
    docs = t.documents.select(
        "doc_id",
        F.when(english, F.array("lang")).otherwise(F.array(F.lit("en"), "lang")).alias("languages"),
        F.when(english, F.create_map("lang", F.col("n_chars").cast("string")))
        .otherwise(F.create_map(F.lit("en"), "source", "lang", F.col("n_chars").cast("string"), F.lit("zz"), "source"))
        .alias("texts"),
    )
    return nested.explode_listed(docs, {"doc_id": "doc_id"}, "languages", "texts", "language", "text")


@query(
    "split_zip",
    """with l as (select p_partkey, string_split(p_name || ' ' || p_type, ' ') as tags, [p_brand, p_type] as names from part)
    select p_partkey as loan_id, tags[i] as tags, names[i] as names from (
        select *, unnest(range(1, least(len(tags), len(names)) + 1)) as i from l)""",
)
def split_zip(t):
    lists = t.part.select(
        F.col("p_partkey").alias("loan_id"),
        F.concat(F.replace("p_name", F.lit(" "), F.lit(" , ")), F.lit(", "), "p_type").alias("tags"),
        F.concat_ws(",", "p_brand", "p_type").alias("names"),
    )
    return nested.split_zip(lists, ["loan_id"], ["tags", "names"])


@query(
    "flatten_struct",
    """select c_custkey as id, c_name as name, n_name as urls_web_user, c_mktsegment as urls_api_user,
        c_acctbal as avatar_small from customer join nation on c_nationkey = n_nationkey""",
)
def flatten_struct(t):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    document = F.struct(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.struct(
            F.struct(F.col("n_name").alias("user")).alias("web"),
            F.struct(F.col("c_mktsegment").alias("user")).alias("api"),
        ).alias("urls"),
        F.struct(F.col("c_acctbal").alias("small")).alias("avatar"),
        F.col("n_name").alias("urls_web_user"),
    )
    return nested.flatten(joined.select(document.alias("creator")), "creator")


@query(
    "kv_map",
    """select event_id, cast(user_id as varchar) as user, 'false' as owner, 'true' as active, event_type as kind,
        null::varchar as about, cast(4 as bigint) + 1 as n, event_type <> 'view' as conflict from events""",
)
def kv_map(t):
    script = F.concat(
        F.lit("var args = {'user': 'x"),
        F.lit("', 'kind': 'view', \"kind\": \""),
        F.col("event_type"),
        F.lit("\", owner: N, active:Y;\nabout: none}\n{user: '"),
        F.col("user_id").cast("string"),
        F.lit("'}"),
    )
    # the first user value only differs where the conflict flag is not looked at
    script = F.replace(script, F.lit("'user': 'x'"), F.concat(F.lit("'user': '"), F.col("user_id").cast("string"), F.lit("'")))
    fields = t.events.select(
        "event_id", nested.script_fields(script).alias("m"), nested.script_fields_conflict(script).alias("conflict")
    )
    return fields.select(
        "event_id",
        *[F.col("m")[k].alias(k) for k in ("user", "owner", "active", "kind", "about")],
        F.size("m").cast("long").alias("n"),
        "conflict",
    )
