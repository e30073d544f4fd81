"""Page extraction: given pages where they have the markup, else pages built row by row from tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pledgeflow.operators import extract as x
from pledgeflow.plans import page_specs, pages
from pledgeflow.queries.registry import query
from pledgeflow.sources.html import Selector, elements

HOST = "site.example"


def _text(*parts):
    """Concatenate literal text and columns."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _attr_json(column):
    return F.replace(column, F.lit('"'), F.lit("&quot;"))


def _if(condition, *parts):
    return F.when(condition, _text(*parts)).otherwise("")


# --- given pages -------------------------------------------------------------


@query(
    "html_links",
    r"""with u as (select page_id, url, regexp_extract(url, '^([a-zA-Z]+://[^/?#]*)', 1) as origin,
        unnest(regexp_extract_all(regexp_replace(html, '(?s)<script.*?</script>', '', 'g'), '<a href="([^"]*)">', 1)) as href
        from pages)
    select page_id, split_part(origin || href, '?', 1) as href, count(*) as n from u group by all""",
)
def html_links(t):
    found = pages.links(t.pages, "page_id", "url", "html")
    return found.groupBy("page_id", "href").agg(F.count(F.lit(1)).alias("n"))


@query(
    "html_text",
    r"""select page_id, replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&amp;', '&'), '&lt;', '<') as title,
        regexp_extract(html, 'html lang="([^"]*)"', 1) as lang,
        len(regexp_extract_all(html, '<li>')) as items from pages where html is not null""",
)
def html_text(t):
    found = elements(
        t.pages,
        "page_id",
        "html",
        {"title": Selector("title"), "html": Selector("html"), "item": Selector("li")},
    )
    return x.page_fields(
        found,
        "page_id",
        {
            "title": x.first("title", x.all_text()),
            "lang": x.first("html", x.attr("lang")),
            "items": x.number_of("item"),
        },
    )


# --- pages made of table rows ------------------------------------------------


def _charity_pages(t):
    """A page of one of six types per customer."""
    key = F.col("c_custkey")
    balance = F.abs("c_acctbal")
    money = F.format_number(balance, 2)
    kind = key % 7
    meta = _text('<html><head><meta property="og:url" content="https://site.example/', key, '">',
                 '<link rel="canonical" href="https://site.example/u', key, '"></head><body>',
                 "<!-- <div id=\"event_page\"> -->")
    fundraiser = _text(
        '<div class="x fundTitle">t</div><div id="total_raised"><h3> $', money, "</h3></div>",
        _if(key % 2 == 0, '<h2 id="the_team_title">The Team: $', F.when(key % 4 == 0, money).otherwise("1"), "</h2>"),
        '<p id="benefiting_line">for <a href="/charity', key, '">c</a></p>',
        '<p id="event_date_line"><span> Jun 05, 2015 </span></p>',
        '<div id="organizer_line"><a href="/team/org', key, '">o</a></div>',
        '<div id="content">Story <b>of ', F.col("c_name"), "</b></div>",
        _if(key % 3 == 0, '<div class="fundraiser-type"><p><span>direct to organizer</span></p></div>',
            '<div class="ffa-title top"><h4><a data-profile="p|owner', key, '" href="#">n</a></h4></div>'),
        _if(key % 3 == 1, '<a class="big sponsorProject button" href="/donate/s', key, '">give</a>'),
        _if(key % 3 == 2, '<a class="fundraiser_profile_link"><img alt="', F.col("c_mktsegment"), '\'s photo"></a>'),
        '<script>var args = {"campaign_id": "', key, '", is_organizer: \'N\', member_type:none};</script>',
        '<div class="grid1-4 project_', key, " fundraiser_", key + 1, ' charity_9"><div><div><h4><a href="/p/m',
        key, '">m</a></h4></div><h3>$5.50</h3></div><p class="progressText"><span>$5.50 Raised of $1,000 Goal</span></p></div>',
        '<div class="grid1-4 project_ fundraiser_1"><div><div><h4><a href="/p/none">x</a></h4></div></div></div>',
    )
    user = _text(
        '<div id="myFundraisersContainer"></div><b id="score">1,00', key % 10, "</b>",
        _if(key % 2 == 0, '<div class="box moneyRaised"><a><h3>$', money, "</h3></a></div>"),
        '<a class="sponsorMember big" href="/donate/', key, '">d</a>',
        '<div class="grid1-4 project"><h4><a href="/a/', key, '">a</a></h4></div>',
        '<div class="grid1-4 project"><h4><a href="/b/', key, '">b</a></h4></div>',
        '<span class="memberTopNameBig">', F.col("c_name"), "</span>",
        '<div id="memberAboutTooltip"><p>Town \n , State</p><p>GIVING SINCE: Mar 04, 2013</p>'
        "<p>Stuff About Me:</p><p>About ", key, "</p></div>",
    )
    charity = _text(
        '<h2 id="fundraisers_section_title">F</h2><h1 id="charity_name"> ', F.col("c_name"), " </h1>",
        _if(key % 2 == 0, '<div id="player"></div>'),
        '<div class="moneyRaised"><h3>$', money, '</h3></div><div><div id="charityMissionScroll">Mission</div></div>',
        '<div id="memberEventsGrid"><div class="content"><a href="/e/', key, '">e</a></div></div>',
        '<div id="memberAboutTooltip"><div>\n\tBASED: Town ', key, '</div><div><span>Feb 01, 2010</span></div></div>',
        '<div id="main-content"><div class="siteAndEIN">EIN: 12-', key, '<a href="http://c', key, '.example">w</a></div></div>',
    )
    event = _text(
        '<div id="event_page"></div><b id="total_raised_amount">$', money, "</b>",
        '<div id="campaignMoneyRaised"><p class="progressText"><span>$1 Raised of $2,500 Goal</span></p></div>',
        '<div id="event_dates"><p>Event Date: <span>May 06, 2016</span></p><p>Deadline to give: <span>Jul 08, 2016</span></p></div>',
        '<div id="content"><p>One ', key, "</p><p>Two</p></div>", _if(key % 2 == 0, '<div id="video"></div>'),
    )
    body = (
        F.when(kind == 0, fundraiser).when(kind == 1, user).when(kind == 2, charity).when(kind == 3, event)
        .when(kind == 4, F.lit('<div id="custom_share"></div>'))
        .when(kind == 5, F.lit('<div class="jumbotron large"></div>'))
        .otherwise(F.lit("<p>nothing</p>"))
    )
    return t.customer.select(key.alias("loc"), kind.alias("kind"), _text(meta, body, "</body></html>").alias("html"))


@query(
    "classify_pages",
    """select c_custkey as loc, ['fundraiser', 'user', 'charity', 'event', 'special_user', 'front_page_redirect',
        'unknown'][c_custkey % 7 + 1] as page_type from customer
    union all select page_id + 1000000, 'unknown' from pages""",
)
def classify_pages(t):
    given = t.pages.select((F.col("page_id") + 1000000).alias("loc"), "html")
    made = _charity_pages(t).select("loc", "html").union(given)
    return x.classify(made, "html", page_specs.PAGE_MARKERS).select("loc", "page_type")


_MONEY = "round(abs(c_acctbal), 2)"


@query(
    "html_fields_fundraiser",
    f"""select c_custkey as loc, {_MONEY} as total_raised,
        case when c_custkey % 2 = 0 then {_MONEY} end as team_total_raised,
        'site.example/charity' || c_custkey as benefiting, date '2015-06-05' as event_date,
        'org' || c_custkey as parent_organizer_username, 'Story of ' || c_name as story,
        c_custkey % 3 = 0 as direct_to_organizer,
        case c_custkey % 3 when 0 then 'owner' || c_custkey when 1 then 's' || c_custkey else c_mktsegment end as username,
        cast(c_custkey as varchar) as campaign_id, 'false' as is_organizer, null::varchar as member_type,
        'site.example/' || c_custkey as true_url
    from customer where c_custkey % 7 = 0 and (c_custkey % 2 = 1 or c_custkey % 4 = 0 or {_MONEY} = 1)""",
)
def html_fields_fundraiser(t):
    made = _charity_pages(t).filter("kind = 0")
    rows = pages.fundraisers(made, "loc", "html", HOST).rows
    return rows.select(
        *"loc total_raised team_total_raised benefiting event_date parent_organizer_username story".split(),
        *"direct_to_organizer username campaign_id is_organizer member_type true_url".split(),
    )


@query(
    "html_sections_team",
    """select c_custkey as loc, 'm' || c_custkey as username, 5.5::double as amount_raised, 1000.0::double as goal,
        c_custkey as project_id, c_custkey + 1 as fundraiser_id, 9::bigint as charity_id
    from customer where c_custkey % 7 = 0 and c_custkey % 2 = 0""",
)
def html_sections_team(t):
    return pages.fundraisers(_charity_pages(t).filter("kind = 0"), "loc", "html", HOST).children["team"]


@query(
    "html_fields_user",
    f"""select c_custkey as loc, (1000 + c_custkey % 10)::double as impact_points,
        case when c_custkey % 2 = 0 then {_MONEY} end as money_raised, 'site.example/donate/' || c_custkey as donate_link,
        'u' || c_custkey as username, c_name as full_name, 2::bigint as number_of_projects, date '2013-03-04' as join_date,
        'About ' || c_custkey as about, 'Town, State' as location
    from customer where c_custkey % 7 = 1""",
)
def html_fields_user(t):
    rows = pages.users(_charity_pages(t).filter("kind = 1"), "loc", "html", HOST).rows
    return rows.drop("true_url")


@query(
    "html_fields_charity",
    f"""select c_custkey as loc, c_custkey % 2 = 0 as has_video, {_MONEY} as money_raised, c_name as name,
        'Mission' as mission, 'Town ' || c_custkey as location, date '2010-02-01' as started,
        '12-' || c_custkey as ein, 'http://c' || c_custkey || '.example' as site, 1::bigint as num_events
    from customer where c_custkey % 7 = 2""",
)
def html_fields_charity(t):
    return pages.charities(_charity_pages(t).filter("kind = 2"), "loc", "html", HOST).rows.drop("true_url")


@query(
    "html_fields_event",
    f"""select c_custkey as loc, {_MONEY} as amount_raised, 2500.0::double as goal, date '2016-05-06' as event_date,
        date '2016-07-08' as deadline_to_give, 'One ' || c_custkey || chr(10) || 'Two' as story,
        c_custkey % 2 = 0 as has_video, 'site.example/' || c_custkey as true_url
    from customer where c_custkey % 7 = 3""",
)
def html_fields_event(t):
    return pages.events(_charity_pages(t).filter("kind = 3"), "loc", "html").rows


@query(
    "parse_pages_batch",
    f"""with due as (select * from customer where c_custkey % 5 <> 0 and c_custkey % 11 <> 0)
    select 'fundraiser' as name, count(*) as n from due
        where c_custkey % 7 = 0 and (c_custkey % 2 = 1 or c_custkey % 4 = 0 or {_MONEY} = 1)
    union all select 'user', count(*) from due where c_custkey % 7 = 1
    union all select 'user_project', 2 * count(*) from due where c_custkey % 7 = 1
    union all select 'charity', count(*) from due where c_custkey % 7 = 2
    union all select 'charity_event', count(*) from due where c_custkey % 7 = 2
    union all select 'event', count(*) from due where c_custkey % 7 = 3
    union all select 'team', count(*) from due where c_custkey % 7 = 0 and c_custkey % 2 = 0
    union all select 'unknown', count(*) from due where c_custkey % 7 = 6
    union all select 'done', count(*) from due where c_custkey % 7 <> 6""",
)
def parse_pages_batch(t):
    batch = _page_batch(t)
    counted = dict(batch.tables, unknown=batch.unknown, done=batch.done)
    names = "fundraiser user user_project charity charity_event event team unknown done".split()
    counts = [counted[n].agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("name"), "n") for n in names]
    return reduce(DataFrame.union, counts)


_DUE = "from customer where c_custkey % 5 <> 0 and c_custkey % 11 <> 0"


@query(
    "parse_pages_children",
    f"""select 'user_project' as name, 'u' || c_custkey as parent, 'site.example/' || p || '/' || c_custkey as child
        from (select *, unnest(['a', 'b']) as p {_DUE} and c_custkey % 7 = 1)
    union all select 'charity_event', 'https://site.example/' || c_custkey, 'site.example/e/' || c_custkey
        {_DUE} and c_custkey % 7 = 2
    union all select 'bad_encoding', 'https://site.example/' || c_custkey, null {_DUE} and c_custkey % 13 = 0""",
)
def parse_pages_children(t):
    batch = _page_batch(t)

    def shown(name, rows, parent, child):
        return rows.select(F.lit(name).alias("name"), F.col(parent).alias("parent"), child.alias("child"))

    parts = [
        shown("user_project", batch.tables["user_project"], "username", F.col("project")),
        shown("charity_event", batch.tables["charity_event"], "charity", F.col("event")),
        shown("bad_encoding", batch.bad_encoding, "loc", F.lit(None).cast("string")),
    ]
    return reduce(DataFrame.union, parts)


def _page_batch(t):
    """Stored pages of one site, some never parsed, some with bytes that are not UTF-8."""
    made = _charity_pages(t)
    made = made.withColumn("html", F.concat("html", F.when(F.col("loc") % 13 == 0, "\u00e9").otherwise("")))
    last = F.when(F.col("loc") % 5 == 0, F.lit("2024-01-05").cast("timestamp_ntz"))
    store = made.select(_text("https://site.example/", F.col("loc")).alias("loc"), "html", last.alias("last_scrape"))
    kinds = F.when(F.col("loc") % 11 == 0, F.array(F.lit("static"))).otherwise(F.array(F.lit("static"), F.lit("users")))
    listed = made.select(
        _text("https://site.example/", F.col("loc")).alias("loc"),
        F.lit("2024-01-04").cast("timestamp_ntz").alias("lastmod"),
        kinds.alias("categories"),
    )
    return pages.parse_batch(store, listed, HOST, "https://site.example", F.lit("2024-02-01").cast("timestamp_ntz"))


# --- project pages -----------------------------------------------------------


@query(
    "html_embedded_json",
    """select o_orderkey as page, o_orderkey as id, 'Project "' || o_orderkey || '" & co' as name, o_totalprice as pledged
    from orders where o_orderkey % 4 <> 0""",
)
def html_embedded_json(t):
    return _embedded(t)[0].select("page", "document.*")


@query(
    "html_embedded_json_rejects",
    "select o_orderkey as page, case when o_orderkey % 8 = 0 then 0 else 2 end as hits from orders where o_orderkey % 4 = 0",
)
def html_embedded_json_rejects(t):
    return _embedded(t)[1]


def _embedded(t):
    key = F.col("o_orderkey")
    name = _text('Project "', key, '" & co')
    data = F.to_json(F.struct(key.alias("id"), name.alias("name"), F.col("o_totalprice").alias("pledged")))
    literal = F.replace(F.replace(data, F.lit("&"), F.lit("&amp;")), F.lit("\\"), F.lit("\\\\"))
    literal = F.replace(literal, F.lit('"'), F.lit("&quot;"))
    script = _text('<script>\nwindow.current_project = "', literal, '";\nother = "x";</script>')
    html = (
        F.when(key % 8 == 0, F.lit("<html><p>none</p></html>"))
        .when(key % 4 == 0, _text("<html>", script, script, "</html>"))
        .otherwise(_text("<html><p>a</p>", script, "</html>"))
    )
    made = t.orders.select(key.alias("page"), html.alias("html"))
    return x.embedded_json(
        made, "page", "html", 'current_project = "(.*)";', "id bigint, name string, pledged double"
    )


@query(
    "html_attr_json",
    "select c_custkey as page, c_custkey as id, c_name as name, c_acctbal as pledged from customer where c_custkey % 5 <> 0",
)
def html_attr_json(t):
    key = F.col("c_custkey")
    data = F.to_json(F.struct(key.alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("pledged")))
    html = _text('<b class="count">1 project</b>', _if(key % 5 != 0, '<div class="c" data-project="', _attr_json(data), '">x</div>'))
    made = t.customer.select(key.alias("page"), html.alias("html"))
    schema = "id bigint, name string, pledged double"
    return pages.listed_projects(made, "page", "html", schema).select("page", "document.*")


@query(
    "html_attr_locations",
    "select distinct n_name as displayable_name, cast(n_nationkey as bigint) as id, 'CA' as status"
    " from nation join customer on c_nationkey = n_nationkey",
)
def html_attr_locations(t):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    place = F.to_json(
        F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("displayable_name"), F.lit("CA").alias("state"))
    )
    html = _text('<div class="project-location"><a data-location="', _attr_json(place), '">here</a></div>')
    made = joined.select(F.col("c_custkey").alias("page"), html.alias("html"))
    schema = "id bigint, displayable_name string, state string, urls string"
    return pages.listed_locations(made, "page", "html", schema)


@query(
    "html_table",
    """select s_suppkey as page, '10.0.0.' || s_suppkey || ':' || (8000 + i) as proxy
    from (select *, unnest(range(1, s_nationkey % 4 + 1)) as i from supplier) where i <> 2""",
)
def html_table(t):
    return pages.proxies(_proxy_pages(t), "page", "html")[0]


@query(
    "html_table_rejects",
    "select s_suppkey as page, 1::bigint as n from supplier",
)
def html_table_rejects(t):
    rejected = pages.proxies(_proxy_pages(t), "page", "html")[1]
    return rejected.groupBy("page").agg(F.count(F.lit(1)).alias("n"))


def _proxy_pages(t):
    key = F.col("s_suppkey")
    numbers = F.filter(F.sequence(F.lit(1), F.lit(4)), lambda i: i <= F.col("s_nationkey") % 4)
    rows = F.transform(
        numbers,
        lambda i: _text(
            "<tr><td>10.0.0.", key, "</td><td>", i + 8000, "</td><td>",
            F.when(i == 1, "anonymous").when(i == 2, "transparent").otherwise("elite proxy"), "</td><td></td></tr>",
        ),
    )
    html = _text(
        '<table id="proxylisttable"><thead><tr><th>IP Address</th><th>Port</th><th>Anonymity</th><th>Seen</th></tr></thead>',
        "<tbody><tr><td>short</td></tr>", F.array_join(rows, ""), "</tbody></table>",
    )
    return t.supplier.select(key.alias("page"), html.alias("html"))


@query(
    "html_sections_comments",
    """select conv_id as page, conv_id * 100 + turn as id, case when turn % 3 <> 0 then 'u' || conv_id end as user_id,
        case when turn % 3 <> 0 then role end as user_name, turn % 3 = 0 as author_deleted,
        'first ' || turn || chr(10) || 'second' as body,
        case when turn % 2 = 0 then date '2014-05-06' else date '2014-06-07' end as post_date,
        case when role = 'user' then 'superbacker' end as badge
    from conversations""",
)
def html_sections_comments(t):
    turn = F.col("turn")
    section = _text(
        '<li id="comment-', F.col("conv_id") * 100 + turn, '">',
        F.when(turn % 3 == 0, F.lit('<span class="author">deleted</span>')).otherwise(
            _text('<a class="author big" href="/profile/u', F.col("conv_id"), '">', F.col("role"), "</a>")
        ),
        _if(F.col("role") == "user", '<span class="repeat superbacker-badge">S</span>'),
        "<p>first ", turn, "<p>second</p>",
        F.when(turn % 2 == 0, '<time datetime="&quot;2014-05-06T10:00:00-04:00&quot;">t</time>').otherwise(
            '<span class="date"><a>Jun 7, 2014</a></span>'
        ),
        "</li>",
    )
    # one page per turn, so building pages needs no grouping; comments of a page come in any number
    made = t.conversations.select(
        F.struct("conv_id", "turn").alias("k"), "conv_id",
        _text('<ul><li class="page"><ol class="comments">', section, "</ol></li><li>", "x</li></ul>").alias("html"),
    )
    keyed = made.select((F.col("k.conv_id") * 1000 + F.col("k.turn")).alias("page"), "html")
    rows = pages.comments(keyed, "page", "html")
    return rows.withColumn("page", F.floor(F.col("page") / 1000))


_STATES = "['live', 'failed', 'canceled', 'suspended', 'successful', 'purged', 'copyright', '404'][o_orderkey % 8 + 1]"


@query(
    "html_fields_project",
    f"""with s as (select *, {_STATES} as state from orders)
    select o_orderkey as page, case when state <> '404' then o_orderkey end as projectid, state,
        case when state = 'copyright' then 'Name' when state not in ('purged', '404') then 'T' || o_orderkey end as title,
        case when state not in ('purged', '404', 'copyright') then 'Summary text' end as description,
        case when state not in ('purged', '404', 'copyright') then o_custkey end as backers_count,
        case when state not in ('purged', '404', 'copyright') then cast(floor(o_totalprice) as bigint) end as amount_pledged,
        case when state not in ('purged', '404', 'copyright') then 5000::bigint end as goal,
        case when state not in ('purged', '404', 'copyright') then 'USD' end as currency,
        case when state not in ('purged', '404', 'copyright') then case when o_orderkey % 2 = 0 or state = 'successful'
            then 'Town' else '' end end as location,
        case when state not in ('purged', '404', 'copyright') then 'Games' end as category,
        case when state not in ('purged', '404', 'copyright') then date '2014-01-02' end as start_date,
        case when state not in ('purged', '404', 'copyright') then date '2014-02-03' end as end_date,
        case when state = 'canceled' then date '2014-01-20' when state not in ('purged', '404', 'copyright')
            then date '2014-02-03' end as state_changed_at
    from s""",
)
def html_fields_project(t):
    key, owner = F.col("o_orderkey"), F.col("o_custkey")
    names = [F.lit(s) for s in ("live", "failed", "canceled", "suspended", "successful", "purged", "copyright", "404")]
    state = F.get(F.array(*names), (key % 8).cast("int"))
    pledged = F.format_number("o_totalprice", 2)
    launched = '<div class="timeline__divider timeline__divider--launched"><time datetime="2014-01-02T10:00:00-05:00"></time></div>'
    place = F.when(key % 2 == 0, F.lit("<b>Town</b><b>Games</b>")).otherwise(F.lit("<b>Games</b>"))
    running = _text(
        '<div class="NS_projects__header"><h2><a href="#">T', key, "</a></h2></div><b>elsewhere</b><div><p>Summary\n text</p>",
        '<div><div id="project_share"><p>no</p></div><i>', place, "</i></div></div>",
        '<div id="backers_count" data-backers-count="', owner, '"></div><span class="money usd">$77</span>',
        '<div><div id="pledged"><data>$', pledged, '</data></div><span><span class="money usd no-code">$5,000</span></span></div>',
        '<span id="project_duration_data" data-end_time="2014-02-03T23:00:00-05:00"></span>',
        _if(state == "canceled", '<div class="NS_projects__funding_bar"><p><data data-value="&quot;2014-01-20T01:00:00Z&quot;"></data></p></div>'),
    )
    won = _text(
        '<div class="NS_project_profile__title"><h2><a>T', key, "</a></h2></div>",
        '<div class="NS_project_profiles__blurb"><div><span><span>Summary\n text</span></span></div></div>',
        '<div class="NS_projects__spotlight_stats"><b>', F.format_number(owner, 0), ' backers</b></div>',
        '<span class="money usd">$', pledged, '</span><span class="money usd">$5,000</span>',
        '<div class="NS_projects__funding_period"><time datetime="2014-01-02"></time><time datetime="2014-02-03T00:00:00"></time></div>',
        '<div class="row"><div><div><a><b>Town</b></a><a><b>Games</b></a></div></div></div><b>elsewhere</b>',
    )
    body = (
        F.when(state == "404", F.lit("<h1>404</h1>"))
        .when(state == "copyright", F.lit(f'<div id="hidden_project"><p><strong>Name{page_specs.DISPUTED}</strong></p></div>'))
        .when(state == "purged", F.lit('<div id="purged_project"></div>'))
        .when(state == "successful", won)
        .otherwise(running)
    )
    shown = F.when(state == "copyright", F.lit("live")).otherwise(state)
    main = _if(state != "404", '<div id="main_content" class="Project', key, "_cxt Project-state-", shown, ' Project-ended">')
    made = t.orders.select(key.alias("page"), _text("<html><body>", main, body, launched, "</div></body></html>").alias("html"))
    return pages.project_states(made, "page", "html")


def _community_pages(t):
    key = F.col("c_custkey")
    count = F.format_number(key, 0)
    place = _text(
        '<div class="location"><div class="primary-text js-location-primary-text"><a href="/d?sort=x&amp;woe_id=', key,
        '&amp;p=1"> Place ', key, " </a></div>",
    )
    tail = _text('<div class="tertiary-text js-location-tertiary-text"> ', count, " backers </div></div>")
    second = '<div class="secondary-text js-location-secondary-text"><a>Country</a></div>'
    full = _text(
        '<div class="location-list js-locations-countries">', place, tail, "</div>",
        '<div class="location-list js-locations-cities">', place, second, tail, place, second, tail, "</div>",
        '<div class="new-backers"><div class="count">', count, '</div></div><div class="existing-backers"><div class="count"> 1,234 </div></div>',
    )
    html = (
        F.when(key % 5 == 0, F.lit(f'<h3 class="normal mb3 mb7-sm"> {page_specs.NO_BACKERS} </h3>'))
        .when(key % 5 == 1, F.lit(f'<h3 class="normal mb3 mb7-sm">4 people {page_specs.FEW_BACKERS}</h3>'))
        .when(key % 5 == 2, F.lit('<div id="purged_project"></div>'))
        .otherwise(full)
    )
    return t.customer.select(key.alias("page"), html.alias("html"))


@query(
    "html_fields_community",
    """select c_custkey as page, ['No backers', 'Few backers', 'Purged'][c_custkey % 5 + 1] as error_message,
        case when c_custkey % 5 > 2 then c_custkey end as new_backers,
        case when c_custkey % 5 > 2 then 1234::bigint end as repeat_backers from customer""",
)
def html_fields_community(t):
    return pages.community(_community_pages(t), "page", "html").rows


@query(
    "html_sections_community",
    """select c_custkey as page, 'Place ' || c_custkey as primary_location, c_custkey as location_id,
        'Country' as secondary_location, c_custkey as num_backers, 2::bigint as n from customer where c_custkey % 5 > 2
    union all select c_custkey, 'Place ' || c_custkey, c_custkey, null, c_custkey, 1 from customer where c_custkey % 5 > 2""",
)
def html_sections_community(t):
    children = pages.community(_community_pages(t), "page", "html").children
    rows = children["backers_in_city"].unionByName(children["backers_in_country"], allowMissingColumns=True)
    return rows.groupBy("page", "primary_location", "location_id", "secondary_location", "num_backers").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "html_sections_rewards",
    """select p_partkey as page, i * 10 as amount_required, p_partkey as backer_count,
        case when i <> 2 then p_name end as description, case when i = 1 then '2014-08-01' end as delivery,
        case when i = 2 then 1500::bigint end as backer_limit, case when i = 1 then 'Ships anywhere' end as shipping_note
    from (select *, unnest(range(1, p_size % 3 + 1)) as i from part) where p_partkey % 6 <> 0 and p_partkey % 7 <> 0""",
)
def html_sections_rewards(t):
    key = F.col("p_partkey")
    number = F.col("p_size") % 3
    levels = F.filter(F.sequence(F.lit(1), F.lit(3)), lambda i: i <= number)
    reward = F.transform(
        levels,
        lambda i: _text(
            '<div class="x NS_backer_rewards__reward"><h5>Pledge $', i * 10, ".00 or more</h5><p><span><span>",
            F.format_number(key, 0), ' backers</span></span><i><span class="limited-number">',
            F.when(i == 2, F.lit("Limited (3 left of 1,500)")).otherwise("all"), "</span></i></p>",
            '<div class="desc h5"><p>', F.when(i == 2, F.lit(" ")).otherwise(F.col("p_name")), "</p></div>",
            F.when(
                i == 1,
                F.lit('<div class="shipping-wrap"><b><time datetime="2014-08-01">Aug</time></b></div><div>'
                      '<div class="NS_backer_rewards__shipping"><span> Ships </span><span>anywhere</span></div></div>'),
            ).otherwise(""),
            "</div>",
        ),
    )
    declared = F.when(key % 7 == 0, number + 1).otherwise(number)
    html = _text(
        _if(key % 6 == 0, '<div id="purged_project"></div>'),
        '<ul class="list mt2" data-reward-count="', declared, '"><li>', F.array_join(reward, ""), "</li></ul>",
    )
    made = t.part.select(key.alias("page"), html.alias("html"))
    return pages.rewards(made, "page", "html")


@query(
    "html_timeline",
    """with e as (select s_suppkey, 1 as n, 'timeline__divider--launched' as kind, 'Launched' as title, 1388657100 as posted
            from supplier
        union all select s_suppkey, 2, 'timeline__item--left', s_name, 1389866400 from supplier
        union all select s_suppkey, 3, 'timeline__divider--successful',
            case when s_nationkey % 2 = 0 then 'Funded' else 'Success' end, 1391385600 from supplier
        union all select s_suppkey, 4, 'timeline__divider--potd', 'Project of the day', 1391472000 from supplier
            where s_nationkey % 3 = 0)
    select s_suppkey as page, n::bigint as update_number, kind, posted::bigint as post_unix_timestamp, title
    from e where s_suppkey % 6 <> 0""",
)
def html_timeline(t):
    key = F.col("s_suppkey")
    html = _text(
        _if(key % 6 == 0, f'<div id="hidden_project"><strong>N{page_specs.DISPUTED}</strong></div>'),
        '<div class="timeline"><div class="timeline__divider timeline__divider--month">May</div>',
        '<div class="timeline__divider timeline__divider--launched"><time datetime="2014-01-02T10:05:00Z"></time><div class="f2"> Launched </div></div>',
        '<div class="timeline__divider"><b>x</b></div>',
        '<div class="timeline__item timeline__item--left"><div><time datetime="2014-01-16T10:00:00Z"></time><h2 class="grid-post__title">',
        F.col("s_name"), "</h2></div></div>",
        '<div class="timeline__divider timeline__divider--successful"><time datetime="2014-02-03T00:00:00Z"></time>',
        _if(F.col("s_nationkey") % 2 == 0, '<div class="h3">Funded</div>'), "</div>",
        _if(F.col("s_nationkey") % 3 == 0, '<div class="timeline__divider timeline__divider--potd"><div><b> Project of the day </b></div>'
            '<time datetime="2014-02-04T00:00:00Z"></time></div>'),
        "</div>",
    )
    return pages.timeline(t.supplier.select(key.alias("page"), html.alias("html")), "page", "html")


@query(
    "html_fields_creator",
    """select s_suppkey as page, case when s_suppkey % 3 <> 0 then s_name end as location_name,
        cast(s_nationkey % 3 as bigint) as links from supplier""",
)
def html_fields_creator(t):
    key = F.col("s_suppkey")
    numbers = F.filter(F.sequence(F.lit(1), F.lit(3)), lambda i: i <= F.col("s_nationkey") % 3)
    anchors = F.transform(numbers, lambda i: _text('<li><a target="_blank" href="http://e', i, '.example">e</a>'))
    html = _text(
        _if(key % 3 != 0, '<p class="f5 bold mb0">', F.col("s_name"), "</p>"),
        '<ul class="menu links">', F.array_join(anchors, ""), '</ul><ul class="links"></ul>',
    )
    bios = pages.creator_bios(t.supplier.select(key.alias("page"), html.alias("html")), "page", "html")
    links = bios.children["creator_external_url"].groupBy("page").agg(F.count(F.lit(1)).alias("links"))
    return bios.rows.join(links, "page", "left").withColumn("links", F.coalesce("links", F.lit(0)))
