"""What to select on each kind of page.

Fixed values: element ids, classes and texts of the page layouts.
"""

from __future__ import annotations

from pledgeflow.sources.html import Selector as S

# charity-fundraising pages: one marker per page type
PAGE_MARKERS = {
    "fundraiser": r'<div[^>]*class="[^"]*fundTitle',
    "user": r'id="myFundraisersContainer"',
    "charity": r'id="fundraisers_section_title"',
    "event": r'id="event_page"',
    "special_user": r'id="custom_share"',
    "front_page_redirect": r'<div[^>]*class="jumbotron large"',
}

FUNDRAISER = {
    "og_url": S("meta", where=("property", "og:url")),
    "total_box": S(id="total_raised"),
    "total": S("h3", child_of="total_box"),
    "team_title": S(id="the_team_title"),
    "benefiting_line": S("p", id="benefiting_line"),
    "benefiting": S("a", child_of="benefiting_line"),
    "event_line": S("p", id="event_line"),
    "event": S("a", child_of="event_line"),
    "event_date_line": S("p", id="event_date_line"),
    "event_date": S("span", child_of="event_date_line"),
    "organizer_line": S(id="organizer_line"),
    "organizer": S("a", child_of="organizer_line"),
    "story": S("div", id="content"),
    "type_box": S("div", cls="fundraiser-type"),
    "type": S("span", inside="type_box"),
    "title_box": S("div", cls_has="ffa-title"),
    "title_profile": S("a", attr="data-profile", inside="title_box"),
    "sponsor": S("a", cls_has="sponsorProject button"),
    "registry": S("a", cls_has="donateRegistry button"),
    "profile_link": S("a", cls="fundraiser_profile_link"),
    "profile_image": S("img", child_of="profile_link"),
    "script": S("script"),
    "member": S("div", cls_has="grid1-4"),
    "member_title": S("h4", inside="member"),
    "member_link": S("a", child_of="member_title"),
    "member_amount": S("h3", inside="member"),
    "member_progress": S("p", cls="progressText", inside="member"),
    "member_goal": S("span", child_of="member_progress"),
}

USER = {
    "og_url": S("meta", where=("property", "og:url")),
    "canonical": S("link", where=("rel", "canonical")),
    "score": S(id="score"),
    "raised_box": S("div", cls_has="moneyRaised"),
    "raised": S("h3", inside="raised_box"),
    "donate": S("a", cls_has="sponsorMember"),
    "project": S("div", cls="grid1-4 project"),
    "project_title": S("h4", inside="project"),
    "project_link": S("a", child_of="project_title"),
    "full_name": S("span", cls="memberTopNameBig"),
    "about": S(id="memberAboutTooltip"),
    "about_part": S(inside="about"),
}

CHARITY = {
    "og_url": S("meta", where=("property", "og:url")),
    "player": S(id="player"),
    "raised_box": S("div", cls_has="moneyRaised"),
    "raised": S("h3", child_of="raised_box"),
    "name": S(id="charity_name"),
    "mission": S(id="charityMissionScroll"),
    "events": S(id="memberEventsGrid"),
    "event_box": S("div", cls="content", inside="events"),
    "event_link": S("a", child_of="event_box"),
    "about": S(id="memberAboutTooltip"),
    "based": S("div", child_of="about"),
    "started": S("span", inside="about"),
    "site_box": S("div", cls="siteAndEIN"),
    "site": S("a", child_of="site_box"),
}

EVENT = {
    "og_url": S("meta", where=("property", "og:url")),
    "raised": S(id="total_raised_amount"),
    "goal_box": S(id="campaignMoneyRaised"),
    "progress": S("p", cls="progressText", inside="goal_box"),
    "goal": S("span", child_of="progress"),
    "dates": S(id="event_dates"),
    "date_line": S(inside="dates"),
    "date": S("span", child_of="date_line"),
    "content": S(id="content"),
    "story": S("p", inside="content"),
    "video": S(id="video"),
}

SPECS = {"fundraiser": FUNDRAISER, "user": USER, "charity": CHARITY, "event": EVENT}

# project pages
PROJECT = {
    "h1": S("h1"),
    "title": S("title"),
    "main": S("div", id="main_content"),
    "hidden": S("div", id="hidden_project"),
    "hidden_text": S("strong", inside="hidden"),
    "header": S("div", cls_has="NS_projects__header"),
    "header_link": S("a", inside="header"),
    "profile_title": S("div", cls_has="NS_project_profile__title"),
    "profile_link": S("a", inside="profile_title"),
    "blurb": S("div", cls="NS_project_profiles__blurb"),
    "blurb_text": S("span", inside="blurb"),
    "share": S("div", id="project_share"),
    "bold": S("b"),
    "paragraph": S("p"),
    "row": S("div", cls="row"),
    "row_column": S("div", child_of="row"),
    "row_cell": S("div", child_of="row_column"),
    "row_link": S("a", child_of="row_cell"),
    "row_place": S("b", child_of="row_link"),
    "backers": S("div", id="backers_count"),
    "spotlight": S("div", cls="NS_projects__spotlight_stats"),
    "spotlight_backers": S("b", child_of="spotlight"),
    "pledged": S("div", id="pledged"),
    "pledged_data": S("data", child_of="pledged"),
    "money": S("span", cls_has="money"),
    "duration": S("span", id="project_duration_data"),
    "period": S("div", cls="NS_projects__funding_period"),
    "period_time": S("time", inside="period"),
    "launched": S("div", cls_has="timeline__divider--launched"),
    "launched_time": S("time", inside="launched"),
    "funding_bar": S("div", cls_has="NS_projects__funding_bar"),
    "cancelled": S("data", inside="funding_bar", attr="data-value"),
}

DISPUTED = " is the subject of an intellectual property dispute and is currently unavailable."
OVERLOADED = "We're sorry, but something went wrong (500)"

COMMENTS = {
    "page": S("li", cls="page"),
    "list": S("ol", cls="comments", child_of="page"),
    "comment": S("li", child_of="list"),
    "author": S("a", cls_has="author", inside="comment"),
    "gone": S("span", cls_has="author", inside="comment"),
    "body": S("p", inside="comment"),
    "time": S("time", inside="comment"),
    "date_box": S("span", cls_has="date", inside="comment"),
    "date": S("a", child_of="date_box"),
    "badge": S(cls_has="-badge", inside="comment"),
}

COMMUNITY = {
    "notice": S("h3", cls="normal mb3 mb7-sm"),
    "purged": S(id="purged_project"),
    "hidden": S(id="hidden_project"),
    "countries": S("div", cls="location-list js-locations-countries"),
    "cities": S("div", cls="location-list js-locations-cities"),
    "country": S("div", child_of="countries"),
    "city": S("div", child_of="cities"),
    "primary": S("div", cls="primary-text js-location-primary-text"),
    "primary_link": S("a", child_of="primary"),
    "secondary": S("div", cls="secondary-text js-location-secondary-text"),
    "secondary_link": S("a", child_of="secondary"),
    "count": S("div", cls="tertiary-text js-location-tertiary-text"),
    "new": S("div", cls="new-backers"),
    "new_count": S("div", cls="count", child_of="new"),
    "existing": S("div", cls="existing-backers"),
    "existing_count": S("div", cls="count", child_of="existing"),
}

NO_BACKERS = "This project doesn't have any backers yet."
FEW_BACKERS = "backed this project and the community is still growing!"

REWARDS = {
    "purged": S("div", id="purged_project"),
    "list": S("ul", cls="list mt2"),
    "reward": S("div", cls_has="NS_backer_rewards__reward"),
    "amount": S("h5", child_of="reward"),
    "backers_line": S("p", child_of="reward"),
    "backers_box": S("span", child_of="backers_line"),
    "backers": S("span", child_of="backers_box"),
    "description_box": S("div", cls_has="desc", child_of="reward"),
    "description": S("p", child_of="description_box"),
    "shipping": S("div", cls="shipping-wrap", child_of="reward"),
    "delivery": S("time", inside="shipping"),
    "limit": S("span", cls="limited-number", inside="reward"),
    "note_box": S("div", cls="NS_backer_rewards__shipping", inside="reward"),
    "note": S("span", child_of="note_box"),
}

TIMELINE = {
    "hidden": S("div", id="hidden_project"),
    "hidden_text": S("strong", inside="hidden"),
    "timeline": S("div", cls="timeline"),
    "entry": S("div", child_of="timeline"),
    "time": S("time", inside="entry"),
    "post_title": S("h2", cls="grid-post__title", inside="entry"),
    "large_title": S("div", cls="f2", inside="entry"),
    "success_title": S("div", cls="h3", inside="entry"),
    "notice": S("div", cls="mb2", inside="entry"),
    "notice_title": S("b", child_of="notice"),
    "inner": S("div", child_of="entry"),
    "inner_title": S("b", child_of="inner"),
}

# class token of a timeline entry -> the element that holds its title
TIMELINE_TITLES = {
    "timeline__divider--cancellation": "notice_title",
    "timeline__divider--failure": "notice_title",
    "timeline__divider--successful": "success_title",
    "timeline__divider--launched": "large_title",
    "timeline__item--right": "post_title",
    "timeline__item--left": "post_title",
    "timeline__divider--potd": "inner_title",
}

CREATOR_BIO = {
    "location": S("p", cls="f5 bold mb0"),
    "links": S("ul", cls_has="links"),
    "link": S("a", inside="links"),
}

LISTING = {"card": S("div", attr="data-project"), "counter": S("b", cls_has="count")}
LOCATIONS = {"box": S("div", cls="project-location"), "link": S("a", child_of="box", attr="data-location")}
LINKS = {"link": S("a", attr="href")}
PROXIES = {
    "table": S("table", id="proxylisttable"),
    "head": S("thead", child_of="table"),
    "body": S("tbody", child_of="table"),
    "header": S("th", inside="head"),
    "row": S("tr", child_of="body"),
    "cell": S("td", child_of="row"),
}
