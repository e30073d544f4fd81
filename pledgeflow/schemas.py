"""Document and table layouts.

Fixed values: field names and types of the source documents and of the flat tables.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- documents ---------------------------------------------------------------

LOAN_DOCUMENT = """
    id bigint, name string, status string, funded_amount double, basket_amount double,
    paid_amount double, activity string, sector string, use string, delinquent boolean,
    partner_id bigint, posted_date string, planned_expiration_date string, loan_amount double,
    lender_count bigint, borrower_count bigint, currency_exchange_loss_amount double,
    bonus_credit_eligibility boolean, funded_date string, paid_date string,
    borrowers array<struct<first_name: string, last_name: string, gender: string, pictured: boolean>>,
    description struct<languages: array<string>, texts: map<string, string>>,
    image struct<id: bigint, template_id: bigint>,
    journal_totals struct<entries: bigint, bulkEntries: bigint>,
    location struct<country: string, country_code: string, town: string,
        geo: struct<pairs: string, type: string, level: string>>,
    payments array<struct<payment_id: bigint, amount: double, processed_date: string,
        settlement_date: string, rounded_local_amount: bigint,
        currency_exchange_loss_amount: double, local_amount: double>>,
    tags array<struct<name: string>>,
    themes array<string>,
    terms struct<disbursal_amount: double, disbursal_currency: string, disbursal_date: string,
        loan_amount: double, repayment_interval: string, repayment_term: bigint,
        loss_liability: struct<currency_exchange: string, currency_exchange_coverage_rate: double,
            nonpayment: string>,
        local_payments: array<struct<due_date: string, amount: double>>,
        scheduled_payments: array<struct<due_date: string, amount: double>>>,
    translator struct<byline: string, image: bigint>,
    video struct<id: bigint, youtubeId: string, title: string, thumbnailImageId: bigint>
"""

LENDER_LINK_DOCUMENT = "id bigint, lender_ids array<string>"

LENDER_DOCUMENT = """
    lender_id string, country_code string, image struct<id: bigint, template_id: bigint>,
    invitee_count bigint, inviter_id string, loan_because string, loan_count bigint,
    member_since string, name string, occupation string, occupational_info string,
    personal_url string, uid string, whereabouts string
"""

_PROFILE = """background_color: string, background_image_opacity: double, blurb: string, id: bigint,
    link_background_color: string, link_text: string, link_text_color: string, link_url: string,
    name: string, project_id: bigint, should_show_feature_image_section: string,
    show_feature_image: string, state: string, state_changed_at: bigint, text_color: string"""

PROJECT_DOCUMENT = f"""
    id bigint, name string, blurb string, goal decimal(20,4), pledged decimal(12,4), state string,
    slug string, country string, currency string, currency_symbol string,
    currency_trailing_code string, disable_communication string, deadline bigint,
    created_at bigint, launched_at bigint, state_changed_at bigint, successful_at bigint,
    updated_at bigint, staff_pick string, spotlight string, static_usd_rate decimal(20,10),
    usd_pledged decimal(20,10), backers_count bigint, comments_count bigint, updates_count bigint,
    category struct<id: bigint, name: string, parent_id: bigint, position: bigint, color: bigint,
        slug: string, urls: struct<web: struct<discover: string>>>,
    creator struct<id: bigint, name: string, slug: string, is_registered: string,
        chosen_currency: string, avatar: struct<thumb: string, small: string, medium: string>,
        urls: struct<web: struct<user: string>, api: struct<user: string>>>,
    items array<struct<id: bigint, name: string, taxable: string, edit_path: string, amount: bigint>>,
    livestreams array<struct<id: bigint, live_now: string, name: string, start_date: bigint, url: string>>,
    location struct<id: bigint, displayable_name: string, type: string, name: string, state: string,
        short_name: string, is_root: string, country: string, slug: string, localized_name: string,
        urls: struct<api: struct<nearby_projects: string>, web: struct<discover: string, location: string>>>,
    rewards array<struct<id: bigint, title: string, reward: string, title_for_backing_tier: string,
        shipping_preference: string, description: string, shipping_summary: string, limit: bigint,
        estimated_delivery_on: bigint, ends_at: bigint, starts_at: bigint, updated_at: bigint,
        shipping_enabled: string, backers_count: bigint, remaining: bigint, minimum: decimal(12,4),
        urls: struct<api: struct<reward: string>>,
        rewards_items: array<struct<id: bigint, reward_id: bigint, quantity: bigint, position: bigint,
            item: struct<id: bigint, name: string, amount: string, taxable: string, edit_path: string,
                project_id: bigint>>>>>,
    photo map<string, string>,
    profile struct<{_PROFILE}>,
    urls struct<web: struct<project: string, project_short: string, rewards: string, updates: string>>,
    video struct<id: bigint, high: string, webm: string, height: bigint, width: bigint, status: string>
"""

SITEMAP_URL = "loc string, lastmod string, changefreq string, priority string"

# --- flat tables -------------------------------------------------------------

LOAN_TABLES = {
    "loan": """id bigint, name string, status string, funded_amount double, basket_amount double,
        paid_amount double, image_id bigint, image_template_id bigint, video_id bigint,
        video_youtube_id string, video_title string, video_thumbnail_image_id bigint,
        activity string, sector string, use string, delinquent boolean, country_code string,
        country string, town string, geo_level string, geo_pairs string, geo_type string,
        partner_id bigint, posted_date timestamp_ntz, planned_expiration_date timestamp_ntz,
        loan_amount double, lender_count bigint, borrower_count bigint,
        currency_exchange_loss_amount double, bonus_credit_eligibility boolean,
        terms_disbursal_date timestamp_ntz, terms_disbursal_currency string,
        terms_disbursal_amount double, terms_repayment_interval string,
        terms_repayment_term bigint, terms_loan_amount double,
        terms_loss_liability_nonpayment string, terms_loss_liability_currency_exchange string,
        terms_loss_liability_currency_exchange_coverage_rate double, funded_date timestamp_ntz,
        paid_date timestamp_ntz, journal_total_entries bigint, journal_total_bulk_entries bigint,
        translator_byline string, translator_image_id bigint, scrape_time timestamp_ntz""",
    "theme": "loan_id bigint, theme string",
    "loan_lender": "loan_id bigint, lender_id string",
    "lender": """lender_id string, country_code string, image_id bigint, image_template_id bigint,
        invitee_count bigint, inviter_id string, loan_because string, loan_count bigint,
        member_since timestamp_ntz, name string, occupation string, occupational_info string,
        personal_url string, uid string, whereabouts string""",
    "tag": "loan_id bigint, name string",
    "payment": """id bigint, loan_id bigint, amount double, processed_date timestamp_ntz,
        settlement_date timestamp_ntz, rounded_local_amount bigint,
        currency_exchange_loss_amount double, local_amount double""",
    "local_payment": "loan_id bigint, order_number int, due_date timestamp_ntz, amount double",
    "scheduled_payment": "loan_id bigint, order_number int, due_date timestamp_ntz, amount double",
    "funding_trend": """loan_id bigint, status string, funded_amount double, basket_amount double,
        paid_amount double, delinquent boolean, lender_count bigint, scrape_time timestamp_ntz""",
    "description": "loan_id bigint, language string, text string",
    "borrower": """loan_id bigint, order_number int, first_name string, last_name string,
        gender string, pictured boolean""",
}

LOAN_KEYS = {
    "loan": ["id"],
    "theme": ["loan_id", "theme"],
    "loan_lender": ["loan_id", "lender_id"],
    "lender": ["lender_id"],
    "tag": ["loan_id", "name"],
    "payment": ["id"],
    "local_payment": ["loan_id", "order_number"],
    "scheduled_payment": ["loan_id", "order_number"],
    "funding_trend": ["loan_id", "scrape_time"],
    "description": ["loan_id", "language"],
    "borrower": ["loan_id", "order_number"],
}

PROJECT_KEYS = {
    "project": ["id"],
    "category": ["id"],
    "creator": ["id"],
    "item": ["project_id", "id"],
    "livestream": ["id"],
    "location": ["id"],
    "reward": ["id"],
    "reward_item": ["reward_id", "id"],
    "funding_trend": ["projectid", "project_last_modification"],
    "comments": ["id"],
    "update": ["project_id", "update_number"],
    "creator_external_url": ["creator_id", "href"],
    "creator_bio": ["creator_id"],
}

PROJECT_TREND = """projectid bigint, project_last_modification timestamp_ntz,
    amount_pledged_usd decimal(20,10), backer_count bigint, update_count bigint,
    comment_count bigint, status string"""


def layout(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
