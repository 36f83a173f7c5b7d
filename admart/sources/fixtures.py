"""Adapters that derive the reference's source tables from the driver's tables.

The reference reads marketing extracts (GA4, Google Ads, Meta Ads, Shopify) that are not part of the
test data. Each adapter below maps one driver table (``events``, ``lineitem``, ``orders``, ``part``)
row-for-row onto one source shape, so every model runs on data whose volume grows with the scale
factor. Text columns come from small fixed pools picked by key arithmetic; the pools are chosen so
that every rule arm of the models is reached.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The fixture pools, picked 0-based by key arithmetic (None = SQL NULL).
COUNTRY = [
    "United Kingdom", "United States", "Canada", "Australia", "Germany", "France", "Japan",
    "Netherlands (the)", "United States of America (the)", "Great Britain", "Czech Republic",
    "Caribbean Netherlands", "Côte d'Ivoire", "Türkiye", "Atlantis", None,
]
SRC = ["google", "facebook.com", "fb", "meta-business", "instagram", "(direct)", "newsletter",
       "bing", "(not set)", None]
MED = ["cpc", "organic", "paid_social", "referral", "(none)", "social", "email", "igshopping",
       "(not set)"]
GROUP = ["Direct", "Referral", "Organic Search", "Organic Social", "Paid Search", "Unassigned", None]
CAMP = [
    "US_satin-kajal-liner_search", "UK_fragrance-discovery_brand", "GB_fragrance_generic",
    "CA-skin-augustinus-bader-pmax", "AU_skin_pmax", "de_mascara_generic", "FR_lip-gloss_brand",
    "IT_face_generic", "[exp] us_eye_generic", "brand_us_misc", "Non-Brand Search",
    "AUS_suite-302_pmax", "JP_power-serum", "ES_gloss", "NL_babyblade",
    "EU_brightening-waterline-pencil", "lid_us", "US_pmax_all", "UK-pmax-misc", "Shopping Everything",
]
CHAN = ["SEARCH", "PERFORMANCE_MAX", "VIDEO", "DISPLAY", None]
AGTYPE = ["SEARCH_STANDARD", '"SEARCH"', "VIDEO_RESPONSIVE", "UNKNOWN", "UNSPECIFIED",
          "DISPLAY_STANDARD", "PERFORMANCE_MAX", "SHOPPING_PRODUCT_ADS", "VIDEO", None]
ADTYPE = ["RESPONSIVE_SEARCH_AD", "VIDEO_RESPONSIVE_AD", "EXPANDED_TEXT_AD",
          "RESPONSIVE_DISPLAY_AD", "IMAGE_AD"]
SLUG = ["satin-kajal-liner", "fragrance-discovery", "fragrance-x", "skin-augustinus-bader", "skin-y",
        "mascara-z", "lip-a", "gloss-b", "face-c", "contour-stylus", "eye-d", "lid-lustre",
        "power-serum", "tote-bag"]
KW = [
    "aerin cream", "thrive causemetics", "nishane ani", "bond no 9", "bvlgari", "byredo", "cartier",
    "creed aventus", "diptyque", "dkny", "givenchy", "guerlain", "juliette has a gun", "initio",
    "LANCÔME mascara", "louis vuitton", "cedrat boise intense", "maison margiela", "montale",
    "parfums de marly", "valentino", "escentric molecules", "lady gaga", "Tiffany",
    "beckham lauder", "estee lauder", "victoria beckham", "satin kajal", "Victoria Beckham",
    "lipstick red",
]
CRITERION = ["KEYWORD", "AUDIENCE"]
BIDDING = ["MANUAL_CPC", "TARGET_ROAS", "MAXIMIZE_CONVERSIONS"]
MATCH = ["EXACT", "PHRASE", "BROAD"]
NETWORK = ["SEARCH", "CONTENT", "YOUTUBE_WATCH"]
PAYMENT = ["CLICKS", "CONVERSIONS"]
ADSET = ["US_lookalike", "GB_broad", "gb_low", "DE_eye", "vast lash", "plain set", "CA_vast lash",
         "AU_core", None]
AD = [
    "[US] [FRAG] a", "[GB] [MCE] b", "[SKN] c", "syd spray", "satin x", "skl y", "jewel-smoky",
    "sigsmokeout", "lid z", "ibwp", "free copy", "augustinus", "crpm", "mascara m", "lip l", "posh",
    "blt", "contour c", "highlighter", "grwvb", "serum s", "moisturizer", "misc free gift",
]
MCAMP = ["US_[EXP] test", "GB_prospect", "[EXP] study", "[RF] reach", "retarget all",
         "skin campaign", "CA_prospect", "plain [EXP]", None, "DE_retarget"]
MID = ["120210388163900589", "120210389141230589", "120210387288060589", "1003", "1004", "1005",
       "1006", "1007", "1008", "1009"]
QUALITY = ["ABOVE_AVERAGE", "AVERAGE", "BELOW_AVERAGE_20"]
GOAL = ["OFFSITE_CONVERSIONS", "LINK_CLICKS", "REACH"]
CUSTOMER_TYPE = ["First-time", "Returning", "Other"]
PURCHASE_OPTION = ["one-time", "subscription"]

CAL_START = dt.date(2024, 1, 1)
CAL_DAYS = 180
SHOP_URL = "https://shop.example/"
#: Added to an ad group's id where a table is to miss it.
ELSEWHERE = 50

# ---------------------------------------------------------------- column helpers

def sql_str(v: str | None) -> str:
    """SQL string literal (NULL for None)."""
    return "NULL" if v is None else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def pick(pool: list, idx: Column) -> Column:
    """0-based pick from a fixed pool; the pool is one literal array (built from SQL text in a
    single call), so this stays in codegen."""
    arr = F.expr("CAST(array(" + ", ".join(sql_str(v) for v in pool) + ") AS array<string>)")
    return F.element_at(arr, (idx + 1).cast("int"))


def idiv(c: Column, n: int) -> Column:
    """Integer division of a non-negative long key (exact: the dividend is a multiple of n)."""
    c = c.cast("long")
    return ((c - c % n) / n).cast("long")


def cal(k: Column) -> Column:
    """CAL(k) = 2024-01-01 + (k mod 180) days."""
    return F.date_add(F.lit(CAL_START), (k % CAL_DAYS).cast("int"))


def dec(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def cents(c: Column) -> Column:
    """Whole cents of a two-decimal double, as a long (exact in any engine)."""
    return F.round(c * 100).cast("long")


def nano(c: Column) -> Column:
    """A number of nine decimals from a long of billionths (exact in any engine)."""
    return (c.cast("decimal(24,0)") * F.lit(Decimal("0.000000001"))).cast("decimal(24,9)")


def fraction(count: Column, key: Column) -> Column:
    """``count`` and a fraction of up to 0.166500333, as attributed conversions have."""
    return nano(count.cast("long") * 1_000_000_000 + (key % 1000) * 166_667)


def mills(money: Column, key: Column) -> Column:
    """Two-decimal ``money`` and up to nine thousandths."""
    return nano((cents(money) * 10 + key % 10) * 1_000_000)


def from_cents(c: Column) -> Column:
    return (c.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)")


# ---------------------------------------------------------------- adapters

def ga4_channel(events: DataFrame) -> DataFrame:
    """GA4 daily x country x channel rows: one session per event, revenue on purchases."""
    eid = F.col("event_id")
    purchase = F.col("event_type") == "purchase"
    return events.select(
        F.date_format(cal(eid), "yyyy-MM-dd").alias("dimension_date"),
        pick(COUNTRY, F.col("user_id") % 16).alias("dimension_country"),
        F.lit(1).cast("long").alias("metric_sessions"),
        F.when(purchase, dec(F.col("value"))).otherwise(dec(F.lit(0))).alias("metric_purchase_revenue"),
        F.when(purchase, 1).otherwise(0).cast("long").alias("metric_total_purchasers"),
        pick(MED, idiv(eid, 10) % 9).alias("dimension_session_medium"),
        pick(SRC, eid % 10).alias("dimension_session_source"),
        pick(GROUP, eid % 7).alias("dimension_session_default_channel_group"),
    )


def ga4_demographic(events: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    return events.select(
        F.date_format(cal(eid), "yyyyMMdd").alias("date"),
        pick(COUNTRY, F.col("user_id") % 16).alias("country"),
        (F.lit(2) + eid % 7).cast("long").alias("totalUsers"),
        (eid % 3).cast("long").alias("newUsers"),
    )


def _gads_ids(partkey: Column) -> tuple[Column, Column, Column]:
    campaign = (partkey % 17).cast("long")
    k = idiv(partkey, 17) % 6
    return campaign, k, campaign * 100 + k


def _gads_metrics(line: DataFrame) -> list[Column]:
    return [
        (cents(F.col("l_extendedprice")) * 10000).alias("metrics_cost_micros"),
        (F.col("l_quantity") * 100).cast("long").alias("metrics_impressions"),
        F.col("l_quantity").cast("long").alias("metrics_clicks"),
        fraction(F.col("l_linenumber"), F.col("l_orderkey")).alias("metrics_conversions"),
        mills(F.col("l_extendedprice"), F.col("l_orderkey")).alias("metrics_conversions_value"),
    ]


def google_keyword(lineitem: DataFrame) -> DataFrame:
    """Keyword x day rows; ad groups with k = 5 have no keywords, theirs name an ad group that no
    other table knows."""
    campaign, k, ad_group = _gads_ids(F.col("l_partkey"))
    ln = F.col("l_linenumber")
    return lineitem.select(
        campaign.alias("campaign_id"),
        F.when(k == 5, ad_group + ELSEWHERE).otherwise(ad_group).alias("ad_group_id"),
        pick(KW, F.col("l_orderkey") % 30).alias("ad_group_criterion_keyword_text"),
        cal(F.col("l_orderkey")).alias("segments_date"),
        *_gads_metrics(lineitem),
        pick(CRITERION, ln % 2).alias("ad_group_criterion_type"),
        pick(BIDDING, ln % 3).alias("campaign_bidding_strategy_type"),
        pick(MATCH, (ln + 1) % 3).alias("ad_group_criterion_keyword_match_type"),
    )


def google_adstats(lineitem: DataFrame) -> DataFrame:
    """Ad group x day rows from the transfer table (all ad groups, including k = 5)."""
    campaign, _, ad_group = _gads_ids(F.col("l_partkey"))
    return lineitem.select(
        campaign.alias("campaign_id"),
        ad_group.alias("ad_group_id"),
        cal(F.col("l_orderkey")).alias("segments_date"),
        *_gads_metrics(lineitem),
    )


def google_campaign(orders: DataFrame) -> DataFrame:
    """Campaign x day rows; campaign 16 goes by another id here (its Google rows get no region).
    In the first 60 days of the calendar a campaign bears its neighbour's name."""
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    cid = (ok % 20).cast("long")
    named = F.when(idiv(ok, 20) % CAL_DAYS < 60, (cid + 1) % 20).otherwise(cid)
    chan = F.when((cid == 3) & (ck % 7 == 0), F.lit(None).cast("string")).otherwise(
        pick(CHAN, (cid + 4) % 5))
    events = (F.when(ok % 3 == 0, F.array(F.lit("CLICK")))
              .when(ok % 3 == 1, F.array(F.lit("CLICK"), F.lit("ENGAGEMENT")))
              .otherwise(F.array(F.lit("VIDEO_VIEW"))))
    return orders.select(
        F.when(cid == 16, cid + 20).otherwise(cid).alias("campaign_id"),
        cal(idiv(ok, 20)).alias("segments_date"),
        pick(CAMP, named).alias("campaign_name"),
        (cents(F.col("o_totalprice")) * 10000).alias("metrics_cost_micros"),
        (ck % 1000).cast("long").alias("metrics_impressions"),
        (ck % 50).cast("long").alias("metrics_clicks"),
        fraction(ck % 5, ok).alias("metrics_conversions"),
        mills(F.col("o_totalprice"), ok).alias("metrics_conversions_value"),
        (ck % 100).cast("long").alias("metrics_video_views"),
        pick(NETWORK, ok % 3).alias("segments_ad_network_type"),
        events.alias("metrics_interaction_event_types"),
        chan.alias("campaign_advertising_channel_type"),
        pick(PAYMENT, ck % 2).alias("campaign_payment_mode"),
    )


def google_ad_group(lineitem: DataFrame) -> DataFrame:
    """Ad group x day attribute rows; ad groups with id % 13 = 0 go by another id here (join misses)."""
    campaign, k, ad_group = _gads_ids(F.col("l_partkey"))
    return lineitem.select(
        F.when(ad_group % 13 == 0, ad_group + ELSEWHERE).otherwise(ad_group).alias("ad_group_id"),
        pick(AGTYPE, (campaign + k) % 10).alias("ad_group_type"),
        F.concat(F.lit("ag_"), ad_group.cast("string")).alias("ad_group_name"),
        cal(F.col("l_orderkey")).alias("segments_date"),
        (cents(F.col("l_extendedprice")) * 10000).alias("metrics_cost_micros"),
    )


def google_ad(part: DataFrame) -> DataFrame:
    """Ad x day rows, one current row per part plus an older version for every third part."""
    pk = F.col("p_partkey")
    campaign, k, ad_group = _gads_ids(pk)
    type_idx = (ad_group + F.when(ad_group % 11 == 0, pk % 2).otherwise(0)) % 5
    slug = F.when(pk % 19 == 0, F.lit(SLUG[13])).otherwise(pick(SLUG, (campaign + 3 * k) % 14))
    url = F.when(k == 5, F.lit(SHOP_URL + "home")).otherwise(
        F.concat(F.lit(SHOP_URL + "products/"), slug))
    text = F.concat(F.lit('text: "care '), (campaign % 4).cast("string"), F.lit('"'))
    urls = F.when((k < 5) & (pk % 4 == 0), F.array(url, F.lit(SHOP_URL + "pages/about"))).otherwise(F.array(url))
    texts = (F.when(pk % 12 == 1, F.array(text, F.lit('text: "two\nlines"'), F.lit('text: "last"')))
             .when(pk % 6 == 1, F.array(text, F.lit('text: "more"'))).otherwise(F.array(text)))
    def version(day: Column, name: Column, type_index: Column, url_list: Column, text_list: Column, single: Column) -> Column:
        return F.struct(
            ad_group.alias("ad_group_id"),
            pk.alias("ad_group_ad_ad_id"),
            day.alias("segments_date"),
            name.alias("ad_group_ad_ad_name"),
            pick(ADTYPE, type_index % 5).alias("ad_group_ad_ad_type"),
            url_list.alias("ad_group_ad_ad_final_urls"),
            text_list.alias("ad_group_ad_ad_responsive_search_ad_descriptions"),
            text_list.alias("ad_group_ad_ad_video_responsive_ad_descriptions"),
            text_list.alias("ad_group_ad_ad_responsive_display_ad_descriptions"),
            single.alias("ad_group_ad_ad_expanded_text_ad_description"))

    old_text = F.lit('text: "old"')
    current = version(cal(pk), F.col("p_name"), type_idx, urls, texts, text)
    older = version(F.date_sub(cal(pk), 1), F.concat(F.col("p_name"), F.lit(" (old)")), type_idx + 1,
                    F.array(F.lit(SHOP_URL + "collections/old-stock")), F.array(old_text), old_text)
    versions = F.when(pk % 3 == 0, F.array(current, older)).otherwise(F.array(current))
    return part.select(F.explode(versions).alias("v")).select("v.*")


def _action(action_type: str, value: Column) -> Column:
    return F.concat(F.lit('{"action_type":"' + action_type + '","value":"'), value.cast("string"),
                    F.lit('"}'))


def _json_array(eid: Column, *items: Column) -> Column:
    """JSON array text; NULL on id % 11 = 0, empty on id % 13 = 0, malformed on id % 97 = 0."""
    body = F.concat(F.lit("["), F.concat_ws(",", *items), F.lit("]"))
    return (F.when(eid % 11 == 0, F.lit(None).cast("string"))
            .when(eid % 13 == 0, F.lit("[]"))
            .when(eid % 97 == 0, F.lit('[{"action_type": "onsite_web_purchase", "value": '))
            .otherwise(body))


def meta_insights(events: DataFrame) -> DataFrame:
    """Meta ad x day rows with JSON-array action columns."""
    eid = F.col("event_id")
    i = idiv(eid, 23) % 10
    purchases = eid % 4
    cart = eid % 7
    spend = dec(F.col("value"))
    revenue = spend * purchases * F.when(eid % 50 == 7, 40).otherwise(1)
    actions = _json_array(
        eid,
        _action("onsite_web_purchase", purchases),
        _action("landing_page_view", eid % 30),
        _action("onsite_web_app_add_to_cart", cart),
        F.when(eid % 5 == 0, _action("onsite_web_purchase", purchases + 1)),
    )
    action_values = _json_array(eid, _action("onsite_web_app_purchase", revenue))
    video_p75 = _json_array(eid, _action("video_view", eid % 9), _action("video_view", eid % 4))
    video_15 = F.when(eid % 7 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("["), _action("video_view", eid % 6), F.lit("]")))
    value = F.col("value")
    return events.select(
        cal(eid).alias("date_start"),
        pick(MID, i).alias("campaign_id"),
        (eid % 9).cast("string").alias("adset_id"),
        eid.cast("string").alias("ad_id"),
        pick(MCAMP, i).alias("campaign_name"),
        pick(ADSET, eid % 9).alias("adset_name"),
        pick(AD, eid % 23).alias("ad_name"),
        (eid % 500).cast("long").alias("reach"),
        spend.alias("spend"),
        (eid % 1000).cast("long").alias("impressions"),
        (eid % 60).cast("long").alias("clicks"),
        (eid % 40).cast("long").alias("unique_clicks"),
        (eid % 20).cast("long").alias("inline_post_engagement"),
        (eid % 50).cast("long").alias("unique_inline_link_clicks"),
        (value / 10).alias("frequency"),
        (value / 3).alias("cpc"),
        (value * 2).alias("cpm"),
        (value / 7).alias("cpp"),
        (value / 100).alias("ctr"),
        (value / 200).alias("unique_link_clicks_ctr"),
        actions.alias("actions"),
        action_values.alias("action_values"),
        video_p75.alias("video_p75_watched_actions"),
        video_15.alias("video_15_sec_watched_actions"),
        pick(QUALITY, eid % 3).alias("quality_ranking"),
        F.lit("USD").alias("account_currency"),
        pick(GOAL, eid % 3).alias("optimization_goal"),
        F.col("ts").alias("created_time"),
        F.col("ts").alias("updated_time"),
    )


def _shopify_daily(orders: DataFrame, parity: int, years_back: int) -> DataFrame:
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    return orders.where(ok % 2 == parity).select(
        F.add_months(cal(ok), -12 * years_back).alias("day"),
        pick(COUNTRY, ck % 16).alias("country"),
        pick(CUSTOMER_TYPE, ck % 3).alias("customer_type"),
        F.lit(1).cast("long").alias("orders"),
        dec(F.col("o_totalprice")).alias("total_sales"),
    )


def shopify_daily_2024(orders: DataFrame) -> DataFrame:
    return _shopify_daily(orders, 0, 0)


def shopify_daily_2023(orders: DataFrame) -> DataFrame:
    return _shopify_daily(orders, 1, 1)


def _shop_month(ok: Column, ck: Column, shift: int = 0) -> Column:
    year = F.when(ck % 2 == 0, F.lit("2023")).otherwise(F.lit("2024"))
    return F.concat(year, F.lit("-"), F.lpad((F.lit(1) + (ok + shift) % 12).cast("string"), 2, "0"))


def shopify_order_lines(lineitem: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    """Order lines with money in exact cents arithmetic."""
    lines = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey).join(
        part, lineitem.l_partkey == part.p_partkey)
    gross = cents(F.col("l_extendedprice"))
    disc = idiv(gross * F.round(F.col("l_discount") * 100).cast("long"), 100)
    sku = F.col("l_partkey") % 50
    return lines.select(
        _shop_month(F.col("o_orderkey"), F.col("o_custkey")).alias("month"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        pick(COUNTRY, F.col("o_custkey") % 16).alias("billing_country"),
        F.when(sku == 0, F.lit(None).cast("string")).otherwise(
            F.concat(F.lit("SKU-"), sku.cast("string"))).alias("variant_sku"),
        F.col("p_name").alias("product"),
        dec(F.col("p_retailprice")).alias("product_price"),
        F.col("l_quantity").cast("long").alias("ordered_items"),
        from_cents(gross).alias("gross_sales"),
        from_cents(disc).alias("discounts"),
        from_cents(gross - disc).alias("net_sales"),
    )


def shopify_orders_new_return(orders: DataFrame) -> DataFrame:
    """Orders x month with three kinds of duplicates (lower-sales copy, second customer type,
    same order in the next month)."""
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")

    def rows(where: Column, month: Column, ctype: Column, sales: Column) -> DataFrame:
        return orders.where(where).select(
            month.alias("month"),
            pick(COUNTRY, ck % 16).alias("billing_country"),
            ok.cast("string").alias("order_id"),
            ctype.alias("customer_type"),
            pick(PURCHASE_OPTION, ok % 2).alias("purchase_option"),
            F.when(ok % 17 == 0, 0).otherwise(1).cast("long").alias("orders"),
            sales.alias("total_sales"),
        )

    base_month, base_type, sales = _shop_month(ok, ck), pick(CUSTOMER_TYPE, ck % 3), dec(F.col("o_totalprice"))
    return (rows(F.lit(True), base_month, base_type, sales)
            .unionByName(rows(ok % 10 == 0, base_month, base_type, sales - 1))
            .unionByName(rows(ok % 25 == 0, base_month, pick(CUSTOMER_TYPE, (ck + 1) % 3), sales))
            .unionByName(rows(ok % 30 == 0, _shop_month(ok, ck, 1), base_type, sales)))


def fixture_sources(spark: SparkSession, sf_dir: str) -> "LazySources":
    """Logical source name -> DataFrame derived from the driver's tables.

    Sources are built on first access only, so a query pays for the sources it reads. Each passes
    through ``conform``, as a warehouse's tables do.
    """
    from admart.sources.registry import LazySources, conform

    def t(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    adapters = {
        "source_ga4_daily_country_marketing_channel": lambda: ga4_channel(t("events")),
        "source_ga4_demographic_country_report": lambda: ga4_demographic(t("events")),
        "source_daily_google_ads_keywords": lambda: google_keyword(t("lineitem")),
        "source_hourly_google_ads_campaigns": lambda: google_campaign(t("orders")),
        "source_daily_google_ads_ad_group_with_more_stats": lambda: google_adstats(t("lineitem")),
        "source_daily_google_ads_ad_group": lambda: google_ad_group(t("lineitem")),
        "source_daily_google_ads_ad": lambda: google_ad(t("part")),
        "source_daily_meta_ads": lambda: meta_insights(t("events")),
        "source_daily_new_return_sales_orders_2024_shopify": lambda: shopify_daily_2024(t("orders")),
        "source_daily_new_return_sales_orders_2023_shopify": lambda: shopify_daily_2023(t("orders")),
        "source_shopify_daily_sales_orders_users_by_country":
            lambda: shopify_order_lines(t("lineitem"), t("orders"), t("part")),
        "source_shopify_monthly_sales_orders_new_return_per_order":
            lambda: shopify_orders_new_return(t("orders")),
    }
    return LazySources({n: (lambda n=n, make=make: conform(make(), n)) for n, make in adapters.items()})
