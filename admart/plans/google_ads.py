"""Google Ads models: campaign, keyword, ad and ad-group dimensions and the daily fact."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from admart.config import Config
from admart.functions.dates import in_trailing_days
from admart.functions.geo import region_of
from admart.functions.rules import Sql, call, first_match, like_any, name
from admart.functions.text import (json_quote, json_string, regexp_extract_or_null, strip_quotes,
                                   trim_ws)
from admart.operators.aggregates import distinct_concat, last_state, money_parts, money_sum, segment_sums
from admart.operators.joins import backfill, lookup

KEYWORDS = "source_daily_google_ads_keywords"
CAMPAIGNS = "source_hourly_google_ads_campaigns"
AD_GROUP_STATS = "source_daily_google_ads_ad_group_with_more_stats"
AD_GROUPS = "source_daily_google_ads_ad_group"
ADS = "source_daily_google_ads_ad"

MICROS = 1_000_000


# ------------------------------------------------------------------ campaign dimension

# Fixed value: country code = first 2-3 letters followed by _ or -, after optional [tags].
CAMPAIGN_COUNTRY = r"(?i)(?:\[.*?\]\s*)*([a-z]{2,3})(?:[_-])"


# Product category from a campaign name or landing-page products (first match wins).
CATEGORY_RULES: list[tuple[str, tuple[str, ...]]] = [
    ("SKL", ("%satin-kajal-liner%",)),
    ("FRD", ("%fragrance-discovery%", "%suite-302%", "%san-ysidro-drive%", "%portofino-97%")),
    ("FRG", ("%fragrance%",)),
    ("SKA", ("%skin-augustinus-bader%", "%power-serum%")),
    ("SKN", ("%skin%", "%the-daily-cleansing-protocol%")),
    ("MAS", ("%mascara%",)),
    ("LIP", ("%lip%", "%gloss%")),
    ("FCE", ("%face%", "%reflect-highlighter-stick%", "%contour-stylus%", "%babyblade%")),
    ("EYE", ("%eye%", "%lid%", "%brightening-waterline-pencil%")),
]


def campaign_category(campaign: Column | Sql) -> Column | Sql:
    """Category of a campaign name; here mascara is spelled ``Mas``."""
    return first_match([(like_any(campaign, *needles), "Mas" if code == "MAS" else code)
                        for code, needles in CATEGORY_RULES], default="MSC")


def url_category(products: Column | Sql) -> Column | Sql:
    return first_match([(like_any(products, *needles), code) for code, needles in CATEGORY_RULES])


def _spends(as_of: dt.date) -> dict[str, Column]:
    """Micros per state: all time and in the trailing 7 and 14 days."""
    micros = F.col("metrics_cost_micros")
    return {"__all": F.sum(micros),
            **{f"__in_{n}": F.sum(F.when(in_trailing_days(F.col("segments_date"), as_of, n), micros).otherwise(0))
               for n in (7, 14)}}


def _spend_totals(prefix: str) -> dict[str, Column]:
    return {f"{prefix}_total_spend": F.round(F.sum("__all") / MICROS),
            **{f"{prefix}_spend_in_last_{n}_days": F.round(F.sum(f"__in_{n}") / MICROS, 2) for n in (7, 14)}}


def campaigns(sources: Mapping[str, DataFrame], as_of: dt.date) -> DataFrame:
    """google_ads_campaigns: one row per campaign with its latest name, run dates, spend totals
    (all time, trailing 7 and 14 days up to ``as_of``), country, region and category."""
    per_campaign = last_state(
        sources[CAMPAIGNS], ["campaign_id"],
        {"campaign_name": F.lower(F.col("campaign_name"))}, "segments_date",
        greatest={
            "segments_ad_network_type": "segments_ad_network_type",
            "metrics_interaction_event_types": json_string(F.col("metrics_interaction_event_types")),
            "campaign_advertising_channel_type": json_quote(F.col("campaign_advertising_channel_type")),
            "campaign_payment_mode": "campaign_payment_mode"},
        first={"__first": F.min("segments_date"), **_spends(as_of)},
        then={"first_run_date": F.min("__first"), "campaign_last_run_date": F.max("__last"),
              **_spend_totals("campaign")},
    ).select("campaign_id", "segments_ad_network_type", "metrics_interaction_event_types",
             "campaign_advertising_channel_type", "campaign_payment_mode", "campaign_name", "first_run_date",
             "campaign_last_run_date", "campaign_total_spend", "campaign_spend_in_last_7_days",
             "campaign_spend_in_last_14_days")
    rest = list(per_campaign.columns)
    with_raw = per_campaign.select(
        F.upper(regexp_extract_or_null(F.col("campaign_name"), CAMPAIGN_COUNTRY)).alias("__country"),
        *rest)
    raw_country = name("__country")
    country = first_match([(raw_country.isNull(), "not parsed"), (raw_country == "GB", "UK")],
                          default=raw_country)
    return with_raw.select(
        campaign_category(name("campaign_name")).alias("category_from_campaign_name"),
        region_of("__country").alias("region"),
        country.alias("country"),
        *rest)


# ------------------------------------------------------------------ keyword dimension

# Keyword brand rules in order (RE2 syntax); the last brand matches either pattern
# and is case-sensitive.
BRAND_RULES: list[tuple[str, tuple[str, ...]]] = [
    ("Aerin", (r"(?i)\baerin\b",)),
    ("Thrive Causemetics", (r"(?i)\bthrive(?:\s+causemetics)?\b",)),
    ("Nishane", (r"(?i)\bnishane\b",)),
    ("Bond No. 9 Tribeca", (r"(?i)\bbond\s*(?:no\s*)?9\b|\bperfume\s*bond\b",)),
    ("Bvlgari", (r"(?i)\bbvlgari\b",)),
    ("byredo", (r"(?i)\bbyredo\b",)),
    ("Cartier", (r"(?i)\bcartier\b",)),
    ("Creed", (r"(?i)\bcreed\b",)),
    ("Diptyque", (r"(?i)\bdiptyque\b",)),
    ("DKNY", (r"(?i)\bdkny\b",)),
    ("Givenchy", (r"(?i)\bgivenchy\b",)),
    ("Guerlain", (r"(?i)\bguerlain\b",)),
    ("Juliette Has a Gun", (r"(?i)\bjuliette\s+has\s+a\s+gun\b",)),
    ("Initio Parfums Privés", (r"(?i)\binitio\b",)),
    ("Lancôme", (r"(?i)\blanc(?:ô|o)me\b",)),
    ("Louis Vuitton", (r"(?i)\blouis\s+vuitton\b",)),
    ("Mancera", (r"(?i)\bcedrat\s+boise(?:\s+intense)?\b",)),
    ("Maison Margiela", (r"(?i)\bmaison\s+margiela\b",)),
    ("Montale", (r"(?i)\bmontale\b",)),
    ("Parfums de Marly", (r"(?i)\bparfums\s+de\s+marly\b",)),
    ("Valentino", (r"(?i)\bvalentino\b",)),
    ("Escentric Molecules", (r"(?i)\bescentric molecules\b",)),
    ("Lady Gaga", (r"(?i)\blady gaga\b",)),
    ("Tiffany & Co.", (r"(?i)\btiffany\b",)),
    ("Estee Lauder x Victoria Beckham Beauty", (r"(?i)\b(beckham|lauder)\b.*\b(lauder|beckham)\b",)),
    ("Estee Lauder", (r"(?i)\best(?:ée?|ee)\s+lauder\b",)),
    ("Victoria Beckham Beauty", (
        r"\bvictoria\s*beckham\b|\bv\s*beckham\b|\bvb\b|\bvic\s*beckham\b|\bvictoriabeckham\b|\bvictoria\s*beauty\b|\bbeckham\b",
        r"\bintimately\s*beckham\b|\bsatin\s*kajal\b|\bbaby\s*blade\b|\blid\s*lustre\b|\bcontour\s*stylus\b|\bsuite\s*302\b|\breflect\s*highlighter\s*stick\b|\bsatin\s*kajal\s*liner\b|\bportofino\s*97\b|\bjump\b|\bsway\b|\bpout\b|\btwist\b|\bpose\b|\bposh\b",
    )),
]

_WORD = "[0-9A-Za-z_]"
_ASCII_BOUNDARY = f"(?:(?<!{_WORD})(?={_WORD})|(?<={_WORD})(?!{_WORD}))"


def to_java_regex(pattern: str) -> str:
    """RE2 -> java.util.regex: ``(?i)`` folds Unicode case in RE2 (``(?iu)`` in Java) and ``\\b``
    is an ASCII word boundary in RE2 (Java would also count accented letters as word chars)."""
    out = pattern.replace("(?i)", "(?iu)")
    return out.replace(r"\b", _ASCII_BOUNDARY)


def keyword_brand(keyword: Column | Sql) -> Column | Sql:
    """Brand of a search keyword; ``'non-brand'`` when no rule matches."""
    def matches(patterns: tuple[str, ...]) -> Column | Sql:
        tests = [keyword.rlike(to_java_regex(p)) for p in patterns]
        out = tests[0]
        for t in tests[1:]:
            out = out | t
        return out
    return first_match([(matches(pats), brand) for brand, pats in BRAND_RULES], default="non-brand")


def keywords(sources: Mapping[str, DataFrame]) -> DataFrame:
    """google_ads_keyword: latest criterion attributes per (campaign, ad group, keyword) + brand.
    The regex rules run once per distinct keyword entity, never per fact row."""
    attributes = ["ad_group_criterion_type", "campaign_bidding_strategy_type", "ad_group_criterion_keyword_match_type"]
    state = last_state(
        sources[KEYWORDS],
        {"campaign_id": "campaign_id", "ad_group_id": "ad_group_id", "keyword": "ad_group_criterion_keyword_text"},
        {c: c for c in attributes}, "segments_date", then={"keyword_last_run_date": F.max("__last")})
    return state.select(keyword_brand(name("keyword")).alias("brand_name"), *state.columns)


# ------------------------------------------------------------------ ad and ad-group dimensions

AD_STATE_COLS = {
    "ad_name": "ad_group_ad_ad_name",
    "final_urls": "ad_group_ad_ad_final_urls",
    "ad_type": "ad_group_ad_ad_type",
    "responsive_search_ad_descriptions": "ad_group_ad_ad_responsive_search_ad_descriptions",
    "video_responsive_ad_descriptions": "ad_group_ad_ad_video_responsive_ad_descriptions",
    "expanded_text_ad_description": "ad_group_ad_ad_expanded_text_ad_description",
    "responsive_display_ad_descriptions": "ad_group_ad_ad_responsive_display_ad_descriptions",
}


def ad_state(sources: Mapping[str, DataFrame]) -> DataFrame:
    """intermediate_google_ads_ad_with_last_state: latest attributes per (ad group, ad), dealt by ad group."""
    return last_state(sources[ADS], {"ad_group_id": "ad_group_id", "ad_id": "ad_group_ad_ad_id"},
                      AD_STATE_COLS, "segments_date", lay_out=["ad_group_id"])


# Landing-page product slug and ad-text piece patterns.
PRODUCT_PATH = r'/(?:products|collections|pages)/([^/"]+)'
AD_TEXT = r'text: \\"([^\\"]+)\\"'

DESCRIPTION_BY_TYPE = {
    "RESPONSIVE_SEARCH_AD": "responsive_search_ad_descriptions_string",
    "VIDEO_RESPONSIVE_AD": "video_responsive_ad_descriptions_string",
    "EXPANDED_TEXT_AD": "expanded_text_ad_description_string",
    "RESPONSIVE_DISPLAY_AD": "responsive_display_ad_descriptions_string",
}


def ad_texts(ads: DataFrame) -> DataFrame:
    """Per ad group: distinct landing products, ad types, names and description JSON texts, then
    the ad text pieces of the group's (single) ad type."""
    per_group = ads.groupBy("ad_group_id").agg(
        distinct_concat(regexp_extract_or_null(json_string(F.col("final_urls")), PRODUCT_PATH), ",")
        .alias("product"),
        distinct_concat("ad_type").alias("ad_type"),
        distinct_concat("ad_name").alias("ad_name"),
        distinct_concat(json_string(F.col("responsive_search_ad_descriptions")))
        .alias("responsive_search_ad_descriptions_string"),
        distinct_concat(json_string(F.col("video_responsive_ad_descriptions")))
        .alias("video_responsive_ad_descriptions_string"),
        distinct_concat(json_quote(F.col("expanded_text_ad_description")))
        .alias("expanded_text_ad_description_string"),
        distinct_concat(json_string(F.col("responsive_display_ad_descriptions")))
        .alias("responsive_display_ad_descriptions_string"),
    )
    text = first_match([(name("ad_type") == t, name(c)) for t, c in DESCRIPTION_BY_TYPE.items()]).column()
    pieces = F.array_join(F.regexp_extract_all(text, F.lit(AD_TEXT), 1), " ")
    return per_group.select(pieces.alias("ad_descriptions"), *per_group.columns)


def ad_group_categories(texts: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Category per ad group from its landing products; an ad group without products borrows
    those of all ad groups with the identical description text (NULL never matches).

    Borrowed products only matter through the rules, so a description carries one flag per rule
    (does any of its groups match?), never a list; no needle could match across two products.
    """
    products = name("products_by_comma")
    flags = {f"__r{i}": like_any(products, *needles) for i, (_, needles) in enumerate(CATEGORY_RULES)}
    combined = texts.select(
        "ad_group_id", *keep,
        trim_ws(F.col("product")).alias("products_by_comma"),
        trim_ws(F.col("ad_descriptions")).alias("description_combined"))
    by_description = combined.where("description_combined IS NOT NULL AND products_by_comma IS NOT NULL").groupBy(
        F.col("description_combined").alias("__needy")).agg(*[F.expr(f"max({c}) AS {n}") for n, c in flags.items()])
    # Only groups without products ask (the others have a NULL here and are judged by their own).
    asking = combined.selectExpr("*", "CASE WHEN products_by_comma IS NULL THEN description_combined END AS __needy")
    joined = lookup(asking, by_description, ["__needy"])
    borrowed = first_match([(name(n), code) for n, (code, _) in zip(flags, CATEGORY_RULES)])
    return joined.select(
        first_match([(products.isNotNull(), url_category(products))], default=borrowed)
        .alias("category_from_destination_url_or_description"),
        "ad_group_id", *keep)


def ad_group_state(sources: Mapping[str, DataFrame], as_of: dt.date) -> DataFrame:
    """Latest type and name (lexicographic max) and total / 7-day / 14-day spend per ad group."""
    return last_state(
        sources[AD_GROUPS], ["ad_group_id"], {}, "segments_date",
        greatest={"ad_group_type": "ad_group_type", "ad_group_name": "ad_group_name"},
        first=_spends(as_of), then=_spend_totals("ad_group"))


def ad_group_dim(sources: Mapping[str, DataFrame], as_of: dt.date) -> DataFrame:
    """intermediate_google_ads_group_with_product_categories: one row per ad group that has ads."""
    texts = ad_texts(ad_state(sources))
    # Both are dealt by ad group (unique and few NULLs), so this join moves no row.
    named = texts.join(ad_group_state(sources, as_of), "ad_group_id", "left")
    kept = [c for c in texts.columns if c != "ad_group_id"]
    state = [c for c in named.columns if c not in texts.columns]
    return ad_group_categories(named, [*state, *kept]).select("ad_group_id", "category_from_destination_url_or_description", *state, *kept)


# ------------------------------------------------------------------ daily fact

METRICS = ["spend", "impressions", "clicks", "conversions", "metrics_conversions_value"]


def _daily(src: DataFrame, keys: list[Column], video: bool = False) -> DataFrame:
    sums = {"spend": f"sum(metrics_cost_micros) / {MICROS}", "impressions": "sum(metrics_impressions)", "clicks": "sum(metrics_clicks)",
            **({"video_views": "sum(metrics_video_views)"} if video else {}),
            "conversions": "sum(metrics_conversions)", "metrics_conversions_value": "sum(metrics_conversions_value)"}
    aggs = [F.expr(f"CAST(round({total}, 2) AS DOUBLE) AS {out}") for out, total in sums.items()]
    return src.groupBy(*keys).agg(*aggs)


def keyword_ad_group_days(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Keyword days merged with ad-group days (a keyword value wins, per metric); ad-group days
    without keywords become rows with a NULL keyword."""
    date = F.col("segments_date").alias("ad_run_date")
    kw = _daily(sources[KEYWORDS], [F.col("campaign_id"), F.col("ad_group_id"),
                                    F.col("ad_group_criterion_keyword_text").alias("keyword"), date])
    ag = _daily(sources[AD_GROUP_STATS], [F.col("campaign_id"), F.col("ad_group_id"), date])
    return backfill(kw, ag, ["ad_run_date", "ad_group_id", "campaign_id"], METRICS).select(
        "campaign_id", "ad_group_id", "keyword", "ad_run_date", *METRICS)


def daily_grains(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Keyword, ad-group and campaign daily numbers merged: the finest grain that has a value wins,
    per metric. Campaign days without ad groups become campaign-only rows."""
    date = F.col("segments_date").alias("ad_run_date")
    camp = _daily(sources[CAMPAIGNS], [F.col("campaign_id"), date], video=True).drop("video_views")
    merged = backfill(keyword_ad_group_days(sources), camp, ["ad_run_date", "campaign_id"], METRICS)
    return merged.select("campaign_id", "ad_group_id", "keyword", "ad_run_date", *METRICS)


# The category, channel and campaign-type rules below.
def gads_category(ad_group_type: Column | Sql, channel_type: Column | Sql, brand: Column | Sql) -> Column | Sql:
    """Google ads category (before quote stripping)."""
    return first_match([
        (brand == "Victoria Beckham Beauty", "BRAND SEARCH"),
        (ad_group_type.isin('"SEARCH"', "SEARCH_STANDARD") | (channel_type == '"SEARCH"'), "NON-BRAND SEARCH"),
        (ad_group_type.isNull(), channel_type),
        (ad_group_type.isin("UNKNOWN", "UNSPECIFIED"), channel_type),
        (ad_group_type.like("%VIDEO%") | channel_type.like("%VIDEO%"), "GOOGLE VIDEO"),
    ], default=ad_group_type)


def gads_channel(category: Column | Sql) -> Column | Sql:
    """Channel from the *unstripped* category: a quoted PERFORMANCE_MAX is not mapped."""
    return first_match([
        (category == "PERFORMANCE_MAX", "PMax"),
        (category.isin("BRAND SEARCH", "NON-BRAND SEARCH"), "Paid Search"),
        (category.isin("VIDEO", "VIDEO_RESPONSIVE"), "Paid Video"),
    ], default="gads not mapped")


def campaign_type(campaign: Column | Sql) -> Column | Sql:
    n = call("lower", campaign)
    return first_match([(n.like("%brand%"), "brand"), (n.like("%pmax%"), "pmax")], default="generic")


def daily_by_campaign(sources: Mapping[str, DataFrame], cfg: Config | None = None) -> DataFrame:
    """The merged daily fact with the campaign dimension and campaign type only: what the all-ads
    roll-up reads. The keyword and ad-group lookups of the full fact are left joins on keys unique
    in those dimensions, so leaving them out changes no row and no column used here (Catalyst
    drops them too, but they would still be built)."""
    cfg = cfg or Config()
    facts = lookup(daily_grains(sources), campaigns(sources, cfg.as_of), ["campaign_id"])
    return facts.select("*", campaign_type(name("campaign_name")).alias("campaign_type"))


def daily_google_ads(sources: Mapping[str, DataFrame], cfg: Config | None = None) -> DataFrame:
    """daily_google_ads: the merged daily fact with keyword, campaign and ad-group dimensions,
    ads category, channel and campaign type. Dimension joins are left lookups; AQE broadcasts a
    dimension when its measured size allows."""
    cfg = cfg or Config()
    facts = daily_grains(sources)
    with_kw = lookup(facts, keywords(sources), ["campaign_id", "ad_group_id", "keyword"])
    with_camp = lookup(with_kw, campaigns(sources, cfg.as_of), ["campaign_id"])
    groups = ad_group_dim(sources, cfg.as_of)
    joined = lookup(with_camp, groups, ["ad_group_id"])
    product = F.coalesce(F.col("category_from_destination_url_or_description"),
                         F.col("category_from_campaign_name"))
    keep = [c for c in joined.columns
            if c not in ("category_from_destination_url_or_description", "category_from_campaign_name")]
    categorized = joined.select(product.alias("product_category"), *keep)
    raw = gads_category(name("ad_group_type"), name("campaign_advertising_channel_type"), name("brand_name"))
    rest = [c for c in categorized.columns if c != "product_category"]
    return categorized.select(
        strip_quotes(raw.column()).alias("google_ads_category"),
        F.coalesce(F.col("product_category"), F.lit("MSC")).alias("product_category"),
        *rest,
        F.lit("Google Ads").alias("ads_platform"),
        gads_channel(raw).alias("channel"),
        campaign_type(name("campaign_name")).alias("campaign_type"),
    )


CAMPAIGN_TYPES = {t: f"campaign_type = '{t}'" for t in ("brand", "generic", "pmax")}


def gads_daily(gads: DataFrame) -> DataFrame:
    """Google part of the all-ads mart: totals and 3 campaign types x 5 metrics per (date, region).

    Money and conversions were rounded to cents per fact row and are summed exactly, so the mart doesn't depend on
    the order of the rows, as sums of doubles do."""
    cents = {"spend": "spend", "conversions": "conversions", "sales": "metrics_conversions_value"}
    kind = "DECIMAL(38,2)"
    rows = money_parts(gads, {out: f"CAST({c} AS DECIMAL(20,2))" for out, c in cents.items()})
    grid = segment_sums({"conversions": "conversions", "clicks": "clicks", "impressions": "impressions", "spend": "spend", "sales": "sales"},
                        CAMPAIGN_TYPES, name="gads_{metric}_{segment}", money=dict.fromkeys(cents, kind))
    totals = {"impressions": "sum(impressions)", "clicks": "sum(clicks)", **{m: money_sum(m, kind) for m in cents}}
    return rows.groupBy(F.col("ad_run_date").alias("date"), "region").agg(
        *[F.expr(f"{total} AS gads_{out}") for out, total in totals.items()], *grid)
