"""Meta Ads models: ad-name note (view) and the daily ad fact with segments, country, category
and AOV outlier correction (view)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from admart.config import Config, MetaSegments
from admart.functions.dates import month_start
from admart.functions.geo import region_of
from admart.functions.json_metrics import array_metric_max, array_metric_sum, json_array
from admart.functions.rules import Sql, call, first_match, like_any, name
from admart.functions.text import regexp_extract_or_null
from admart.operators.aggregates import money_parts, money_sum, segment_sums
from admart.operators.windows import clamp_outliers, rank_median

SOURCE = "source_daily_meta_ads"
VALUE_SCHEMA = "array<struct<value:string>>"


def free_shipping_note(ad_name: Column) -> Column:
    return F.when(F.lower(ad_name).like("%free%"), F.lit("free shipping")).otherwise(
        F.lit("no free shipping"))


def ad_name_updated(sources: Mapping[str, DataFrame]) -> DataFrame:
    """intermediate_daily_meta_ads_ad_name_updated: the source plus ``free_shipping_note``."""
    src = sources[SOURCE]
    return src.select(free_shipping_note(F.col("ad_name")).alias("free_shipping_note"), *src.columns)


JSON_COLUMNS = ("actions", "action_values", "video_p75_watched_actions", "video_15_sec_watched_actions")


def extract_metrics(ads: DataFrame) -> DataFrame:
    """Flatten the JSON-array action columns into scalar metrics.

    Each JSON column is parsed once in its own projection (Catalyst keeps a non-cheap expression
    that is read several times in its own Project), then the metrics are read from the arrays.
    """
    parsed = ads.select(
        *[c for c in ads.columns if c not in JSON_COLUMNS],
        json_array(F.col("actions")).alias("__actions"),
        json_array(F.col("action_values")).alias("__values"),
        json_array(F.col("video_p75_watched_actions"), VALUE_SCHEMA).alias("__p75"),
        json_array(F.col("video_15_sec_watched_actions"), VALUE_SCHEMA).alias("__s15"),
    )
    actions = F.col("__actions")
    return parsed.select(
        F.col("date_start").alias("ad_run_date"),
        "free_shipping_note", "campaign_name", "adset_name", "ad_name", "reach", "spend",
        "impressions", "clicks", "unique_clicks",
        array_metric_max(actions, "onsite_web_purchase").alias("onsite_web_purchases"),
        array_metric_max(F.col("__values"), "onsite_web_app_purchase", "double")
        .alias("onsite_web_app_purchase_sum_usd"),
        array_metric_max(actions, "landing_page_view").alias("landing_page_views"),
        array_metric_max(actions, "onsite_web_app_add_to_cart").alias("onsite_web_app_add_to_cart_count"),
        "quality_ranking", "inline_post_engagement", "unique_link_clicks_ctr",
        "unique_inline_link_clicks", "created_time", "updated_time",
        array_metric_sum(F.col("__p75")).alias("video_p75_watched_actions_count"),
        array_metric_sum(F.col("__s15")).alias("video_15_sec_watched_count"),
        "campaign_id", "adset_id", "ad_id", "frequency", "cpc", "cpm", "cpp", "ctr",
        "account_currency", "optimization_goal",
    )


def segment_flags(seg: MetaSegments) -> dict[str, Sql]:
    """is_experiment / is_reach_and_frequency / is_retargeting / is_prospecting."""
    campaign = call("lower", name("campaign_name"))
    cid = name("campaign_id")
    start, end = (Sql(f"DATE'{d}'") for d in (seg.window_start, seg.window_end))
    experiment = first_match([
        (cid.isin(*seg.window_campaign_ids) & name("ad_run_date").between(start, end), True),
        (campaign.like("%[exp]%") & ~cid.isin(*seg.excluded_campaign_ids), True),
    ], default=False)
    rf = campaign.like("%[rf]%")
    retarget = campaign.like("%retarget%")
    return {
        "is_experiment": experiment,
        "is_reach_and_frequency": rf,
        "is_retargeting": retarget,
        # computed from the same expressions as the flags above (the SELECT sees no sibling alias)
        "is_prospecting": ~rf & ~retarget & ~experiment,
    }


def _prefix_code(c: Column | Sql) -> tuple:
    """(has a two-letter ``xx_`` prefix, the prefix as written)."""
    return call("substring", c, 3, 1) == "_", call("substring", c, 1, 2)


BRACKET = r"\[([^\]]+)\]"
SECOND_BRACKET = r"\[[^\]]+\]\s*\[([^\]]+)\]"


def meta_country(adset: Column | Sql, ad: Column | Sql, campaign: Column | Sql, bracket: Column | Sql | None = None) -> Column | Sql:
    """Country from the adset prefix, else the first ad-name bracket, else the campaign prefix.
    The ``GB`` test is on the raw case, upper-casing comes after. ``bracket`` may pass the
    already extracted first bracket code of ``ad``."""
    a_has, a_code = _prefix_code(adset)
    c_has, c_code = _prefix_code(campaign)
    bracket = regexp_extract_or_null(ad, BRACKET) if bracket is None else bracket
    return call("upper", first_match([
        (a_has & (a_code != "GB"), a_code),
        (a_has & (a_code == "GB"), "UK"),
        (bracket != "GB", bracket),
        (c_has & (c_code != "GB"), c_code),
        (c_has & (c_code == "GB"), "UK"),
    ]))


def meta_category(category: Column | Sql, ad: Column | Sql, adset: Column | Sql, campaign: Column | Sql) -> Column | Sql:
    """Product category: bracket code (FRAG -> FRD, MCE -> MSC) else rules on the names."""
    a, s, c = call("lower", ad), call("lower", adset), call("lower", campaign)
    # The needles of both rule lists.
    by_name = first_match([
        (like_any(a, "%satin%", "%skl%", "%jewel_smoky%", "%sigsmokeout%"), "SKL"),
        (like_any(a, "%lid%", "%ibwp%") | (a.like("%free%") & a.like("%copy%")) | s.like("%eye%"), "EYE"),
        (like_any(a, "%augustinus%", "%crpm%"), "SKA"),
        (a.like("%mascara%") | s.like("%vast lash%"), "MAS"),
        (like_any(a, "%lip%", "%posh%", "%blt%"), "LIP"),
        (like_any(a, "%contour%", "%highlighter%", "%grwvb%", "%majorglowset%"), "FCE"),
        (like_any(a, "%skin%", "%serum%", "%moisturizer%") | c.like("%skin%"), "SKN"),
    ], default="MSC")
    return first_match([
        ((category == "FRAG") | like_any(a, "%frag%", "%syd%"), "FRD"),
        (category == "MCE", "MSC"),
        (category.isNull(), by_name),
    ], default=category)


def with_segments(metrics: DataFrame, seg: MetaSegments) -> DataFrame:
    flags = segment_flags(seg)
    cols = [c for c in metrics.columns if c != "free_shipping_note"]
    note = F.coalesce(F.col("free_shipping_note"), free_shipping_note(F.col("ad_name")))
    return metrics.select(*cols, *[v.alias(k) for k, v in flags.items()],
                          note.alias("free_shipping_note"))


def with_country_category(df: DataFrame) -> DataFrame:
    """Country, region and product category. The bracket codes are extracted once, in their own
    projection, and the rule chains read them (a regex is not re-run per rule arm)."""
    ad, adset, camp = name("ad_name"), name("adset_name"), name("campaign_name")
    helpers = df.select("*", regexp_extract_or_null(F.col("ad_name"), BRACKET).alias("__bracket"),
                        regexp_extract_or_null(F.col("ad_name"), SECOND_BRACKET).alias("__category"))
    with_country = helpers.select("*", meta_country(adset, ad, camp, bracket=name("__bracket")).alias("country"))
    kept = [c for c in with_country.columns if c not in ("__bracket", "__category")]
    return with_country.select(*kept, region_of("country").alias("region"),
                               meta_category(name("__category"), ad, adset, camp).alias("product_category"))


def aov_rows(df: DataFrame) -> DataFrame:
    """AOV per ad-day (NULL when purchases are 0 or missing) and its month bucket."""
    aov = F.try_divide(F.col("onsite_web_app_purchase_sum_usd"), F.col("onsite_web_purchases"))
    return df.withColumn("aov", aov).withColumn("month_start_date", month_start("ad_run_date"))


def aov_medians(rows: DataFrame, null_keys: bool = True) -> DataFrame:
    """Rank-median AOV per (region, month) over rows with purchases and purchase value; the others have no AOV."""
    return rank_median(rows, ["region", "month_start_date"], "aov", out="aov_reion_month_median", null_keys=null_keys)


def daily_meta_ads(sources: Mapping[str, DataFrame], cfg: Config | None = None,
                   columns: list[str] | None = None) -> DataFrame:
    """daily_meta_ads: one row per ad-day with flags, country, region, category and the revenue
    recomputed from the outlier-corrected AOV (purchases x corrected AOV).

    A lazy plan: the medians (at most seven regions times the months of the data) are one
    pre-aggregated branch and are broadcast to the rows, which stay where they were read.
    ``columns`` keeps only what a consumer needs (plus the AOV inputs).
    """
    cfg = cfg or Config()
    base = with_country_category(with_segments(extract_metrics(ad_name_updated(sources)), cfg.meta))
    rows = aov_rows(base)
    if columns is not None:
        keep = list(dict.fromkeys([*columns, "region", "month_start_date", "aov", "onsite_web_purchases",
                                   "onsite_web_app_purchase_sum_usd"]))
        rows = rows.select(*keep)
    corrected = clamp_outliers(rows, aov_medians(rows, null_keys=False), ["region", "month_start_date"], "aov",
                               "aov_reion_month_median", "aov_corrected", cfg.aov_outlier_factor, few_groups=True)
    revenue = F.col("onsite_web_purchases") * F.col("aov_corrected")
    return (corrected.withColumn("onsite_web_app_purchase_sum_usd", revenue)
                     .withColumn("ads_platform", F.lit("Meta Ads"))
                     .withColumn("channel", F.lit("Paid Social")))


SEGMENTS = {
    "retargeting": "is_retargeting",
    "prospecting": "is_prospecting",
    "experiment": "is_experiment",
    "rf": "is_reach_and_frequency",
}


ROLLUP_COLUMNS = ["ad_run_date", "impressions", "landing_page_views", "unique_inline_link_clicks", "spend",
                  "is_retargeting", "is_prospecting", "is_experiment", "is_reach_and_frequency"]


def meta_daily(meta: DataFrame) -> DataFrame:
    """Meta part of the all-ads mart: totals and 4 segments x 6 metrics per (date, region).

    Revenue per ad-day is a double; it is added up as a decimal of six places, so the sums don't
    depend on the order of the rows."""
    money = {"spend": "DECIMAL(34,9)", "sales": "DECIMAL(38,6)"}
    rows = money_parts(meta, {"spend": "spend", "sales": "CAST(onsite_web_app_purchase_sum_usd AS DECIMAL(28,6))"})
    seg = segment_sums({
        "landing_page_views": "landing_page_views", "conversions": "onsite_web_purchases",
        "impressions": "impressions", "clicks": "unique_inline_link_clicks", "spend": "spend", "sales": "sales"},
        SEGMENTS, name="meta_{metric}_{segment}", money=money)
    totals = {"meta_impressions": "sum(impressions)", "landing_page_views": "sum(landing_page_views)",
              "meta_clicks": "sum(unique_inline_link_clicks)", "meta_spend": money_sum("spend", money["spend"]),
              "meta_conversions": "sum(onsite_web_purchases)", "meta_sales": money_sum("sales", money["sales"])}
    return rows.groupBy(F.col("ad_run_date").alias("date"), "region").agg(
        *[F.expr(f"{total} AS {out}") for out, total in totals.items()], *seg)
