"""Combined marts: all-ads daily performance (flagship) and new orders vs sessions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from admart.config import Config
from admart.operators.aggregates import zero_fill_sum
from admart.operators.joins import channel_merge, merge_by_key
from admart.plans import ga4, google_ads, meta_ads, shopify

KEYS = ["date", "region"]

# Output measures of the all-ads mart, in output order (output name -> feed column).
ALL_ADS_MEASURES: dict[str, str] = {
    "ga4_sessions": "ga4_sessions", "ga4_orders": "ga4_orders",
    **{f"meta_impressions{s}": f"meta_impressions{s}"
       for s in ("", "_retargeting", "_prospecting", "_experiment", "_rf")},
    "meta_landing_page_views": "landing_page_views",
    **{f"meta_landing_page_views{s}": f"meta_landing_page_views{s}"
       for s in ("_retargeting", "_prospecting", "_experiment", "_rf")},
    **{f"gads_impressions{s}": f"gads_impressions{s}" for s in ("", "_brand", "_generic", "_pmax")},
    **{f"meta_clicks{s}": f"meta_clicks{s}"
       for s in ("", "_retargeting", "_prospecting", "_experiment", "_rf")},
    **{f"gads_clicks{s}": f"gads_clicks{s}" for s in ("", "_brand", "_generic", "_pmax")},
    **{f"meta_conversions{s}": f"meta_conversions{s}"
       for s in ("", "_retargeting", "_prospecting", "_experiment", "_rf")},
    **{f"gads_conversions{s}": f"gads_conversions{s}" for s in ("", "_brand", "_generic", "_pmax")},
    "ga4_sales": "ga4_sales", "ga4_gads_revenue": "ga4_gads_revenue",
    "ga4_meta_revenue": "ga4_meta_revenue",
    **{f"ga4_{g}_{m}": f"ga4_{g}_{m}" for g in ("direct", "referral", "organic")
       for m in ("revenue", "orders", "sessions")},
    "vbb_sales": "shopify_sales", "vbb_new_sales": "shopify_new_sales",
    "vbb_return_sales": "shopify_return_sales", "vbb_orders": "shopify_orders",
    "vbb_new_orders": "shopify_new_orders", "vbb_return_orders": "shopify_return_orders",
    **{f"meta_sales{s}": f"meta_sales{s}"
       for s in ("", "_retargeting", "_prospecting", "_experiment", "_rf")},
    **{f"gads_sales{s}": f"gads_sales{s}" for s in ("", "_brand", "_generic", "_pmax")},
    **{f"meta_spend{s}": f"meta_spend{s}"
       for s in ("", "_retargeting", "_prospecting", "_experiment", "_rf")},
    **{f"gads_spend{s}": f"gads_spend{s}" for s in ("", "_brand", "_generic", "_pmax")},
}


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Exact decimal money becomes double once, at the output."""
    return df.selectExpr(*[f"CAST(`{c}` AS DOUBLE) AS `{c}`" if t.startswith("decimal") else f"`{c}`" for c, t in df.dtypes])


def feeds(sources: Mapping[str, DataFrame], cfg: Config) -> list[DataFrame]:
    """The four per-(date, region) feeds of the flagship mart."""
    return [
        ga4.daily_rollup(ga4.channel_revenue(sources), cfg.meta_revenue_uplift),
        shopify.shopify_daily(shopify.new_returning_daily(sources)),
        meta_ads.meta_daily(meta_ads.daily_meta_ads(sources, cfg, columns=meta_ads.ROLLUP_COLUMNS)),
        google_ads.gads_daily(google_ads.daily_by_campaign(sources, cfg)),
    ]


def all_ads_daily(sources: Mapping[str, DataFrame], cfg: Config | None = None) -> DataFrame:
    """all_ads_daily_performance: one row per (date, region) with 70 zero-filled measures.

    The four feeds are unioned and aggregated once (equal to the full-outer-join chain followed by
    the group-by; the NULL region of unmatched Google campaigns folds into one row per date).
    """
    cfg = cfg or Config()
    merged = channel_merge(feeds(sources, cfg), KEYS)
    out = merged.groupBy(*KEYS).agg(*zero_fill_sum(ALL_ADS_MEASURES))
    return decimals_to_double(out.select(
        "date", F.trunc(F.col("date"), "MM").alias("month"), "region", *ALL_ADS_MEASURES))


def orders_sessions(sources: Mapping[str, DataFrame]) -> DataFrame:
    """all_ads_daily_new_orders_sessions_by_source_medium: GA4 sessions per (date, region, traffic
    class) next to Shopify new orders per (date, region) under source_medium 'not_specified'."""
    sessions = ga4.channel_revenue(sources).groupBy(
        "date", "region", F.col("ga4_source_medium").alias("source_medium")).agg(
        F.round(F.sum("sessions")).cast("double").alias("sessions"))
    new_orders = shopify.new_returning_daily(sources).groupBy(
        F.col("day").alias("date"), "region").agg(
        F.round(F.sum("new_orders")).cast("double").alias("new_orders")).select(
        "date", "region", F.lit("not_specified").alias("source_medium"), "new_orders")
    merged = merge_by_key(new_orders, sessions, ["date", "region", "source_medium"])
    return merged.select("date", "region", "source_medium", "sessions", "new_orders")
