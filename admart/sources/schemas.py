"""Declared source schemas: only the columns the models use, with the types they need.

The reference declares no columns (schemas are inferred by the warehouse); declaring them here lets a
reader project and cast once at the scan, so Catalyst prunes every other column. Money and conversions
keep nine decimals: feeds report fractions of both, and they are rounded after the sum, never before.
"""

from pyspark.sql.types import (ArrayType, DateType, DecimalType, DoubleType, LongType, StringType,
                               StructField, StructType, TimestampType)

S, L, D, DEC, DBL, TS = StringType(), LongType(), DateType(), DecimalType(24, 9), DoubleType(), TimestampType()
ARR = ArrayType(StringType())


def _schema(*cols: tuple) -> StructType:
    return StructType([StructField(n, t, True) for n, t in cols])


_GADS_METRICS = (("metrics_cost_micros", L), ("metrics_impressions", L), ("metrics_clicks", L),
                 ("metrics_conversions", DEC), ("metrics_conversions_value", DEC))

SCHEMAS: dict[str, StructType] = {
    "source_ga4_daily_country_marketing_channel": _schema(
        ("dimension_date", S), ("dimension_country", S), ("metric_sessions", L),
        ("metric_purchase_revenue", DEC), ("metric_total_purchasers", L),
        ("dimension_session_medium", S), ("dimension_session_source", S),
        ("dimension_session_default_channel_group", S)),
    "source_ga4_demographic_country_report": _schema(
        ("date", S), ("country", S), ("totalUsers", L), ("newUsers", L)),
    "source_daily_google_ads_keywords": _schema(
        ("campaign_id", L), ("ad_group_id", L), ("ad_group_criterion_keyword_text", S),
        ("segments_date", D), *_GADS_METRICS, ("ad_group_criterion_type", S),
        ("campaign_bidding_strategy_type", S), ("ad_group_criterion_keyword_match_type", S)),
    "source_hourly_google_ads_campaigns": _schema(
        ("campaign_id", L), ("segments_date", D), ("campaign_name", S), *_GADS_METRICS,
        ("metrics_video_views", L), ("segments_ad_network_type", S),
        ("metrics_interaction_event_types", ARR), ("campaign_advertising_channel_type", S),
        ("campaign_payment_mode", S)),
    "source_daily_google_ads_ad_group_with_more_stats": _schema(
        ("campaign_id", L), ("ad_group_id", L), ("segments_date", D), *_GADS_METRICS),
    "source_daily_google_ads_ad_group": _schema(
        ("ad_group_id", L), ("ad_group_type", S), ("ad_group_name", S), ("segments_date", D),
        ("metrics_cost_micros", L)),
    "source_daily_google_ads_ad": _schema(
        ("ad_group_id", L), ("ad_group_ad_ad_id", L), ("segments_date", D),
        ("ad_group_ad_ad_name", S), ("ad_group_ad_ad_type", S), ("ad_group_ad_ad_final_urls", ARR),
        ("ad_group_ad_ad_responsive_search_ad_descriptions", ARR),
        ("ad_group_ad_ad_video_responsive_ad_descriptions", ARR),
        ("ad_group_ad_ad_responsive_display_ad_descriptions", ARR),
        ("ad_group_ad_ad_expanded_text_ad_description", S)),
    "source_daily_meta_ads": _schema(
        ("date_start", D), ("campaign_id", S), ("adset_id", S), ("ad_id", S), ("campaign_name", S),
        ("adset_name", S), ("ad_name", S), ("reach", L), ("spend", DEC), ("impressions", L),
        ("clicks", L), ("unique_clicks", L), ("inline_post_engagement", L),
        ("unique_inline_link_clicks", L), ("frequency", DBL), ("cpc", DBL), ("cpm", DBL),
        ("cpp", DBL), ("ctr", DBL), ("unique_link_clicks_ctr", DBL), ("actions", S),
        ("action_values", S), ("video_p75_watched_actions", S), ("video_15_sec_watched_actions", S),
        ("quality_ranking", S), ("account_currency", S), ("optimization_goal", S),
        ("created_time", TS), ("updated_time", TS)),
    "source_daily_new_return_sales_orders_2024_shopify": _schema(
        ("day", D), ("country", S), ("customer_type", S), ("orders", L), ("total_sales", DEC)),
    "source_daily_new_return_sales_orders_2023_shopify": _schema(
        ("day", D), ("country", S), ("customer_type", S), ("orders", L), ("total_sales", DEC)),
    "source_shopify_daily_sales_orders_users_by_country": _schema(
        ("month", S), ("order_id", S), ("billing_country", S), ("variant_sku", S), ("product", S),
        ("product_price", DEC), ("ordered_items", L), ("gross_sales", DEC), ("discounts", DEC),
        ("net_sales", DEC)),
    "source_shopify_monthly_sales_orders_new_return_per_order": _schema(
        ("month", S), ("billing_country", S), ("order_id", S), ("customer_type", S),
        ("purchase_option", S), ("orders", L), ("total_sales", DEC)),
}
