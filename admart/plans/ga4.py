"""GA4 models: daily country x channel revenue (view) and monthly users by region (table)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from admart.functions.geo import region_of, with_country_code
from admart.functions.rules import Sql, call, first_match, like_any, like_none, name
from admart.operators.aggregates import segment_sums

SOURCE = "source_ga4_daily_country_marketing_channel"
DEMOGRAPHIC = "source_ga4_demographic_country_report"

# The needles of the traffic rules here and in source_medium().
META_SOURCES = ("%facebook%", "%fb%", "%meta%")


def source_medium(source: Column | Sql, medium: Column | Sql) -> Column | Sql:
    """Traffic class of a GA4 session source/medium (11 classes, first match wins).

    The meta/paid rule reads ``a OR b OR c OR (d AND e)``: any facebook/fb/meta source is paid,
    only instagram needs a paid medium.
    """
    s, m = call("lower", source), call("lower", medium)
    paid = like_any(m, "%paid%", "%cpc%", "%ads%")
    return first_match([
        (s.like("%google%") & paid, "google/paid"),
        (like_any(s, *META_SOURCES)
         | (s.like("%instagram%") & like_any(m, "%paid%", "%cpc%", "%igshopping%")), "meta/paid"),
        (s.like("%google%") & m.like("%organic%"), "google/organic"),
        (m.like("%organic%"), "other/organic"),
        (s.like("%direct%") & m.like("%none%"), "direct/none"),
        (m.like("%social%") & like_none(s, *META_SOURCES, "%instagram%"), "organic/social"),
        (m.like("%referral%"), "referral"),
        (like_any(s, *META_SOURCES, "%instagram%"), "meta"),
        (m.like("%email%"), "email"),
        (like_none(m, "%referral%", "%not set%"), "affiliate"),
    ], default="other traffic")


def ads_platform(traffic_class: Column | Sql) -> Column | Sql:
    return first_match([
        (traffic_class.like("%google%"), "Google Ads"),
        (traffic_class.like("%meta%"), "Meta Ads"),
    ])


def channel_revenue(sources: Mapping[str, DataFrame]) -> DataFrame:
    """ga4_daily_country_channel_revenue: one row per source row, with country code, region,
    traffic class and ads platform."""
    src = sources[SOURCE]
    named = src.select(
        F.col("dimension_date").cast("date").alias("date"),
        F.col("dimension_country").alias("country"),
        F.col("metric_sessions").alias("sessions"),
        F.col("metric_purchase_revenue").alias("revenue"),
        F.col("metric_total_purchasers").alias("purchasers"),
        "dimension_session_medium",
        "dimension_session_source",
        source_medium(name("dimension_session_source"), name("dimension_session_medium"))
        .alias("ga4_source_medium"),
        F.col("dimension_session_default_channel_group").alias("session_default_channel_group"),
    )
    coded = with_country_code(named, "country", out="country_code")
    return coded.select(
        ads_platform(name("ga4_source_medium")).alias("ads_platform"),
        region_of("country").alias("region"),
        "date", "country", "country_code", "sessions", "revenue", "purchasers",
        "dimension_session_medium", "dimension_session_source", "ga4_source_medium",
        "session_default_channel_group",
    )


def monthly_users(sources: Mapping[str, DataFrame]) -> DataFrame:
    """ga4_monthly_users_by_country: total / new / returning users by month and region."""
    src = sources[DEMOGRAPHIC]
    keyed = src.select(
        F.trunc(F.to_date(F.col("date"), "yyyyMMdd"), "MM").alias("month"),
        region_of("country").alias("region"),
        "totalUsers", "newUsers")
    return keyed.groupBy("month", "region").agg(
        F.round(F.sum("totalUsers"), 2).cast("double").alias("totalUsers"),
        F.round(F.sum("newUsers"), 2).cast("double").alias("newUsers"),
        F.round(F.sum(F.col("totalUsers") - F.col("newUsers")), 2).cast("double").alias("returnUsers"),
    )


CHANNEL_GROUPS = {
    "direct": "session_default_channel_group = 'Direct'",
    "referral": "session_default_channel_group = 'Referral'",
    "organic": "lower(session_default_channel_group) LIKE '%organic%'",
}


def daily_rollup(channel: DataFrame, meta_uplift: float = 1.75) -> DataFrame:
    """GA4 part of the all-ads mart: one row per (date, region) with revenue, orders and sessions,
    split by channel group and ads platform. Days with no revenue or no purchasers are dropped."""
    metrics = {"revenue": "revenue", "orders": "purchasers", "sessions": "sessions"}
    grid = segment_sums(metrics, CHANNEL_GROUPS, name="ga4_{segment}_{metric}")
    agg = channel.groupBy("date", "region").agg(
        F.sum("revenue").alias("ga4_sales"),
        F.sum("purchasers").alias("ga4_orders"),
        F.sum("sessions").alias("ga4_sessions"),
        *grid,
        *segment_sums({"revenue": "revenue"}, {"gads": "ads_platform = 'Google Ads'"},
                      name="ga4_{segment}_{metric}"),
        *segment_sums({"revenue": "revenue"}, {"meta": "ads_platform = 'Meta Ads'"},
                      name="ga4_{segment}_{metric}", factor=meta_uplift),
    )
    return agg.where((F.col("ga4_sales") != 0) & (F.col("ga4_orders") != 0))
