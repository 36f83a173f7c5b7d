"""Registered queries: name -> (spark, sf_dir) -> DataFrame, each over the whole test tables.

Every query derives the reference's source tables from the driver's tables (sources/fixtures.py)
and runs one model or operator on them. ``as_of`` is pinned so trailing-spend columns are stable.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from admart.config import FIXTURE_AS_OF, Config
from admart.functions.dates import latest_date
from admart.functions.geo import region_of, with_country_code
from admart.operators import concat_by_group
from admart.plans import combined, ga4, google_ads, meta_ads, shopify
from admart.plans.combined import decimals_to_double
from admart.session import shared_folder
from admart.sources import (SCHEMAS, accepted, as_view, checked, ledger_counts, physical_name, read_sorted, save_sorted,
                            save_table, warehouse_sources)
from admart.sources.fixtures import fixture_sources
from admart.sources.registry import parquet_reader

CFG = Config(prospect="fixture", customer_id="0", as_of=FIXTURE_AS_OF)

Query = Callable[[SparkSession, str], DataFrame]


_BUILT: dict[tuple[str, str], object] = {}


def _src(spark: SparkSession, sf_dir: str):
    """The sources over ``sf_dir``. They are lazy plans, so a session builds each of them once and all queries share it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        _BUILT[key] = fixture_sources(spark, sf_dir)
    return _BUILT[key]


def q_country_code(spark, sf_dir):
    """B1: spelling -> code over every GA4 row."""
    rows = ga4.channel_revenue(_src(spark, sf_dir))
    return rows.groupBy("country", "country_code").agg(F.count(F.lit(1)).alias("n_rows"))


def q_region_map(spark, sf_dir):
    """Shopify region via code next to the region via the name."""
    years = shopify.combined_years(_src(spark, sf_dir))
    coded = with_country_code(years, "country", out="country_code")
    return coded.groupBy(
        "country", "country_code",
        region_of("country_code").alias("region_via_code"),
        region_of("country").alias("region_via_name"),
    ).agg(F.count(F.lit(1)).alias("n_rows"))


def q_ga4_source_medium(spark, sf_dir):
    """Traffic class and ads platform for every source/medium pair seen."""
    rows = ga4.channel_revenue(_src(spark, sf_dir))
    return rows.groupBy("dimension_session_source", "dimension_session_medium", "ga4_source_medium",
                        "ads_platform").agg(F.count(F.lit(1)).alias("n_rows"))


def q_ga4_channel_revenue(spark, sf_dir):
    return decimals_to_double(ga4.channel_revenue(_src(spark, sf_dir)))


def q_ga4_daily_rollup(spark, sf_dir):
    return decimals_to_double(ga4.daily_rollup(ga4.channel_revenue(_src(spark, sf_dir)),
                                               CFG.meta_revenue_uplift))


def q_monthly_users(spark, sf_dir):
    return ga4.monthly_users(_src(spark, sf_dir))


def q_union_years(spark, sf_dir):
    return decimals_to_double(shopify.combined_years(_src(spark, sf_dir)))


def q_new_returning_daily(spark, sf_dir):
    return decimals_to_double(shopify.new_returning_daily(_src(spark, sf_dir)))


def q_shopify_daily(spark, sf_dir):
    return decimals_to_double(shopify.shopify_daily(shopify.new_returning_daily(_src(spark, sf_dir))))


def q_orders_sessions(spark, sf_dir):
    return combined.orders_sessions(_src(spark, sf_dir))


def q_dedupe_top1(spark, sf_dir):
    return decimals_to_double(shopify.dedupe_orders(_src(spark, sf_dir)))


def q_orders_by_period(spark, sf_dir):
    return shopify.orders_by_period(_src(spark, sf_dir), CFG.periods)


def q_sku_sales_by_period(spark, sf_dir):
    return shopify.sku_sales_by_period(_src(spark, sf_dir), CFG.periods)


def q_json_metrics(spark, sf_dir):
    """JSON-array metrics per ad-day."""
    m = meta_ads.extract_metrics(meta_ads.ad_name_updated(_src(spark, sf_dir)))
    return m.select("ad_id", "ad_run_date", "onsite_web_purchases", "onsite_web_app_purchase_sum_usd",
                    "landing_page_views", "onsite_web_app_add_to_cart_count",
                    "video_p75_watched_actions_count", "video_15_sec_watched_count")


def q_meta_segments(spark, sf_dir):
    """Flags, free-shipping note, country, region and category per ad-day."""
    m = meta_ads.extract_metrics(meta_ads.ad_name_updated(_src(spark, sf_dir)))
    seg = meta_ads.with_country_category(meta_ads.with_segments(m, CFG.meta))
    return seg.select("ad_id", "ad_run_date", "is_experiment", "is_reach_and_frequency",
                      "is_retargeting", "is_prospecting", "free_shipping_note", "country", "region",
                      "product_category")


def _meta_rows(spark, sf_dir):
    m = meta_ads.extract_metrics(meta_ads.ad_name_updated(_src(spark, sf_dir)))
    return meta_ads.aov_rows(meta_ads.with_country_category(meta_ads.with_segments(m, CFG.meta)))


def q_rank_median(spark, sf_dir):
    """Rank-median AOV per (region, month)."""
    return meta_ads.aov_medians(_meta_rows(spark, sf_dir))


def q_meta_aov_corrected(spark, sf_dir):
    """Corrected AOV and revenue per ad-day."""
    meta = meta_ads.daily_meta_ads(_src(spark, sf_dir), CFG, columns=["ad_id", "ad_run_date"])
    return meta.select("ad_id", "ad_run_date", "region", "month_start_date", "aov",
                       "aov_reion_month_median", "aov_corrected", "onsite_web_purchases",
                       "onsite_web_app_purchase_sum_usd", "ads_platform", "channel")


def q_daily_meta_ads(spark, sf_dir):
    """The full daily Meta view: every column of the model."""
    return decimals_to_double(meta_ads.daily_meta_ads(_src(spark, sf_dir), CFG))


def q_meta_daily_rollup(spark, sf_dir):
    meta = meta_ads.daily_meta_ads(_src(spark, sf_dir), CFG, columns=meta_ads.ROLLUP_COLUMNS)
    return decimals_to_double(meta_ads.meta_daily(meta))


def q_keyword_brand(spark, sf_dir):
    """Keyword last state and brand."""
    return google_ads.keywords(_src(spark, sf_dir))


def q_last_state_ad(spark, sf_dir):
    """Ad last state."""
    return google_ads.ad_state(_src(spark, sf_dir))


def q_campaign_dim(spark, sf_dir):
    """A4, A5, B5, B6, B15, F10, X3."""
    return google_ads.campaigns(_src(spark, sf_dir), CFG.as_of)


def q_ad_group_texts(spark, sf_dir):
    """A8, A9, B8, B9, F8, F9."""
    return google_ads.ad_texts(google_ads.ad_state(_src(spark, sf_dir)))


def q_ordered_concat(spark, sf_dir):
    """A8, A9, O3 for hot groups: per country of the order lines, the distinct products and all SKUs in order (digests
    of the joined texts)."""
    lines = _src(spark, sf_dir)[shopify.ORDER_LINES]
    products = concat_by_group(lines, ["billing_country"], {"products": "product"}, ",")
    skus = concat_by_group(lines, ["billing_country"], {"skus": "variant_sku"}, ", ", distinct=False)
    both = products.join(skus.withColumnRenamed("billing_country", "same"), F.expr("billing_country <=> same"))
    return both.selectExpr("billing_country", "CAST(length(products) AS BIGINT) AS products_length", "md5(products) AS products_md5",
                           "CAST(length(skus) AS BIGINT) AS skus_length", "md5(skus) AS skus_md5")


def q_ad_group_state(spark, sf_dir):
    """Latest type/name and total / 7-day / 14-day spend per ad group."""
    return google_ads.ad_group_state(_src(spark, sf_dir), CFG.as_of)


def q_ad_group_category(spark, sf_dir):
    """Category from landing products, back-filled by identical description."""
    return google_ads.ad_group_categories(google_ads.ad_texts(google_ads.ad_state(_src(spark, sf_dir))))


def q_ad_group_dim(spark, sf_dir):
    """A10, B7, B10, B11, B12."""
    return google_ads.ad_group_dim(_src(spark, sf_dir), CFG.as_of)


def q_grain_backfill(spark, sf_dir):
    """Keyword / ad group / campaign daily numbers merged."""
    return google_ads.daily_grains(_src(spark, sf_dir))


def q_grain_backfill_keyword(spark, sf_dir):
    """J3 first level: keyword days back-filled from ad-group days."""
    return google_ads.keyword_ad_group_days(_src(spark, sf_dir))


def q_daily_google_ads(spark, sf_dir):
    """J4, B18-B21, X2."""
    return google_ads.daily_google_ads(_src(spark, sf_dir), CFG)


def q_gads_daily_rollup(spark, sf_dir):
    """B32, X10."""
    return decimals_to_double(google_ads.gads_daily(google_ads.daily_by_campaign(_src(spark, sf_dir), CFG)))


def q_all_ads_daily(spark, sf_dir):
    """B34 flagship: J1 as union + one aggregate, A14."""
    return combined.all_ads_daily(_src(spark, sf_dir), CFG)


def q_latest_date(spark, sf_dir):
    """Freshness of a DATE, a TIMESTAMP and an epoch-seconds column."""
    src = _src(spark, sf_dir)
    meta = src["source_daily_meta_ads"]
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.unix_timestamp("ts").alias("epoch"))
    parts = [
        latest_date(meta, "date_start", "DATE").select(F.lit("DATE").alias("kind"), "latest_date"),
        latest_date(meta, "created_time", "TIMESTAMP").select(F.lit("TIMESTAMP").alias("kind"), "latest_date"),
        latest_date(events, "epoch", "INTEGER").select(F.lit("INTEGER").alias("kind"), "latest_date"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_mart_tables(spark, sf_dir):
    """Sources laid out as warehouse tables, read back through the registry; the
    all-ads mart saved as a table by month and the Meta view sorted by date, both read back."""
    root = f"{shared_folder(spark)}/admart-marts-{uuid.uuid4().hex}"
    sources = _src(spark, sf_dir)
    for name in SCHEMAS:
        save_table(sources[name], path=f"{root}/{physical_name(name, CFG).replace('.', '/')}")
    warehouse = warehouse_sources(spark, CFG, parquet_reader(root))
    save_table(combined.all_ads_daily(warehouse, CFG), path=f"{root}/mart", partition_by=["month"])
    meta = decimals_to_double(meta_ads.daily_meta_ads(warehouse, CFG, columns=["ad_id", "ad_run_date", "spend"]))
    view = f"daily_meta_ads_{uuid.uuid4().hex}"
    as_view(meta, view, order_by=[F.desc("ad_run_date")])
    mart = spark.read.parquet(f"{root}/mart")
    days = spark.table(view).groupBy(F.col("ad_run_date").alias("date")).agg(
        F.count(F.lit(1)).alias("meta_rows"), F.min("ad_id").alias("least_ad"))
    per_day = mart.groupBy("date").agg(F.count(F.lit(1)).alias("mart_rows"), F.sum("vbb_orders").alias("orders"),
                                       F.sum("ga4_sessions").alias("sessions"))
    return per_day.join(days, "date", "left")


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/admart-{name}-{uuid.uuid4().hex}"


def q_sorted_view(spark, sf_dir):
    """O1: the Meta view's final sort as a table in that order, read back with each row's position."""
    path = _scratch(spark, "sorted")
    meta = meta_ads.daily_meta_ads(_src(spark, sf_dir), CFG, columns=["ad_id", "ad_run_date", "spend"])
    save_sorted(decimals_to_double(meta.select("ad_id", "spend", "ad_run_date")), path, [F.desc("ad_run_date")])
    return read_sorted(spark, path).select("position", "ad_run_date", "ad_id", "spend")


def q_mart_refresh(spark, sf_dir):
    """A mart saved by month, the even months replaced alone, then the whole refreshed from itself."""
    path = _scratch(spark, "refresh")
    daily = shopify.new_returning_daily(_src(spark, sf_dir)).selectExpr(
        "day", "region", "new_orders", "CAST(new_sales AS DOUBLE) AS new_sales", "trunc(day, 'MM') AS month")
    save_table(daily, path=path, partition_by=["month"])
    even = daily.where("month(day) % 2 = 0").withColumn("new_orders", F.col("new_orders") * 10)
    save_table(even, path=path, partition_by=["month"], touched_only=True)
    save_table(spark.read.parquet(path).withColumn("new_orders", F.col("new_orders") + 1), path=path, partition_by=["month"])
    return spark.read.parquet(path).select("day", "region", "new_orders", "new_sales")


def q_reject_ledger(spark, sf_dir):
    """order lines and ad metrics that arrive as text with bad values: what was rejected, by column, and how
    many lines were accepted."""
    sources = _src(spark, sf_dir)
    lines = sources[shopify.ORDER_LINES]
    spoiled = {"ordered_items": "CASE WHEN order_id % 89 = 0 THEN ordered_items || ' pcs' ELSE ordered_items END",
               "product_price": "CASE WHEN order_id % 97 = 0 AND product_price IS NOT NULL THEN 'n/a' ELSE product_price END",
               "net_sales": "CASE WHEN order_id % 101 = 0 AND net_sales IS NOT NULL THEN '1,234.50' ELSE net_sales END"}
    texts = lines.selectExpr(*[f"CAST(`{c}` AS STRING) AS `{c}`" for c in lines.columns])
    rows = checked(texts.selectExpr(*[f"{spoiled.get(c, f'`{c}`')} AS `{c}`" for c in lines.columns]), shopify.ORDER_LINES)
    ads = sources[meta_ads.SOURCE].withColumn("actions", F.expr(
        """CASE WHEN ad_id % 83 = 0 THEN replace(actions, '"value":"', '"value":"~') ELSE actions END"""))
    metrics = checked(ads, meta_ads.SOURCE, json_values={"actions": "bigint"})
    total = accepted(rows).agg(F.lit("accepted lines").alias("column"), F.count(F.lit(1)).alias("n_rejected")).selectExpr(
        "*", "CAST(NULL AS BIGINT) AS n_values", "CAST(NULL AS STRING) AS least_value")
    return ledger_counts(rows).unionByName(ledger_counts(metrics)).unionByName(total)


QUERIES: dict[str, Query] = {
    "country_code": q_country_code,
    "region_map": q_region_map,
    "ga4_source_medium": q_ga4_source_medium,
    "ga4_channel_revenue": q_ga4_channel_revenue,
    "ga4_daily_rollup": q_ga4_daily_rollup,
    "monthly_users": q_monthly_users,
    "union_years": q_union_years,
    "new_returning_daily": q_new_returning_daily,
    "shopify_daily": q_shopify_daily,
    "orders_sessions": q_orders_sessions,
    "dedupe_top1": q_dedupe_top1,
    "orders_by_period": q_orders_by_period,
    "sku_sales_by_period": q_sku_sales_by_period,
    "json_metrics": q_json_metrics,
    "meta_segments": q_meta_segments,
    "rank_median": q_rank_median,
    "meta_aov_corrected": q_meta_aov_corrected,
    "daily_meta_ads": q_daily_meta_ads,
    "meta_daily_rollup": q_meta_daily_rollup,
    "keyword_brand": q_keyword_brand,
    "last_state_ad": q_last_state_ad,
    "campaign_dim": q_campaign_dim,
    "ad_group_texts": q_ad_group_texts,
    "ordered_concat": q_ordered_concat,
    "ad_group_state": q_ad_group_state,
    "ad_group_category": q_ad_group_category,
    "ad_group_dim": q_ad_group_dim,
    "grain_backfill_keyword": q_grain_backfill_keyword,
    "grain_backfill": q_grain_backfill,
    "daily_google_ads": q_daily_google_ads,
    "gads_daily_rollup": q_gads_daily_rollup,
    "all_ads_daily": q_all_ads_daily,
    "sorted_view": q_sorted_view,
    "mart_refresh": q_mart_refresh,
    "reject_ledger": q_reject_ledger,
    "latest_date": q_latest_date,
    "mart_tables": q_mart_tables,
}
