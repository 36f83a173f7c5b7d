"""Shopify models: new vs returning daily orders, orders by period, SKU sales by period."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from admart.config import DEFAULT_PERIODS, Period
from admart.functions.geo import region_of, with_country_code
from admart.operators.aggregates import segment_sums
from admart.operators.aggregates import distinct_count_and_sums
from admart.operators.periods import period_labels, period_rollup
from admart.operators.sets import union_years
from admart.operators.windows import dedupe_top1

DAILY_2024 = "source_daily_new_return_sales_orders_2024_shopify"
DAILY_2023 = "source_daily_new_return_sales_orders_2023_shopify"
ORDER_LINES = "source_shopify_daily_sales_orders_users_by_country"
ORDERS = "source_shopify_monthly_sales_orders_new_return_per_order"


def combined_years(sources: Mapping[str, DataFrame]) -> DataFrame:
    return union_years([sources[DAILY_2024], sources[DAILY_2023]])


def new_returning_daily(sources: Mapping[str, DataFrame]) -> DataFrame:
    """daily_new_return_sales_orders: orders and sales of first-time and returning customers per
    day and region. The region goes name -> code -> region."""
    coded = with_country_code(combined_years(sources), "country")
    keyed = coded.withColumn("region", region_of("country"))
    return keyed.groupBy("day", "region").agg(*segment_sums(
        {"orders": "orders", "sales": "total_sales"},
        {"new": "customer_type = 'First-time'", "return": "customer_type = 'Returning'"},
        name="{segment}_{metric}"))


def shopify_daily(daily: DataFrame) -> DataFrame:
    """Shopify part of the all-ads mart: totals per (date, region)."""
    return daily.groupBy(F.col("day").alias("date"), "region").agg(
        F.sum(F.col("new_sales") + F.col("return_sales")).alias("shopify_sales"),
        F.sum("new_sales").alias("shopify_new_sales"),
        F.sum("return_sales").alias("shopify_return_sales"),
        F.sum(F.col("new_orders") + F.col("return_orders")).alias("shopify_orders"),
        F.sum("new_orders").alias("shopify_new_orders"),
        F.sum("return_orders").alias("shopify_return_orders"),
    )


def _month_of(text_col: str) -> F.Column:
    return F.to_date(F.concat(F.col(text_col), F.lit("-01")), "yyyy-MM-dd")


def orders_by_period(sources: Mapping[str, DataFrame],
                     periods: Sequence[Period] = DEFAULT_PERIODS) -> DataFrame:
    """shopify_monthly_orders_per_region_per_customer_type: distinct orders per month, region and
    customer type, plus each named period as the sum of its monthly counts (an order seen in two
    months counts twice there)."""
    src = sources[ORDERS].where(F.col("orders") == 1)
    keyed = src.select(
        _month_of("month").alias("month"),
        region_of("billing_country").alias("region"),
        F.concat(F.col("customer_type"), F.lit(" / "), F.col("purchase_option")).alias("customer_type"),
        "order_id")
    monthly = keyed.groupBy("month", "region", "customer_type").agg(
        F.count_distinct("order_id").alias("orders"))
    return period_rollup(monthly, "month", periods, ["region", "customer_type"],
                         [F.sum("orders").alias("orders")]).select(
        "period", "region", "customer_type", "orders")


def dedupe_orders(sources: Mapping[str, DataFrame], partition_by: Sequence[str] | None = None) -> DataFrame:
    """One row per (month, billing country, order, customer type): the one with the highest
    total sales (ties: the other columns, descending)."""
    return dedupe_top1(sources[ORDERS], ["month", "billing_country", "order_id", "customer_type"],
                       ["total_sales"], partition_by=partition_by)


def sku_sales_by_period(sources: Mapping[str, DataFrame],
                        periods: Sequence[Period] = DEFAULT_PERIODS) -> DataFrame:
    """shopify_sales_per_order_per_period_aov_analysis: per period, SKU, product, price, customer
    type and region - distinct orders, rounded quantities and money, and AOV.

    The order lines are joined to the deduplicated orders on (month, order) only, so an order with
    two countries or customer types multiplies its lines, as in the reference. Both sides are dealt by order alone:
    the month is compared by two inequalities, as an equality would become a part of the key. All rows of an order
    then lie in one task, where its lines are copied to their periods and added up per (period, order); one shuffle
    of sums is left.
    """
    orders = dedupe_orders(sources, partition_by=["order_id"]).selectExpr(
        "month AS __m", "order_id AS __o", "concat(customer_type, ' / ', purchase_option) AS customer_type")
    lines = sources[ORDER_LINES].where("variant_sku IS NOT NULL")
    joined = lines.join(orders, F.expr("order_id = __o AND month <= __m AND month >= __m"), "inner")
    keys = ["variant_sku", "product_title", "customer_type", "product_price", "region"]
    money = ["ordered_item_quantity", "gross_sales", "discounts", "net_sales"]
    # The month's text is parsed once a row, in a projection of its own; the labels compare the date many times.
    dated = joined.select(
        _month_of("month").alias("__date"), "order_id", "customer_type", "variant_sku", F.col("product").alias("product_title"),
        "product_price", F.col("ordered_items").alias("ordered_item_quantity"), "gross_sales", "discounts", "net_sales",
        region_of("billing_country").alias("region"))
    in_periods = dated.select(F.explode(period_labels("__date", periods)).alias("period"), "order_id", *keys, *money)
    rolled = distinct_count_and_sums(in_periods, ["period", *keys], "order_id", "orders", {m: m for m in money})
    rounded = rolled.where(F.col("period").isNotNull()).select(
        "period", "variant_sku", "product_title", "customer_type",
        F.col("product_price").cast("double").alias("product_price"), "orders",
        *[F.round(F.col(m)).cast("double").alias(m) for m in money], "region")
    return rounded.withColumn("aov", F.round(F.col("net_sales") / F.col("orders"), 2))
