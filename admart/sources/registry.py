"""Source registry: logical source name -> physical table, parameterised by prospect and customer."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from admart.config import Config
from admart.sources.schemas import SCHEMAS

# Logical source name -> physical table name ({customer} is the customer id).
IDENTIFIERS: dict[str, str] = {
    "source_daily_google_ads_keywords": "google_ads_keyword_view",
    "source_hourly_google_ads_campaigns": "google_ads_campaign",
    "source_daily_google_ads_ad": "google_ads_ad_group_ad",
    "source_daily_google_ads_ad_group": "google_ads_ad_group",
    "source_daily_google_ads_ad_group_with_more_stats": "p_ads_AdStats_{customer}",
    "source_daily_meta_ads": "facebook_ads_insights",
    "source_entity_custom_audiences": "custom_audiences",
    "source_ga4_daily_country_marketing_channel":
        "custom_source_ga4_daily_country_marketing_channel_with_session_metrics",
    "source_ga4_demographic_country_report": "ga4_demographic_country_report",
    "source_daily_new_return_sales_orders_2024_shopify": "gsheet_shopify_orders_new_vs_return_2024",
    "source_daily_new_return_sales_orders_2023_shopify": "gsheet_shopify_orders_new_vs_return_2023",
    "source_shopify_daily_sales_orders_users_by_country":
        "csv_shopify_daily_sales_orders_users_by_country",
    "source_shopify_monthly_sales_orders_new_return_per_order":
        "shopify_monthly_sales_orders_new_return_per_order",
}


def physical_name(name: str, cfg: Config) -> str:
    """``<prospect>_extracts.<identifier>`` with the customer id filled in."""
    return f"{cfg.database}.{IDENTIFIERS[name].format(customer=cfg.customer_id)}"


def conform(df: DataFrame, name: str) -> DataFrame:
    """Project a raw source to its declared columns and types (extra columns are dropped here,
    so the scan reads only what the models use)."""
    schema = SCHEMAS[name]
    return df.selectExpr(*[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields])


def warehouse_sources(spark: SparkSession, cfg: Config,
                      reader: Callable[[SparkSession, str], DataFrame] | None = None
                      ) -> "LazySources":
    """Lazily bind every declared source to its physical table (catalog table by default)."""
    read = reader or (lambda s, table: s.table(table))
    return LazySources({name: (lambda n=name: conform(read(spark, physical_name(n, cfg)), n))
                        for name in SCHEMAS})


def parquet_reader(root: str) -> Callable[[SparkSession, str], DataFrame]:
    """Reader for sources laid out as ``<root>/<database>/<table>`` parquet folders."""
    def read(spark: SparkSession, table: str) -> DataFrame:
        db, tbl = table.split(".", 1)
        return spark.read.parquet(f"{root}/{db}/{tbl}")
    return read


class Sources(Mapping):
    """Read-only mapping of logical source name -> DataFrame (what every model takes)."""

    def __init__(self, frames: Mapping[str, DataFrame]):
        self._frames = dict(frames)

    def __getitem__(self, name: str) -> DataFrame:
        return self._frames[name]

    def __iter__(self):
        return iter(self._frames)

    def __len__(self) -> int:
        return len(self._frames)


class LazySources(Sources):
    """Sources built on first access (and then reused), from name -> zero-argument factory."""

    def __init__(self, factories: Mapping[str, Callable[[], DataFrame]]):
        super().__init__({})
        self._factories = dict(factories)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._factories[name]()
        return self._frames[name]

    def __iter__(self):
        return iter(self._factories)

    def __len__(self) -> int:
        return len(self._factories)
