"""admart: marketing-performance datamarts as Spark DataFrame operators.

Layout:
  sources/    source registry, declared schemas, adapters from the test tables, sinks
  functions/  Column-level helpers (rule chains, text/JSON, dates, country/region lookups)
  operators/  DataFrame-level operators (segment sums, last state, back-fill, medians, periods)
  plans/      the data models: GA4, Google Ads, Meta Ads, Shopify and the combined marts
"""

from admart.config import Config

__all__ = ["Config"]
