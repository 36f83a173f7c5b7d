"""Source registry naming, conforming and the fixture adapters' schemas."""

import pytest

from admart.config import Config
from admart.sources import IDENTIFIERS, SCHEMAS, conform, fixture_sources, physical_name


def test_physical_names():
    cfg = Config(prospect="acme", customer_id="123")
    assert physical_name("source_daily_meta_ads", cfg) == "acme_extracts.facebook_ads_insights"
    assert physical_name("source_daily_google_ads_ad_group_with_more_stats", cfg) == "acme_extracts.p_ads_AdStats_123"
    assert set(SCHEMAS) <= set(IDENTIFIERS)


@pytest.mark.parametrize("name", sorted(SCHEMAS))
def test_fixture_matches_declared_schema(spark, sf_small, name):
    df = fixture_sources(spark, sf_small)[name]
    declared = {f.name: f.dataType.simpleString() for f in SCHEMAS[name].fields}
    got = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert set(got) == set(declared)
    conformed = conform(df, name)
    assert [f.name for f in conformed.schema.fields] == [f.name for f in SCHEMAS[name].fields]
    assert conformed.limit(1).count() <= 1


def test_sinks(spark, tmp_path):
    from admart.sources import as_view, save_table
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    as_view(df, "admart_sink_view")
    assert spark.sql("SELECT count(*) FROM admart_sink_view").collect()[0][0] == 1
    save_table(df, path=str(tmp_path / "t"), partition_by=["y"])
    save_table(df, path=str(tmp_path / "t"), partition_by=["y"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1


def test_warehouse_path_roundtrip(spark, sf_small, tmp_path):
    """Sources laid out as <prospect>_extracts/<table> parquet read back through the registry
    give the same mart as the in-memory adapters."""
    from collections import Counter

    from admart.config import FIXTURE_AS_OF
    from admart.plans import combined
    from admart.sources.registry import parquet_reader, warehouse_sources

    cfg = Config(prospect="acme", customer_id="42", as_of=FIXTURE_AS_OF)
    fx = fixture_sources(spark, sf_small)
    for name in SCHEMAS:
        db, tbl = physical_name(name, cfg).split(".", 1)
        fx[name].write.parquet(f"{tmp_path}/{db}/{tbl}")
    wh = warehouse_sources(spark, cfg, parquet_reader(str(tmp_path)))
    a = Counter(map(tuple, combined.orders_sessions(wh).collect()))
    b = Counter(map(tuple, combined.orders_sessions(fx).collect()))
    assert a == b and sum(a.values()) > 0


def test_fractions_are_rounded_after_the_sum(spark):
    """Six ad-group rows with conversions 0.166667 and value 10.004 give 1.00 and 60.02."""
    from pyspark.sql import functions as F

    from admart.plans.google_ads import AD_GROUP_STATS, _daily
    raw = spark.createDataFrame([(1, 2, "2024-01-01", 1000000, 10, 1, 0.166667, 10.004)] * 6,
                                "campaign_id long, ad_group_id long, segments_date string, metrics_cost_micros long, "
                                "metrics_impressions long, metrics_clicks long, metrics_conversions double, metrics_conversions_value double")
    row = _daily(conform(raw, AD_GROUP_STATS), [F.col("campaign_id")]).collect()[0]
    assert (row.conversions, row.metrics_conversions_value, row.spend) == (1.0, 60.02, 6.0)


def test_fixture_money_has_fractions(spark, sf_small):
    src = fixture_sources(spark, sf_small)["source_daily_google_ads_keywords"]
    assert src.where("metrics_conversions != round(metrics_conversions, 2)").count() > 0
    assert src.where("metrics_conversions_value != round(metrics_conversions_value, 2)").count() > 0
    assert src.count() == spark.read.parquet(f"{sf_small}/lineitem.parquet").count()


def test_views_sort_at_the_sink(spark):
    from admart.sources import as_view
    as_view(spark.createDataFrame([(1,), (3,), (2,)], "x int"), "admart_sorted_view", order_by=["x"])
    assert [r.x for r in spark.table("admart_sorted_view").collect()] == [1, 2, 3]


def test_building_a_model_runs_no_job(spark, sf_small):
    from admart.config import FIXTURE_AS_OF
    from admart.plans import combined
    spark.sparkContext.setJobGroup("build-only", "plan building")
    combined.all_ads_daily(fixture_sources(spark, sf_small), Config(as_of=FIXTURE_AS_OF))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("build-only")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # reading a table's footer for its schema is the only job a plan may start
    assert len(jobs) <= 12
