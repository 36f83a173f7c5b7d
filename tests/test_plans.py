"""Plan shape checks: no Python in any plan, lookups broadcast, flagship merged by one aggregate."""

import pytest

from admart.queries import QUERIES


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf(spark, sf_small, name):
    plan = physical(QUERIES[name](spark, sf_small))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "PythonUDF" not in plan


def test_country_lookup_is_broadcast(spark, sf_small):
    plan = physical(QUERIES["country_code"](spark, sf_small))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_flagship_merges_its_feeds_without_a_full_outer_join(spark, sf_small):
    plan = QUERIES["all_ads_daily"](spark, sf_small)._jdf.queryExecution().optimizedPlan().toString()
    # The two levels of the grain back-fill, below the feeds' union; the lower one is read by the upper one's marks too.
    assert plan.count("FullOuter") == 3
    assert "FullOuter" not in plan.split("Union")[0]


def test_parquet_scan_is_pruned(spark, sf_small):
    plan = physical(QUERIES["monthly_users"](spark, sf_small))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in scan


def counts(df):
    plan = physical(df)
    return {k: plan.count(k) for k in ("FileScan parquet", "SortAggregate", "Exchange hashpartitioning", "FullOuter")}


@pytest.fixture()
def static_plans(spark):
    """Plans as they would run without adaptive changes or automatic broadcasts."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in keep.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("name,scans", [("grain_backfill", 3), ("gads_daily_rollup", 4), ("daily_google_ads", 8), ("all_ads_daily", 9),
                                        ("rank_median", 1), ("meta_aov_corrected", 2), ("daily_meta_ads", 2), ("meta_daily_rollup", 2)])
def test_scans_are_bounded(spark, sf_small, static_plans, name, scans):
    assert counts(QUERIES[name](spark, sf_small))["FileScan parquet"] <= scans


@pytest.mark.parametrize("name", ["keyword_brand", "campaign_dim", "last_state_ad", "ad_group_state", "dedupe_top1"])
def test_no_source_is_sorted_before_its_aggregate(spark, sf_small, static_plans, name):
    """Below every sort aggregate stands a hash aggregate, so only its few rows are sorted."""
    lines = physical(QUERIES[name](spark, sf_small)).splitlines()
    for i, line in enumerate(lines):
        if "SortAggregate" in line:
            assert any("HashAggregate" in x for x in lines[i + 1:]), line
    scan = max(i for i, x in enumerate(lines) if "FileScan" in x)
    above = [x for x in lines[:scan] if "Aggregate" in x]
    assert "HashAggregate" in above[-1]


def test_medians_are_broadcast_and_rows_stay(spark, sf_small, static_plans):
    plan = physical(QUERIES["daily_meta_ads"](spark, sf_small))
    assert "BroadcastHashJoin" in plan.split("BroadcastExchange")[0]


def test_ad_group_category_builds_no_list(spark, sf_small):
    from admart.plans import google_ads
    texts = spark.createDataFrame([(1, "a,skin-y", "t"), (2, None, "t"), (3, None, None)], "ad_group_id long, product string, ad_descriptions string")
    df = google_ads.ad_group_categories(texts)
    assert "collect_list" not in physical(df) and "collect_set" not in physical(df)
    assert {r[1]: r[0] for r in df.collect()} == {1: "SKN", 2: "SKN", 3: None}


def test_sku_report_exchanges(spark, sf_small, static_plans):
    assert counts(QUERIES["sku_sales_by_period"](spark, sf_small))["Exchange hashpartitioning"] <= 8


def test_median_shares_one_histogram(spark, sf_small, static_plans):
    """The rank search and the pick read one shuffle of (group, value) counts; each JSON text is parsed once for the rows
    and once for the counts."""
    plan = physical(QUERIES["meta_aov_corrected"](spark, sf_small))
    assert plan.count("ReusedExchange") == 1 and plan.count("from_json(ArrayType") <= 2 * 4 + 1


def test_dedupe_shuffles_whole_rows_once(spark, sf_small, static_plans):
    lines = [x for x in physical(QUERIES["dedupe_top1"](spark, sf_small)).splitlines() if "Exchange hashpartitioning" in x]
    assert len(lines) == 2  # whole rows, and (key, value) below the join


def test_ad_group_dim_exchanges(spark, sf_small, static_plans):
    plan = physical(QUERIES["ad_group_dim"](spark, sf_small))
    assert plan.count("Exchange hashpartitioning") - plan.count("ReusedExchange") <= 8
