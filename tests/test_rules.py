"""Rule chains as SQL text give what they give as Columns."""

from pyspark.sql import functions as F

from admart.functions.rules import Sql, call, first_match, like_any, like_none, literal, name
from admart.plans import ga4, google_ads, meta_ads


def same(spark, df, build, *columns):
    one = build(*[F.col(c) for c in columns])
    two = build(*[name(c) for c in columns])
    rows = df.select(one.alias("column"), two.alias("text")).collect()
    assert all(r["column"] == r["text"] for r in rows), rows


def test_models_agree(spark):
    words = ["US_[EXP] brand", "GB_a", "de_b", "[UK] [FRAG] x", "free copy", "it's \\ 50% \"x\"", "google", "paid_cpc", "pmax skin", "VIDEO", '"SEARCH"', None,
             "satin-kajal-liner", "aerin cream", "Victoria Beckham"]
    df = spark.createDataFrame([(a, b) for a in words for b in words], "a string, b string")
    same(spark, df, ga4.source_medium, "a", "b")
    same(spark, df, ga4.ads_platform, "a")
    same(spark, df, google_ads.campaign_category, "a")
    same(spark, df, google_ads.url_category, "a")
    same(spark, df, google_ads.keyword_brand, "a")
    same(spark, df, google_ads.campaign_type, "a")
    same(spark, df, google_ads.gads_channel, "a")
    same(spark, df, lambda a, b: google_ads.gads_category(a, b, b), "a", "b")
    same(spark, df, lambda a, b: meta_ads.meta_category(a, b, a, b), "a", "b")
    same(spark, df, lambda a, b: meta_ads.meta_country(a, b, a, bracket=b), "a", "b")


def test_text_is_quoted(spark):
    odd = "it's \\ 50% \"x\" `y`\n"
    df = spark.createDataFrame([(odd,), ("other",), (None,)], "a string")
    got = df.select(first_match([(name("a") == odd, odd), (name("a").isNull(), "null")], default="else").alias("x")).collect()
    assert [r["x"] for r in got] == [odd, "else", "null"]
    assert literal(None) == "NULL" and literal(True) == "true" and literal(3) == "3" and literal(Sql("a + 1")) == "a + 1"


def test_null_conditions_fall_through(spark):
    df = spark.createDataFrame([("x",), (None,)], "a string")
    rule = first_match([(like_none(name("a"), "%y%"), "no y"), (like_any(name("a"), "%x%") | name("a").isNull(), "null")])
    assert [r[0] for r in df.select(rule.alias("r")).collect()] == ["no y", "null"]
    assert [r[0] for r in df.select(call("concat", name("a"), "-", 1).alias("r")).collect()] == ["x-1", None]
