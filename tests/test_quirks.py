"""Golden rows for the semantics that bite (X1-X11) and for rule arms."""

import datetime as dt

from pyspark.sql import functions as F

from admart.functions.geo import region_of, with_country_code
from admart.functions.json_metrics import json_metric_max, json_metric_sum
from admart.functions.text import json_quote, json_string, regexp_extract_or_null, trim_ws
from admart.operators.windows import median_ranks
from admart.plans import ga4, google_ads, meta_ads


def one(spark, col, rows, schema="x string"):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(col.alias("out")).collect()]


def test_x1_meta_paid_precedence(spark):
    rows = [("facebook.com", "organic"), ("fb", None), ("instagram", "organic"), ("instagram", "cpc"),
            ("google", "cpc"), ("google", "organic"), ("(direct)", "(none)"), ("bing", "social"),
            ("x", "referral"), ("x", "email"), ("x", "(not set)"), ("x", "display"), (None, None)]
    df = spark.createDataFrame(rows, "s string, m string")
    got = [r[0] for r in df.select(ga4.source_medium(F.col("s"), F.col("m"))).collect()]
    assert got == ["meta/paid", "meta/paid", "other/organic", "meta/paid", "google/paid",
                   "google/organic", "direct/none", "organic/social", "referral", "email",
                   "other traffic", "affiliate", "other traffic"]


def test_ads_platform(spark):
    got = one(spark, ga4.ads_platform(F.col("x")), [("google/organic",), ("meta",), ("email",)])
    assert got == ["Google Ads", "Meta Ads", None]


def test_x5_region_via_code_vs_name(spark):
    rows = [("United States of America (the)",), ("Great Britain",), ("Netherlands (the)",),
            ("Caribbean Netherlands",), ("Atlantis",), (None,), ("Namibia",), ("United Kingdom",)]
    df = with_country_code(spark.createDataFrame(rows, "country string"), "country", out="code")
    got = {r[0]: (r[1], r[2], r[3]) for r in df.select(
        "country", "code", region_of("code").alias("via_code"), region_of("country").alias("via_name")).collect()}
    assert got["United States of America (the)"] == ("US", "US", "ROW")
    assert got["Great Britain"] == ("not_set", "ROW", "UK")
    assert got["Netherlands (the)"] == ("NL", "EU", "ROW")
    assert got["Caribbean Netherlands"] == ("NL", "EU", "ROW")
    assert got["Atlantis"] == ("not_set", "ROW", "ROW")
    assert got[None] == ("not_set", "ROW", "ROW")
    assert got["Namibia"][0] == "NA"
    assert got["United Kingdom"] == ("UK", "UK", "UK")


def test_region_column_and_name_forms_agree(spark):
    rows = [("GB",), ("AUS",), ("Türkiye",), ("PM",), ("XX",), (None,)]
    df = spark.createDataFrame(rows, "c string")
    a = [r[0] for r in df.select(region_of("c")).collect()]
    b = [r[0] for r in df.select(region_of(F.col("c"))).collect()]
    assert a == b == ["UK", "AU", "EU", "EU", "ROW", "ROW"]


def test_x4_median_ranks(spark):
    df = spark.createDataFrame([(n,) for n in range(1, 7)], "n long")
    r1, r2 = median_ranks(F.col("n"))
    got = [(r[0], r[1], r[2]) for r in df.select("n", r1, r2).collect()]
    # ranks actually used are those <= n: {1}, {2}, {2,3}, {3}, {3,4}, {4}
    assert got == [(1, 2, 1), (2, 2, 2), (3, 3, 2), (4, 3, 3), (5, 4, 3), (6, 4, 4)]


def test_x6_x7_brand_regex(spark):
    rows = [("LANCÔME mascara",), ("lancome",), ("estélauder",), ("estée lauder",), ("Victoria Beckham",),
            ("victoria beckham",), ("beckham lauder set",), ("bond no 9",), ("perfume bond",), (None,),
            ("creedence",), ("satin kajal",), ("Tiffany blue",)]
    got = one(spark, google_ads.keyword_brand(F.col("x")), rows)
    assert got == ["Lancôme", "Lancôme", "non-brand", "Estee Lauder", "non-brand",
                   "Victoria Beckham Beauty", "Estee Lauder x Victoria Beckham Beauty",
                   "Bond No. 9 Tribeca", "Bond No. 9 Tribeca", "non-brand", "non-brand",
                   "Victoria Beckham Beauty", "Tiffany & Co."]


def test_x2_channel_uses_unstripped_category(spark):
    rows = [(None, '"PERFORMANCE_MAX"', None), ("PERFORMANCE_MAX", '"SEARCH"', None),
            ("VIDEO", '"DISPLAY"', None), (None, '"SEARCH"', None), ("UNKNOWN", '"VIDEO"', None),
            ("DISPLAY_STANDARD", "null", "Victoria Beckham Beauty"), ("SHOPPING_PRODUCT_ADS", "null", None)]
    df = spark.createDataFrame(rows, "t string, c string, b string")
    raw = google_ads.gads_category(F.col("t"), F.col("c"), F.col("b"))
    got = [(r[0], r[1]) for r in df.select(F.replace(raw, F.lit('"'), F.lit("")),
                                            google_ads.gads_channel(raw)).collect()]
    assert got == [("PERFORMANCE_MAX", "gads not mapped"), ("NON-BRAND SEARCH", "Paid Search"),
                   ("GOOGLE VIDEO", "gads not mapped"), ("NON-BRAND SEARCH", "Paid Search"),
                   ("VIDEO", "gads not mapped"), ("BRAND SEARCH", "Paid Search"),
                   ("SHOPPING_PRODUCT_ADS", "gads not mapped")]


def test_x3_json_text_of_null_sorts_last(spark):
    df = spark.createDataFrame([(1, "SEARCH"), (1, None), (2, 'a"b')], "k int, x string")
    got = dict((r[0], r[1]) for r in df.groupBy("k").agg(F.max(json_quote(F.col("x")))).collect())
    assert got == {1: "null", 2: '"a\\"b"'}
    arr = spark.createDataFrame([(["a", "b"],), (None,)], "x array<string>")
    assert [r[0] for r in arr.select(json_string(F.col("x"))).collect()] == ['["a","b"]', "null"]


def test_campaign_type_order_and_country(spark):
    names = [("non-brand search",), ("aus_suite-302_pmax",), ("brand_us_misc",), ("[exp] us_eye_generic",),
             ("shopping everything",), ("gb_fragrance_generic",)]
    df = spark.createDataFrame(names, "x string")
    got = [r[0] for r in df.select(google_ads.campaign_type(F.col("x"))).collect()]
    assert got == ["brand", "pmax", "brand", "generic", "generic", "generic"]
    country = F.upper(regexp_extract_or_null(F.col("x"), google_ads.CAMPAIGN_COUNTRY))
    assert [r[0] for r in df.select(country).collect()] == ["NON", "AUS", "AND", "US", None, "GB"]


def test_category_rules_case_differs(spark):
    df = spark.createDataFrame([("de_mascara_generic",), ("tote",)], "x string")
    assert [r[0] for r in df.select(google_ads.campaign_category(F.col("x"))).collect()] == ["Mas", "MSC"]
    assert [r[0] for r in df.select(google_ads.url_category(F.col("x"))).collect()] == ["MAS", None]


def test_like_underscore_is_wildcard(spark):
    df = spark.createDataFrame([("jewel-smoky",)], "x string")
    got = [r[0] for r in df.select(meta_ads.meta_category(F.lit(None).cast("string"), F.col("x"),
                                                          F.lit("set"), F.lit("camp"))).collect()]
    assert got == ["SKL"]


def test_meta_country_gb_case(spark):
    rows = [("gb_low", None, None), ("GB_broad", None, None), (None, "[GB] [MCE] b", "US_x"),
            (None, "[SKN] c", None), ("plain", "no bracket", "GB_prospect"), (None, None, "x")]
    df = spark.createDataFrame(rows, "a string, d string, c string")
    got = [r[0] for r in df.select(meta_ads.meta_country(F.col("a"), F.col("d"), F.col("c"))).collect()]
    assert got == ["GB", "UK", "US", "SKN", "UK", None]


def test_json_metrics_edge_cases(spark):
    rows = [('[{"action_type":"p","value":"2"},{"action_type":"p","value":"5"},{"action_type":"q","value":"9"}]',),
            ("[]",), (None,), ('{"action_type":"p","value":"3"}',), ('[{"action_type": "p", "value": ',),
            ('[{"action_type":"p","value":7}]',)]
    df = spark.createDataFrame(rows, "x string")
    got = [(r[0], r[1]) for r in df.select(json_metric_max(F.col("x"), "p"), json_metric_sum(F.col("x"))).collect()]
    assert got == [(5, 16), (None, None), (None, None), (None, None), (None, None), (7, 7)]


def test_regexp_extract_and_trim(spark):
    df = spark.createDataFrame([("a [US] b",), ("none",), (None,)], "x string")
    assert [r[0] for r in df.select(regexp_extract_or_null(F.col("x"), r"\[([^\]]+)\]")).collect()] == \
        ["US", None, None]
    df2 = spark.createDataFrame([("\t x \n",)], "x string")
    assert df2.select(trim_ws(F.col("x"))).collect()[0][0] == "x"


def test_trailing_window_inclusive(spark):
    from admart.functions.dates import in_trailing_days
    as_of = dt.date(2024, 6, 20)
    df = spark.createDataFrame([(dt.date(2024, 6, 13),), (dt.date(2024, 6, 12),)], "d date")
    assert [r[0] for r in df.select(in_trailing_days("d", as_of, 7)).collect()] == [True, False]


def test_latest_date_kinds(spark):
    import pytest
    from admart.functions.dates import latest_date
    df = spark.createDataFrame([(1704067201, dt.date(2024, 1, 5))], "s long, d date")
    assert latest_date(df, "s", "INTEGER").collect()[0][0] == dt.date(2024, 1, 1)
    assert latest_date(df, "d", "date").collect()[0][0] == dt.date(2024, 1, 5)
    with pytest.raises(ValueError):
        latest_date(df, "d", "STRING")


def test_trim_takes_unicode_white_space(spark):
    df = spark.createDataFrame([("\u00a0a b\u00a0\u2003",), ("\u3000x",)], "x string")
    assert [r[0] for r in df.select(trim_ws(F.col("x"))).collect()] == ["a b", "x"]


def test_json_quote_escapes_as_json(spark):
    rows = [('a"b\\c',), ("two\nlines\t",), (None,), ("é\u0001",), ("",)]
    assert one(spark, json_quote(F.col("x")), rows) == ['"a\\"b\\\\c"', '"two\\nlines\\t"', "null", '"é\\u0001"', '""']


def test_newline_in_an_ad_text_is_no_piece(spark):
    texts = F.regexp_extract_all(json_string(F.array(F.col("x"), F.lit('text: "ok"'))), F.lit(google_ads.AD_TEXT), 1)
    assert one(spark, texts, [('text: "two\nlines"',)]) == [["ok"]]


def test_json_path_and_bad_numbers(spark):
    import pytest
    rows = [('[{"v":{"a":"2"}},{"v":{"a":3}},{"v":{}}]',), ("[]",), (None,)]
    assert one(spark, json_metric_sum(F.col("x"), "$.v.a"), rows) == [5, None, None]
    for bad in ('[{"action_type":"p","value":"3.0"},{"action_type":"p","value":"2"}]', '[{"action_type":"p","value":"x"}]'):
        for metric in (json_metric_max(F.col("x"), "p"), json_metric_sum(F.col("x"))):
            with pytest.raises(Exception, match="not a bigint"):
                one(spark, metric, [(bad,)])


def test_rule_data_counts_and_spot_values():
    """The data both sides share, and the oracle's own tables, hold what the survey counts."""
    from admart import oracle
    from admart.functions.geo import REGION_KEYS, country_code_rows
    from admart.plans.combined import ALL_ADS_MEASURES
    pairs = country_code_rows()
    assert len(pairs) == 305 and len(dict(pairs)) == 305 and len({c for _, c in pairs}) == 250
    assert dict(pairs)["Namibia"] == "NA" and dict(pairs)["Türkiye"] == "TR"
    assert sum(map(len, REGION_KEYS.values())) == 150
    assert oracle.MEASURES == ALL_ADS_MEASURES and len(oracle.MEASURES) == 70
    assert {c for _, c, _ in oracle.CATEGORY_NEEDLES} == {c for c, _ in google_ads.CATEGORY_RULES}
    assert [b for b, _ in google_ads.BRAND_RULES] == list(dict.fromkeys(b for b, _ in oracle.BRANDS))
    assert len({c for _, c, *_ in oracle.TRAFFIC_RULES}) == 10
