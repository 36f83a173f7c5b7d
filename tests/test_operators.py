"""Operators against their literal SQL forms or brute force, including NULL keys and hot groups."""

import datetime as dt
import random
from collections import Counter

from pyspark.sql import functions as F

from admart.config import DEFAULT_PERIODS
from admart.operators import (backfill, channel_merge, concat_by_group, dedupe_top1, distinct_count_and_sums, lookup, merge_by_key,
                              money_parts, money_sum, period_rollup, rank_median, segment_sums)
from admart.operators.aggregates import distinct_concat, last_state, last_value, ordered_concat
from admart.operators.windows import value_bucket


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_backfill_equals_full_outer_join(spark):
    fine = spark.createDataFrame(
        [(1, "a", 10.0), (1, "b", None), (2, "a", 5.0), (None, "z", 1.0), (4, None, 2.0)],
        "k int, kw string, m double")
    coarse = spark.createDataFrame([(1, 100.0), (3, 300.0), (None, 7.0), (4, None)], "k int, m double")
    got = backfill(fine, coarse, ["k"], ["m"]).select("k", "kw", "m")
    fine.createOrReplaceTempView("f")
    coarse.createOrReplaceTempView("c")
    want = spark.sql("SELECT k, f.kw, coalesce(f.m, c.m) AS m FROM f FULL OUTER JOIN c USING (k)")
    assert bag(got) == bag(want)


def test_merge_by_key_equals_full_outer_join(spark):
    left = spark.createDataFrame([(1, "x", 1.0), (2, "x", 2.0), (None, "x", 3.0)], "d int, r string, a double")
    right = spark.createDataFrame([(1, "x", 10), (3, "y", 30), (None, "x", 40)], "d int, r string, b long")
    got = merge_by_key(left, right, ["d", "r"]).select("d", "r", "a", "b")
    left.createOrReplaceTempView("l")
    right.createOrReplaceTempView("r2")
    want = spark.sql("SELECT d, r, l.a, r2.b FROM l FULL OUTER JOIN r2 USING (d, r)")
    assert bag(got) == bag(want)


def test_channel_merge_equals_full_join_chain(spark):
    f1 = spark.createDataFrame([(1, "UK", 1), (2, "US", 2)], "date int, region string, a long")
    f2 = spark.createDataFrame([(1, "UK", 10), (3, None, 30), (3, None, 31)], "date int, region string, b long") \
        .groupBy("date", "region").agg(F.sum("b").alias("b"))
    f3 = spark.createDataFrame([(2, "US", 5), (3, None, 6)], "date int, region string, c long")
    merged = channel_merge([f1, f2, f3], ["date", "region"]).groupBy("date", "region").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in "abc"])
    for n, f in (("f1", f1), ("f2", f2), ("f3", f3)):
        f.createOrReplaceTempView(n)
    want = spark.sql("""SELECT date, region, coalesce(sum(a), 0) a, coalesce(sum(b), 0) b, coalesce(sum(c), 0) c
                        FROM f1 FULL JOIN f2 USING (date, region) FULL JOIN f3 USING (date, region)
                        GROUP BY date, region""")
    assert bag(merged) == bag(want)


def test_period_rollup_equals_five_way_union(spark):
    rng = random.Random(3)
    months = [dt.date(y, m, 1) for y in (2023, 2024) for m in range(1, 13)] + [None]
    rows = [(rng.choice(months), rng.choice("ab"), str(rng.randrange(40))) for _ in range(400)]
    df = spark.createDataFrame(rows, "month date, g string, o string")
    got = period_rollup(df, "month", DEFAULT_PERIODS, ["g"], [F.count_distinct("o").alias("n")])
    df.createOrReplaceTempView("pr")
    parts = [f"SELECT '{p.label}' AS period, g, count(DISTINCT o) AS n FROM pr "
             f"WHERE month BETWEEN DATE '{p.first_month}' AND DATE '{p.last_month}' GROUP BY g"
             for p in DEFAULT_PERIODS]
    parts.append("SELECT CAST(month AS STRING) AS period, g, count(DISTINCT o) AS n FROM pr GROUP BY month, g")
    want = spark.sql(" UNION ALL ".join(parts))
    assert bag(got.select("period", "g", "n")) == bag(want)


def brute_median(values):
    """The reference's rule: average of rows ranked round(n/2)+1 and round((n+1)/2) (half up)."""
    v = sorted(values)
    n = len(v)
    ranks = {int(n / 2 + 0.5) + 1, int((n + 1) / 2 + 0.5)}
    picked = [v[r - 1] for r in ranks if r <= n]
    return sum(picked) / len(picked)


def test_rank_median_matches_brute_force_with_hot_group_and_ties(spark):
    rng = random.Random(7)
    rows = []
    for g, n in (("hot", 30_000), ("b", 1), ("c", 2), ("d", 3), ("e", 4), ("f", 5), ("g", 57)):
        for _ in range(n):
            rows.append((g, float(rng.randrange(0, 50)) if g == "g" else rng.random() * 100))
    rows += [("c", None), (None, 3.0), (None, 9.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r[0]: r[1] for r in rank_median(df, ["k"], "v", out="m").collect()}
    groups = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    assert set(got) == set(groups)
    for k, vals in groups.items():
        assert got[k] == brute_median(vals), k


def test_rank_median_even_count_and_signs(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(10)], "k string, v double")
    # n = 10: both ranks are 6 (round(5) + 1 and round(5.5)), so the value is 5.0, not 4.5 or 5.5
    assert rank_median(df, ["k"], "v").collect()[0][1] == 5.0 == brute_median(range(10))
    rng = random.Random(1)
    for n in (7, 8, 200, 201):
        vals = [rng.choice([-1, 1]) * rng.choice([0.0, 1e-9, 0.5, 0.5000001, 3.0, 1e12]) * rng.random() for _ in range(n)]
        df = spark.createDataFrame([("a", v) for v in vals], "k string, v double")
        assert rank_median(df, ["k"], "v").collect()[0][1] == brute_median(vals)


def test_value_bucket_never_falls(spark):
    rng = random.Random(5)
    vals = sorted({rng.choice([-1, 1]) * 10 ** rng.uniform(-12, 12) for _ in range(3000)} | {0.0, -0.0, 1.0, 2.0, 1e300, -1e300})
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r[1] for r in sorted(df.select("v", value_bucket(F.col("v"))).collect())]
    assert got == sorted(got)


def test_last_state_in_two_steps(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), dt.date(2024, 1, rng.randint(1, 5)), rng.choice(["x", "y", None]), rng.choice(["p", "q", None]), rng.randint(1, 9))
            for _ in range(60)]
    df = spark.createDataFrame(rows, "k string, d date, x string, y string, n long")
    got = last_state(df, {"key": "k"}, {"x": "x"}, "d", greatest={"y": "y"}, first={"__n": F.sum("n"), "__f": F.min("d")},
                     then={"n": F.sum("__n"), "first": F.min("__f"), "last": F.max("__last")})
    want = df.groupBy(F.col("k").alias("key")).agg(
        last_value("x", "d").alias("x"), F.max("y").alias("y"), F.sum("n").alias("n"), F.min("d").alias("first"), F.max("d").alias("last"))
    assert bag(got) == bag(want)


def test_dedupe_top1(spark):
    rows = [("k1", 5.0, "one-time", 1), ("k1", 7.0, "one-time", 1), ("k1", None, "z", 1),
            ("k2", None, "a", 1), ("k2", None, "b", 0), ("k3", 1.0, None, 1), ("k3", 1.0, "a", 1)]
    df = spark.createDataFrame(rows, "k string, s double, p string, o long")
    got = {r[0]: tuple(r) for r in dedupe_top1(df, ["k"], ["s"]).collect()}
    assert got == {"k1": ("k1", 7.0, "one-time", 1), "k2": ("k2", None, "b", 0), "k3": ("k3", 1.0, "a", 1)}
    laid_out = dedupe_top1(df.unionByName(df), ["k", "o"], ["s"], partition_by=["k"])
    assert bag(laid_out) == bag(dedupe_top1(df, ["k", "o"], ["s"]))


def test_distinct_count_and_sums(spark):
    rows = [("a", "o1", 1), ("a", "o1", 2), ("a", "o2", None), ("a", None, 5), ("b", "o3", 1)]
    df = spark.createDataFrame(rows, "g string, o string, x long")
    got = bag(distinct_count_and_sums(df, ["g"], "o", "n", {"x": "x"}).select("g", "n", "x"))
    want = bag(df.groupBy("g").agg(F.count_distinct("o").alias("n"), F.sum("x").alias("x")))
    assert got == want


def test_last_value_and_concat(spark):
    rows = [(1, dt.date(2024, 1, 1), "old"), (1, dt.date(2024, 1, 2), "b"), (1, dt.date(2024, 1, 2), "a"),
            (1, dt.date(2024, 1, 2), None), (2, dt.date(2024, 1, 1), None)]
    df = spark.createDataFrame(rows, "k int, d date, x string")
    got = {r[0]: (r[1], r[2], r[3]) for r in df.groupBy("k").agg(
        last_value("x", "d"), distinct_concat("x"), ordered_concat("x", ", ")).collect()}
    assert got == {1: ("b", "a,b,old", "a, b, old"), 2: (None, None, None)}


def rows_by_task(df):
    """Rows of each task of the last stage."""
    return sorted((r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()), reverse=True)


def test_backfill_spreads_a_hot_key_and_null_keys(spark):
    """A campaign-day with a third of the rows, and a third without a key: equal to SQL, and spread over tasks."""
    fine = spark.range(9000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN NULL ELSE id END AS campaign", "DATE'2024-01-01' AS day",
        "concat('w', id) AS keyword", "CASE WHEN id % 5 > 0 THEN id END AS m", "CASE WHEN id % 7 > 0 THEN id END AS n")
    coarse = spark.createDataFrame([(7, 1, 2), (None, 3, 4), (5, 5, None), (-1, 6, 7), (-2, None, 8)], "campaign long, m long, n long").selectExpr(
        "*", "DATE'2024-01-01' AS day")
    got = backfill(fine, coarse, ["day", "campaign"], ["m", "n"])
    fine.createOrReplaceTempView("f")
    coarse.createOrReplaceTempView("c")
    want = spark.sql("SELECT day, campaign, keyword, coalesce(f.m, c.m) AS m, coalesce(f.n, c.n) AS n FROM f FULL OUTER JOIN c USING (day, campaign)")
    assert bag(got.select("day", "campaign", "keyword", "m", "n")) == bag(want)
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(keep, ("false", "-1")):
            spark.conf.set(k, v)
        assert rows_by_task(got)[0] < 2000 and len(rows_by_task(got)) == 8  # by key alone, 3,000 rows meet in one task
        lacks = got.where("campaign = 7").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(lacks) == 8
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_backfill_copies_to_marked_pieces_alone(spark):
    """Coarse rows whose fine rows lack nothing are neither copied nor returned; pieces up to 64 work."""
    fine = spark.range(500).selectExpr("id % 2 AS k", "id AS w", "CASE WHEN id % 2 = 1 OR id % 10 > 0 THEN id END AS m")
    coarse = spark.createDataFrame([(0, -5), (1, -6), (2, -7)], "k long, m long")
    for pieces in (1, 2, 64):
        got = backfill(fine, coarse, ["k"], ["m"], pieces)
        assert got.count() == 501 and got.where("w IS NULL").collect()[0]["m"] == -7
        assert got.where("m = -5").count() == 50 and got.where("m = -6").count() == 0


def test_lookup_spreads_rows_without_a_key(spark):
    facts = spark.range(9000).selectExpr("CASE WHEN id % 3 > 0 THEN id % 50 END AS k", "id AS v")
    dim = spark.createDataFrame([(i, f"n{i}") for i in range(40)] + [(None, "none")], "k long, name string")
    got = lookup(facts, dim, ["k"])
    facts.createOrReplaceTempView("lf")
    dim.createOrReplaceTempView("ld")
    assert bag(got.select("k", "v", "name")) == bag(spark.sql("SELECT k, v, name FROM lf LEFT JOIN ld USING (k)"))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(keep, ("false", "-1")):
            spark.conf.set(k, v)
        alone = got.where("k IS NULL").groupBy(F.spark_partition_id()).count().collect()
        assert len(alone) == 8 and max(r["count"] for r in alone) < 800
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_dedupe_with_null_keys_ties_and_nulls_last(spark):
    rows = [(None, None, 1.0, "a"), (None, None, 2.0, "b"), (None, 1, None, "c"), (None, 1, None, "d"), (1, None, 5.0, "x"), (1, None, 5.0, None), (2, 2, None, None)]
    df = spark.createDataFrame(rows * 3, "k int, j int, s double, t string")
    want = {(None, None, 2.0, "b"), (None, 1, None, "d"), (1, None, 5.0, "x"), (2, 2, None, None)}
    assert bag(dedupe_top1(df, ["k", "j"], ["s"])) == Counter(want) == bag(dedupe_top1(df, ["k", "j"], ["s"], partition_by=["k"]))


def test_medians_without_null_keys(spark):
    rows = [(k, float(v)) for k in ("a", "b", None) for v in range(7)] + [("a", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    every = {r["k"]: r["median"] for r in rank_median(df, ["k"], "v").collect()}
    known = {r["k"]: r["median"] for r in rank_median(df, ["k"], "v", null_keys=False).collect()}
    assert known == {k: m for k, m in every.items() if k is not None} and None in every


def test_concat_by_group_equals_the_aggregates(spark):
    rows = [(i % 3 if i % 4 else None, f"v{i * 7 % 23}" if i % 5 else None, "it's" if i % 2 else None) for i in range(200)] + [(9, None, None)]
    df = spark.createDataFrame(rows, "k int, x string, y string").repartition(5)
    plain = df.groupBy("k").agg(distinct_concat("x").alias("x"), distinct_concat("y").alias("y"))
    assert bag(concat_by_group(df, ["k"], {"x": "x", "y": "y"})) == bag(plain)
    every = df.groupBy("k").agg(ordered_concat("x", "' ").alias("x"))
    assert bag(concat_by_group(df, ["k"], {"x": "x"}, "' ", distinct=False)) == bag(every)
    assert concat_by_group(df.limit(0), ["k"], {"x": "x"}).collect() == []


def test_concat_by_group_of_a_hot_group(spark):
    """10^5 different values in one group: the text is whole and in order, and no task holds all of its values."""
    df = spark.range(100_000).selectExpr("CASE WHEN id % 100 = 0 THEN 1 ELSE 0 END AS k", "concat('value ', id) AS v")
    got = {r["k"]: r["v"] for r in concat_by_group(df, ["k"], {"v": "v"}, "|").collect()}
    assert got[0] == "|".join(sorted(f"value {i}" for i in range(100_000) if i % 100))
    assert got[1] == "|".join(sorted(f"value {i}" for i in range(0, 100_000, 100)))
    keep = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        laid = df.groupBy("k", "v").count().repartitionByRange("k", "v")
        assert rows_by_task(laid)[0] < 30_000 and len(rows_by_task(laid)) == 8
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", keep)


def test_money_parts_add_up_exactly(spark):
    rng = random.Random(4)
    rows = [(rng.choice("ab"), rng.random() < 0.5 if rng.random() < 0.9 else None,
             None if rng.random() < 0.1 else str(rng.randrange(-10**20, 10**20)) + "e-9") for _ in range(500)]
    df = spark.createDataFrame(rows, "k string, seg boolean, t string").selectExpr("k", "seg", "CAST(t AS DECIMAL(24,9)) AS m")
    plain = df.groupBy("k").agg(F.expr("sum(m) AS total"), *segment_sums({"m": "m"}, {"seg": "seg"}))
    kind = "DECIMAL(34,9)"
    parts = money_parts(df, {"m": "m"}).groupBy("k").agg(F.expr(f"{money_sum('m', kind)} AS total"), *segment_sums({"m": "m"}, {"seg": "seg"}, money={"m": kind}))
    assert bag(parts) == bag(plain) and parts.dtypes == plain.dtypes
