"""Ranking operators: top-1 dedupe, rank-based median, outlier clamp.

No operator here sorts a whole source or a whole group in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from admart.operators.joins import lookup


def dedupe_top1(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                partition_by: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per ``keys``: the first by ``order`` descending, NULLs last.

    Ties on ``order`` are broken by the remaining columns (descending), so the pick is
    deterministic. Whole rows are shuffled once:
      - a hash aggregate over keys and the first ``order`` column alone finds each key's greatest value (combined
        map-side); rows are laid out by the same key, meet it there, and only those that tie for it are compared whole;
      - with ``partition_by``, a subset of ``keys``, rows are laid out by that and compared where they lie, and a
        later join on it needs no further shuffle.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in order]
    parts = ", ".join(f"`{c}` IS NOT NULL AS `__nn_{c}`, `{c}` AS `{c}`" for c in [*order, *rest])
    best = F.expr(f"max(struct({parts})) AS __best")
    columns = [f"__best.`{c}` AS `{c}`" for c in [*order, *rest]]
    quoted = [f"`{k}`" for k in keys]
    if partition_by is not None:
        return df.repartition(*partition_by).groupBy(*keys).agg(best).selectExpr(*quoted, *columns).select(*df.columns)
    # A struct of the keys is never NULL and equal where all its fields are, NULLs included.
    key = f"struct({', '.join(quoted)}) AS __key"
    top = df.selectExpr(key, f"`{order[0]}` AS __value").groupBy("__key").agg(F.expr("max(__value) AS __top"))
    # Told apart after a left join: as a condition of the join, the value would become a part of its key.
    ties = df.selectExpr(key, "*").join(top, "__key", "left").where(f"`{order[0]}` <=> __top")
    picked = ties.groupBy("__key").agg(best)
    return picked.selectExpr(*[f"__key.{k}" for k in quoted], *columns).select(*df.columns)


def median_ranks(n: Column) -> tuple[Column, Column]:
    """The two ranks the rank-median averages, with the cast of ``n/2`` rounding half away from
    zero: ``round(n/2) + 1`` and ``round((n+1)/2)``. For n = 1..5: {1}, {2}, {2,3}, {3}, {3,4}."""
    n = n.cast("long")
    upper = F.floor((n + 1) / 2).cast("long") + 1
    lower = F.floor(n / 2).cast("long") + 1
    return upper, lower


def value_bucket(v: Column) -> Column:
    """A bucket number that never falls as ``v`` rises: 64 buckets for each power of two, mirrored
    for negative values."""
    size = F.floor(F.log2(F.abs(v)) * 64) + F.lit(1 << 20)
    return F.when(v > 0, size).when(v < 0, -size).otherwise(F.lit(0)).cast("long")


def rank_median(df: DataFrame, keys: Sequence[str], value: str, out: str = "median", null_keys: bool = True) -> DataFrame:
    """Per group, the average of the values at ranks ``median_ranks(n)`` in ascending order.

    This is not ``percentile(0.5)``: for odd n it averages the middle and the next value. Exact,
    and spread out even when one group holds most rows:
      1. one hash aggregate counts each (group, value): rows leave the scan pre-aggregated;
      2. counts per value bucket, added up in bucket order, say which bucket holds which rank;
      3. the values of those buckets alone are ranked.
    The counts of step 1 are one shuffle that steps 2 and 3 share. NULL values are ignored. NULL
    keys form their own group, or are left out with ``null_keys=False``. Say so where the medians are joined back
    ``USING (keys)``: that join lets the optimizer drop NULL keys below step 3 alone, and unless step 2 drops them
    too, the two no longer share a shuffle and the input is read and parsed once more.
    """
    keys = list(keys)
    by = [f"`{k}`" for k in keys]
    known = "true" if null_keys else " AND ".join(f"{k} IS NOT NULL" for k in by)
    # A filter on the value would be pushed down to its inputs and compute them (say, parse JSON) once more.
    counts = df.selectExpr(*by, f"CAST(`{value}` AS DOUBLE) AS __v").where(known).groupBy(*keys, "__v").agg(
        F.expr("count(__v) AS __c")).where("__c > 0")
    counts = counts.withColumn("__b", F.coalesce(value_bucket(F.col("__v")), F.lit(0).cast("long")))
    per_bucket = counts.groupBy(*keys, "__b").agg(F.expr("sum(__c) AS __c"))
    group = f"PARTITION BY {', '.join(by)}"
    upto = f"sum(__c) OVER ({group} ORDER BY __b ROWS UNBOUNDED PRECEDING)"
    placed = per_bucket.selectExpr(*by, "__b", f"sum(__c) OVER ({group}) AS __n", f"{upto} - __c AS __before", f"{upto} AS __upto")
    r1, r2 = median_ranks(F.col("__n"))
    placed = placed.select("*", F.least(r1, F.col("__n")).alias("__r1"), r2.alias("__r2"))
    wanted = placed.where("(__before < __r1 AND __r1 <= __upto) OR (__before < __r2 AND __r2 <= __upto)")
    names = {k: f"__k{i}" for i, k in enumerate([*keys, "__b"])}
    wanted = wanted.selectExpr(*[f"`{k}` AS {n}" for k, n in names.items()], "__before", "__r1", "__r2")
    same = " AND ".join(f"`{k}` {'<=>' if null_keys else '='} {n}" for k, n in names.items())
    inside = counts.join(wanted, F.expr(same)).drop(*names.values())
    last = f"__before + sum(__c) OVER ({group}, __b ORDER BY __v ROWS UNBOUNDED PRECEDING)"
    ranked = inside.selectExpr("*", f"{last} AS __last").selectExpr("*", "__last - __c AS __first")
    hits = ("CASE WHEN __first < __r2 AND __r2 <= __last THEN 1 ELSE 0 END"
            " + CASE WHEN __r1 <> __r2 AND __first < __r1 AND __r1 <= __last THEN 1 ELSE 0 END AS __hits")
    picked = ranked.selectExpr("*", hits).where("__hits > 0")
    return picked.groupBy(*keys).agg(F.expr(f"sum(__v * __hits) / sum(__hits) AS `{out}`"))


def clamp_outliers(df: DataFrame, medians: DataFrame, keys: Sequence[str], value: str,
                   median: str, out: str, factor: float = 3.0, few_groups: bool = False) -> DataFrame:
    """Left-join the group median and replace values above ``factor`` x median by the median.

    NULL value or NULL median keeps the value. Joined ``USING (keys)``: NULL keys never match.
    ``medians`` has a row per group. With ``few_groups`` the caller vouches for a bounded number of groups
    (regions x months, say) and they are broadcast, so that the rows of ``df`` are not shuffled on a few dozen
    keys; else it is a ``lookup``, which is broadcast by measured size.
    """
    joined = df.join(F.broadcast(medians), list(keys), "left") if few_groups else lookup(df, medians, keys)
    too_big = F.col(value) > F.lit(factor) * F.col(median)
    return joined.withColumn(out, F.when(too_big, F.col(median)).otherwise(F.col(value)))
