"""Join operators: grain back-fill, merging per-key feeds, dimension lookups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Pieces that the fine rows of one key may be dealt to. A power of two up to 64 (pieces are bits of a long).
PIECES = 32
#: Pieces for rows whose NULL key matches nothing: enough to spread them over all tasks.
APART = 1 << 16


def any_null(keys: Sequence[str]) -> str:
    """SQL text: is one of the keys NULL?"""
    return "(" + " OR ".join(f"`{k}` IS NULL" for k in keys) + ")"


def piece_of(keys: Sequence[str], by: Sequence[str], pieces: int) -> str:
    """SQL text: the piece of its key a row belongs to, by a hash of the columns ``by`` that tell the rows of a key
    apart. Rows with a NULL key match nothing; they go to pieces of their own (negative), far more of them."""
    told = "xxhash64(" + ", ".join(f"`{c}`" for c in by) + ")"
    return f"CAST(CASE WHEN {any_null(keys)} THEN -1 - pmod({told}, {APART}) ELSE pmod({told}, {pieces}) END AS INT)"


def backfill(fine: DataFrame, coarse: DataFrame, keys: Sequence[str],
             metrics: Sequence[str], pieces: int = PIECES) -> DataFrame:
    """``fine FULL OUTER JOIN coarse USING (keys)`` with ``coalesce(fine.m, coarse.m)`` per metric.

    ``coarse`` is unique on ``keys``. Spark can neither broadcast a side of a full outer join nor split a key in it,
    so the fine rows of a key are dealt to ``pieces`` by a hash of their other columns:
      1. one aggregate puts a mark next to each coarse row for every piece where a fine row lacks a metric (a bit
         each in a long, combined map-side, so a hot key ships one row per task);
      2. a coarse row is copied to the marked pieces alone, as nothing of it is used elsewhere; one whose key has no
         fine row goes to no piece and stays unmatched;
      3. the full outer join is on (keys, piece). A copy meets the rows that asked for it, so a coarse row comes
         out unmatched once or not at all.
    Marks and join need the same columns of ``fine`` (the pieces come from all of them), so the shuffle below it is
    read twice and its sources once. NULL keys never match, as in SQL; fine rows that have one are spread over all tasks.
    """
    keys = list(keys)
    quoted = [f"`{k}`" for k in keys]
    fine_rest = [c for c in fine.columns if c not in keys and c not in metrics]
    dealt = fine.selectExpr("*", f"{piece_of(keys, fine_rest or fine.columns, pieces)} AS __piece")
    lacks = " OR ".join(f"`{m}` IS NULL" for m in metrics)
    types = dict(coarse.dtypes)
    marks = dealt.selectExpr(
        *quoted, *[f"CAST(NULL AS {types[m]}) AS `{m}`" for m in metrics],
        f"CASE WHEN __piece >= 0 AND ({lacks}) THEN shiftleft(1L, __piece) ELSE 0L END AS __marks", "false AS __coarse")
    rows = coarse.selectExpr(*quoted, *[f"`{m}`" for m in metrics], "CAST(NULL AS BIGINT) AS __marks", "true AS __coarse")
    # NULL keys of both sides don't meet.
    apart = F.expr(f"CASE WHEN {any_null(keys)} THEN __coarse END AS __apart")
    marked = rows.unionByName(marks).groupBy(*keys, apart).agg(
        *[F.expr(f"max(`{m}`) AS `__c_{m}`") for m in metrics],
        F.expr("bit_or(__marks) AS __marks"), F.expr("max(__coarse) AS __coarse"))
    to = (f"CASE WHEN __marks IS NULL THEN array(CAST(NULL AS INT)) "
          f"ELSE filter(sequence(0, {pieces - 1}), p -> getbit(__marks, p) = 1) END")
    copies = marked.where("__coarse").selectExpr(*quoted, *[f"`__c_{m}`" for m in metrics], f"explode({to}) AS __piece")
    return dealt.join(copies, [*keys, "__piece"], "full").selectExpr(
        *quoted, *[f"`{c}`" for c in fine_rest], *[f"coalesce(`{m}`, `__c_{m}`) AS `{m}`" for m in metrics])


def merge_by_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``left FULL OUTER JOIN right USING (keys)`` for two inputs that are each unique on ``keys``.

    Computed as union + one aggregate (one shuffle, partial aggregation). Rows with a NULL key
    are kept apart per side, because NULL keys never match in a join.
    """
    keys = list(keys)
    lcols = [c for c in left.columns if c not in keys]
    rcols = [c for c in right.columns if c not in keys]
    ltypes = dict(left.dtypes)
    rtypes = dict(right.dtypes)

    def pad(df, own, other, types, side):
        return df.selectExpr(*[f"`{c}`" for c in [*keys, *own]], *[f"CAST(NULL AS {types[c]}) AS `{c}`" for c in other],
                             f"{side} AS __side")

    both = pad(left, lcols, rcols, rtypes, 0).unionByName(
        pad(right, rcols, lcols, ltypes, 1))
    grouped = both.groupBy(*keys, F.expr(f"CASE WHEN {any_null(keys)} THEN __side END AS __nk"))
    return grouped.agg(*[F.expr(f"max(`{c}`) AS `{c}`") for c in lcols + rcols]).drop("__nk")


def channel_merge(feeds: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Align per-key feeds on ``keys``: union by name, missing measures NULL.

    Followed by a group-by on the same keys this equals the chain of full outer joins
    ``f1 FULL JOIN f2 USING (keys) FULL JOIN f3 ...`` then group-by, with one exchange instead of
    one per join.
    """
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)


def lookup(df: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left dimension lookup ``USING (keys)``; ``dim`` is unique on them.

    AQE measures the dimension when its stage has run and broadcasts it below the broadcast threshold
    (spark.sql.adaptive.autoBroadcastJoinThreshold), else both sides are dealt by key and hot keys are split. Rows
    with a NULL key match nothing: they are dealt to pieces of their own, so that they don't meet in one task.
    """
    keys = list(keys)
    by = [c for c, kind in df.dtypes if "map<" not in kind]  # maps have no hash
    facts = df.selectExpr("*", f"CASE WHEN {any_null(keys)} THEN {piece_of(keys, by, 1)} ELSE 0 END AS __piece")
    own = dim.selectExpr("*", f"CASE WHEN {any_null(keys)} THEN 1 ELSE 0 END AS __piece")
    return facts.join(own, [*keys, "__piece"], "left").drop("__piece")
