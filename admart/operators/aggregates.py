"""Aggregate operators. All combine map-side, so a hot group is pre-reduced in every task before the
shuffle. Sums, counts and numeric minima and maxima are hash aggregates; the maximum of a string or
a struct is a sort aggregate, so it only runs on rows that a hash aggregate has made few."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def money_parts(df: DataFrame, money: Mapping[str, str]) -> DataFrame:
    """``df`` and, for each decimal of ``money`` (name -> SQL text), two longs that make it up: whole thousandths and
    the billionths that are left. Longs add up in machine words, where decimals of more than 18 digits are objects;
    a grid of conditional sums over the parts, which are made once a row, takes about a third of the time (a single
    plain sum gains nothing). Exact: the parts of a group may count 9.2e18 thousandths and 9e12 rows, and more is an
    overflow error. At most nine decimals.
    """
    parts = []
    for name, value in money.items():
        high = f"CAST(floor(({value}) * 1000BD) AS BIGINT)"
        parts += [f"{high} AS `__h_{name}`", f"CAST((({value}) - {high} * 0.001BD) * 1000000000BD AS BIGINT) AS `__l_{name}`"]
    return df.selectExpr("*", *parts)


def money_sum(name: str, kind: str, segment: str | None = None) -> str:
    """SQL text of the sum of a ``money_parts`` decimal, as ``kind``: of all rows, or with 0 for rows out of the segment."""
    of = (lambda c: f"CASE WHEN {segment} THEN `{c}` ELSE 0 END") if segment else (lambda c: f"`{c}`")
    whole, rest = (f"CAST(sum({of(p + name)}) AS DECIMAL(20,0))" for p in ("__h_", "__l_"))
    return f"CAST({whole} * 0.001BD + {rest} * 0.000000001BD AS {kind})"


def segment_sums(metrics: Mapping[str, Column | str], segments: Mapping[str, Column | str],
                 name: str = "{metric}_{segment}", factor: float | None = None, money: Mapping[str, str] | None = None) -> list[Column]:
    """Conditional sums ``sum(if(segment, metric, 0))`` for every (segment x metric) pair. Metrics in ``money``
    (metric -> type of the sum) are added up from their ``money_parts``.

    Returns aggregate Columns to put into one ``agg``: one pass computes the whole grid.
    A NULL segment flag counts as false; a NULL metric is skipped by ``sum``. Metrics and
    segments may be given as SQL text (column names or expressions); then each aggregate is
    built from one SQL expression, which keeps plan construction cheap for wide grids.
    """
    out = []
    scale = "" if factor is None else f" * {Decimal(repr(factor))}BD"
    for mname, m in metrics.items():
        for sname, cond in segments.items():
            alias = name.format(metric=mname, segment=sname)
            if money and mname in money:
                out.append(F.expr(f"{money_sum(mname, money[mname], cond)} AS `{alias}`"))
                continue
            if isinstance(m, str) and isinstance(cond, str):
                out.append(F.expr(f"sum(CASE WHEN {cond} THEN {m} ELSE 0 END){scale} AS `{alias}`"))
                continue
            mc = F.expr(m) if isinstance(m, str) else m
            cc = F.expr(cond) if isinstance(cond, str) else cond
            total = F.sum(F.when(cc, mc).otherwise(F.lit(0)))
            if factor is not None:
                total = total * F.lit(Decimal(repr(factor)))
            out.append(total.alias(alias))
    return out


def zero_fill_sum(cols: Mapping[str, str] | Sequence[str]) -> list[Column]:
    """``coalesce(sum(c), 0)`` for each column (output name -> input column), one SQL expression
    per output."""
    pairs = cols.items() if isinstance(cols, Mapping) else [(c, c) for c in cols]
    return [F.expr(f"coalesce(sum(`{src}`), 0) AS `{out}`") for out, src in pairs]


def last_value(value: Column | str, order: Column | str) -> Column:
    """Value on the row with the greatest ``order`` (ties: greatest value, so it is deterministic).

    The max of a struct is a sort aggregate; use it on rows that a hash aggregate made few, as
    ``last_state`` does, not on a source.
    """
    if isinstance(value, str) and isinstance(order, str):
        return F.expr(f"max(struct(`{order}` AS o, `{value}` AS v)).v")
    value = F.col(value) if isinstance(value, str) else value
    order = F.col(order) if isinstance(order, str) else order
    return F.max(F.struct(order.alias("o"), value.alias("v")))["v"]


def last_state(df: DataFrame, keys: Mapping[str, str] | Sequence[str], cols: Mapping[str, str | Column],
               order: str, greatest: Mapping[str, str | Column] | None = None,
               first: Mapping[str, Column] | None = None, then: Mapping[str, Column] | None = None,
               lay_out: Sequence[str] | None = None) -> DataFrame:
    """Latest state per entity, in two steps.

    First a hash aggregate per (entity, attribute values) keeps the greatest ``order``: the source is
    combined map-side, never sorted, and its rows shrink to the different states of each entity.
    Then, per entity, each output of ``cols`` is its last value by ``order`` and each of ``greatest``
    its greatest value. ``first`` names further aggregates for the first step (sums, minima) and
    ``then`` how the second step folds them; ``__last`` is the greatest ``order`` there. ``lay_out``, a subset of
    ``keys``, deals the states by those keys alone, so that a later aggregate or join on them needs no shuffle.
    """
    keys = dict(keys) if isinstance(keys, Mapping) else {k: k for k in keys}
    named = lambda c, n: F.expr(f"`{c}` AS `{n}`") if isinstance(c, str) else c.alias(n)
    states = {**cols, **(greatest or {})}
    per_state = df.groupBy(*[named(src, k) for k, src in keys.items()],
                           *[named(c, f"__a_{out}") for out, c in states.items()]).agg(
        F.max(order).alias("__last"), *[c.alias(n) for n, c in (first or {}).items()])
    if lay_out:
        per_state = per_state.repartition(*lay_out)
    pick = lambda out: f"max(`__a_{out}`)" if out in (greatest or {}) else f"max(struct(__last AS o, `__a_{out}` AS v)).v"
    return per_state.groupBy(*keys).agg(
        *[F.expr(f"{pick(out)} AS `{out}`") for out in states],
        *[c.alias(n) for n, c in (then or {}).items()])


def distinct_concat(c: Column | str, sep: str = ",") -> Column:
    """Distinct non-NULL values joined ascending by ``sep``; NULL when there are none.

    ``collect_set`` deduplicates map-side, so a group ships at most its distinct values.
    """
    c = F.col(c) if isinstance(c, str) else c
    values = F.array_sort(F.collect_set(c))
    return F.when(F.size(values) > 0, F.array_join(values, sep))


def ordered_concat(c: Column | str, sep: str = ", ") -> Column:
    """All non-NULL values (duplicates kept) joined ascending by ``sep``; NULL when none."""
    c = F.col(c) if isinstance(c, str) else c
    values = F.array_sort(F.collect_list(c))
    return F.when(F.size(values) > 0, F.array_join(values, sep))


def concat_by_group(df: DataFrame, keys: Sequence[str], values: Mapping[str, str], sep: str = ",", distinct: bool = True) -> DataFrame:
    """Per group, each output's non-NULL values (SQL text) joined ascending by ``sep``, distinct or all; NULL when none.

    What ``distinct_concat`` and ``ordered_concat`` give, for groups of any number of values: those hold a group's
    values as one array in one task. Here
      1. a hash aggregate counts each (group, output, value), which spreads a hot group over its values;
      2. these are laid out by ranges of (group, output, value), so a hot group fills many ranges, in order;
      3. each range joins its part of a group's text, and the parts are joined in the order of the ranges.
    A task holds one range of values at a time, and only a group's finished text, which is one row of the result,
    comes together as a whole.
    """
    keys, outputs = list(keys), list(values)
    pairs = ", ".join(f"named_struct('o', {i}, 'v', CAST({v} AS STRING))" for i, v in enumerate(values.values()))
    # A group without any value keeps one row, of output -1.
    listed = f"concat(array(named_struct('o', -1, 'v', '')), filter(array({pairs}), p -> p.v IS NOT NULL))"
    by = [f"`{k}`" for k in keys]
    rows = df.selectExpr(*by, f"explode({listed}) AS __p").selectExpr(*by, "__p.o AS __o", "__p.v AS __v")
    counted = rows.groupBy(*keys, "__o", "__v").agg(F.count(F.lit(1)).alias("__n"))
    order = [*keys, "__o", "__v"]
    laid = counted.repartitionByRange(*order).select("*", F.spark_partition_id().alias("__part"))
    quoted = "'" + sep.replace("\\", "\\\\").replace("'", "\\'") + "'"
    sorted_ = "array_sort(collect_list(struct(__v, __n)))"
    joined = (f"array_join(transform({sorted_}, p -> p.__v), {quoted})" if distinct else
              f"array_join(flatten(transform({sorted_}, p -> array_repeat(p.__v, CAST(p.__n AS INT)))), {quoted})")
    fragments = laid.groupBy(*keys, "__o", "__part").agg(F.expr(f"{joined} AS __text"))
    texts = fragments.groupBy(*keys, "__o").agg(F.expr(
        f"array_join(transform(array_sort(collect_list(struct(__part, __text))), p -> p.__text), {quoted}) AS __text"))
    return texts.groupBy(*keys).agg(*[F.expr(f"max(CASE WHEN __o = {i} THEN __text END) AS `{o}`") for i, o in enumerate(outputs)])


def distinct_count_and_sums(df: DataFrame, keys: Sequence[str], distinct_col: str, count_name: str,
                            sums: Mapping[str, str]) -> DataFrame:
    """``count(DISTINCT distinct_col)`` plus ``sum(c)`` per output, grouped by ``keys``.

    Two plain aggregates instead of Spark's Expand-based distinct rewrite: first per
    (keys, distinct value) with partial sums, then per keys counting the non-NULL distinct values.
    The first level is keyed by the distinct value too, so a hot key spreads over many tasks.
    """
    keys = list(keys)
    first = df.groupBy(*keys, distinct_col).agg(
        *[F.sum(src).alias(f"__s_{out}") for out, src in sums.items()])
    return first.groupBy(*keys).agg(
        F.count(distinct_col).alias(count_name),
        *[F.sum(f"__s_{out}").alias(out) for out in sums])
