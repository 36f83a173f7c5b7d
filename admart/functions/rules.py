"""Ordered rule chains: CASE WHEN ... first match wins.

Rules are written once, over Columns or over ``Sql`` texts. A chain of ``Sql`` reaches the JVM as one expression,
where Columns take a call for every operator; plans of hundreds of rules are built many times faster so.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal(v) -> str:
    """A value as SQL text."""
    if isinstance(v, Sql):
        return str(v)
    if v is None or isinstance(v, bool | int | float):
        return {None: "NULL", True: "true", False: "false"}[v] if v is None or isinstance(v, bool) else repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


class Sql(str):
    """Text of a SQL expression, with the operators of Column that rules use. Dates in ``between`` are given as texts."""

    def like(self, pattern: str) -> Sql:
        return Sql(f"({self} LIKE {literal(pattern)})")

    def rlike(self, pattern: str) -> Sql:
        return Sql(f"({self} RLIKE {literal(pattern)})")

    def isin(self, *values) -> Sql:
        return Sql(f"({self} IN ({', '.join(map(literal, values))}))")

    def between(self, low, high) -> Sql:
        return Sql(f"({self} BETWEEN {literal(low)} AND {literal(high)})")

    def isNull(self) -> Sql:
        return Sql(f"({self} IS NULL)")

    def isNotNull(self) -> Sql:
        return Sql(f"({self} IS NOT NULL)")

    def __eq__(self, other) -> Sql:  # type: ignore[override]
        return Sql(f"({self} = {literal(other)})")

    def __ne__(self, other) -> Sql:  # type: ignore[override]
        return Sql(f"({self} <> {literal(other)})")

    def __and__(self, other: Sql) -> Sql:
        return Sql(f"({self} AND {other})")

    def __or__(self, other: Sql) -> Sql:
        return Sql(f"({self} OR {other})")

    def __invert__(self) -> Sql:
        return Sql(f"(NOT {self})")

    __hash__ = str.__hash__

    def alias(self, name: str) -> Column:
        return F.expr(f"{self} AS `{name}`")

    def column(self) -> Column:
        return F.expr(str(self))


def name(c: str) -> Sql:
    """A column, as ``Sql``."""
    return Sql(f"`{c}`")


def call(function: str, *args: Column | Sql | str | int) -> Column | Sql:
    """A SQL function of Columns or of ``Sql`` (plain values are literals)."""
    if any(isinstance(a, Column) for a in args):
        return F.call_function(function, *[a if isinstance(a, Column) else F.lit(a) for a in args])
    return Sql(f"{function}({', '.join(map(literal, args))})")


def like_any(c: Column | Sql, *patterns: str) -> Column | Sql:
    """``c LIKE p1 OR c LIKE p2 ...`` (SQL LIKE: ``_`` is a one-character wildcard)."""
    return reduce(lambda a, b: a | b, [c.like(p) for p in patterns])


def like_none(c: Column | Sql, *patterns: str) -> Column | Sql:
    """``c NOT LIKE p1 AND c NOT LIKE p2 ...`` (NULL stays NULL, as in SQL)."""
    return reduce(lambda a, b: a & b, [~c.like(p) for p in patterns])


def first_match(rules: Sequence[tuple], default=None) -> Column | Sql:
    """First rule whose condition is TRUE gives the value; NULL conditions fall through. ``Sql`` where all conditions are."""
    if all(isinstance(cond, Sql) for cond, _ in rules):
        arms = " ".join(f"WHEN {cond} THEN {literal(value)}" for cond, value in rules)
        return Sql(f"CASE {arms} ELSE {literal(default)} END")

    def lit(v):
        return v if isinstance(v, Column) else v.column() if isinstance(v, Sql) else F.lit(v)
    expr = None
    for cond, value in rules:
        expr = F.when(lit(cond), lit(value)) if expr is None else expr.when(lit(cond), lit(value))
    return expr.otherwise(lit(default)) if default is not None else expr
