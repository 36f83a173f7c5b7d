"""Metrics held in JSON-array text columns, e.g. ``[{"action_type": "x", "value": "3"}, ...]``.

Parsed in-row with ``from_json`` + higher-order functions: no explode, no join, no Python. A value
that is no number of the wanted type fails the query, as a cast does in the warehouse; it is never
dropped in silence.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ACTION_SCHEMA = "array<struct<action_type:string,value:string>>"


def json_array(c: Column, schema: str = ACTION_SCHEMA) -> Column:
    """Parsed array, NULL unless the text is a JSON array (a bare object is not one; bad JSON and
    NULL give NULL)."""
    return F.when(c.rlike(r"^\s*\["), F.from_json(c, schema))


def number(c: Column, dtype: str) -> Column:
    """``c`` as ``dtype``; raises where the text is not NULL and no such number, in any ANSI mode."""
    made = c.try_cast(dtype)
    wrong = F.raise_error(F.concat(F.lit(f"not a {dtype}: "), c)).cast(dtype)
    return F.when(c.isNull() | made.isNotNull(), made).otherwise(wrong)


def array_metric_max(arr: Column, action_type: str, dtype: str = "bigint") -> Column:
    """Largest ``value`` among parsed entries of ``action_type``; NULL when there is none."""
    entries = F.filter(arr, lambda e: e["action_type"] == F.lit(action_type))
    return F.array_max(F.transform(entries, lambda e: number(e["value"], dtype)))


def _total(texts: Column, dtype: str) -> Column:
    values = F.filter(F.transform(texts, lambda x: number(x, dtype)), lambda v: v.isNotNull())
    total = F.aggregate(values, F.lit(0).cast(dtype), lambda acc, v: acc + v)
    return F.when(F.size(values) > 0, total)


def array_metric_sum(arr: Column, field: str = "value", dtype: str = "bigint") -> Column:
    """Sum of ``field`` over parsed entries; NULL when the array is NULL, empty or all-NULL."""
    return _total(F.transform(arr, lambda e: e[field]), dtype)


def json_metric_max(c: Column, action_type: str, dtype: str = "bigint") -> Column:
    """Largest ``value`` among entries of ``action_type`` in JSON text; NULL when there is none.

    To read several metrics from one column, parse it once with ``json_array`` into a column
    and use ``array_metric_max`` on that column (the parse is the expensive part)."""
    return array_metric_max(json_array(c), action_type, dtype)


def json_metric_sum(c: Column, path: str = "$.value", dtype: str = "bigint") -> Column:
    """Sum of what stands at the JSON ``path`` of each entry of JSON text (a bare name is a top-level
    field); NULL when NULL, empty or all-NULL."""
    path = path if path.startswith("$") else f"$.{path}"
    entries = json_array(c, "array<string>")
    return _total(F.transform(entries, lambda e: F.get_json_object(e, path)), dtype)
