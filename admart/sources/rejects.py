"""Reject ledger: rows whose values don't fit their declared types.

``conform`` fails on the first value that can't be cast, as the warehouse does. ``checked`` casts what it can and says,
next to each row, which columns it could not; ``accepted`` and ``ledger`` part the two from one lazy plan, and
nothing is dropped without an entry.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from admart.functions.json_metrics import json_array
from admart.sources.schemas import SCHEMAS

REJECTED = "__rejected"


def checked(df: DataFrame, source: str | StructType, json_values: dict[str, str] | None = None) -> DataFrame:
    """The declared columns of ``source``, NULL where a value doesn't fit, and ``__rejected``: the columns and texts that
    didn't fit (NULL texts always fit). ``json_values`` names columns of JSON arrays and the type each entry's
    ``value`` must have; such a column is rejected as a whole, with the first text that isn't one."""
    schema = SCHEMAS[source] if isinstance(source, str) else source
    casts, faults = [], []
    for f in schema.fields:
        kind = f.dataType.simpleString()
        casts.append(f"try_cast(`{f.name}` AS {kind}) AS `{f.name}`")
        faults.append(f"CASE WHEN `{f.name}` IS NOT NULL AND try_cast(`{f.name}` AS {kind}) IS NULL "
                      f"THEN struct('{f.name}' AS column, CAST(`{f.name}` AS STRING) AS value) END")
    out = df.selectExpr(*casts, f"array_compact(array({', '.join(faults)})) AS {REJECTED}")
    for name, kind in (json_values or {}).items():
        wrong = F.filter(json_array(F.col(name), "array<struct<value:string>>"),
                         lambda e: e["value"].isNotNull() & e["value"].try_cast(kind).isNull())
        entry = F.when(F.size(wrong) > 0, F.array(F.struct(F.lit(f"{name}.value").alias("column"), wrong[0]["value"].alias("value"))))
        out = out.withColumn(REJECTED, F.concat(REJECTED, F.coalesce(entry, F.array().cast("array<struct<column:string,value:string>>"))))
        out = out.withColumn(name, F.when(F.coalesce(F.size(wrong), F.lit(0)) <= 0, F.col(name)))
    return out


def accepted(rows: DataFrame) -> DataFrame:
    """Rows of ``checked`` that fit in every column."""
    return rows.where(F.size(REJECTED) == 0).drop(REJECTED)


def ledger(rows: DataFrame, keep: list[str] = ()) -> DataFrame:
    """An entry per value that didn't fit: the columns of ``keep``, column and value."""
    return rows.select(*keep, F.explode(REJECTED).alias("r")).select(*keep, "r.column", "r.value")


def ledger_counts(rows: DataFrame) -> DataFrame:
    """Per column: how many values didn't fit, how many different ones, and the least of them. Two aggregates, so a
    column that is bad in every row meets in no one task before its values are counted."""
    values = ledger(rows).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return values.groupBy("column").agg(F.sum("n").alias("n_rejected"), F.count(F.lit(1)).alias("n_values"), F.min("value").alias("least_value"))
