"""Period roll-ups: one row per month plus one per named period that contains it, in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from admart.config import Period


def period_labels(month: Column | str, periods: Sequence[Period]) -> Column:
    """Array of the labels a month row belongs to: its own month (``yyyy-MM-dd`` text, NULL
    for a NULL month) followed by every named period whose bounds contain it."""
    month = F.col(month) if isinstance(month, str) else month
    named = [F.when(month.between(F.lit(p.first_month), F.lit(p.last_month)), F.lit(p.label))
             for p in periods]
    own = F.array(month.cast("string"))
    return F.concat(own, F.array_compact(F.array(*named))) if named else own


def period_rollup(df: DataFrame, month: str, periods: Sequence[Period], keys: Sequence[str],
                  aggs: Sequence[Column], period_col: str = "period") -> DataFrame:
    """Equivalent of ``UNION ALL`` of one aggregate per named period and one per month, computed
    as explode-to-labels + a single aggregate (one scan, one shuffle).

    Re-count mode: pass row-level input and distinct counts in ``aggs`` (each period recounts).
    Sum mode: pass a monthly aggregate and ``sum`` in ``aggs`` (period = sum of its months).
    """
    exploded = df.withColumn(period_col, F.explode(period_labels(month, periods)))
    return exploded.groupBy(period_col, *keys).agg(*aggs)
