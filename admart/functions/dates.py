"""Date helpers: month buckets, trailing windows and the data-freshness date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_start(c: Column | str) -> Column:
    """First day of the month as a DATE (Spark's ``date_trunc`` would give a TIMESTAMP)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trunc(c, "MM")


def in_trailing_days(date_col: Column | str, as_of: dt.date, days: int) -> Column:
    """``date >= as_of - days`` (inclusive lower bound, no upper bound)."""
    date_col = F.col(date_col) if isinstance(date_col, str) else date_col
    return date_col >= F.date_sub(F.lit(as_of), days)


def latest_date(df: DataFrame, col: str, kind: str) -> DataFrame:
    """One-row DataFrame ``latest_date``: the freshest date in ``col`` of type DATE, TIMESTAMP or
    INTEGER (epoch seconds). A distributed max; nothing is pulled to the driver."""
    k = kind.upper()
    m = F.max(F.col(col))
    if k == "DATE":
        expr = m.cast("date")
    elif k == "TIMESTAMP":
        expr = F.to_date(m)
    elif k == "INTEGER":
        expr = F.to_date(F.timestamp_seconds(m))
    else:
        raise ValueError(f"Invalid timestamp type. Expected: DATE, TIMESTAMP, INTEGER. Got: {kind}")
    return df.agg(expr.alias("latest_date"))
