"""String helpers with the warehouse's NULL and JSON conventions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def regexp_extract_or_null(c: Column, pattern: str, idx: int = 1) -> Column:
    """Group ``idx`` of the first match, NULL when there is no match (Spark returns '')."""
    return F.nullif(F.regexp_extract(c, pattern, idx), F.lit(""))


def trim_ws(c: Column) -> Column:
    """Trim all leading/trailing white space, in Unicode's sense (Spark's ``trim`` removes spaces only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def json_string(c: Column) -> Column:
    """JSON text of an array value; NULL becomes the text ``null``."""
    return F.coalesce(F.to_json(c), F.lit("null"))


def json_quote(c: Column) -> Column:
    """JSON text of a scalar string, as Spark's JSON writer escapes it; NULL becomes the text ``null``."""
    listed = F.to_json(F.array(c), {"ignoreNullFields": "false"})
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def strip_quotes(c: Column) -> Column:
    return F.replace(c, F.lit('"'), F.lit(""))
