"""Country spelling -> code (B1) and country name-or-code -> sales region (B2)."""

from __future__ import annotations

from functools import lru_cache
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NOT_SET = "not_set"
DEFAULT_REGION = "ROW"

# Keys (names or codes) of each sales region, in the order the regions are tested.
# Anything else, and NULL, is ROW.
REGION_KEYS: dict[str, tuple[str, ...]] = {
    "UK": (
        "AI", "BM", "CUK", "FK", "GB", "GI", "IO", "MS", "SH", "TC", "UK",
        "Anguilla", "Bermuda", "United Kingdom", "Falkland Islands (Islas Malvinas)", "Great Britain",
        "Gibraltar", "British Indian Ocean Territory", "Montserrat", "St. Helena",
        "Turks & Caicos Islands", "Turks and Caicos Islands",
    ),
    "CA": ("CA", "Canada"),
    "AU": ("AU", "AUS", "Australia"),
    "US": (
        "AS", "CUS", "GU", "MP", "PR", "US", "VI",
        "American Samoa", "United States", "Guam", "Northern Mariana Islands", "Puerto Rico",
        "U.S. Virgin Islands",
    ),
    "EU": (
        "AD", "AL", "AM", "AT", "AX", "BA", "BE", "BG", "BY", "CH", "CY", "CZ", "DE", "DK", "EE", "ES",
        "EU", "FI", "FO", "FR", "GE", "GL", "GR", "HR", "HU", "IE", "IS", "IT", "LI", "LT", "LU", "LV",
        "MC", "MD", "ME", "MK", "MT", "NL", "NO", "PL", "PT", "RO", "RS", "RU", "SE", "SI", "SJ", "SK",
        "SM", "TR", "UA", "XK", "PM", "Europe",
        "Andorra", "Albania", "Armenia", "Austria", "Åland Islands", "Bosnia & Herzegovina", "Belgium",
        "Bulgaria", "Belarus", "Switzerland", "Cyprus", "Czech Republic", "Czechia", "Germany",
        "Denmark", "Estonia", "Spain", "European Union", "Finland", "Faroe Islands", "France",
        "Georgia", "Greenland", "Greece", "Croatia", "Hungary", "Ireland", "Iceland", "Italy",
        "Liechtenstein", "Lithuania", "Luxembourg", "Latvia", "Monaco", "Moldova", "Montenegro",
        "North Macedonia", "Malta", "Netherlands", "Norway", "Poland", "Portugal", "Romania", "Serbia",
        "Russia", "Sweden", "Slovenia", "Svalbard and Jan Mayen", "Svalbard & Jan Mayen", "Slovakia",
        "San Marino", "Turkey", "Türkiye", "Ukraine", "Kosovo", "St. Pierre & Miquelon",
    ),
}


def _sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def region_sql(column_sql: str) -> str:
    """The region CASE as SQL text over ``column_sql``."""
    arms = " ".join(f"WHEN {column_sql} IN ({', '.join(_sql_str(k) for k in keys)}) THEN '{region}'"
                    for region, keys in REGION_KEYS.items())
    return f"CASE {arms} ELSE '{DEFAULT_REGION}' END"


def region_of(c: Column | str) -> Column:
    """Region of a country name or code (NULL or unknown -> ROW).

    Each key list becomes a hash ``InSet`` test, so this is a per-row expression inside
    whole-stage codegen: no join, no shuffle. Given a column name, the CASE is built from SQL
    text in one call.
    """
    if isinstance(c, str):
        return F.expr(region_sql(f"`{c}`"))
    expr = None
    for region, keys in REGION_KEYS.items():
        cond = c.isin(*keys)
        expr = F.when(cond, F.lit(region)) if expr is None else expr.when(cond, F.lit(region))
    return expr.otherwise(F.lit(DEFAULT_REGION))


@lru_cache(maxsize=1)
def country_code_rows() -> tuple[tuple[str, str], ...]:
    """(spelling, code) pairs from the bundled table (read as plain text: ``NA`` stays Namibia)."""
    text = resources.files("admart.data").joinpath("country_codes.tsv").read_text(encoding="utf-8")
    rows = []
    for line in text.splitlines():
        if not line.strip() or line.startswith("#"):
            continue
        code, *names = line.split("\t")
        rows.extend((name, code) for name in names)
    return tuple(rows)


#: Largest lookup that is broadcast by hint; the bundled one has 305 rows.
BROADCAST_ROWS = 10_000


def country_code_table(spark: SparkSession,
                       mapping: tuple[tuple[str, str], ...] | None = None) -> DataFrame:
    """The spelling -> code dimension, a local relation shipped with the plan. Up to
    ``BROADCAST_ROWS`` rows it carries a broadcast hint; a larger ``mapping`` is left to Spark."""
    rows = mapping or country_code_rows()
    # A VALUES clause is a JVM LocalRelation: broadcast straight from the driver, without the
    # parallelized Python RDD (and its Python workers) that createDataFrame(list) would make.
    values = ", ".join(f"({_sql_str(n)}, {_sql_str(c)})" for n, c in rows)
    table = spark.sql(f"SELECT * FROM VALUES {values} AS t(_cc_name, _cc_code)")
    return F.broadcast(table) if len(rows) <= BROADCAST_ROWS else table


def with_country_code(df: DataFrame, col: str, out: str | None = None,
                      mapping: tuple[tuple[str, str], ...] | None = None) -> DataFrame:
    """Add (or replace) ``out`` with the code of ``col``; unknown or NULL -> ``'not_set'``.

    A broadcast hash join against the bundled lookup: O(1) per row, no shuffle of ``df``, and the
    spellings are unique so rows never multiply.
    """
    out = out or col
    lookup = country_code_table(df.sparkSession, mapping)
    joined = df.join(lookup, F.col(col) == F.col("_cc_name"), "left")
    code = F.coalesce(F.col("_cc_code"), F.lit(NOT_SET))
    return joined.withColumn(out, code).drop("_cc_name", "_cc_code")
