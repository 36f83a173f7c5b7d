"""Sinks that survive failed writes, replace partitions, keep an order; the reject ledger."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from admart.sources import accepted, checked, ledger, ledger_counts, read_sorted, save_sorted, save_table
from admart.sources.schemas import SCHEMAS


def failing(spark):
    return spark.range(100).selectExpr("CASE WHEN id = 77 THEN raise_error('broken') ELSE id END AS x", "'a' AS y")


def values(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("touched", [False, True])
def test_a_failed_write_leaves_the_old_table(spark, tmp_path, touched):
    path, old = str(tmp_path / "t"), spark.createDataFrame([(1, "a"), (2, "b")], "x long, y string")
    save_table(old, path=path, partition_by=["y"])
    with pytest.raises(Exception, match="broken"):
        save_table(failing(spark), path=path, partition_by=["y"], touched_only=touched)
    assert values(spark.read.parquet(path).select("x", "y")) == [(1, "a"), (2, "b")]
    assert os.listdir(tmp_path) == ["t"]


def test_only_touched_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    save_table(spark.createDataFrame([(1, "a"), (2, "b")], "x long, y string"), path=path, partition_by=["y"], touched_only=True)
    save_table(spark.createDataFrame([(3, "b"), (4, "c")], "x long, y string"), path=path, partition_by=["y"], touched_only=True)
    assert values(spark.read.parquet(path).select("x", "y")) == [(1, "a"), (3, "b"), (4, "c")]
    save_table(spark.read.parquet(path).where("x > 3"), path=path, partition_by=["y"])  # reads what it replaces
    assert values(spark.read.parquet(path).select("x", "y")) == [(4, "c")]
    with pytest.raises(ValueError):
        save_table(spark.range(1), path=path, touched_only=True)
    with pytest.raises(ValueError):
        save_table(spark.range(1))


def test_catalog_tables_are_swapped(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS admart_swap")
    try:
        save_table(spark.createDataFrame([("a", 1), ("b", 2)], "y string, x long"), name="admart_swap", partition_by=["y"])
        with pytest.raises(Exception, match="broken"):
            save_table(failing(spark), name="admart_swap")
        assert values(spark.table("admart_swap").select("x", "y")) == [(1, "a"), (2, "b")]
        save_table(spark.createDataFrame([("b", 5)], "y string, x long"), name="admart_swap", partition_by=["y"], touched_only=True)
        assert values(spark.table("admart_swap").select("x", "y")) == [(1, "a"), (5, "b")]
        save_table(spark.table("admart_swap").where("x > 1"), name="admart_swap", partition_by=["y"])
        assert values(spark.table("admart_swap").select("x", "y")) == [(5, "b")]
        assert [t.name for t in spark.catalog.listTables() if t.name.startswith("admart_swap")] == ["admart_swap"]
    finally:
        spark.sql("DROP TABLE IF EXISTS admart_swap")


def test_sorted_table_keeps_its_order(spark, tmp_path):
    rows = [(i * 7 % 50, None if i % 9 == 0 else f"t{i % 5}") for i in range(300)] + [(None, "x"), (3, "t1"), (3, "t1")]
    df = spark.createDataFrame(rows, "d int, t string").repartition(6)
    save_sorted(df, str(tmp_path / "s"), [F.desc("d")])
    found = [tuple(r) for r in read_sorted(spark, str(tmp_path / "s")).orderBy("position").collect()]
    assert [p for p, _, _ in found] == list(range(1, len(rows) + 1))
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    assert [(d, t) for _, d, t in found] == want
    assert spark.read.parquet(str(tmp_path / "s")).select("__part").distinct().count() >= 1
    save_sorted(df.limit(0), str(tmp_path / "s"), ["d"])
    assert read_sorted(spark, str(tmp_path / "s")).collect() == []


SCHEMA = StructType([StructField("n", IntegerType()), StructField("s", StringType())])


def test_rejects_are_kept_apart_and_counted(spark):
    df = spark.createDataFrame([("1", "a", 0), ("x", "b", 1), (None, "c", 2), ("99999999999", None, 3), ("x", "d", 4)], "n string, s string, other int")
    rows = checked(df, SCHEMA)
    assert values(accepted(rows).select("s", "n")) == [("a", 1), ("c", None)]
    assert values(ledger(rows, ["s"]).where("s IS NOT NULL")) == [("b", "n", "x"), ("d", "n", "x")]
    assert values(ledger_counts(rows)) == [("n", 3, 2, "99999999999")]
    assert ledger_counts(checked(df.limit(0), SCHEMA)).collect() == []


def test_json_values_are_checked(spark):
    name = "source_daily_meta_ads"
    text = ['[{"action_type":"a","value":"1"}]', '[{"action_type":"a","value":"1"},{"action_type":"b","value":"x7"},{"value":"y"}]', None, "not json", '[{"value":null}]']
    df = spark.createDataFrame([(t, "2024-01-01") for t in text], "actions string, date_start string")
    raw = df.select(*[c if c in df.columns else F.lit(None).cast("string").alias(c) for c in SCHEMAS[name].fieldNames()])
    rows = checked(raw, name, json_values={"actions": "bigint"})
    assert values(ledger(rows)) == [("actions.value", "x7")]
    assert accepted(rows).count() == 4 and accepted(rows).select("date_start").distinct().collect()[0][0] == dt.date(2024, 1, 1)
