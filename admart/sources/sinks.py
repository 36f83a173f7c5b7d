"""Model sinks: a view (lazy), a table that is refreshed as a whole or by partition, and a table in a real order."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def as_view(df: DataFrame, name: str, order_by: list | None = None) -> DataFrame:
    """View sink: register the lazy plan under ``name``; nothing is computed. ``order_by`` is the
    final sort of the view, applied here and not inside the models."""
    df = df.orderBy(*order_by) if order_by else df
    df.createOrReplaceTempView(name)
    return df


def save_table(df: DataFrame, name: str | None = None, path: str | None = None,
               partition_by: list[str] | None = None, fmt: str = "parquet", touched_only: bool = False) -> None:
    """Table sink. Give a catalog ``name`` or a ``path``. A write that fails leaves the old table as it was.

    The whole table is written beside the old one first and takes its place when it is complete, so ``df`` may read
    the table it refreshes. With ``touched_only`` the partitions that ``df`` has rows for are replaced and the others
    stay (Spark stages those too, and swaps them in when the job commits); it needs ``partition_by`` and takes
    effect only where the table is there already.

    Marts keyed by date are best partitioned by ``month`` so readers prune by period.
    """
    if (name is None) == (path is None):
        raise ValueError("save_table needs a table name or a path")
    if touched_only and not partition_by:
        raise ValueError("only partitions can be replaced one by one")
    spark = df.sparkSession
    there = spark.catalog.tableExists(name) if name is not None else exists(spark, path)
    if touched_only and there:
        writer = df.write.mode("overwrite").format(fmt).option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
        writer.save(path if name is None else _location(spark, name))
        if name is not None:
            spark.catalog.recoverPartitions(name)
            spark.catalog.refreshTable(name)
        return
    writer = df.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    beside = f"__{uuid.uuid4().hex}"
    if name is not None:
        _swap_table(spark, writer, name, partition_by, fmt, there)
    else:
        _swap_folder(spark, writer, path.rstrip("/"), path.rstrip("/") + beside, there)


def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _file_system(spark, path)
    return fs.exists(at)


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, at = _file_system(spark, source)
    if not fs.rename(at, _file_system(spark, target)[1]):
        raise OSError(f"could not rename {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def _swap_folder(spark: SparkSession, writer, path: str, staged: str, there: bool) -> None:
    old = staged + "_old"
    try:
        writer.save(staged)
        if there:
            move(spark, path, old)
        try:
            move(spark, staged, path)
        except Exception:
            if there:
                move(spark, old, path)
            raise
    finally:
        remove(spark, staged)
    if there:
        remove(spark, old)


def _swap_table(spark: SparkSession, writer, name: str, partition_by: list[str] | None, fmt: str, there: bool) -> None:
    """The new data goes to a folder of its own in the warehouse; once complete, the name is given to it. (A rename of
    the table would leave the places of its partitions behind.)"""
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name.replace('.', '/')}__{uuid.uuid4().hex}"
    try:
        writer.save(folder)
    except Exception:
        remove(spark, folder)
        raise
    old = _location(spark, name) if there else None
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=folder, source=fmt)
    if partition_by:
        spark.catalog.recoverPartitions(name)
    if old:
        remove(spark, old)


def _location(spark: SparkSession, name: str) -> str | None:
    rows = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


PART, PLACE = "__part", "__place"


def save_sorted(df: DataFrame, path: str, order_by: list[Column | str]) -> None:
    """Sink of a table whose order is real: laid out by ranges of ``order_by`` and sorted inside them, so that no
    task holds more than one range, and each row keeps its range and its place there. Rows that tie are ordered by
    the remaining columns, ascending; repeated rows are alike in any order. Staged like ``save_table``.
    """
    spark, order = df.sparkSession, [*order_by, *df.columns]
    laid = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = laid.select("*", F.spark_partition_id().alias(PART),
                         F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias(PLACE))
    path = path.rstrip("/")
    _swap_folder(spark, placed.write, path, f"{path}__{uuid.uuid4().hex}", exists(spark, path))


def read_sorted(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """A table of ``save_sorted`` with each row's ``position`` in it, from 1: the sizes of the ranges before its own
    (one row a range meets in one task, and is broadcast) and its place there."""
    rows = spark.read.parquet(path)
    sizes = rows.groupBy(PART).agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select(PART, (F.sum("n").over(Window.orderBy(PART)) - F.col("n")).alias("before"))
    kept = [c for c in rows.columns if c not in (PART, PLACE)]
    return rows.join(F.broadcast(before), PART).select((F.col("before") + F.col(PLACE) + 1).alias(position), *kept)
