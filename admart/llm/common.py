"""Helpers shared by the operators: memos, columns, tables in the shared folder."""

from __future__ import annotations

import ctypes
import gc
import pickle
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What parts words, in Spark's regular expressions: the space and the control characters 9 to 13. In tasks,
#: bytes.split() parts UTF-8 text at exactly these.
GAP_JVM = r"[\x20\x09-\x0D]+"
#: Rows and bytes of an Arrow batch while a step is written. Bytes bound what long texts take at once, in the JVM
#: and in the worker; a single longer text still goes through as a batch of its own.
BATCH, BATCH_BYTES = 2000, 4 << 20


class Memo(dict):
    """``make`` by key, for the keys met lately: at most ``2 * limit`` of up to ``chars`` characters.

    Looked up by ``memo[key]`` alone. When ``limit`` keys are new, they become the older half and the
    half before them goes; what is asked for again moves up, so frequent keys stay.
    """

    def __init__(self, make: Callable, limit: int, chars: int):
        super().__init__()
        self.make, self.limit, self.chars, self.older = make, limit, chars, {}

    def __missing__(self, key: str):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.chars:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


_KEPT: dict[tuple, object] = {}


def kept(key: tuple, make: Callable):
    """This Python worker's ``make()`` of ``key``, kept from task to task; one at a time, so that a worker that
    serves several operators doesn't hold the models and memos of all."""
    if key not in _KEPT:
        _KEPT.clear()
        give_back()
        _KEPT[key] = make()
    return _KEPT[key]


def give_back() -> None:
    """Hand this worker's free memory back to the system. Workers outlive a stage, and what one stage freed but
    still holds would add to what the next one needs."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def lean(step: Callable) -> Callable:
    """``step`` for mapInArrow in a worker that holds no model: those of earlier stages go first, and what the
    task freed is handed back after it."""
    def run(batches: Iterator) -> Iterator:
        kept((), tuple)
        try:
            yield from step(batches)
        finally:
            give_back()

    return run


def doc_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under fixed names and types."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def shared_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a scratch folder only where that is unset and
    everything runs in one JVM (tests)."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc._jsc.sc().isLocal():  # local-cluster is not local
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="admart-shared-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/admart-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return a scan of it.

    The table survives lost executors and cuts the lineage. Shuffle files of the finished write are
    released at once (a retry of a lost stage regenerates them), so a job of several steps holds the
    shuffles of one step at a time. Texts go to Python ``BATCH`` rows at a time meanwhile.
    """
    spark, path = df.sparkSession, new_folder(df.sparkSession, name)
    own = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH),
           "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}
    before = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` that no later step reads."""
    for table in tables:
        jvm = table.sparkSession.sparkContext._jvm
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def gather(df: DataFrame, fold: Callable, merge: Callable, fan: int = 16):
    """One value from all rows: ``fold`` makes one of each partition's Arrow batches (or None), ``merge`` one of a
    list of those. Merged in ``fan`` tasks first, so at most ``fan`` values reach the driver. None without rows."""
    def carry(value) -> list:
        return [] if value is None else [pa.RecordBatch.from_arrays([pa.array([pickle.dumps(value)], pa.binary())], ["value"])]

    def first(batches):
        yield from carry(fold(batches))

    def second(batches):
        found = [pickle.loads(v.as_py()) for b in batches for v in b.column(0)]
        yield from carry(merge(found) if found else None)

    rows = df.mapInArrow(first, "value binary").repartition(fan).mapInArrow(second, "value binary").collect()
    found = [pickle.loads(r["value"]) for r in rows]
    return merge(found) if found else None
