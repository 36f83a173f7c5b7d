"""SparkSession construction and the folder that its executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every run wants: AQE re-plans joins from runtime sizes (this is the size check behind
# every non-forced broadcast), coalesces small shuffle partitions and splits skewed ones.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "admart",
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; on a cluster use the cluster's own session."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, which driver and executors share. A scratch folder
    stands in only where the setting is missing and everything runs in one JVM, as in tests."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not sc._jsc.sc().isLocal():  # local-cluster isn't local
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="admart-shared-")
    sc.setCheckpointDir(root)
    return root
