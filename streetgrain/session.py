"""Session settings and the shared scratch location."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings that every job of this package relies on. Join sides are
# broadcast by Catalyst / AQE only, from measured sizes; there are no hints.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Conform projections can grow large. A generated method above 8000 bytes is
    # never compiled by the JVM; below the limit Spark generates the operator by
    # itself instead, split into small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Many folders are listed by so many tasks instead of one each: the driver
    # keeps a record of every task.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "200",
    # A read holds the list of its files; Spark would keep those of earlier reads too.
    "spark.sql.hive.filesourcePartitionFileCacheSize": "0",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and benchmarks, local to one host."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("streetgrain")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, a
    temporary folder is made and recorded if the session is local, as in tests;
    on a cluster it is an error, since executors couldn't see such a folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="streetgrain-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from a table written below the shared folder.

    For a result that several branches of one job read: it is computed once and
    outlives the loss of executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_by(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """The same for a result that is grouped by ``key`` more than once: a bucketed table, so no reader shuffles it."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, key).option("path", scratch_path(spark, name)).saveAsTable(table)
    return spark.table(table)
