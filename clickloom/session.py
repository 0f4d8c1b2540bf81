"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cpus: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and measurements."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("clickloom")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path under the folder that every executor shares.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset and all work is
    done in this one process, as in tests, is a temporary folder set in its place.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root and context.master.split("[")[0] == "local":
        context.setCheckpointDir(tempfile.mkdtemp(prefix="clickloom-"))
        root = context.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return f"{root.rstrip('/')}/clickloom/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame) -> DataFrame:
    """The rows, computed once and kept in the shared folder, so that a lost executor does not take them along."""
    spark = frame.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(folder) if folder else shared_folder(spark, "stored")
    return frame.checkpoint()


def stateful_session(spark: SparkSession) -> SparkSession:
    """A sibling session whose streams keep state in RocksDB, as stateful processors need."""
    sibling = spark.newSession()
    # A stream keeps its number of state partitions for life, so it is the configured one.
    sibling.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    sibling.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    sibling.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return sibling
