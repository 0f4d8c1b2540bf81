"""Intermediate tables, written once to the folder that all executors share."""

from __future__ import annotations

import gc
import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


BATCH_BYTES = 8 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset on a local master, one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="clickloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(frame: DataFrame) -> DataFrame:
    """Write the rows once, replicated by the shared folder's file system, and go on from there.

    A lost executor does not take them with it, and Spark's cleaner may remove them when the
    frame is no longer referenced.
    """
    spark = frame.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(spark))
    return frame.checkpoint(eager=True)


_tables = threading.local()


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """The files of tables that this thread writes inside go at the end: what is read later must be stored anew by then."""
    outer, _tables.paths = getattr(_tables, "paths", None), []
    try:
        yield
    finally:
        made, _tables.paths = _tables.paths, outer
        for path in made:
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def _new(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark).rstrip('/')}/{name}"
    if getattr(_tables, "paths", None) is not None:
        _tables.paths.append(path)
    return path


def let_go(spark: SparkSession) -> None:
    """Shuffle files and checkpoints that nothing refers to any more go now, not when the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def written(frame: DataFrame) -> DataFrame:
    """As ``stored``, in a Parquet table, whose size the plans that follow know."""
    spark = frame.sparkSession
    path = _new(spark, f"table-{uuid.uuid4().hex}")
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def bucketed(frame: DataFrame, key: str) -> tuple[str, DataFrame]:
    """The name of a table of the rows, dealt out by ``key`` once, and the table: joins on ``key`` only move the other side.

    Its files lie in the shared folder; who made it drops it, and ``passing`` the files.
    """
    spark = frame.sparkSession
    name, n = f"bucketed_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = _new(spark, name)
    frame.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(name)
    return name, spark.table(name)


def small_batches(frame: DataFrame, rows: int = 1000) -> DataFrame:
    """The frame, in a session that hands Python at most ``rows`` texts at a time, about eight megabytes of them."""
    conf, name = frame.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= rows:
        conf.set(name, str(rows))
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", conf.get(name).lower()).groups()
    if int(number) << 10 * " kmgtp".index(unit or " ") > BATCH_BYTES:
        conf.set(name, f"{BATCH_BYTES}b")
    return frame


def unused(frame: DataFrame, name: str) -> str:
    """A column name that the frame does not have, made from ``name``."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name
