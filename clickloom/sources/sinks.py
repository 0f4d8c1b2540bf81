"""Where streams end: labelled console, files, an upsert log, one sink per outcome."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from clickloom.session import shared_folder

BATCH = "_batch"


def console(df: DataFrame, label: str | None = None, mode: str = "append") -> DataStreamWriter:
    """Print a stream, under a label if given."""
    writer = df.writeStream.format("console").outputMode(mode).option("truncate", "false")
    return writer.queryName(label) if label else writer


def run_to_end(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process all that the sources hold now, batch by batch, then stop."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def run_every(writer: DataStreamWriter, checkpoint: str, every: timedelta) -> StreamingQuery:
    """Start a stream that takes what has come, again and again, until it is stopped."""
    trigger = f"{every // timedelta(milliseconds=1)} milliseconds"
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=trigger).start()


def append_files(stream: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """Run an appending stream to its end into parquet in the shared folder, and read that."""
    folder = shared_folder(spark, name)
    rows, schema = f"{folder}/rows", stream.schema
    run_to_end(
        stream.writeStream.format("parquet").outputMode("append").option("path", rows),
        f"{folder}/checkpoint",
    )
    return spark.read.schema(schema).parquet(rows)


def each_batch(
    stream: DataFrame,
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    transform: Callable[[DataFrame], DataFrame],
    mode: str = "append",
) -> DataFrame:
    """Apply a batch-only operator to what each micro-batch emits; run to the end and read the result.

    Each batch overwrites its own folder, so a repeated batch changes nothing.
    """
    folder = shared_folder(spark, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{folder}/rows/{BATCH}={batch_id}")

    run_to_end(stream.writeStream.foreachBatch(write).outputMode(mode), f"{folder}/checkpoint")
    return spark.read.schema(schema).parquet(f"{folder}/rows").select(*schema.names)


class UpsertLog:
    """A keyed table fed by an updating stream.

    Each micro-batch appends its changed rows under its batch number; the table is the
    newest row per key. A repeated batch overwrites itself.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema: T.StructType):
        self.spark, self.path, self.keys, self.schema = spark, path, list(keys), schema

    def write(self, batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*self.schema.names)
        rows.write.mode("overwrite").parquet(f"{self.path}/{BATCH}={batch_id}")

    def history(self) -> DataFrame:
        """All row versions with their batch number."""
        fields = T.StructType([*self.schema, T.StructField(BATCH, T.LongType())])
        return self.spark.read.schema(fields).parquet(self.path)

    def table(self) -> DataFrame:
        """The newest version of each row."""
        values = [c for c in self.schema.names if c not in self.keys]
        newest = F.max_by(F.struct(*values), F.col(BATCH)).alias("_v")
        return self.history().groupBy(*self.keys).agg(newest).select(*self.keys, "_v.*")

    def run(self, stream: DataFrame, checkpoint: str) -> DataFrame:
        """Run an updating stream to its end and read the table."""
        run_to_end(stream.writeStream.foreachBatch(self.write).outputMode("update"), checkpoint)
        return self.table()


def by_outcome(
    folder: str, tags: Sequence[str], column: str = "outcome"
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes the rows of each tag to a folder of its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.where(F.col(column).isin(*tags))
        rows.write.mode("overwrite").partitionBy(column).parquet(f"{folder}/{BATCH}={batch_id}")

    return write
