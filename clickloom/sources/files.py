"""Delimited text and parquet, as tables or replayed as streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.time import with_event_time
from clickloom.schemas import ORDER_EVENT, RECEIPT_EVENT
from clickloom.sources.tables import Folder


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def replay(
    spark: SparkSession, folder: str, name: str, schema: T.StructType, files_per_trigger: int | None = 1
) -> DataFrame:
    """A parquet table as a stream that takes at most some files per micro-batch, or all in one.

    The braces make the path a pattern, which matches a single file as well as a folder.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(f"{folder}/{{{name}}}.parquet")


def staged_replay(
    rows: DataFrame, batch: Column, order: Column, closing: DataFrame, path: str, files: int = 2
) -> DataFrame:
    """Rows written once below ``path``, ``files`` files for each value of ``batch``, then ``closing``, and streamed batch by batch.

    A micro-batch is the files of one value, each sorted by ``order``. The source takes files in the
    order of their times, which are set by batch; a batch of few rows is filled up with empty files.
    """
    spark = rows.sparkSession
    staged = rows.withColumn("_batch", batch).repartition(files).sortWithinPartitions("_batch", order)
    staged.write.partitionBy("_batch").parquet(path)
    folder = Folder(spark, path)
    numbers = sorted(int(n.split("=")[1]) for n in folder.names("") if n.startswith("_batch="))
    closing.coalesce(1).write.parquet(f"{path}/_batch={numbers[-1] + 1}")
    for place, number in enumerate([*numbers, numbers[-1] + 1]):
        name = f"_batch={number}"
        for _ in range(files - len(_data_files(folder, name))):
            closing.limit(0).coalesce(1).write.mode("append").parquet(f"{path}/{name}")
        for file in _data_files(folder, name):
            folder.set_time(f"{name}/{file}", 1_000_000_000_000 + 60_000 * place)
    reader = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files)
    return reader.parquet(f"{path}/*")


def _data_files(folder: Folder, name: str) -> list[str]:
    return [n for n in folder.names(name) if n.startswith("part-")]


def delimited(
    spark: SparkSession, path: str, schema: T.StructType, streaming: bool = False
) -> DataFrame:
    """Comma-separated rows without a header, in a fixed schema, with event time."""
    reader = spark.readStream if streaming else spark.read
    return with_event_time(reader.schema(schema).csv(path))


def order_events(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Order events. A create has no transaction: the reader gives null, the events carry ''."""
    rows = delimited(spark, path, ORDER_EVENT, streaming)
    return rows.withColumn("tx_id", F.coalesce("tx_id", F.lit("")))


def receipt_events(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Receipt events of the payment channels."""
    return delimited(spark, path, RECEIPT_EVENT, streaming)


def with_file_order(df: DataFrame, out: str = "seq") -> DataFrame:
    """Number rows by their place in the input: file by file, line by line.

    Ids grow with the partition and with the row in it; they have gaps but keep the order
    within a file, which is all that a tie-break needs.
    """
    return df.withColumn(out, F.monotonically_increasing_id())


def split_line(df: DataFrame, schema: T.StructType, line: str = "value") -> DataFrame:
    """Parse comma-separated lines by position; a field that does not convert is null."""
    parts = F.split(F.col(line), ",")
    fields = [
        F.trim(F.get(parts, F.lit(i))).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema)
    ]
    return df.select(*fields)
