"""A keyed table fed by numbered micro-batches, whose files stay in proportion to its rows.

Each batch adds one run of rows sorted by key. As soon as ``fan`` runs of one level have come
together, they become one run of the next level, in which only the newest row of each key is left.
So a table of n keys lies in at most ``fan - 1`` runs on each of about log(n) levels, however many
batches it has seen. A list of the runs that make up the table is kept for the last two batches:
a batch that is repeated starts from the list of the one before it and ends in the same state,
and runs that neither list names are removed.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.sources.sinks import BATCH, run_to_end


class Folder:
    """Small texts, listings and removals below a path of any file system that Spark can write."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path.rstrip("/")
        self.files = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str) -> list[str]:
        if not self.files.exists(self._at(name)):
            return []
        return sorted(s.getPath().getName() for s in self.files.listStatus(self._at(name)))

    def write(self, name: str, text: str) -> None:
        out = self.files.create(self._at(name), True)
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()

    def read(self, name: str) -> str | None:
        if not self.files.exists(self._at(name)):
            return None
        stream = self.files.open(self._at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def set_time(self, name: str, ms: int) -> None:
        """Set a file's time of change, by which streams take files in order."""
        self.files.setTimes(self._at(name), ms, -1)

    def remove(self, name: str) -> None:
        self.files.delete(self._at(name), True)


class CompactTable:
    """The newest row of each key. Batches are numbered from 0 without gaps, and only the last may be repeated."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema: T.StructType, fan: int = 4):
        self.spark, self.path, self.keys, self.schema, self.fan = spark, path.rstrip("/"), list(keys), schema, fan
        self.values = [n for n in schema.names if n not in self.keys]
        self.folder = Folder(spark, self.path)

    def put(self, rows: DataFrame | None, batch_id: int) -> None:
        """Insert or replace rows, one for each key; none if the batch changes nothing."""
        runs = self.runs(batch_id - 1)
        if rows is not None:
            self._write(rows.select(*self.schema.names, F.lit(batch_id).cast("bigint").alias(BATCH)), f"0-{batch_id}")
            runs = [*runs, f"0-{batch_id}"]
        level = 0
        while sum(_level(r) == level for r in runs) >= self.fan:
            merged = [r for r in runs if _level(r) == level]
            level += 1
            self._write(self._newest(self._read(merged), BATCH), f"{level}-{batch_id}")
            runs = [*(r for r in runs if r not in merged), f"{level}-{batch_id}"]
        self.folder.write(f"lists/{batch_id}", json.dumps(runs))
        self._remove_old(batch_id, runs)

    def _write(self, rows: DataFrame, name: str) -> None:
        rows.sortWithinPartitions(*self.keys).write.mode("overwrite").parquet(f"{self.path}/runs/{name}")

    def _remove_old(self, batch_id: int, runs: list[str]) -> None:
        """Lists before the last one, and runs that no list names (merged at once, or left by a lost attempt)."""
        for number in self.folder.names("lists"):
            if number.isdigit() and int(number) < batch_id - 1:
                self.folder.remove(f"lists/{number}")
        for run in set(self.folder.names("runs")) - {*runs, *self.runs(batch_id - 1)}:
            self.folder.remove(f"runs/{run}")

    def runs(self, batch_id: int | None = None) -> list[str]:
        """The runs that make up the table after a batch, by default the last one."""
        if batch_id is None:
            batch_id = max((int(n) for n in self.folder.names("lists") if n.isdigit()), default=-1)
        if batch_id < 0:
            return []
        text = self.folder.read(f"lists/{batch_id}")
        if text is None:
            raise ValueError(f"batch {batch_id} was never put, or is too long ago, in {self.path}")
        return json.loads(text)

    def _read(self, runs: Sequence[str]) -> DataFrame:
        schema = T.StructType([*self.schema, T.StructField(BATCH, T.LongType())])
        if not runs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/runs/{r}" for r in runs])

    def _newest(self, rows: DataFrame, *more: str) -> DataFrame:
        newest = F.max_by(F.struct(*self.values, BATCH), F.col(BATCH)).alias("_v")
        kept = rows.groupBy(*self.keys).agg(newest)
        return kept.select(*[F.col(n) if n in self.keys else F.col(f"_v.{n}") for n in (*self.schema.names, *more)])

    def table(self, batch_id: int | None = None, where: Column | None = None) -> DataFrame:
        """The rows after a batch; ``where``, on key columns, is pushed down to the sorted runs."""
        rows = self._read(self.runs(batch_id))
        return self._newest(rows if where is None else rows.where(where))

    def run(self, stream: DataFrame, checkpoint: str) -> DataFrame:
        """Feed the table with an updating stream until its sources are used up, and read it."""

        def write(batch: DataFrame, batch_id: int) -> None:
            self.put(batch, batch_id)

        writer = stream.writeStream.foreachBatch(write).outputMode("update")
        run_to_end(writer, checkpoint)
        return self.table()


def _level(run: str) -> int:
    return int(run.split("-")[0])
