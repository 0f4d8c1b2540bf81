"""The analyses as streams. Inputs are watermarked streaming frames; results are read back
from what the streams wrote, once their sources are used up.

Windows that the last watermark has not closed stay open, as they would in a running stream;
the registered replays end with a far-off row that closes them.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.hashing import poly_hash
from clickloom.functions.time import TS_MS, millis
from clickloom.operators import lateness
from clickloom.operators.hotkeys import position
from clickloom.operators.topn import top_n
from clickloom.operators.windows import WINDOW, WINDOW_END, time_window, window_end
from clickloom.session import shared_folder
from clickloom.sources.sinks import BATCH, each_batch, run_to_end
from clickloom.sources.tables import CompactTable


def rank_closed_windows(
    counts: DataFrame, spark: SparkSession, name: str, n: int, key: str
) -> DataFrame:
    """Rank the windows of an appending stream of window counts.

    Append mode emits all counts of a window in the micro-batch that closes it, so ranking
    within the batch is exact, and it is the distributed batch ranking.
    """
    fields = [counts.schema[key], counts.schema[WINDOW_END], counts.schema["cnt"]]
    schema = T.StructType([*fields, T.StructField("row_num", T.LongType())])
    rows = counts.select(key, WINDOW_END, "cnt")
    return each_batch(rows, spark, name, schema, lambda batch: top_n(batch, n, key))


def rank_updated_windows(
    counts: DataFrame, spark: SparkSession, name: str, n: int, key: str
) -> DataFrame:
    """Rank from the newest counts: a late row within the watermark updates its windows again."""
    rows = counts.select(key, WINDOW_END, "cnt")
    folder = shared_folder(spark, name)
    table = CompactTable(spark, f"{folder}/table", [WINDOW_END, key], rows.schema)
    return top_n(table.run(rows, f"{folder}/checkpoint"), n, key)


def visitors_updating(
    behavior: DataFrame, spark: SparkSession, size: timedelta, visitor: str = "user_id"
) -> DataFrame:
    """Visitors per window by hashed bitmap, updated as rows come.

    The table holds the newest bitmap of each (window, bucket); a window's count is read from it.
    """
    parts = _visitor_bitmaps(behavior, size, visitor)
    rows = parts.select(window_end().alias(WINDOW_END), "_bucket", "_bits")
    folder = shared_folder(spark, "visitors")
    table = CompactTable(spark, f"{folder}/table", [WINDOW_END, "_bucket"], rows.schema)
    newest = table.run(rows, f"{folder}/checkpoint")
    return newest.groupBy(WINDOW_END).agg(F.sum(F.bitmap_count("_bits")).alias("uv"))


def _visitor_bitmaps(behavior: DataFrame, size: timedelta, visitor: str) -> DataFrame:
    offset = F.col("_offset")
    rows = behavior.withColumn("_offset", poly_hash(F.col(visitor).cast("string")))
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(offset))
    window = time_window(size).alias(WINDOW)
    return rows.groupBy(window, F.bitmap_bucket_number(offset).alias("_bucket")).agg(bits.alias("_bits"))


def visitors_bitmap(behavior: DataFrame, size: timedelta, visitor: str = "user_id") -> DataFrame:
    """Visitors per closed window by hashed bitmap, in two chained aggregations."""
    parts = _visitor_bitmaps(behavior, size, visitor)
    counts = parts.groupBy(WINDOW).agg(F.sum(F.bitmap_count("_bits")).alias("uv"))
    return counts.select(window_end().alias(WINDOW_END), "uv")


class RunningVisitors:
    """Numbers first visits within their window, batch by batch, as a trigger on each row would show the count.

    A batch's first visits come after those of all batches before it, so a visit's number is its place
    in the batch on top of the window's count so far, which a compacted table holds.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, count: str = "uv"):
        self.spark, self.folder, self.count = spark, folder, count
        self.schema = T.StructType([*schema, T.StructField(count, T.LongType())])
        counts = T.StructType([T.StructField(WINDOW_END, T.LongType()), T.StructField("_before", T.LongType())])
        self.counts = CompactTable(spark, f"{folder}/counts", [WINDOW_END], counts)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        added = batch.groupBy(WINDOW_END).agg(F.count(F.lit(1)).alias("_added"))
        ends = added.agg(F.min(WINDOW_END).alias("low"), F.max(WINDOW_END).alias("high")).first()
        if ends["low"] is None:
            batch.unpersist()
            self.counts.put(None, batch_id)
            return
        before = self.counts.table(batch_id - 1, F.col(WINDOW_END).between(ends["low"], ends["high"]))
        placed = position(batch, [WINDOW_END], [TS_MS, "seq"], "_place", None).join(before, WINDOW_END, "left")
        number = (F.col("_place") + F.coalesce("_before", F.lit(0))).alias(self.count)
        placed.select(*self.schema.names[:-1], number).write.mode("overwrite").parquet(f"{self.folder}/rows/{BATCH}={batch_id}")
        now = added.join(before, WINDOW_END, "left")
        self.counts.put(now.select(WINDOW_END, (F.col("_added") + F.coalesce("_before", F.lit(0))).alias("_before")), batch_id)
        batch.unpersist()

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.folder}/rows").select(*self.schema.names)


def visitors_running(visits: DataFrame, spark: SparkSession) -> DataFrame:
    """Run a stream of first visits to its end: a row for each, with its window's count after it."""
    folder = shared_folder(spark, "visitors_running")
    running = RunningVisitors(spark, folder, visits.schema)
    run_to_end(visits.writeStream.foreachBatch(running.write), f"{folder}/checkpoint")
    return running.rows()


class LateRouter:
    """Tags the late rows of a stream and keeps them, where Spark itself would drop them.

    Within a micro-batch rows are judged in arrival order; from one batch to the next only
    the latest event time is carried, recorded in the shared folder under the batch number.
    A repeated batch therefore sees the same past and overwrites its own rows. The stream
    needs no watermark, and no state is kept per key.
    """

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        arrival: Sequence[str],
        bound: timedelta,
        size: timedelta,
        slide: timedelta | None = None,
        lateness: timedelta = timedelta(0),
    ):
        self.spark, self.folder = spark, shared_folder(spark, name)
        self.arrival, self.bound = list(arrival), bound
        self.size, self.slide, self.lateness = size, slide, lateness

    def _seen_before(self, batch_id: int) -> int | None:
        if batch_id == 0:
            return None
        schema = T.StructType([T.StructField("latest", T.LongType())])
        row = self.spark.read.schema(schema).parquet(f"{self.folder}/seen/{BATCH}={batch_id - 1}").first()
        return row[0]

    def tagged(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The rows with the watermark they met and whether they are late."""
        before = self._seen_before(batch_id)
        rows = lateness.arrival_watermark(batch, self.arrival, self.bound)
        if before is not None:
            carried = F.lit(before - millis(self.bound))
            rows = rows.withColumn(lateness.WATERMARK, F.greatest(lateness.WATERMARK, carried))
        return lateness.tag_late(rows, self.size, self.slide, self.lateness)

    def remember(self, batch: DataFrame, batch_id: int) -> None:
        """Record the latest event time seen up to this batch."""
        before = F.lit(self._seen_before(batch_id)).cast("bigint")
        latest = batch.agg(F.greatest(F.max(TS_MS), before).alias("latest"))
        latest.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/seen/{BATCH}={batch_id}")

    def write(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        self.tagged(batch, batch_id).write.mode("overwrite").parquet(f"{self.folder}/rows/{BATCH}={batch_id}")
        self.remember(batch, batch_id)
        batch.unpersist()

    def rows(self, schema: T.StructType) -> DataFrame:
        """What was written of a stream of this schema, with ``wm_ms`` and ``outcome``."""
        added = [T.StructField(lateness.WATERMARK, T.LongType()), T.StructField(lateness.OUTCOME, T.StringType())]
        whole = T.StructType([*schema, *added])
        return self.spark.read.schema(whole).parquet(f"{self.folder}/rows").select(*whole.names)

    def run(self, stream: DataFrame) -> DataFrame:
        """Run the stream to its end and read all rows with ``wm_ms`` and ``outcome``."""
        run_to_end(stream.writeStream.foreachBatch(self.write), f"{self.folder}/checkpoint")
        return self.rows(stream.schema)
