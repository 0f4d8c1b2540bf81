"""Rankings that change while a stream runs, as rows added and rows taken back.

The counts of all (window, key) pairs lie in a compacted table. A micro-batch brings new counts of
some pairs; only the windows of these are ranked again, once as they were and once as they are now,
and what differs is emitted. A repeated batch sees the same past and overwrites its own changes.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.operators import lateness
from clickloom.operators.topn import top_n
from clickloom.operators.windows import WINDOW_END
from clickloom.session import shared_folder
from clickloom.sources.sinks import BATCH, run_to_end
from clickloom.sources.tables import CompactTable
from clickloom.streaming.jobs import LateRouter

ADD = "added"


class RankedCounts:
    """The ``n`` largest counts of each window, ties by key, kept up to date batch by batch."""

    def __init__(self, spark: SparkSession, folder: str, key: T.StructField, n: int, fan: int = 4):
        self.spark, self.folder, self.key, self.n = spark, folder, key.name, n
        fields = [T.StructField(WINDOW_END, T.LongType()), key, T.StructField("cnt", T.LongType())]
        self.counts = CompactTable(spark, f"{folder}/counts", [WINDOW_END, key.name], T.StructType(fields), fan)
        ranked = [*fields, T.StructField("row_num", T.LongType())]
        self.schema = T.StructType([*ranked, T.StructField(ADD, T.BooleanType()), T.StructField(BATCH, T.LongType())])

    def write(self, batch: DataFrame, batch_id: int, additive: bool = False) -> None:
        """Take the new counts of some pairs, or with ``additive`` what comes on top of the old ones."""
        new = batch.select(WINDOW_END, self.key, F.col("cnt").cast("bigint").alias("cnt")).persist()
        ends = new.agg(F.min(WINDOW_END).alias("low"), F.max(WINDOW_END).alias("high")).first()
        if ends["low"] is None:
            new.unpersist()
            self.counts.put(None, batch_id)
            return
        near = F.col(WINDOW_END).between(ends["low"], ends["high"])
        touched = new.select(WINDOW_END).distinct()
        before = self.counts.table(batch_id - 1, near).join(touched, WINDOW_END, "left_semi")
        both = before.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)))
        merged = both.groupBy(WINDOW_END, self.key).agg(
            F.sum("cnt").alias("_sum"),
            F.max(F.when(F.col("_new"), F.col("cnt"))).alias("_latest"),
            F.max(F.when(~F.col("_new"), F.col("cnt"))).alias("_before"),
        )
        now = F.col("_sum") if additive else F.coalesce("_latest", "_before")
        merged = merged.select(WINDOW_END, self.key, "_before", "_latest", now.alias("cnt")).persist()
        old = top_n(merged.where("_before IS NOT NULL").select(WINDOW_END, self.key, F.col("_before").alias("cnt")), self.n, self.key)
        ranked = top_n(merged.select(WINDOW_END, self.key, "cnt"), self.n, self.key)
        names = [n for n in self.schema.names if n not in (ADD, BATCH)]
        signed = ranked.select(*names, F.lit(1).alias("_sign")).unionByName(old.select(*names, F.lit(-1).alias("_sign")))
        changed = signed.groupBy(*names).agg(F.sum("_sign").alias("_sign")).where("_sign <> 0")
        changed = changed.select(*names, (F.col("_sign") > 0).alias(ADD))
        changed.write.mode("overwrite").parquet(f"{self.folder}/changes/{BATCH}={batch_id}")
        self.counts.put(merged.where("_latest IS NOT NULL").select(*self.counts.schema.names), batch_id)
        merged.unpersist()
        new.unpersist()

    def changes(self) -> DataFrame:
        """Every row that came into a ranking (``added``) or left it (not), with its batch."""
        if not self.counts.folder.names("../changes"):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.folder}/changes")

    def folded(self) -> DataFrame:
        """The rankings that the changes add up to."""
        names = [n for n in self.schema.names if n not in (ADD, BATCH)]
        left = self.changes().groupBy(*names).agg(F.sum(F.when(F.col(ADD), 1).otherwise(-1)).alias("_left"))
        return left.where("_left > 0").select(*names)


def ranking_changes(counts: DataFrame, spark: SparkSession, name: str, n: int, key: str) -> RankedCounts:
    """Run an updating stream of window counts to its end as a stream of ranking changes."""
    folder = shared_folder(spark, name)
    ranked = RankedCounts(spark, folder, counts.schema[key], n)
    run_to_end(counts.writeStream.foreachBatch(ranked.write).outputMode("update"), f"{folder}/checkpoint")
    return ranked


class InTimeRanking:
    """One pass over a log in arrival order: rankings of what comes in time, and the rows that come too late.

    A row counts in those of its windows that are still open for it, the allowed lateness included, and
    the windows it touches are ranked anew in its micro-batch. A row for which no window is open goes
    to the late output. The stream needs no watermark of its own.
    """

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        key: T.StructField,
        n: int,
        arrival: Sequence[str],
        bound: timedelta,
        size: timedelta,
        slide: timedelta | None = None,
        allowed: timedelta = timedelta(0),
        wanted: tuple[str, str] | None = None,
    ):
        self.router = LateRouter(spark, name, arrival, bound, size, slide, allowed)
        self.ranking = RankedCounts(spark, f"{self.router.folder}/ranking", key, n)
        self.key, self.windows, self.wanted = key.name, (size, slide, allowed), wanted

    def write(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        rows = self.router.tagged(batch, batch_id)
        if self.wanted:
            column, value = self.wanted
            rows = rows.where(F.col(column) == value)
        rows = rows.persist()
        late = rows.where(F.col(lateness.OUTCOME) == lateness.LATE)
        late.write.mode("overwrite").parquet(f"{self.router.folder}/rows/{BATCH}={batch_id}")
        size, slide, allowed = self.windows
        counts = lateness.accepted_counts(rows, [self.key], size, slide, allowed)
        self.ranking.write(counts, batch_id, additive=True)
        self.router.remember(batch, batch_id)
        rows.unpersist()
        batch.unpersist()

    def run(self, stream: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Run the stream to its end: the final rankings, and the late rows with ``wm_ms``."""
        run_to_end(stream.writeStream.foreachBatch(self.write), f"{self.router.folder}/checkpoint")
        return self.ranking.folded(), self.router.rows(stream.schema)
