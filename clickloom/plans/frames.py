"""The given tables seen as the typed event frames that the jobs take.

``events`` plays every stream: its type is the behaviour, request method, login state or
order event, and the number in ``props`` is the item. Rows are neither filtered nor cut here.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.time import TS, TS_MS, epoch_ms, millis, with_event_time
from clickloom.session import shared_folder
from clickloom.sources.files import read_table, replay, staged_replay

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def _typed(raw: DataFrame) -> DataFrame:
    rows = with_event_time(raw.withColumnRenamed("ts", "at"), "at")
    return rows.select(
        F.col("event_id").alias("seq"),
        TS,
        TS_MS,
        "user_id",
        "event_type",
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
    )


def events(spark: SparkSession, folder: str) -> DataFrame:
    return _typed(read_table(spark, folder, "events"))


# Milliseconds by which an item's rows arrive late, for each number of the item.
ITEM_DELAY = 180_000

# The end of a bounded replay: rows of a reserved key, so far off that the watermark closes all before
# them, one of each type, since a filter by type may run before the watermark is taken.
FAR, RESERVED = datetime(2100, 1, 1), -1
TYPES = "click error purchase signup view".split()


def _closing_rows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(RESERVED, FAR, RESERVED, t, None, None) for t in TYPES], EVENTS)


def event_stream(
    spark: SparkSession, folder: str, delay: timedelta = timedelta(0), closed: bool = True
) -> DataFrame:
    """The same rows as a stream, watermarked by ``delay``.

    A closed stream reads the table in one micro-batch and with it the closing rows, which themselves
    stay in windows and state that never end.
    """
    rows = replay(spark, folder, "events", EVENTS, None if closed else 1)
    if closed:
        path = shared_folder(spark, "closing")
        _closing_rows(spark).coalesce(1).write.parquet(path)
        rows = rows.unionByName(spark.readStream.schema(EVENTS).parquet(path))
        delay = max(delay, timedelta(milliseconds=1))  # the watermark stays before the closing rows
    return _typed(rows).withWatermark(TS, f"{millis(delay)} milliseconds")


def disturbed_stream(
    spark: SparkSession,
    folder: str,
    delay: timedelta = timedelta(days=1),
    days: int = 5,
    hold: timedelta = timedelta(hours=12),
) -> DataFrame:
    """The table replayed in several micro-batches, out of order within ``delay``, then closed.

    A batch is some days; of each batch's last hours (``hold``), every third row comes with the next one.
    Within a batch the newest rows come first.
    """
    span = days * 24 * 3_600_000
    raw = read_table(spark, folder, "events")
    ms = epoch_ms(raw, "ts")
    late = (F.col("event_id") % 3 == 1) & (F.pmod(ms, F.lit(span)) >= span - millis(hold))
    batch = F.floor(ms / span) + F.when(late, 1).otherwise(0)
    ordered = raw.select(*EVENTS.names)
    path = shared_folder(spark, "disturbed")
    stream = staged_replay(ordered, batch, F.desc("ts"), _closing_rows(spark), path)
    return _typed(stream).withWatermark(TS, f"{millis(delay)} milliseconds")


def arriving_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The table replayed in several micro-batches in the order of :func:`late_page_log`'s arrival, without a watermark.

    A batch is five days of arrival.
    """
    raw = read_table(spark, folder, "events")
    item = F.get_json_object("props", "$.k").cast("bigint")
    batch = F.floor((epoch_ms(raw, "ts") + item * ITEM_DELAY) / (5 * 24 * 3_600_000))
    path = shared_folder(spark, "arriving")
    closing = _closing_rows(spark).where("false")
    return _typed(staged_replay(raw.select(*EVENTS.names), batch, F.col("event_id"), closing, path))


def behavior(rows: DataFrame) -> DataFrame:
    return rows.select("user_id", "item_id", F.col("event_type").alias("behavior"), TS, TS_MS, "seq")


def page_log(rows: DataFrame) -> DataFrame:
    url = F.concat(F.lit("/p/"), (F.col("item_id") % 8).cast("string"))
    return rows.select("user_id", F.col("event_type").alias("method"), url.alias("url"), TS, TS_MS, "seq", "item_id")


def late_page_log(rows: DataFrame) -> DataFrame:
    """The log with a made arrival time: each item's rows are delayed by three minutes per item number."""
    arrival = F.col(TS_MS) + F.col("item_id") * ITEM_DELAY
    return page_log(rows).withColumn("arrival_ms", arrival)


def marketing(rows: DataFrame) -> DataFrame:
    channel = (F.col("user_id") % 3).cast("string")
    return rows.select("user_id", F.col("event_type").alias("behavior"), channel.alias("channel"), TS, TS_MS)


def ad_clicks(rows: DataFrame) -> DataFrame:
    province = (F.col("user_id") % 6).cast("string")
    return rows.select("user_id", F.col("event_type").alias("ad_id"), province.alias("province"), TS, TS_MS, "seq")


def logins(rows: DataFrame) -> DataFrame:
    return rows.select("user_id", F.col("event_type").alias("login_state"), TS, TS_MS, "seq")


def user_orders(rows: DataFrame) -> DataFrame:
    """Order events keyed by user, so that keys repeat."""
    return rows.select(F.col("user_id").alias("order_id"), "event_type", TS, TS_MS, "seq")


def payments(rows: DataFrame) -> DataFrame:
    tx = F.col("user_id").cast("string")
    return rows.select("event_type", tx.alias("tx_id"), TS, TS_MS, "seq")


def receipts(rows: DataFrame, kind: str = "purchase") -> DataFrame:
    tx = F.col("user_id").cast("string")
    return rows.where(F.col("event_type") == kind).select(tx.alias("tx_id"), TS, TS_MS, "seq")


def shop_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as creates, and the shipping of each line as a pay; every fifth order's pays bear another number."""
    orders = read_table(spark, folder, "orders")
    lines = read_table(spark, folder, "lineitem")

    def as_events(df: DataFrame, order: str, time: str, kind: Column) -> DataFrame:
        return df.select(F.col(order).alias("order_id"), kind.alias("event_type"), epoch_ms(df, time).alias(TS_MS))

    paid = F.when(F.col("l_orderkey") % 5 == 0, -F.col("l_orderkey")).otherwise(F.col("l_orderkey"))
    creates = as_events(orders, "o_orderkey", "o_orderdate", F.lit("create"))
    return creates.unionByName(as_events(lines.withColumn("_paid", paid), "_paid", "l_shipdate", F.lit("pay")))
