"""Distinct visitors per window: exact, running, bitmap and sketch."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.hashing import BITMAP_BITS, poly_hash
from clickloom.functions.time import TS_MS, millis, slot_start
from clickloom.operators.hotkeys import position
from clickloom.operators.windows import (
    WINDOW,
    WINDOW_END,
    time_window,
    window_end,
    windowed_agg,
)


def distinct_exact(df: DataFrame, visitor: str, size: timedelta, count: str = "uv") -> DataFrame:
    """Exact distinct visitors per tumbling window.

    Both forms first reduce to one row per (window, visitor), which also splits a busy
    window over all tasks. A stream cannot count distinct values, so it drops duplicates.
    """
    pairs = df.select(time_window(size).alias(WINDOW), visitor)
    if df.isStreaming:
        counted = pairs.dropDuplicates([WINDOW, visitor]).groupBy(WINDOW).agg(F.count(visitor).alias(count))
    else:
        counted = pairs.groupBy(WINDOW).agg(F.count_distinct(visitor).alias(count))
    return counted.select(window_end().alias(WINDOW_END), count)


def distinct_running(
    df: DataFrame, visitor: str, seq: str, size: timedelta, count: str = "uv", width: timedelta | None = None
) -> DataFrame:
    """Each change of a window's distinct count: one row per first visit, with the count after it.

    First visits are numbered over slices that hold about equally many of all rows, so a window is
    many tasks' work.
    """
    span = millis(size)
    end = (slot_start(F.col(TS_MS), span) + span).alias(WINDOW_END)
    first = df.groupBy(end, visitor).agg(F.min(F.struct(TS_MS, seq)).alias("_first"))
    visits = first.select(WINDOW_END, visitor, "_first.*")
    return position(visits, [WINDOW_END], [TS_MS, seq], count, width, df)


def distinct_bitmap(
    df: DataFrame, visitor: str, size: timedelta, count: str = "uv", bits: int = BITMAP_BITS
) -> DataFrame:
    """Distinct hash offsets per window, held in bitmaps.

    One bitmap covers 32,768 offsets, so a window's full bitmap is spread over up to
    ``bits / 32768`` groups and its parts merge before the shuffle.
    """
    offset = F.col("_offset")
    rows = df.withColumn("_offset", poly_hash(F.col(visitor).cast("string"), bits=bits))
    rows = rows.withColumn("_bucket", F.bitmap_bucket_number(offset))
    bitmaps = windowed_agg(
        rows,
        ["_bucket"],
        [F.bitmap_construct_agg(F.bitmap_bit_position(offset)).alias("_bits")],
        size,
    )
    return bitmaps.groupBy(WINDOW_END).agg(F.sum(F.bitmap_count("_bits")).alias(count))


def distinct_sketch(
    df: DataFrame, visitor: str, size: timedelta, count: str = "uv", rsd: float = 0.02
) -> DataFrame:
    """Approximate distinct visitors per window within a relative error, in fixed space."""
    return windowed_agg(df, [], [F.approx_count_distinct(visitor, rsd).alias(count)], size)
