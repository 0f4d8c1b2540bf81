"""Watermarks in arrival order, allowed lateness and the late side output, in batch.

The stream forms are ``withWatermark`` and ``clickloom.streaming.jobs.LateRouter``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.time import TS_MS, millis, slot_start
from clickloom.operators.hotkeys import running
from clickloom.operators.windows import WINDOW_END, ends_of_pane

WATERMARK = "wm_ms"
OUTCOME = "outcome"
LATE, ON_TIME = "late", "on_time"


def watermark(df: DataFrame, delay: timedelta = timedelta(0)) -> DataFrame:
    """Watermark a stream's ``ts`` by a bound on out-of-orderness; zero means ascending time."""
    return df.withWatermark("ts", f"{millis(delay)} milliseconds")


def arrival_watermark(
    df: DataFrame, arrival: Sequence[str], bound: timedelta, width: timedelta | None = None
) -> DataFrame:
    """Add the watermark each row met: the latest event time so far, in arrival order, less ``bound``.

    ``arrival`` orders the rows totally and starts with a millisecond column. The whole
    table is one ordered group here, cut into slices of about equally many rows (or of arrival time
    ``width`` wide); what crosses them is one running maximum for each slice.
    """
    everything = df.withColumn("_all", F.lit(0))
    seen = running(everything, ["_all"], arrival, F.col(TS_MS), "_seen", F.max, width)
    return seen.withColumn(WATERMARK, F.col("_seen") - millis(bound)).drop("_seen", "_all")


def _checked(size: timedelta, slide: timedelta | None) -> timedelta:
    if slide is not None and millis(size) % millis(slide):
        raise ValueError("the window size must be a multiple of the slide")
    return slide or size


def tag_late(
    df: DataFrame, size: timedelta, slide: timedelta | None = None, lateness: timedelta = timedelta(0)
) -> DataFrame:
    """Tag rows whose every window had closed, lateness included, when they arrived."""
    slide = _checked(size, slide)
    latest_end = slot_start(F.col(TS_MS), millis(slide)) + millis(size)
    late = latest_end + millis(lateness) <= F.col(WATERMARK)
    return df.withColumn(OUTCOME, F.when(late, LATE).otherwise(ON_TIME))


def accepted_counts(
    tagged: DataFrame,
    keys: Sequence[str],
    size: timedelta,
    slide: timedelta | None = None,
    lateness: timedelta = timedelta(0),
    count: str = "cnt",
) -> DataFrame:
    """Final window counts of the rows in time: each row counts in those windows still open for it."""
    slide = _checked(size, slide)
    step = millis(slide)
    # First window end after (watermark - lateness); ends are multiples of the slide.
    closed = F.col(WATERMARK) - millis(lateness)
    first_open = slot_start(closed, step) + step
    pane = slot_start(F.col(TS_MS), step)
    panes = (
        tagged.where(F.col(OUTCOME) == ON_TIME)
        .groupBy(*keys, pane.alias("_pane"), F.greatest(first_open, pane + step).alias("_first"))
        .agg(F.count(F.lit(1)).alias(count))
    )
    ends = F.explode(ends_of_pane(size, slide, F.col("_first"))).alias(WINDOW_END)
    copies = panes.select(*keys, count, ends)
    return copies.groupBy(*keys, WINDOW_END).agg(F.sum(count).alias(count))


def split_outputs(df: DataFrame, tags: Sequence[str], column: str = OUTCOME) -> dict[str, DataFrame]:
    """One frame per tag of the outcome column."""
    return {tag: df.where(F.col(column) == tag) for tag in tags}
