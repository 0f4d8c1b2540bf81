"""Tumbling and sliding event-time windows and the aggregates over them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.time import TS, TS_MS, interval_text, millis, slot_start

WINDOW = "w"
WINDOW_END = "window_end_ms"


def time_window(size: timedelta, slide: timedelta | None = None, time: str = TS) -> Column:
    """Epoch-aligned window column, tumbling unless a slide is given."""
    if slide is None or slide == size:
        return F.window(time, interval_text(size))
    return F.window(time, interval_text(size), interval_text(slide))


def window_end(window: str = WINDOW) -> Column:
    """The window's end in epoch milliseconds."""
    return F.unix_millis(F.col(f"{window}.end"))


def windowed_agg(
    df: DataFrame,
    keys: Sequence[str],
    aggs: Sequence[Column],
    size: timedelta,
    slide: timedelta | None = None,
    keep_window: bool = False,
) -> DataFrame:
    """Aggregate per key and window. ``keys`` may be empty: one row per window.

    Works on batch and streaming frames. A stream that is aggregated again needs the
    window itself, which ``keep_window`` leaves in as ``w``.
    """
    grouped = df.groupBy(*keys, time_window(size, slide).alias(WINDOW)).agg(*aggs)
    lead = [*keys, WINDOW] if keep_window else [*keys]
    values = [c for c in grouped.columns if c not in (*keys, WINDOW)]
    return grouped.select(*lead, window_end().alias(WINDOW_END), *values)


def windowed_count(
    df: DataFrame,
    keys: Sequence[str],
    size: timedelta,
    slide: timedelta | None = None,
    count: str = "cnt",
    counted: str | None = None,
    keep_window: bool = False,
    chained: bool = False,
) -> DataFrame:
    """Rows (or non-null values of ``counted``) per key and window.

    A stream counts each row in all its windows at once, or, ``chained``, once in its slide-wide
    pane and then adds the panes up; that needs append mode but no copies of the input rows.
    """
    one = F.lit(1) if counted is None else F.col(counted)
    if df.isStreaming and chained and _has_panes(size, slide):
        panes = df.groupBy(*keys, time_window(slide).alias("_pane")).agg(F.count(one).alias(count))
        window = F.window(F.window_time("_pane"), interval_text(size), interval_text(slide)).alias(WINDOW)
        sums = panes.groupBy(*keys, window).agg(F.sum(count).alias(count))
        return sums.select(*keys, *([WINDOW] if keep_window else []), window_end().alias(WINDOW_END), count)
    if df.isStreaming or not _has_panes(size, slide):
        return windowed_agg(df, keys, [F.count(one).alias(count)], size, slide, keep_window)
    panes = df.groupBy(*keys, _pane_start(slide)).agg(F.count(one).alias(count))
    return _roll_up(panes, keys, size, slide, count)


def windowed_sum(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    size: timedelta,
    slide: timedelta | None = None,
    out: str = "total",
    keep_window: bool = False,
) -> DataFrame:
    """Sum of ``value`` per key and window."""
    if df.isStreaming or not _has_panes(size, slide):
        return windowed_agg(df, keys, [F.sum(value).alias(out)], size, slide, keep_window)
    panes = df.groupBy(*keys, _pane_start(slide)).agg(F.sum(value).alias(out))
    return _roll_up(panes, keys, size, slide, out)


def _has_panes(size: timedelta, slide: timedelta | None) -> bool:
    return slide is not None and slide < size and millis(size) % millis(slide) == 0


def _pane_start(slide: timedelta) -> Column:
    return slot_start(F.col(TS_MS), millis(slide)).alias("_pane")


def ends_of_pane(size: timedelta, slide: timedelta, first: Column | None = None) -> Column:
    """Ends of the windows that contain the slide-wide pane ``_pane``, from ``first`` on."""
    low = F.col("_pane") + millis(slide)
    low = low if first is None else F.greatest(low, first)
    return F.sequence(low, F.col("_pane") + millis(size), F.lit(millis(slide)).cast("bigint"))


def _roll_up(
    panes: DataFrame, keys: Sequence[str], size: timedelta, slide: timedelta, value: str
) -> DataFrame:
    """Add slide-wide panes up into windows: counted rows are copied size/slide times, input rows never."""
    copies = panes.select(*keys, value, F.explode(ends_of_pane(size, slide)).alias(WINDOW_END))
    return copies.groupBy(*keys, WINDOW_END).agg(F.sum(value).alias(value))


def labelled_total(
    df: DataFrame,
    label: str,
    size: timedelta,
    slide: timedelta | None = None,
    label_column: str = "label",
    count: str = "cnt",
) -> DataFrame:
    """Count of all rows per window under a constant label."""
    counts = windowed_count(df, [], size, slide, count)
    return counts.select(F.lit(label).alias(label_column), WINDOW_END, count)


# Fixed value: number of salts of the two-stage count.
SALTS = 12


def salted_count(
    df: DataFrame,
    size: timedelta,
    salt_by: Sequence[str],
    salts: int = SALTS,
    count: str = "cnt",
) -> DataFrame:
    """Window count in two stages, first per salt, then over the salts.

    The salt is a hash of ``salt_by``, so a retried task assigns it again alike.
    """
    salt = F.pmod(F.xxhash64(*salt_by), F.lit(salts))
    first = windowed_count(df.withColumn("_salt", salt), ["_salt"], size, None, count, keep_window=True)
    if df.isStreaming:
        second = first.groupBy(WINDOW).agg(F.sum(count).alias(count))
        return second.select(window_end().alias(WINDOW_END), count)
    return first.groupBy(WINDOW_END).agg(F.sum(count).alias(count))
