"""Event sequences per key: consecutive runs, strict and relaxed sequences."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.time import TS_MS, java_timestamp_text, millis
from clickloom.operators.hotkeys import WIDTH, with_next, with_preceding

FIRST, LAST = "first_ts_ms", "last_ts_ms"


def strict_sequence(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    steps: Sequence[Column],
    within: timedelta,
    inclusive: bool = False,
    width: timedelta = WIDTH,
) -> DataFrame:
    """Matches of adjacent rows that satisfy ``steps`` in turn, first to last ``within`` a span.

    Matches may overlap. A row is the end of a match when the rows 0, 1, ... before it
    satisfy the last, the last but one, ... step.
    """
    flags = [f"_step{i}" for i in range(len(steps))]
    rows = df.select(*keys, TS_MS, seq, *[s.alias(f) for s, f in zip(steps, flags)])
    depth = len(steps) - 1

    def look_back(spec):
        met = F.lit(True)
        for i, flag in enumerate(flags):
            back = depth - i
            met = met & (F.lag(flag, back).over(spec) if back else F.col(flag))
        return {FIRST: F.lag(TS_MS, depth).over(spec) if depth else F.col(TS_MS), "_met": met}

    found = with_preceding(rows, keys, [TS_MS, seq], max(depth, 1), look_back, width)
    span, limit = F.col(TS_MS) - F.col(FIRST), millis(within)
    near = span <= limit if inclusive else span < limit
    matches = found.where(F.col("_met") & near)
    return matches.select(*keys, FIRST, F.col(TS_MS).alias(LAST), seq)


def consecutive(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    condition: Column,
    times: int,
    within: timedelta,
    inclusive: bool = False,
    width: timedelta = WIDTH,
) -> DataFrame:
    """Overlapping runs of ``times`` adjacent rows that all meet ``condition``, ``within`` a span."""
    return strict_sequence(df, keys, seq, [condition] * times, within, inclusive, width)


MATCHED, TIMED_OUT = "matched", "timeout"


def followed_by(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    begin: Column,
    end: Column,
    within: timedelta,
    width: timedelta = WIDTH,
) -> DataFrame:
    """For each ``begin`` row, whether an ``end`` row of its key follows ``within`` a span.

    Rows in between do not matter. ``outcome`` is ``matched`` (with the end's time) or
    ``timeout``; an end row without a begin gives nothing.
    """
    rows = df.select(*keys, TS_MS, seq, begin.alias("_begin"), end.alias("_end"))
    rows = rows.where(F.col("_begin") | F.col("_end"))
    found = with_next(rows, keys, [TS_MS, seq], "_end", "_next", width).where("_begin")
    in_time = F.col("_next") - F.col(TS_MS) < millis(within)
    return found.select(
        *keys,
        F.col(TS_MS).alias("begin_ms"),
        seq,
        F.when(in_time, F.col("_next")).alias("end_ms"),
        F.when(in_time, MATCHED).otherwise(TIMED_OUT).alias("outcome"),
    )


def order_pattern_result(found: DataFrame, order: str, within: timedelta, zone: str = "UTC") -> DataFrame:
    """The result text of a create/pay pattern: ``payed`` or the times it ran from and out at."""
    # The texts, with two spaces after the bar.
    created = java_timestamp_text(F.col("begin_ms"), zone)
    expired = java_timestamp_text(F.col("begin_ms") + millis(within), zone)
    timeout = F.concat(
        F.lit("order create time : "), created, F.lit(" |  order timeout : "), expired
    )
    state = F.when(F.col("outcome") == MATCHED, "payed").otherwise(timeout)
    return found.select(order, state.alias("result_state"), "outcome")
