"""Joining two keyed streams on a time interval, and reconciling them."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.time import TS, TS_MS, millis
from clickloom.operators.hotkeys import WIDTH, whole_slots, with_nearest_sides

SIDE = "side"
LEFT, RIGHT = "left", "right"


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    before: timedelta,
    after: timedelta,
    prefixes: tuple[str, str] = ("l_", "r_"),
    how: str = "inner",
) -> DataFrame:
    """Pairs with equal keys and ``left - before <= right <= left + after``, both ends included.

    All columns come out prefixed. In batch the key is extended by a time slot as wide as
    the interval: a left row goes to the at most two slots its interval touches and meets
    only the right rows there, so a key with many rows is split by time. A stream joins
    on the key and the interval, from which Spark bounds its state.
    """
    lp, rp = prefixes
    if left.isStreaming or right.isStreaming:
        l, r = prefixed(left, lp), prefixed(right, rp)
        near = F.expr(
            f"{rp}{TS} >= {lp}{TS} - interval '{millis(before) / 1000}' second "
            f"and {rp}{TS} <= {lp}{TS} + interval '{millis(after) / 1000}' second"
        )
        return l.join(r, (F.col(lp + on) == F.col(rp + on)) & near, how)
    if how != "inner":
        raise ValueError("batch interval joins are inner; use reconcile for the unmatched rows")

    low, high = millis(before), millis(after)
    slot = lambda ms: whole_slots(ms, max(low + high, 1))
    l = prefixed(left, lp)
    r = prefixed(right, rp)
    at = F.col(lp + TS_MS)
    l = l.withColumn("_slot", F.explode(F.sequence(slot(at - low), slot(at + high))))
    r = r.withColumn("_rslot", slot(F.col(rp + TS_MS)))
    near = F.col(rp + TS_MS).between(at - low, at + high)
    same = (F.col(lp + on) == F.col(rp + on)) & (F.col("_slot") == F.col("_rslot"))
    return l.join(r, same & near).drop("_slot", "_rslot")


def connect(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both streams in one frame with a ``side`` tag; missing columns are null."""
    return left.withColumn(SIDE, F.lit(LEFT)).unionByName(
        right.withColumn(SIDE, F.lit(RIGHT)), allowMissingColumns=True
    )


MATCHED, UNMATCHED_LEFT, UNMATCHED_RIGHT = "matched", "unmatched_left", "unmatched_right"


def unmatched(
    left: DataFrame,
    right: DataFrame,
    on: str,
    before: timedelta,
    after: timedelta,
    width: timedelta = WIDTH,
) -> DataFrame:
    """Rows of either side with no partner in the interval, tagged by side.

    Whether a row has a partner depends only on the nearest rows of the other side, before
    and after it: two linear scans over one shuffle, and no pairs.
    """
    low, high = millis(before), millis(after)
    rows = with_nearest_sides(
        connect(left, right), [on], TS_MS, {LEFT: "_l", RIGHT: "_r"}, SIDE, width
    )
    at = F.col(TS_MS)
    has_right = (F.col("_r_before") >= at - low) | (F.col("_r_after") <= at + high)
    has_left = (F.col("_l_before") >= at - high) | (F.col("_l_after") <= at + low)
    # A null key equals nothing, so such rows have no partner.
    paired = F.when(F.col(SIDE) == LEFT, has_right).otherwise(has_left) & F.col(on).isNotNull()
    return rows.where(~F.coalesce(paired, F.lit(False))).drop(
        "_l_before", "_l_after", "_r_before", "_r_after"
    )


def reconcile(
    left: DataFrame,
    right: DataFrame,
    on: str,
    before: timedelta,
    after: timedelta,
    prefixes: tuple[str, str] = ("l_", "r_"),
    width: timedelta = WIDTH,
) -> DataFrame:
    """All matched pairs, and the rows of either side without a partner, under ``outcome``."""
    lp, rp = prefixes
    pairs = interval_join(left, right, on, before, after, prefixes)
    lone = unmatched(left, right, on, before, after, width)
    lone = lone.select(
        *[F.when(F.col(SIDE) == LEFT, F.col(c)).alias(lp + c) for c in left.columns],
        *[F.when(F.col(SIDE) == RIGHT, F.col(c)).alias(rp + c) for c in right.columns],
        F.when(F.col(SIDE) == LEFT, UNMATCHED_LEFT).otherwise(UNMATCHED_RIGHT).alias("outcome"),
    )
    return pairs.withColumn("outcome", F.lit(MATCHED)).unionByName(lone)
