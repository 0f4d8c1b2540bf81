"""The outcome of an order from its create and pay events."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.time import TS_MS, millis

# The four result texts.
PAID = "payed successfully"
PAID_LATE = "payed but already timeout"
NEVER_PAID = "payed timeout"
NEVER_CREATED = "payed but not found created log"

MAIN, SIDE = "main", "side"


def order_outcomes(
    df: DataFrame,
    order: str,
    create: Column,
    pay: Column,
    within: timedelta,
    max_early: timedelta | None = None,
) -> DataFrame:
    """One outcome per order from its first create and first pay.

    A pay may come before its create by at most ``max_early`` (no limit if None); beyond
    that the order gives two rows, a pay without create and a create without pay. The
    two times are partial minima, so an order with very many events costs one row per task.
    """
    times = df.groupBy(order).agg(
        F.min(F.when(create, F.col(TS_MS))).alias("create_ms"),
        F.min(F.when(pay, F.col(TS_MS))).alias("pay_ms"),
    )
    c, p = F.col("create_ms"), F.col("pay_ms")
    early = F.lit(False) if max_early is None else c - p > millis(max_early)
    states = (
        F.when(c.isNull() & p.isNull(), F.array().cast("array<string>"))
        .when(p.isNull(), F.array(F.lit(NEVER_PAID)))
        .when(c.isNull(), F.array(F.lit(NEVER_CREATED)))
        .when(early, F.array(F.lit(NEVER_CREATED), F.lit(NEVER_PAID)))
        .when(p < c + millis(within), F.array(F.lit(PAID)))
        .otherwise(F.array(F.lit(PAID_LATE)))
    )
    return with_output(times.select(order, F.explode(states).alias("result_state")))


def with_output(results: DataFrame) -> DataFrame:
    """Add ``output``: successful orders are the main result, all else goes to the side."""
    tag = F.when(F.col("result_state") == PAID, MAIN).otherwise(SIDE)
    return results.withColumn("output", tag)
