"""A daily cap per key with a single alert when it is broken."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.time import TS_MS, calendar_day

OUTCOME = "outcome"
PASSED, WARNING = "passed", "warning"


def cap_warning_text(cap: int) -> str:
    # Fixed value: the alert's text, without a space before "times".
    return f"click over {cap}times."


def daily_cap(
    df: DataFrame, keys: Sequence[str], seq: str, cap: int, zone: str = "UTC"
) -> DataFrame:
    """Rows under the cap (``passed``) and the first row beyond it (``warning``) per key and day.

    The count is tested before it grows, so ``cap + 1`` rows pass. Rows after the warning
    vanish, which is what keeps a hot key cheap: no task keeps more than ``cap + 2`` rows
    of a key, before the shuffle as well as after it.
    """
    spec = Window.partitionBy(*keys, "_day").orderBy(TS_MS, seq)
    ranked = (
        df.withColumn("_day", calendar_day(F.col(TS_MS), zone))
        .withColumn("_nth", F.row_number().over(spec))
        .where(F.col("_nth") <= cap + 2)
    )
    outcome = F.when(F.col("_nth") <= cap + 1, PASSED).otherwise(WARNING)
    return ranked.withColumn(OUTCOME, outcome).drop("_nth", "_day")


def passed_rows(capped: DataFrame) -> DataFrame:
    return capped.where(F.col(OUTCOME) == PASSED).drop(OUTCOME)


def cap_warnings(capped: DataFrame, keys: Sequence[str], cap: int) -> DataFrame:
    rows = capped.where(F.col(OUTCOME) == WARNING)
    return rows.select(*keys, F.lit(cap_warning_text(cap)).alias("warning_msg"))
