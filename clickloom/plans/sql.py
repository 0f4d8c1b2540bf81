"""The hot-item analysis through temporary views and SQL."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.time import interval_text
from clickloom.operators.windows import windowed_count


def hot_items_from_table(
    behavior: DataFrame,
    n: int = 5,
    size: timedelta = timedelta(minutes=1),
    slide: timedelta = timedelta(seconds=5),
    view: str = "pv",
) -> DataFrame:
    """Aggregate with the DataFrame API, then rank and format in SQL."""
    counts = windowed_count(
        behavior.where(F.col("behavior") == view), ["item_id"], size, slide, counted="item_id"
    )
    return behavior.sparkSession.sql(
        f"""
        SELECT item_id,
               date_format(convert_timezone('UTC', 'UTC',
                   timestampadd(MILLISECOND, window_end_ms, timestamp_ntz'1970-01-01 00:00:00')),
                   'yyyy-MM-dd HH:mm:ss') AS window_end,
               cnt, CAST(row_num AS BIGINT) AS row_num
        FROM (SELECT *, row_number() OVER (PARTITION BY window_end_ms ORDER BY cnt DESC, item_id) AS row_num
              FROM {{counts}})
        WHERE row_num <= {int(n)}
        """,
        counts=counts,
    )


def hot_items_in_sql(
    behavior: DataFrame,
    n: int = 5,
    size: timedelta = timedelta(minutes=1),
    slide: timedelta = timedelta(seconds=5),
    view: str = "pv",
) -> DataFrame:
    """Filter, window, count and rank in SQL."""
    return ranked_in_sql(counted_in_sql(behavior, size, slide, view), n)


def counted_in_sql(behavior: DataFrame, size: timedelta, slide: timedelta, view: str = "pv") -> DataFrame:
    """Views per item and sliding window by a SQL statement. Batch or stream."""
    return behavior.sparkSession.sql(
        f"""
        SELECT item_id, unix_millis(window.end) AS window_end_ms, count(item_id) AS cnt
        FROM {{behavior}}
        WHERE behavior = :view
        GROUP BY item_id, window(ts, '{interval_text(size)}', '{interval_text(slide)}')
        """,
        args={"view": view},
        behavior=behavior,
    )


def ranked_in_sql(counts: DataFrame, n: int) -> DataFrame:
    """The most frequent items of each window by a SQL statement."""
    return counts.sparkSession.sql(
        f"""
        SELECT item_id, window_end_ms, cnt, CAST(row_num AS BIGINT) AS row_num
        FROM (
            SELECT item_id, window_end_ms, cnt,
                   row_number() OVER (PARTITION BY window_end_ms ORDER BY cnt DESC, item_id) AS row_num
            FROM {{counts}}
        )
        WHERE row_num <= {int(n)}
        """,
        counts=counts,
    )
