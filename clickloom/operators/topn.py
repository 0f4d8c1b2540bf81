"""Per-window rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.time import format_ms
from clickloom.operators.windows import WINDOW_END


def top_n(
    counts: DataFrame,
    n: int,
    key: str,
    measure: str = "cnt",
    within: Sequence[str] = (WINDOW_END,),
    rank: str = "row_num",
) -> DataFrame:
    """The ``n`` largest per window, ties by key.

    The filter directly on row_number lets Spark keep only ``n`` rows per window in each
    map task before the shuffle, so a window with millions of keys is never collected.
    """
    spec = Window.partitionBy(*within).orderBy(F.desc(measure), F.asc(key))
    ranked = counts.withColumn(rank, F.row_number().over(spec)).where(F.col(rank) <= n)
    return ranked.withColumn(rank, F.col(rank).cast("bigint"))


# The report's text pieces.
REPORT_RULE = "======"
REPORT_HEAD = "窗口结束时间："
REPORT_FOOT = "==========================================="
ITEM_LABELS = (" 商品ID = ", " 热门度 : ")
PAGE_LABELS = (" 页面url : ", " 浏览量 : ")


def render_ranking(
    ranked: DataFrame,
    key: str,
    labels: tuple[str, str],
    measure: str = "cnt",
    rank: str = "row_num",
    zone: str = "UTC",
) -> DataFrame:
    """One text block per window from rows that :func:`top_n` has already cut to a few."""
    line = F.concat(
        F.lit("NO."), F.col(rank).cast("string"), F.lit(":"),
        F.lit(labels[0]), F.col(key).cast("string"),
        F.lit(labels[1]), F.col(measure).cast("string"), F.lit("\n"),
    )
    lines = F.array_sort(F.collect_list(F.struct(F.col(rank), line.alias("line"))))
    body = F.array_join(F.transform(F.col("_lines"), lambda r: r["line"]), "")
    head = F.concat(
        F.lit(REPORT_RULE + REPORT_HEAD), format_ms(F.col(WINDOW_END), zone=zone), F.lit(REPORT_RULE + "\n")
    )
    return (
        ranked.groupBy(WINDOW_END)
        .agg(lines.alias("_lines"))
        .select(WINDOW_END, F.concat(head, body, F.lit(REPORT_FOOT + "\n\n")).alias("report"))
    )


def descending(df: DataFrame, measure: str, *ties: str) -> DataFrame:
    """Rows by falling measure, ties by the given columns."""
    order: list[Column] = [F.desc(measure), *[F.asc(t) for t in ties]]
    return df.orderBy(*order)
