"""Ordered work per key that stays parallel when one key holds much of the data.

A Spark window partitions by key, so a key with a third of all rows would be sorted by one
task. Here every key is cut into time slices of one width. What a slice must know of the others
(a running total, the last few rows, the nearest row of some kind) is aggregated per slice,
scanned over the key's short list of slices, and handed to each slice as *boundary rows* that
sort in with its own. The window then runs per (key, slice) and gives exactly what it would
have given per key, whatever the width. Nothing is counted or collected first.

Rows without a time belong to the first slice of their key.

Where one order runs over a whole table, slices of one width would be as uneven as the rows in
time. There slices hold about as many rows each instead: their bounds are quantiles of sampled rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.time import millis

SLICE = "_slice"
BOUNDARY = "_boundary"
WIDTH = timedelta(days=1)
_FIRST = -(2**63)


def whole_slots(ms: Column, width: int) -> Column:
    """Number of the epoch-aligned slot of ``width`` milliseconds that holds ``ms``, in whole numbers."""
    size = F.lit(width).cast("bigint")
    return F.call_function("div", ms - F.pmod(ms, size), size)


@dataclass(frozen=True)
class Sliced:
    """A frame with its slice column."""

    df: DataFrame
    keys: list[str]

    @property
    def group(self) -> list[str]:
        return [*self.keys, SLICE]


def cut_by_time(df: DataFrame, keys: Sequence[str], time: str, width: timedelta = WIDTH) -> Sliced:
    """Number the slices of ``width`` that the rows lie in."""
    number = F.coalesce(whole_slots(F.col(time), millis(width)), F.lit(_FIRST).cast("bigint"))
    return Sliced(df.withColumn(SLICE, number), list(keys))


def cut_by_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slices: int | None = None,
    sampled: DataFrame | None = None,
) -> Sliced:
    """Number slices of about equally many rows in ``order``, whatever the keys.

    ``order`` is a column of whole numbers, and another that cuts its ties where very many rows share one.
    By default there are sixteen slices for each shuffle partition: dealt by hash, they load tasks
    evenly. The driver samples some rows for each slice, and no more; with ``sampled``, rows of that
    frame, where ``df`` is costly and a part of it.
    """
    slices = slices or 16 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    time, tie = order if len(order) > 1 else (order[0], None)
    source = df if sampled is None else sampled
    bounds = _bounds(source.select(time, (F.col(tie) if tie else F.lit(0)).alias("_tie")), slices)
    times = list(dict.fromkeys(t for t, _ in bounds))
    if not times:
        return Sliced(df.withColumn(SLICE, F.lit(0).cast("bigint")), list(keys))
    at = F.coalesce(F.col(time).cast("double"), F.lit(float("-inf")))
    splits = [float("-inf"), *map(float, times), float("inf")]
    cut = Bucketizer(splits=splits, inputCol="_at", outputCol="_cut").transform(df.withColumn("_at", at))
    # A time that is a bound itself begins a slice; one that is several bounds is cut by the tie column too.
    crowded = [sorted(v for t, v in bounds if t == time)[1:] for time in times]
    after = [0]
    for ties in crowded:
        after.append(after[-1] + 1 + len(ties))
    number = F.get(F.array(*map(F.lit, after)), F.col("_cut").cast("int"))
    if any(crowded):
        kind = T.ArrayType(T.ArrayType(df.schema[tie].dataType))
        ties = F.get(F.from_json(F.lit(json.dumps([[], *crowded])), kind), F.col("_cut").cast("int"))
        here = F.col(time) == F.get(F.array(F.lit(None).cast("bigint"), *map(F.lit, times)), F.col("_cut").cast("int"))
        ahead = F.size(F.filter(ties, lambda v: v > F.col(tie)))
        number = number - F.when(here, ahead).otherwise(0)
    return Sliced(cut.withColumn(SLICE, number.cast("bigint")).drop("_at", "_cut"), list(keys))


def _bounds(rows: DataFrame, slices: int, each: int = 20) -> list[tuple]:
    """Different points that part the sampled rows into even slices."""
    total = rows.count()
    if slices < 2 or not total:
        return []
    share = min(1.0, each * slices / total)
    sampled = rows if share == 1 else rows.sample(fraction=share, seed=1)
    found = sorted(tuple(r) for r in sampled.na.drop().collect())
    return list(dict.fromkeys(found[len(found) * k // slices] for k in range(1, slices))) if found else []


def _with_boundary(sliced: Sliced, boundary: DataFrame) -> DataFrame:
    rows = sliced.df.withColumn(BOUNDARY, F.lit(False))
    return rows.unionByName(boundary.withColumn(BOUNDARY, F.lit(True)), allowMissingColumns=True)


def _strip(df: DataFrame) -> DataFrame:
    return df.where(~F.col(BOUNDARY)).drop(BOUNDARY, SLICE)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    out: str,
    agg: Callable[[Column], Column] = F.sum,
    width: timedelta | None = WIDTH,
    sampled: DataFrame | None = None,
) -> DataFrame:
    """Running ``agg`` (sum, max or min) of ``value`` per key, up to and including each row.

    ``order`` starts with a millisecond column and must order the rows of a key totally. Slices are
    ``width`` wide; with none, they are cut by numbers of rows (of ``sampled``, if given).
    """
    valued = df.withColumn("_value", value)
    if width is None:
        sliced = cut_by_rows(valued, keys, order, sampled=sampled)
    else:
        sliced = cut_by_time(valued, keys, order[0], width)
    before = Window.partitionBy(*sliced.keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        sliced.df.groupBy(*sliced.group)
        .agg(agg(F.col("_value")).alias("_total"))
        .withColumn("_value", agg(F.col("_total")).over(before))
        .where(F.col("_value").isNotNull())
        .drop("_total")
    )
    # Boundary rows come first: they have no order values, and rows without a time follow them.
    upto = (
        Window.partitionBy(*sliced.group)
        .orderBy(F.desc(BOUNDARY), *[F.asc_nulls_first(c) for c in order])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = _with_boundary(sliced, totals)
    return _strip(rows.withColumn(out, agg(F.col("_value")).over(upto)).drop("_value"))


def position(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out: str,
    width: timedelta | None = WIDTH,
    sampled: DataFrame | None = None,
) -> DataFrame:
    """Exact 1-based row number per key."""
    return running(df, keys, order, F.lit(1).cast("bigint"), out, F.sum, width, sampled)


def with_preceding(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    depth: int,
    columns: Callable[[Window], dict[str, Column]],
    width: timedelta = WIDTH,
) -> DataFrame:
    """Add window columns that look back at most ``depth`` rows within a key.

    ``columns`` gets the ordered window spec and returns the columns to add.
    """
    sliced = cut_by_time(df, keys, order[0], width)
    latest = Window.partitionBy(*sliced.group).orderBy(*[F.desc(c) for c in order])
    earlier = Window.partitionBy(*sliced.keys).orderBy(SLICE).rowsBetween(-depth, -1)
    rest = [c for c in df.columns if c not in order and c not in sliced.keys]
    boundary = (
        sliced.df.withColumn("_back", F.row_number().over(latest))
        .where(F.col("_back") <= depth)
        .groupBy(*sliced.group)
        .agg(F.array_sort(F.collect_list(F.struct(*order, F.struct(*rest, F.lit(0)).alias("_rest")))).alias("_tail"))
        .withColumn("_tail", F.flatten(F.collect_list("_tail").over(earlier)))
        .select(*sliced.group, F.explode(F.slice("_tail", F.greatest(F.lit(1), F.size("_tail") - depth + 1), F.lit(depth))).alias("_row"))
        .select(*sliced.group, *[f"_row.{c}" for c in order], *[f"_row._rest.{c}" for c in rest])
    )
    spec = Window.partitionBy(*sliced.group).orderBy(F.desc(BOUNDARY), *order)
    return _strip(_with_boundary(sliced, boundary).withColumns(columns(spec)))


def nearest_of_other_slices(
    sliced: Sliced, order: Sequence[str], wanted: Sequence[tuple[Column, bool, dict[str, Column]]]
) -> DataFrame:
    """Per slice of a key, the nearest rows outside it that meet the wanted conditions.

    ``wanted`` holds (condition, look before instead of after, columns to mark the row with).
    All are found in one pre-aggregated pass. A row is given by its order values and its marks.
    """
    names = [f"_near{i}" for i in range(len(wanted))]
    inside = [
        (F.max if before else F.min)(F.when(condition, F.struct(*order))).alias(name)
        for name, (condition, before, _) in zip(names, wanted)
    ]
    earlier = Window.partitionBy(*sliced.keys).orderBy(F.asc(SLICE))
    later = Window.partitionBy(*sliced.keys).orderBy(F.desc(SLICE))
    outside = {}
    for name, (_, before, _) in zip(names, wanted):
        spec = (earlier if before else later).rowsBetween(Window.unboundedPreceding, -1)
        outside[name] = (F.max if before else F.min)(name).over(spec)
    found = sliced.df.groupBy(*sliced.group).agg(*inside).withColumns(outside)
    marked = [
        F.struct(
            F.col(name).isNotNull().alias("_found"),
            *[F.col(name)[c].alias(c) for c in order],
            *[value.alias(mark) for mark, value in marks.items()],
        )
        for name, (_, _, marks) in zip(names, wanted)
    ]
    rows = found.select(*sliced.group, F.explode(F.array(*marked)).alias("_row"))
    rows = rows.where("_row._found").select(*sliced.group, "_row.*")
    return rows.drop("_found")


def with_next(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    target: str,
    out: str,
    width: timedelta = WIDTH,
) -> DataFrame:
    """Add ``out``: first order value of the next row in the key where the flag ``target`` holds."""
    sliced = cut_by_time(df, keys, order[0], width)
    wanted = [(F.col(target), False, {target: F.lit(True)})]
    rows = _with_boundary(sliced, nearest_of_other_slices(sliced, order, wanted))
    # Seen from the end, the rows already passed are the later ones: a growing frame, linear work.
    later = (
        Window.partitionBy(*sliced.group)
        .orderBy(*[F.desc(c) for c in order])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    value = F.min(F.when(F.col(target), F.col(order[0]))).over(later)
    return _strip(rows.withColumn(out, value))


def with_nearest_sides(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    sides: dict[str, str],
    side: str,
    width: timedelta = WIDTH,
) -> DataFrame:
    """For each side value, add the nearest time of that side at or before, and at or after, each row.

    ``sides`` maps a side value to a prefix; the columns are ``<prefix>_before`` and ``<prefix>_after``.
    """
    sliced = cut_by_time(df, keys, time, width)
    wanted = [
        (F.col(side) == value, before, {side: F.lit(value)}) for value in sides for before in (True, False)
    ]
    rows = _with_boundary(sliced, nearest_of_other_slices(sliced, [time], wanted))
    # Range frames take in rows at the same time, so both ends count as inclusive.
    upto = Window.partitionBy(*sliced.group).orderBy(F.asc(time))
    onward = Window.partitionBy(*sliced.group).orderBy(F.desc(time))
    added = {}
    for value, prefix in sides.items():
        at = F.when(F.col(side) == value, F.col(time))
        added[f"{prefix}_before"] = F.max(at).over(upto)
        added[f"{prefix}_after"] = F.min(at).over(onward)
    return _strip(rows.withColumns(added))
