"""Aggregates of the user's own, with partial states before the shuffle.

An accumulator makes a state, adds rows to it, merges two states and tells the result. Each task
adds the rows of its Arrow batches group by group, so what is shuffled is one state for each task
and group, also of a key that holds much of the data. Sliding windows are made from slide-wide
panes: a row is added once, and the panes' merged states are copied to the windows.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from datetime import timedelta
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from clickloom.functions.time import TS_MS, millis, slot_start
from clickloom.operators.windows import WINDOW_END, ends_of_pane

# Workers need not have the package installed: its functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules["clickloom"])

STATE, PANE = "_state", "_pane"
# States that a task holds before it hands them on.
HELD = 50_000


class Accumulator:
    """An aggregate. ``state`` and ``output`` are Spark types of a state and of the result.

    Merging must not depend on the order of states, nor adding on the order of rows.
    """

    state: T.DataType
    output: T.DataType

    def create(self) -> Any:
        """The state of no rows."""
        raise NotImplementedError

    def add(self, state: Any, *columns: pa.Array) -> Any:
        """The state with some rows of one group added, given as one array for each input column."""
        raise NotImplementedError

    def merge(self, one: Any, other: Any) -> Any:
        raise NotImplementedError

    def result(self, state: Any) -> Any:
        return state


class TrimmedMean(Accumulator):
    """The mean of whole numbers without the smallest and the largest one; nulls are left out. Null below three values."""

    state = T.StructType([T.StructField(n, T.LongType()) for n in ("n", "total", "low", "high")])
    output = T.DoubleType()

    def create(self) -> dict:
        return {"n": 0, "total": 0, "low": None, "high": None}

    def add(self, state: dict, values: pa.Array) -> dict:
        known = values.drop_null().to_numpy(zero_copy_only=False)
        if not len(known):
            return state
        new = {"n": len(known), "total": int(known.sum()), "low": int(known.min()), "high": int(known.max())}
        return self.merge(state, new)

    def merge(self, one: dict, other: dict) -> dict:
        if not one["n"] or not other["n"]:
            return one if one["n"] else other
        low, high = min(one["low"], other["low"]), max(one["high"], other["high"])
        return {"n": one["n"] + other["n"], "total": one["total"] + other["total"], "low": low, "high": high}

    def result(self, state: dict) -> float | None:
        if state["n"] < 3:
            return None
        return (state["total"] - state["low"] - state["high"]) / (state["n"] - 2)


def _groups(columns: Sequence[pa.Array]) -> Iterator[np.ndarray]:
    """Places of the rows of each group of equal keys, null equal to null."""
    code = np.zeros(len(columns[0]), np.int64)
    for column in columns:
        one = column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        _, code = np.unique(code * (int(one.max()) + 1) + one, return_inverse=True)
    order = np.argsort(code, kind="stable")
    yield from np.split(order, np.flatnonzero(np.diff(code[order])) + 1)


def _adding(accumulator: Accumulator, keys: int, schema: pa.Schema, held: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[tuple, Any] = {}

        def out() -> pa.RecordBatch:
            columns = [*zip(*states), list(states.values())]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            if not len(batch):
                continue
            names, inputs = batch.columns[:keys], batch.columns[keys:]
            for places in _groups(names):
                key = tuple(column[int(places[0])].as_py() for column in names)
                rows = pa.array(places)
                state = states[key] if key in states else accumulator.create()
                states[key] = accumulator.add(state, *[column.take(rows) for column in inputs])
                if len(states) >= held:
                    yield out()
                    states.clear()
        if states:
            yield out()

    return run


def _merging(accumulator: Accumulator, keys: int, schema: pa.Schema, last: bool) -> Callable:
    """Merge the states of each group of a sorted partition; tell the results if they are the last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, rows = None, None, []

        def done() -> tuple:
            return (*key, accumulator.result(state) if last else state)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for batch in batches:
            *names, states = [column.to_pylist() for column in batch.columns]
            for found, other in zip(zip(*names), states):
                if found == key:
                    state = accumulator.merge(state, other)
                else:
                    if key is not None:
                        rows.append(done())
                    key, state = found, other
            if rows:
                yield out()
                rows.clear()
        if key is not None:
            rows.append(done())
            yield out()

    return run


def accumulate(
    df: DataFrame,
    keys: Sequence[str],
    accumulator: Accumulator,
    inputs: Sequence[str],
    size: timedelta,
    slide: timedelta | None = None,
    out: str = "value",
    held: int = HELD,
) -> DataFrame:
    """``keys``, the window's end and the accumulator's result of the ``inputs`` columns, for each key and window.

    Rows without a time are left out. ``keys`` may be empty: one row for each window.
    """
    step = slide or size
    if millis(size) % millis(step):
        raise ValueError("the window size must be a multiple of the slide")
    pane = slot_start(F.col(TS_MS), millis(step)).alias(PANE)
    rows = df.where(F.col(TS_MS).isNotNull()).select(*keys, pane, *inputs)
    by_pane, by_window = [*keys, PANE], [*keys, WINDOW_END]

    def shape(group: Sequence[str], value: str, kind: T.DataType) -> T.StructType:
        first = [T.StructField(k, df.schema[k].dataType) for k in group[:-1]]
        return T.StructType([*first, T.StructField(group[-1], T.LongType()), T.StructField(value, kind)])

    def merged(states: DataFrame, group: Sequence[str], last: bool) -> DataFrame:
        made = shape(group, out if last else STATE, accumulator.output if last else accumulator.state)
        ready = states.repartition(*group).sortWithinPartitions(*group).select(*group, STATE)
        return ready.mapInArrow(_merging(accumulator, len(group), to_arrow_schema(made), last), made)

    partial = shape(by_pane, STATE, accumulator.state)
    states = rows.mapInArrow(_adding(accumulator, len(by_pane), to_arrow_schema(partial), held), partial)
    if step == size:
        whole = states.withColumn(WINDOW_END, F.col(PANE) + millis(size))
        return merged(whole, by_window, True)
    panes = merged(states, by_pane, False)
    copies = panes.select(*keys, F.explode(ends_of_pane(size, step)).alias(WINDOW_END), STATE)
    return merged(copies, by_window, True)
