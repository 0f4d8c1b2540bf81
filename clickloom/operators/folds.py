"""Rules that must see the rows of a key one after another.

A fold holds a small state and meets the rows of its key in order. Spark shuffles and
sorts the rows; the Python side walks each partition once, batch by batch, and keeps
only the current state, so no group is ever held whole. Before that, keys are cut where a
fold starts afresh, by window functions that run per time slice: failure rules between
successes (the timer rule also at pauses), pairing at pauses. Order cycles are folded per time
slice for each state that a slice may begin in, and the slices' results are chained per key.
"""

from __future__ import annotations

import sys
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from datetime import timedelta

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from clickloom.functions.time import TS_MS, millis
from clickloom.operators import lifecycle
from clickloom.operators.hotkeys import SLICE, WIDTH, cut_by_time, running, with_preceding
from clickloom.operators.matching import (
    LEFT,
    MATCHED,
    SIDE,
    UNMATCHED_LEFT,
    UNMATCHED_RIGHT,
    connect,
)
from clickloom.session import stored

# Workers need not have the package installed: its functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules["clickloom"])

TAG = "_tag"


class AnchoredFailures:
    """Alerts whenever a failure and the oldest kept one are within the span, ``times`` kept at least.

    An alert keeps the list, so the next failure alerts again from the same first one. When
    the oldest is too old, it and the current failure are both dropped.
    """

    outputs = ("first_ts_ms", "last_ts_ms")

    def __init__(self, times: int, within_ms: int):
        self.times, self.within = times, within_ms

    def start(self, state: list[int]) -> None:
        self.kept = deque(state)

    def step(self, ts: int, seq: int, tag: int) -> list[tuple]:
        if not tag:
            self.kept.clear()
            return []
        if len(self.kept) + 1 < self.times:
            self.kept.append(ts)
            return []
        first = self.kept[0] if self.kept else ts
        if ts - first <= self.within:
            self.kept.append(ts)
            return [(first, ts)]
        self.kept.popleft()
        return []

    def deadline(self) -> int | None:
        return None

    def expire(self, now: int) -> list[tuple]:
        return []

    def state(self) -> list[int]:
        return list(self.kept)

    def finish(self) -> list[tuple]:
        return []


class TimerFailures:
    """A first failure opens a span; at its end ``times`` failures or more alert once.

    Anything but a failure within the span discards it.
    """

    outputs = ("first_ts_ms", "last_ts_ms", "fails")

    def __init__(self, times: int, within_ms: int):
        self.times, self.within = times, within_ms

    def start(self, state: list[int]) -> None:
        self.slot = tuple(state)

    def step(self, ts: int, seq: int, tag: int) -> list[tuple]:
        closed = []
        if self.slot and ts > self.slot[0] + self.within:
            closed = self.finish()
        if not tag:
            self.slot = ()
        elif self.slot:
            self.slot = (self.slot[0], ts, self.slot[2] + 1)
        else:
            self.slot = (ts, ts, 1)
        return closed

    def deadline(self) -> int | None:
        return self.slot[0] + self.within if self.slot else None

    def expire(self, now: int) -> list[tuple]:
        return self.finish() if self.slot and self.slot[0] + self.within <= now else []

    def state(self) -> list[int]:
        return list(self.slot)

    def finish(self) -> list[tuple]:
        slot, self.slot = self.slot, ()
        return [slot] if slot and slot[2] >= self.times else []


class ConsecutiveRun:
    """Every ``times`` failures in a row within the span; runs overlap. The stream form of a lag."""

    outputs = ("first_ts_ms", "last_ts_ms")

    def __init__(self, times: int, within_ms: int, inclusive: bool):
        self.times, self.limit = times, within_ms + (1 if inclusive else 0)

    def start(self, state: list[int]) -> None:
        self.run = deque(state, maxlen=self.times)

    def step(self, ts: int, seq: int, tag: int) -> list[tuple]:
        if not tag:
            self.run.clear()
            return []
        self.run.append(ts)
        full = len(self.run) == self.times
        return [(self.run[0], ts)] if full and ts - self.run[0] < self.limit else []

    def deadline(self) -> int | None:
        return self.run[0] + self.limit if self.run else None

    def expire(self, now: int) -> list[tuple]:
        while self.run and self.run[0] + self.limit <= now:
            self.run.popleft()
        return []

    def state(self) -> list[int]:
        return list(self.run)

    def finish(self) -> list[tuple]:
        return []


class StrictSequence:
    """Adjacent rows that meet the steps in turn, within a span. Bit ``k`` of a tag: the row meets step ``k``."""

    outputs = ("first_ts_ms", "last_ts_ms")

    def __init__(self, steps: int, limit_ms: int):
        self.steps, self.limit = steps, limit_ms

    def start(self, state: list[int]) -> None:
        self.recent = deque(zip(state[::2], state[1::2]), maxlen=self.steps)

    def step(self, ts: int, seq: int, tag: int) -> list[tuple]:
        self.recent.append((ts, tag))
        met = len(self.recent) == self.steps and all(t >> k & 1 for k, (_, t) in enumerate(self.recent))
        first = self.recent[0][0]
        return [(first, ts)] if met and ts - first < self.limit else []

    def deadline(self) -> int | None:
        return self.recent[0][0] + self.limit if self.recent else None

    def expire(self, now: int) -> list[tuple]:
        while self.recent and self.recent[0][0] + self.limit <= now:
            self.recent.popleft()
        return []

    def state(self) -> list[int]:
        return [v for pair in self.recent for v in pair]

    def finish(self) -> list[tuple]:
        return []


class FifoPairs:
    """Pairs each row with the oldest row of the other side that still waits for it.

    A left row waits ``after``, a right row ``before``; then it leaves unpaired. Only one
    side waits at any time, and only rows within the span.
    """

    outputs = ("code", "left_seq", "right_seq")
    PAIR, LONE_LEFT, LONE_RIGHT = 0, 1, 2

    def __init__(self, before_ms: int, after_ms: int):
        self.patience = {1: after_ms, 0: before_ms}

    def start(self, state: list[int]) -> None:
        self.side = state[0] if state else 1
        self.waiting = deque(zip(state[1::2], state[2::2]))

    def step(self, ts: int, seq: int, tag: int) -> list[tuple]:
        out = []
        while self.waiting and ts - self.waiting[0][0] > self.patience[self.side]:
            out.append(self._lone(self.waiting.popleft()[1]))
        if self.waiting and self.side != tag:
            other = self.waiting.popleft()[1]
            out.append((self.PAIR, seq, other) if tag else (self.PAIR, other, seq))
        else:
            self.side = tag
            self.waiting.append((ts, seq))
        return out

    def deadline(self) -> int | None:
        return self.waiting[0][0] + self.patience[self.side] if self.waiting else None

    def expire(self, now: int) -> list[tuple]:
        out = []
        while self.waiting and self.waiting[0][0] + self.patience[self.side] <= now:
            out.append(self._lone(self.waiting.popleft()[1]))
        return out

    def _lone(self, seq: int) -> tuple:
        return (self.LONE_LEFT, seq, None) if self.side else (self.LONE_RIGHT, None, seq)

    def state(self) -> list[int]:
        return [self.side, *[v for pair in self.waiting for v in pair]] if self.waiting else []

    def finish(self) -> list[tuple]:
        return [self._lone(self.waiting.popleft()[1]) for _ in range(len(self.waiting))]


class FollowedBy:
    """Begin rows (tag bit 1) that wait for the first end row (tag bit 2), or for their time to run out."""

    outputs = ("begin_ms", "end_ms")

    def __init__(self, within_ms: int):
        self.within = within_ms

    def start(self, state: list[int]) -> None:
        self.waiting = deque(state)

    def step(self, ts: int, seq: int, tag: int) -> list[tuple]:
        found = []
        if tag & 2:
            found = [(t, ts if ts - t < self.within else None) for t in self.waiting]
            self.waiting.clear()
        if tag & 1:
            self.waiting.append(ts)
        return found

    def deadline(self) -> int | None:
        return self.waiting[0] + self.within if self.waiting else None

    def expire(self, now: int) -> list[tuple]:
        found = []
        while self.waiting and self.waiting[0] + self.within <= now:
            found.append((self.waiting.popleft(), None))
        return found

    def state(self) -> list[int]:
        return list(self.waiting)

    def finish(self) -> list[tuple]:
        return self.expire(2**63)


class OrderCycles:
    """Create and pay events matched in turn; a key may run through several cycles.

    A stream gives up on a waiting event at the end of its span, or after ``keep_ms`` if that is
    longer; until then a pay that comes too late still finds its create.
    """

    outputs = ("code", "create_ms", "pay_ms")
    PAID, PAID_LATE, NEVER_PAID, NEVER_CREATED = 0, 1, 2, 3

    def __init__(self, within_ms: int, max_early_ms: int | None, keep_ms: int = 0):
        self.within, self.max_early, self.keep = within_ms, max_early_ms, keep_ms

    def start(self, state: list[int]) -> None:
        self.waiting = tuple(state)

    def step(self, ts: int, seq: int, tag: int) -> list[tuple]:
        if not self.waiting:
            self.waiting = (tag, ts)
            return []
        kind, since = self.waiting
        if kind == tag:
            return []
        self.waiting = ()
        if tag == 0:
            return [(self.PAID if ts < since + self.within else self.PAID_LATE, since, ts)]
        if self.max_early is None or ts - since <= self.max_early:
            return [(self.PAID, ts, since)]
        self.waiting = (tag, ts)
        return [(self.NEVER_CREATED, None, since)]

    def deadline(self) -> int | None:
        if not self.waiting:
            return None
        kind, since = self.waiting
        return since + max(self.keep, self.within if kind else self.max_early or 0)

    def expire(self, now: int) -> list[tuple]:
        end = self.deadline()
        return self.finish() if end is not None and end <= now else []

    def state(self) -> list[int]:
        return list(self.waiting)

    def finish(self) -> list[tuple]:
        if not self.waiting:
            return []
        kind, since = self.waiting
        self.waiting = ()
        return [(self.NEVER_PAID, since, None) if kind else (self.NEVER_CREATED, None, since)]


class SliceCycles:
    """:class:`OrderCycles` over one time slice of a key, for each state in which the slice may begin.

    Beginnings: nothing waits; a create waits; a pay waits that the first create finds in time; a
    pay waits that it finds too late. Since when the old event waits is not known here, so a
    beginning is only resolved by the time of its first unlike row. Rows come out as (beginning,
    kind, code, create, pay): of kind ``RESULT``, or one ``SUMMARY`` each with code = the tag that
    waits at the end or null, create = its time, or null if the old event still waits, pay = the
    resolving time.
    """

    outputs = ("beginning", "kind", "code", "create_ms", "pay_ms")
    NOTHING, CREATE, PAY_IN_TIME, PAY_LATE = range(4)
    RESULT, SUMMARY = 0, 1

    def __init__(self, within_ms: int, max_early_ms: int | None):
        self.folds = [OrderCycles(within_ms, max_early_ms) for _ in range(4)]

    def start(self, state: list[int]) -> None:
        self.resolved: list[int | None] = [0, None, None, None]
        for fold in self.folds:
            fold.start([])

    def step(self, ts: int, seq: int, tag: int) -> list[tuple]:
        out = []
        for beginning, fold in enumerate(self.folds):
            if self.resolved[beginning] is None:
                old = 1 if beginning == self.CREATE else 0
                if tag != old:
                    self.resolved[beginning] = ts
                    if beginning == self.PAY_LATE:
                        fold.waiting = (tag, ts)
                continue
            out += [(beginning, self.RESULT, *found) for found in fold.step(ts, seq, tag)]
        return out

    def finish(self) -> list[tuple]:
        out = []
        for beginning, fold in enumerate(self.folds):
            old = beginning != self.NOTHING and self.resolved[beginning] is None
            tag, since = (None, None) if old or not fold.waiting else fold.waiting
            if old:
                tag = 1 if beginning == self.CREATE else 0
            out.append((beginning, self.SUMMARY, tag, since, self.resolved[beginning]))
        return out


class ChainedCycles:
    """The slices of a key in turn: from the summaries, which beginning was true, and what crosses slices.

    Tags are beginnings in order; a step gets (slice, beginning, code, create, pay) of a summary.
    Rows come out as (slice, beginning, code, create, pay): slice null for results that cross slices,
    code null for the true beginning of a slice.
    """

    outputs = ("slice", "beginning", "code", "create_ms", "pay_ms")

    def __init__(self, within_ms: int, max_early_ms: int | None):
        self.fold = OrderCycles(within_ms, max_early_ms)

    def start(self) -> None:
        self.fold.start([])
        self.held: dict[int, tuple] = {}

    def step(self, number: int, beginning: int, code: int | None, create: int | None, pay: int | None) -> list[tuple]:
        self.held[beginning] = (code, create, pay)
        return self._met(number) if len(self.held) == 4 else []

    def _met(self, number: int) -> list[tuple]:
        held, self.held = self.held, {}
        true, out = SliceCycles.NOTHING, []
        if self.fold.waiting:
            kind, _ = self.fold.waiting
            true = SliceCycles.CREATE if kind else SliceCycles.PAY_IN_TIME
            resolved = held[true][2]
            if resolved is not None:
                found = self.fold.step(resolved, 0, 1 - kind)
                if self.fold.waiting:
                    true = SliceCycles.PAY_LATE
                out += [(None, None, *row) for row in found]
        tag, since, _ = held[true]
        if since is not None or tag is None:
            self.fold.waiting = () if tag is None else (tag, since)
        return [*out, (number, true, None, None, None)]

    def finish(self) -> list[tuple]:
        return [(None, None, *row) for row in self.fold.finish()]


def _walker(make: Callable, keys: int, schema: pa.Schema, started: bool = True) -> Callable:
    """The function that folds one sorted partition. Columns: the keys, then what a step takes."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, key = make(), None
        rows: list[tuple] = []
        for batch in batches:
            columns = [column.to_pylist() for column in batch.columns]
            for found, event in zip(zip(*columns[:keys]), zip(*columns[keys:])):
                if found != key:
                    if key is not None:
                        rows.extend((*key, *out) for out in fold.finish())
                    key = found
                    fold.start(*([[]] if started else []))
                rows.extend((*key, *out) for out in fold.step(*event))
            if rows:
                yield _batch(rows, schema)
                rows.clear()
        if key is not None:
            rows.extend((*key, *out) for out in fold.finish())
        if rows:
            yield _batch(rows, schema)

    return walk


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema
    )


def ordered_fold(
    rows: DataFrame, keys: Sequence[str], seq: str, make: Callable, outputs: Sequence[str]
) -> DataFrame:
    """Fold the rows (keys, ``ts_ms``, ``seq``, ``_tag``) of each key in time order.

    Rows at the same time come with the higher tag first, then by ``seq``. Rows without a time are left out.
    """
    schema = T.StructType(
        [rows.schema[k] for k in keys] + [T.StructField(o, T.LongType()) for o in outputs]
    )
    order = [F.asc(TS_MS), F.desc(TAG), F.asc(seq)]
    timed = rows.where(F.col(TS_MS).isNotNull())
    # The window only asks for rows clustered by key; if they already are, nothing moves.
    clustered = timed.withColumn(
        "_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    ).where(F.col("_n") > 0)
    ready = clustered.sortWithinPartitions(*keys, *order).select(*keys, TS_MS, seq, TAG)
    return ready.mapInArrow(_walker(make, len(keys), to_arrow_schema(schema)), schema)


def failure_pieces(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    fail: Column,
    times: int,
    pause_ms: int | None = None,
    width: timedelta = WIDTH,
) -> DataFrame:
    """Runs of failures with the row that ends each, numbered as ``_piece``; runs under ``times`` failures are left out.

    A non-failure resets every failure rule, so runs are independent of each other. A rule that
    forgets after ``pause_ms`` is also cut at longer pauses.
    """
    order = [TS_MS, seq]
    rows = df.select(*keys, TS_MS, seq, fail.cast("bigint").alias(TAG))
    ended = 1 - F.col(TAG)
    if pause_ms is None:
        # The row that ends a run still belongs to it.
        pieces = running(rows, keys, order, ended, "_ended", F.sum, width)
        pieces = pieces.withColumn("_piece", F.col("_ended") - ended).drop("_ended")
    else:

        def look_back(spec):
            return {"_tag_before": F.lag(TAG).over(spec), "_time_before": F.lag(TS_MS).over(spec)}

        rows = with_preceding(rows, keys, order, 1, look_back, width)
        fresh = (F.col("_tag_before") == 0) | (F.col(TS_MS) - F.col("_time_before") > pause_ms)
        starts = F.coalesce(fresh, F.lit(False)).cast("bigint")
        # A non-failure after a non-failure ends nothing.
        pieces = running(rows, keys, order, starts, "_piece", F.sum, width)
        pieces = pieces.where((F.col(TAG) == 1) | (F.col("_tag_before") == 1)).drop("_tag_before", "_time_before")
    # The fold needs a piece's rows together anyway, so counting them there moves nothing.
    fails = F.sum(TAG).over(Window.partitionBy(*keys, "_piece"))
    return pieces.withColumn("_fails", fails).where(F.col("_fails") >= times).drop("_fails")


def anchored_failures(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    fail: Column,
    times: int,
    within: timedelta,
    width: timedelta = WIDTH,
) -> DataFrame:
    """Alerts of :class:`AnchoredFailures`: keys, first and last time. One run of failures is one task."""
    runs = failure_pieces(df, keys, seq, fail, times, None, width)
    span = millis(within)
    found = ordered_fold(
        runs, [*keys, "_piece"], seq, lambda: AnchoredFailures(times, span), AnchoredFailures.outputs
    )
    return found.drop("_piece")


def timer_failures(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    fail: Column,
    times: int,
    within: timedelta,
    width: timedelta = WIDTH,
) -> DataFrame:
    """Alerts of :class:`TimerFailures`: keys, first and last time, number of failures."""
    span = millis(within)
    runs = failure_pieces(df, keys, seq, fail, times, span, width)
    found = ordered_fold(
        runs, [*keys, "_piece"], seq, lambda: TimerFailures(times, span), TimerFailures.outputs
    )
    return found.drop("_piece")


def quiet_spells(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], silence_ms: int, width: timedelta = WIDTH
) -> DataFrame:
    """Number the stretches of each key between pauses longer than ``silence_ms`` as ``_spell``."""
    rows = with_preceding(df, keys, order, 1, lambda spec: {"_before": F.lag(order[0]).over(spec)}, width)
    starts = (F.col(order[0]) - F.col("_before") > silence_ms).cast("bigint")
    rows = running(rows, keys, order, F.coalesce(starts, F.lit(0)), "_spell", F.sum, width)
    return rows.drop("_before")


def pair_one_to_one(
    left: DataFrame,
    right: DataFrame,
    on: str,
    seq: str,
    before: timedelta,
    after: timedelta,
    width: timedelta = WIDTH,
) -> DataFrame:
    """Each row in at most one pair, first come first served: key, ``left_seq``, ``right_seq``, ``outcome``.

    After a pause longer than any row waits nobody waits, so what follows stands alone.
    """
    rows = connect(left.select(on, TS_MS, seq), right.select(on, TS_MS, seq))
    rows = rows.select(on, TS_MS, seq, (F.col(SIDE) == LEFT).cast("bigint").alias(TAG))
    low, high = millis(before), millis(after)
    spells = quiet_spells(rows, [on], [TS_MS, TAG, seq], max(low, high), width)
    found = ordered_fold(spells, [on, "_spell"], seq, lambda: FifoPairs(low, high), FifoPairs.outputs)
    names = [MATCHED, UNMATCHED_LEFT, UNMATCHED_RIGHT]
    return found.select(on, "left_seq", "right_seq", _named("code", names).alias("outcome"))


def order_cycles(
    df: DataFrame,
    order: str,
    seq: str,
    create: Column,
    pay: Column,
    within: timedelta,
    max_early: timedelta | None = None,
    width: timedelta = WIDTH,
) -> DataFrame:
    """Every create/pay cycle of each order with its outcome, for orders with repeated events.

    Each (order, time slice) is folded by itself, once for each state it may begin in; the slices'
    short summaries are then chained per order, which tells the true states.
    """
    tag = F.when(create, F.lit(1)).when(pay, F.lit(0)).cast("bigint")
    rows = df.select(order, TS_MS, seq, tag.alias(TAG)).where(F.col(TAG).isNotNull() & F.col(TS_MS).isNotNull())
    span, early = millis(within), None if max_early is None else millis(max_early)
    sliced = cut_by_time(rows, [order], TS_MS, width)
    # Both the summaries and the results are read from it, and the fold is the dear part.
    folded = stored(ordered_fold(sliced.df, sliced.group, seq, lambda: SliceCycles(span, early), SliceCycles.outputs))
    summaries = folded.where(F.col("kind") == SliceCycles.SUMMARY).drop("kind")
    schema = T.StructType([rows.schema[order]] + [T.StructField(o, T.LongType()) for o in ChainedCycles.outputs])
    by_slice = [order, SLICE, "beginning"]
    clustered = summaries.repartition(order).sortWithinPartitions(*by_slice).select(*by_slice, *OrderCycles.outputs)
    walker = _walker(lambda: ChainedCycles(span, early), 1, to_arrow_schema(schema), started=False)
    chained = stored(clustered.mapInArrow(walker, schema))
    true = chained.where(F.col("slice").isNotNull()).select(
        F.col(order).alias("_order"), F.col("slice").alias("_number"), F.col("beginning").alias("_true")
    )
    results = folded.where(F.col("kind") == SliceCycles.RESULT)
    same = (
        results[order].eqNullSafe(true["_order"])
        & (results[SLICE] == true["_number"])
        & (results["beginning"] == true["_true"])
    )
    inside = results.join(true, same).select(order, *OrderCycles.outputs)
    found = inside.unionByName(chained.where(F.col("slice").isNull()).select(order, *OrderCycles.outputs))
    names = [lifecycle.PAID, lifecycle.PAID_LATE, lifecycle.NEVER_PAID, lifecycle.NEVER_CREATED]
    states = found.select(order, "create_ms", "pay_ms", _named("code", names).alias("result_state"))
    return lifecycle.with_output(states)


def _named(code: str, names: Sequence[str]) -> Column:
    chosen = F.when(F.col(code) == 0, names[0])
    for number, name in enumerate(names[1:], start=1):
        chosen = chosen.when(F.col(code) == number, name)
    return chosen
