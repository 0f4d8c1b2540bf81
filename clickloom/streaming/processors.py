"""Keyed stateful processors for rules that built-in streaming operators cannot express.

Rows are held in state until the watermark has passed them, and are then met in the order of
event time, so the result does not depend on how they were split into micro-batches or on their
order of arrival within the watermark's delay. What a key holds is the rows of that delay and its
rule's small memory, which goes when no later row can need it.
"""

from __future__ import annotations

import heapq
import itertools
import sys
from collections.abc import Iterator, Sequence
from datetime import timedelta

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from clickloom.functions.hashing import poly_hash
from clickloom.functions.time import TS, TS_MS, calendar_day, millis, slot_start
from clickloom.operators import lifecycle
from clickloom.operators.folds import (
    AnchoredFailures,
    ConsecutiveRun,
    FifoPairs,
    FollowedBy,
    OrderCycles,
    StrictSequence,
    TimerFailures,
)
from clickloom.operators.matching import LEFT, MATCHED, SIDE, UNMATCHED_LEFT, UNMATCHED_RIGHT
from clickloom.operators.patterns import TIMED_OUT
from clickloom.operators.ratelimit import PASSED, WARNING
from clickloom.operators.windows import WINDOW_END

cloudpickle.register_pickle_by_value(sys.modules["clickloom"])

LONGS = T.StructType([T.StructField("values", T.ArrayType(T.LongType()))])
NUMBER = T.StructType([T.StructField("number", T.LongType())])
BY_SEQ, BY_TAG = "seq", "tag"
# Rows of the first and of the largest chunks, rows sorted at once while they come in, rows handed to a rule at once.
FIRST, CHUNK, PIECE, SLICE = 16, 128, 8192, 1024
# As many waiting rows of a key need no chunk.
FEW = 8


class InEventTime(StatefulProcessor):
    """Meets each key's rows in event time.

    Rows wait in chunks sorted by time, each an entry of a map. The index lists the chunks' first
    times, so that a timer reads the chunks that hold due rows and no others. What is left of a
    chunk that the watermark has reached goes into new chunks, which no longer overlap in time. A row
    is therefore read as often as the watermark stops inside its chunk, however long rows wait, and
    memory holds the chunks that overlap, however many rows are due. Every call to the state costs more
    than a row, so ``FEW`` rows wait beside the rule's memory, which is read anyway: a key with so few has no chunks
    and no index. They are read again each time the key is looked at.

    ``held`` is the schema of what a row keeps while it waits. A row's place among those of the
    same time is by ``seq``, or by the higher tag and then ``seq``.
    """

    def __init__(self, held: T.StructType, ties: str = BY_SEQ):
        self.held, self.ties = held, ties
        self.at = held.names.index(TS_MS)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        rows = T.StructType([T.StructField("rows", T.ArrayType(self.held))])
        self.memory = handle.getValueState("memory", T.StructType([*LONGS, *rows]))
        self.index = handle.getValueState("index", LONGS)
        self.waiting = handle.getMapState("waiting", NUMBER, rows)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known, few, number, chunks = self._load()
        earliest, had, before = self._earliest(few, chunks), number, len(chunks)
        piece = few
        for row in rows:
            piece.append(tuple(row[name] for name in self.held.names))
            if len(piece) == PIECE:
                number = self._keep(piece, number, chunks)
                piece = []
        few, number = self._wait(piece, number, chunks)
        self._store(known, few, number, chunks, number != had, before)
        first = self._earliest(few, chunks)
        if first is not None and (earliest is None or first < earliest):
            self.handle.registerTimer(first)
        return iter(())

    def _load(self) -> tuple[list[int], list[tuple], int, list[tuple[int, int]]]:
        """The rule's memory, the few rows beside it, the next chunk's number, and (first time, number) of the chunks in order of time."""
        if not self.memory.exists():
            return [], [], 0, []
        (indexed, *known), few = self.memory.get()
        number, *flat = self.index.get()[0] if indexed else (0,)
        return known, [tuple(values) for values in few], number, list(zip(flat[::2], flat[1::2]))

    def _store(self, known: list[int], few: list[tuple], number: int, chunks: list[tuple[int, int]], changed: bool, before: int) -> None:
        """The other way round; ``before`` says how many chunks there were, ``changed`` whether others have come."""
        if chunks and (changed or len(chunks) != before):
            self.index.update(([number, *(v for c in chunks for v in c)],))
        elif before and not chunks:
            self.index.clear()
        if known or few or chunks:
            self.memory.update(([int(bool(chunks)), *(int(v) for v in known)], few))
        else:
            self.memory.clear()

    def _earliest(self, few: list[tuple], chunks: list[tuple[int, int]]) -> int | None:
        return min([c[0] for c in chunks[:1]] + [values[self.at] for values in few], default=None)

    def _wait(self, rows: list[tuple], number: int, chunks: list[tuple[int, int]]) -> tuple[list[tuple], int]:
        """Let rows wait, in chunks unless they are few; gives those few and the next number."""
        if len(rows) <= FEW:
            return rows, number
        return [], self._keep(rows, number, chunks)

    def _keep(self, rows: list[tuple], number: int, chunks: list[tuple[int, int]]) -> int:
        """Let rows wait in new chunks, small ones for the rows that are due next; gives the next number."""
        rows.sort(key=lambda r: r[self.at])
        low, size = 0, CHUNK if len(rows) <= 2 * FIRST else FIRST
        while low < len(rows):
            part = rows[low : low + size]
            low, size = low + size, min(2 * size, CHUNK)
            self.waiting.updateValue((number,), (part,))
            chunks.append((part[0][self.at], number))
            number += 1
        chunks.sort()
        return number

    def _place(self, row: dict) -> tuple:
        return (row[TS_MS], -row["_tag"] if self.ties == BY_TAG else 0, row["seq"])

    def _due(self, few: list[tuple], chunks: list[tuple[int, int]], now: int, later: list[tuple]) -> Iterator[dict]:
        """The rows up to ``now`` in order; chunks are taken out as they are reached, and what is later in them is set aside."""
        ahead: list[tuple] = []
        loaded = 0

        def load(rows: Sequence) -> None:
            nonlocal loaded
            for values in rows:
                if values[self.at] > now:
                    later.append(tuple(values))
                    continue
                row = dict(zip(self.held.names, values))
                heapq.heappush(ahead, (self._place(row), loaded, row))
                loaded += 1

        load(few)
        while True:
            while chunks and chunks[0][0] <= now and (not ahead or chunks[0][0] <= ahead[0][0][0]):
                _, number = chunks.pop(0)
                load(self.waiting.getValue((number,))[0])
                self.waiting.removeKey((number,))
            if not ahead:
                return
            yield heapq.heappop(ahead)[2]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        known, few, number, chunks = self._load()
        state = self.recalled(known)
        had, before, later = number, len(chunks), []
        due = self._due(few, chunks, now, later)
        rows = list(itertools.islice(due, SLICE))
        while True:
            following = list(itertools.islice(due, SLICE))
            # Up to just before a slice's last time, all rows have been met.
            upto = rows[-1][TS_MS] - 1 if following else now
            found, state, deadline = self.meet(key, rows, state, upto)
            yield from found
            if not following:
                break
            rows = following
        few, number = self._wait(later, number, chunks)
        self._store(self.remembered(state, known), few, number, chunks, number != had, before)
        nexts = [t for t in (self._earliest(few, chunks), deadline) if t is not None]
        if nexts:
            self.handle.registerTimer(min(nexts))

    def recalled(self, known: list[int]):  # type: ignore[no-untyped-def]
        """The rule's state, from the numbers that were kept."""
        return known

    def remembered(self, state, known: list[int]) -> list[int]:  # type: ignore[no-untyped-def]
        """The numbers to keep of the rule's state; ``known`` are those it came from."""
        return state

    def meet(self, key, rows: list[dict], state: list[int], now: int) -> tuple[list[Row], list[int], int | None]:
        """Results of the rows and of what ran out by ``now``, the new state, and when to look again."""
        raise NotImplementedError

    def close(self) -> None:
        pass


class Folded(InEventTime):
    """A fold of :mod:`clickloom.operators.folds` kept alive between micro-batches."""

    def __init__(self, rule, held: T.StructType, names: Sequence[str], ties: str):
        super().__init__(held, ties)
        self.rule, self.names = rule, list(names)

    def meet(self, key, rows, state, now):
        self.rule.start(state)
        found = []
        for row in rows:
            found += self.rule.step(row[TS_MS], row["seq"], row["_tag"])
        found += self.rule.expire(now)
        out = [Row(**dict(zip(self.names, (*key, *values)))) for values in found]
        return out, self.rule.state(), self.rule.deadline()


class ClickCap(InEventTime):
    """Daily cap for the keys of a bucket: state is the rows counted for each key on each day, which goes when the watermark ends the day.

    What Spark asks of a processor for one key costs as much as very many rows, so keys come in buckets.
    """

    def __init__(self, cap: int, held: T.StructType, keys: Sequence[str]):
        super().__init__(held)
        self.cap, self.keys = cap, list(keys)

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        kinds = [self.held[k].dataType for k in self.keys] + [T.LongType(), T.LongType()]
        self.days = handle.getValueState("days", T.StructType([T.StructField(f"_{n}", T.ArrayType(kind)) for n, kind in enumerate(kinds)]))

    def recalled(self, known):
        """Rows counted by key and end of the day."""
        return {tuple(map(_same, key)): n for *key, n in zip(*self.days.get())} if known else {}

    def remembered(self, state, known):
        if state:
            self.days.update(tuple(map(list, zip(*((*key, n) for key, n in state.items())))))
        elif known:
            self.days.clear()
        return [1] if state else []

    def meet(self, key, rows, state, now):
        out = []
        for row in rows:
            day = (*(_same(row[k]) for k in self.keys), row["_day_end"])
            state[day] = n = state.get(day, 0) + 1
            if n <= self.cap + 2:
                values = {k: v for k, v in row.items() if k != "_day_end"}
                out.append(Row(**values, outcome=PASSED if n <= self.cap + 1 else WARNING))
        state = {day: n for day, n in state.items() if day[-1] > now}
        return out, state, min((day[-1] for day in state), default=None)


_NAN = float("nan")


def _same(value):  # type: ignore[no-untyped-def]
    """A value that is equal to and found by what Spark takes for the same key."""
    if isinstance(value, float) and value != value:
        return _NAN
    if isinstance(value, list):
        return tuple(map(_same, value))
    return bytes(value) if isinstance(value, bytearray) else value


class FirstVisits(InEventTime):
    """The rows that set a bit of their key's bitmap first. Words of the bitmap are entries of a map, which goes at the key's end.

    The first part of the key is the end of its window; ``_offset`` is a row's bit.
    """

    WORD = 32

    def __init__(self, held: T.StructType, key_names: Sequence[str]):
        super().__init__(held)
        self.key_names = list(key_names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.words = handle.getMapState("words", NUMBER, NUMBER)

    def meet(self, key, rows, state, now):
        words, changed, out = {}, set(), []
        for row in rows:
            word, bit = divmod(row["_offset"], self.WORD)
            if word not in words:
                found = self.words.getValue((word,)) if self.words.containsKey((word,)) else (0,)
                words[word] = found[0]
            if not words[word] >> bit & 1:
                words[word] |= 1 << bit
                changed.add(word)
                out.append(Row(**dict(zip(self.key_names, key)), **{k: v for k, v in row.items() if k != "_offset"}))
        if now >= key[0]:
            self.words.clear()
            return out, [], None
        for word in changed:
            self.words.updateValue((word,), (words[word],))
        return out, [1], key[0]


def _schema(df: DataFrame, names: Sequence[str], **added: T.DataType) -> T.StructType:
    return T.StructType(
        [df.schema[n] for n in names] + [T.StructField(n, kind) for n, kind in added.items()]
    )


def _run(
    df: DataFrame,
    keys: Sequence[str],
    processor: StatefulProcessor,
    schema: T.StructType,
    event_time: str = "",
) -> DataFrame:
    """Run a processor. Naming the output's event time lets another windowed operator follow."""
    return df.groupBy(*keys).transformWithState(
        processor, schema, "Append", "EventTime", eventTimeColumnName=event_time
    )


def _fold(
    rows: DataFrame, source: DataFrame, keys: Sequence[str], rule, ties: str, outputs: Sequence[str]
) -> DataFrame:
    held = _schema(rows, [TS_MS, "seq", "_tag"])
    schema = _schema(source, keys, **{o: T.LongType() for o in outputs})
    return _run(rows, keys, Folded(rule, held, schema.names, ties), schema)


def stream_daily_cap(df: DataFrame, keys: Sequence[str], cap: int, zone: str = "UTC", buckets: int = 1024) -> DataFrame:
    """Stream form of :func:`clickloom.operators.ratelimit.daily_cap`; windows may follow on its ``ts``.

    Keys are dealt over so many ``buckets``: the most tasks that share the work.
    """
    names = df.columns
    day = F.date_add(F.lit("1970-01-01").cast("date"), calendar_day(F.col(TS_MS), zone) + 1)
    midnight = F.convert_timezone(F.lit(zone), F.lit("UTC"), day.cast("timestamp_ntz"))
    end = F.timestamp_diff("MILLISECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), midnight)
    rows = df.withColumn("_day_end", end)
    held = _schema(rows, rows.columns)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("_bucket")
    rows = rows.select("*", bucket)
    return _run(rows, ["_bucket"], ClickCap(cap, held, keys), _schema(df, names, outcome=T.StringType()), TS)


def stream_failures(
    df: DataFrame,
    keys: Sequence[str],
    fail: Column,
    times: int,
    within: timedelta,
    rule: str = "anchored",
    inclusive: bool = False,
) -> DataFrame:
    """Stream form of the failure rules: ``anchored``, ``timer`` or ``consecutive``.

    The anchored rule keeps its list until a success, as it must; the others forget with the watermark.
    """
    span = millis(within)
    rows = df.select(*keys, TS, TS_MS, "seq", fail.cast("bigint").alias("_tag"))
    if rule == "consecutive":
        return _fold(rows, df, keys, ConsecutiveRun(times, span, inclusive), BY_SEQ, ConsecutiveRun.outputs)
    kind = {"anchored": AnchoredFailures, "timer": TimerFailures}[rule]
    return _fold(rows, df, keys, kind(times, span), BY_TAG, kind.outputs)


def stream_sequence(
    df: DataFrame, keys: Sequence[str], steps: Sequence[Column], within: timedelta, inclusive: bool = False
) -> DataFrame:
    """Stream form of :func:`clickloom.operators.patterns.strict_sequence`: first and last time of each match."""
    met = F.lit(0).cast("bigint")
    for k, step in enumerate(steps):
        met = met + F.when(F.coalesce(step, F.lit(False)), 1 << k).otherwise(0)
    rows = df.select(*keys, TS, TS_MS, "seq", met.alias("_tag"))
    rule = StrictSequence(len(steps), millis(within) + (1 if inclusive else 0))
    return _fold(rows, df, keys, rule, BY_SEQ, StrictSequence.outputs)


def stream_followed_by(
    df: DataFrame, keys: Sequence[str], begin: Column, end: Column, within: timedelta
) -> DataFrame:
    """Stream form of :func:`clickloom.operators.patterns.followed_by`."""
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("bigint")
    rows = df.select(*keys, TS, TS_MS, "seq", (flag(begin) + 2 * flag(end)).alias("_tag")).where("_tag > 0")
    found = _fold(rows, df, keys, FollowedBy(millis(within)), BY_SEQ, FollowedBy.outputs)
    outcome = F.when(F.col("end_ms").isNotNull(), MATCHED).otherwise(TIMED_OUT)
    return found.select(*keys, "begin_ms", "end_ms", outcome.alias("outcome"))


def stream_order_lifecycle(
    df: DataFrame,
    order: str,
    create: Column,
    pay: Column,
    within: timedelta,
    max_early: timedelta,
    keep: timedelta = timedelta(0),
) -> DataFrame:
    """Stream form of the order lifecycle, timeouts included.

    With ``keep`` an event waits longer for its counterpart than its span, so that what comes
    too late is told apart from what never comes.
    """
    tag = F.when(create, F.lit(1)).when(pay, F.lit(0)).cast("bigint")
    rows = df.select(order, TS, TS_MS, "seq", tag.alias("_tag")).where(F.col("_tag").isNotNull())
    rule = OrderCycles(millis(within), millis(max_early), millis(keep))
    found = _fold(rows, df, [order], rule, BY_TAG, OrderCycles.outputs)
    names = [lifecycle.PAID, lifecycle.PAID_LATE, lifecycle.NEVER_PAID, lifecycle.NEVER_CREATED]
    state = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("code") + 1).cast("int"))
    return lifecycle.with_output(found.select(order, "create_ms", "pay_ms", state.alias("result_state")))


def stream_one_to_one(
    connected: DataFrame, on: str, before: timedelta, after: timedelta
) -> DataFrame:
    """Stream form of one-to-one pairing, on both streams connected under a ``side`` tag."""
    rows = connected.select(on, TS, TS_MS, "seq", (F.col(SIDE) == LEFT).cast("bigint").alias("_tag"))
    rule = FifoPairs(millis(before), millis(after))
    found = _fold(rows, connected, [on], rule, BY_TAG, FifoPairs.outputs)
    names = [MATCHED, UNMATCHED_LEFT, UNMATCHED_RIGHT]
    outcome = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("code") + 1).cast("int"))
    return found.select(on, "left_seq", "right_seq", outcome.alias("outcome"))


def stream_first_visits(
    df: DataFrame, visitor: str, size: timedelta, buckets: int = 16
) -> DataFrame:
    """Each window's first row of each hashed visitor, in event time: ``window_end_ms``, visitor, time and ``seq``.

    A window's bitmap is dealt over ``buckets`` keys. State goes at the window's end.
    """
    span = millis(size)
    offset = poly_hash(F.col(visitor).cast("string"))
    end = slot_start(F.col(TS_MS), span) + span
    rows = df.select(end.alias(WINDOW_END), F.pmod(offset, F.lit(buckets)).alias("_bucket"), TS, TS_MS, "seq", visitor,
                     F.floor(offset / buckets).cast("bigint").alias("_offset"))
    keys, held = [WINDOW_END, "_bucket"], _schema(rows, [TS_MS, "seq", visitor, "_offset"])
    schema = _schema(rows, [*keys, TS_MS, "seq", visitor])
    return _run(rows, keys, FirstVisits(held, keys), schema).drop("_bucket")
