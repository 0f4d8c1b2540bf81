"""Streams over several micro-batches against the batch operators and small replays."""

import json
import os
import random
from datetime import timedelta as D

import pytest
from helpers import SF, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions import with_event_time
from clickloom.operators import folds, lateness, matching, patterns, ratelimit
from clickloom.operators.distinct import distinct_exact, distinct_running
from clickloom.operators.windows import labelled_total, salted_count, windowed_count
from clickloom.plans import frames, jobs
from clickloom.sources import append_files, by_outcome, console, order_events, replay, run_every, run_to_end
from clickloom.sources.sinks import UpsertLog
from clickloom.streaming import jobs as stream_jobs
from clickloom.streaming import processors

S, MIN = D(seconds=1), D(minutes=1)
FAR = 10**9
# Times start a day after the epoch: at a stream's start its watermark is zero, and rows at it are late.
T0 = 86_400_000


def long(name):
    return T.StructField(name, T.LongType())


def text(name):
    return T.StructField(name, T.StringType())


class Feed:
    """Rows handed to a stream one file, hence one micro-batch, at a time."""

    def __init__(self, spark, folder, fields):
        self.spark, self.folder = spark, str(folder)
        self.schema = T.StructType(fields)

    def put(self, batches):
        for number, batch in enumerate(batches):
            path = f"{self.folder}/{number:04d}.json"
            with open(path, "w") as out:
                for row in batch:
                    values = dict(zip(self.schema.names, row))
                    out.write(json.dumps(values | {"time": values["time"] + T0}) + "\n")
            os.utime(path, (1_000_000 + number, 1_000_000 + number))
        return self

    def stream(self, delay=D(0)):
        reader = self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1)
        return lateness.watermark(with_event_time(reader.json(self.folder), "time"), delay)

    def table(self):
        return with_event_time(self.spark.read.schema(self.schema).json(self.folder), "time").drop("time")


@pytest.fixture()
def feed(spark, tmp_path):
    def make(fields, batches, name="feed"):
        folder = tmp_path / name
        folder.mkdir()
        return Feed(spark, folder, fields).put(batches)

    return make


VISIT = [long("seq"), long("time"), long("user_id"), text("behavior")]


def visits(n=120, batches=2):
    data = [(i, 700 * i, i * i % 13, "pv" if i % 3 else "buy") for i in range(n)]
    size = n // batches
    closing = [[(FAR, 10_000_000, 99, "pv")]]
    return [data[i : i + size] for i in range(0, n, size)] + closing


def before_close(df):
    return rows(df.where(F.col("window_end_ms") < T0 + 5_000_000))


def test_window_counts(spark, feed):
    f = feed(VISIT, visits())
    for size, slide in [(10 * S, None), (20 * S, 5 * S)]:
        got = append_files(windowed_count(f.stream(), ["behavior"], size, slide), spark, "t")
        assert before_close(got) == before_close(windowed_count(f.table(), ["behavior"], size, slide))


def test_salted_count(spark, feed):
    f = feed(VISIT, visits())
    got = append_files(salted_count(f.stream(), 10 * S, ["user_id"]), spark, "t")
    assert before_close(got) == before_close(
        labelled_total(f.table(), "x", 10 * S).select("window_end_ms", "cnt")
    )


def test_distinct(spark, feed):
    f = feed(VISIT, visits())
    expected = before_close(distinct_exact(f.table(), "user_id", 10 * S))
    assert before_close(append_files(distinct_exact(f.stream(), "user_id", 10 * S), spark, "t")) == expected
    assert before_close(append_files(stream_jobs.visitors_bitmap(f.stream(), 10 * S), spark, "t")) == expected


def test_updating_count_keeps_the_newest(spark, feed, tmp_path):
    f = feed(VISIT, visits())
    counts = windowed_count(f.stream(MIN), ["behavior"], 10 * S)
    log = UpsertLog(spark, str(tmp_path / "log"), ["behavior", "window_end_ms"], counts.schema)
    got = log.run(counts, str(tmp_path / "check"))
    assert rows(got.select(*counts.columns)) == rows(windowed_count(f.table(), ["behavior"], 10 * S))
    assert log.history().count() > got.count()


def test_late_rows_update_then_drop(spark, feed):
    """A row within the watermark's delay updates its closed window; one beyond it is dropped."""
    batches = [[(1, 1000, 1, "pv")], [(2, 25_000, 1, "pv")], [(3, 2000, 2, "pv")], [(4, 90_000, 1, "pv")],
               [(5, 91_000, 1, "pv")], [(6, 3000, 3, "pv")]]
    f = feed(VISIT, batches)
    counts = windowed_count(f.stream(30 * S), ["behavior"], 10 * S)
    ranked = stream_jobs.rank_updated_windows(counts, spark, "t", 3, "behavior")
    assert rows(ranked.where(F.col("window_end_ms") == T0 + 10_000), "cnt") == [(2,)]


def test_rank_of_closed_windows(spark, feed):
    f = feed(VISIT, visits())
    counts = windowed_count(f.stream(), ["user_id"], 20 * S, 5 * S)
    got = stream_jobs.rank_closed_windows(counts, spark, "t", 3, "user_id")
    table = f.table().withColumn("item_id", F.col("user_id"))
    expected = jobs.hot_items(table.withColumn("behavior", F.lit("pv")), 3, 20 * S, 5 * S)
    names = ["window_end_ms", "row_num", "cnt"]
    assert before_close(got.select(*names)) == before_close(expected.select(*names))


def test_daily_cap(spark, feed):
    day = 86_400_000
    data = [(i, (i * 7 % 50) * 1000 + (i % 2) * day, 1, "ad") for i in range(60)]
    data.sort(key=lambda r: (r[1], r[0]))
    f = feed(VISIT, [data[:20], data[20:40], data[40:]])
    rows_in = f.stream().select("seq", "ts", "ts_ms", "user_id", "behavior")
    got = append_files(processors.stream_daily_cap(rows_in, ["user_id", "behavior"], 3), spark, "t")
    expected = ratelimit.daily_cap(f.table(), ["user_id", "behavior"], "seq", 3)
    assert rows(got, "seq", "outcome") == rows(expected, "seq", "outcome")


LOGIN = [long("seq"), long("time"), long("user_id"), text("state")]


def logins():
    data = [(i, 900 * i, i % 3, "ok" if i % 17 == 0 else "fail") for i in range(150)]
    return [data[i : i + 50] for i in range(0, 150, 50)] + [[(FAR, 10_000_000, 99, "ok")]]


def fail():
    return F.col("state") == "fail"


def test_anchored_failures(spark, feed):
    f = feed(LOGIN, logins())
    got = append_files(processors.stream_failures(f.stream(), ["user_id"], fail(), 3, 8 * S), spark, "t")
    assert rows(got) == rows(folds.anchored_failures(f.table(), ["user_id"], "seq", fail(), 3, 8 * S))


def test_timer_failures(spark, feed):
    f = feed(LOGIN, logins())
    got = append_files(processors.stream_failures(f.stream(), ["user_id"], fail(), 3, 8 * S, "timer"), spark, "t")
    assert rows(got) == rows(folds.timer_failures(f.table(), ["user_id"], "seq", fail(), 3, 8 * S))


def test_consecutive_failures(spark, feed):
    f = feed(LOGIN, logins())
    got = append_files(processors.stream_failures(f.stream(), ["user_id"], fail(), 4, 9 * S, "consecutive"), spark, "t")
    expected = patterns.consecutive(f.table(), ["user_id"], "seq", fail(), 4, 9 * S)
    assert rows(got) == rows(expected, "user_id", "first_ts_ms", "last_ts_ms")


ORDER = [long("seq"), long("time"), long("order_id"), text("kind")]


def kinds():
    return F.col("kind") == "create", F.col("kind") == "pay"


def test_followed_by(spark, feed):
    minute = 60_000
    batches = [
        [(1, 0, 1, "create"), (2, 0, 2, "create"), (3, 0, 3, "create"), (4, 1, 1, "create")],
        [(5, 5 * minute, 1, "pay"), (6, 15 * minute, 2, "pay"), (7, 15 * minute, 9, "pay")],
        [(8, 300 * minute, 7, "pay")],
    ]
    f = feed(ORDER, batches)
    got = append_files(processors.stream_followed_by(f.stream(), ["order_id"], *kinds(), 15 * MIN), spark, "t")
    expected = patterns.followed_by(f.table(), ["order_id"], "seq", *kinds(), 15 * MIN)
    names = ["order_id", "begin_ms", "outcome"]
    assert rows(got, *names) == rows(expected, *names)


def test_order_lifecycle(spark, feed):
    minute = 60_000
    batches = [
        [(1, 0, 1, "create"), (2, 0, 2, "pay"), (3, 0, 3, "create"), (4, 0, 4, "pay")],
        [(5, 5 * minute, 1, "pay"), (6, 6 * minute, 2, "create")],
        [(7, 40 * minute, 8, "pay")],
        [(8, 400 * minute, 9, "pay")],
        [(9, 400 * minute, 3, "pay")],
    ]
    f = feed(ORDER, batches)
    found = processors.stream_order_lifecycle(f.stream(), "order_id", *kinds(), 15 * MIN, 15 * MIN)
    got = append_files(found, spark, "t")
    # Order 3's pay comes after its timer has fired, so on a stream it gives a second row only later.
    assert rows(got, "order_id", "result_state") == [
        (1, "payed successfully"),
        (2, "payed successfully"),
        (3, "payed timeout"),
        (4, "payed but not found created log"),
        (8, "payed but not found created log"),
    ]


MINUTE = 60_000


def out_of_order(f):
    """The feed in batches against its watermark of 15 minutes; the last batch closes it."""
    return f.stream(15 * MIN)


def test_a_pay_before_its_create_in_a_later_batch(spark, feed):
    f = feed(ORDER, [[(1, 20 * MINUTE, 1, "create")], [(2, 15 * MINUTE, 1, "pay")], [(9, FAR, 0, "pay")]])
    got = append_files(processors.stream_followed_by(out_of_order(f), ["order_id"], *kinds(), 15 * MIN), spark, "t")
    assert rows(got, "order_id", "begin_ms", "outcome") == [(1, T0 + 20 * MINUTE, "timeout")]


def test_a_success_between_two_failures_in_a_later_batch(spark, feed):
    batches = [
        [(1, 0, 1, "fail"), (2, 2 * MINUTE, 1, "fail")],
        [(3, MINUTE, 1, "ok"), (4, 3 * MINUTE, 1, "fail")],
        [(9, FAR, 0, "ok")],
    ]
    for rule, expected in (
        ("anchored", [(1, T0 + 2 * MINUTE, T0 + 3 * MINUTE)]),
        ("timer", [(1, T0 + 2 * MINUTE, T0 + 3 * MINUTE, 2)]),
        ("consecutive", [(1, T0 + 2 * MINUTE, T0 + 3 * MINUTE)]),
    ):
        f = feed(LOGIN, batches, rule)
        found = processors.stream_failures(out_of_order(f), ["user_id"], fail(), 2, 10 * MIN, rule)
        assert rows(append_files(found, spark, "t")) == expected


def test_an_earlier_pay_in_a_later_batch(spark, feed):
    batches = [
        [(1, 30 * MINUTE, 1, "create"), (2, 46 * MINUTE, 1, "pay")],
        [(3, 32 * MINUTE, 1, "pay")],
        [(9, FAR, 0, "pay")],
    ]
    f = feed(ORDER, batches)
    found = processors.stream_order_lifecycle(out_of_order(f), "order_id", *kinds(), 15 * MIN, 15 * MIN)
    got = rows(append_files(found, spark, "t"), "order_id", "pay_ms", "result_state")
    assert got == [
        (1, T0 + 32 * MINUTE, "payed successfully"),
        (1, T0 + 46 * MINUTE, "payed but not found created log"),
    ]


def test_a_nearer_partner_in_a_later_batch(spark, feed):
    batches = [
        [(1, 10 * MINUTE, "x", "left"), (2, 12 * MINUTE, "x", "right")],
        [(3, 11 * MINUTE, "x", "right")],
        [(9, FAR, "y", "left")],
    ]
    f = feed(PAY, batches)
    got = append_files(processors.stream_one_to_one(out_of_order(f), "tx_id", 3 * MIN, 5 * MIN), spark, "t")
    assert rows(got.where("outcome = 'matched'"), "left_seq", "right_seq") == [(1, 3)]
    assert rows(got.where("outcome <> 'matched'"), "right_seq") == [(2,)]


def test_daily_cap_on_three_days_with_late_rows(spark, feed):
    day = 86_400_000
    batches = [
        [(1, 0, 1, "ad"), (2, 1000, 1, "ad"), (3, 2000, 1, "ad")],
        [(4, 2 * day, 1, "ad")],
        [(5, 3000, 1, "ad"), (6, 4000, 1, "ad")],
        [(9, 30 * day, 0, "ad")],
    ]
    f = feed(VISIT, batches)
    rows_in = f.stream(D(days=5)).select("seq", "ts", "ts_ms", "user_id", "behavior")
    got = append_files(processors.stream_daily_cap(rows_in, ["user_id", "behavior"], 1), spark, "t")
    assert rows(got, "seq", "outcome") == [(1, "passed"), (2, "passed"), (3, "warning"), (4, "passed")]


def test_strict_sequence(spark, feed):
    f = feed(LOGIN, logins())
    steps = [fail(), fail(), F.col("state") == "ok"]
    got = append_files(processors.stream_sequence(f.stream(), ["user_id"], steps, 9 * S), spark, "t")
    expected = patterns.strict_sequence(f.table(), ["user_id"], "seq", steps, 9 * S)
    assert rows(got) == rows(expected, "user_id", "first_ts_ms", "last_ts_ms")
    assert got.count()


def test_chained_panes(spark, feed):
    f = feed(VISIT, visits())
    got = append_files(windowed_count(f.stream(), ["behavior"], 20 * S, 5 * S, chained=True), spark, "t")
    assert before_close(got) == before_close(windowed_count(f.table(), ["behavior"], 20 * S, 5 * S))


PAY = [long("seq"), long("time"), text("tx_id"), text("side")]


def payments():
    pays = [(i, 1000 * i, f"t{i % 7}", "left") for i in range(60)]
    receipts = [(1000 + i, 1000 * i + 400 * (i % 9), f"t{i % 5}", "right") for i in range(50)]
    both = sorted(pays + receipts, key=lambda r: (r[1], r[0]))
    return [both[:40], both[40:80], both[80:], [(FAR, 10_000_000, "end", "left"), (FAR + 1, 10_000_000, "end2", "right")]]


def test_one_to_one(spark, feed):
    f = feed(PAY, payments())
    got = append_files(processors.stream_one_to_one(f.stream(), "tx_id", 3 * S, 5 * S), spark, "t")
    table = f.table()
    expected = folds.pair_one_to_one(
        table.where("side = 'left'"), table.where("side = 'right'"), "tx_id", "seq", 3 * S, 5 * S
    )
    last = F.coalesce("left_seq", "right_seq") < FAR
    assert rows(got.where(last).fillna(-1)) == rows(expected.where(last).fillna(-1))


def test_interval_joins(spark, feed):
    f = feed(PAY, payments())
    left = f.stream().where("side = 'left'").drop("side", "time")
    right = f.stream().where("side = 'right'").drop("side", "time")
    a = f.table().where("side = 'left'").drop("side")
    b = f.table().where("side = 'right'").drop("side")
    inner = append_files(matching.interval_join(left, right, "tx_id", 3 * S, 5 * S), spark, "t")
    names = ["l_seq", "r_seq"]
    assert rows(inner, *names) == rows(matching.interval_join(a, b, "tx_id", 3 * S, 5 * S), *names)
    left = f.stream().where("side = 'left'").drop("side", "time")
    right = f.stream().where("side = 'right'").drop("side", "time")
    outer = append_files(matching.interval_join(left, right, "tx_id", 3 * S, 5 * S, how="full_outer"), spark, "t")
    expected = matching.reconcile(a, b, "tx_id", 3 * S, 5 * S)
    last = F.coalesce("l_seq", "r_seq") < FAR
    assert rows(outer.where(last).fillna(-1), *names) == rows(expected.where(last).fillna(-1), *names)


def test_late_rows_across_batches(spark, feed):
    """Batch by batch, late rows are those that the whole log in arrival order would have."""
    data = [(i, i * 1000 - (i * 37 % 90) * 1000 + 100_000, i % 2, "pv") for i in range(120)]
    f = feed(VISIT, [data[:50], data[50:55], data[55:]])
    log = stream_jobs.LateRouter(spark, "t", ["seq"], 2 * S, 20 * S, 5 * S, 10 * S)
    got = log.run(f.stream())
    seen = lateness.arrival_watermark(f.table(), ["seq"], 2 * S)
    expected = lateness.tag_late(seen, 20 * S, 5 * S, 10 * S)
    names = ["seq", "wm_ms", "outcome"]
    assert rows(got, *names) == rows(expected, *names)
    assert {r[0] for r in rows(got.select("outcome").distinct())} == {"late", "on_time"}


def test_tagged_rows_go_to_their_folders(spark, feed, tmp_path):
    f = feed(VISIT, visits())
    tagged = f.stream().withColumn("outcome", F.when(F.col("user_id") < 5, "late").otherwise("on_time"))
    writer = tagged.writeStream.foreachBatch(by_outcome(str(tmp_path / "out"), ["late", "on_time"]))
    run_to_end(writer, str(tmp_path / "check"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.where("outcome = 'late'").count() == f.table().where("user_id < 5").count()
    assert got.count() == f.table().count()


def test_console_label(spark, feed, tmp_path):
    """The console prints every micro-batch of the stream under its label."""
    f = feed(VISIT, visits())
    writer = console(f.stream(), "label").option("checkpointLocation", str(tmp_path / "check"))
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.name == "label" and query.exception() is None
    assert sum(p["numInputRows"] for p in query.recentProgress) == f.table().count()


def test_a_trigger_by_the_clock_gives_the_same(spark, feed, tmp_path):
    f = feed(VISIT, visits())
    counts = windowed_count(f.stream(), ["behavior"], 10 * S)
    writer = counts.writeStream.format("parquet").option("path", str(tmp_path / "rows"))
    query = run_every(writer, str(tmp_path / "check"), D(milliseconds=200))
    query.processAllAvailable()
    query.stop()
    got = spark.read.schema(counts.schema).parquet(str(tmp_path / "rows"))
    assert before_close(got) == before_close(windowed_count(f.table(), ["behavior"], 10 * S))


def test_delimited_stream(spark, order_files):
    stream = order_events(spark, order_files[0].replace("orders.csv", "order*.csv"), streaming=True)
    got = append_files(stream, spark, "t")
    assert rows(got, "order_id", "tx_id") == rows(order_events(spark, order_files[0]), "order_id", "tx_id")


def test_replay_of_a_table(spark):
    got = append_files(replay(spark, SF, "events", frames.EVENTS), spark, "t")
    assert got.count() == spark.read.parquet(f"{SF}/events.parquet").count()


class FakeHandle:
    """State of one key in dictionaries, counting what is read from the waiting rows."""

    def __init__(self):
        self.states, self.timers, self.rows_read, self.rows_written, self.values_read = {}, set(), 0, 0, 0

    def getValueState(self, name, schema):
        return FakeState(self, self.states.setdefault(name, {}))

    def getMapState(self, name, keys, values):
        return FakeState(self, self.states.setdefault(name, {}))

    def registerTimer(self, at):
        self.timers.add(at)


class FakeState:
    def __init__(self, handle, data):
        self.handle, self.data = handle, data

    def exists(self):
        return bool(self.data)

    def get(self):
        self.handle.values_read += len(self.data[()][0])
        return self.data[()]

    def update(self, value):
        self.data[()] = value

    def clear(self):
        self.data.clear()

    def containsKey(self, key):
        return key in self.data

    def getValue(self, key):
        self.handle.rows_read += len(self.data[key][0])
        return self.data[key]

    def updateValue(self, key, value):
        self.handle.rows_written += len(value[0])
        self.data[key] = value

    def removeKey(self, key):
        del self.data[key]


class Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentWatermarkInMs(self):
        return self.now


class Recorder(processors.InEventTime):
    """Remembers the order in which rows are met."""

    def meet(self, key, rows, state, now):
        assert all(r["ts_ms"] <= max(now, r["ts_ms"]) for r in rows)
        return [(r["ts_ms"], r["seq"]) for r in rows], [len(rows)], None


HELD = T.StructType([long("ts_ms"), long("seq")])


def fed(delay, each, steps=400, seed=5):
    """One key's rows, ``each`` per micro-batch and out of order within the delay; what the state did."""
    pick, handle, met = random.Random(seed), FakeHandle(), []
    recorder = Recorder(HELD)
    recorder.init(handle)
    seq = 0
    for step in range(steps + delay // 10 + 2):
        now = 10 * step - delay
        if step < steps:
            batch = []
            for _ in range(each):
                batch.append({"ts_ms": max(0, 10 * step - pick.randrange(delay)) + delay, "seq": seq})
                seq += 1
            list(recorder.handleInputRows((1,), iter(batch), Clock(now)))
        due = sorted(t for t in handle.timers if t <= now + delay)
        handle.timers -= set(due)
        for timer in due:
            met += recorder.handleExpiredTimer((1,), Clock(now + delay), timer)
    return handle, met, seq


@pytest.mark.parametrize("each", [1, 10, 300])
def test_waiting_rows_are_read_a_constant_number_of_times(each):
    per_row = []
    for delay in (100, 1000, 3000):
        handle, met, n = fed(delay, each)
        assert met == sorted(met) and len(met) == n
        assert not handle.states["waiting"] and not handle.states["index"]
        per_row.append(handle.rows_read / n)
    assert max(per_row) < 12, per_row


def test_few_waiting_rows_have_no_chunks():
    """They lie beside the rule's memory; a row more and all go into a chunk, and what it leaves comes back."""
    handle = FakeHandle()
    recorder = Recorder(HELD)
    recorder.init(handle)
    few = [{"ts_ms": 10 * k, "seq": k} for k in (3, 1, 2)]
    list(recorder.handleInputRows((1,), iter(few), Clock(0)))
    assert not handle.states["waiting"] and not handle.states["index"] and min(handle.timers) == 10
    assert recorder.handleExpiredTimer((1,), Clock(20), 10).__next__() == (10, 1)
    more = [{"ts_ms": 100 + k, "seq": 10 + k} for k in range(processors.FEW)]
    handle = FakeHandle()
    recorder.init(handle)
    list(recorder.handleInputRows((1,), iter(few + more), Clock(0)))
    assert len(handle.states["waiting"]) == 1 and handle.states["index"]
    assert list(recorder.handleExpiredTimer((1,), Clock(25), 10)) == [(10, 1), (20, 2)]
    assert handle.states["waiting"]  # more than a few are left
    assert list(recorder.handleExpiredTimer((1,), Clock(101), 30)) == [(30, 3), (100, 10), (101, 11)]
    assert not handle.states["waiting"] and not handle.states["index"] and 102 in handle.timers
    assert len(list(recorder.handleExpiredTimer((1,), Clock(200), 102))) == processors.FEW - 2


def test_keys_of_a_bucket_are_capped_apart():
    """Each key has its own count, also nulls and numbers that are none; counts come back between timers and go with the day."""
    held = T.StructType([long("ts_ms"), long("seq"), long("_day_end"), T.StructField("value", T.DoubleType()), T.StructField("kind", T.StringType())])
    handle = FakeHandle()
    cap = processors.ClickCap(1, held, ["value", "kind"])
    cap.init(handle)
    kinds = [(1.0, "a"), (None, "a"), (float("nan"), "a"), (1.0, None), (float("nan"), "b")]
    rows_in = [{"ts_ms": 10 * n + k, "seq": 10 * n + k, "_day_end": 100, "value": v, "kind": w} for n in range(4) for k, (v, w) in enumerate(kinds)]
    out = []
    for low, now in ((0, 19), (10, 99)):  # two rows of each key at a time
        list(cap.handleInputRows((0,), iter(rows_in[low : low + 10]), Clock(now - 1)))
        out += cap.handleExpiredTimer((0,), Clock(now), now)
    got = [(r["seq"] % 10, r["outcome"]) for r in out]
    assert sorted(got) == sorted((k, o) for k in range(5) for o in ("passed", "passed", "warning"))
    assert handle.states["days"] and 100 in handle.timers
    assert list(cap.handleExpiredTimer((0,), Clock(100), 100)) == [] and not any(handle.states.values())


def test_very_many_due_rows_are_met_in_slices():
    handle, met, n = fed(1000, 9000, steps=3)
    assert len(met) == n == 27_000 and met == sorted(met)


def test_running_visitors(spark, feed):
    """Every first visit with the count after it, out of order within the delay, equals the batch form."""
    pick = random.Random(2)
    data = [(i, max(0, 700 * i - pick.choice([0, 0, 9000])), pick.randrange(30), "pv") for i in range(150)]
    f = feed(VISIT, [data[:40], data[40:41], data[41:110], data[110:], [(FAR, 10_000_000, 99, "pv")]])
    views = f.stream(15 * S)
    got = stream_jobs.visitors_running(processors.stream_first_visits(views, "user_id", 20 * S, 3), spark)
    expected = distinct_running(f.table(), "user_id", "seq", 20 * S)
    names = ["window_end_ms", "user_id", "ts_ms", "seq", "uv"]
    assert before_close(got.select(*names)) == before_close(expected.select(*names)) != []


def test_running_visitors_of_a_repeated_batch(spark, tmp_path):
    schema = T.StructType([long("window_end_ms"), long("ts_ms"), long("seq"), long("user_id")])
    running = stream_jobs.RunningVisitors(spark, f"file://{tmp_path}/v", schema)
    parts = [[(10, 1, 1, 5), (10, 2, 2, 6), (20, 12, 3, 5)], [], [(20, 13, 4, 7), (20, 14, 5, 8)], [(20, 15, 6, 9)]]
    for number, part in enumerate(parts):
        for _ in range(2 if number == 2 else 1):
            running.write(spark.createDataFrame(part, schema), number)
    assert [r[-1] for r in rows(running.rows())] == [1, 2, 1, 2, 3, 4]


def test_two_sources_under_the_smaller_watermark(spark, feed):
    """One source is far ahead of the other; no row of the one that lags is dropped."""
    fields = [long("seq"), long("time"), text("tx_id")]
    pick = random.Random(6)
    left = [(i, 1000 * i, f"t{pick.randrange(6)}") for i in range(60)]
    right = [(100 + i, 1000 * i + 500, f"t{pick.randrange(6)}") for i in range(60)]
    closing = [(FAR, 10_000_000, "end")]
    ahead = feed(fields, [left[:55], left[55:], closing], "left")
    shuffled = [right[k : k + 6][::-1] for k in range(0, 60, 6)]
    behind = feed(fields, [*shuffled, closing], "right")
    both = matching.connect(ahead.stream(S), behind.stream(20 * S))
    got = append_files(processors.stream_one_to_one(both, "tx_id", 2 * S, 3 * S), spark, "t").where("tx_id <> 'end'")
    expected = folds.pair_one_to_one(ahead.table(), behind.table(), "tx_id", "seq", 2 * S, 3 * S).where("tx_id <> 'end'")
    key = lambda r: str(tuple(r))
    assert sorted(map(key, got.collect())) == sorted(map(key, expected.select(*got.columns).collect()))
