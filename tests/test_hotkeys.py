"""Cut keys must give what whole keys give, whatever the width of the slices, null times included."""

import random
from datetime import timedelta as D

import pytest
from helpers import frame, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickloom.operators import hotkeys as hk

SCHEMA = "user long, ts_ms long, seq long, flag boolean, side string"


def sample(seed, n=300):
    """One user holds most rows, some rows share a time, some slices stay empty."""
    r = random.Random(seed)
    out = []
    for seq in range(n):
        user = 1 if r.random() < 0.7 else r.choice([2, 3, 4, None])
        ts = r.choice([r.randrange(0, 400), r.randrange(3000, 3100)]) * 10
        ts = None if r.random() < 0.03 else ts
        out.append((user, ts, seq, r.random() < 0.4, r.choice("LR")))
    return out


@pytest.fixture(scope="module", params=[1])
def df(spark, request):
    return frame(spark, sample(request.param), SCHEMA).drop("ts").cache()


ORDER = ["ts_ms", "seq"]
WHOLE = D(days=9)
WIDTHS = [D(milliseconds=70), D(milliseconds=900)]


def test_slices_keep_the_order_of_time(df):
    cut = hk.cut_by_time(df, ["user"], "ts_ms", D(milliseconds=70)).df
    assert cut.count() == df.count()
    found = [tuple(r) for r in cut.orderBy(F.asc_nulls_first("ts_ms")).select("ts_ms", hk.SLICE).collect()]
    assert [n for _, n in found] == sorted(n for _, n in found)
    assert all(n == ts // 70 for ts, n in found if ts is not None)
    assert any(ts is None for ts, _ in found)


def test_slots_of_times_before_the_epoch(spark):
    times = [-71, -70, -1, 0, 69, 70, 2**60 + 1]
    df = spark.createDataFrame([(t,) for t in times], "t long").select("t", hk.whole_slots(F.col("t"), 70))
    assert rows(df) == sorted((t, t // 70) for t in times)


def test_building_a_frame_starts_no_job(df):
    tracker = df.sparkSession.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    hk.position(df, ["user"], ORDER, "nth")
    hk.with_next(df, ["user"], ORDER, "flag", "next")
    assert len(tracker.getJobIdsForGroup(None)) == before


def uneven(n, crowded):
    """Nine of ten rows lie in one hour of a month, or share one millisecond of it."""
    hour = 3_600_000
    busy = [300 * hour if crowded else 300 * hour + k * hour // n for k in range(9 * n // 10)]
    return busy + [k * 720 * hour // n for k in range(n // 10)]


@pytest.mark.parametrize("crowded", [False, True])
@pytest.mark.parametrize("slices", [1, 7, 40])
def test_slices_hold_about_equally_many_rows(spark, crowded, slices):
    data = [(t, k) for k, t in enumerate(uneven(20_000, crowded))] + [(None, -1)]
    df = spark.createDataFrame(data, "ts_ms long, seq long").repartition(3)
    cut = hk.cut_by_rows(df, [], ORDER, slices).df
    found = sorted(((r["ts_ms"] is not None, r["ts_ms"], r["seq"], r[hk.SLICE]) for r in cut.collect()), key=lambda r: r[:3])
    numbers = [n for *_, n in found]
    assert numbers == sorted(numbers) and len(numbers) == 20_001
    sizes = sorted(numbers.count(n) for n in set(numbers))
    assert len(sizes) >= 0.8 * slices and sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_tasks_of_an_uneven_log_are_even(spark):
    """Sixteen slices for each shuffle partition, dealt by hash: no task has twice the median's rows."""
    data = [(0, t, k) for k, t in enumerate(uneven(40_000, False))]
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", "6")
    session.conf.set("spark.sql.adaptive.enabled", "false")
    df = session.createDataFrame(data, "one long, ts_ms long, seq long")
    got = hk.running(df, ["one"], ORDER, F.col("ts_ms"), "latest", F.max, None)
    by_task = got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max("latest"))
    tasks = sorted(r["n"] for r in by_task.collect())
    assert len(tasks) == 6 and tasks[-1] <= 2 * tasks[3]


def test_slices_of_one_order_column(spark):
    df = spark.range(1000).withColumnRenamed("id", "seq")
    cut = hk.cut_by_rows(df, [], ["seq"], 5).df
    assert [r["count"] > 150 for r in cut.groupBy(hk.SLICE).count().collect()] == [True] * 5
    assert hk.cut_by_rows(df.where("false"), [], ["seq"], 5).df.count() == 0


@pytest.mark.parametrize("width", [*WIDTHS, None])
@pytest.mark.parametrize("agg", [F.sum, F.max, F.min])
def test_running(df, width, agg):
    value = F.col("seq") * F.when(F.col("flag"), 1).otherwise(-1)
    whole = hk.running(df, ["user"], ORDER, value, "out", agg, WHOLE)
    cut = hk.running(df, ["user"], ORDER, value, "out", agg, width)
    assert cut.columns == whole.columns
    assert set(map(str, cut.collect())) == set(map(str, whole.collect()))


@pytest.mark.parametrize("width", [*WIDTHS, None])
def test_position(df, width):
    whole = hk.position(df, ["user"], ORDER, "nth", WHOLE)
    cut = hk.position(df, ["user"], ORDER, "nth", width)
    assert set(map(str, cut.collect())) == set(map(str, whole.collect()))


@pytest.mark.parametrize("width", WIDTHS)
@pytest.mark.parametrize("depth", [1, 4])
def test_lag(df, width, depth):
    def add(spec):
        return {"a": F.lag("ts_ms", depth).over(spec), "b": F.lag("flag", 1).over(spec)}

    whole = hk.with_preceding(df, ["user"], ORDER, depth, add, WHOLE)
    cut = hk.with_preceding(df, ["user"], ORDER, depth, add, width)
    assert set(map(str, cut.collect())) == set(map(str, whole.collect()))


@pytest.mark.parametrize("width", WIDTHS)
def test_next(df, width):
    whole = hk.with_next(df, ["user"], ORDER, "flag", "next", WHOLE)
    cut = hk.with_next(df, ["user"], ORDER, "flag", "next", width)
    assert set(map(str, cut.collect())) == set(map(str, whole.collect()))


@pytest.mark.parametrize("width", WIDTHS)
def test_nearest_sides(df, width):
    sides = {"L": "l", "R": "r"}
    whole = hk.with_nearest_sides(df, ["user"], "ts_ms", sides, "side", WHOLE)
    cut = hk.with_nearest_sides(df, ["user"], "ts_ms", sides, "side", width)
    assert set(map(str, cut.collect())) == set(map(str, whole.collect()))


def test_two_key_columns(df):
    whole = hk.position(df, ["user", "side"], ORDER, "nth", WHOLE)
    cut = hk.position(df, ["user", "side"], ORDER, "nth", WIDTHS[0])
    assert set(map(str, cut.collect())) == set(map(str, whole.collect()))


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(1, 2), st.integers(0, 40)), min_size=1, max_size=60), st.integers(1, 9))
def test_position_property(spark, points, width):
    data = [(u, t, i, True, "L") for i, (u, t) in enumerate(points)]
    got = hk.position(frame(spark, data, SCHEMA).drop("ts"), ["user"], ORDER, "nth", D(milliseconds=width))
    expected, seen = [], {}
    for user, ts, seq, *_ in sorted(data):
        seen[user] = seen.get(user, 0) + 1
        expected.append((user, seq, seen[user]))
    assert rows(got, "user", "seq", "nth") == sorted(expected)
