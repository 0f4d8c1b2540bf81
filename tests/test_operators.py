from datetime import timedelta as D

import pandas as pd
import pytest
from helpers import frame, rows
from pyspark.sql import functions as F

from clickloom.functions import calendar_day, display_shift, format_ms, java_timestamp_text, next_midnight_ms, poly_hash
from clickloom.operators import filters, lateness, lifecycle, matching, patterns, ratelimit, topn, windows
from clickloom.operators.distinct import distinct_bitmap, distinct_exact, distinct_running, distinct_sketch

S, MIN = D(seconds=1), D(minutes=1)


def test_sliding_window_ends(spark):
    df = frame(spark, [(1, 1618203601000)], "item long, ts_ms long")
    expected = [1618203600000 + 5000 * i for i in range(1, 13)]
    panes = windows.windowed_count(df, ["item"], MIN, 5 * S)
    direct = windows.windowed_agg(df, ["item"], [F.count("*").alias("cnt")], MIN, 5 * S)
    for got in (panes, direct):
        assert rows(got, "window_end_ms", "cnt") == [(e, 1) for e in expected]


def test_panes_equal_direct_expansion(spark):
    data = [(i % 3, 1000 * (i * 7 % 200), i % 5 or None) for i in range(300)]
    df = frame(spark, data, "item long, ts_ms long, v long").cache()
    for size, slide in [(MIN, 5 * S), (20 * S, 5 * S), (10 * S, None)]:
        count = windows.windowed_count(df, ["item"], size, slide, counted="v")
        total = windows.windowed_sum(df, ["item"], "v", size, slide)
        aggs = [F.count("v").alias("cnt"), F.sum("v").alias("total")]
        direct = windows.windowed_agg(df, ["item"], aggs, size, slide)
        assert rows(count, "item", "window_end_ms", "cnt") == rows(direct, "item", "window_end_ms", "cnt")
        assert rows(total, "item", "window_end_ms", "total") == rows(direct, "item", "window_end_ms", "total")


def test_sliding_counts_add_up(spark):
    df = frame(spark, [(i, 997 * i) for i in range(200)], "item long, ts_ms long")
    total = windows.windowed_count(df, ["item"], MIN, 5 * S).agg(F.sum("cnt")).first()[0]
    assert total == 200 * 12


def test_salted_count_equals_direct(spark):
    df = frame(spark, [(i % 17, 700 * i) for i in range(500)], "user long, ts_ms long")
    direct = windows.windowed_count(df, [], 10 * S)
    salted = windows.salted_count(df, 10 * S, ["user"])
    assert rows(salted, "window_end_ms", "cnt") == rows(direct, "window_end_ms", "cnt")


def test_before_the_epoch(spark):
    df = frame(spark, [(1, -1), (1, 0)], "item long, ts_ms long")
    assert rows(windows.windowed_count(df, [], 10 * S, 5 * S), "window_end_ms", "cnt") == [
        (0, 1), (5000, 2), (10000, 1)
    ]


def test_top_n_ties_go_by_key(spark):
    df = spark.createDataFrame([("c", 0, 1), ("b", 0, 2), ("a", 0, 2)], "k string, window_end_ms long, cnt long")
    assert rows(topn.top_n(df, 2, "k"), "row_num", "k") == [(1, "a"), (2, "b")]


def test_report_text(spark):
    df = spark.createDataFrame([(7, 60000, 3), (8, 60000, 2)], "k long, window_end_ms long, cnt long")
    text = topn.render_ranking(topn.top_n(df, 5, "k"), "k", topn.ITEM_LABELS).first()["report"]
    assert text.split("\n")[:3] == [
        "======窗口结束时间：1970-01-01 00:01:00======",
        "NO.1: 商品ID = 7 热门度 : 3",
        "NO.2: 商品ID = 8 热门度 : 2",
    ]


def test_filters_and_nulls(spark):
    df = spark.createDataFrame([("UNINSTALL",), ("CLICK",), (None,), ("",)], "b string")
    assert {r["b"] for r in filters.differs(df, "b", "UNINSTALL").collect()} == {"CLICK", None, ""}
    assert rows(filters.equals(df, "b", "CLICK")) == [("CLICK",)]
    assert rows(filters.non_empty(df, "b")) == [("CLICK",), ("UNINSTALL",)]


def test_hash_values(spark):
    df = spark.createDataFrame([("1234",), ("98765432109876543210",), ("",)], "s string")
    got = {r["s"]: r["h"] for r in df.select("s", poly_hash(F.col("s")).alias("h")).collect()}
    assert got == {"1234": 11311282, "98765432109876543210": 475220442, "": 0}


def test_distinct_forms_agree(spark):
    df = frame(spark, [(i * i % 83, 400 * i, i) for i in range(600)], "user long, ts_ms long, seq long").cache()
    exact = rows(distinct_exact(df, "user", 10 * S), "window_end_ms", "uv")
    assert rows(distinct_bitmap(df, "user", 10 * S), "window_end_ms", "uv") == exact
    last = distinct_running(df, "user", "seq", 10 * S).groupBy("window_end_ms").agg(F.max("uv").alias("uv"))
    assert rows(last, "window_end_ms", "uv") == exact
    cut = distinct_running(df, "user", "seq", 10 * S, width=3 * S)
    assert rows(cut) == rows(distinct_running(df, "user", "seq", 10 * S))
    for (_, near), (_, uv) in zip(rows(distinct_sketch(df, "user", 10 * S), "window_end_ms", "uv"), exact):
        assert abs(near - uv) <= 2


@pytest.mark.parametrize("zone", ["UTC", "+08:00"])
def test_daily_cap(spark, zone):
    data = [(1, 7, 1000 * i, i) for i in range(13)] + [(1, 8, 5, 99)]
    df = frame(spark, data, "user long, ad long, ts_ms long, seq long")
    capped = ratelimit.daily_cap(df, ["user", "ad"], "seq", 10, zone)
    assert ratelimit.passed_rows(capped).count() == 11 + 1
    assert rows(ratelimit.cap_warnings(capped, ["user", "ad"], 10)) == [(1, 7, "click over 10times.")]


def test_cap_starts_again_at_midnight_of_the_zone(spark):
    eve = 16 * 3600_000
    data = [(1, eve - 2, 1), (1, eve - 1, 2), (1, eve, 3)]
    df = frame(spark, data, "user long, ts_ms long, seq long")
    assert rows(ratelimit.daily_cap(df, ["user"], "seq", 0, "+08:00"), "seq", "outcome") == [
        (1, "passed"), (2, "warning"), (3, "passed")
    ]


def test_cap_keeps_few_rows_before_the_shuffle(spark):
    df = frame(spark, [(1, 1, 1)], "user long, ts_ms long, seq long")
    plan = ratelimit.daily_cap(df, ["user"], "seq", 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_time_text(spark):
    df = spark.createDataFrame([(1618203600000,), (1618203600120,), (1618203600123,)], "ms long")
    ms = F.col("ms")
    got = df.select(
        format_ms(ms), java_timestamp_text(ms, "+08:00"), calendar_day(ms), next_midnight_ms(ms, D(hours=8))
    )
    assert [tuple(r) for r in got.collect()] == [
        ("2021-04-12 05:00:00", "2021-04-12 13:00:00.0", 18729, 1618243200000),
        ("2021-04-12 05:00:00", "2021-04-12 13:00:00.12", 18729, 1618243200000),
        ("2021-04-12 05:00:00", "2021-04-12 13:00:00.123", 18729, 1618243200000),
    ]


def test_display_shift_moves_text_only(spark):
    df = frame(spark, [(1618203600000,)], "ts_ms long")
    got = df.select(F.unix_millis(display_shift("ts")) - F.col("ts_ms")).first()[0]
    assert got == 8 * 3600_000


def test_any_aggregate_per_window(spark):
    """The escape hatch: a pandas aggregate works like a built-in one."""

    @F.pandas_udf("double")
    def middle(v: pd.Series) -> float:
        return float(v.median())

    df = frame(spark, [(1, 1000, 5.0), (1, 2000, 9.0), (1, 3000, 6.0)], "k long, ts_ms long, v double")
    got = windows.windowed_agg(df, ["k"], [middle("v").alias("mid")], 10 * S)
    assert rows(got) == [(1, 10_000, 6.0)]


# --- lateness --------------------------------------------------------------------------


def late_rows(data, bound, size, slide, allowed):
    """Row by row, as a stream in arrival order would see it."""
    seen, tags, counts = None, [], {}
    for arrival, seq, ts, key in sorted(data):
        seen = ts if seen is None else max(seen, ts)
        wm = seen - bound
        last_start = ts // slide * slide
        ends = range(last_start + slide, last_start + size + 1, slide)
        tags.append((seq, "late" if last_start + size + allowed <= wm else "on_time"))
        for end in ends:
            if end + allowed > wm:
                counts[key, end] = counts.get((key, end), 0) + 1
    return sorted(tags), sorted((k, e, n) for (k, e), n in counts.items())


@pytest.mark.parametrize("width", [D(days=1), 7 * S])
def test_lateness_against_replay(spark, width):
    data = [(i * 1000, i, (i * 1000 - (i * 37 % 90) * 1000), i % 2) for i in range(200)]
    df = frame(spark, data, "arrival long, seq long, ts_ms long, key long")
    seen = lateness.arrival_watermark(df, ["arrival", "seq"], 2 * S, width)
    tagged = lateness.tag_late(seen, 20 * S, 5 * S, 10 * S)
    counts = lateness.accepted_counts(tagged, ["key"], 20 * S, 5 * S, 10 * S)
    tags, expected = late_rows(data, 2000, 20000, 5000, 10000)
    assert rows(tagged, "seq", "outcome") == tags
    assert {t for _, t in tags} == {"late", "on_time"}
    assert rows(counts, "key", "window_end_ms", "cnt") == expected
    outputs = lateness.split_outputs(tagged, ["late", "on_time"])
    assert sum(o.count() for o in outputs.values()) == len(data)


def test_size_must_be_a_multiple(spark):
    df = frame(spark, [(1, 1)], "arrival long, ts_ms long").withColumn("wm_ms", F.lit(0))
    with pytest.raises(ValueError):
        lateness.tag_late(df, 7 * S, 5 * S)


# --- patterns --------------------------------------------------------------------------

LOGIN = "user long, ts_ms long, seq long, state string"
def fail():
    return F.col("state") == "fail"


def logins(spark, events):
    return frame(spark, [(u, t, i, s) for i, (u, t, s) in enumerate(events)], LOGIN)


@pytest.mark.parametrize("width", [D(days=1), D(milliseconds=700)])
def test_consecutive_runs_overlap(spark, width):
    df = logins(spark, [(1, 1000 * i, "fail") for i in range(6)] + [(1, 6000, "success")])
    got = patterns.consecutive(df, ["user"], "seq", fail(), 5, 10 * S, width=width)
    assert rows(got, "first_ts_ms", "last_ts_ms") == [(0, 4000), (1000, 5000)]


def test_consecutive_span_ends(spark):
    df = logins(spark, [(1, 0, "fail"), (1, 10000, "fail")])
    assert patterns.consecutive(df, ["user"], "seq", fail(), 2, 10 * S).count() == 0
    assert patterns.consecutive(df, ["user"], "seq", fail(), 2, 10 * S, inclusive=True).count() == 1


@pytest.mark.parametrize("width", [D(days=1), D(milliseconds=700)])
def test_strict_sequence(spark, width):
    df = logins(spark, [(1, 0, "a"), (1, 1, "b"), (1, 2, "x"), (1, 3, "a"), (1, 4, "b"), (1, 5, "c"), (2, 6, "c")])
    steps = [F.col("state") == s for s in "abc"]
    got = patterns.strict_sequence(df, ["user"], "seq", steps, S, width=width)
    assert rows(got, "user", "first_ts_ms", "last_ts_ms") == [(1, 3, 5)]


@pytest.mark.parametrize("width", [D(days=1), D(milliseconds=700)])
def test_followed_by(spark, width):
    events = [(1, 0, "create"), (1, 1, "create"), (1, 2, "pay"), (1, 3, "pay"), (2, 0, "pay"), (3, 0, "create"),
              (3, 900_000, "pay"), (4, 0, "create")]
    df = logins(spark, events)
    got = patterns.followed_by(
        df, ["user"], "seq", F.col("state") == "create", F.col("state") == "pay", 15 * MIN, width
    )
    assert sorted(map(tuple, got.select("user", "begin_ms", F.coalesce("end_ms", F.lit(-1)), "outcome").collect())) == [
        (1, 0, 2, "matched"), (1, 1, 2, "matched"), (3, 0, -1, "timeout"), (4, 0, -1, "timeout")
    ]


# --- joins -----------------------------------------------------------------------------


def brute_pairs(left, right, low, high):
    return sorted((a[2], b[2]) for a in left for b in right if a[0] == b[0] and -low <= b[1] - a[1] <= high)


@pytest.mark.parametrize("width", [D(days=1), D(milliseconds=700)])
def test_reconcile_against_brute_force(spark, width):
    left = [(f"t{i % 3}", i * 1700 % 90_000, i) for i in range(80)]
    right = [(f"t{i % 4}", i * 2900 % 90_000, i) for i in range(60)]
    schema = "tx string, ts_ms long, seq long"
    a, b = frame(spark, left, schema), frame(spark, right, schema)
    pairs = brute_pairs(left, right, 300, 500)
    assert rows(matching.interval_join(a, b, "tx", 300 * S / 1000, 500 * S / 1000), "l_seq", "r_seq") == pairs
    got = matching.reconcile(a, b, "tx", 300 * S / 1000, 500 * S / 1000, width=width).cache()
    assert rows(got.where("outcome = 'matched'"), "l_seq", "r_seq") == pairs
    lone = {p for p, _ in pairs}, {r for _, r in pairs}
    assert [r[0] for r in rows(got.where("outcome = 'unmatched_left'"), "l_seq")] == [
        i for i in range(80) if i not in lone[0]
    ]
    assert [r[0] for r in rows(got.where("outcome = 'unmatched_right'"), "r_seq")] == [
        i for i in range(60) if i not in lone[1]
    ]


def test_interval_ends_are_inclusive(spark):
    schema = "tx string, ts_ms long, seq long"
    left = frame(spark, [("a", 10_000, 0)], schema)
    right = frame(spark, [("a", t, t) for t in (6_999, 7_000, 15_000, 15_001)] + [(None, 10_000, 1)], schema)
    got = matching.interval_join(left, right, "tx", 3 * S, 5 * S)
    assert rows(got, "r_seq") == [(7_000,), (15_000,)]
    lone = matching.unmatched(left, right, "tx", 3 * S, 5 * S)
    assert rows(lone, "side", "seq") == [("right", 1), ("right", 6_999), ("right", 15_001)]


def test_order_outcome_cases(spark):
    minute = 60_000
    events = [(1, "create", 0), (1, "pay", 15 * minute - 1), (2, "create", 0), (2, "pay", 15 * minute),
              (3, "create", 0), (4, "pay", 0), (5, "pay", 0), (5, "create", 15 * minute),
              (6, "pay", 0), (6, "create", 15 * minute + 1), (7, "create", 5), (7, "create", 0), (7, "pay", 9)]
    df = frame(spark, events, "order_id long, kind string, ts_ms long")
    got = lifecycle.order_outcomes(
        df, "order_id", F.col("kind") == "create", F.col("kind") == "pay", 15 * MIN, 15 * MIN
    )
    assert rows(got, "order_id", "result_state", "output") == [
        (1, "payed successfully", "main"),
        (2, "payed but already timeout", "side"),
        (3, "payed timeout", "side"),
        (4, "payed but not found created log", "side"),
        (5, "payed successfully", "main"),
        (6, "payed but not found created log", "side"),
        (6, "payed timeout", "side"),
        (7, "payed successfully", "main"),
    ]
