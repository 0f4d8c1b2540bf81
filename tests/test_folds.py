"""Folds against the worked traces, and with narrow slices against plain Python."""

import random
from datetime import timedelta as D

import pytest
from helpers import frame, rows
from pyspark.sql import functions as F

from clickloom.operators import folds

S, MIN = D(seconds=1), D(minutes=1)
LOGIN = "user long, ts_ms long, seq long, state string"
def fail():
    return F.col("state") == "fail"


def logins(spark, events):
    return frame(spark, [(u, t, i, s) for i, (u, t, s) in enumerate(events)], LOGIN)


def anchored(events, times, within):
    out, kept = [], {}
    for user, ts, state in events:
        if state != "fail":
            kept[user] = []
            continue
        seen = kept.setdefault(user, [])
        seen.append(ts)
        if len(seen) >= times:
            if ts - seen[0] <= within:
                out.append((user, seen[0], ts))
            else:
                kept[user] = seen[1 : len(seen) - 1]
    return sorted(out)


def timer(events, times, within):
    out, slots = [], {}

    def close(user):
        first, last, n = slots.pop(user)
        if n >= times:
            out.append((user, first, last, n))

    for user, ts, state in events:
        if user in slots and ts > slots[user][0] + within:
            close(user)
        if state != "fail":
            slots.pop(user, None)
        else:
            first, _, n = slots.get(user, (ts, ts, 0))
            slots[user] = (first, ts, n + 1)
    for user in list(slots):
        close(user)
    return sorted(out)


def test_anchored_trace(spark):
    df = logins(spark, [(1, 1000 * t, "fail") for t in (0, 10, 20, 30, 70, 80)])
    got = folds.anchored_failures(df, ["user"], "seq", fail(), 3, MIN)
    assert rows(got) == [(1, 0, 20_000), (1, 0, 30_000)]


@pytest.mark.parametrize("gap, alerts", [(60_000, 1), (60_001, 0)])
def test_anchored_span_is_inclusive(spark, gap, alerts):
    df = logins(spark, [(1, 0, "fail"), (1, gap, "fail")])
    assert folds.anchored_failures(df, ["user"], "seq", fail(), 2, MIN).count() == alerts


def test_success_resets(spark):
    df = logins(spark, [(1, 0, "fail"), (1, 1, "success"), (1, 2, "fail"), (2, 0, "fail"), (2, 5, "fail")])
    assert rows(folds.anchored_failures(df, ["user"], "seq", fail(), 2, MIN)) == [(2, 0, 5)]
    assert rows(folds.timer_failures(df, ["user"], "seq", fail(), 2, MIN)) == [(2, 0, 5, 2)]


def test_timer_span(spark):
    events = [(1, 0, "fail"), (1, 60_000, "fail"), (1, 60_001, "fail"), (1, 60_002, "success"),
              (2, 0, "fail"), (2, 1, "fail"), (2, 60_000, "success"),
              (3, 0, "fail"), (3, 1, "fail"), (3, 60_001, "success")]
    got = folds.timer_failures(logins(spark, events), ["user"], "seq", fail(), 2, MIN)
    assert rows(got) == [(1, 0, 60_000, 2), (3, 0, 1, 2)]


def login_sample(seed, n=400):
    r = random.Random(seed)
    times = sorted(r.choice([r.randrange(0, 2000), r.randrange(6000, 6200)]) for _ in range(n))
    return [(1 if r.random() < 0.7 else r.randrange(2, 6), t, "fail" if r.random() < 0.93 else "ok") for t in times]


@pytest.mark.parametrize("width", [D(days=1), D(milliseconds=60)])
@pytest.mark.parametrize("times, within", [(2, 5), (3, 40), (5, 200)])
def test_failures_against_replay(spark, width, times, within):
    events = login_sample(times)
    df = logins(spark, events)
    span = D(milliseconds=within)
    got = folds.anchored_failures(df, ["user"], "seq", fail(), times, span, width)
    assert rows(got) == anchored(events, times, within)
    got = folds.timer_failures(df, ["user"], "seq", fail(), times, span, width)
    assert rows(got) == timer(events, times, within)


def fifo(left, right, low, high):
    """Replay one key at a time; the oldest waiting row of the other side is taken."""
    events = sorted([(k, t, 0, s) for k, t, s in left] + [(k, t, 1, s) for k, t, s in right])
    pairs, waiting = set(), {}
    for key, ts, side, seq in events:
        other = [w for w in waiting.get((key, 1 - side), []) if ts - w[0] <= (high if side else low)]
        if other:
            pairs.add((seq, other[0][1]) if side == 0 else (other[0][1], seq))
            waiting[key, 1 - side] = other[1:]
        else:
            waiting[key, 1 - side] = other
            waiting.setdefault((key, side), []).append((ts, seq))
    return pairs


@pytest.mark.parametrize("width", [D(days=1), D(milliseconds=25)])
def test_one_to_one_against_replay(spark, width):
    r = random.Random(5)
    key = lambda: "hot" if r.random() < 0.7 else r.choice("abc")
    left = [(key(), r.randrange(0, 900), i) for i in range(120)]
    right = [(key(), r.randrange(0, 900), i) for i in range(110)]
    schema = "tx string, ts_ms long, seq long"
    got = folds.pair_one_to_one(
        frame(spark, left, schema), frame(spark, right, schema), "tx", "seq",
        D(milliseconds=6), D(milliseconds=11), width,
    ).cache()
    pairs = fifo(left, right, 6, 11)
    assert set(rows(got.where("outcome = 'matched'"), "left_seq", "right_seq")) == pairs
    assert got.where("outcome <> 'matched'").count() == 120 + 110 - 2 * len(pairs)
    assert got.select("left_seq").dropna().distinct().count() == 120
    assert got.select("right_seq").dropna().distinct().count() == 110


def cycles(events, within, early):
    out, waiting = [], {}
    for key, kind, ts in sorted(events, key=lambda e: (e[0], e[2], e[1] != "create")):
        held = waiting.get(key)
        if held is None:
            waiting[key] = (kind, ts)
        elif held[0] != kind:
            del waiting[key]
            if kind == "pay":
                state = "payed successfully" if ts < held[1] + within else "payed but already timeout"
            elif ts - held[1] <= early:
                state = "payed successfully"
            else:
                state = "payed but not found created log"
                waiting[key] = (kind, ts)
            out.append((key, state))
    for key, (kind, _) in waiting.items():
        out.append((key, "payed timeout" if kind == "create" else "payed but not found created log"))
    return sorted(out)


@pytest.mark.parametrize("seed", [11, 12])
@pytest.mark.parametrize("width", [D(days=1), D(milliseconds=25), D(milliseconds=4)])
def test_cycles_against_replay(spark, width, seed):
    r = random.Random(seed)
    events = [(1 if r.random() < 0.6 else r.randrange(2, 9), r.choice(["create", "pay"]), t * 3) for t in range(200)]
    df = frame(spark, [(*e, i) for i, e in enumerate(events)], "order_id long, kind string, ts_ms long, seq long")
    got = folds.order_cycles(
        df, "order_id", "seq", F.col("kind") == "create", F.col("kind") == "pay",
        D(milliseconds=8), D(milliseconds=5), width,
    )
    assert rows(got, "order_id", "result_state") == cycles(events, 8, 5)
