"""User accumulators against plain groups, whatever the batches, tasks and flushes."""

import random
import sys
from collections import defaultdict
from datetime import timedelta as D

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from helpers import frame, rows
from pyspark import cloudpickle
from pyspark.sql import types as T

from clickloom.operators.accumulate import Accumulator, TrimmedMean, accumulate
from clickloom.operators.windows import windowed_count

# Workers cannot import this file, so its accumulators travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

S = D(seconds=1)
SCHEMA = "user long, kind string, ts_ms long, v long"


class Count(Accumulator):
    state = output = T.LongType()

    def create(self):
        return 0

    def add(self, state, values: pa.Array):
        return state + len(values)

    def merge(self, one, other):
        return one + other


class Longest(Accumulator):
    """The longest distinct texts of two columns put together, in order: a state that is a list, and two inputs."""

    state = T.ArrayType(T.StringType())
    output = T.StringType()

    def create(self):
        return []

    def add(self, state, kinds, values):
        texts = pc.binary_join_element_wise(kinds, values.cast(pa.string()), "-").to_pylist()
        return self.merge(state, [t for t in texts if t is not None])

    def merge(self, one, other):
        return sorted({*one, *other}, key=lambda t: (-len(t), t))[:2]

    def result(self, state):
        return ",".join(state)


def drawn(n=600):
    pick = random.Random(4)
    out = []
    for _ in range(n):
        user = 1 if pick.random() < 0.7 else pick.choice([2, 3, None])  # one key holds most rows
        ts = None if pick.random() < 0.02 else pick.randrange(-20_000, 60_000)
        out.append((user, pick.choice(["a", "bb", None]), ts, None if pick.random() < 0.1 else pick.randrange(500)))
    return out


@pytest.fixture(scope="module")
def df(spark):
    return frame(spark, drawn(), SCHEMA).repartition(5).cache()


def grouped(keys, size, slide, result):
    found = defaultdict(list)
    for row in drawn():
        user, kind, ts, v = row
        if ts is not None:
            first = ts // slide * slide + slide
            for end in range(first, first + size, slide):
                found[tuple({"user": user, "kind": kind}[k] for k in keys), end].append(row)
    return {(*key, end): result(members) for (key, end), members in found.items()}


def as_map(got, out="value"):
    return {tuple(r)[:-1]: r[out] for r in got.collect()}


@pytest.mark.parametrize("keys", [["user"], ["user", "kind"], []])
@pytest.mark.parametrize("slide", [None, 5 * S])
@pytest.mark.parametrize("held", [1, 50_000])
def test_trimmed_mean(df, keys, slide, held):
    def mean(members):
        known = sorted(v for *_, v in members if v is not None)
        return sum(known[1:-1]) / (len(known) - 2) if len(known) > 2 else None

    got = as_map(accumulate(df, keys, TrimmedMean(), ["v"], 20 * S, slide, held=held))
    assert got == grouped(keys, 20_000, 5000 if slide else 20_000, mean)


def test_count_is_the_built_in_count(df):
    got = accumulate(df, ["kind"], Count(), ["v"], 20 * S, 5 * S, "cnt")
    expected = windowed_count(df.where("ts_ms IS NOT NULL"), ["kind"], 20 * S, 5 * S)
    key = lambda r: str(r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, expected.select(*got.columns).collect()), key=key)


def test_states_of_lists_and_two_inputs(df):
    def longest(members):
        texts = {f"{k}-{v}" for _, k, _, v in members if k is not None and v is not None}
        return ",".join(sorted(texts, key=lambda t: (-len(t), t))[:2])

    got = as_map(accumulate(df, ["user"], Longest(), ["kind", "v"], 20 * S))
    assert got == grouped(["user"], 20_000, 20_000, longest)


def test_a_state_for_each_task_and_group_is_shuffled(df):
    """The rows of the busy key are not: five tasks hand on at most five states of a group."""
    plan = accumulate(df, ["user"], Count(), ["v"], 1000 * S)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("Exchange") < plan.rindex("MapInArrow")


def test_no_rows_and_uneven_slides(spark, df):
    assert rows(accumulate(df.where("false"), ["user"], Count(), ["v"], S)) == []
    with pytest.raises(ValueError, match="multiple"):
        accumulate(df, ["user"], Count(), ["v"], 7 * S, 2 * S)
