"""Whitening and vector codes against plain numpy and plain Python."""

import hashlib
import math

import numpy as np
import pytest

from clickloom.llm import vector_codes, whitening

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label int, i long, ids string, x string, codes int, _id int"


def vectors(spark, rows, labels=None, partitions=3):
    labels = labels or [None if k % 4 == 0 else k % 3 for k in range(len(rows))]
    floats = [(i, v and [c if c is None else float(c) for c in v]) for i, v in rows]
    data = [(i, v, g, 1, "s", "t", 2, 3) for (i, v), g in zip(floats, labels, strict=True)]
    return spark.createDataFrame(data, SCHEMA).repartition(partitions)


def some_rows(n, width, seed=3, spread=1.0):
    draw = np.random.default_rng(seed)
    mix = draw.normal(size=(width, width)) * np.linspace(1, 0.05, width)
    x = (draw.normal(size=(n, width)) @ mix * spread + draw.normal(size=width)).astype(np.float32)
    return [(k * 3 % (2 * n) - 5, v) for k, v in enumerate(x.tolist())]


BAD = [(1000, None), (1001, [NAN] * 6), (1002, [1.0, None, 0, 0, 0, 0]), (1003, [INF, 0, 0, 0, 0, 0]), (1004, [0, 0, 0, 0, 0, -INF])]


def by_definition(rows, components=32):
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows], dtype=object)
    n, total = len(x), x.sum(0)
    deviation = ((n * x - total) ** 2).sum(1)
    centred = ((n * x - total) / n).astype(float)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    return deviation, centred @ axes / np.sqrt(values), values / np.trace(centred.T @ centred / n)


@pytest.mark.parametrize("height, columns, components", [(None, 1024, 32), (1, 1024, 32), (7, 3, 2), (50, 5, 4)])
def test_whitening(spark, height, columns, components):
    good = some_rows(120, 6)
    good += [(None, good[0][1]), good[1], good[1]]
    got = whitening.whiten(vectors(spark, good + BAD), components=components, height=height, columns=columns).collect()
    deviation, whitened, explained = by_definition(good, components)
    some = min(components, 6)
    assert len(got) == len(good) * some and {r["n"] for r in got} == {len(good)}
    assert max(r["identity_error"] for r in got) < 1e-9
    assert sorted((r["vec_id"] is None, r["vec_id"], r["component"]) for r in got if r["vec_id"] is not None) == sorted(
        (False, i, c + 1) for i, _ in good if i is not None for c in range(some)
    )
    for c in range(some):
        mine = sorted((r["deviation"], r["whitened"]) for r in got if r["component"] == c + 1)
        sign = 1 if np.allclose(mine, sorted(zip(deviation, whitened[:, c])), rtol=1e-6, atol=1e-6) else -1
        assert np.allclose(np.array(mine, float), np.array(sorted(zip(deviation, sign * whitened[:, c])), float), rtol=1e-9, atol=1e-9)
        assert [r["explained"] for r in got if r["component"] == c + 1] == pytest.approx([explained[c]] * len(good), rel=1e-9)


def test_whitened_rows_keep_their_ids(spark):
    rows = some_rows(80, 6)
    got = {(r["vec_id"], r["component"]): r for r in whitening.whiten(vectors(spark, rows), height=8).collect()}
    deviation, whitened, _ = by_definition(rows)
    for c in range(6):
        signs = {round(got[i, c + 1]["whitened"] / whitened[k, c], 6) for k, (i, _) in enumerate(rows)}
        assert signs in ({1.0}, {-1.0})
    assert all(got[i, 1]["deviation"] == deviation[k] for k, (i, _) in enumerate(rows))


def test_dimensions_without_variance(spark):
    rows = [(i, [v[0], 0.5, v[1], 0.5, v[1], 0.25]) for i, v in some_rows(50, 2)]
    got = whitening.whiten(vectors(spark, rows)).collect()
    assert {r["component"] for r in got} == {1, 2}
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0


def test_tables_without_vectors(spark):
    for rows in ([], BAD[:1], [(1, [])]):
        got = whitening.whiten(vectors(spark, rows))
        assert got.count() == 0 and got.columns[0] == "vec_id"
        if not rows or rows[0][1] is None:
            assert vector_codes.compress_vectors(vectors(spark, rows)).count() == 0


def test_different_lengths_are_an_error(spark):
    mixed = vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0, 3.0])])
    with pytest.raises(ValueError, match="different lengths"):
        whitening.whiten(mixed)
    with pytest.raises(ValueError, match="cannot be cut"):
        vector_codes.compress_vectors(mixed, parts=1, entries=2)


def test_squares_beyond_a_long_are_null():
    assert whitening.squared_lengths(np.array([[2**31, 2**31], [1, -2], [2**32, 0]])) == [None, 5, None]
    assert whitening.squared_lengths(np.array([[3, 4], [-2**30, 0]])) == [25, 2**60]


def lloyd(rows, labels, parts, entries, rounds, scale=4096):
    """The contract by loops over Python's whole numbers."""
    kept = [(i, [math.floor(scale * c) for c in v], g) for (i, v), g in zip(rows, labels)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    size = len(kept[0][1]) // parts
    cut = [[r[1][p * size : (p + 1) * size] for p in range(parts)] for r in kept]
    books = [[f[1][p * size : (p + 1) * size] for f in first] for p in range(parts)]

    def nearest(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for row in cut:
                held.setdefault(nearest(p, row[p])[1], []).append(row[p])
            for k, members in held.items():
                books[p][k] = [sum(c) // len(members) for c in zip(*members)]
    found = [[nearest(p, row[p]) for p in range(parts)] for row in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for (_, _, g), e in zip(kept, errors):
        by_label[g] = by_label.get(g, 0) + e
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(
        ((r[0], "".join(f"{k:02x}" for _, k in f), e, by_label[r[2]], digest) for r, f, e in zip(kept, found, errors)), key=repr
    )


def codes(frame, **settings):
    got = vector_codes.compress_vectors(frame, **settings)
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("block_rows", [1, 16, 4096])
def test_codes(spark, block_rows):
    rows = some_rows(100, 8, spread=0.1)
    rows += [(None, rows[0][1]), rows[1], (rows[2][0], rows[3][1])]
    labels = [None if k % 5 == 0 else k % 3 for k in range(len(rows))]
    settings = {"parts": 4, "entries": 5, "rounds": 3}
    frame = vectors(spark, rows + [(i, v and v + [0, 0]) for i, v in BAD], labels + [1] * len(BAD))
    assert codes(frame, block_rows=block_rows, **settings) == lloyd(rows, labels, **settings)


def test_ties_and_unused_entries(spark):
    """Few values in whole steps: many equal distances, equal first entries, entries that stay unused."""
    draw = np.random.default_rng(8)
    rows = [(k, (v / 4096).tolist()) for k, v in enumerate(draw.integers(-2, 3, (150, 6)).astype(float))]
    rows[1] = (1, rows[0][1])
    labels = [7] * 50 + [None] * 100
    settings = {"parts": 3, "entries": 16, "rounds": 6}
    assert codes(vectors(spark, rows, labels), block_rows=20, **settings) == lloyd(rows, labels, **settings)


def test_fewer_vectors_than_entries(spark):
    rows = some_rows(3, 8)
    labels = [1, 1, 2]
    assert codes(vectors(spark, rows, labels)) == lloyd(rows, labels, 8, 16, 6)


def test_entries_beyond_the_limit_are_an_error(spark):
    with pytest.raises(Exception, match="beyond 134217728"):
        codes(vectors(spark, [(1, [1e9] * 8), (2, [0.0] * 8)]))


@pytest.mark.parametrize("seed", range(6))
def test_balls_from_any_start(seed):
    """Whatever entry a part is known by, the nearest of all is found, with fewer distances than all."""
    draw = np.random.default_rng(seed)
    entries = draw.integers(-40, 40, (16, 3)) * (1 if seed % 2 else 50)
    x = entries[draw.integers(0, 16, 400)] + draw.integers(-6, 7, (400, 3))
    away = ((x[:, None] - entries[None]) ** 2).sum(2)
    balls = vector_codes.Balls(entries)
    best, distance, measured = balls.assign(x, draw.integers(0, 16, 400))
    assert (best == away.argmin(1)).all() and (distance == away.min(1)).all()
    again, _, few = balls.assign(x, best)
    assert (again == best).all() and few < measured <= 400 * 15
    if seed % 2 == 0:
        assert few < 400  # most parts lie in stable cores
