"""Tables that compact themselves, ranking changes, the one pass for late rows, and staged replays."""

import random
from datetime import timedelta as D

import pytest
from helpers import frame, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.operators import lateness
from clickloom.operators.topn import top_n
from clickloom.sources import CompactTable
from clickloom.sources.files import staged_replay
from clickloom.streaming.rankings import ADD, InTimeRanking, RankedCounts

S = D(seconds=1)
PAIR = T.StructType([T.StructField("k", T.LongType()), T.StructField("name", T.StringType()), T.StructField("v", T.LongType())])


def batches(n, seed=3, keys=12):
    pick = random.Random(seed)
    out = []
    for number in range(n):
        chosen = pick.sample(range(keys), pick.randrange(1, 5)) + ([None] if number % 5 == 0 else [])
        out.append([(k, "a" if k is None or k % 2 else None, 100 * number + (k or 0)) for k in chosen])
    return out


def newest(done):
    state = {}
    for batch in done:
        state |= {(k, name): v for k, name, v in batch}
    return {(*key, v) for key, v in state.items()}


def test_files_stay_in_proportion_and_a_repeat_changes_nothing(spark, tmp_path):
    table = CompactTable(spark, f"file://{tmp_path}/t", ["k", "name"], PAIR, fan=3)
    work = batches(50)
    for number, batch in enumerate(work):
        table.put(spark.createDataFrame(batch, PAIR).coalesce(1), number)
        if number in (8, 26, 31):  # the last batch again, by an object that knows nothing: before and after merges
            runs = table.runs()
            again = CompactTable(spark, f"file://{tmp_path}/t", ["k", "name"], PAIR, fan=3)
            again.put(spark.createDataFrame(batch, PAIR).coalesce(1), number)
            assert again.runs() == runs
        if number % 7 == 0 or number in (8, 26, 31):
            assert {tuple(r) for r in table.table().collect()} == newest(work[: number + 1])
        folders = [p.name for p in (tmp_path / "t" / "runs").iterdir()]
        assert len(table.runs()) <= 2 * 4 and set(table.runs()) <= set(folders)
        assert len(folders) <= 16 and len(list((tmp_path / "t" / "lists").glob("[0-9]*"))) <= 2
    assert {tuple(r) for r in table.table(48).collect()} == newest(work[:49])
    near = table.table(where=F.col("k").between(3, 5))
    assert {tuple(r) for r in near.collect()} == {r for r in newest(work) if r[0] in (3, 4, 5)}
    with pytest.raises(ValueError, match="never put"):
        table.table(20)


def test_batches_without_rows(spark, tmp_path):
    table = CompactTable(spark, f"file://{tmp_path}/t", ["k", "name"], PAIR)
    assert table.table().count() == 0
    table.put(None, 0)
    table.put(spark.createDataFrame([(1, "x", 2)], PAIR), 1)
    table.put(None, 2)
    assert rows(table.table()) == [(1, "x", 2)]


COUNTS = "window_end_ms long, item long, cnt long"


def drawn(n, seed, additive):
    pick = random.Random(seed)
    seen, out = {}, []
    for _ in range(n):
        batch = {}
        for _ in range(pick.randrange(0, 9)):
            pair = (pick.randrange(3), pick.randrange(6))
            more = pick.randrange(1, 4)
            batch[pair] = batch.get(pair, 0) + more
            seen[pair] = seen.get(pair, 0) + more
        out.append([(w, i, c if additive else seen[w, i]) for (w, i), c in batch.items()])
    return out


@pytest.mark.parametrize("additive", [False, True])
def test_changes_fold_to_the_ranking_after_every_batch(spark, tmp_path, additive):
    ranked = RankedCounts(spark, f"file://{tmp_path}/r", T.StructField("item", T.LongType()), 2, fan=2)
    counts, before = {}, set()
    for number, batch in enumerate(drawn(6, 4, additive)):
        given = spark.createDataFrame(batch, COUNTS)
        for _ in range(2 if number in (2, 3) else 1):  # a repeated batch overwrites what it did
            ranked.write(given, number, additive)
        for w, i, c in batch:
            counts[w, i] = counts.get((w, i), 0) + c if additive else c
        whole = spark.createDataFrame([(w, i, c) for (w, i), c in counts.items()], COUNTS)
        now = set(rows(top_n(whole, 2, "item"), "window_end_ms", "item", "cnt", "row_num"))
        names = ["window_end_ms", "item", "cnt", "row_num"]
        assert set(rows(ranked.folded(), *names)) == now
        found = {(r[ADD], *[r[n] for n in names]) for r in ranked.changes().where(F.col("_batch") == number).collect()}
        assert found == {(True, *r) for r in now - before} | {(False, *r) for r in before - now}
        before = now


def test_no_changes_at_all(spark, tmp_path):
    ranked = RankedCounts(spark, f"file://{tmp_path}/r", T.StructField("item", T.LongType()), 2)
    ranked.write(spark.createDataFrame([], COUNTS), 0)
    assert ranked.changes().count() == ranked.folded().count() == 0


LOG = "seq long, ts_ms long, url string, method string"


def test_one_pass_gives_what_two_give(spark):
    """Late rows within the allowance update their windows in a later batch; beyond it they are put aside."""
    pick = random.Random(9)
    data = []
    for seq in range(400):
        late = pick.choice([0, 0, 0, 0, 3000, 12_000, 40_000])
        data.append((seq, max(0, 500 * seq - late), f"/{pick.randrange(4)}", pick.choice(["GET", "GET", "POST"])))
    data[7] = (7, 10, None, "GET")
    whole = frame(spark, data, LOG)
    one = InTimeRanking(spark, "t", T.StructField("url", T.StringType()), 2, ["seq"], S, 20 * S, 5 * S, 10 * S, ("method", "GET"))
    for number in range(5):
        part = whole.where((F.col("seq") >= 80 * number) & (F.col("seq") < 80 * (number + 1)))
        for _ in range(2 if number == 3 else 1):
            one.write(part, number)
    tagged = lateness.tag_late(lateness.arrival_watermark(whole, ["seq"], S), 20 * S, 5 * S, 10 * S).where("method = 'GET'")
    late = rows(tagged.where("outcome = 'late'"), "seq", "wm_ms")
    assert late and rows(one.router.rows(whole.schema), "seq", "wm_ms") == late
    names = ["window_end_ms", "url", "cnt", "row_num"]
    ranked = top_n(lateness.accepted_counts(tagged, ["url"], 20 * S, 5 * S, 10 * S), 2, "url")
    key = lambda r: [str(v) for v in r]
    got = [tuple(r) for r in one.ranking.folded().select(*names).collect()]
    assert sorted(got, key=key) == sorted((tuple(r) for r in ranked.select(*names).collect()), key=key)
    assert one.ranking.changes().where(f"NOT {ADD}").count() > 0


def test_staged_replay_goes_batch_by_batch(spark, tmp_path):
    data = spark.createDataFrame([(k, k % 4) for k in range(41)] + [(100, 9)], "id long, b long")
    closing = spark.createDataFrame([(-1, -1)], "id long, b long")
    stream = staged_replay(data, F.col("b"), F.desc("id"), closing, f"file://{tmp_path}/rows", 3)
    seen = []

    def keep(batch, number):
        seen.append(sorted(r["id"] for r in batch.collect()))

    query = stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert seen == [*([k for k in range(41) if k % 4 == b] for b in range(4)), [100], [-1]]
