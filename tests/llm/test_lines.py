"""Repeated lines: the hash and its arrays by definition, documents against a plain walk."""

import random
from collections import defaultdict

import numpy as np
import pytest
from llm_helpers import AWKWARD, documents, prose

from clickloom.llm import lines

WHITE = " \t\n\x0b\x0c\r"


def some_keys(n, seed=1):
    keys = np.zeros(n, lines.KEY)
    draw = np.random.default_rng(seed)
    keys["high"], keys["low"] = draw.integers(0, 2**63, n), draw.integers(0, 2**63, n)
    return keys


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
@pytest.mark.parametrize("levels", [0, 1, 24])
def test_places_are_the_numbers_below_the_count(n, levels):
    keys = some_keys(n)
    assert sorted(lines.PerfectHash.build(keys, levels).places(keys)) == list(range(n))


def test_keys_that_differ_in_one_half_only():
    keys = some_keys(3000)
    keys["high"][:1500] = 7
    keys["low"][1500:] = 9
    assert sorted(lines.PerfectHash.build(keys).places(keys)) == list(range(3000))


def test_arrays_hold_counts_and_last_holders():
    keys = some_keys(400)
    which = np.random.default_rng(2).integers(0, 300, 2000)
    ids = np.arange(2000) - 1000
    named = which % 7 > 0
    row = lines.LineCounts.build(0, keys[which], np.ones(2000, np.int64), ids, named)
    counts, lasts, has = lines.LineCounts(row).find(keys)
    for k in range(400):
        mine = ids[which == k]
        assert counts[k] == len(mine)  # 0 for the keys that were not put in: their fingerprints differ
        if len(mine):
            assert has[k] == (k % 7 > 0) and lasts[k] == mine.max()


def walked(rows, least=20, documents=3):
    """(kept text, lines, dropped) of each (id, text), by dictionaries of whole keys."""

    def key(line):
        made = line.strip(WHITE)
        made = "".join(c.lower() if "A" <= c <= "Z" else c for c in made)
        return made if len(made) >= least else None

    holders = defaultdict(list)
    for number, (i, text) in enumerate(rows):
        for k in {key(line) for line in (text or "").split("\n")} - {None}:
            holders[k].append((number, i))
    out = []
    for i, text in rows:
        kept, split = [], (text or "").split("\n")
        for line in split:
            held = [h for _, h in holders.get(key(line), [])]
            last = max((h for h in held if h is not None), default=None)
            if len(held) < documents or i == last:
                kept.append(line)
        out.append((i, "\n".join(kept), len(split), len(split) - len(kept)))
    return sorted(out, key=repr)


def found(frame):
    return sorted(((r["doc_id"], r["kept_text"], r["n_lines"], r["n_dropped"]) for r in frame.collect()), key=repr)


def crowded(n=90):
    pick = random.Random(5)
    common = [f"Common line number {k} of them all" for k in range(6)]
    shapes = [lambda s: s, str.upper, lambda s: f"  {s}\t\r", lambda s: s + " ", lambda s: s.replace("C", "Ç")]
    out = []
    for k in range(n):
        rows = [prose(k, 8), "short", ""] + [pick.choice(shapes)(pick.choice(common)) for _ in range(pick.randrange(4))]
        if k % 3 == 0:
            rows.append("This line stands in a third of all documents")
        pick.shuffle(rows)
        out.append("\n".join(rows))
    return out


@pytest.mark.parametrize("flush, shard_bytes", [(3, 1 << 20), (1000, 500)])
def test_documents(spark, flush, shard_bytes):
    texts = crowded() + AWKWARD + [AWKWARD[-2]] * 3 + ["é" * 19 + "\n" + "é" * 20] * 4 + ["\n" * 5]
    ids = [k * 7 % 200 - 50 for k in range(len(texts))]
    got = lines.dedup_lines(documents(spark, texts, ids=ids), flush=flush, shard_bytes=shard_bytes)
    assert found(got) == walked(list(zip(ids, texts)))


def test_rows_without_an_id_and_repeated_ids(spark):
    a, b, c, d = (f"line {x} that is long enough to count" for x in "abcd")
    rows = [(None, a), (None, a), (None, a), (1, b), (1, f"{b}\nx"), (1, b), (None, f"{c}\n{b}"), (2, c), (3, c), (4, f"{d}\n{d}\n{d}")]
    schema = "doc_id long, text string, _lines int, _lost string"
    frame = spark.createDataFrame([(i, t, 1, "") for i, t in rows], schema)
    got = lines.dedup_lines(frame)
    assert got.columns == ["doc_id", "text", "_lines", "_lost", "kept_text", "n_lines", "n_dropped"]
    assert found(got) == walked(rows)
    # Three lines without any holder's id stay; a line three times in one document is in one document.
    assert {r[1] for r in found(got) if r[0] is None} == {a, ""}


def test_settings_and_clashing_names(spark):
    texts = ["tiny\nsame", "Same \nother", "same"]
    got = lines.dedup_lines(documents(spark, texts), least=4, documents=2).withColumnRenamed("kept_text", "text2")
    assert {r["doc_id"]: r["text2"] for r in got.collect()} == {0: "tiny", 1: "other", 2: "same"}
    again = lines.dedup_lines(got.withColumnRenamed("text2", "kept_text").select("doc_id", "text", "kept_text", "n_lines"))
    assert again.columns == ["doc_id", "text", "kept_text", "n_lines", "kept_text_", "n_lines_", "n_dropped"]


def test_empty_table(spark):
    assert found(lines.dedup_lines(documents(spark, ["x"]).where("false"))) == []


def test_very_long_text_and_a_very_common_line(spark):
    common = "the line that every document has in common"
    texts = ["\n".join(f"{prose(k, 6)} {k}\n{common}" for k in range(20_000))] + [f"{common}\nown line of document {k}" for k in range(40)]
    got = lines.dedup_lines(documents(spark, texts), flush=700)
    assert found(got) == walked(list(enumerate(texts)))
