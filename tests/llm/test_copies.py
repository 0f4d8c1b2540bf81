"""Fingerprints (3), near duplicates (5), passages (10) and the graph helper."""

import glob
import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest
from llm_helpers import AWKWARD, WORD, by_id, documents, edit, joined, near, prose, scattered

from clickloom.llm import fingerprints, neardup, passages
from clickloom.llm.graph import components
from clickloom.llm.storage import bucketed, shared_folder


@pytest.mark.parametrize("seed", range(3))
def testjoined(spark, seed):
    pick = random.Random(seed)
    pairs = [(pick.randrange(200) * 10**12, pick.randrange(200) * 10**12) for _ in range(110)]
    pairs += [(k, k + 1) for k in range(1, 40)] + [(5000, 5001 + k) for k in range(50)]
    out = components(spark.createDataFrame(pairs, "a long, b long"))
    assert {r["node"]: r["component"] for r in out.collect()} == joined([p for p in pairs if p[0] != p[1]])


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_levels_as_by_definition():
    pick = np.random.default_rng(1)
    data = np.concatenate((np.frombuffer(b"the quick brown fox " * 9, np.uint8), pick.integers(0, 256, 300, np.uint8), np.zeros(150, np.uint8)))
    found = fingerprints.levels(data)
    for at in range(len(data) - 63):
        count = Counter(data[at : at + 64].tolist())
        whole = sum(int(fingerprints._ENTROPY[n]) for n in count.values())
        assert found[at] == whole * 1000 // fingerprints._TOP


def test_features_as_by_definition():
    texts = [prose(k, n).encode() for k, n in enumerate([3, 12, 20, 22, 40, 200])] + [b"", b"a" * 500, b"short"]
    rank = fingerprints.rarity(np.arange(fingerprints.LEVELS)[::-1])
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    hashes, first = fingerprints.features(data, offsets, rank)
    for k, text in enumerate(texts):
        own = np.frombuffer(text, np.uint8)
        if len(own) < 64:
            assert first[k + 1] - first[k] == (len(own) > 0)
            continue
        ranks = rank[fingerprints.levels(own)].tolist()
        won = Counter(min(range(p, p + 64), key=lambda i: (ranks[i], i)) for p in range(len(ranks) - 63))
        chosen = sorted(i for i, n in won.items() if n >= fingerprints.POPULAR) or [min(range(len(ranks)), key=lambda i: (ranks[i], i))]
        different = list(dict.fromkeys(text[i : i + 64] for i in chosen))
        assert first[k + 1] - first[k] == len(different)
        alone, _ = fingerprints.features(own, np.array([0, len(own)]), rank)
        assert alone.tolist() == hashes[first[k] : first[k + 1]].tolist()


@pytest.mark.parametrize("block_rows", [2, 256])
def test_fingerprints(spark, block_rows):
    texts = [*AWKWARD, prose(1, 3000), prose(2, 200), prose(1, 3000), edit(prose(2, 200), 3, 3), prose(4, 200), None]
    ids = [k * 7 - 20 + (1000 if k > 9 else 0) for k in range(len(texts))]
    docs = documents(spark, [*texts, "no id"], ids=[*ids, None])
    out = by_id(fingerprints.fingerprint_documents(docs, block_rows=block_rows))
    assert sorted(out) == sorted(ids)
    rank = fingerprints.rarity(fingerprints.level_counts(docs.where("doc_id is not null or true")))
    known = [fingerprints.fingerprints([(t or "").encode()], rank)[0] for t in texts]
    for k, (doc_id, text) in enumerate(zip(ids, texts, strict=True)):
        text, following = text or "", texts[(k + 1) % len(texts)] or ""
        half = len(text) // 2
        new = text[: len(text) - half] + following[:half]
        code, chain = fingerprints.fingerprints([new.encode()], rank)[0]
        r = out[doc_id]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (known[k][0], code)
        assert r["near_edited"] == fingerprints.likeness(known[k][1], chain)
        assert r["near_next"] == fingerprints.likeness(known[k][1], known[(k + 1) % len(texts)][1])
        assert 0 <= r["near_edited"] <= 1
    assert out[ids[12]]["fingerprint"] == out[ids[14]]["fingerprint"]
    assert fingerprints.likeness(known[13][1], known[15][1]) > 0.7 > 0.2 > fingerprints.likeness(known[13][1], known[16][1])


def test_blocks_of_ids_far_apart(spark):
    """One id far from the others, and two dense stretches: blocks stay small and rise with the ids."""
    ids = spark.range(0, 20_000).unionByName(spark.range(10**9, 10**9 + 20_000)).unionByName(spark.range(10**12, 10**12 + 1))
    ids = ids.unionByName(spark.createDataFrame([(-(2**63),), (2**63 - 1,)], "id long")).withColumnRenamed("id", "doc_id")
    rows = ids.withColumn("block", fingerprints._numbered_blocks(ids, 64)).orderBy("doc_id").collect()
    blocks = [r["block"] for r in rows]
    assert blocks == sorted(blocks) and blocks[0] >= 0
    assert max(blocks.count(b) for b in set(blocks[:20_000:50])) <= 2 * -(-40_003 // fingerprints.SPANS)
    assert max(np.bincount(np.unique(blocks, return_inverse=True)[1])) <= 2 * -(-40_003 // fingerprints.SPANS)


def test_one_fingerprint_and_none(spark):
    docs = documents(spark, ["only text"])
    assert [r["near_next"] for r in fingerprints.fingerprint_documents(docs).collect()] == [1.0]
    assert fingerprints.fingerprint_documents(docs.where("false")).collect() == []


@pytest.mark.parametrize("block", [256, 8])
def test_near_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    passage = prose(99, 50)
    base = prose(5, 120)
    texts = [*AWKWARD, "ONE", "two WORDS", "Two  words"]
    texts += [edit(base, k, k % 9) for k in range(60)]  # one large group, some of it too far from the rest
    texts += [f"{prose(200 + k, k)} {passage}" for k in range(0, 60, 2)]  # a passage in many short texts
    texts += [edit(prose(300 + k // 3, 30 + 40 * (k // 3)), k, k % 3) for k in range(30)]
    texts += [prose(5, 120)] * 4
    sets, expected = near(texts)
    out = by_id(neardup.near_duplicates(documents(spark, texts)))
    assert {k: r["component_id"] for k, r in out.items()} == expected
    assert [out[k]["n_shingles"] for k in range(len(texts))] == [len(s) for s in sets]
    assert all(r["kept"] == (r["component_id"] == k) for k, r in out.items())


def test_a_dense_group_has_few_edges(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 32)
    base, n = prose(5, 200), 600
    docs = documents(spark, [edit(base, k, 2) for k in range(n)])
    rows = neardup.sketches(docs).withColumnRenamed("doc_id", "node")
    edges = neardup.likely_edges(rows.select("node", "n_shingles", "sketch", "short")).distinct()
    assert edges.count() <= 3 * n + (n // 32) ** 2
    found = neardup.links(docs, rows.selectExpr("node", "0L as cluster", "n_shingles"))
    assert found.count() == n - 1
    assert {r["component"] for r in components(found).collect()} == {0}


def test_links_of_a_cluster_of_chains_and_a_large_part(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 8)
    texts = [edit(prose(1, 60), k, k % 2) for k in range(60)]  # a part with blocks of its own
    for chain in range(12):
        words = prose(50 + chain, 60).split(" ")
        for k in range(7):  # each is like its neighbours only
            texts.append(" ".join([*words[4 * k :], *prose(900 + chain, 60).split(" ")[: 4 * k]]))
    sets, expected = near(texts)
    assert len(set(expected.values())) < len(texts)
    docs = documents(spark, texts)
    members = spark.createDataFrame([(k, k % 2, len(s)) for k, s in enumerate(sets)], "node long, cluster long, n_shingles long")
    pairs = [(a, b) for a, x in enumerate(sets) for b, y in enumerate(sets[:a]) if (a - b) % 2 == 0 and 100 * len(x & y) >= 75 * len(x | y)]
    found = {r["node"]: r["component"] for r in components(neardup.links(docs, members)).collect()}
    groups = joined(pairs)
    assert found == {x: min(y for y in groups if groups[y] == groups[x]) for x in groups}


def test_near_duplicates_with_repeated_and_missing_ids(spark):
    a, b = prose(1, 60), prose(2, 60)
    docs = documents(spark, [a, a, b, b, None, "gone"], ids=[7, 7, 7, 9, 3, None])
    out = sorted((r["doc_id"], r["component_id"]) for r in neardup.near_duplicates(docs).collect())
    assert out == [(3, 3), (7, 7), (7, 7), (7, 7), (9, 7)]
    assert neardup.near_duplicates(docs.where("false")).collect() == []


def test_chains():
    line = [(k, k + 10) for k in range(0, 60, 7)]
    far = [(300 + k, 5 + k) for k in range(0, 30, 10)]
    found = passages.chains([*line, *far, (21, 900), (500, 3)])
    assert sorted(map(len, found)) == [len(far), len(line)]
    assert line in found and far in found


def test_chains_after_a_long_passage():
    long = [(k, k) for k in range(0, 1000, 8)]
    second = [(k, k) for k in range(1100, 1155, 8)]
    third = [(k, k - 300) for k in range(1400, 1440, 8)]
    assert sorted(passages.chains([*long, *second, *third])) == [long, second, third]


def test_two_exact_passages_of_one_pair(spark):
    long, short = prose(70, 1000), prose(71, 60)
    texts = [f"{long} {prose(72 + k, 100)} {short} {prose(74 + k, 20)}" for k in range(2)]
    found = passages.chained(passages.several(documents(spark, texts))).where("b IS NOT NULL").collect()
    assert any(r["at_a"][0] < 1000 for r in found) and any(r["at_a"][0] >= 1100 for r in found)
    rows = passages.shared_passages(documents(spark, texts)).collect()
    assert _uncut_runs(texts, rows) == []


def test_edited_passages_are_found(spark):
    pick, texts = random.Random(8), []
    for k in range(60):
        words = prose(500 + k, 60).split()
        changed = [f"new{pick.randrange(10**9)}" if pick.random() < 0.1 else w for w in words]
        texts += [f"{prose(600 + 2 * k + n, 40)} {' '.join(part)} {prose(800 + 2 * k + n, 40)}" for n, part in enumerate((words, changed))]
    rows = passages.shared_passages(documents(spark, texts)).collect()
    assert all(r["similarity"] >= 0.75 for r in rows)
    found = {(r["doc_id"], r["other_id"]) for r in rows}
    assert sum((2 * k + 1, 2 * k) in found for k in range(60)) >= 39  # 32 with 16 neighbours and chains of two


def test_on_a_line():
    pick = random.Random(5)
    for _ in range(200):
        at = np.cumsum([pick.choice((1, 3, 8, 11, 20, 70)) for _ in range(pick.randrange(2, 40))]).tolist()
        points = [(x, x + 7) for x in at]
        assert sorted(passages.on_a_line(points)) == sorted(passages.chains(points))


def test_edited_passages_in_groups_of_six(spark):
    """Documents with an earlier copy that has 75 % of their words in common, copies edited independently."""
    pick, texts, copies = random.Random(11), [], []
    for k in range(20):
        words = prose(5000 + k, 100).split()
        for n in range(6):
            changed = [f"new{pick.randrange(10**9)}" if pick.random() < 0.1 else w for w in words]
            copies.append((k, changed))
            texts.append(f"{prose(6000 + 6 * k + n, 40)} {' '.join(changed)} {prose(7000 + 6 * k + n, 40)}")
    rows = passages.shared_passages(documents(spark, texts)).collect()
    found = {r["doc_id"] for r in rows}
    due = {
        d
        for d, (k, own) in enumerate(copies)
        if any(k == j and sum(x == y for x, y in zip(own, other, strict=True)) >= 75 for j, other in copies[:d])
    }
    assert len(due) > 90 and len(found & due) >= 0.9 * len(due)


@pytest.mark.parametrize("hot", [False, True])
def test_seeds_of_several_documents(spark, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(passages, "SAMPLE", 1)
        monkeypatch.setattr(passages, "OFTEN", 3)
    texts = [f"{prose(k, 30)} {prose(90, 60)} {prose(91 + k % 3, 40)}" for k in range(12)]
    docs = documents(spark, texts)
    where = {}
    for r in passages.seeds(docs).collect():
        where.setdefault(r["code"], []).append((r["doc_id"], r["position"]))
    expected = []
    for places in where.values():
        ids = sorted({d for d, _ in places})
        if len(ids) > 1:
            place = dict(sorted(places))  # a seed occurs once in a document here
            expected += [(d, p, ids[0], place[ids[0]], ids[-1], place[ids[-1]], len(ids) == 2) for d, p in places]
    assert sorted(map(tuple, passages.several(docs).collect())) == sorted(expected)


def test_texts_are_dealt_out_once(spark, monkeypatch):
    """What is joined with the texts moves, the texts stay where they are; no table is left behind."""
    monkeypatch.setattr(passages, "BROADCAST_BYTES", -1)
    name, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    docs = documents(spark, [prose(k, 60) for k in range(20)])
    spark.conf.set(name, "-1")
    try:
        table, texts = bucketed(passages._packed(docs, "text"), "node")
        found = passages._with_texts(spark.range(5).withColumnRenamed("id", "b"), texts, "b")
        assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
        assert sorted(r["b"] for r in found.collect()) == list(range(5))
    finally:
        spark.conf.set(name, before)
    spark.sql(f"DROP TABLE {table}")
    passages.shared_passages(docs).collect()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


def test_passages_leave_no_tables_behind(spark):
    kept = os.path.join(shared_folder(spark), "*-*")
    before = set(glob.glob(kept))
    text = prose(1, 80)
    assert passages.shared_passages(documents(spark, [text, text, f"{text} {text}"])).count() > 0
    assert not [p for p in set(glob.glob(kept)) - before if os.path.basename(p).startswith(("table-", "bucketed_"))]


def test_spans_are_joined_before_they_meet_texts(spark):
    """Spans that overlap, touch or come again are one; while they are few, the texts do not move."""
    spans = [(1, 5, 9), (1, 0, 3), (1, 3, 4), (1, 6, 8), (1, 5, 9), (2, 0, 2), (2, 2, 26)]
    docs = documents(spark, ["abcdefghijklmnopqrstuvwxyz"] * 3)
    name, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(name, "-1")
    try:
        left = passages.without_passages(docs, spark.createDataFrame(spans, "doc_id long, start long, end long"))
        assert "Exchange hashpartitioning" not in left._jdf.queryExecution().executedPlan().toString()
        assert {k: r["text"] for k, r in by_id(left).items()} == {0: "abcdefghijklmnopqrstuvwxyz", 1: "e\njklmnopqrstuvwxyz"}
    finally:
        spark.conf.set(name, before)


def test_prefix_best():
    pick = random.Random(3)
    tree, known = passages.PrefixBest(50), {}
    for k in range(300):
        rank, value = pick.randrange(50), pick.random()
        tree.add(rank, value, k)
        known[rank] = max(known.get(rank, (-np.inf, -1)), (value, k))
        ask = pick.randrange(51)
        assert tree.best(ask) == max([known[r] for r in known if r < ask], default=(-np.inf, -1))


def test_passages(spark):
    shared, other = prose(50, 70), prose(51, 60)
    texts = [*AWKWARD]
    n = len(texts)
    texts += [f"{prose(k, 80)} {shared} {prose(k + 100, 30 * k)}" for k in range(6)]
    texts += [f"{prose(20, 90)} {edit(shared, 4, 3)} {prose(21, 40)}", f"{other}\n{prose(22, 70)}", f"É {prose(23, 70)}\n{other.upper()}"]
    texts += [prose(24, 200), prose(25, 49), f"{prose(26, 60)} {' '.join(shared.split()[:30])} {prose(27, 60)}"]
    out = passages.shared_passages(documents(spark, [*texts, shared], ids=[*range(len(texts)), None]))
    rows = out.collect()
    for r in rows:
        span = WORD.findall(texts[r["doc_id"]][r["start"] : r["end"]])
        assert len(span) == r["n_words"] == r["last_word"] - r["first_word"] >= 50
        assert r["other_id"] < r["doc_id"]
        assert r["similarity"] >= 0.75
    found = {r["doc_id"] for r in rows}
    assert found - set(range(n)) == {*range(n + 1, n + 7), n + 8}
    for k in range(n + 1, n + 6):
        assert any(shared in texts[k][r["start"] : r["end"]] for r in rows if r["doc_id"] == k)
    cut = by_id(passages.without_passages(documents(spark, texts), out))
    assert shared in cut[n]["text"]
    assert all(shared not in cut[k]["text"] and prose(k - n, 80)[:200] in cut[k]["text"] for k in range(n + 1, n + 6))
    assert cut[n + 9]["text"] == texts[n + 9]
    assert cut[0]["text"] is None


def _uncut_runs(texts, rows, n=50):
    """Runs of ``n`` words that a document shares with an earlier one and that no passage of it covers."""
    split = [[w.lower() for w in WORD.findall(t)] for t in texts]
    first, left = {}, []
    for doc, words in enumerate(split):
        for k in range(len(words) - n + 1):
            if first.setdefault(tuple(words[k : k + n]), doc) != doc:
                spans = [(r["first_word"], r["last_word"]) for r in rows if r["doc_id"] == doc]
                if not any(low <= k and k + n <= high for low, high in spans):
                    left.append((doc, k))
    return left


def test_passages_whose_parts_have_other_partners(spark):
    x, y, line = prose(60, 30), prose(61, 30), prose(62, 25)
    long, same = prose(63, 70), "again " * 90
    texts = [prose(k, 60) for k in range(20)]
    for k, part in [(1, x), (8, x), (2, y), (9, y), (3, f"{x} {y}"), (4, f"{x} {y}")]:
        texts[k] = f"{prose(100 + k, 40)} {part} {prose(200 + k, 40)}"
    # the parts in one first document, and a line that the first document has earlier too
    texts[0] = f"{x} {prose(300, 300)} {y}"
    texts[5] = f"{line} {prose(301, 300)} {prose(302, 25)} {line} {prose(303, 20)}"
    texts[6] = f"{prose(304, 40)} {prose(302, 25)} {line} {prose(303, 20)}"
    texts[7], texts[10] = f"{prose(305, 40)} {same} end", f"{same} {prose(306, 40)}"
    # boilerplate of which each text has another stretch
    words = long.split()
    for k in range(11, 20):
        texts[k] = f"{texts[k]} {' '.join(words[k - 11 : k + 44])} {prose(400 + k, 30)}"
    rows = passages.shared_passages(documents(spark, texts)).collect()
    assert _uncut_runs(texts, rows) == []
    assert (4, 3) in {(r["doc_id"], r["other_id"]) for r in rows}


@pytest.mark.parametrize("block", [passages.BLOCK, 1])
def test_edited_passages_whose_seeds_have_other_first_and_last_documents(spark, monkeypatch, block):
    """The first two and last two documents have each part of the passages, far from each other."""
    monkeypatch.setattr(passages, "BLOCK", block)
    texts = scattered()
    found = {(r["doc_id"], r["other_id"]) for r in passages.shared_passages(documents(spark, texts)).collect()}
    assert found >= {(2 + 3 * k + n, 2 + 3 * k) for k in range(4) for n in (1, 2)}
    assert all(other >= 2 and doc < len(texts) - 2 for doc, other in found)


def test_places_meet_those_with_free_seeds_only(spark, monkeypatch):
    """Of 30 documents with two seeds, two of them freely, only these meet all: no row for each two blocks."""
    monkeypatch.setattr(passages, "BLOCK", 1)
    texts, n = [f"{prose(k, 70)} {prose(90, 20)} {prose(100 + k, 70)}" for k in range(30)], 30
    rows = spark.createDataFrame([(k, [72, 80], [5, 6], [k < 2] * 2) for k in range(n)], "node long, at array<int>, codes array<long>, frees array<boolean>")
    packed = passages._packed(documents(spark, texts), "text")
    found = passages.contexts(rows, passages.met_keys(rows), packed)
    assert found.count() <= 4 * n  # 30 a place with blocks that all meet
    same = [prose(1, 160)] * n
    met = passages.meetings(passages.contexts(rows, passages.met_keys(rows), passages._packed(documents(spark, same), "text"))).collect()
    assert {(r["a"], r["b"]) for r in met} == {(a, b) for b in range(2) for a in range(b + 1, n)}


def test_places_of_which_none_is_hopeful(spark):
    texts = [prose(k, 160) for k in range(2)]
    rows = spark.createDataFrame([(k, [72, 80], [5, 6], [True] * 2) for k in range(2)], "node long, at array<int>, codes array<long>, frees array<boolean>")
    found = passages.contexts(rows, passages.met_keys(rows), passages._packed(documents(spark, texts), "text"))
    assert passages.met_chains(passages.meetings(found)).collect() == []


def test_repetitive_texts_have_few_passages(spark):
    texts = [f"{prose(k, 60)} {'again ' * n} {prose(10 + k, 40)}" for k, n in enumerate((400, 900, 650))]
    texts += [f"{prose(20 + k, 60)} {'over and out ' * n} end" for k, n in enumerate((200, 300))]
    rows = passages.shared_passages(documents(spark, texts)).collect()
    assert _uncut_runs(texts, rows) == []
    assert len(rows) < 700  # 1,737 before: about one for each beginning


def test_hopeful_places_by_alignment():
    """No place that ``bounds`` makes a passage of is dropped."""
    pick, passed = np.random.default_rng(7), 0
    for n in range(600):
        x = pick.integers(1, 200, 300)
        y = np.where(pick.random(300) < pick.uniform(0.1, 0.5), pick.integers(1, 200, 300), x)
        if n % 3 == 0:
            y = np.concatenate((y[:170], pick.integers(1, 200, 2), y[170:298]))
        i, j = 140, 140 + int(pick.integers(5, 20))
        y[i : j + 5] = x[i : j + 5]
        around = [np.concatenate((t[i - 64 : i][::-1], t[j + 5 : j + 69])).astype(np.uint8)[None] for t in (x, y)]
        hopeful = bool(passages._hopeful(*around, np.array([j + 5 - i]))[0])
        found = passages.bounds(x, y[i - passages.REACH : j + 5 + passages.REACH], [(i, passages.REACH), (j, passages.REACH + j - i)])
        assert hopeful or found is None
        passed += found is not None
    assert 50 < passed < 550


@pytest.mark.parametrize("seed", range(2))
def test_all_shared_runs_by_brute_force(spark, seed):
    pick = random.Random(seed)
    lines = [prose(1000 + k, pick.randrange(8, 40)) for k in range(25)]
    texts = ["\n".join([pick.choice(lines) if pick.random() < 0.7 else prose(pick.random(), 12) for _ in range(12)]) for _ in range(60)]
    rows = passages.shared_passages(documents(spark, texts)).collect()
    assert _uncut_runs(texts, rows) == []


def test_whole_copies_and_empty_tables(spark):
    text = prose(1, 80)
    docs = documents(spark, [text, text, text, text], ids=[4, 9, 9, 12])
    out = passages.shared_passages(docs)
    assert {(r["doc_id"], r["other_id"]) for r in out.collect()} >= {(9, 4), (12, 4)}
    assert by_id(passages.without_passages(docs, out)).keys() == {4}
    empty = docs.where("false")
    assert passages.shared_passages(empty).collect() == []
    assert passages.without_passages(empty, passages.shared_passages(empty)).collect() == []
