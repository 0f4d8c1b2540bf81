"""The pipeline's stages and the registered queries."""

import re
import zlib

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pytest
from llm_helpers import AWKWARD, WORD, by_id, documents, near, prose, scattered
from tokenizers import Tokenizer

import __spark_entry__ as entry
from clickloom.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def test_all_operators_are_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_as_in_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    result = con.execute(SQL[name])
    names = [d[0] for d in result.description]
    expected = sorted(map(repr, result.fetchall()))
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert sorted(repr(tuple(r)) for r in got.select(*names).collect()) == expected


def test_quality_and_language_on_held_out_rows(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op2_quality_trees"](spark, SF).collect() if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in rows) >= 0.9 * len(rows)
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = [r for r in QUERIES["op6_language_mixture"](spark, SF).collect() if r["held_out"]]
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in rows) >= 0.95 * len(rows)


def test_stages_on_awkward_rows(spark, tmp_path):
    shared = prose(50, 70)
    texts = [*AWKWARD, prose(1, 90), prose(1, 90), f"{prose(2, 60)} {shared}", f"{prose(3, 60)} {shared}", prose(4, 30) + " password=abcdefghijklm x"]
    docs = documents(spark, [*texts, prose(5, 20)], ids=[*range(len(texts)), None])
    n, at = len(AWKWARD), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.schema == docs.schema
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        at[name] = by_id(docs)
    assert not {0, 1, 2, 11} & set(at["language"])
    assert set(at["language"]) >= {3, 4, 7, *range(n, n + 5), None}
    assert set(at["language"]) - set(at["near_duplicates"]) == {n + 1}
    assert shared in at["passages"][n + 2]["text"] and shared not in at["passages"][n + 3]["text"]
    assert at["secrets"][n + 4]["text"] == prose(4, 30) + " [secret] x"
    assert set(at["packing"]) == set(at["secrets"])


def test_edited_passages_that_only_middle_documents_have_are_cut(spark):
    texts = scattered()
    cut = by_id(corpus_pipeline.without_repeats(spark, documents(spark, texts), SF))
    left = {k: len(WORD.findall(cut[k]["text"])) for k in cut}
    first = {2, 5, 8, 11}
    assert all(left[k] == 180 for k in first) and all(left[k] < 125 for k in {*range(2, 14)} - first)


def test_language_stage_keeps_mixed_and_unlearned_texts(spark):
    parts = {"en": "the of and ing", "de": "sch keit ung ich", "fr": "eau oi que ment"}
    texts = [" ".join(words.split() * 20) for words in parts.values() for _ in range(8)]
    langs = [lang for lang in parts for _ in range(8)]
    texts, langs = [*texts, " ".join(" ".join(parts.values()).split() * 20), "12 34", None], [*langs, "en", "en", "en"]
    for given in (langs, [None] * len(texts)):
        kept = corpus_pipeline.known_language(spark, documents(spark, texts, given), SF)
        assert {r["doc_id"] for r in kept.collect()} == set(range(len(texts) - 2))


def test_stages_by_brute_force(spark, tmp_path):
    """Each stage on what its predecessor kept of the smallest table, against plain Python."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [{r["doc_id"]: r["text"] for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        texts.append({r["doc_id"]: r["text"] for r in docs.collect()})
    raw, spoken, single, cut, clean = texts
    assert set(spoken) == {k for k, t in raw.items() if any(c.isalpha() for c in t or "")}

    ids = sorted(spoken)
    _, component = near([spoken[k] for k in ids])
    assert sorted(single) == [k for n, k in enumerate(ids) if component.get(n, n) == n]

    # no run of 66 words (a passage, and what alignment may leave at its ends) is left in two documents
    seen = {}
    for k, t in cut.items():
        words = WORD.findall(t.lower())
        for n in range(len(words) - 65):
            assert seen.setdefault(tuple(words[n : n + 66]), k) == k
    for k, t in single.items():
        left = iter(WORD.findall(t))
        assert all(w in left for w in WORD.findall(cut.get(k, "")))  # words are only taken out

    key = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12,}""", re.I | re.A)
    for k, t in clean.items():
        assert not key.search(t) and not re.search("[0-9a-f]{16,}|AKIA[A-Z0-9]{14,}", t)
        assert ("[secret]" in t) or t == cut[k]
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in rows} == set(clean)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for k, t in clean.items():
        own = sorted((r for r in rows if r["doc_id"] == k), key=lambda r: r["start"])
        found = [*library.encode(t, add_special_tokens=False).ids, 1]
        assert sum(r["length"] for r in own) == len(found)
        for r in own:
            part = np.array(found[r["start"] : r["start"] + r["length"]], "<u4")
            assert zlib.crc32(part.tobytes()) == r["ids_crc32"]


def test_pipeline_runs(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} <= set(rows[0].asDict())
    documents_of = {r["doc_id"] for r in rows}
    kept = {r["doc_id"] for r in QUERIES["op5_bottom_k"](spark, SF).collect() if r["kept"]}
    assert documents_of <= kept
    assert len(documents_of) > 0.9 * len(kept)


def test_stages_on_no_rows(spark):
    docs = documents(spark, ["x"]).where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == []


def test_texts_under_one_id_leave_the_same_row_each_time(spark):
    texts = [prose(k, 60) for k in range(4)]
    docs = documents(spark, [*texts, prose(9, 60)], ids=[5, 5, 5, 5, 6])
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    found = {
        tuple(sorted((r["doc_id"], r["text"]) for r in stage(spark, rows, SF).collect()))
        for rows in (docs, docs.orderBy("text").coalesce(1), docs.repartition(7))
    }
    assert len(found) == 1
    assert sorted(i for i, _ in found.pop()) == [5, 6]
