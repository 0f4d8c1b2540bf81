"""SentencePiece encoding (1) and packing (7), against the libraries on whole texts."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import AWKWARD, by_id, documents, prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickloom.llm import packing, sentencepieces

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [*AWKWARD, prose(1, 800), "<s> </s> <unk> <0x41> <|endoftext|> it's I'LL 'Tis", prose(1, 800), "don't 'sx 's.　…. a…b é. È, 1.5%"]


def test_encode_and_decode(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = documents(spark, [*TEXTS, "twice"], ids=[*range(len(TEXTS)), 3])
    out = sentencepieces.encode_documents(docs, PIECES, with_ids=True).collect()
    assert len(out) == len(TEXTS) + 1
    for row in out:
        texts = [TEXTS[row["doc_id"]] or ""] + (["twice"] if row["doc_id"] == 3 else [])
        expected = [library.encode(t) for t in texts]
        assert row["ids"] in expected
        ids = row["ids"]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded"] == library.decode(ids)
        assert row["decoded_sha256"] == hashlib.sha256(row["decoded"].encode()).hexdigest()


@given(st.text(st.characters(codec="utf-8"), max_size=80))
@settings(max_examples=150, deadline=None)
def test_any_text_is_encoded_as_by_the_library(text):
    model = sentencepieces.piece_model(PIECES)
    raw = np.frombuffer(text.encode(), np.uint8)
    ids, bounds = model.encode(raw, np.array([0, len(raw)]))
    expected = model.library.encode(text)
    assert ids.tolist() == expected
    assert model.decode(ids, bounds)[0].decode() == model.library.decode(expected)


@given(st.text(st.characters(codec="utf-8"), max_size=60))
@settings(max_examples=150, deadline=None)
def test_any_text_is_tokenized_as_by_the_library(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    tokenizer = packing.word_tokenizer(WORDS)
    ids, _ = tokenizer(raw, np.array([0, len(raw)]))
    assert ids.tolist() == [*tokenizer.library.encode(text, add_special_tokens=False).ids, packing.END]


@pytest.mark.parametrize("n", [*range(0, 400), *range(900, 1100), *range(1900, 4300, 7)])
def test_cut_lengths(n):
    lengths = packing.cut_lengths(n)
    assert sum(lengths) == n
    assert all(0 < x <= packing.CAPACITY for x in lengths)
    for x in lengths:
        k = packing.CAPACITY // x
        assert k >= packing.SMALL or packing.CAPACITY - k * x <= packing.CAPACITY // packing.WASTE


def _check_packed(rows, texts):
    tokenizer = Tokenizer.from_file(WORDS)
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    for doc_id, own in pieces.items():
        ids = [*tokenizer.encode(texts[doc_id] or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            part = ids[at : at + r["length"]]
            assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.CAPACITY
    return sequences


def test_pack_documents(spark):
    texts = [*TEXTS, *(prose(k, 40 + 37 * k) for k in range(60))]
    rows = packing.pack_documents(documents(spark, texts), WORDS).collect()
    sequences = _check_packed(rows, texts)
    assert {r["doc_id"] for r in rows} == set(range(len(texts)))
    tokens = sum(r["length"] for r in rows)
    assert tokens / (packing.CAPACITY * len(sequences)) > 0.97


def test_pack_in_many_shards(spark):
    rows = [(k, 0, 50 + k % 120, k, 50 + k % 120) for k in range(3000)]
    pieces = spark.createDataFrame(rows, packing.PIECES)
    packed = packing.pack(pieces, shard_rows=100).collect()
    assert sorted((r["doc_id"], r["length"]) for r in packed) == sorted((r[0], r[2]) for r in rows)
    sequences = {}
    for r in packed:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in sequences.values():
        own.sort()
        assert [a for a, _ in own] == list(np.cumsum([0, *(n for _, n in own)])[:-1])
        assert sum(n for _, n in own) <= packing.CAPACITY
    assert sum(r[2] for r in rows) / (packing.CAPACITY * len(sequences)) > 0.93


def test_a_class_of_very_many_pieces_is_no_single_group(spark, monkeypatch):
    """200,000 empty texts: no (class, shard) of any round has over twice the rows a shard is meant to have."""
    seen = []
    filled = packing._filled

    def watched(pieces, shards, level):
        rows = filled(pieces, shards, level)
        seen.append((level, rows.groupBy("k", "shard").count().agg(F.max("count")).first()[0]))
        return rows

    monkeypatch.setattr(packing, "_filled", watched)
    n = 200_000
    rows = spark.range(0, n, 1, 8).selectExpr("id doc_id", "0L start", "1L length", "id ids_crc32", "1L doc_tokens")
    monkeypatch.setattr(packing, "SHARD_SEQUENCES", 4)
    packed = packing.pack(rows)
    assert packed.agg(F.count("*"), F.countDistinct("doc_id")).first() == (n, n)
    assert packed.select("sequence_id", "offset").distinct().count() == n
    assert packed.select("sequence_id").distinct().count() == -(-n // packing.CAPACITY)
    assert [level for level, _ in seen] == list(range(len(seen))) and 3 <= len(seen) <= 5
    assert all(most <= 2 * 4 * packing.CAPACITY for _, most in seen)


def test_nothing_to_encode_or_pack(spark):
    docs = documents(spark, ["x"]).where("false")
    assert sentencepieces.encode_documents(docs, PIECES).collect() == []
    assert packing.pack_documents(docs, WORDS).collect() == []


def test_repeated_rows_and_rows_without_id(spark):
    docs = documents(spark, ["a b", "a b", None], ids=[4, 4, None])
    rows = packing.pack_documents(docs, WORDS).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == ["4", "4", "None"]
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == 3
    assert by_id(sentencepieces.encode_documents(docs, PIECES))[None]["n_tokens"] == 0
