"""The shared text helpers against plain Python."""

import numpy as np
import pytest
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import WORD

from clickloom.llm.storage import small_batches
from clickloom.llm.text import SpanIds, slices, span_hashes, windows, words

TEXTS = st.lists(st.one_of(st.none(), st.text("ab \n\té日", max_size=30)), max_size=8)


@given(TEXTS, st.integers(1, 40))
@settings(max_examples=100, deadline=None)
def test_words_and_windows(texts, size):
    seen = {}
    rows = 0
    for low, high, data, offsets in slices(pa.array(texts, pa.string()), size):
        assert low == rows
        rows = high
        starts, ends, first = words(data, offsets)
        hashes = span_hashes(data, starts, ends)
        at, code = windows(hashes, first, 2)
        pairs = dict(zip(at.tolist(), code.tolist(), strict=True))
        raw = data.tobytes()
        for k, text in enumerate(texts[low:high]):
            expected = WORD.findall(text or "")
            own = range(first[k], first[k + 1])
            assert [raw[starts[i] : ends[i]].decode() for i in own] == expected
            for i, word in zip(own, expected, strict=True):
                assert seen.setdefault(word, hashes[i]) == hashes[i]
            assert [i in pairs for i in own] == [i + 1 < first[k + 1] for i in own]
            for i in list(own)[:-1]:
                j = i - first[k]
                name = (expected[j], expected[j + 1])
                assert seen.setdefault(name, pairs[i]) == pairs[i]
    assert rows == len(texts)
    assert len(set(seen.values())) == len(seen)


def test_remembered_spans_with_a_small_memory():
    cache = SpanIds(lambda spans: [np.frombuffer(s, np.uint8).astype(np.int32) for s in spans], limit=5)
    for text in (b"ab cd ab ef", b"gh ij kl mn cd", b"ab ab"):
        data = np.frombuffer(text, np.uint8)
        starts, ends, _ = words(data, np.array([0, len(data)]))
        ids, counts = cache.tokens(data, starts, ends)
        assert bytes(ids.tolist()) == text.replace(b" ", b"")
        assert counts.tolist() == [2] * len(starts)


@pytest.mark.parametrize("set_to, expected", [("64m", "8388608b"), ("1g", "8388608b"), ("512k", "512k"), ("4096b", "4096b")])
def test_batches_are_bounded_by_bytes(spark, set_to, expected):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, set_to)
        small_batches(spark.range(1))
        assert spark.conf.get(name) == expected
    finally:
        spark.conf.set(name, before)


def test_remembered_ids_are_bounded():
    cache = SpanIds(lambda spans: [np.frombuffer(s, np.uint8).astype(np.int32) for s in spans], most_ids=50)
    for k in range(40):
        data = np.frombuffer(f"span{k}".encode() * 3, np.uint8)
        ids, length = cache.tokens(data, np.array([0, 2]), np.array([len(data), 9]))
        assert ids.tolist() == [*data.tolist(), *data[2:9].tolist()]
        assert length.tolist() == [len(data), 7] and cache.used <= 50 + 30 + len(data)
