"""Texts of an Arrow batch as one byte array: words, hashes of words, windows of words.

Spark cuts the input into partitions and Arrow batches. Here a batch is walked in slices of
about ``SLICE`` bytes of UTF-8 (one text at least), so that what a task holds does not grow
with the batch. A null text counts as empty. Words are runs of bytes other than space and
09 to 0D, which in UTF-8 never lie inside a character.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.storage import small_batches

SLICE = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

U64 = np.uint64
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        tables = []
        for base in (_MULTIPLIER, _INVERSE):
            table = np.ones(size, U64)
            have, step = 1, base
            while have < size:
                table[have : 2 * have] = table[:have] * U64(step)
                have, step = 2 * have, step * step % (1 << 64)
            tables.append(table)
        _powers[:] = tables
    return _powers[0], _powers[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def hash_sums(data: np.ndarray) -> np.ndarray:
    """Running sums from which the hash of any span follows."""
    power, _ = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * power[: len(data)], out=sums[1:])
    return sums


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, sums: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of the byte spans [starts, ends), equal for equal bytes wherever they lie."""
    _, inverse = _power_tables(len(data) + 1)
    sums = hash_sums(data) if sums is None else sums
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(U64))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the number of words before each text (one more than texts)."""
    n = len(data)
    space = SPACE[data]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[1:], after[:-1] = space[:-1], space[1:]
    if n:
        before[0] = after[-1] = True
    before[offsets[offsets < n]] = True
    after[offsets[offsets > 0] - 1] = True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def owners(counts: np.ndarray) -> np.ndarray:
    """The number of the text of each item, from the number of items of each text."""
    return np.repeat(np.arange(len(counts)), counts)


def windows(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Position of the first word and hash of each window of ``size`` words inside one text."""
    count = np.maximum(np.diff(first) - size + 1, 0)
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    at = np.arange(total) + np.repeat(first[:-1] - np.concatenate(([0], np.cumsum(count)[:-1])), count)
    # runs twice as long from two that follow each other, added up to ``size``
    run, have, factor = hashes, 1, 0xD6E8FEB86659FD93
    code, taken = None, 0
    while True:
        if size & have:
            n = len(hashes) - taken - have + 1
            code = run[:n] if code is None else code[:n] * U64(factor) + run[taken : taken + n]
            taken += have
        if taken == size:
            return at, mixed(code[at])
        run = run[:-have] * U64(factor) + run[have:]
        have, factor = 2 * have, factor * factor % (1 << 64)


def in_text(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Hashes that are equal for equal values of the same text only."""
    return mixed(hashes ^ (owner.astype(U64) * U64(0xA0761D6478BD642F)))


def sums_by_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the values of each text; ``offsets`` bound the texts."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


class SpanIds:
    """Token ids of byte spans, remembered by the span's 64-bit hash: so many spans and ids, and those of one slice."""

    def __init__(self, encode: Callable[[list[bytes]], list[np.ndarray]], limit: int = 1_000_000, most_ids: int = 4_000_000):
        self.encode, self.limit, self.most_ids = encode, limit, most_ids
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.place = np.zeros(0, np.int64)
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(1 << 16, np.int32), 0

    def _learn(self, keys: np.ndarray, spans: list[bytes]) -> None:
        found = self.encode(spans)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        total = int(lengths.sum())
        if self.used + total > len(self.ids):
            grown = np.zeros(max(len(self.ids) * 3 // 2, self.used + total), np.int32)
            grown[: self.used] = self.ids[: self.used]
            self.ids = grown
        if total:
            self.ids[self.used : self.used + total] = np.concatenate(found)
        starts = self.used + np.cumsum(lengths) - lengths
        at = np.searchsorted(self.keys, keys)
        self.place = np.insert(self.place, at, np.arange(len(keys)) + len(self.start))
        self.keys = np.insert(self.keys, at, keys)
        self.start, self.length = np.concatenate((self.start, starts)), np.concatenate((self.length, lengths))
        self.used += total

    def tokens(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all spans in order, and the number of ids of each span."""
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        keys, first, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.limit or self.used > self.most_ids:
            self._clear()
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != keys[inside]
        if new.any():
            raw = data.tobytes()
            self._learn(keys[new], [raw[a:b] for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)])
            at = np.searchsorted(self.keys, keys)
        place = self.place[at][which]
        length, start = self.length[place], self.start[place]
        total = int(length.sum())
        index = np.arange(total) + np.repeat(start - (np.cumsum(length) - length), length)
        return self.ids[index], length


def slices(texts: pa.Array, size: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of consecutive rows with about ``size`` bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    if not len(texts):
        return
    _, bounds, content = texts.buffers()
    offsets = np.frombuffer(bounds, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(content, np.uint8) if content is not None and content.size else np.zeros(0, np.uint8)
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + size, "right")) - 1)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def map_texts(
    docs: DataFrame,
    keep: list[str],
    schema: str,
    function: Callable[[pa.RecordBatch, np.ndarray, np.ndarray], dict],
    text: str = "text",
    size: int = SLICE,
) -> DataFrame:
    """Apply ``function(kept columns, bytes, offsets)`` to slices of the texts; it returns columns by name."""
    from pyspark.sql.types import _parse_datatype_string

    wanted = _parse_datatype_string(schema)
    names = [f.name for f in wanted.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(wanted)
        for batch in batches:
            kept = batch.select(keep)
            for low, high, data, offsets in slices(batch.column("_text"), size):
                out = function(kept.slice(low, high - low), data, offsets)
                arrays = [
                    (a.cast(f.type) if a.type != f.type else a)
                    if isinstance(a, pa.Array)
                    else pa.array(a, f.type)
                    for a, f in ((out[n], f) for n, f in zip(names, arrow, strict=True))
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return small_batches(docs).select(*keep, F.col(text).alias("_text")).mapInArrow(run, wanted)
