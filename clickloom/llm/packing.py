"""Pack documents into token sequences by length classes of reciprocal capacity.

A document's tokens are cut by a rule that looks at their number only: whole sequences first,
then pieces of exactly ``capacity // k`` tokens while leaving the rest whole would waste much.
A piece of length ``l`` belongs to class ``k = capacity // l``, and every sequence of class ``k``
takes exactly ``k`` pieces, so each (class, shard) fills its sequences without knowing of the
others. A shard has pieces for ``SHARD_SEQUENCES`` sequences or more. What does not fill one is dealt
out to fewer shards in the next round, until a class has one shard; its last partial sequence's
worth goes into mixed sequences. Only piece descriptions are shuffled, never tokens.

Null or empty texts have one token, the end token. Repeated rows are packed once each. A null
``doc_id`` stays null. Extra columns are ignored. No rows give no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.storage import stored
from clickloom.llm.text import LOWER, SPACE, SpanIds, map_texts

CAPACITY = 2048
END = 1
#: A piece of at most a sixteenth of a sequence, or one that wastes at most a fiftieth of it, is left whole.
SMALL, WASTE = 16, 50
#: Pieces that one (class, shard) numbers; a bound of a task's sort, not of the data.
SHARD_ROWS = 4_096
#: Sequences that a shard fills at least, so that few of its pieces are left over.
SHARD_SEQUENCES = 64
#: Rounds and the mixed sequences number theirs apart; each round leaves a 64th of the one before.
LEVELS = 16

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cut_lengths(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of a document of ``n`` tokens, in order."""
    lengths = [capacity] * (n // capacity)
    rest = n % capacity
    while rest:
        k = capacity // rest
        if k >= SMALL or capacity - k * rest <= capacity // WASTE:
            lengths.append(rest)
            break
        lengths.append(capacity // (k + 1))
        rest -= lengths[-1]
    return lengths


# Kinds of bytes for cutting a text where the tokenizer's own split always cuts it.
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "'"]] = True


def _spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans that the tokenizer treats apart: cut at white space and between an ASCII letter and punctuation."""
    n = len(data)
    space = SPACE[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    letter, punct = _LETTER[data], _PUNCT[data]
    cut[1:n] |= (letter[:-1] & punct[1:]) | (punct[:-1] & letter[1:]) | (space[:-1] != space[1:])
    at = np.flatnonzero(cut)
    starts, ends = at[:-1], at[1:]
    inside = ~space[starts] if n else np.zeros(0, bool)
    starts, ends = starts[inside], ends[inside]
    return starts, ends, np.searchsorted(starts, offsets)


class WordTokenizer:
    """Ids as the ``tokenizers`` library gives them for whole texts, without added special tokens."""

    SEPARATOR = "\x00"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        separator = self.library.encode(self.SEPARATOR, add_special_tokens=False).ids
        self.separator = separator[0] if len(separator) == 1 else None
        self.cache = SpanIds(self._encode)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int32) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, spans: list[bytes]) -> list[np.ndarray]:
        """All spans as one text, with a separator between them that is a token of its own."""
        texts = [s.decode() for s in spans]
        if self.separator is None or any(self.SEPARATOR in t for t in texts):
            return self._whole(texts)
        out = []
        for low in range(0, len(texts), 4096):
            part = texts[low : low + 4096]
            ids = np.array(self.library.encode_batch_fast([f" {self.SEPARATOR} ".join(part)], add_special_tokens=False)[0].ids, np.int32)
            at = np.flatnonzero(ids == self.separator)
            if len(at) != len(part) - 1:
                out += self._whole(part)
            else:
                out += [x[1:] if k else x for k, x in enumerate(np.split(ids, at))]
        return out

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, each with the end token, and the offsets of the texts in them."""
        lower = LOWER[data]
        starts, ends, first = _spans(lower, offsets)
        ids, counts = self.cache.tokens(lower, starts, ends)
        bounds = np.concatenate(([0], np.cumsum(counts)))[first]
        raw = data.tobytes()
        odd = [k for k in range(len(offsets) - 1) if any(s in raw[offsets[k] : offsets[k + 1]] for s in self.special)] if any(s in raw for s in self.special) else []
        if odd:
            parts = [ids[bounds[k] : bounds[k + 1]] for k in range(len(offsets) - 1)]
            for k, found in zip(odd, self._whole([raw[offsets[k] : offsets[k + 1]].decode() for k in odd]), strict=True):
                parts[k] = found
            ids = np.concatenate(parts)
            bounds = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        ids = np.insert(ids, bounds[1:], END)
        return ids, bounds + np.arange(len(bounds))


_tokenizers: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer, and one cache, for a task; for the worker, where it has this package itself."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def cut_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of each document: ``doc_id, start, length, ids_crc32, doc_tokens``."""

    def cut(kept: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> dict:
        ids, bounds = word_tokenizer(tokenizer)(data, offsets)
        content = memoryview(ids.astype("<u4").tobytes())
        rows: list[tuple[int, int, int, int, int]] = []
        for k, (low, high) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            start = 0
            for length in cut_lengths(high - low, capacity):
                a = 4 * (low + start)
                rows.append((k, start, length, zlib.crc32(content[a : a + 4 * length]), high - low))
                start += length
        owner, *columns = (list(c) for c in zip(*rows, strict=True))
        return {"doc_id": kept.column("doc_id").take(pa.array(owner, pa.int64()))} | dict(
            zip(("start", "length", "ids_crc32", "doc_tokens"), columns, strict=True)
        )

    return map_texts(docs, ["doc_id"], PIECES, cut)


def _identity(level: int, shards: Column, shard: Column, number: Column, k: Column) -> Column:
    """A number for each sequence that no other (level, class, shard) uses."""
    return ((number * shards + shard) * F.lit(CAPACITY + 1) + k) * F.lit(LEVELS) + F.lit(level)


def _filled(pieces: DataFrame, shards: DataFrame, level: int) -> DataFrame:
    """Number the pieces of each (class, shard) and put ``k`` to a sequence; ``full`` tells whole sequences."""
    rows = pieces.join(F.broadcast(shards), "k")  # a row for each class, at most 2 * sqrt(capacity)
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.col("shards")))
    group = Window.partitionBy("k", "shard")
    order = group.orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    return (
        rows.withColumn("number", F.row_number().over(order) - 1)
        .withColumn("count", F.count(F.lit(1)).over(group))
        .withColumn("bin", F.expr("number div k"))
        .withColumn("full", F.expr("(bin + 1) * k <= count"))
        .withColumn("sequence_id", _identity(level, F.col("shards"), F.col("shard"), F.col("bin"), F.col("k")))
        .withColumn(
            "offset",
            F.coalesce(
                F.sum("length").over(
                    Window.partitionBy("k", "shard", "bin").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ).cast("long"),
        )
    )


def _mixed(frames: Iterator[pd.DataFrame], capacity: int) -> Iterator[pd.DataFrame]:
    """Longest first, into the first sequence with room."""
    rows = pd.concat(list(frames), ignore_index=True)
    rows = rows.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable", ignore_index=True)
    room: list[int] = []
    place, offset = [], []
    for length in rows["length"].tolist():
        b = next((i for i, r in enumerate(room) if r >= length), len(room))
        if b == len(room):
            room.append(capacity)
        place.append(b)
        offset.append(capacity - room[b])
        room[b] -= length
    rows["sequence_id"] = np.array(place, np.int64) * LEVELS * (CAPACITY + 1) + LEVELS - 1
    rows["offset"] = np.array(offset, np.int64)
    yield rows


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of at most ``capacity`` tokens."""
    columns = [f.split()[0] for f in PIECES.split(", ")]
    whole = [*columns, "sequence_id", "offset"]
    left = stored(pieces.select(*columns).withColumn("k", F.expr(f"{capacity} div length")))
    done: list[DataFrame] = []
    most = 2
    while most > 1:
        size = F.greatest(F.lit(shard_rows), F.lit(SHARD_SEQUENCES) * F.col("k"))
        shards = stored(left.groupBy("k").agg(F.ceil(F.count(F.lit(1)) / F.first(size)).cast("long").alias("shards")))
        most = shards.agg(F.max("shards")).first()[0] or 0
        filled = stored(_filled(left, shards, len(done)).select(*columns, "k", "sequence_id", "offset", "full"))
        done.append(filled.where("full").select(*whole))
        left = filled.where(~F.col("full")).select(*columns, "k")
    # at most k - 1 pieces of each class k, whatever the size of the corpus
    mixed = left.select(*columns).coalesce(1).mapInPandas(
        lambda frames: (out for out in _mixed_or_nothing(frames, capacity)), f"{PIECES}, sequence_id long, offset long"
    )
    return reduce(DataFrame.unionByName, [*done, mixed.select(*whole)])


def _mixed_or_nothing(frames: Iterator[pd.DataFrame], capacity: int) -> Iterator[pd.DataFrame]:
    kept = [f for f in frames if len(f)]
    if kept:
        yield from _mixed(iter(kept), capacity)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    return pack(cut_documents(docs, tokenizer, capacity), capacity)
