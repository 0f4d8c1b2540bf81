"""Repeated lines across documents, found by probing a sharded minimal perfect hash.

A line's key is the line without spaces and 09 to 0D at its ends, A-Z in lower case; keys are
known by their 128-bit hash. Documents are read in flushes of bounded size. What a flush holds
of each shard of the hash space is one row: its different keys, how many documents have each and
the largest id among them, and where they stand. From all flushes' keys every shard builds a
minimal perfect hash (levels of bits, each taking the keys that met no other there) with
fingerprints, counts and last holders in arrays at the hashed places. The flushes' keys then
probe their shard's arrays; a key that stands in very many documents is one probe per flush.
Answers go back to the flush rows, and from there the numbers of dropped lines to the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.storage import small_batches, stored, unused
from clickloom.llm.text import U64, mixed, slices

WHITE = b" \t\n\x0b\x0c\r"
# Different keys a flush holds, and bytes of text for each shard of the index.
FLUSH = 100_000
SHARD_BYTES = 128 << 20
# Bits per key of a level; keys left after the last level lie in a sorted list.
ROOM, LEVELS = 2, 24
KEY = np.dtype([("high", "<u8"), ("low", "<u8")])


def line_key(line: bytes, least: int) -> bytes | None:
    """The hash of a line's key; none for keys of fewer than ``least`` code points."""
    key = line.strip(WHITE)
    if len(key) < least or (len(key) < 4 * least and len(key.decode("utf-8", "replace")) < least):
        return None
    return xxhash.xxh3_128_digest(key.lower())


class PerfectHash:
    """A minimal perfect hash of different 128-bit keys: a place below their number for each."""

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest = levels, rest
        self.ranks, self.size = [], 0
        for words in levels:
            ones = np.bitwise_count(words).astype(np.int64)
            self.ranks.append(self.size + np.cumsum(ones) - ones)
            self.size += int(ones.sum())

    @staticmethod
    def _bits(keys: np.ndarray, level: int, words: int) -> np.ndarray:
        seed = U64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64))
        return (mixed(keys["high"] ^ mixed(keys["low"] + seed)) % U64(64 * words)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray, levels: int = LEVELS) -> PerfectHash:
        taken = []
        for level in range(levels):
            if not len(keys):
                break
            words = max(1, -(-ROOM * len(keys) // 64))
            at = cls._bits(keys, level, words)
            alone = np.bincount(at, minlength=64 * words)[at] == 1
            bits = np.zeros(words, U64)
            np.bitwise_or.at(bits, at[alone] >> 6, U64(1) << (at[alone] & 63).astype(U64))
            taken.append(bits)
            keys = keys[~alone]
        return cls(taken, np.sort(keys, order=("high", "low")))

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key. A key that was not built in gets any place, or -1."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (words, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = self._bits(keys[left], level, len(words))
            word, bit = words[at >> 6], (at & 63).astype(U64)
            here = (word >> bit) & U64(1) == 1
            below = np.bitwise_count(word & ((U64(1) << bit) - U64(1))).astype(np.int64)
            out[left[here]] = (ranks[at >> 6] + below)[here]
            left = left[~here]
        if len(left) and len(self.rest):
            at = np.minimum(np.searchsorted(self.rest, keys[left]), len(self.rest) - 1)
            found = self.rest[at] == keys[left]
            out[left[found]] = self.size + at[found]
        return out


def _smallest(values: np.ndarray) -> np.ndarray:
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))


class LineCounts:
    """One shard of the index: for each place a fingerprint, a count and the last holder."""

    schema = (
        "shard int, levels array<binary>, rest binary, prints binary, counts binary, width int, lasts binary, named binary"
    )

    def __init__(self, row: dict):
        self.hash = PerfectHash([np.frombuffer(b, U64) for b in row["levels"]], np.frombuffer(row["rest"], KEY))
        self.prints = np.frombuffer(row["prints"], np.uint32)
        self.counts = np.frombuffer(row["counts"], f"<u{row['width']}")
        self.lasts = np.frombuffer(row["lasts"], np.int64)
        self.named = np.frombuffer(row["named"], bool)

    @staticmethod
    def build(shard: int, keys: np.ndarray, counts: np.ndarray, lasts: np.ndarray, named: np.ndarray) -> dict:
        """The arrays of keys that may repeat: counts add up, the largest named holder is the last."""
        order = np.lexsort((lasts, named, keys["low"], keys["high"]))
        keys, counts, lasts, named = keys[order], counts[order], lasts[order], named[order]
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        first = np.flatnonzero(new)
        end = np.append(first[1:], len(keys)) - 1
        total = np.add.reduceat(counts, first)
        keys, lasts, named = keys[first], lasts[end], named[end]
        hashed = PerfectHash.build(keys)
        at = hashed.places(keys)
        order = np.argsort(at)
        arrays = [values[order] for values in (keys["low"].astype(np.uint32), total, lasts, named)]
        small = _smallest(arrays[1])
        return {
            "shard": shard,
            "levels": [w.tobytes() for w in hashed.levels],
            "rest": hashed.rest.tobytes(),
            "prints": arrays[0].tobytes(),
            "counts": small.tobytes(),
            "width": small.itemsize,
            "lasts": arrays[2].tobytes(),
            "named": arrays[3].tobytes(),
        }

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents with each key (0: none, but for equal fingerprints), the last holder, and whether it has an id."""
        at = self.hash.places(keys)
        if not len(self.prints):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        known = (at >= 0) & (self.prints[at] == keys["low"].astype(np.uint32))
        return np.where(known, self.counts[at], 0).astype(np.int64), self.lasts[at], self.named[at]


FLUSHED = (
    "flush long, shard int, keys binary, counts binary, lasts binary, named binary, "
    "ends binary, owners binary, lines binary, ids array<long>, prints array<long>"
)


def flushes(docs: DataFrame, shards: int, least: int, size: int = FLUSH) -> DataFrame:
    """A row for each flush and shard: keys with counts and last holders, and where each stands.

    ``ends`` bounds the places of each key; a place is the number of the document (in ``ids`` and
    ``prints``) and of the line.
    """
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(FLUSHED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        part, number = TaskContext.get().partitionId(), 0
        places: dict[bytes, list[int]] = {}
        ids: list[int | None] = []
        prints: list[int] = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number
            for row in _rows_of_flush(places, ids, prints, shards):
                row["flush"] = (part << 32) + number
                yield pa.RecordBatch.from_pylist([row], schema=arrow)
            number += 1
            places.clear(), ids.clear(), prints.clear()

        for batch in batches:
            names, marks = batch.column("_id").to_pylist(), batch.column("_print").to_pylist()
            for low, high, data, offsets in slices(batch.column("_text")):
                raw = data.tobytes()
                for k in range(high - low):
                    text = raw[offsets[k] : offsets[k + 1]]
                    if len(text) < least:
                        continue
                    owner = len(ids)
                    for line, content in enumerate(text.split(b"\n")):
                        key = line_key(content, least)
                        if key is not None:
                            places.setdefault(key, []).extend((owner, line))
                    ids.append(names[low + k])
                    prints.append(marks[low + k])
                    if len(places) >= size or len(ids) >= size:
                        yield from flush()
        if places:
            yield from flush()

    texts = small_batches(docs).select(
        F.col("doc_id").cast("bigint").alias("_id"), F.xxhash64("text").alias("_print"), F.col("text").alias("_text")
    )
    return texts.mapInArrow(run, schema)


def _rows_of_flush(places: dict[bytes, list[int]], ids: list, prints: list, shards: int) -> Iterator[dict]:
    keys = np.frombuffer(b"".join(places), KEY)
    ends = np.cumsum([len(p) // 2 for p in places.values()])
    flat = np.fromiter((x for p in places.values() for x in p), np.int64, 2 * int(ends[-1]) if len(ends) else 0)
    owner, line = flat[::2], flat[1::2]
    key_of = np.repeat(np.arange(len(keys)), np.diff(ends, prepend=0))
    # Places of a key stand by document, so a key's documents are counted where the document changes.
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (key_of[1:] != key_of[:-1])
    counts = np.bincount(key_of[new], minlength=len(keys))
    named = np.array([i is not None for i in ids], bool)
    values = np.array([0 if i is None else i for i in ids], np.int64)
    first = ends - np.diff(ends, prepend=0)
    has = np.logical_or.reduceat(named[owner], first) if len(first) else np.zeros(0, bool)
    least = np.iinfo(np.int64).min
    last = np.maximum.reduceat(np.where(named[owner], values[owner], least), first) if len(first) else np.zeros(0, np.int64)
    shard = (mixed(keys["high"]) % U64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    bounds = np.flatnonzero(np.diff(shard[order], prepend=-1, append=shards))
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        mine = order[a:b]
        size = ends[mine] - first[mine]
        at = np.arange(int(size.sum())) + np.repeat(first[mine] - (np.cumsum(size) - size), size)
        used, renamed = np.unique(owner[at], return_inverse=True)
        yield {
            "shard": int(shard[mine[0]]),
            "keys": keys[mine].tobytes(),
            "counts": counts[mine].astype(np.int64).tobytes(),
            "lasts": last[mine].tobytes(),
            "named": has[mine].tobytes(),
            "ends": np.cumsum(size).astype(np.int64).tobytes(),
            "owners": renamed.astype(np.uint32).tobytes(),
            "lines": line[at].astype(np.uint32).tobytes(),
            "ids": [ids[u] for u in used],
            "prints": [prints[u] for u in used],
        }


def line_index(flushed: DataFrame) -> DataFrame:
    """The index: a row of arrays for each shard."""
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(LineCounts.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        shard, parts = None, []

        def built() -> Iterator[pa.RecordBatch]:
            if parts:
                arrays = [np.concatenate(x) for x in zip(*parts, strict=True)]
                yield pa.RecordBatch.from_pylist([LineCounts.build(shard, *arrays)], schema=arrow)

        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != shard:
                    yield from built()
                    shard, parts = row["shard"], []
                parts.append(_counted(row))
        yield from built()

    rows = flushed.select("shard", "keys", "counts", "lasts", "named")
    return rows.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, schema)


def _counted(row: dict) -> tuple[np.ndarray, ...]:
    kinds = (("keys", KEY), ("counts", np.int64), ("lasts", np.int64), ("named", bool))
    return tuple(np.frombuffer(row[name], kind) for name, kind in kinds)


def repeated_keys(flushed: DataFrame, index: DataFrame, documents: int) -> DataFrame:
    """Probe each flush row's keys: ``hits`` are numbers of keys found in enough documents, with their last holders.

    A shard's arrays come first in its task, and the flush rows stream past them.
    """
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string("flush long, shard int, hits binary, lasts binary, named binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        arrays: LineCounts | None = None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["flush"] is None:
                    arrays = LineCounts(row)
                    continue
                count, last, named = arrays.find(np.frombuffer(row["keys"], KEY))
                hits = np.flatnonzero(count >= documents)
                if len(hits):
                    parts = {"hits": hits.tobytes(), "lasts": last[hits].tobytes(), "named": named[hits].tobytes()}
                    out.append({"flush": row["flush"], "shard": row["shard"], **parts})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    probes = flushed.select("flush", "shard", "keys")
    both = index.withColumn("flush", F.lit(None).cast("bigint")).unionByName(probes, allowMissingColumns=True)
    ordered = both.repartition("shard").sortWithinPartitions("shard", F.asc_nulls_first("flush"))
    return ordered.mapInArrow(run, schema)


def dropped_lines(flushed: DataFrame, hits: DataFrame) -> DataFrame:
    """``id, print, lines``: the numbers of the lines that a document loses, in parts."""
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string("id long, print long, lines array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            for row in batch.to_pylist():
                ends, owner = np.frombuffer(row["ends"], np.int64), np.frombuffer(row["owners"], np.uint32)
                line = np.frombuffer(row["lines"], np.uint32)
                hits = np.frombuffer(row["hits"], np.int64)
                first = np.append(0, ends)[hits]
                size = ends[hits] - first
                at = np.arange(int(size.sum())) + np.repeat(first - (np.cumsum(size) - size), size)
                last = np.repeat(np.frombuffer(row["lasts"], np.int64), size)
                named = np.repeat(np.frombuffer(row["named"], bool), size)
                values = np.array([0 if i is None else i for i in row["ids"]], np.int64)
                has = np.array([i is not None for i in row["ids"]], bool)
                mine = owner[at]
                # The last holder stays; where no holder has an id, all of them stay.
                stays = np.where(named, has[mine] & (values[mine] == last), True)
                mine, lost = mine[~stays], line[at][~stays]
                order = np.argsort(mine, kind="stable")
                mine, lost = mine[order], lost[order]
                bounds = np.flatnonzero(np.diff(mine.astype(np.int64), prepend=-1))
                out = [
                    {"id": row["ids"][mine[a]], "print": row["prints"][mine[a]], "lines": part.tolist()}
                    for a, part in zip(bounds, np.split(lost, bounds[1:]), strict=True)
                ] if len(bounds) else []
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return flushed.join(hits.withColumnRenamed("lasts", "_lasts").withColumnRenamed("named", "_named"), ["flush", "shard"]).select(
        "ends", "owners", "lines", "hits", F.col("_lasts").alias("lasts"), F.col("_named").alias("named"), "ids", "prints"
    ).mapInArrow(run, schema)


def dedup_lines(
    docs: DataFrame, least: int = 20, documents: int = 3, flush: int = FLUSH, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """Documents with ``kept_text``, ``n_lines`` (before) and ``n_dropped``, beside their own columns.

    Keys of at least ``least`` code points in at least ``documents`` documents (rows) lose all their
    lines except in the largest ``doc_id`` that holds them; rows that share this id all keep theirs. A
    row without an id counts as a document and loses the line, unless no holder has an id: then all
    keep it. A null or empty text is one empty line, and its kept text is empty, as it is when all
    lines go. Short lines stay. An empty table gives an empty table; other columns pass through, and
    where their names clash with the three added ones, the added ones get an underscore.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    shards = max(-(-total // shard_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    flushed = stored(flushes(docs, shards, least, flush))
    index = stored(line_index(flushed))
    lost = dropped_lines(flushed, repeated_keys(flushed, index, documents))
    gone, whole, holder, mark = (unused(docs, n) for n in ("_lost", "_lines", "_holder", "_mark"))
    lost = lost.groupBy("id", "print").agg(F.flatten(F.collect_set("lines")).alias(gone))
    lost = lost.select(F.col("id").alias(holder), F.col("print").alias(mark), gone)
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col(holder)) & (F.xxhash64("text") == F.col(mark))
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    numbered = F.transform(whole, lambda line, i: F.struct(line.alias("line"), i.alias("i")))
    stay = F.filter(numbered, lambda x: ~F.array_contains(gone, x["i"]))
    kept = F.when(F.col(gone).isNull(), F.coalesce("text", F.lit(""))).otherwise(
        F.array_join(F.transform(stay, lambda x: x["line"]), "\n")
    )
    names = [unused(docs, n) for n in ("kept_text", "n_lines", "n_dropped")]
    dropped = F.coalesce(F.size(F.array_distinct(gone)), F.lit(0)).cast("bigint")
    return docs.join(lost, same, "left").withColumn(whole, lines).select(
        *docs.columns,
        kept.alias(names[0]),
        F.size(whole).cast("bigint").alias(names[1]),
        dropped.alias(names[2]),
    )


WHITE_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
SQL = f"""
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, {WHITE_SQL}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM split
), repeated AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.last AS lost FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE lost) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
