"""Fingerprints of improbable byte windows in chained Bloom filters.

Every window of 64 bytes has an entropy; how often each entropy (in thousandths of its maximum)
occurs over all texts ranks them, the rarest first. A window is a feature if it has the best rank
in at least ``POPULAR`` of the runs of 64 neighbouring windows that hold it. Five parts of 11 bits
of a feature's hash set bits in a filter of 2048 bits, and after 160 features the next filter
begins. Two fingerprints are as like as the bits that their filters share beyond chance, from 0 to
1: each filter of the shorter chain against the best of the other, weighted by its bits.

For the comparison with the next document, texts are dealt out (compressed) by blocks of ids, each
partition is walked in the order of ids, and only the first and last document of a block meet
their neighbours in a second, small shuffle.

A null text counts as empty. An empty text has the fingerprint ``0:`` and is like another empty
text (1) and no other (0). A text under 64 bytes is one feature; one without a popular window has
its best window as feature. Rows without a ``doc_id`` have no place in the order and are left out;
of rows with the same id, the text's hash gives the order. A single document is its own next.
Extra columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.storage import stored
from clickloom.llm.text import SLICE, hash_sums, in_text, slices, span_hashes

WINDOW = 64
POPULAR = 16
FILTER_BITS, FILTER_FEATURES, PARTS = 2048, 160, 5
LEVELS = 1001
#: Windows below this level (thousandths of the largest entropy) say nothing.
LEAST_LEVEL = 100
BLOCK_ROWS = 256
#: Spans of ids of equally many rows, in each of which blocks are equally wide.
SPANS = 256
_SCALE = 1 << 20
_share = np.arange(1, WINDOW + 1) / WINDOW
_ENTROPY = np.concatenate(([0], np.rint(-_share * np.log2(_share) * _SCALE))).astype(np.int64)
_TOP = 6 * _SCALE  # 64 different bytes


def levels(data: np.ndarray) -> np.ndarray:
    """Entropy level, 0 to 1000, of the window that begins at each byte."""
    n = len(data)
    if n < WINDOW:
        return np.zeros(0, np.int64)
    order = np.argsort(data, kind="stable")
    key = data[order].astype(np.int64) * (n + WINDOW) + order
    rank = np.arange(n)
    after = np.searchsorted(key, key + WINDOW)  # first equal byte out of reach
    before = np.cumsum(np.bincount(after, minlength=n + 1))[:n]  # first equal byte within reach from behind
    leaving, entering = np.empty(n, np.int64), np.empty(n, np.int64)
    leaving[order] = after - rank
    entering[order] = rank - before + 1
    step = (_ENTROPY[leaving[: n - WINDOW] - 1] - _ENTROPY[leaving[: n - WINDOW]]) + (
        _ENTROPY[entering[WINDOW:]] - _ENTROPY[entering[WINDOW:] - 1]
    )
    first = int(_ENTROPY[np.bincount(data[:WINDOW], minlength=256)].sum())
    total = np.concatenate(([first], first + np.cumsum(step)))
    return np.minimum(total * (LEVELS - 1) // _TOP, LEVELS - 1)


def _inside(n: int, offsets: np.ndarray) -> np.ndarray:
    """Whether the window that begins at each byte ends in the same text."""
    inside = np.zeros(max(0, n - WINDOW + 1) + 1, np.int32)
    length = np.diff(offsets)
    long = length >= WINDOW
    np.add.at(inside, offsets[:-1][long], 1)
    np.add.at(inside, offsets[1:][long] - WINDOW + 1, -1)
    return np.cumsum(inside)[:-1] > 0


def level_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """How many windows of the whole corpus have each level."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LEVELS, np.int64)
        for batch in batches:
            for _, _, data, offsets in slices(batch.column("_text")):
                total += np.bincount(levels(data)[_inside(len(data), offsets)], minlength=LEVELS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["level", "n"])

    rows = docs.select(F.col(text).alias("_text")).mapInArrow(count, "level int, n long").groupBy("level").agg(F.sum("n").alias("n"))
    total = np.zeros(LEVELS, np.int64)
    for level, n in rows.collect():  # at most LEVELS rows
        total[level] = n
    return total


def rarity(counts: np.ndarray) -> np.ndarray:
    """Rank of each level, 0 for the rarest; levels that say nothing come last."""
    rank = np.empty(LEVELS, np.int64)
    rank[np.lexsort((np.arange(LEVELS), counts))] = np.arange(LEVELS)
    rank[:LEAST_LEVEL] = LEVELS
    return rank


def features(data: np.ndarray, offsets: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the features of all texts in order, and the number of each text's first."""
    n, texts = len(data), len(offsets) - 1
    length = np.diff(offsets)
    chosen = np.zeros(n + 1, bool)
    if n >= WINDOW:
        inside = _inside(n, offsets)
        shift = np.uint64(max(1, int(n).bit_length()))
        worst = np.uint64(LEVELS + 1) << shift
        key = rank[levels(data)].astype(np.uint64) << shift
        key[~inside] = worst
        key |= np.arange(len(key), dtype=np.uint64)
        if shift <= 21:
            key = key.astype(np.uint32)
        mask = key.dtype.type((1 << int(shift)) - 1)
        low, run = key, 1
        while run < WINDOW and len(low) > run:
            low = np.minimum(low[:-run], low[run:])
            run *= 2
        if run == WINDOW:
            # a run of neighbours counts if its first and last window lie in one text
            reach = np.zeros(len(low) + 1, np.int32)
            long = length >= 2 * WINDOW - 1
            np.add.at(reach, offsets[:-1][long], 1)
            np.add.at(reach, offsets[1:][long] - (2 * WINDOW - 1) + 1, -1)
            winners = (low & mask)[np.cumsum(reach)[:-1] > 0]
            chosen[:n] = np.bincount(winners.astype(np.int64), minlength=n) >= POPULAR
        some = np.flatnonzero(length >= WINDOW)
        have = np.add.reduceat(chosen[:n].astype(np.int64), offsets[some]) if len(some) else np.zeros(0)
        for k in some[have == 0].tolist():
            part = key[offsets[k] : offsets[k + 1] - WINDOW + 1]
            chosen[int(part.min() & mask)] = True
    short = (length > 0) & (length < WINDOW)
    chosen[offsets[:-1][short]] = True
    starts = np.flatnonzero(chosen)
    owner = np.searchsorted(offsets, starts, "right") - 1
    hashes = span_hashes(data, starts, np.minimum(starts + WINDOW, offsets[owner + 1]), hash_sums(data))
    _, first = np.unique(in_text(hashes, owner), return_index=True)
    first.sort()
    return hashes[first], np.searchsorted(owner[first], np.arange(texts + 1))


def filters(hashes: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """The chain of filters (rows of bytes) of each text."""
    count = np.diff(first)
    chain = -(-count // FILTER_FEATURES)
    base = np.concatenate(([0], np.cumsum(chain)))
    within = np.arange(len(hashes)) - np.repeat(first[:-1], count)
    row = np.repeat(base[:-1], count) + within // FILTER_FEATURES
    bits = np.zeros((int(base[-1]), FILTER_BITS), bool)
    for part in range(PARTS):
        bits[row, (hashes >> np.uint64(11 * part)).astype(np.int64) % FILTER_BITS] = True
    packed = np.packbits(bits, axis=1)
    return [packed[a:b] for a, b in zip(base[:-1], base[1:], strict=True)]


def fingerprints(texts: list[bytes], rank: np.ndarray) -> list[tuple[str, np.ndarray]]:
    """The fingerprint and the chain of filters of each text."""
    out = []
    for _, _, data, offsets in slices(pa.array(texts, pa.large_binary()).cast(pa.large_string())):
        hashes, first = features(data, offsets, rank)
        for n, chain in zip(np.diff(first).tolist(), filters(hashes, first), strict=True):
            out.append((f"{n}:{base64.b64encode(chain.tobytes()).decode()}", chain))
    return out


def parsed(fingerprint: str) -> np.ndarray:
    """The chain of filters of a fingerprint."""
    raw = base64.b64decode(fingerprint.partition(":")[2])
    return np.frombuffer(raw, np.uint8).reshape(-1, FILTER_BITS // 8)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Bits shared beyond chance, normalised to 0 to 1."""
    if len(a) > len(b) or (len(a) == len(b) and a.tobytes() > b.tobytes()):
        a, b = b, a
    if not len(a):
        return 1.0 if not len(b) else 0.0
    size_a, size_b = np.bitwise_count(a).sum(1, dtype=np.int64), np.bitwise_count(b).sum(1, dtype=np.int64)
    total = 0.0
    for row, size in zip(a, size_a.tolist(), strict=True):
        both = np.bitwise_count(b & row).sum(1, dtype=np.int64)
        chance = size * size_b / FILTER_BITS
        most = np.minimum(size, size_b)
        total += size * float(np.clip((both - chance) / np.maximum(most - chance, 1e-9), 0, 1).max())
    score = total / int(size_a.sum())
    return score * min(1.0, len(a) / len(b)) if len(a) != len(b) else score


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the next one's beginning, or all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_WALKED = f"{RESULT}, block long, edge int, packed binary"
_FIRST, _LAST = 1, 2


def _packed(texts: DataFrame) -> DataFrame:
    """Each text compressed, with its id and a hash for the order of equal ids."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                raw = [(t or "").encode() for t in part.column("_text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("tie"), pa.array([press.compress(r) for r in raw], pa.binary())],
                    names=["doc_id", "tie", "packed"],
                )

    return texts.mapInArrow(pack, "doc_id long, tie long, packed binary")


def _compared(rows: list[tuple], rank: np.ndarray) -> Iterator[tuple]:
    """Result rows of (doc_id, text, chain, next text, next chain)."""
    texts = [edited(text, following) for _, text, _, following, _ in rows]
    raw = [t.encode() for t in texts]
    for (doc_id, text, own, _, after), content, (code, chain) in zip(rows, raw, fingerprints(raw, rank), strict=True):
        yield (doc_id, len(text), hashlib.sha256(content).hexdigest(), own[0], code, likeness(own[1], chain), likeness(own[1], after[1]))


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _walk(blocks: DataFrame, rank: np.ndarray) -> DataFrame:
    """Rows in the order of block and id: results for all but the last of a block, and the edges."""
    from pyspark.sql.types import _parse_datatype_string

    wanted = _parse_datatype_string(_WALKED)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark.sql.pandas.types import to_arrow_schema

        schema, inflate = to_arrow_schema(wanted), zstandard.ZstdDecompressor()
        held = None  # the row before: block, id, text, (name, chain), packed

        def edge(kind: int, row: tuple) -> tuple:
            block, doc_id, text, own, packed = row
            return (doc_id, len(text), None, own[0], None, None, None, block, kind, packed)

        def finished(part: list[tuple]) -> Iterator[pa.RecordBatch]:
            nonlocal held
            raw = [r[3] for r in part]
            rows = [(b, d, t.decode(), own, p) for (b, d, p, t), own in zip(part, fingerprints(raw, rank), strict=True)]
            pairs, out = [], []
            for row in rows:
                if held is None or held[0] != row[0]:
                    if held is not None:
                        out.append(edge(_LAST, held))
                    out.append(edge(_FIRST, row))
                else:
                    pairs.append((held[1], held[2], held[3], row[2], row[3]))
                held = row
            out += [(*r, None, 0, None) for r in _compared(pairs, rank)]
            if out:
                yield _arrow(out, schema)

        part, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("block", "doc_id", "packed")), strict=True):
                text = inflate.decompress(row[2])
                part.append((*row, text))
                size += len(text)
                if size >= SLICE:
                    yield from finished(part)
                    part, size = [], 0
        if part:
            yield from finished(part)
        if held is not None:
            yield _arrow([edge(_LAST, held)], schema)

    return blocks.mapInArrow(walk, wanted)


def _following(first: DataFrame) -> DataFrame:
    """``block, after``: the next block that has rows, and the first after the last.

    Blocks are ordered within groups of 4096, and the groups by their first and last blocks.
    """
    grouped = first.withColumn("group", F.expr("block div 4096"))
    inner = grouped.withColumn("after", F.lead("block").over(Window.partitionBy("group").orderBy("block")))
    ends = grouped.groupBy("group").agg(F.min("block").alias("first"))  # one row for a million documents
    order = Window.orderBy("group")
    ends = ends.withColumn("next_first", F.coalesce(F.lead("first").over(order), F.first("first").over(order)))
    return inner.join(ends.select("group", "next_first"), "group").select("block", F.coalesce("after", "next_first").alias("after"))


def _numbered_blocks(docs: DataFrame, block_rows: int) -> Column:
    """The number of the block of a ``doc_id``; blocks rise with ids and hold about ``block_rows`` of them.

    Quantiles of the ids bound spans, and each span has blocks of a width of its own, by its own
    density: no block holds more than a span, wherever ids lie far apart.
    """
    cuts = docs.select(F.col("doc_id").cast("double").alias("id")).approxQuantile("id", [k / SPANS for k in range(1, SPANS)], 0.25 / SPANS)
    lows = F.array(*(F.lit(c) for c in sorted(set(cuts)))) if cuts else F.array().cast("array<double>")
    span = F.size(F.filter(lows, lambda low: low <= F.col("doc_id").cast("double")))
    ends = docs.groupBy(span.alias("span")).agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("rows"))
    width, base, begun = [1] * SPANS, [0] * SPANS, 0
    for row in sorted(ends.collect()):  # SPANS rows at most
        k, low, high, rows = row
        width[k] = min(block_rows * -(-(high - low + 1) // rows), 1 << 62)
        base[k] = begun - low // width[k]
        begun = base[k] + high // width[k] + 1
    own = F.element_at(F.array(*(F.lit(w).cast("long") for w in width)), span + 1)
    down = F.when((F.col("doc_id") < 0) & (F.pmod(F.col("doc_id"), own) != 0), 1).otherwise(0)
    quotient = F.call_function("div", F.col("doc_id"), own)
    return quotient - down + F.element_at(F.array(*(F.lit(b).cast("long") for b in base)), span + 1)


def fingerprint_documents(docs: DataFrame, text: str = "text", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The columns of ``RESULT`` for each document with an id."""
    from pyspark.sql.types import _parse_datatype_string

    rank = rarity(level_counts(docs, text))
    known = docs.where(F.col("doc_id").isNotNull())
    ids = known.select(F.col("doc_id").cast("long").alias("doc_id"))
    texts = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("tie"), F.col(text).alias("_text"))
    blocks = _packed(texts).withColumn("block", _numbered_blocks(ids, block_rows))
    walked = stored(_walk(blocks.repartition("block").sortWithinPartitions("block", "doc_id", "tie"), rank))
    names = [f.split()[0] for f in RESULT.split(", ")]
    done = walked.where("edge = 0").select(*names)
    edges = walked.where("edge > 0").select("block", "doc_id", "fingerprint", "packed", "edge")
    first = stored(edges.where(F.col("edge") == _FIRST).drop("edge"))
    last = edges.where(F.col("edge") == _LAST).drop("edge").join(_following(first.select("block")), "block")
    pairs = last.join(
        first.select(F.col("block").alias("after"), F.col("fingerprint").alias("next_fingerprint"), F.col("packed").alias("next_packed")), "after"
    )
    wanted = _parse_datatype_string(RESULT)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark.sql.pandas.types import to_arrow_schema

        schema, inflate = to_arrow_schema(wanted), zstandard.ZstdDecompressor()
        columns = ("doc_id", "packed", "fingerprint", "next_packed", "next_fingerprint")
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                part = batch.slice(low, 64)
                rows = [
                    (d, inflate.decompress(p).decode(), (f, parsed(f)), inflate.decompress(q).decode(), (g, parsed(g)))
                    for d, p, f, q, g in zip(*(part.column(c).to_pylist() for c in columns), strict=True)
                ]
                if rows:
                    yield _arrow(list(_compared(rows, rank)), schema)

    return done.unionByName(pairs.mapInArrow(finish, wanted))
