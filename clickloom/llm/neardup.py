"""Near duplicates by bottom-k sketches of word shingles.

A document's set is its distinct 5-word shingles (A-Z in lower case; fewer words: the whole
sequence). Documents of equal sets form a class, and only classes are compared.

1. Sketch: the ``K`` smallest hashes of a set under one hash function. Similar sets share at least
   ``SHARED`` of them (at a similarity of 0.75 all but one pair in a thousand million).
   Beside the hashes that name lists, a sketch is kept as their upper 32 bits, to be compared.
2. Inverted lists: each class enters the lists of its rarest sketch values only, so many that two
   sketches with ``SHARED`` common values must meet in one. Frequent passages thus make no lists
   where a document has anything else. A long list is walked in pairs of blocks, spread over tasks,
   and two classes are only looked at in the first list that they have in common.
3. Union sketch: pairs that meet are estimated by the sketch of their union (of pairs with a
   similarity of 0.75 all but one in 29 million pass). What is likely enough
   joins two classes to a cluster; a block passes on stars, and two blocks only what joins their stars.
4. Exact check: within a cluster, the full sets are compared, first within blocks, then one member of
   each part found so, then members of parts that are still apart. The components are the result.

Null texts and texts without words have an empty set and are linked with nothing. Rows without a
``doc_id`` are left out. Each row gives one row; rows that share an id count as one document when
links are followed. Extra columns are ignored; no rows give no rows. Sets are compared by 64-bit
hashes of their shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.graph import components
from clickloom.llm.storage import stored
from clickloom.llm.text import LOWER, map_texts, mixed, slices, span_hashes, windows, words

SHINGLE = 5
PERCENT = 75
K, SHARED = 32, 8
#: Of the union's K smallest values, this many must be common to both for a pair to be checked.
LIKELY = 10
BLOCK = 512
#: Rows of a block that others are held against first, so that later lists repeat the edges of earlier ones.
LEADERS = 8
#: Shingles that the blocks of a cluster are made for, besides their number of classes.
BLOCK_SHINGLES = 400_000
_FILLER = np.uint32(2**32 - 1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    lower = LOWER[data]
    starts, ends, first = words(lower, offsets)
    hashes = span_hashes(lower, starts, ends)
    at, code = windows(hashes, first, size)
    bounds = np.searchsorted(at, first)
    for k, (low, high) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        if high > low:
            yield np.unique(code[low:high])
        else:
            own = hashes[first[k] : first[k + 1]]
            yield windows(own, np.array([0, len(own)]), len(own))[1] if len(own) else own


def least_shared(n: int) -> int:
    """Sketch values that a set of ``n`` shingles shares with any similar set, at least."""
    return SHARED if n * PERCENT > SHARED * 100 else max(1, -(-n * PERCENT // 100))


def sketches(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, n_shingles``, a 128-bit name of the set, and its ``sketch``."""
    schema = "doc_id long, n_shingles long, name_1 long, name_2 long, sketch array<long>, short binary"

    def sketch(kept: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> dict:
        sizes, names, lowest = [], [], []
        for values in shingle_sets(data, offsets):
            sizes.append(len(values))
            names.append((mixed(values).sum(dtype=np.uint64), mixed(values ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)))
            lowest.append(values[:K])
        bounds = np.concatenate(([0], np.cumsum([len(x) for x in lowest])))
        name = np.array(names, np.uint64).view(np.int64).reshape(-1, 2)
        return {
            "doc_id": kept.column("doc_id"),
            "n_shingles": np.array(sizes, np.int64),
            "name_1": name[:, 0],
            "name_2": name[:, 1],
            "sketch": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(lowest).view(np.int64))),
            "short": pa.array([(x >> np.uint64(32)).astype("<u4").tobytes() for x in lowest], pa.binary()),
        }

    return map_texts(docs, ["doc_id"], schema, sketch, text)


def _least(n: int, links: np.ndarray) -> np.ndarray:
    """The smallest of ``n`` rows that each is joined with by the links between rows."""
    label = np.arange(n)
    while True:
        ends = label[links]
        apart = ends[:, 0] != ends[:, 1]
        if not apart.any():
            return label
        links, ends = links[apart], ends[apart]
        np.minimum.at(label, ends.max(1), ends.min(1))
        while not np.array_equal(further := label[label], label):
            label = further


def _star(nodes: np.ndarray, label: np.ndarray) -> list[tuple[int, int]]:
    """Each joined row's node and the smallest node that it is joined with."""
    at = np.flatnonzero(label != np.arange(len(label)))
    return list(zip(nodes[at].tolist(), nodes[label[at]].tolist(), strict=True))


def _common(values: list[np.ndarray], chunk: int = 4096) -> np.ndarray:
    """Number of common values of each two of the sets."""
    flat = np.concatenate(values) if values else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(len(values)), [len(v) for v in values])
    _, inverse, count = np.unique(flat, return_inverse=True, return_counts=True)
    several = count[inverse] > 1
    column = (np.cumsum(count > 1) - 1)[inverse[several]]
    row = row[several]
    total = np.zeros((len(values), len(values)), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, chunk):
        a, b = np.searchsorted(column, (low, low + chunk))
        has = np.zeros((len(values), chunk), np.float32)
        has[row[a:b], column[a:b] - low] = 1
        total += has @ has.T
    return np.rint(total).astype(np.int64)


class _Sketches:
    """Tells which pairs of rows are likely: their union sketch makes the similarity possible."""

    def __init__(self, sizes: np.ndarray, sketch: list[np.ndarray]):
        self.sizes, self.common = sizes, _common(sketch)
        self.need = np.array([least_shared(int(n)) for n in sizes])
        fits = 100 * np.minimum.outer(sizes, sizes) >= PERCENT * np.maximum.outer(sizes, sizes)
        self.possible = fits & (self.common >= np.minimum.outer(self.need, self.need))
        self.table = np.full((len(sketch), K), _FILLER, np.uint32)
        for k, s in enumerate(sketch):
            self.table[k, : len(s)] = s

    def likely(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which of the possible pairs of rows are likely."""
        in_union = np.zeros(len(a), np.int64)
        for low in range(0, len(a), 1 << 14):
            part = slice(low, low + (1 << 14))
            merged = np.sort(np.concatenate((self.table[a[part]], self.table[b[part]]), axis=1), axis=1)
            twice = np.zeros(merged.shape, bool)
            twice[:, :-1] = (merged[:, 1:] == merged[:, :-1]) & (merged[:, 1:] != _FILLER)
            again = np.zeros(merged.shape, bool)
            again[:, 1:] = twice[:, :-1]
            place = np.cumsum(~again, axis=1)
            in_union[part] = (twice & (place <= K)).sum(1)
        whole = (self.sizes[a] <= K) & (self.sizes[b] <= K)
        both = self.common[a, b]
        exact = 100 * both >= PERCENT * (self.sizes[a] + self.sizes[b] - both)
        return np.where(whole, exact, in_union >= np.minimum(LIKELY, np.minimum(self.need[a], self.need[b])))

    def pairs(self, mask: np.ndarray) -> np.ndarray:
        a, b = np.nonzero(mask & self.possible)
        return np.column_stack((a, b))[self.likely(a, b)]

    def led(self, rows: np.ndarray) -> np.ndarray:
        """Likely pairs of a first row with others, then of the first of the rest, a few times."""
        found = [np.zeros((0, 2), np.int64)]
        for _ in range(LEADERS):
            if len(rows) < 2:
                break
            first, rows = rows[0], rows[1:]
            near = self.possible[first, rows]
            near[near] = self.likely(np.full(near.sum(), first), rows[near])
            found.append(np.column_stack((np.full(near.sum(), first), rows[near])))
            rows = rows[~near]
        return np.concatenate(found)


def _grouped(rows: DataFrame, key: list[str], columns: list[str], function, schema: str) -> DataFrame:  # type: ignore[no-untyped-def]
    """Call ``function(key values, rows)`` on each run of equal keys in sorted partitions."""
    from pyspark.sql.types import _parse_datatype_string

    wanted = _parse_datatype_string(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(wanted)
        held: list[tuple] = []
        current, out = None, []

        def emitted(force: bool) -> Iterator[pa.RecordBatch]:
            if out and (force or len(out) > 4096):
                arrays = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)
                out.clear()

        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in key), strict=True)
            values = zip(*(batch.column(c).to_pylist() for c in columns), strict=True)
            for k, v in zip(keys, values, strict=True):
                if k != current:
                    if held:
                        out.extend(function(current, held))
                        yield from emitted(False)
                    current, held = k, []
                held.append(v)
        if held:
            out.extend(function(current, held))
        yield from emitted(True)

    return rows.select(*key, *columns).repartition(*key).sortWithinPartitions(*key).mapInArrow(run, wanted)


def _met(rows: DataFrame, others: Column) -> DataFrame:
    """A copy of each row for each block in ``others`` that its own ``block`` is compared with: ``block_a, block_b``."""
    other = rows.withColumn("other", F.explode(others))
    return other.withColumn("block_a", F.least("block", "other")).withColumn("block_b", F.greatest("block", "other"))


def _up_to(n: Column) -> Column:
    """0 to ``n - 1``, nothing if there is none."""
    return F.filter(F.sequence(F.lit(0).cast("long"), n), lambda x: x < n)


def _blocks_for(count: Column, shingles: Column) -> Column:
    return F.ceil(F.greatest(count / BLOCK, shingles / BLOCK_SHINGLES)).cast("long")


def likely_edges(classes: DataFrame) -> DataFrame:
    """Edges ``a, b`` that hold every two classes that may be similar in one component.

    A block of a list gives a star for each part of it that belongs together; a pair of blocks
    gives only what joins parts of one to parts of the other.
    """
    values = classes.select("node", F.explode("sketch").alias("value"))
    counts = stored(values.groupBy("value").agg(F.count(F.lit(1)).alias("count")).where("count > 1"))
    kept = F.size("sketch") - F.least(F.lit(SHARED), F.ceil(F.col("n_shingles") * PERCENT / 100)) + 1
    several = values.join(counts, "value").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("count", "value"))).alias("several"))
    # values of one class only come before all others in the order of frequency
    least = F.greatest(F.lit(0), kept - (F.size("sketch") - F.size("several"))).cast("int")
    prefix = classes.join(several, "node").withColumn("prefix", F.slice("several", F.lit(1), least))
    rows = prefix.select("node", "n_shingles", "short", "prefix", F.posexplode("prefix").alias("at", "p")).select(
        "node",
        "n_shingles",
        "short",
        F.slice("prefix.value", F.lit(1), F.col("at")).alias("earlier"),
        F.col("p.value").alias("value"),
        # powers of two, so that lists of about the same members have the same blocks and give the same stars
        F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.col("p.count") / BLOCK, F.lit(1.0))))).cast("long").alias("blocks"),
    )

    def likely(key: tuple, rows: list[tuple]) -> list[tuple[int, int]]:
        if len(rows) < 2:
            return []
        rows = sorted(rows, key=lambda r: r[0])
        nodes, block = np.array([r[0] for r in rows]), np.array([r[4] for r in rows])
        known = _Sketches(np.array([r[1] for r in rows]), [np.frombuffer(r[2], "<u4") for r in rows])
        # an earlier list has the other pairs
        mask = np.triu(_common([np.array(r[3], np.int64) for r in rows]) == 0, 1)
        mask &= (block[:, None] == block[None, :]) == (key[1] == key[2])
        found = known.pairs(mask)
        if not len(found):
            return []
        # what a leader joins is joined by this list's blocks or by earlier lists
        led = _least(len(rows), np.concatenate([known.led(np.flatnonzero(block == x)) for x in set(key[1:])]))
        part = _least(len(rows), led[found])
        if key[1] != key[2]:
            return _star(nodes, part)
        part = part[led]
        new = np.isin(part, part[found[:, 0]])
        return _star(nodes, np.where(new, part, np.arange(len(rows))))

    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
    copies = _met(rows, _up_to(F.col("blocks")))
    return _grouped(copies, ["value", "block_a", "block_b"], ["node", "n_shingles", "short", "earlier", "block"], likely, "a long, b long")


def _packed(docs: DataFrame, text: str) -> DataFrame:
    """``doc_id`` and the compressed text."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                raw = [press.compress((t or "").encode()) for t in part.column("_text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(raw, pa.binary())], names=["node", "packed"])

    return docs.select(F.col("doc_id").cast("long").alias("node"), F.col(text).alias("_text")).mapInArrow(pack, "node long, packed binary")


def _linked(key: tuple, rows: list[tuple]) -> list[tuple[int, int]]:
    """Stars of the parts ``(part, packed text, block)`` that links between the rows of two blocks join.

    Rows of one block are compared if the key's blocks are the same one.
    """
    import zstandard

    rows = sorted(rows, key=lambda r: r[0])
    parts, first = np.unique(np.array([r[0] for r in rows]), return_inverse=True)
    if len(parts) < 2:
        return []
    inflate = zstandard.ZstdDecompressor()
    texts = pa.array([inflate.decompress(r[1]) for r in rows], pa.large_binary()).cast(pa.large_string())
    sets = [s for _, _, data, offsets in slices(texts) for s in shingle_sets(data, offsets)]
    sizes, block = np.array([len(s) for s in sets]), np.array([r[2] for r in rows])
    common = _common(sets)
    union = sizes[:, None] + sizes[None, :] - common
    mask = (first[:, None] != first[None, :]) & ((block[:, None] != block[None, :]) | (key[1] == key[2]))
    found = np.argwhere(np.triu(mask & (union > 0) & (100 * common >= PERCENT * union), 1))
    return _star(parts, _least(len(parts), first[found]))


def links(docs: DataFrame, clusters: DataFrame, text: str = "text") -> DataFrame:
    """Edges ``a, b`` that join exactly what links join among the members ``node, cluster, n_shingles`` of each cluster.

    Members are compared within blocks, which gives parts. Of clusters of several blocks, the parts'
    smallest members are compared next, in blocks again, and where several parts are left, members of
    different parts: a large part has blocks of its own, which are not compared with each other.
    """
    key = ["cluster", "block_a", "block_b"]
    sizes = clusters.groupBy("cluster").agg(_blocks_for(F.count(F.lit(1)), F.sum("n_shingles")).alias("blocks"))
    members = stored(clusters.join(sizes, "cluster").select("node", "cluster", "n_shingles", "blocks"))
    rows = stored(_packed(docs, text).join(members.withColumn("block", F.pmod(F.xxhash64("node"), "blocks")), "node"))

    def compared(rows: DataFrame, part: str, others: Column) -> DataFrame:
        return stored(_grouped(_met(rows, others), key, [part, "packed", "block"], _linked, "a long, b long"))

    inside = compared(rows, "node", F.array("block"))
    several = members.where("blocks > 1").select("node", "cluster", "n_shingles")
    if several.isEmpty():
        return inside

    # a node is in one block, so the star gives its part
    named = several.join(inside.withColumnRenamed("a", "node"), "node", "left").withColumn("part", F.coalesce("b", "node")).drop("b")
    least = named.where("node = part")
    sizes = least.groupBy("cluster").agg(_blocks_for(F.count(F.lit(1)), F.sum("n_shingles")).alias("blocks"))
    least = least.join(sizes, "cluster").select("node", F.pmod(F.xxhash64("node", F.lit(1)), "blocks").alias("block"))
    texts = rows.select("node", "cluster", "packed")
    between = compared(texts.join(least, "node"), "node", F.array("block"))

    named = named.join(between.withColumnRenamed("a", "part"), "part", "left")
    named = stored(named.select("node", "cluster", "n_shingles", F.coalesce("b", "part").alias("part")))
    parts = named.groupBy("cluster", "part").agg(F.count(F.lit(1)).alias("count"), F.sum("n_shingles").alias("shingles"))
    parts = parts.withColumn("own", _blocks_for(F.col("count"), F.col("shingles")))
    parts = stored(parts.withColumn("own", F.when(F.col("own") > 1, F.col("own")).otherwise(0)))
    small = F.col("own") == 0
    shared = parts.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("parts"),
        F.coalesce(_blocks_for(F.sum(F.when(small, F.col("count"))), F.sum(F.when(small, F.col("shingles")))), F.lit(0)).alias("shared"),
        F.sum("own").alias("owned"),
    )
    # blocks are numbered from the shared ones on; parts with blocks of their own are at most one in 512 members
    large = parts.where(~small).withColumn(
        "first", F.sum("own").over(Window.partitionBy("cluster").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    )
    parts = parts.select("cluster", "part", "own").join(large.select("cluster", "part", "first"), ["cluster", "part"], "left")
    apart = named.join(parts, ["cluster", "part"]).join(shared.where("parts > 1"), "cluster")
    first = F.col("shared") + F.coalesce("first", F.lit(0))
    block = F.when(small, F.pmod(F.xxhash64("part"), F.col("shared"))).otherwise(first + F.pmod(F.xxhash64("node"), F.col("own")))
    others = F.filter(
        _up_to(F.col("shared") + F.col("owned")), lambda x: small | (x < first) | (x >= first + F.col("own"))
    )
    apart = apart.select("node", "part", block.alias("block"), others.alias("others"))
    across = compared(texts.join(apart, "node"), "part", F.col("others"))
    return inside.unionByName(between).unionByName(across)


def near_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of each row with an id."""
    known = docs.where(F.col("doc_id").isNotNull())
    rows = stored(sketches(known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))))
    classes = stored(
        rows.where("n_shingles > 0")
        .groupBy("name_1", "name_2")
        .agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"), F.first("short").alias("short"))
    )
    clusters = components(likely_edges(classes.select("node", "n_shingles", "sketch", "short")))
    clusters = clusters.withColumnRenamed("component", "cluster").join(
        classes.groupBy("node").agg(F.max("n_shingles").alias("n_shingles")), "node"
    )
    found = components(links(known, clusters, text))
    named = stored(
        classes.select("name_1", "name_2", "node")
        .join(found, "node", "left")
        .select("name_1", "name_2", F.coalesce("component", "node").alias("component_id"))
    )
    # a class of very many copies is a skewed join key, whose rows the adaptive plan splits
    joined = rows.select("doc_id", "n_shingles", "name_1", "name_2").join(named, ["name_1", "name_2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), (component == F.col("doc_id")).alias("kept"))
