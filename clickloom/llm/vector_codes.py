"""Compression of vectors to codes by ball k-means, in whole numbers.

A vector is cut into equal parts, and every part position has a codebook of entries. All parts
nearest to an entry are its ball. In each round, a block of vectors measures its parts' distance to
their own entry, which gives the ball's radius there. Only entries within two radii are neighbours
of the ball. A part that is nearer to its entry than half way to every neighbour lies in the stable
core and needs no other distance. Beyond it, rings between half the distances to one neighbour and
the next tell how many neighbours, the nearest first, are a part's candidates. All comparisons are
of squared whole numbers, so no neighbour that could tie is passed over. Sums are kept up by the
parts that changed their ball.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm.storage import small_batches, stored, unused

# Vectors of a block, and the largest whole number of an entry: squares of differences add up below 2**63.
BLOCK_ROWS, LARGEST = 4096, 1 << 27
SALTS = 16


def whole_vectors(frame: DataFrame, id: str, vector: str, scale: int, keep: list[str]) -> DataFrame:
    """``_id, _x`` and other columns of the rows whose vector has neither null nor non-finite entries."""
    bad = F.exists("_x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    kept = [F.col(c).alias(f"_{c}") for c in keep]
    rows = frame.select(F.col(id).alias("_id"), F.col(vector).cast("array<double>").alias("_x"), *kept)
    rows = rows.where(F.col("_x").isNotNull() & ~bad)
    return rows.withColumn("_x", F.transform("_x", lambda c: F.floor(c * scale).cast("bigint")))


def first_codebooks(rows: DataFrame, parts: int, entries: int) -> np.ndarray:
    """Codebooks (part, entry, position) of the parts of the smallest ids; vectors break ties, no id comes last."""
    first = rows.select("_id", "_x").orderBy(F.asc_nulls_last("_id"), "_x").limit(entries).collect()
    lengths = {len(r["_x"]) for r in first}
    if len(lengths) > 1 or any(n % parts or not n for n in lengths):
        raise ValueError(f"vectors of {sorted(lengths)} entries cannot be cut into {parts} equal parts")
    books = np.array([r["_x"] for r in first], np.int64).reshape(len(first), parts, max(lengths, default=0) // parts)
    return books.transpose(1, 0, 2).copy()


class Balls:
    """The entries of one part position, and each one's neighbours from the nearest on."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        away = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(2)
        np.fill_diagonal(away, -1)
        self.near = np.argsort(away, axis=1, kind="stable")[:, 1:]
        self.away = np.take_along_axis(away, self.near, 1)

    def assign(self, x: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest entries (lowest of ties) of the parts ``x``, known to be in the balls ``codes``, their
        squared distances, and how many other distances were measured."""
        best, distance, measured = codes.copy(), self.squared(x, codes), 0
        for ball in np.flatnonzero(np.bincount(codes, minlength=len(self.entries))):
            mine = np.flatnonzero(codes == ball)
            own = 4 * distance[mine]
            # Neighbours of the ball, by its radius; a part's ring is the number of entries within twice its distance.
            neighbours = self.away[ball][: np.searchsorted(self.away[ball], own.max(), "right")]
            ring = np.searchsorted(neighbours, own, "right")
            for k in range(len(neighbours)):
                out = mine[ring > k]
                other = self.near[ball][k]
                d = ((x[out] - self.entries[other]) ** 2).sum(1)
                measured += len(out)
                closer = (d < distance[out]) | ((d == distance[out]) & (other < best[out]))
                best[out[closer]], distance[out[closer]] = other, d[closer]
        return best, distance, measured

    def squared(self, x: np.ndarray, codes: np.ndarray) -> np.ndarray:
        return ((x - self.entries[codes]) ** 2).sum(1)


def vector_blocks(rows: DataFrame, width: int, parts: int, keep: list[str], size: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of vectors: columns as lists, the numbers compressed, and all parts in their position's first ball."""
    fields = [T.StructField(c, T.ArrayType(rows.schema[c].dataType)) for c in ["_id", *keep]]
    schema = T.StructType([*fields, T.StructField("x", T.BinaryType()), T.StructField("codes", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, held, n = to_arrow_schema(schema), [], 0

        def made(table: pa.Table) -> pa.RecordBatch:
            lists = table.column("_x").combine_chunks()
            if (np.diff(lists.offsets.to_numpy()) != width).any():
                raise ValueError(f"vectors of other lengths beside {width}")
            x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            if len(x) and (x.max() > LARGEST or x.min() < -LARGEST):
                raise ValueError(f"an entry is beyond {LARGEST} once it is a whole number")
            bounds = pa.array([0, len(table)], pa.int32())
            columns = [
                pa.ListArray.from_arrays(bounds, table.column(f.name).combine_chunks()).cast(arrow.field(f.name).type) for f in fields
            ]
            blobs = [zlib.compress(x.astype(np.int32).tobytes(), 1), bytes(len(table) * parts)]
            return pa.RecordBatch.from_arrays([*columns, *(pa.array([b], pa.binary()) for b in blobs)], schema=arrow)

        for batch in batches:
            held.append(batch)
            n += len(batch)
            while n >= size:
                table = pa.Table.from_batches(held)
                yield made(table.slice(0, size))
                held, n = table.slice(size).to_batches(), n - size
        if n:
            yield made(pa.Table.from_batches(held))

    return small_batches(rows).mapInArrow(run, schema)


def _parts(x: bytes, parts: int) -> np.ndarray:
    """Whole numbers by (vector, part, position)."""
    return np.frombuffer(zlib.decompress(x), np.int32).astype(np.int64).reshape(-1, parts)


def _round(blocks: DataFrame, books: np.ndarray, width: int, first: bool) -> DataFrame:
    """The blocks with new codes and ``moved``: what this adds to each entry's number of parts and sums."""
    parts, entries, length = books.shape
    schema = T.StructType([*blocks.drop("moved", "errors").schema, T.StructField("moved", T.ArrayType(T.LongType())), T.StructField("errors", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        balls = [Balls(b) for b in books]
        for batch in batches:
            for k in range(len(batch)):
                x = _parts(batch.column("x")[k].as_py(), width).reshape(-1, parts, length)
                before = np.frombuffer(batch.column("codes")[k].as_py(), np.uint8).reshape(-1, parts).astype(np.int64)
                after, error = np.empty_like(before), np.zeros(len(x), np.int64)
                moved = np.zeros((parts, entries, 1 + length), np.int64)
                for p in range(parts):
                    after[:, p], distance, _ = balls[p].assign(x[:, p], before[:, p])
                    error += distance
                    new = np.arange(len(x)) if first else np.flatnonzero(after[:, p] != before[:, p])
                    counted = np.hstack((np.ones((len(new), 1), np.int64), x[new, p]))
                    np.add.at(moved[p], after[new, p], counted)
                    if not first:
                        np.subtract.at(moved[p], before[new, p], counted)
                row = batch.slice(k, 1).select([f.name for f in schema if f.name not in ("codes", "moved", "errors")])
                blobs = {
                    "codes": pa.array([after.astype(np.uint8).tobytes()], pa.binary()),
                    "moved": pa.array([moved.ravel()], arrow.field("moved").type),
                    "errors": pa.array([error], arrow.field("errors").type),
                }
                yield pa.RecordBatch.from_arrays([blobs[n] if n in blobs else row.column(n) for n in schema.names], schema=arrow)

    return blocks.drop("moved", "errors").mapInArrow(run, schema)


def _sums(blocks: DataFrame, shape: tuple[int, ...]) -> np.ndarray:
    """``moved`` added up over all blocks: as many numbers as the codebooks hold, whatever the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(int(np.prod(shape)), np.int64)
        for batch in batches:
            total += batch.column("moved").flatten().to_numpy().reshape(len(batch), -1).sum(0)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "v"])

    found = blocks.select("moved").mapInArrow(run, "at long, v long").groupBy("at").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(int(np.prod(shape)), np.int64)
    for row in found:
        out[row["at"]] = row["v"]
    return out.reshape(shape)


def compress_vectors(
    frame: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of each kept vector, as in the contract of the query.

    Vectors that are null or hold null or non-finite entries are dropped. Rows without an id are
    coded like the others but come last where the first codebooks are taken; repeated ids are taken
    there by their vectors. With fewer vectors than entries the codebooks have as many entries as
    there are vectors; an empty table gives no rows. Rows without a label share one. Other columns
    are not read. Vectors of different lengths, or not of a multiple of the parts, and entries
    beyond :data:`LARGEST` as whole numbers end the job with an error.
    """
    spark = frame.sparkSession
    rows = whole_vectors(frame, id, vector, scale, [label])
    books = first_codebooks(rows, parts, entries)
    kept = T.StructType(
        [
            T.StructField("vec_id", frame.schema[id].dataType),
            T.StructField("code", T.StringType()),
            T.StructField("error", T.LongType()),
            T.StructField("label_error", T.LongType()),
            T.StructField("codebooks_sha256", T.StringType()),
        ]
    )
    if not books.shape[1]:
        return spark.createDataFrame([], kept)
    width = parts * books.shape[2]
    blocks = stored(vector_blocks(rows, width, parts, [f"_{label}"], block_rows))
    held = np.zeros((*books.shape[:2], 1 + books.shape[2]), np.int64)
    for number in range(rounds):
        blocks = stored(_round(blocks, books, width, number == 0))
        held += _sums(blocks, held.shape)
        used = held[:, :, 0] > 0
        books[used] = np.floor_divide(held[used][:, 1:], held[used][:, :1])
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    coded = stored(_coded(_round(blocks, books, width, False), rows, f"_{label}", parts))
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    # A label of very many vectors is dealt over salts, each of which meets a copy of the label's total.
    salted = totals.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = coded.withColumn("_salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    same = dealt["label"].eqNullSafe(salted["label"]) & (dealt["_salt"] == salted["_salt"])
    return dealt.join(salted, same, "left").select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _coded(blocks: DataFrame, rows: DataFrame, label: str, parts: int) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("vec_id", rows.schema["_id"].dataType),
            T.StructField("label", rows.schema[label].dataType),
            T.StructField("code", T.StringType()),
            T.StructField("error", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            for k in range(len(batch)):
                code = batch.column("codes")[k].as_py().hex()
                columns = [
                    batch.column("_id")[k].values,
                    batch.column(label)[k].values,
                    pa.array([code[i : i + 2 * parts] for i in range(0, len(code), 2 * parts)], pa.string()),
                    batch.column("errors")[k].values,
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return blocks.select("_id", label, "codes", "errors").mapInArrow(run, schema)


def _sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """The same rounds in SQL: positions of all vectors, then alternately codes and codebooks."""
    ctes = [
        f"""kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda c: CAST(floor(CAST(c AS DOUBLE) * {scale}) AS BIGINT)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(CAST(c AS DOUBLE)))) = 0
)""",
        f"""pieces AS MATERIALIZED (
  SELECT vec_id, label, p, x[p * (len(x) // {parts}) + 1 : (p + 1) * (len(x) // {parts})] AS v
  FROM kept, (SELECT unnest(range({parts})) AS p)
)""",
        f"""book0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v FROM pieces
  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {entries})
)""",
    ]
    for r in range(rounds + 1):
        ctes.append(
            f"""code{r} AS MATERIALIZED (
  SELECT vec_id, label, p, v, min(d * 100 + e) % 100 AS e, min(d * 100 + e) // 100 AS d FROM (
    SELECT a.vec_id, a.label, a.p, a.v, b.e,
           CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
    FROM pieces a JOIN book{r} b ON a.p = b.p)
  GROUP BY vec_id, label, p, v
)"""
        )
        if r < rounds:
            ctes.append(
                f"""sum{r} AS MATERIALIZED (
  SELECT p, e, i, CAST(sum(c) AS BIGINT) AS s, count(*) AS n
  FROM (SELECT p, e, unnest(v) AS c, generate_subscripts(v, 1) AS i FROM code{r}) GROUP BY p, e, i
)"""
            )
            ctes.append(
                f"""mean{r} AS MATERIALIZED (
  SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM sum{r} GROUP BY p, e
)"""
            )
            ctes.append(
                f"""book{r + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM book{r} b LEFT JOIN mean{r} m ON b.p = m.p AND b.e = m.e
)"""
            )
    ctes.append(
        f"""coded AS (
  SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM code{rounds} GROUP BY vec_id
)"""
    )
    ctes.append(
        f"""digest AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds}
)"""
    )
    return (
        "WITH "
        + ",\n".join(ctes)
        + "\nSELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, digest"
    )


SQL = _sql()
