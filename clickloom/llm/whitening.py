"""Whitening of embeddings through Spark MLlib's distributed BlockMatrix.

Rows are packed into blocks of consecutive numbers, which go from Arrow straight into a
BlockMatrix of centred rows with a last column of ones. Its transpose times itself gives the
scatter, a matrix as wide as a vector, whose eigenvectors are found locally. A second product,
with the whitening matrix, projects all rows. The column of ones carries column sums along, so
the covariance of what comes out can be centred without another pass.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm.storage import small_batches, stored

# Bytes of a block of doubles, and of the blocks that one task multiplies; the driver keeps a
# number for each block, so blocks get higher where there would be more than this many.
BLOCK_BYTES, TASK_BYTES, MOST_BLOCKS = 2 << 20, 32 << 20, 1 << 20
# Width of a block in columns.
COLUMNS = 1024
BLOCK = T.StructType(
    [
        T.StructField("at", T.StructType([T.StructField("i", T.LongType()), T.StructField("j", T.LongType())])),
        T.StructField("block", MatrixUDT()),
    ]
)


def whole_numbers(frame: DataFrame, id: str, vector: str, scale: int, shift: int) -> DataFrame:
    """``_id, _x`` of the rows whose vector has neither null nor non-finite entries: floor(scale * c) + shift."""
    entries = F.col(vector).cast("array<double>")
    bad = F.exists("_v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = frame.select(F.col(id).alias("_id"), entries.alias("_v")).where(F.col("_v").isNotNull() & ~bad)
    return rows.select("_id", F.transform("_v", lambda c: F.floor(c * scale).cast("bigint") + shift).alias("_x"))


def column_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and exact sum of each dimension; one row for each task and dimension is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        count: dict[int, int] = {}
        for batch in batches:
            x = batch.column("_x")
            for width in np.unique(lengths := np.diff(x.offsets.to_numpy())):
                values = _matrix(x.filter(pa.array(lengths == width)), int(width))
                sums[int(width)] = sums.get(int(width), 0) + values.sum(0)
                count[int(width)] = count.get(int(width), 0) + len(values)
        for width, total in sums.items():
            yield pa.RecordBatch.from_pydict(
                {"width": [width] * (width + 1), "d": list(range(-1, width)), "total": [count[width], *total.tolist()]},
                schema=pa.schema([("width", pa.int32()), ("d", pa.int32()), ("total", pa.int64())]),
            )

    found = small_batches(rows).mapInArrow(run, "width int, d int, total long").groupBy("width", "d").agg(F.sum("total")).collect()
    widths = {r[0] for r in found}
    if len(widths) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(widths)}")
    totals = [r[2] for r in sorted(found)]
    return (totals[0], totals[1:]) if totals else (0, [])


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width) if width else np.zeros((len(lists), 0), np.int64)


def row_blocks(rows: DataFrame, width: int, height: int) -> DataFrame:
    """``i, ids, x``: each input partition's rows in blocks of ``height``, the last one lower; ``i`` has no gaps."""
    kind = rows.schema["_id"].dataType
    schema = T.StructType(
        [
            T.StructField("part", T.LongType()),
            T.StructField("k", T.LongType()),
            T.StructField("ids", T.ArrayType(kind)),
            T.StructField("x", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, part, k = to_arrow_schema(schema), TaskContext.get().partitionId(), 0

        def made(table: pa.Table) -> pa.RecordBatch:
            ids = table.column("_id").combine_chunks()
            x = zlib.compress(_matrix(table.column("_x").combine_chunks(), width).tobytes(), 1)
            lists = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
            columns = [pa.array([part]), pa.array([k]), lists.cast(arrow.field("ids").type), pa.array([x], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, schema=arrow)

        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch)
            while n >= height:
                table = pa.Table.from_batches(held)
                yield made(table.slice(0, height))
                k += 1
                held, n = table.slice(height).to_batches(), n - height
        if n:
            yield made(pa.Table.from_batches(held))

    blocks = stored(small_batches(rows).mapInArrow(run, schema))
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = blocks.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # one row for each input partition
    starts = counts.select("part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("start"))
    return blocks.join(starts, "part").select((F.col("start") + F.col("k")).alias("i"), "ids", "x")


def _block(i: int, j: int, values: np.ndarray) -> dict:
    matrix = {"type": 1, "numRows": values.shape[0], "numCols": values.shape[1], "colPtrs": None, "rowIndices": None}
    return {"at": {"i": i, "j": j}, "block": matrix | {"values": values.ravel(), "isTransposed": True}}


def _block_matrix(blocks: DataFrame, high: int, wide: int, rows: int, columns: int) -> BlockMatrix:
    """A BlockMatrix of a frame of :data:`BLOCK`, without a detour through Python objects."""
    return BlockMatrix(callMLlibFunc("createBlockMatrix", blocks, high, wide, rows, columns), high, wide)


def _times(left: BlockMatrix, right: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """The product; ``splits`` cuts the inner dimension over so many tasks."""
    product = left._java_matrix_wrapper._java_model.multiply(right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock)


def centred_matrix(blocks: DataFrame, count: int, n: int, sums: list[int], height: int, wide: int) -> BlockMatrix:
    """Rows x - S/n, with a column of ones at the end. n * x - S is exact before it is divided."""
    total, width = np.array(sums, np.int64), len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(BLOCK)
        for batch in batches:
            for row in batch.to_pylist():
                x = _unpacked(row["x"], width)
                values = np.hstack(((n * x - total) / n, np.ones((len(x), 1))))
                for j in range(0, width + 1, wide):
                    part = np.ascontiguousarray(values[:, j : j + wide])
                    yield pa.RecordBatch.from_pylist([_block(row["i"], j // wide, part)], schema=arrow)

    frame = blocks.select("i", "x").mapInArrow(run, BLOCK)
    return _block_matrix(frame, height, wide, count * height, width + 1)


def _unpacked(x: bytes, width: int) -> np.ndarray:
    return np.frombuffer(zlib.decompress(x), np.int64).reshape(-1, width)


def _covariance(gram: np.ndarray, n: int) -> np.ndarray:
    """From the scatter of rows with a last one: the covariance about the mean, divisor n."""
    mean = gram[-1, :-1] / n
    return gram[:-1, :-1] / n - np.outer(mean, mean)


def whiten(
    frame: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    components: int = 32,
    scale: int = 64,
    shift: int = 1_000_000,
    height: int | None = None,
    columns: int = COLUMNS,
) -> DataFrame:
    """A row for each kept vector and component, as in the contract of the query.

    Vectors that are null or hold null or non-finite entries are dropped; repeated rows and rows
    without an id count as they stand, and other columns are not read. Components without variance
    (constant dimensions, fewer vectors than dimensions) have no whitened values and are left out;
    an empty table, or one without variance, gives no rows. A squared deviation beyond a long is
    null. Vectors of different lengths, and entries whose whole number is beyond a long, end the job
    with an error. ``height`` and ``columns`` are those of a block.
    """
    spark, kind = frame.sparkSession, frame.schema[id].dataType
    schema = T.StructType(
        [
            T.StructField("vec_id", kind),
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()),
            T.StructField("identity_error", T.DoubleType()),
        ]
    )
    rows = whole_numbers(frame, id, vector, scale, shift)
    n, sums = column_sums(rows)
    width = len(sums)
    if not n or not width:
        return spark.createDataFrame([], schema)
    height = height or max(64, BLOCK_BYTES // (8 * width), -(-n // MOST_BLOCKS))
    blocks = row_blocks(rows, width, height)
    count = blocks.count()
    splits = min(count, max(-(-count * height * width * 8 // TASK_BYTES), spark.sparkContext.defaultParallelism))
    wide = max(min(columns, width + 1), components + 1)
    centred = centred_matrix(blocks, count, n, sums, height, wide)
    scatter = _times(centred.transpose(), centred, splits).toLocalMatrix().toArray()
    covariance = _covariance(scatter, n)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    some = int((values > max(values[0], 0) * width * np.finfo(float).eps).sum())
    some = min(some, components)
    if not some:
        return spark.createDataFrame([], schema)
    signs = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(width)])  # the largest entry is positive
    whitener = np.zeros((width + 1, some + 1))
    whitener[:width, :some] = (vectors * signs)[:, :some] / np.sqrt(values[:some])
    whitener[width, some] = 1
    explained = values[:some] / np.trace(covariance)
    parts = [_block(i // wide, 0, whitener[i : i + wide]) for i in range(0, width + 1, wide)]
    parts = [((p["at"]["i"], 0), _dense(p["block"])) for p in parts]
    right = _block_matrix(spark.createDataFrame(parts, BLOCK), wide, some + 1, width + 1, some + 1)
    projected = stored(_projected(_times(centred, right), some))
    grams = projected.select(F.posexplode("gram").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).collect()
    gram = np.array([r["v"] for r in sorted(grams)]).reshape(some + 1, some + 1)
    error = float(np.abs(_covariance(gram, n) - np.eye(some)).max())
    both = blocks.join(projected.select("i", "y"), "i")
    return _rows_out(both, schema, n, np.array(sums, np.int64), some, explained, error)


def _dense(block: dict):
    from pyspark.mllib.linalg import DenseMatrix

    return DenseMatrix(block["numRows"], block["numCols"], block["values"], block["isTransposed"])


def _projected(product: BlockMatrix, some: int) -> DataFrame:
    """``i, y, gram`` of each block: its projected rows, and their transpose times themselves."""
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string("i long, y binary, gram array<double>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            at, blocks = batch.column(0), batch.column(1)
            for k in range(len(batch)):
                m = blocks[k]
                shape = (m["numRows"].as_py(), m["numCols"].as_py())
                flat = m["values"].values.to_numpy()
                y = flat.reshape(shape) if m["isTransposed"].as_py() else flat.reshape(shape[::-1]).T
                gram = (y.T @ y).ravel().tolist()
                row = {"i": at[k]["_1"].as_py(), "y": np.ascontiguousarray(y[:, :some]).tobytes(), "gram": gram}
                yield pa.RecordBatch.from_pylist([row], schema=arrow)

    blocks = callMLlibFunc("getMatrixBlocks", product._java_matrix_wrapper._java_model)
    return blocks.mapInArrow(run, schema)


def _rows_out(
    both: DataFrame, schema: T.StructType, n: int, sums: np.ndarray, some: int, explained: np.ndarray, error: float
) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            ids = batch.column("ids")
            for k in range(len(batch)):
                deviation = squared_lengths(n * _unpacked(batch.column("x")[k].as_py(), len(sums)) - sums)
                size = len(deviation)
                rows = np.repeat(np.arange(size), some)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids[k].values.take(pa.array(rows)),
                        pa.array(np.tile(np.arange(1, some + 1, dtype=np.int32), size)),
                        pa.array(np.full(len(rows), n)),
                        pa.array(deviation, pa.int64()).take(pa.array(rows)),
                        pa.array(np.frombuffer(batch.column("y")[k].as_py())),
                        pa.array(np.tile(explained, size)),
                        pa.array(np.full(len(rows), error)),
                    ],
                    schema=arrow,
                )

    return both.select("ids", "x", "y").mapInArrow(run, schema)


def squared_lengths(values: np.ndarray) -> list[int | None]:
    """Exact sums of squares of each row; none where they are beyond a long."""
    most = int(np.abs(values).max()) if values.size else 0
    if most * most * values.shape[1] < 1 << 63:
        return (values * values).sum(1).tolist()
    exact = (sum(v * v for v in row) for row in values.tolist())
    return [s if s < 1 << 63 else None for s in exact]
