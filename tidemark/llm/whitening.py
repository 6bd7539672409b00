"""Embedding whitening with MLlib block matrices.

Vectors are put on a whole-number grid (``floor(64 c) + 1000000``).  The fit list is each distinct grid vector
once.  Its rows, centred by the exact sums, are indexed into the row blocks of a ``BlockMatrix``; the transpose
times the matrix is the scatter, ``eigh`` of that d x d matrix gives the components, and the rows' block matrix
times the whitening matrix projects them.  ``identity_error`` is measured on the whitened fit list in the same
way.

Scale.  No group of rows meets in one task: distinct vectors combine before the exchange, so a vector that a third
of the rows hold costs one row per task, and every row is projected in the block it lies in.  Inner products are
split over ``blocks / MID_BLOCKS`` tasks (``numMidDimSplits``), whose d x d sums are then added; without the split
one task would multiply all blocks.  The driver gets one number pair per block (``BLOCK_ROWS`` rows) and the d x d
scatter.  Intermediate tables are written to the shared folder.

Cases: a null vector, or one with a null or non-finite entry, or with an entry beyond 2**40 in size (it has no
place on the grid), is dropped.  So are empty vectors and those whose length isn't that of most rows (of equally
frequent lengths the longest).  Null and repeated ids are kept as they are.  Components whose eigenvalue is zero
to double precision (less than 1e-10 of the largest) are left out, so a table of one distinct vector, like an
empty one, gives no components.  Only the two named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import load, share, shared, written

GRID, SHIFT = 64, 1_000_000
LARGEST = float(1 << 40)
COMPONENTS = 16
BLOCK_ROWS = 1024
#: Blocks that one task multiplies.
MID_BLOCKS = 16


def on_grid(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, x) of the rows whose vector can be used."""
    v = F.col(vec_col)
    fine = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) <= LARGEST))
    return rows.where(F.coalesce(fine, F.lit(False))) \
        .select(F.col(id_col).alias("id"), F.transform(v, lambda c: F.floor(c.cast("double") * GRID).cast("long") + SHIFT).alias("x"))


def _blocks(rows: DataFrame, n: int, sums: list[int], id_type: str | None, label: str) -> DataFrame:
    """Row blocks (block, rows, data[, ids, deviations]) of the centred rows, numbered from 0, as a written table.

    ``data``: a column-major ``BLOCK_ROWS`` x d matrix; rows beyond ``rows`` are zero.
    """
    model = share(rows.sparkSession, (n, np.array(sums, np.int64)))
    schema = "part int, seq int, rows int, data binary" + (f", ids array<{id_type}>, deviations array<decimal(38,0)>" if id_type else "")

    def run(batches):
        from pyspark import TaskContext
        n, sums = shared(model)
        d, part, seq = len(sums), TaskContext.get().partitionId(), 0
        held, size = [], 0

        def block(batch):
            x = batch.column("x").flatten().to_numpy().reshape(-1, d)
            data = np.zeros((BLOCK_ROWS, d))
            data[:len(x)] = x - sums // n - (sums % n) / n      # whole parts cancel exactly
            out = [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(x)], pa.int32()), pa.array([data.tobytes("F")], pa.binary())]
            if id_type:
                y = x * n - sums
                safe = float(np.abs(y).max()) ** 2 * d < 2.0 ** 62
                far = (y * y).sum(axis=1) if safe else (y.astype(object) ** 2).sum(axis=1)
                ids, one = batch.column("id"), pa.array([0, len(x)], pa.int32())
                out += [pa.ListArray.from_arrays(one, ids),
                        pa.ListArray.from_arrays(one, pa.array([int(v) for v in far], pa.decimal128(38, 0)))]
            return pa.RecordBatch.from_arrays(out, names=names)

        names = ["part", "seq", "rows", "data"] + (["ids", "deviations"] if id_type else [])
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                piece = batch.slice(at, BLOCK_ROWS - size)
                held.append(piece)
                size, at = size + piece.num_rows, at + piece.num_rows
                if size == BLOCK_ROWS:
                    yield block(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                    held, size, seq = [], 0, seq + 1
        if size:
            yield block(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    blocks = written(rows.mapInArrow(run, schema), label)
    # A task's blocks follow those of the tasks before it: one row per task on the driver.
    counts = sorted((r.part, r.n) for r in blocks.groupBy("part").agg(F.count("*").alias("n")).collect())
    first, starts = 0, []
    for part, k in counts:
        starts.append((part, first))
        first += k
    starts = rows.sparkSession.createDataFrame(starts, "part int, first int")
    return blocks.join(F.broadcast(starts), "part").select((F.col("first") + F.col("seq")).alias("block"), *blocks.columns[2:])


def _matrix(blocks: DataFrame, count: int, d: int) -> BlockMatrix:
    def block(r):
        return (r.block, 0), DenseMatrix(BLOCK_ROWS, d, np.frombuffer(r.data))

    return BlockMatrix(blocks.select("block", "data").rdd.map(block), BLOCK_ROWS, d, count * BLOCK_ROWS, d)


def _gram(m: BlockMatrix, count: int, d: int) -> np.ndarray:
    """The transpose times the matrix, its inner dimension split over ``count / MID_BLOCKS`` tasks."""
    # The Python method has no parameter for the split; the public JVM method of the same name has.
    product = m.transpose()._java_matrix_wrapper.call("multiply", m._java_matrix_wrapper._java_model, max(1, -(-count // MID_BLOCKS)))
    return BlockMatrix(product, d, d).toLocalMatrix().toArray()


@dataclass
class Whitening:
    """A fitted model: ``n`` distinct vectors with ``sums``; ``matrix`` (d x k) whitens centred rows."""

    n: int
    sums: list[int]
    explained: list[float]
    matrix: np.ndarray
    identity_error: float

    @property
    def components(self) -> int:
        return self.matrix.shape[1]

    def project(self, m: BlockMatrix) -> BlockMatrix:
        d, k = self.matrix.shape
        sc = m.blocks.context
        return m.multiply(BlockMatrix(sc.parallelize([((0, 0), DenseMatrix(d, k, self.matrix.ravel("F")))], 1), d, k, d, k))


def fit(grid: DataFrame, d: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors ``x`` of length ``d``; None when there is none or no component."""
    distinct = written(grid.select("x").distinct(), "whitening_fit")
    sums = [r.s for r in distinct.select(F.posexplode("x").alias("i", "c")).groupBy("i").agg(F.sum("c").alias("s")).orderBy("i").collect()]
    n = distinct.count()
    if not n:
        return None
    blocks = _blocks(distinct, n, sums, None, "whitening_fit_blocks")
    count = blocks.count()
    rows = _matrix(blocks, count, d)
    values, vectors = np.linalg.eigh(_gram(rows, count, d) / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, int((values > 1e-10 * max(values[0], 0)).sum())) if values[0] > 0 else 0
    if not k:
        return None
    model = Whitening(n, sums, (values[:k] / values.sum()).tolist(), vectors[:, :k] / np.sqrt(values[:k]), 0.0)
    model.identity_error = float(np.abs(_gram(model.project(rows), count, k) / n - np.eye(k)).max())
    return model


def whiten(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> tuple[DataFrame, Whitening | None]:
    """(whitened rows, model): id, deviation (exact, decimal) and whitened (array of k doubles) of each row that can be used."""
    spark = rows.sparkSession
    grid = written(on_grid(rows, id_col, vec_col), "whitening_grid")
    lengths = grid.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    id_type = grid.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, deviation decimal(38,0), whitened array<double>"
    model = None
    if lengths:
        grid = grid.where(F.size("x") == lengths.d)
        model = fit(grid, lengths.d, components)
    if model is None:
        return spark.createDataFrame([], schema), None
    blocks = _blocks(grid, model.n, model.sums, id_type, "whitening_blocks")
    projected = model.project(_matrix(blocks, blocks.count(), lengths.d)).blocks \
        .map(lambda b: (b[0][0], bytearray(np.ascontiguousarray(b[1].toArray()).tobytes())))
    k = model.components

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                n = batch.column(0)[i].as_py()
                flat = np.frombuffer(batch.column(1)[i].as_buffer(), np.float64)[:n * k]
                yield pa.RecordBatch.from_arrays([
                    batch.column(2)[i].values, batch.column(3)[i].values,
                    pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * k, pa.int32()), pa.array(flat))], names=["id", "deviation", "whitened"])

    out = blocks.select("block", "rows", "ids", "deviations").join(spark.createDataFrame(projected, "block int, whitened binary"), "block") \
        .select("rows", "whitened", "ids", "deviations").mapInArrow(run, schema)
    return out, model


def op12(spark, sf_dir: str) -> DataFrame:
    """The first 16 whitened components of every usable row of ``embeddings``.

    ``deviation`` is null where its exact value is beyond a long (from about ten million distinct vectors on).
    """
    out, model = whiten(load(spark, sf_dir, "embeddings"))
    explained = F.array(*[F.lit(v) for v in model.explained]) if model else F.array(F.lit(0.0))
    return out.select("id", "deviation", F.posexplode("whitened").alias("i", "whitened")).select(
        F.col("id").alias("vec_id"), (F.col("i") + 1).cast("int").alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"),
        F.col("deviation").try_cast("long").alias("deviation"), "whitened", F.element_at(explained, F.col("i") + 1).alias("explained"),
        F.lit(model.identity_error if model else 0.0).alias("identity_error"))
