"""Whitening of vectors with distributed block matrices.

The rows are indexed into blocks of a Spark MLlib ``BlockMatrix``. One block below the other
they are a tall matrix X, and XᵀX, multiplied in splits of the long side, is the scatter. Its
eigenvectors over the roots of their eigenvalues are the whitening matrix W, found on the driver,
as it is dimensions × dimensions. For the projection the same blocks are laid out as a square
grid and W stands in every block of the other matrix's diagonal: a product of block matrices is
spread over both sides of its grid, and a tall one would leave its product to few tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..session import stage

#: An entry c stands for the whole number floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Rows of a block, and blocks that one task of the scatter multiplies.
ROWS, TOGETHER = 1024, 16
#: Whole numbers up to here are exact as doubles.
EXACT = float(1 << 53)


@dataclass(frozen=True)
class Fit:
    """``n`` rows, ``sums`` of the whole numbers less SHIFT, eigenvalues and unit eigenvectors."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray

    @property
    def components(self) -> int:
        """Directions in which the rows differ; rounding alone gives no direction."""
        top = self.values[0] if len(self.values) else 0.0
        return int((self.values > top * len(self.values) * 1e-14).sum()) if top > 0 else 0


def _usable(vector: str) -> Column:
    def bad(x: Column) -> Column:
        x = x.cast("double")
        return x.isNull() | F.isnan(x) | (F.abs(x) * SCALE >= EXACT)
    return F.col(vector).isNotNull() & ~F.exists(vector, bad) & (F.size(vector) > 0)


def blocks(df: DataFrame, id_col: str, vector_col: str, rows: int = ROWS) -> DataFrame:
    """(block, members): usable rows in blocks 0, 1, 2 … of ``rows`` at most.

    A member is (at, id, x), ``x`` the whole numbers less SHIFT, in order of ``at``. Every task
    cuts its own rows into blocks, and a table with a row for each task says where its blocks begin.
    """
    good = df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).filter(_usable("v"))
    length = good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    good = good.filter(F.size("v") == (length["d"] if length else 0))
    placed = stage(good.select(
        "id", F.transform("v", lambda c: F.floor(c.cast("double") * SCALE)).alias("x"),
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at"),
    ), "whole-vectors")
    sizes = placed.groupBy("part").agg((F.max("at") + 1).alias("n"))
    most = sizes.agg(F.max("n")).first()[0] or 1
    height = min(rows, most)
    taken = F.ceil(F.col("n") / height)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begin = sizes.select("part", F.coalesce(F.sum(taken).over(before), F.lit(0)).alias("begin"))
    at = (F.col("begin") + F.floor(F.col("at") / height)).alias("block")
    member = F.struct((F.col("at") % height).cast("int").alias("at"), "id", "x").alias("member")
    return stage(
        placed.join(F.broadcast(begin), "part").select(at, member)
        .groupBy("block").agg(F.sort_array(F.collect_list("member")).alias("members")),
        "vector-blocks",
    )


def _matrix(table: DataFrame, fit_n: int, sums: list[int], height: int, wide: int) -> BlockMatrix:
    """The centred rows as a block matrix that is ``wide`` blocks wide; short blocks end in zeros."""
    mean = np.array(sums, float) / fit_n
    d = len(sums)

    def entry(row) -> tuple[tuple[int, int], DenseMatrix]:
        values = np.zeros((height, d))
        values[:len(row.x)] = np.array(row.x, float) - mean
        return (row.block // wide, row.block % wide), DenseMatrix(
            height, d, values.ravel(order="F"))

    cells = table.select("block", F.col("members.x").alias("x")).rdd.map(entry)
    return BlockMatrix(cells, height, d)


def _product(left: BlockMatrix, right: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """The product with the inner side in ``splits``: without these one task gets all of it."""
    found = left._java_matrix_wrapper.call(
        "multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(found, left.rowsPerBlock, right.colsPerBlock)


def _tall_scatter(table: DataFrame, n: int, sums: list[int], height: int, count: int) -> np.ndarray:
    tall = _matrix(table, n, sums, height, 1).persist(StorageLevel.MEMORY_AND_DISK)
    found = _product(tall.transpose(), tall, -(-count // TOGETHER)).toLocalMatrix().toArray()
    tall.blocks.unpersist()
    return found


def fit(table: DataFrame) -> Fit | None:
    """The covariance's eigenvectors, or None without rows; ``table`` comes from ``blocks``."""
    per = table.select(F.explode("members.x").alias("x")).select(F.posexplode("x").alias("i", "x"))
    totals = per.groupBy("i").agg(F.sum("x").alias("s"), F.count("x").alias("n")).orderBy("i").collect()
    if not totals:
        return None
    n, sums = totals[0]["n"], [row["s"] for row in totals]
    height, count = _shape(table)
    scatter = _tall_scatter(table, n, sums, height, count)
    values, vectors = np.linalg.eigh((scatter + scatter.T) / (2 * n))
    return Fit(n, sums, values[::-1].copy(), vectors[:, ::-1].copy())


def _shape(table: DataFrame) -> tuple[int, int]:
    row = table.agg(F.max(F.size("members")), F.count(F.lit(1))).first()
    return row[0], row[1]


def _projected(table: DataFrame, model: Fit, k: int) -> DataFrame:
    """(block, y): the whitened rows of each block, one behind the other."""
    height, count = _shape(table)
    wide = int(np.ceil(np.sqrt(count)))
    whitening = model.vectors[:, :k] / np.sqrt(model.values[:k])
    d = len(model.sums)
    values = whitening.ravel(order="F")
    spark = table.sparkSession
    diagonal = spark.sparkContext.range(wide, numSlices=min(wide, 64)).map(
        lambda j: ((j, j), DenseMatrix(d, k, values)))
    product = _product(_matrix(table, model.n, model.sums, height, wide), BlockMatrix(diagonal, d, k))
    rows = product.blocks.map(
        lambda cell: (cell[0][0] * wide + cell[0][1], cell[1].toArray().ravel().tolist()))
    return spark.createDataFrame(rows, "block long, y array<double>")


def _deviation(x: Column, model: Fit) -> Column:
    """Sum over dimensions of (n * x - S)², exactly; null where it is beyond a long.

    SHIFT falls out of n * x - S, so the numbers less SHIFT do.
    """
    total = F.array(*[F.lit(s).cast("long") for s in model.sums])
    apart = F.zip_with(x, total, lambda a, s: F.try_subtract(F.try_multiply(F.lit(model.n).cast("long"), a), s))
    return F.aggregate(apart, F.lit(0).cast("long"), lambda t, e: F.try_add(t, F.try_multiply(e, e)))


def _identity_error(whitened: DataFrame, n: int, k: int) -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity."""
    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            for y in batch["y"]:
                rows = np.asarray(y).reshape(-1, k)  # the zeros of a short block add nothing
                total[:k] += rows.T @ rows
                total[k] += rows.sum(axis=0)
        yield pd.DataFrame({"i": np.arange(total.size), "s": total.ravel()})

    parts = whitened.select("y").mapInPandas(sums, "i int, s double")
    found = np.zeros((k + 1) * k)
    for row in parts.groupBy("i").agg(F.sum("s").alias("s")).collect():
        found[row["i"]] = row["s"]
    found = found.reshape(k + 1, k) / n
    return float(np.abs(found[:k] - np.outer(found[k], found[k]) - np.eye(k)).max())


RESULT = ("id {}, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


def whiten(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    components: int = COMPONENTS, rows: int = ROWS,
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), a row a component.

    An entry c becomes x = floor(64 c) + 1,000,000, and rows are fitted and projected by x. A
    null vector, an empty one and one with a null, NaN, infinite or, beyond 2^53 / 64, inexact
    entry takes no part. Vectors of another length than the commonest (of equally common ones
    the longest) take no part either. Repeated rows, also of one id or of a null id, each count
    and each come back. Equal eigenvalues leave their components' directions open, as in any such
    analysis. Directions in which the rows do not differ are no components, so a table
    of one row, of equal rows, or an empty one gives an empty result. Columns other than the two
    named play no part, whatever they are called. ``deviation`` is null if beyond a long.
    """
    table = blocks(df, id_col, vector_col, rows)
    model = fit(table)
    k = min(components, model.components) if model else 0
    kind = df.schema[id_col].dataType.simpleString()
    if not k:
        return df.sparkSession.createDataFrame([], RESULT.format(kind))
    projected = stage(_projected(table, model, k), "whitened")
    error = _identity_error(projected, model.n, k)
    share = model.values[:k] / model.values.sum()
    explained = F.array(*[F.lit(float(s)) for s in share])
    member = F.col("m.member")
    return (
        table.join(projected, "block")
        .select(F.explode(F.transform("members", lambda m, at: F.struct(
            m.alias("member"), F.slice("y", at * k + 1, F.lit(k)).alias("y")))).alias("m"))
        .select(member["id"].alias("id"), _deviation(member["x"], model).alias("deviation"),
                F.posexplode("m.y").alias("at", "whitened"))
        .select("id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
                "deviation", "whitened", explained[F.col("at")].alias("explained"),
                F.lit(error).alias("identity_error"))
    )
