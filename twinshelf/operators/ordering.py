"""Row numbers over a whole table without a one-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

#: Rows that one task sorts, and sizes that one window adds up.
ROWS, SIZES = 500_000, 1024
#: ``monotonically_increasing_id`` counts rows in its lower bits, partitions above them.
_LOWER = (1 << 33) - 1


def _sorted_parts(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """The rows sorted over the whole table, with the number of their part and a place in it.

    Spark samples the keys for the range partitioning; the number of parts follows the rows.
    """
    parts = max(1, -(-df.count() // rows))
    ordered = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    return stage(ordered.withColumns({
        "_part": F.spark_partition_id(),
        "_at": F.monotonically_increasing_id().bitwiseAND(F.lit(_LOWER)),
    }), "sorted")


def _running(sizes: DataFrame, size: str, name: str) -> DataFrame:
    """``name``: the sum of ``size`` over all parts before, by blocks of ``SIZES`` parts."""
    block = F.floor(F.col("_part") / SIZES).alias("_block")
    blocked = sizes.withColumn("_block", block)
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("_block").orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    bases = blocked.groupBy("_block").agg(F.sum(size).alias("_sum")).select(
        "_block", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    return blocked.join(F.broadcast(bases), "_block").withColumn(
        name, F.col("_base") + F.coalesce(F.sum(size).over(within), F.lit(0))
    ).drop("_block", "_base", size)


def number_rows(
    df: DataFrame, keys: Sequence[str], name: str = "number", rows: int = ROWS,
) -> DataFrame:
    """Number the rows 1, 2, 3 … by ``keys``, nulls first; rows of equal keys in any order.

    The table is sorted into parts of about ``rows`` rows. Each part's rows are shifted by the
    sizes of the parts before it; the table of these has a row for each part.
    """
    placed = _sorted_parts(df, keys, rows)
    shifts = _running(placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")), "_n", "_shift")
    return (
        placed.join(F.broadcast(shifts), "_part")
        .withColumn(name, F.col("_shift") + F.col("_at") + 1)
        .drop("_part", "_at", "_shift")
    )


def number_within(
    df: DataFrame, group: str, keys: Sequence[str], name: str = "number", rows: int = ROWS,
) -> DataFrame:
    """Number the rows of each ``group`` 1, 2, 3 … by ``keys``, nulls first; ``group`` is not null.

    A group of any size is dealt over the parts of one sort; a part of a group is shifted by the
    sizes of the group's parts before it, so no task holds more than a part of it.
    """
    placed = _sorted_parts(df, [group, *keys], rows)
    pieces = placed.groupBy(group, "_part").agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = pieces.select(
        group, "_part", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first"))
        .alias("_shift"))
    return (
        placed.join(shifts, [group, "_part"])
        .withColumn(name, F.col("_shift") + F.col("_at") + 1)
        .drop("_part", "_at", "_shift")
    )


def rank_values(*values: tuple[DataFrame, Column]) -> DataFrame:
    """Dense rank of the distinct non-null values that the given columns hold together."""
    pooled = None
    for df, column in values:
        part = df.select(column.alias("key")).filter(F.col("key").isNotNull()).distinct()
        pooled = part if pooled is None else pooled.unionByName(part)
    return number_rows(pooled.distinct(), ["key"], "rank")
