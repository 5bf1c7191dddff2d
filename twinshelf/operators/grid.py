"""Equi-joins of many-to-many groups, with large groups cut into a grid.

Joining a key that holds ``n`` rows to itself yields up to n²/2 rows in one task, however
small its input, and adaptive execution looks at input sizes only. So a key with more than
``BLOCK`` rows is cut into pieces by hash, every pair of pieces is a task group of its own,
and the rows of one piece are copied to each group it takes part in. No pair is lost or
met twice. Keys that cannot pair at all are dropped before the join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 4000


def _prefixed(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return df.select(*[
        F.col(c) if c in keys or c in ("_p", "_q") else F.col(c).alias(f"{prefix}{c}")
        for c in df.columns
    ])


def _piece(id_col: str, pieces: Column) -> Column:
    return F.pmod(F.xxhash64(id_col), pieces).cast("int")


def _pieces(n: str, block: int) -> Column:
    return F.ceil(F.col(n) / block).cast("int")


def self_pairs(
    rows: DataFrame, keys: Sequence[str], id_col: str = "id", block: int = BLOCK,
) -> DataFrame:
    """Pairs of rows that share ``keys``: columns ``a_…`` and ``b_…`` with a's id < b's id.

    ``id_col`` must be unique within a key. Two rows that share several keys meet once per
    key. The smaller id is only known after the join, so payload columns are swapped then.
    """
    keys = list(keys)
    payload = [c for c in rows.columns if c not in keys]
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    cut = (
        rows.join(sizes.withColumn("_pieces", _pieces("_n", block)).drop("_n"), keys)
        .withColumn("_piece", _piece(id_col, F.col("_pieces")))
    )
    first = cut.withColumn("_p", F.col("_piece")).withColumn(
        "_q", F.explode(F.sequence("_piece", F.col("_pieces") - 1))
    ).drop("_piece", "_pieces")
    second = cut.withColumn("_q", F.col("_piece")).withColumn(
        "_p", F.explode(F.sequence(F.lit(0), "_piece"))
    ).drop("_piece", "_pieces")
    met = _prefixed(first, keys, "x_").join(
        _prefixed(second, keys, "y_"), [*keys, "_p", "_q"]
    ).filter((F.col("_p") < F.col("_q")) | (F.col(f"x_{id_col}") < F.col(f"y_{id_col}")))
    ordered = F.col(f"x_{id_col}") < F.col(f"y_{id_col}")
    return met.select(
        *keys,
        *[F.when(ordered, F.col(f"x_{c}")).otherwise(F.col(f"y_{c}")).alias(f"a_{c}")
          for c in payload],
        *[F.when(ordered, F.col(f"y_{c}")).otherwise(F.col(f"x_{c}")).alias(f"b_{c}")
          for c in payload],
    )


def side_blocks(
    left: DataFrame, right: DataFrame, keys: Sequence[str],
    left_id: str = "id", right_id: str = "id", block: int = BLOCK,
) -> tuple[DataFrame, DataFrame]:
    """Both sides with block columns ``_p`` and ``_q``: rows meet within (keys, _p, _q)."""
    keys = list(keys)
    sizes = (
        left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_l"))
        .join(right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_r")), keys)
        .select(*keys, _pieces("_l", block).alias("_lp"), _pieces("_r", block).alias("_rp"))
    )
    placed_left = (
        left.join(sizes, keys)
        .withColumn("_p", _piece(left_id, F.col("_lp")))
        .withColumn("_q", F.explode(F.sequence(F.lit(0), F.col("_rp") - 1)))
        .drop("_lp", "_rp")
    )
    placed_right = (
        right.join(sizes, keys)
        .withColumn("_q", _piece(right_id, F.col("_rp")))
        .withColumn("_p", F.explode(F.sequence(F.lit(0), F.col("_lp") - 1)))
        .drop("_lp", "_rp")
    )
    return placed_left, placed_right


def side_pairs(
    left: DataFrame, right: DataFrame, keys: Sequence[str],
    left_id: str = "id", right_id: str = "id", block: int = BLOCK,
    where: Callable[[], Column] | None = None,
) -> DataFrame:
    """Left rows with right rows of the same ``keys``: columns ``a_…`` and ``b_…``."""
    keys = list(keys)
    placed_left, placed_right = side_blocks(left, right, keys, left_id, right_id, block)
    met = _prefixed(placed_left, keys, "a_").join(
        _prefixed(placed_right, keys, "b_"), [*keys, "_p", "_q"]
    ).drop("_p", "_q")
    return met.filter(where()) if where else met
