"""Candidate pairs, kept as pairs of key values.

Blocking and sorted neighbourhood decide by key alone, so the whole candidate set is given by
the pairs of key values that meet and the records behind each value. That table grows with
the number of distinct keys; listing the record pairs would be quadratic in the rows of one
popular key. Comparisons run from these tables (see operators.linking) and reach exactly the
pairs the listing would hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import rank_values


def block_keys(left: DataFrame, right: DataFrame, left_on: str, right_on: str) -> DataFrame:
    """(left_key, right_key): equal keys on both sides; a null key never pairs."""
    shared = left.select(F.col(left_on).alias("left_key")).distinct().join(
        right.select(F.col(right_on).alias("left_key")).distinct(), "left_key"
    )
    return shared.select("left_key", F.col("left_key").alias("right_key"))


def neighbour_keys(
    left: DataFrame, right: DataFrame, left_on: str, right_on: str, window: int = 3,
) -> DataFrame:
    """(left_key, right_key) whose ranks among all distinct keys differ by at most window // 2.

    Each key names the ranks in reach, and those are equi-joined.
    """
    if window < 1 or window % 2 == 0:
        raise ValueError("window must be a positive odd number")
    reach = window // 2
    # Both uses of the ranks come from one plan, so Spark computes the exchange once.
    ranks = rank_values((left, F.col(left_on)), (right, F.col(right_on)))
    near = ranks.select(
        F.col("key").alias("right_key"),
        F.explode(F.sequence(F.col("rank") - reach, F.col("rank") + reach)).alias("rank"),
    )
    met = ranks.select(F.col("key").alias("left_key"), "rank").join(near, "rank").drop("rank")
    lefts = left.select(F.col(left_on).alias("left_key")).distinct()
    rights = right.select(F.col(right_on).alias("right_key")).distinct()
    return met.join(lefts, "left_key", "left_semi").join(rights, "right_key", "left_semi")


def key_sizes(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(
        F.count(F.lit(1)).alias("n")
    )


def candidate_blocks(
    keys: DataFrame, left: DataFrame, right: DataFrame, left_on: str, right_on: str,
) -> DataFrame:
    """(left_key, right_key, n_left, n_right, n_pairs) of a two-table candidate set."""
    return (
        keys.join(key_sizes(left, left_on).toDF("left_key", "n_left"), "left_key")
        .join(key_sizes(right, right_on).toDF("right_key", "n_right"), "right_key")
        .withColumn("n_pairs", F.col("n_left") * F.col("n_right"))
        .select("left_key", "right_key", "n_left", "n_right", "n_pairs")
    )


def self_candidate_blocks(keys: DataFrame, df: DataFrame, on: str) -> DataFrame:
    """The same for one table, where each unordered record pair counts once."""
    blocks = candidate_blocks(keys.filter("left_key <= right_key"), df, df, on, on)
    same = F.col("n_left") * (F.col("n_left") - 1) / 2
    return blocks.withColumn(
        "n_pairs",
        F.when(F.col("left_key") == F.col("right_key"), same.cast("long"))
        .otherwise(F.col("n_pairs")),
    ).filter("n_pairs > 0")


def full_size(left: DataFrame, right: DataFrame) -> DataFrame:
    """Size of the full index, as one row in the shape of ``candidate_blocks``."""
    one = left.agg(F.count(F.lit(1)).alias("n_left"))
    other = right.agg(F.count(F.lit(1)).alias("n_right")).scalar()
    return one.select(
        F.lit(None).cast("string").alias("left_key"),
        F.lit(None).cast("string").alias("right_key"),
        "n_left", other.alias("n_right"), (F.col("n_left") * other).alias("n_pairs"),
    )
