"""Selecting and sampling catalogue rows, and the plain aggregates around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_large_groups(df: DataFrame, group: str, counted: str, at_least: int) -> DataFrame:
    """Rows whose group has at least so many non-null ``counted`` values in the whole table."""
    large = (
        df.groupBy(group)
        .agg(F.count(counted).alias("_n"))
        .filter(F.col("_n") >= at_least)
        .select(group)
    )
    return df.join(large, group, "left_semi")


def group_draw(key: Column, seed: str | int) -> Column:
    """A draw per group that any engine can repeat."""
    return F.md5(F.concat_ws("-", key.cast("string"), F.lit(str(seed))))


def random_draw(seed: int | None = None) -> Column:
    """Random whole number from 1 to 99."""
    return F.floor(F.rand(seed) * (100 - 1) + 1)


def sample_groups(
    df: DataFrame, group: str, more_than: int, k: int, draw: Column, id_col: str,
) -> DataFrame:
    """All rows of ``k`` drawn groups with more than ``more_than`` rows, in draw order.

    Only ``k`` group rows are broadcast.
    """
    drawn = (
        df.groupBy(group)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > more_than)
        .select(group, draw.alias("draw"))
        .orderBy("draw", group)
        .limit(k)
    )
    return df.join(F.broadcast(drawn), group).orderBy("draw", group, id_col)


def sample_rows(df: DataFrame, n: int, draw: Column, id_col: str) -> DataFrame:
    """``n`` drawn rows: one pass with a bounded heap per task, no full sort."""
    return df.withColumn("draw", draw).orderBy("draw", id_col).limit(n)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc(column))


def member_lists(df: DataFrame, group: str, id_col: str, chunk: int = 1000) -> DataFrame:
    """Members gathered per group, in parts of about ``chunk`` ids.

    A group with a third of all rows becomes many array rows instead of one, so no task has
    to hold it. Ids go to the parts of their group by hash; every id is in exactly one part.
    """
    sizes = df.groupBy(group).agg(F.count(id_col).alias("size"))
    parts = F.ceil(F.col("size") / chunk)
    digest = F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 8), 16, 10)
    return (
        df.filter(F.col(id_col).isNotNull())
        .join(sizes, group)
        .withColumn("part", F.pmod(digest.cast("long"), parts))
        .groupBy(group, "size", "part")
        .agg(F.sort_array(F.collect_list(id_col)).alias("members"))
    )


def copies(df: DataFrame, by: list[str], id_col: str) -> DataFrame:
    """Collapse rows that agree on ``by``: ``id`` is the least id, ``copies`` the row count."""
    return df.groupBy(*by).agg(F.min(id_col).alias("id"), F.count(F.lit(1)).alias("copies"))


def dealt(df: DataFrame, n: int, by: list[str], rows: int = 50_000) -> DataFrame:
    """The ``n`` rows of ``df`` dealt to parts of about ``rows`` rows by a hash of ``by``.

    For costly work on rows of small tables: a file that is read by a few tasks, or parts put
    together by size, would leave it to those.
    """
    return df.repartition(max(1, -(-n // rows)), *by)
