"""Reading and writing catalogue tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None,
    columns: Sequence[str] | None = None, key: str | None = None, first: int | None = None,
) -> DataFrame:
    """CSV with a header. ``first`` keeps so many rows in the order of ``key``.

    The key stays an ordinary column. Without a schema the types are inferred, which reads
    the file twice.
    """
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    df = reader.csv(path)
    if columns:
        df = df.select(*[F.col(f"`{c}`") for c in columns])
    if first is not None:
        if key is None:
            raise ValueError("the first rows need a key to be ordered by")
        df = df.orderBy(F.col(f"`{key}`")).limit(first)
    return df


def read_query(
    spark: SparkSession, url: str, query: str, options: dict[str, str] | None = None,
    partition_column: str | None = None, bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> DataFrame:
    """Result of a query that the database runs. Split it by a numeric column if it is large."""
    reader = spark.read.format("jdbc").options(**(options or {})).option("url", url)
    reader = reader.option("dbtable", f"({query}) q")
    if partition_column is not None:
        if bounds is None:
            raise ValueError("a partition column needs bounds")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", bounds[0]).option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    return reader.load()


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Raw documents, one per line, as column ``raw``; blank lines are no documents."""
    return spark.read.text(path).select(F.col("value").alias("raw")).filter(
        F.trim("raw") != ""
    )


def write_lines(df: DataFrame, column: str, path: str) -> None:
    """One text line per row, replacing what is there."""
    df.select(F.col(column).cast("string").alias("value")).filter(
        F.col("value").isNotNull()
    ).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str, schema: T.StructType, required: str) -> None:
    """CSV with a header in the declared column order; rows without ``required`` are skipped."""
    conform(df.filter(F.col(required).isNotNull()), schema).write.mode("overwrite").csv(
        path, header=True
    )


def append_json(df: DataFrame, path: str) -> None:
    """Append JSON lines; letters outside ASCII are kept as they are."""
    df.write.mode("append").json(path)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to a declared schema by column name; a missing column becomes null."""
    return df.select(*[
        (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None))
        .cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def replace_table(df: DataFrame, path: str, schema: T.StructType) -> None:
    conform(df, schema).write.mode("overwrite").parquet(path)


def append_rows(df: DataFrame, path: str, schema: T.StructType) -> None:
    conform(df, schema).write.mode("append").parquet(path)


def append_to_database(
    df: DataFrame, url: str, table: str, options: dict[str, str] | None = None,
) -> None:
    df.write.format("jdbc").options(**(options or {})).option("url", url).option(
        "dbtable", table
    ).mode("append").save()


def keyed_update(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """``target`` with the non-null values of ``updates`` laid over the rows of the same key.

    Columns that only ``updates`` has are added. Every target row is kept once: a key that
    is updated twice fails the job rather than multiply rows. Write the result to a new place.
    """
    changed = [c for c in updates.columns if c != key]
    once = updates.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(f"_new_{c}") for c in changed]
    )
    problem = F.concat(F.lit("key updated more than once: "), F.col(key).cast("string"))
    checked = once.withColumn(
        key, F.when(F.col("_n") == 1, F.col(key)).otherwise(F.raise_error(problem))
    ).drop("_n")
    kept = [
        F.coalesce(f"_new_{c}", c).alias(c) if c in changed else F.col(c)
        for c in target.columns
    ]
    added = [F.col(f"_new_{c}").alias(c) for c in changed if c not in target.columns]
    return target.join(checked, key, "left").select(*kept, *added)
