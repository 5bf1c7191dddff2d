"""Registered queries: a Spark function of (spark, folder) and, where SQL can say it, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql.strip()
        return function
    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# ``part`` stands in for the labelled product table.
PRODUCTS = """products AS (
  SELECT p_partkey AS product_id, p_name AS name, p_brand AS brand, p_type AS category,
         p_size AS cluster_id, p_retailprice AS price,
         p_brand || ' ' || p_name || ' ' || p_type || ' ' || p_size || ' gb' AS title
  FROM part)"""


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"), F.col("p_type").alias("category"),
        F.col("p_size").alias("cluster_id"), F.col("p_retailprice").alias("price"),
        F.concat("p_brand", F.lit(" "), "p_name", F.lit(" "), "p_type", F.lit(" "),
                 F.col("p_size").cast("string"), F.lit(" gb")).alias("title"),
    )


def catalogues(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The product table as two catalogues: odd and even ids, every row in one of them."""
    whole = products(spark, folder)
    odd = F.col("product_id") % 2 == 1
    return whole.filter(odd), whole.filter(~odd)
