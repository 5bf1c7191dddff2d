"""Queries: every sink written to the work folder and read back by its source.

Database sources and sinks are left out, as they need a database.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.documents import parse
from ..session import new_path
from ..sources import tables
from .registry import PRODUCTS, products, query, table

_ROWS = (
    T.StructType().add("product_id", T.LongType()).add("name", T.StringType())
    .add("brand", T.StringType()).add("category", T.StringType())
    .add("cluster_id", T.IntegerType()).add("price", T.DoubleType())
)


def _listed(spark, folder):
    return tables.conform(products(spark, folder), _ROWS)


@query(f"""
WITH {PRODUCTS} SELECT product_id, name, brand, cluster_id::INTEGER AS cluster_id,
price::DOUBLE AS price FROM products WHERE brand IS NOT NULL
""")
def csv_written_and_read(spark, folder):
    path = new_path(spark, "csv")
    tables.write_csv(_listed(spark, folder), path, _ROWS, required="brand")
    return tables.read_csv(
        spark, path, _ROWS, columns=["product_id", "name", "brand", "cluster_id", "price"])


@query(f"""
WITH {PRODUCTS} SELECT product_id, name, category FROM products ORDER BY product_id LIMIT 206
""")
def csv_first_rows(spark, folder):
    path = new_path(spark, "csv")
    tables.write_csv(_listed(spark, folder), path, _ROWS, required="product_id")
    return tables.read_csv(spark, path, columns=["product_id", "name", "category"],
                           key="product_id", first=206).withColumn(
        "product_id", F.col("product_id").cast("long"))


@query("""
SELECT o_orderkey AS id, o_orderstatus AS status, CASE WHEN o_orderkey % 2 = 0 THEN 'é 🎈' END AS note
FROM orders
""")
def json_lines_written_and_read(spark, folder):
    path = new_path(spark, "json")
    rows = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderkey") % 2 == 0, F.lit("é 🎈")).alias("note"))
    for part in (0, 1):  # two appends to one place
        tables.append_json(rows.filter(F.col("id") % 2 == part), path)
    good, _ = parse(tables.read_documents(spark, path), "raw", T.StructType.fromDDL(
        "id long, status string, note string"))
    return good.select("doc.id", "doc.status", "doc.note")


@query("SELECT l_orderkey::VARCHAR AS line, count(*) AS n FROM lineitem GROUP BY 1")
def text_lines_written_and_read(spark, folder):
    path = new_path(spark, "lines")
    tables.write_lines(table(spark, folder, "lineitem"), "l_orderkey", path)
    return tables.read_documents(spark, path).groupBy(F.col("raw").alias("line")).agg(
        F.count(F.lit(1)).alias("n"))


@query(f"""
WITH {PRODUCTS} SELECT product_id, name, brand, category, cluster_id::INTEGER AS cluster_id,
price::DOUBLE AS price FROM products
""")
def table_replaced_and_appended(spark, folder):
    path, rows = new_path(spark, "table"), _listed(spark, folder)
    tables.replace_table(rows, path, _ROWS)
    tables.replace_table(rows.filter("product_id % 3 = 0"), path, _ROWS)
    tables.append_rows(rows.filter("product_id % 3 <> 0"), path, _ROWS)
    return spark.read.schema(_ROWS).parquet(path)
