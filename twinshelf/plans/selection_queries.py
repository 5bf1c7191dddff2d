"""Queries: selecting, sampling and counting catalogue rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import selection
from .registry import PRODUCTS, catalogues, products, query


@query(f"""
WITH {PRODUCTS}
SELECT product_id, title, cluster_id FROM products
WHERE category <> 'PROMO'
  AND cluster_id IN (SELECT cluster_id FROM products GROUP BY cluster_id
                     HAVING count(product_id) >= 20)
""")
def large_cluster_rows(spark, folder):
    rows = selection.in_large_groups(
        products(spark, folder), "cluster_id", "product_id", 20
    )
    return rows.filter("category <> 'PROMO'").select("product_id", "title", "cluster_id")


@query(f"""
WITH {PRODUCTS}, drawn AS (
  SELECT cluster_id, md5(concat_ws('-', cluster_id::VARCHAR, '7')) AS draw FROM products
  GROUP BY cluster_id HAVING count(*) > 10 ORDER BY draw, cluster_id LIMIT 7)
SELECT draw, cluster_id, product_id, title FROM products JOIN drawn USING (cluster_id)
""")
def sample_clusters(spark, folder):
    drawn = selection.sample_groups(
        products(spark, folder), "cluster_id", more_than=10, k=7,
        draw=selection.group_draw(F.col("cluster_id"), 7), id_col="product_id",
    )
    return drawn.select("draw", "cluster_id", "product_id", "title")


@query()
def sample_clusters_random(spark, folder):
    drawn = selection.sample_groups(
        products(spark, folder), "cluster_id", more_than=10, k=5,
        draw=selection.random_draw(7), id_col="product_id",
    )
    return drawn.select("draw", "cluster_id", "product_id", "title")


@query(f"""
WITH {PRODUCTS}
SELECT product_id, title, md5(concat_ws('-', product_id::VARCHAR, '7')) AS draw
FROM products ORDER BY draw, product_id LIMIT 100
""")
def sample_rows(spark, folder):
    draw = selection.group_draw(F.col("product_id"), 7)
    return selection.sample_rows(
        products(spark, folder).select("product_id", "title"), 100, draw, "product_id"
    )


@query(f"""
WITH {PRODUCTS}
SELECT product_id, title, cluster_id FROM products
WHERE cluster_id IN (4, 10, 14, 17, 22) AND product_id NOT IN (68, 69, 122, 169)
""")
def in_list_filter(spark, folder):
    return products(spark, folder).filter(
        F.col("cluster_id").isin(4, 10, 14, 17, 22)
        & ~F.col("product_id").isin(68, 69, 122, 169)
    ).select("product_id", "title", "cluster_id")


@query(f"""
WITH {PRODUCTS}
SELECT 'left' AS side, product_id, title FROM products WHERE product_id % 2 = 1
UNION ALL
SELECT 'right' AS side, product_id, title FROM products WHERE product_id % 2 = 0
""")
def parity_split(spark, folder):
    left, right = catalogues(spark, folder)
    return left.select(F.lit("left").alias("side"), "product_id", "title").unionByName(
        right.select(F.lit("right").alias("side"), "product_id", "title")
    )


@query(f"""
WITH {PRODUCTS}
SELECT cluster_id, count(*) AS n, count(DISTINCT title) AS titles, count(DISTINCT brand) AS brands
FROM products GROUP BY cluster_id
""")
def cluster_sizes(spark, folder):
    return products(spark, folder).groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("title").alias("titles"),
        F.countDistinct("brand").alias("brands"),
    )


@query(f"""
WITH {PRODUCTS}, sized AS (
  SELECT product_id, cluster_id, count(product_id) OVER (PARTITION BY cluster_id) AS size,
         ('0x' || substr(md5(product_id::VARCHAR), 1, 8))::BIGINT AS digest
  FROM products)
SELECT cluster_id, size, digest % ceil(size / 100)::BIGINT AS part,
       string_agg(product_id::VARCHAR, ',' ORDER BY product_id) AS members
FROM sized GROUP BY ALL
""")
def cluster_members(spark, folder):
    lists = selection.member_lists(products(spark, folder), "cluster_id", "product_id", chunk=100)
    return lists.withColumn("members", F.array_join(F.col("members").cast("array<string>"), ","))


@query(f"""
WITH {PRODUCTS}
SELECT product_id, row_number() OVER (ORDER BY price DESC, product_id) AS position, price
FROM products
""")
def numbered_products(spark, folder):
    from ..operators.ordering import number_rows

    rows = products(spark, folder).select("product_id", "price")
    return number_rows(
        rows.withColumn("dear", -F.col("price")), ["dear", "product_id"], "position"
    ).select("product_id", "position", "price")
