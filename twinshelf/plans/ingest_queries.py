"""Queries: raw documents, listings and pages to product rows.

The raw documents are made from the sales table, one per sold line, and then read back the way
stored documents are.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas
from ..functions.documents import BROKEN, nested_as_text, parse, usable_id
from ..operators.selection import dealt
from ..sources import pages as html
from ..sources import products as ingest
from ..sources.tables import conform
from .registry import query, table

_SOLD = """sold AS (
  SELECT *, round(l_extendedprice * 100)::BIGINT AS price, l_linenumber = 6 AS broken,
         CASE WHEN l_quantity = 50 THEN 0 ELSE l_partkey END AS id
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey)"""


def _sold(spark, folder):
    lines = table(spark, folder, "lineitem")
    sales = lines.join(
        table(spark, folder, "part"), F.col("p_partkey") == F.col("l_partkey")
    ).join(table(spark, folder, "supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
    # Documents cost far more than their rows: tasks follow the number of lines, not of bytes.
    sales = dealt(sales, lines.count(), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    return sales.withColumn("price", F.round(F.col("l_extendedprice") * 100).cast("long")) \
        .withColumn("id", F.when(F.col("l_quantity") == 50, 0).otherwise(F.col("l_partkey")))


def _raw(sold, document):
    """JSON text per line; lines numbered 6 are cut off and no longer parse."""
    text = F.to_json(document)
    cut = F.substring(text, F.lit(1), F.length(text) - 5)
    return sold.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                       F.when(F.col("l_linenumber") == 6, cut).otherwise(text).alias("raw"))


def seller_documents(spark, folder):
    sold = _sold(spark, folder)
    seller = F.struct(
        F.col("l_orderkey").alias("product_id"), "price", F.col("l_suppkey").alias("store_id"),
        F.col("s_name").alias("name"),
    )
    none = F.array().cast("array<struct<product_id:bigint,price:bigint,store_id:bigint,"
                          "name:string>>")
    return _raw(sold, F.struct(
        "id", F.concat(F.lit("sku"), F.col("l_partkey").cast("string")).alias("sku"),
        F.col("p_name").alias("name"), F.lit(None).cast("string").alias("url_key"),
        F.concat(F.lit("/"), "p_name").alias("url_path"),
        F.struct(F.col("p_type").alias("name")).alias("categories"),
        F.struct(F.col("p_brand").alias("name")).alias("brand"),
        F.when(F.col("l_returnflag") == "A", none)
        .when(F.col("l_returnflag") == "R", F.array(seller, seller))
        .otherwise(F.array(seller)).alias("other_sellers"),
        F.when(F.col("l_linestatus") == "O", seller).alias("current_seller"),
    ))


def shop_documents(spark, folder):
    return _raw(_sold(spark, folder), F.struct(
        "id", F.concat(F.lit("sku"), F.col("l_partkey").cast("string")).alias("sku"),
        F.col("p_name").alias("name"), F.concat(F.lit("/"), "p_name").alias("cat_path"),
        F.when(F.col("l_returnflag") != "N",
               F.concat(F.lit("🎈🎈"), "p_name", F.lit("🎈🎈"))).alias("short_description"),
        "price", F.col("p_brand").alias("brand_name"),
        F.when(F.col("l_linestatus") == "O",
               F.struct(F.col("p_type").alias("category_level1_name"))).alias("categories"),
        F.lit("other").alias("category"),
        F.struct(F.col("l_suppkey").alias("shop_id"), F.col("s_name").alias("shop_name"))
        .alias("shop_info"),
    ))


_SELLER_COLUMNS = """l_orderkey AS pid, 'sku' || l_partkey AS sku, p_name AS name,
  NULL::VARCHAR AS url_key, '/' || p_name AS url_path, 'first' AS sales_page,
  NULL::VARCHAR AS short_desc, price, p_type AS category, p_brand AS brand,
  l_suppkey AS store_id, s_name AS store_name"""

_SELLER_SQL = f"""
SELECT {_SELLER_COLUMNS} FROM sold,
  range(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'R' THEN 2 ELSE 1 END)
WHERE NOT broken AND id <> 0
UNION ALL
SELECT {_SELLER_COLUMNS} FROM sold
WHERE NOT broken AND id <> 0 AND l_linestatus = 'O' AND price > 3000000"""

_SHOP_SQL = """
SELECT id AS pid, 'sku' || l_partkey AS sku, p_name AS name, NULL::VARCHAR AS url_key,
  '/' || p_name AS url_path, 'second' AS sales_page,
  CASE WHEN l_returnflag <> 'N' THEN p_name END AS short_desc, price,
  CASE WHEN l_linestatus = 'O' THEN p_type ELSE 'other' END AS category, p_brand AS brand,
  l_suppkey AS store_id, s_name AS store_name
FROM sold WHERE NOT broken AND id <> 0"""


@query(f"WITH {_SOLD} {_SELLER_SQL}")
def seller_rows(spark, folder):
    return ingest.seller_rows(seller_documents(spark, folder), "first")[0]


@query(f"WITH {_SOLD} {_SHOP_SQL}")
def shop_rows(spark, folder):
    return ingest.shop_rows(shop_documents(spark, folder), "second")[0]


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_linenumber = 6")
def quarantined_lines(spark, folder):
    bad = ingest.seller_rows(seller_documents(spark, folder), "first")[1]
    return bad.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(f"WITH {_SOLD}, rows AS ({_SELLER_SQL} UNION ALL {_SHOP_SQL}) SELECT * FROM rows")
def vendor_union(spark, folder):
    first = ingest.seller_rows(seller_documents(spark, folder), "first")[0]
    second = ingest.shop_rows(shop_documents(spark, folder), "second")[0]
    whole = ingest.union_products(first, second)
    return conform(whole, schemas.PRODUCT).drop("id")


@query(f"""
WITH {_SOLD}, rows AS ({_SHOP_SQL})
SELECT pid, name, price, category, brand FROM rows
WHERE price >= 1000000 AND price <= 8000000 AND category = 'SMALL'
""")
def priced_products(spark, folder):
    rows = ingest.shop_rows(shop_documents(spark, folder), "second")[0]
    return ingest.priced(rows, floor=1_000_000, ceiling=8_000_000, category="SMALL").select(
        "pid", "name", "price", "category", "brand"
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey AS product_id, p_name AS product_title,
       l_suppkey || '.' || l_partkey AS url_key,
       'https://shop.example/i.' || l_suppkey || '.' || l_partkey AS url_path,
       'third' AS vendor, NULL::VARCHAR AS short_desc,
       round(l_extendedprice * 100)::BIGINT / 100000.0::DOUBLE AS price
FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_linenumber <> 6
""")
def item_rows(spark, folder):
    documents = _raw(_sold(spark, folder), F.struct(F.struct(
        F.col("l_partkey").alias("itemid"), F.col("p_name").alias("name"), "price"
    ).alias("item")))
    keyed = documents.withColumn("url_key", F.concat_ws(
        ".", F.col("l_suppkey").cast("string"), F.col("l_partkey").cast("string")
    ))
    return ingest.item_rows(
        keyed, "third", "https://shop.example/i.", keep=["l_orderkey", "l_linenumber"]
    )[0]


@query(f"""
WITH {_SOLD}
SELECT l_orderkey, l_linenumber, id, '{{"name":"' || p_type || '"}}' AS categories,
       '{{"name":"' || p_brand || '"}}' AS brand
FROM sold WHERE NOT broken AND id <> 0
""")
def flat_documents(spark, folder):
    good, _ = parse(seller_documents(spark, folder), "raw", schemas.SELLER_DOCUMENT)
    documents = good.filter(usable_id(F.col("doc.id"))).select(
        "l_orderkey", "l_linenumber", "doc.*"
    ).drop(BROKEN)
    return nested_as_text(documents).select(
        "l_orderkey", "l_linenumber", ingest.whole("id").alias("id"), "categories", "brand"
    )


_RESPONSES = """responses AS (
  SELECT p_size AS listing, p_partkey // 100 AS page, p_partkey AS id,
         CASE WHEN (p_partkey // 100) % 7 = 5 THEN 500 ELSE 200 END AS status,
         (p_partkey // 100) % 11 = 10 AS empty
  FROM part)"""


def responses(spark, folder):
    """Listing responses: the ids of a listing come in pages of at most 100."""
    page = F.floor(F.col("p_partkey") / 100)
    paged = table(spark, folder, "part").groupBy(
        F.col("p_size").alias("listing"), page.alias("page")
    ).agg(F.collect_list(F.struct(F.col("p_partkey").alias("id"))).alias("data"))
    return paged.select(
        "listing", "page",
        F.when(F.col("page") % 7 == 5, 500).otherwise(200).alias("status"),
        F.when(F.col("page") % 11 == 10, F.lit("{}"))
        .otherwise(F.to_json(F.struct("data"))).alias("body"),
    )


@query(f"""
WITH {_RESPONSES},
ends AS (SELECT listing, min(page) AS last FROM responses WHERE status <> 200 OR empty
         GROUP BY listing)
SELECT listing, page, id::VARCHAR AS product_id FROM responses LEFT JOIN ends USING (listing)
WHERE last IS NULL OR page < last
""")
def listing_ids(spark, folder):
    return ingest.listing_ids(responses(spark, folder))


@query(r"""
WITH found AS (
  SELECT page_id, regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*"([^"]*)"', 1) AS hrefs
  FROM pages)
SELECT page_id, unnest(range(len(hrefs)))::INT AS position, unnest(hrefs) AS href FROM found
""")
def page_links(spark, folder):
    return ingest.links(table(spark, folder, "pages"))


@query("""
SELECT l_orderkey, l_linenumber, '/x-i.' || l_suppkey || '.' || l_partkey AS href,
       l_suppkey || '.' || l_partkey AS key, l_suppkey::VARCHAR AS shop_id,
       l_partkey::VARCHAR AS item_id
FROM lineitem WHERE l_returnflag <> 'A'
""")
def product_keys(spark, folder):
    key = F.concat(F.col("l_suppkey").cast("string"), F.lit("."),
                   F.col("l_partkey").cast("string"))
    hrefs = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "A", F.concat(F.lit("/x/"), key))
        .otherwise(F.concat(F.lit("/x-i."), key)).alias("href"),
    )
    return ingest.product_keys(hrefs)[0]


def _text_sql(expression: str) -> str:
    for reference, mark in (("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"),
                            ("&quot;", '"'), ("&amp;", "&")):
        expression = f"replace({expression}, '{reference}', '{mark}')"
    return f"nullif(trim({expression}), '')"


@query(f"""
SELECT page_id, {_text_sql("regexp_extract(html, '<h1>([^<]*)', 1)")} AS title,
  {_text_sql("regexp_extract(html, '<footer>([^<]*)', 1)")} AS store, NULL::VARCHAR AS price,
  array_to_string(list_filter(list_transform(
    regexp_extract_all(html, '<a [^>]*>([^<]*)', 1), lambda x: {_text_sql('x')}),
    lambda x: x IS NOT NULL), '|') AS categories,
  {_text_sql("regexp_extract(html, '<p>([^<]+)', 1)")} AS description,
  {_text_sql("regexp_extract(html, '<title>([^<]*)', 1)")} AS brand, '{{}}' AS attributes
FROM pages
""")
def page_records(spark, folder):
    records = html.page_records(table(spark, folder, "pages"), html.ARTICLE_LAYOUT)
    return records.withColumns({
        "attributes": F.to_json("attributes"), "categories": F.array_join("categories", "|")
    })
