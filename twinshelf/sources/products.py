"""Raw product documents and listing responses to rows of the product table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.documents import parse, usable_id
from ..functions.text import shop_and_item, url_key, without
from ..operators.ordering import number_rows
from ..session import stage

# Least price of a current seller; parts of a price unit; mark to remove.
CURRENT_SELLER_ABOVE = 3_000_000
PRICE_PARTS = 1e5
MARK = "🎈🎈"

COMMON = [f.name for f in schemas.PRODUCT.fields if f.name != "id"]


def whole(name: str) -> Column:
    """An id or price as a whole number; null if it is none."""
    return F.col(name).try_cast("long")


def responses_ok(responses: DataFrame, status: str = "status") -> DataFrame:
    return responses.filter(F.col(status) == 200)


def seller_rows(
    documents: DataFrame, vendor: str, above: int = CURRENT_SELLER_ABOVE,
) -> tuple[DataFrame, DataFrame]:
    """Seller documents (``raw``) to (product rows, quarantined lines).

    One row per other seller, and one for the current seller if its price exceeds ``above``.
    Documents without a usable id give no rows.
    """
    good, bad = parse(documents, "raw", schemas.SELLER_DOCUMENT)
    base = good.filter(usable_id(F.col("doc.id")))
    shared = [
        F.col("doc.sku").alias("sku"), F.col("doc.name").alias("name"),
        F.col("doc.url_key").alias("url_key"), F.col("doc.url_path").alias("url_path"),
        F.lit(vendor).alias("sales_page"), F.col("doc.short_description").alias("short_desc"),
        F.col("doc.categories.name").alias("category"), F.col("doc.brand.name").alias("brand"),
    ]
    sold = [
        whole("seller.product_id").alias("pid"), whole("seller.price").alias("price"),
        whole("seller.store_id").alias("store_id"), F.col("seller.name").alias("store_name"),
    ]
    none = F.array().cast(schemas.SELLER_DOCUMENT["other_sellers"].dataType)
    current = F.when(F.col("doc.current_seller.price") > above,
                     F.array("doc.current_seller")).otherwise(none)
    sellers = F.concat(F.coalesce("doc.other_sellers", none), current)
    rows = base.withColumn("seller", F.explode(sellers)).filter(F.col("seller").isNotNull())
    return rows.select(*shared, *sold).select(*COMMON), bad


def shop_rows(documents: DataFrame, vendor: str) -> tuple[DataFrame, DataFrame]:
    """Shop documents (``raw``) to (product rows, quarantined lines) under the common names."""
    good, bad = parse(documents, "raw", schemas.SHOP_DOCUMENT)
    doc = F.col("doc")
    rows = good.filter(usable_id(doc.id)).select(
        whole("doc.id").alias("pid"), doc.sku.alias("sku"), doc.getField("name").alias("name"),
        doc.url_key.alias("url_key"), doc.cat_path.alias("url_path"),
        F.lit(vendor).alias("sales_page"),
        without(doc.short_description, MARK).alias("short_desc"),
        whole("doc.price").alias("price"),
        F.when(doc.categories.isNotNull(), doc.categories.category_level1_name)
        .otherwise(doc.category).alias("category"),
        doc.brand_name.alias("brand"),
        whole("doc.shop_info.shop_id").alias("store_id"), doc.shop_info.shop_name.alias("store_name"),
    )
    return rows.select(*COMMON), bad


def item_rows(
    documents: DataFrame, vendor: str, site: str, keep: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Item documents (``raw``, ``url_key``) to rows of the listed-product table."""
    good, bad = parse(documents, "raw", schemas.ITEM_DOCUMENT)
    item = F.col("doc.item")
    key = F.col("url_key") if "url_key" in documents.columns else F.lit(None).cast("string")
    rows = good.filter(item.isNotNull()).select(
        *keep, whole("doc.item.itemid").alias("product_id"), item.getField("name").alias("product_title"),
        key.alias("url_key"), F.concat(F.lit(site), key).alias("url_path"),
        F.lit(vendor).alias("vendor"), item.description.alias("short_desc"),
        (item.price / PRICE_PARTS).alias("price"),
    )
    return rows, bad


def listing_ids(responses: DataFrame, listing: str = "listing", page: str = "page") -> DataFrame:
    """(listing, page, product_id) of stored listing responses (listing, page, status, body).

    A listing is read page by page until the first one that failed, does not parse or holds no
    products; later pages do not count.
    """
    body = F.from_json("body", schemas.LISTING)
    read = responses.select(listing, page, "status", body.data.alias("data"))
    ended = (F.col("status") != 200) | F.col("status").isNull() | (
        F.coalesce(F.size("data"), F.lit(0)) <= 0
    )
    ends = read.filter(ended).groupBy(listing).agg(F.min(page).alias("_end"))
    return (
        read.join(ends, listing, "left")
        .filter(F.col("_end").isNull() | (F.col(page) < F.col("_end")))
        .select(listing, page, F.explode("data").alias("entry"))
        .select(listing, page, F.col("entry.id").alias("product_id"))
    )


def links(pages: DataFrame, id_col: str = "page_id", html: str = "html") -> DataFrame:
    """(id, position, href) of every anchor with an address, in page order.

    Addresses may be in either quotes or in none; character references in them are decoded.
    Anchors in comments and scripts are no anchors.
    """
    live = F.regexp_replace(F.col(html), r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", "")
    found = F.regexp_extract_all(live, F.lit(ANCHOR), 1)
    return pages.select(id_col, F.posexplode(found).alias("position", "href")).withColumn(
        "href", unquoted(F.col("href"))
    )


ANCHOR = (r"""(?is)<a(?=\s)(?:\s+(?!href\s*=)[^\s=>"']+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]*))?)*"""
          r"""\s+href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
# The character references that addresses hold, the ampersand last.
REFERENCES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#34;", '"'), ("&#39;", "'"),
              ("&apos;", "'"), ("&#38;", "&"), ("&amp;", "&")]


def unquoted(value: Column) -> Column:
    out = F.regexp_replace(value, r"""^["']|["']$""", "")
    for reference, mark in REFERENCES:
        out = F.replace(out, F.lit(reference), F.lit(mark))
    return out


def product_keys(hrefs: DataFrame, href: str = "href") -> tuple[DataFrame, DataFrame]:
    """(links with key, shop_id and item_id; links without a product key)."""
    keyed = hrefs.withColumn("key", url_key(F.col(href)))
    parts = shop_and_item(F.col("key"))
    good = keyed.filter("key IS NOT NULL").select("*", parts.alias("_k")).select(
        *keyed.columns, "_k.shop_id", "_k.item_id"
    )
    return good, keyed.filter("key IS NULL").drop("key")


def numbered(rows: DataFrame, keys: list[str], name: str = "id") -> DataFrame:
    """Assign sequence numbers in the order of unique non-null ``keys``."""
    return number_rows(rows, keys, name)


def union_products(*tables: DataFrame) -> DataFrame:
    """Several vendors' rows under the common columns; what a vendor lacks is null."""
    whole = None
    for table in tables:
        whole = table if whole is None else whole.unionByName(table, allowMissingColumns=True)
    return whole


def priced(rows: DataFrame, floor: int | None = None, ceiling: int | None = None,
           category: str | None = None, brand: str | None = None) -> DataFrame:
    """The selections the sources offer: price range, category, brand; dearest first.

    What is selected is written before it is sorted, as a sort reads its input twice.
    """
    price: Column = F.col("price")
    if floor is not None:
        rows = rows.filter(price >= floor)
    if ceiling is not None:
        rows = rows.filter(price <= ceiling)
    if category is not None:
        rows = rows.filter(F.col("category") == category)
    if brand is not None:
        rows = rows.filter(F.col("brand") == brand)
    return stage(rows, "priced").orderBy(price.desc_nulls_last(), "pid")
