"""Declared schemas (one per source) and the common product table they are mapped to."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_LONG, _INT, _TEXT, _DOUBLE = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType()

# Labelled product file: titles with the cluster and category they are known to belong to.
LABELLED_PRODUCT = _struct(
    product_id=_LONG, product_title=_TEXT, vendor_id=_INT, cluster_id=_INT,
    cluster_label=_TEXT, category_id=_INT, category_label=_TEXT,
)

# Common vendor table. ``id`` is assigned on load.
PRODUCT = _struct(
    id=_LONG, pid=_LONG, sku=_TEXT, name=_TEXT, url_key=_TEXT, url_path=_TEXT,
    sales_page=_TEXT, short_desc=_TEXT, price=_LONG, category=_TEXT, brand=_TEXT,
    store_id=_LONG, store_name=_TEXT,
)

# Smaller vendor table of the listing-key vendor.
LISTED_PRODUCT = _struct(
    id=_LONG, product_id=_LONG, sku=_TEXT, product_title=_TEXT, url_key=_TEXT,
    url_path=_TEXT, vendor=_TEXT, short_desc=_TEXT, price=_LONG,
)

# Ids of raw documents are read as text and prices as numbers of any kind, since one odd value
# must not cost the whole document; they are cast when rows are made of them.
_SELLER = _struct(product_id=_TEXT, price=_DOUBLE, store_id=_TEXT, name=_TEXT)

# Document of a marketplace where one product has several sellers.
SELLER_DOCUMENT = _struct(
    id=_TEXT, sku=_TEXT, name=_TEXT, url_key=_TEXT, url_path=_TEXT, short_description=_TEXT,
    categories=_struct(name=_TEXT), brand=_struct(name=_TEXT),
    other_sellers=T.ArrayType(_SELLER), current_seller=_SELLER,
)

# Document of a marketplace where a product belongs to one shop.
SHOP_DOCUMENT = _struct(
    id=_TEXT, sku=_TEXT, name=_TEXT, url_key=_TEXT, cat_path=_TEXT, short_description=_TEXT,
    price=_DOUBLE, brand_name=_TEXT, categories=_struct(category_level1_name=_TEXT),
    category=_TEXT, shop_info=_struct(shop_id=_TEXT, shop_name=_TEXT),
)

# Document whose price is given in units of 1/100000.
ITEM_DOCUMENT = _struct(
    item=_struct(itemid=_TEXT, name=_TEXT, price=_DOUBLE, description=_TEXT),
)

LISTING = _struct(data=T.ArrayType(_struct(id=_TEXT)))

# What one product page yields (see sources.pages).
PAGE_RECORD = T.StructType([
    T.StructField("page_id", _LONG),
    T.StructField("title", _TEXT),
    T.StructField("store", _TEXT),
    T.StructField("price", _TEXT),
    T.StructField("categories", T.ArrayType(_TEXT)),
    T.StructField("description", _TEXT),
    T.StructField("brand", _TEXT),
    T.StructField("attributes", T.MapType(_TEXT, _TEXT)),
])

LINKAGE_LEFT = _struct(**{
    "Account_Num": _LONG, "Facility Name": _TEXT, "Address": _TEXT, "City": _TEXT,
    "State": _TEXT,
})
LINKAGE_RIGHT = _struct(**{
    "Provider_Num": _LONG, "Provider Name": _TEXT, "Provider Street Address": _TEXT,
    "Provider City": _TEXT, "Provider State": _TEXT,
})
