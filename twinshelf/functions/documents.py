"""JSON helpers for raw documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The nested fields that a raw seller document may carry.
NESTED_FIELDS = [
    "badges", "inventory", "categories", "rating_summary", "brand", "seller_specifications",
    "current_seller", "other_sellers", "configurable_options", "configurable_products",
    "specifications", "product_links", "services_and_promotions", "promotions",
    "stock_item", "installment_info",
]


BROKEN = "_broken"


def parse(df: DataFrame, raw: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Parse one JSON document per row. Returns (documents, quarantined raw rows).

    Everything but the raw text is kept beside the document column ``doc``. Exploding the
    parsed document keeps Spark from copying the parse into every filter and field above it.
    """
    wide = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
    options = {"columnNameOfCorruptRecord": BROKEN, "mode": "PERMISSIVE"}
    parsed = df.select("*", F.explode(F.array(F.from_json(F.col(raw), wide, options)))
                       .alias("doc"))
    good = F.col("doc").isNotNull() & F.col(f"doc.{BROKEN}").isNull()
    return parsed.filter(good).drop(raw), parsed.filter(~good).drop("doc")


def usable_id(value: Column) -> Column:
    """True for an id that is neither missing, zero nor empty."""
    text = value.cast("string")
    return text.isNotNull() & ~text.isin("", "0")


def nested_as_text(df: DataFrame) -> DataFrame:
    """Nested fields of a document become JSON text, as a flat CSV sink needs them."""
    kinds = {field.name: field.dataType for field in df.schema.fields}
    return df.select(*[
        F.to_json(name).alias(name)
        if name in NESTED_FIELDS and isinstance(kind, (T.StructType, T.ArrayType, T.MapType))
        else F.col(name)
        for name, kind in kinds.items()
    ])


def merge_attributes(base: Column, labels: Column, dropped: list[str]) -> Column:
    """Label -> text entries, minus ``dropped``, laid over ``base``; the labels win.

    ``labels`` is an array of (key, value) structs in page order. A repeated label keeps its
    last text, which is also why no session setting on duplicate map keys is needed.
    """
    keys = F.array_distinct(F.filter(F.transform(labels, lambda e: e.key),
                                     lambda k: k.isNotNull() & ~k.isin(*dropped)))
    last = F.transform(
        keys,
        lambda k: F.struct(
            k.alias("key"),
            F.element_at(F.filter(labels, lambda e: e.key == k), -1).value.alias("value"),
        ),
    )
    kept = F.map_filter(base, lambda k, v: ~F.array_contains(keys, k))
    return F.map_concat(kept, F.map_from_entries(last))
