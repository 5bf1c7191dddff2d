"""Product pages (HTML) to records.

Parsing a page is opaque to Spark, so each task parses its own pages; nothing is shared
between them and no page is cut.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.documents import merge_attributes

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
        "track", "wbr"}


@dataclass(frozen=True)
class Spot:
    """Text of ``tag`` inside an element of class ``inside`` (empty: anywhere).

    With a ``path``, ``inside`` names all classes of the element where the path starts; its
    steps are the tags of children down to ``tag``, each with its place among the siblings of
    that tag (0: any place).
    """

    tag: str
    inside: str = ""
    path: tuple[tuple[str, int], ...] = ()

    def meets(self, chain: tuple[tuple[str, int, frozenset[str]], ...]) -> bool:
        """Whether the innermost of these open elements is such a place."""
        if not self.path:
            return chain[-1][0] == self.tag and (
                not self.inside or any(self.inside in own for _, _, own in chain))
        steps, start = chain[-len(self.path):], chain[:-len(self.path)]
        return bool(start) and start[-1][2] == frozenset(self.inside.split()) and all(
            tag == want and place in (at, 0)
            for (tag, at, _), (want, place) in zip(steps, self.path))


@dataclass(frozen=True)
class PageLayout:
    """Where a site keeps the fields of a product.

    ``row`` is the class of the elements that pair a label with a text.
    """

    title: Spot
    store: Spot
    price: Spot
    category: Spot
    description: Spot
    brand: Spot
    row: str
    dropped: tuple[str, ...] = ()


# Class names and labels of the product pages this layout describes.
PRODUCT_LAYOUT = PageLayout(
    title=Spot("span", "qaNIZv"), store=Spot("div", "_3Lybjn"), price=Spot("div", "_3n5NQx"),
    category=Spot("a", "product-detail page-product__detail",
                  (("div", 1), ("div", 2), ("div", 0), ("div", 0), ("a", 0))),
    description=Spot("span", "product-detail page-product__detail",
                     (("div", 2), ("div", 2), ("div", 0), ("span", 0))),
    brand=Spot("a", "kIo6pj"), row="kIo6pj", dropped=("Danh Mục", "Thương hiệu"),
)
# Plain article pages: heading, menu links and first paragraph.
ARTICLE_LAYOUT = PageLayout(
    title=Spot("h1"), store=Spot("footer"), price=Spot("div", "price"), category=Spot("a"),
    description=Spot("p"), brand=Spot("title"), row="attribute",
)


class _Texts(HTMLParser):
    """Direct texts of elements as (open elements, text, row number).

    An open element is its tag, its place among the siblings of that tag, and its classes.
    """

    def __init__(self, row: str) -> None:
        super().__init__(convert_charrefs=True)
        self.row = row
        self.open: list[tuple[str, int, frozenset[str]]] = []
        self.numbers: list[int] = []
        self.children: list[Counter] = [Counter()]
        self.rows = 0
        self.texts: list[tuple[tuple[tuple[str, int, frozenset[str]], ...], str, int]] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.children[-1][tag] += 1
        if tag in VOID:
            return
        own = frozenset((dict(attrs).get("class") or "").split())
        number = self.numbers[-1] if self.numbers else 0
        if self.row in own:
            self.rows += 1
            number = self.rows
        self.open.append((tag, self.children[-1][tag], own))
        self.numbers.append(number)
        self.children.append(Counter())

    def handle_endtag(self, tag: str) -> None:
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == tag:
                del self.open[depth:], self.numbers[depth:], self.children[depth + 1:]
                return

    def handle_data(self, data: str) -> None:
        if self.open and data.strip():
            self.texts.append((tuple(self.open), data.strip(), self.numbers[-1]))


def read_page(html: str, layout: PageLayout) -> dict:
    parser = _Texts(layout.row)
    parser.feed(html or "")
    parser.close()

    def at(spot: Spot) -> list[str]:
        return [text for chain, text, _ in parser.texts if spot.meets(chain)]

    def first(spot: Spot) -> str | None:
        return next(iter(at(spot)), None)

    labels: dict[int, str] = {}
    values: dict[int, str] = {}
    for chain, text, number in parser.texts:
        tag = chain[-1][0]
        if number and tag == "label":
            labels.setdefault(number, text)
        elif number and tag == "div":
            values.setdefault(number, text)
    return {
        "title": first(layout.title), "store": first(layout.store),
        "price": first(layout.price), "categories": at(layout.category),
        "description": first(layout.description), "brand": first(layout.brand),
        "labels": [{"key": label, "value": values.get(number)}
                   for number, label in labels.items()],
    }


def page_records(
    pages: DataFrame, layout: PageLayout = PRODUCT_LAYOUT,
    id_col: str = "page_id", html: str = "html",
) -> DataFrame:
    """Pages to records of ``schemas.PAGE_RECORD``; labels become the attribute map."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            records = pd.DataFrame([read_page(page, layout) for page in batch["html"]])
            records.insert(0, "page_id", batch["page_id"].to_numpy())
            yield records

    read = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html).alias("html"))
    parsed = read.mapInPandas(
        run,
        "page_id long, title string, store string, price string, categories array<string>, "
        "description string, brand string, labels array<struct<key string, value string>>",
    )
    nothing = F.map_from_arrays(
        F.array().cast("array<string>"), F.array().cast("array<string>")
    )
    merged = parsed.withColumn(
        "attributes", merge_attributes(nothing, F.col("labels"), list(layout.dropped))
    )
    return merged.select(*[f.name for f in schemas.PAGE_RECORD.fields])


def full_content(records: DataFrame) -> DataFrame:
    """(page_id, content): the fixed fields as a map with the page's own labels laid over."""
    fixed = ["title", "store", "price", "description", "brand"]
    base = F.create_map(*[part for name in fixed for part in (F.lit(name), F.col(name))])
    labels = F.transform(
        F.map_entries("attributes"), lambda e: F.struct(e.key.alias("key"), e.value.alias("value"))
    )
    return records.select("page_id", merge_attributes(base, labels, []).alias("content"))
