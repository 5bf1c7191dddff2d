"""Title normalising, tokenising, stop words and n-grams, all as JVM column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's \W is ASCII only and would cut accented words apart.
NON_WORD = r"[^\p{L}\p{N}_]"

# The stop words of the two title flows.
TITLE_STOP_WORDS = ["hàng", "nhập", "khẩu", "chính", "hãng", "sale", "model", "rẻ"]
CATALOGUE_STOP_WORDS = [
    "freeship", "hàng", "nhập", "khẩu", "chính", "hãng", "sale", "model", "rẻ",
]
# The optional colour and phone-offer lists.
COLOUR_STOP_WORDS = ["black", "white", "grey", "silver", "gold", "rose"]
OFFER_STOP_WORDS = [
    "unlocked", "sim", "free", "4g", "in", "black", "white", "grey", "silver", "blue",
    "gold", "rose", "pink",
]


def clean(text: Column) -> Column:
    """Every character that is neither letter, digit nor underscore becomes a space."""
    return F.regexp_replace(text, NON_WORD, " ")


def join_unit(text: Column, *units: str) -> Column:
    """``64 gb`` -> ``64gb``: the one space between a digit and a lower-case unit goes."""
    return F.regexp_replace(text, rf"(?<=\p{{Nd}}) (?={'|'.join(units)})", "")


def tidy_title(text: Column) -> Column:
    """Clean, then join kilograms, centimetres and gigabytes, case as it stands.

    One unit never uncovers another, so a single pass does what one pass per unit does.
    """
    return join_unit(clean(text), "kg", "cm", "gb")


def split_digits(text: Column) -> Column:
    """``8gb`` -> ``8 gb``."""
    return F.regexp_replace(text, "([0-9])([A-Za-z])", "$1 $2")


def space_tokens(text: Column) -> Column:
    """Lower-case and split on each single space; a double space leaves an empty token."""
    return F.split(F.lower(text), " ")


def word_tokens(text: Column) -> Column:
    """Lower-case words of a cleaned text, no empty tokens."""
    return F.filter(F.split(F.lower(text), r"\s+"), lambda word: word != "")


def whole_token(text: Column) -> Column:
    return F.array(F.lower(text))


def drop_words(tokens: Column, stop: Sequence[str]) -> Column:
    """Remove stop words and keep repeats of the others."""
    return F.filter(tokens, lambda word: ~word.isin(*stop)) if stop else tokens


def lettered(tokens: Column) -> Column:
    """Keep the tokens that hold at least one Latin letter."""
    return F.filter(tokens, lambda word: word.rlike("[a-zA-Z]"))


def ngrams(tokens: Column, sizes: tuple[int, int]) -> Column:
    """Word n-grams of every size from ``sizes[0]`` to ``sizes[1]``, pooled."""
    none = F.array().cast("array<string>")

    def grams(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.size(tokens) - (n - 1))
        joined = F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, n), " "))
        return F.when(F.size(tokens) >= n, joined).otherwise(none)

    parts = [tokens if n == 1 else grams(n) for n in range(sizes[0], sizes[1] + 1)]
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def without(text: Column, literal: str) -> Column:
    """Remove every occurrence of a literal substring; null stays null."""
    return F.replace(text, F.lit(literal), F.lit(""))


def lookup_text(*fields: Column) -> Column:
    """Fields joined by ``_`` for reading side by side; missing fields are left out."""
    return F.concat_ws("_", *fields)


def url_key(url: Column) -> Column:
    """Text after the last ``-i.``; null where the mark is absent."""
    return F.when(url.contains("-i."), F.substring_index(url, "-i.", -1))


def shop_and_item(key: Column) -> Column:
    """Split a ``shop.item`` key into a struct; a key with one part has a null item."""
    parts = F.split(key, r"\.")
    return F.struct(F.get(parts, 0).alias("shop_id"), F.get(parts, 1).alias("item_id"))


def html_key(url: Column) -> Column:
    """Older link form: the digits between ``-p`` and ``.html``."""
    found = F.regexp_extract(url, r"-p(\d+)\.html", 1)
    return F.when(found != "", found)
