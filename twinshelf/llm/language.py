"""Language identification by cross-parsing.

For each language a suffix automaton holds a sample of its labelled text. A text is parsed
against it into phrases: the longest match that the automaton knows, then the next one, and so
on. Text of the automaton's language needs few, long phrases. The number of phrases per byte is
divided by that of other labelled text of the same language, and the language with the least
quotient wins. A language with few texts learns that number by leaving texts out in turn.

Letters are compared as lower-case UTF-8, everything else in ASCII is one space. A text is
parsed in stretches of ``STRETCH`` bytes, whose phrases are added up, so that many stretches
advance together, one byte at a time, as an array of states.
"""

from __future__ import annotations

import re
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import by_parts, chunks, remembered, utf8

#: The fitted sample: different texts of each language, those with the least hashes, and the
#: characters read of them in all. A text gives its share from a place that its hash draws.
DOCUMENTS, CHARACTERS = 120, 40_000
#: Parts that a language's texts are dealt to, each being left out in turn or, from
#: ``FOLDS * FOLDS`` texts on, only the first.
FOLDS = 5
#: A language's own text has at most this share of the phrases that foreign text has.
FOREIGN = 0.9
STRETCH = 1024
#: How sharply quotients become scores, and the quotient from which no language fits.
SHARPNESS, MISFIT = 12.0, 2.5
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
_SPACED = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256))


def normal(text: str) -> bytes:
    """Lower-case letters and single spaces; empty if there is no letter."""
    if not _LETTER.search(text):
        return b""
    return b" %b " % b" ".join(text.lower().encode().translate(_SPACED).split())


class CrossParser:
    """The suffix automaton of a text as a table of moves.

    A move's entry holds the next state's row and, in its two low bits, how many phrases end:
    none if the match goes on, one if a new phrase starts with this byte, and one more if even
    the empty match cannot take it.
    """

    def __init__(self, text: bytes):
        symbols = sorted(set(text))
        self.classes = np.full(256, len(symbols), np.int32)
        self.classes[symbols] = np.arange(len(symbols))
        width = len(symbols) + 1  # the last column is for unknown bytes
        moves, link, length, last = [{}], [-1], [0], 0
        for symbol in self.classes[np.frombuffer(text, np.uint8)].tolist():
            moves.append({})
            link.append(0)
            length.append(length[last] + 1)
            made, at = len(moves) - 1, last
            while at >= 0 and symbol not in moves[at]:
                moves[at][symbol] = made
                at = link[at]
            if at >= 0:
                there = moves[at][symbol]
                if length[there] != length[at] + 1:
                    moves.append(dict(moves[there]))
                    link.append(link[there])
                    length.append(length[at] + 1)
                    copy = len(moves) - 1
                    while at >= 0 and moves[at].get(symbol) == there:
                        moves[at][symbol] = copy
                        at = link[at]
                    link[there] = copy
                    there = copy
                link[made] = there
            last = made
        fresh = np.full(width, 2, np.int32)  # from the root, behind a match
        for symbol, there in moves[0].items():
            fresh[symbol] = there * width << 2 | 1
        table = np.tile(fresh, (len(moves), 1))
        table[0][fresh == 2] = 1
        for state, own in enumerate(moves):
            for symbol, there in own.items():
                table[state, symbol] = there * width << 2
        self.table = table.ravel()

    def phrases(self, columns: list[np.ndarray], lanes: int) -> np.ndarray:
        """Phrases of each stretch; ``columns`` are the stretches' bytes by place, longest first."""
        state, count = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)
        for column in columns:
            n = len(column)
            entry = self.table[state[:n] + self.classes[column]]
            count[:n] += entry & 3
            state[:n] = entry >> 2
        return count + (state > 0)


def stretches(texts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    """Bytes by place over all stretches, longest stretch first, and each stretch's text."""
    parts = [(len(t[a:a + STRETCH]), owner, t[a:a + STRETCH])
             for owner, t in enumerate(texts) for a in range(0, len(t), STRETCH)]
    parts.sort(key=lambda x: -x[0])
    sizes = np.array([x[0] for x in parts])
    if not len(parts):
        return [], np.zeros(0, np.int64)
    grid = np.zeros((len(parts), sizes[0]), np.uint8)
    grid[np.arange(sizes[0]) < sizes[:, None]] = np.frombuffer(
        b"".join([x[2] for x in parts]), np.uint8)
    alive = len(parts) - np.searchsorted(sizes[::-1], np.arange(sizes[0]), side="right")
    by_place = np.ascontiguousarray(grid.T)
    return [by_place[i, :n] for i, n in enumerate(alive)], np.array([x[1] for x in parts])


def rates(parser: CrossParser, texts: list[bytes]) -> np.ndarray:
    """Phrases per byte of each text."""
    columns, owner = stretches(texts)
    found = np.bincount(owner, parser.phrases(columns, len(owner)), len(texts))
    return found / np.maximum(1, [len(t) for t in texts])


def left_out(texts: list[bytes]) -> list[tuple[bytes, bytes]]:
    """(learnt, held) pairs of a language's texts; a single text is cut in two."""
    if len(texts) == 1:
        words = texts[0].split()
        half = len(words) // 2
        texts = [b" %b " % b" ".join(w) for w in (words[:half], words[half:]) if w]
    folds = min(FOLDS, len(texts))
    used = 1 if len(texts) >= FOLDS * FOLDS else folds
    return [(b"".join(chain.from_iterable(texts[i::folds] for i in range(folds) if i != fold)),
             b"".join(texts[fold::folds])) for fold in range(used) if folds > 1]


class CrossParsingModel:
    """Sample text and usual rate of every language; automata are made where they are used.

    ``samples`` holds each language's different texts, dealt in the order given. The usual rate
    is that of texts that were left out. Foreign text bounds it: too few or too odd samples
    tell little of their language, and must not make it fit all others.
    """

    def __init__(self, samples: dict[str, list[str]]):
        self.languages, self.texts, usual, held_texts = [], [], [], []
        for language in sorted(samples):
            texts = [t for t in map(normal, samples[language]) if t]
            if not texts:
                continue
            pairs = left_out(texts)
            phrases = sum(rates(CrossParser(learnt), [held])[0] * len(held)
                          for learnt, held in pairs)
            self.languages.append(language)
            self.texts.append(pairs[0][0] if len(pairs) == 1 else b"".join(texts))
            usual.append(phrases / sum(len(held) for _, held in pairs) if pairs else np.inf)
            held_texts.append(pairs[0][1] if len(pairs) == 1 else b"".join(texts))
        self.usual = []
        for at, text in enumerate(self.texts):
            others = [t for i, t in enumerate(held_texts) if i != at]
            foreign = rates(CrossParser(text), others).min() if others else 1.0
            self.usual.append(max(min(usual[at], FOREIGN * foreign), 1e-3))

    def quotients(self, texts: list[bytes]) -> np.ndarray:
        """Phrases against the usual number, a column for each language."""
        parsers = remembered("language", "parsers", lambda: [CrossParser(t) for t in self.texts],
                             hash(tuple(self.texts)))
        out = np.zeros((len(texts), len(self.languages)))
        for part in chunks([len(t) for t in texts]):
            columns, owner = stretches(texts[part])
            sizes = np.maximum(1, [len(t) for t in texts[part]])
            for at, parser in enumerate(parsers):
                found = np.bincount(owner, parser.phrases(columns, len(owner)), len(sizes))
                out[part, at] = found / sizes / self.usual[at]
        return out

    def predict(self, texts: list[str]) -> list[tuple[str, float, float]]:
        """(language, score, quotient) of each text."""
        ready = [normal(t) for t in texts]
        out = [(UNKNOWN, 0.0, 0.0)] * len(texts)
        lettered = [i for i, t in enumerate(ready) if t]
        if self.languages and lettered:
            found = self.quotients([ready[i] for i in lettered])
            best = found.argmin(axis=1)
            least = found[np.arange(len(best)), best]
            score = 1 / np.exp(-SHARPNESS * (found - least[:, None])).sum(axis=1)
            for i, at, s, q in zip(lettered, best.tolist(), score.tolist(), least.tolist()):
                out[i] = (self.languages[at], s, q)
        return out


def fit(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
    documents: int = DOCUMENTS, characters: int = CHARACTERS,
) -> CrossParsingModel:
    """Fit on labelled rows; those without a text or a language are left out.

    At most ``documents`` different texts of a language are drawn, by hash, so repeated rows
    count once and the draw does not depend on the rows' order. They give ``characters`` in all:
    each the same number, from anywhere in the text, and a shorter one all it has. An empty
    table gives a model without languages.
    """
    labelled = docs.select(
        F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
    ).filter("text is not null and lang is not null").withColumn("hash", F.xxhash64("text"))
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(
        F.approx_count_distinct("hash").alias("n")).collect()}
    if not sizes:
        return CrossParsingModel({})
    # Twice the texts wanted, as their number is not exact; all of a small language.
    place = F.pmod("hash", F.lit(1 << 30)) / (1 << 30)
    drawn = reduce(lambda a, b: a | b, [
        (F.col("lang") == lang) & (place < 2 * documents / n) for lang, n in sizes.items()])
    share = reduce(lambda otherwise, lang: F.when(
        F.col("lang") == lang, -(-characters // min(documents, sizes[lang]))).otherwise(otherwise),
        sizes, F.lit(0)).cast("int")
    start = F.pmod(F.shiftright("hash", 30), F.greatest(F.lit(1), F.length("text") - share + 1))
    passages = labelled.filter(drawn).select(
        "lang", "hash", F.col("text").substr((start + 1).cast("int"), share).alias("text"))
    rows = passages.groupBy("lang", "hash").agg(F.min("text").alias("text")).collect()
    samples: dict[str, list[str]] = {lang: [] for lang in sizes}
    for row in sorted(rows, key=lambda r: (r["hash"] % (1 << 30), r["hash"])):
        if len(samples[row["lang"]]) < documents:
            samples[row["lang"]].append(row["text"])
    return CrossParsingModel(samples)


def predicted(spark, model: CrossParsingModel, text: str) -> Column:
    """struct(lang, score, quotient) of a text column.

    A null text or one without letters is ``und`` with score 0. Equal quotients go to the
    first language by name. Whole texts are parsed, however long, in parts of bounded size;
    repeated rows get equal results, an empty table none.
    """
    shared = spark.sparkContext.broadcast(model)
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("quotient", pa.float64())])

    @by_parts("struct<lang:string,score:double,quotient:double>")
    def run(part: pa.Array) -> pa.Array:
        found = shared.value.predict([t.decode() for t in utf8(part)])
        return pa.array([dict(zip(("lang", "score", "quotient"), x)) for x in found], kind)

    return run(F.col(text))


def identified(docs: DataFrame, model: CrossParsingModel, text_col: str = "text",
               misfit: float = MISFIT) -> DataFrame:
    """The rows of ``docs`` with letters that some learned language fits.

    Rejected are null texts, texts without letters, and texts whose best language needs
    ``misfit`` times its usual number of phrases. Repeated rows are judged alike, an empty table
    stays empty, and columns of any name are kept as they are.
    """
    mark = "_language"
    while mark in docs.columns:
        mark += "_"
    marked = docs.withColumn(mark, predicted(docs.sparkSession, model, text_col))
    kept = marked.filter((F.col(f"{mark}.lang") != UNKNOWN) & (F.col(f"{mark}.quotient") < misfit))
    return kept.select(docs.columns)
