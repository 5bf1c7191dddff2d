"""Benchmark decontamination with a generalised suffix automaton of the test items.

Texts become words: runs of ASCII letters and digits, lower-cased, and of all characters
beyond ASCII. A window is ``WINDOW`` consecutive words of an item, or the whole item if it is
shorter. Each document's words stream through the automaton, which keeps the longest match
that ends at the current word; a window ends there when that match is at least as long.

The items are dealt to automata of about ``SHARD_WORDS`` words, so that what is broadcast has
a bound however many items there are; every document meets all of them.

Only stretches in which each pair of neighbouring words also occurs in the items can hold a
window, so the stream is cut to these stretches first, which loses nothing.
"""

from __future__ import annotations

import pickle
import re
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .batches import by_parts, chunks, utf8

WINDOW = 10
#: A document goes as a whole when at least this share of its words is hit.
COVERAGE = 0.5
SHARD_WORDS = 500_000
PAIR_SLOTS = 1 << 22

_WORD = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACED = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.lower().translate(_SPACED).split()


class ItemAutomaton:
    """Suffix automaton of several word sequences; no match runs across two of them."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window, self.vocabulary = window, {}
        self.next, self.link, self.length = [{}], [-1], [0]
        coded = []
        pairs = set()
        for item, words in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            if ids:
                coded.append((item, ids))
                pairs.update(zip(ids, ids[1:]))
                last = 0
                for word in ids:
                    last = self._extend(last, word)
        self.shortest = min((len(ids) for _, ids in coded), default=1)
        self.shortest = min(self.shortest, window)
        self.pairs = np.zeros(PAIR_SLOTS, bool)
        if pairs:
            left, right = np.array(sorted(pairs), np.int64).T
            self.pairs[self._slot(left, right)] = True
        # The windows that end in a state: items by window length.
        self.ending: dict[int, dict[int, set[str]]] = {}
        for item, ids in coded:
            size, state = min(len(ids), window), 0
            for at, word in enumerate(ids):
                state = self.next[state][word]
                if at + 1 >= size:
                    top = self._state_of(state, size)
                    self.ending.setdefault(top, {}).setdefault(size, set()).add(item)
        self._above: dict[int, list[tuple[int, int, frozenset[str]]]] = {}

    @staticmethod
    def _slot(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left * 1_000_003 + right) & (PAIR_SLOTS - 1)

    def _state_of(self, state: int, size: int) -> int:
        """The state of the last ``size`` words of what leads to ``state``."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def _copy(self, of: int, length: int, last: int, word: int) -> int:
        """Split a state: its strings up to ``length`` words get a state of their own."""
        self.next.append(dict(self.next[of]))
        self.link.append(self.link[of])
        self.length.append(length)
        made = len(self.next) - 1
        while last >= 0 and self.next[last].get(word) == of:
            self.next[last][word] = made
            last = self.link[last]
        self.link[of] = made
        return made

    def _extend(self, last: int, word: int) -> int:
        there = self.next[last].get(word)
        if there is not None:
            if self.length[there] == self.length[last] + 1:
                return there
            return self._copy(there, self.length[last] + 1, last, word)
        self.next.append({})
        self.link.append(0)
        self.length.append(self.length[last] + 1)
        made = len(self.next) - 1
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = made
            last = self.link[last]
        if last >= 0:
            there = self.next[last][word]
            self.link[made] = (
                there if self.length[there] == self.length[last] + 1
                else self._copy(there, self.length[last] + 1, last, word))
        return made

    def above(self, state: int) -> list[tuple[int, int, frozenset[str]]]:
        """(length, size, items) of windows ending in a state or one of its suffixes."""
        if state not in self._above:
            found, at, full = [], state, self.length[state]
            while at > 0:
                found += [(full if at == state else 0, size, frozenset(items))
                          for size, items in self.ending.get(at, {}).items()]
                at = self.link[at]
            self._above[state] = found
        return self._above[state]

    def stretches(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Places [a, b) whose neighbouring words are neighbours in some item as well."""
        known = ids > 0
        joined = known[:-1] & known[1:] & self.pairs[self._slot(ids[:-1], ids[1:])]
        step = np.diff(np.concatenate(([False], joined, [False])).astype(np.int8))
        begin, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1) + 1
        keep = end - begin >= self.shortest
        found = list(zip(begin[keep].tolist(), end[keep].tolist()))
        if self.shortest == 1:  # single words outside the stretches
            alone = known.copy()
            alone[:-1] &= ~joined
            alone[1:] &= ~joined
            found += [(a, a + 1) for a in np.flatnonzero(alone).tolist()]
        return found

    def spans(self, ids: np.ndarray) -> list[tuple[int, int, frozenset[str]]]:
        """(first place, end, items) of every window in the stream."""
        out = []
        for begin, end in self.stretches(ids):
            state = length = 0
            for place, word in enumerate(ids[begin:end].tolist(), begin + 1):
                while state and word not in self.next[state]:
                    state = self.link[state]
                    length = self.length[state]
                if word in self.next[state]:
                    state, length = self.next[state][word], length + 1
                if length >= self.shortest:
                    out += [(place - size, place, items)
                            for _, size, items in self.above(state) if size <= length]
        return out


def automata(items: DataFrame, id_col: str, text_col: str, window: int,
             shard_words: int = SHARD_WORDS) -> list:
    """Broadcast automata, each of about ``shard_words`` words of items."""
    spark = items.sparkSession
    rows = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = -(-total // (5 * shard_words)) or 1

    def build(part: pd.DataFrame) -> pd.DataFrame:
        made = ItemAutomaton(
            [(i, words_of(t.encode())) for i, t in zip(part["item"], part["text"])], window)
        return pd.DataFrame({"automaton": [pickle.dumps(vars(made))]})

    built = stage(
        rows.filter("text is not null")
        .groupBy(F.pmod(F.xxhash64("item", "text"), F.lit(shards)).alias("shard"))
        .applyInPandas(build, "automaton binary"), "automata")
    return [spark.sparkContext.broadcast(bytes(row[0])) for row in built.toLocalIterator()]


class Scanner:
    """Finds the windows of all broadcast automata in texts."""

    def __init__(self, shared: list):
        self.shared, self._made = shared, {}

    def __getstate__(self) -> dict:
        return {"shared": self.shared, "_made": {}}

    def _automaton(self, at: int) -> ItemAutomaton:
        if at not in self._made:
            machine = ItemAutomaton([])
            vars(machine).update(pickle.loads(self.shared[at].value))
            self._made = {at: machine}  # one at a time in memory
        return self._made[at]

    def scan(self, texts: list[bytes]) -> list[tuple[int, np.ndarray, set[str]]]:
        """For each text: its number of words, which of them are hit, and the items."""
        out = []
        for part in chunks([len(x) for x in texts]):
            found = [words_of(x) for x in texts[part]]
            sizes = np.array([len(w) for w in found])
            begin = np.cumsum(sizes + 1) - sizes  # a gap before each text
            hit = np.zeros(int((sizes + 1).sum()) + 1, bool)
            items: list[set[str]] = [set() for _ in found]
            for at in range(len(self.shared)):
                machine = self._automaton(at)
                ids = np.zeros(len(hit), np.int64)
                for first, words in zip(begin.tolist(), found):
                    ids[first:first + len(words)] = np.fromiter(
                        map(machine.vocabulary.get, words, repeat(0)), np.int64, len(words))
                for a, b, names in machine.spans(ids):
                    hit[a:b] = True
                    items[int(np.searchsorted(begin, a, "right")) - 1] |= names
            out += [(int(n), hit[a:a + n], names)
                    for n, a, names in zip(sizes.tolist(), begin.tolist(), items)]
        return out


def matches(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """(id, n_words, n_hit, items): words inside windows, and the sorted ids of the items.

    A null or empty text has no words. Items whose text is null or empty are left out; items of
    equal text all count. The windows of an item without an id are hit as well, though it
    has no id to be listed by. Repeated documents each keep their row, and whole texts are
    searched, however long. Without items nothing is hit; no documents give no rows.
    """
    scanner = Scanner(automata(items, item_col, item_text, window))
    kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()),
                      ("items", pa.list_(pa.string()))])

    @by_parts("struct<n_words:long,n_hit:long,items:array<string>>")
    def look(part: pa.Array) -> pa.Array:
        return pa.array([
            {"n_words": n, "n_hit": int(hit.sum()), "items": sorted(names - {None})}
            for n, hit, names in scanner.scan(utf8(part))], kind)

    return docs.select(F.col(id_col).alias("id"), look(F.col(text_col)).alias("found")).select(
        "id", "found.*")


def cleaned(text: bytes, hit: np.ndarray, coverage: float) -> bytes | None:
    """The text without its hit words and what stands between them; None if too little stays."""
    if hit.sum() >= coverage * len(hit):
        return None
    keep, at, cut = [], 0, False
    for place, word in enumerate(re.finditer(_WORD, text.lower())):
        if hit[place] and not cut:
            keep.append(text[at:word.start()])
        if not hit[place] and cut:
            at = word.start()
        cut = bool(hit[place])
        if cut:
            at = word.end()
    keep.append(text[at:])
    return b"".join(keep)


def decontaminate(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text", window: int = WINDOW, coverage: float = COVERAGE,
) -> DataFrame:
    """``docs`` without the benchmark's windows.

    Spans of hit words are cut out of a text. A document of which at least ``coverage`` of the
    words is hit goes as a whole. All other rows, also null and empty ones, stay as they are.
    """
    scanner = Scanner(automata(items, item_col, item_text, window))
    kind = pa.struct([("drop", pa.bool_()), ("text", pa.string())])

    @by_parts("struct<drop:boolean,text:string>")
    def clean(part: pa.Array) -> pa.Array:
        out, texts = [], utf8(part)
        for text, (_, hit, _) in zip(texts, scanner.scan(texts)):
            kept = cleaned(text, hit, coverage) if hit.any() else None
            out.append({"drop": bool(hit.any()) and kept is None,
                        "text": None if kept is None else kept.decode()})
        return pa.array(out, kind)

    mark = "_clean"
    while mark in docs.columns:
        mark += "_"
    marked = docs.withColumn(mark, clean(F.col(text_col))).filter(~F.col(f"{mark}.drop"))
    return marked.withColumn(text_col, F.coalesce(f"{mark}.text", text_col)).select(docs.columns)
