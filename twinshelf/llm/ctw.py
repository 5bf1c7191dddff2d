"""Language-model scoring by context-tree weighting over bytes.

Each byte is eight binary decisions, from the highest bit down, and each decision has a context
tree of its own: its nodes are the bytes before, from none to ``DEPTH`` of them. A node holds
how often either bit followed in the training texts and estimates the next one by Krichevsky
and Trofimov's rule. A node's weighted probability is the mean of its own estimate of what it
saw and the product of its children's weighted ones. After training, the share of a node's own
estimate in that mean is its weight, and a text's probability is the product, over its bytes
and bits, of the estimates along the path from the root to depth ``DEPTH``, mixed by these
weights. Texts are compared without upper-case A-Z and end with a byte that UTF-8 never has.

The counts cover all training texts and live in a distributed table; no task or driver holds
the model. Texts are packed into blocks. A block asks for its different byte strings of
``DEPTH`` + 1 bytes, with its training counts, in rows dealt by the last two bytes of the
context. Whoever holds such a share sums the counts of all blocks, builds the trees below
these two bytes and answers with the probabilities. What lies above is two small tables of
256 x 256 nodes at most. Words for the baseline are counted and answered on the same way.
"""

from __future__ import annotations

import pickle
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import new_path, stage
from .batches import chunks, utf8

DEPTH = 5
#: Bytes of text in a block, and blocks for which there is one more share of the model.
BLOCK, SPREAD = 4 << 20, 4
LEAST_SHARES = 24
END = b"\xff"
LN2 = np.log(2.0)


def packed(value: object) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(value))


def unpacked(blob: bytes) -> object:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(bytes(blob)))


def planes(values: np.ndarray) -> np.ndarray:
    """Numbers as bytes of equal weight side by side, which compress well."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)


def from_planes(found: np.ndarray, kind: str) -> np.ndarray:
    return np.ascontiguousarray(found.T).view(kind).ravel()


def strings(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes, first places): for each byte, its context and itself as one number.

    The byte just before is highest, then the one before that, down to the byte itself.
    """
    pad = bytes(depth)
    line = np.frombuffer(b"".join([pad + t + END for t in texts]), np.uint8).astype(np.uint64)
    sizes = np.array([len(t) + 1 for t in texts])
    starts = np.cumsum(sizes + depth) - sizes - depth
    code = line.copy()
    for back in range(1, depth + 1):
        code[back:] |= line[:-back] << np.uint64(8 * (depth + 1 - back))
    keep = np.ones(len(line), bool)
    for at in range(depth):
        keep[starts + at] = False
    return code[keep], np.cumsum(sizes) - sizes


def share_of(codes: np.ndarray, depth: int, shares: int) -> np.ndarray:
    """Which share of the model holds a string: by the two bytes before the last."""
    near = (codes >> np.uint64(8 * (depth - 1))).astype(np.int64)
    return (near * 40_503 >> 4) % shares


def counted(codes: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different codes in order, and how often each occurs in training texts."""
    both = np.sort(codes << np.uint64(1) | train)
    first = np.flatnonzero(np.concatenate(([True], both[1:] >> np.uint64(1) != both[:-1] >> np.uint64(1))))
    sums = np.add.reduceat((both & np.uint64(1)).astype(np.int64), first)
    return both[first] >> np.uint64(1), sums


def block_words(texts: list[bytes]) -> list[list[bytes]]:
    return [t.split() for t in texts]


def requests(texts: list[bytes], held: np.ndarray, depth: int, shares: int) -> Iterator[tuple[int, bytes]]:
    """(share, what the block asks and counts there)."""
    codes, starts = strings(texts, depth)
    train = np.repeat((~held).astype(np.uint64), np.diff(np.append(starts, len(codes))))
    codes, sums = counted(codes, train)
    share = share_of(codes, depth, shares)
    order = np.argsort(share, kind="stable")
    codes, sums, share = codes[order], sums[order], share[order]
    cuts = np.searchsorted(share, np.arange(shares + 1))
    seen, words = Counter(), block_words(texts)
    for out, line in zip(held.tolist(), words):
        seen.update(dict.fromkeys(line, 0) if out else line)
    for line in (x for out, x in zip(held.tolist(), words) if out):
        for word in line:
            seen.setdefault(word, 0)
    by_share: list[list[bytes]] = [[] for _ in range(shares)]
    for word in sorted(seen):
        by_share[zlib.crc32(word) % shares].append(word)
    for at in range(shares):
        a, z = cuts[at], cuts[at + 1]
        if z > a or by_share[at]:
            yield at, packed((planes(codes[a:z]), planes(sums[a:z].astype(np.uint32)),
                              b" ".join(by_share[at]),
                              planes(np.array([seen[w] for w in by_share[at]], np.uint32))))


_TABLE = 1 << 16


class LogGamma:
    """ln of the gamma function at n + 1/2 and n + 1 for whole n."""

    def __init__(self):
        n = np.arange(1, _TABLE)
        self.half = np.concatenate(([0.0], np.cumsum(np.log(n - 0.5)))) + 0.5 * np.log(np.pi)
        self.one = np.concatenate(([0.0], np.cumsum(np.log(n))))

    @staticmethod
    def _far(z: np.ndarray) -> np.ndarray:
        return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + 1 / (12 * z) - 1 / (360 * z ** 3)

    def _at(self, table: np.ndarray, n: np.ndarray, plus: float) -> np.ndarray:
        near = table[np.minimum(n, _TABLE - 1).astype(np.int64)]
        return np.where(n < _TABLE, near, self._far(np.maximum(n, 1) + plus))

    def estimate(self, zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
        """ln of the Krichevsky-Trofimov probability of a sequence with these counts."""
        return (self._at(self.half, zeros, 0.5) + self._at(self.half, ones, 0.5)
                - self._at(self.one, zeros + ones, 1.0) - np.log(np.pi))


@dataclass
class Level:
    """One depth: different (context, byte) entries, and their nodes bit by bit."""

    keys: np.ndarray     # context and byte
    counts: np.ndarray
    above: np.ndarray    # each entry's entry one depth higher
    nodes: list          # by bit: (each entry's node, first entry, n, ones, ln weighted, weight)


def node_numbers(keys: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray]:
    """Each entry's node for one bit, and the nodes' first entries; keys are in order."""
    prefix = keys >> np.uint64(8 - bit)
    new = np.concatenate(([True], prefix[1:] != prefix[:-1]))
    return np.cumsum(new) - 1, np.flatnonzero(new)


def bits(keys: np.ndarray, bit: int) -> np.ndarray:
    return (keys >> np.uint64(7 - bit) & np.uint64(1)).astype(np.int64)


def grow(codes: np.ndarray, counts: np.ndarray, depth: int, top: int) -> list[Level]:
    """Levels ``depth`` down to ``top`` of the trees over the given strings, in that order."""
    gamma, levels = LogGamma(), []
    keys, sums = codes, counts.astype(np.float64)
    for at in range(depth, top - 1, -1):
        level = Level(keys, sums, np.zeros(0, np.int64), [])
        for bit in range(8):
            node, first = node_numbers(keys, bit)
            total = np.bincount(node, sums, len(first))
            ones = np.bincount(node, sums * bits(keys, bit), len(first))
            own = gamma.estimate(total - ones, ones)
            if levels:
                below = levels[-1]
                _, b_first, _, _, b_weighted, _ = below.nodes[bit]
                parent = node[below.above[b_first]]
                product = np.bincount(parent, b_weighted, len(first))
                weighted = np.logaddexp(own - LN2, product - LN2)
                weight = np.exp(own - LN2 - weighted)
            else:
                weighted, weight = own, np.ones(len(first))
            level.nodes.append((node, first, total, ones, weighted, weight))
        levels.append(level)
        if at > top:
            # Entries are (c1 ... c_at, byte); the next level drops c_at, the byte stays.
            higher = (keys >> np.uint64(16)) << np.uint64(8) | keys & np.uint64(255)
            upper, level.above = np.unique(higher, return_inverse=True)
            sums = np.bincount(level.above, sums, len(upper))
            keys = upper
    return levels


def mixed(levels: list[Level]) -> np.ndarray:
    """(entries of the deepest level, 8): the probability of each bit, mixed up to the top level."""
    deepest = levels[0]
    out = np.zeros((len(deepest.keys), 8))
    for bit in range(8):
        one = bits(deepest.keys, bit).astype(bool)
        at = np.arange(len(deepest.keys))
        q = np.full(len(at), 0.5)
        for level in levels:
            node, _, total, ones, _, weight = level.nodes[bit]
            here = node[at]
            hits = np.where(one, ones[here], total[here] - ones[here])
            q = weight[here] * (hits + 0.5) / (total[here] + 1) + (1 - weight[here]) * q
            if len(level.above):
                at = level.above[at]
        out[:, bit] = q
    return out


def near_nodes(levels: list[Level]) -> pd.DataFrame:
    """Counts, and products of weighted probabilities, of the nodes below one byte of context.

    ``levels`` end with contexts of two bytes; rows are by the nearer byte and the node, which
    is numbered 1, 2-3, 4-7 and so on by its bits.
    """
    level, parts = levels[-1], []
    for bit in range(8):
        _, first, total, ones, weighted, _ = level.nodes[bit]
        keys = level.keys[first].astype(np.int64)
        parts.append(pd.DataFrame({
            "byte": keys >> 16, "node": (1 << bit) | (keys & 255) >> (8 - bit),
            "n": total, "ones": ones, "product": weighted}))
    return pd.concat(parts).groupby(["byte", "node"], as_index=False).sum()


class TopTables:
    """Weights and estimates of the nodes with one byte of context and with none."""

    def __init__(self, rows: pd.DataFrame):
        shape = (256, 256)
        n, ones, product = (np.zeros(shape) for _ in range(3))
        where = rows["byte"].to_numpy(int), rows["node"].to_numpy(int)
        n[where], ones[where], product[where] = (rows[c] for c in ("n", "ones", "product"))
        gamma = LogGamma()
        own = gamma.estimate(n - ones, ones)
        weighted = np.logaddexp(own - LN2, product - LN2)
        self.weight, self.one = np.exp(own - LN2 - weighted), (ones + 0.5) / (n + 1)
        n, ones, product = n.sum(axis=0), ones.sum(axis=0), weighted.sum(axis=0)
        own = gamma.estimate(n - ones, ones)
        self.root_weight = np.exp(own - LN2 - np.logaddexp(own - LN2, product - LN2))
        self.root_one = (ones + 0.5) / (n + 1)

    def finish(self, keys: np.ndarray, depth: int, q: np.ndarray) -> np.ndarray:
        """ln probability of each entry's byte, from ``mixed`` up to the root."""
        near = (keys >> np.uint64(8 * depth)).astype(np.int64)
        value, out = (keys & np.uint64(255)).astype(np.int64), np.zeros(len(keys))
        for bit in range(8):
            node = (1 << bit) | value >> (8 - bit)
            one = bits(keys, bit).astype(bool)
            p = np.where(one, self.one[near, node], 1 - self.one[near, node])
            w = self.weight[near, node]
            mix = w * p + (1 - w) * q[:, bit]
            p = np.where(one, self.root_one[node], 1 - self.root_one[node])
            out += np.log(self.root_weight[node] * p + (1 - self.root_weight[node]) * mix)
        return out


class Share:
    """What all blocks ask of one share of the model."""

    def __init__(self, payloads: list[bytes]):
        asked = [unpacked(p) for p in payloads]
        self.codes = [from_planes(c, "<u8") for c, _, _, _ in asked]
        sums = [from_planes(s, "<u4") for _, s, _, _ in asked]
        flat = np.concatenate(self.codes)
        self.all, inverse = np.unique(flat, return_inverse=True)
        self.counts = np.bincount(inverse, np.concatenate(sums), len(self.all))
        self.places = np.split(inverse, np.cumsum([len(c) for c in self.codes])[:-1])
        self.words = [line.split(b" ") if line else [] for _, _, line, _ in asked]
        self.word_counts: Counter = Counter()
        for words, (_, _, _, counts) in zip(self.words, asked):
            for word, n in zip(words, from_planes(counts, "<u4").tolist() if words else ()):
                self.word_counts[word] += n

    def levels(self, depth: int) -> list[Level]:
        return grow(self.all, self.counts, depth, 2)


def score(
    docs: DataFrame, held_col: str = "held_out", id_col: str = "doc_id", text_col: str = "text",
    depth: int = DEPTH, block: int = BLOCK,
) -> DataFrame:
    """(id, held_out, n_bytes, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Rows whose ``held_col`` is false are learnt from; a null there counts as held out. ``score``
    is the log10 probability of the text and its end, and ``base_score`` that of its words and
    end by smoothed word counts. A null or empty text is its end alone. Without a training text
    every bit has probability 1/2. Repeated rows are learnt from and scored each.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    shares = max(LEAST_SHARES, total // block // SPREAD)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            ids, held = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), bool)
            texts = [t.lower() for t in utf8(batch.column(2))]
            for part in chunks([len(t) for t in texts], block):
                name = TaskContext.get().partitionId() << 32 | number
                number += 1
                rows = [(-1, packed((ids[part], held[part], texts[part])))]
                rows += requests(texts[part], held[part], depth, shares)
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([name] * len(rows), pa.int64()),
                    "share": pa.array([r[0] for r in rows], pa.int32()),
                    "payload": pa.array([r[1] for r in rows], pa.binary()),
                    "kind": pa.array(["text"] + ["asked"] * (len(rows) - 1))})

    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(held_col), F.lit(True)).alias("held"), F.col(text_col).alias("text"))
    path, kind = new_path(spark, "blocks"), "block long, share int, payload binary, kind string"
    rows.mapInArrow(pack, kind).write.partitionBy("kind").parquet(path)
    blocks = spark.read.schema(kind).parquet(path)
    texts = blocks.filter("kind = 'text'").select("block", "payload")
    asked = blocks.filter("kind = 'asked'").select("block", "share", "payload")

    def summary(part: pd.DataFrame) -> pd.DataFrame:
        share = Share(list(part["payload"]))
        out = near_nodes(share.levels(depth)) if len(share.all) else pd.DataFrame(
            columns=["byte", "node", "n", "ones", "product"])
        counts = share.word_counts
        words = pd.DataFrame({  # node 0 holds the words: how many, and how many different ones
            "byte": [0], "node": [0], "n": [float(sum(counts.values()))],
            "ones": [float(sum(1 for n in counts.values() if n))], "product": [0.0]})
        return pd.concat([out, words]).astype(
            {"byte": "int64", "node": "int64", "n": float, "ones": float, "product": float})

    top = asked.groupBy("share").applyInPandas(
        summary, "byte long, node long, n double, ones double, product double"
    ).groupBy("byte", "node").agg(F.sum("n").alias("n"), F.sum("ones").alias("ones"),
                                  F.sum("product").alias("product")).toPandas()
    words = top[top["node"] == 0]
    ends = docs.filter(~F.coalesce(F.col(held_col), F.lit(True))).count()
    n_train = int(words["n"].sum()) + ends
    different = int(words["ones"].sum()) + (ends > 0)
    tables = spark.sparkContext.broadcast(TopTables(top[top["node"] > 0]))

    def answer(part: pd.DataFrame) -> pd.DataFrame:
        share = Share(list(part["payload"]))
        found = np.zeros(0)
        if len(share.all):
            found = tables.value.finish(share.all, depth, mixed(share.levels(depth)))
        return pd.DataFrame({"block": part["block"], "share": part["share"], "payload": [
            packed((planes(found[places].astype(np.float32)),
                    np.array([share.word_counts[w] for w in own], np.int64)))
            for places, own in zip(share.places, share.words)]})

    answers = stage(asked.groupBy("share").applyInPandas(
        answer, "block long, share int, payload binary"), "answers")
    per_token = n_train + 0.5 * (different + 1)

    def finish(key: tuple, text: pd.DataFrame, answered: pd.DataFrame) -> pd.DataFrame:
        ids, held, texts = unpacked(text["payload"].iloc[0])
        codes, starts = strings(texts, depth)
        known, where = np.unique(codes, return_inverse=True)
        share = share_of(known, depth, shares)
        words = block_words(texts)
        by_share: dict[int, list[bytes]] = {}
        for word in sorted(set().union(*words)):
            by_share.setdefault(zlib.crc32(word) % shares, []).append(word)
        logs, counts = np.zeros(len(known)), {}
        for at, blob in zip(answered["share"], answered["payload"]):
            found, word_counts = unpacked(blob)
            logs[share == at] = from_planes(found, "<f4")
            counts.update(zip(by_share.get(at, ()), word_counts.tolist()))
        score = np.add.reduceat(logs[where], starts) / np.log(10)
        out = []
        for name, out_of, text_, line, s in zip(ids, held.tolist(), texts, words, score.tolist()):
            seen = np.array([*map(counts.__getitem__, line), ends], np.float64)
            out.append((name, out_of, len(text_), len(seen), int((seen > 0).sum()), n_train,
                        float(np.log10((seen + 0.5) / per_token).sum()), s))
        return pd.DataFrame(out, columns=[
            "id", "held_out", "n_bytes", "n_tokens", "n_known", "train_tokens", "base_score", "score",
        ]).astype({"id": "Int64"})

    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        finish, "id long, held_out boolean, n_bytes long, n_tokens long, n_known long, "
                "train_tokens long, base_score double, score double")
