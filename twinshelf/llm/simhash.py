"""SimHash near-duplicates with a hierarchical index in Gray order.

Two texts are linked when their 64-bit fingerprints differ in at most ``distance`` bits; a
document's component is the least id that links reach.

Distinct fingerprints are dealt to buckets. With k allowed differences and k + 1 blocks of
bits, two linked fingerprints agree on a whole block, so the block's bits are the pattern of
the bucket's top node and the difference that has accumulated there is zero. Below that node
the bucket's fingerprints are sorted by Gray rank, in which neighbours share most bits, and
every 16 neighbours form a node, 16 of these the node above. A node holds the mask of the bits
that all its members share, without those that its parent holds, and their values. A search
adds up the differences on the way down and drops a node with all its members as soon as they
exceed the distance.

A bucket of more than ``BUCKET`` fingerprints is dealt again by blocks of its remaining bits,
which is exact for the same reason, until too few bits are left for so many fingerprints.
Buckets return a spanning forest of their links, not the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.linkage import components
from ..session import counted_stage, stage
from .batches import by_parts, chunks, utf8

SEED, SHINGLE, DISTANCE = 42, 3, 3
#: Fingerprints that one bucket may hold before it is dealt again.
BUCKET = 4096
#: Members of a node, and query-member pairs compared at a time.
FANOUT, PAIRS = 16, 1 << 20
FULL = (1 << 64) - 1


def shingle_hashes(text: bytes, words: int = SHINGLE) -> list[int]:
    """XXH64 of every run of ``words`` words, of all words if they are fewer."""
    found = text.lower().split()
    if not found:
        return []
    line = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(words, len(found)) - 1
    digest = xxhash.xxh64_intdigest
    return [digest(line[a:b], SEED) for a, b in zip(starts.tolist(), ends[k:].tolist())]


def fingerprints(texts: list[bytes], words: int = SHINGLE) -> np.ndarray:
    """A bit is 1 if it is set in over half the hashes; a text without words gives zero."""
    out = np.zeros(len(texts), np.uint64)
    for part in chunks([len(x) for x in texts], 1 << 20):
        hashes = [shingle_hashes(x, words) for x in texts[part]]
        sizes = np.array([len(x) for x in hashes])
        if not sizes.any():
            continue
        flat = np.fromiter((x for h in hashes for x in h), np.uint64, sizes.sum())
        bits = np.unpackbits(flat.byteswap().view(np.uint8).reshape(-1, 8), axis=1)
        full = np.flatnonzero(sizes)
        begin = (np.cumsum(sizes) - sizes)[full]
        ones = np.add.reduceat(bits, begin, axis=0, dtype=np.int32)
        majority = np.packbits(2 * ones > sizes[full, None], axis=1)
        out[np.arange(part.start, part.stop)[full]] = majority.view(np.uint64).ravel().byteswap()
    return out


def fingerprint(text: str, words: int = SHINGLE) -> Column:
    """The fingerprint of a text column as a signed long."""
    @by_parts("long")
    def of(part: pa.Array) -> pa.Array:
        return pa.array(fingerprints(utf8(part), words).view(np.int64))
    return of(F.col(text))


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each value in the reflected Gray sequence."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(shift))
    return x


def blocks(fixed: int, distance: int) -> list[int]:
    """The masks that add one of ``distance`` + 1 blocks of the free bits to ``fixed``."""
    free = [b for b in range(63, -1, -1) if not fixed >> b & 1]
    cuts = [len(free) * i // (distance + 1) for i in range(distance + 2)]
    return [fixed | sum(1 << b for b in free[a:z]) for a, z in zip(cuts, cuts[1:])]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def dealt(df: DataFrame, masks: list[int], distance: int) -> DataFrame:
    """One row for each bucket that a fingerprint falls in; ``df`` has ``fixed`` and ``fp``."""
    below = df.sparkSession.createDataFrame(
        [(signed(m), signed(c)) for m in masks for c in blocks(m, distance)],
        "above long, fixed long")  # a few thousand rows at the deepest, whatever the table
    return df.select("fp", F.col("fixed").alias("above")).join(F.broadcast(below), "above").select(
        "fixed", F.col("fp").bitwiseAND(F.col("fixed")).alias("held"), "fp"
    )


class GrayIndex:
    """Nodes over sorted fingerprints; ``starts`` are the first places of the buckets."""

    def __init__(self, values: np.ndarray, starts: np.ndarray):
        self.values, self.levels = values, []
        bucket_sizes = np.diff(np.append(starts, len(values)))
        begin, owner = starts, np.zeros(len(starts), np.int64)
        masks = np.zeros(len(starts), np.uint64)
        width = FANOUT * FANOUT
        ends = starts + bucket_sizes
        while width >= FANOUT:
            counts = -(-(ends - begin) // width)
            parent = np.repeat(np.arange(len(begin)), counts)
            first = np.cumsum(counts) - counts
            at = begin[parent] + (np.arange(len(parent)) - first[parent]) * width
            stop = np.minimum(at + width, ends[parent])
            shared = ~(np.bitwise_or.reduceat(values, at) ^ np.bitwise_and.reduceat(values, at))
            own = shared & ~masks[parent]
            self.levels.append((first, counts, own, values[at] & own))
            begin, ends, masks, width = at, stop, shared, width // FANOUT
        self.leaf = begin, ends, ~masks

    def links(self, queries: np.ndarray, bucket: np.ndarray, distance: int):
        """(query place, member place) for members behind the query and within the distance."""
        q, node, off = queries, bucket, np.zeros(len(queries), np.int64)
        for first, counts, own, pattern in self.levels:
            n = counts[node]
            child = np.repeat(first[node] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            q, off = np.repeat(q, n), np.repeat(off, n)
            off = off + np.bitwise_count((self.values[q] ^ pattern[child]) & own[child])
            keep = off <= distance
            q, node, off = q[keep], child[keep], off[keep]
        begin, ends, rest = self.leaf
        n = ends[node] - begin[node]
        member = np.repeat(begin[node] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        q, off, rest = np.repeat(q, n), np.repeat(off, n), np.repeat(rest[node], n)
        near = (member > q) & (
            off + np.bitwise_count((self.values[q] ^ self.values[member]) & rest) <= distance)
        return q[near], member[near]


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union-find over arrays: every root hooks on to the least root it meets."""
    while True:
        left, right = parent[a], parent[b]
        differ = left != right
        if not differ.any():
            return parent
        a, b, left, right = a[differ], b[differ], left[differ], right[differ]
        np.minimum.at(parent, np.maximum(left, right), np.minimum(left, right))
        while not np.array_equal(up := parent[parent], parent):
            parent = up


def forest(fixed: np.ndarray, held: np.ndarray, fp: np.ndarray, distance: int):
    """(member, root) fingerprints of every bucket's linked groups; buckets lie together."""
    order = np.lexsort((gray_rank(fp), held, fixed))
    fixed, held, fp = fixed[order], held[order], fp[order]
    new = np.concatenate(([True], (fixed[1:] != fixed[:-1]) | (held[1:] != held[:-1])))
    starts = np.flatnonzero(new)
    bucket = np.cumsum(new) - 1
    sizes = np.diff(np.append(starts, len(fp)))[bucket]
    index, parent = GrayIndex(fp, starts), np.arange(len(fp))
    many = np.flatnonzero(sizes > 1)
    slices = (np.cumsum(sizes[many]) - 1) // PAIRS
    for part in np.split(many, np.flatnonzero(np.diff(slices)) + 1):
        if len(part):
            parent = unite(parent, *index.links(part, bucket[part], distance))
    moved = np.flatnonzero(parent != np.arange(len(fp)))
    return fp[moved], fp[parent[moved]]


def bucket_links(buckets: DataFrame, distance: int) -> DataFrame:
    """(a, b): each member of a linked group in a bucket, with the group's root."""
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def solved(part: pd.DataFrame) -> pd.DataFrame:
            a, b = forest(*[part[c].to_numpy().view(np.uint64) for c in ("fixed", "held", "fp")],
                          distance)
            return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

        rest = None
        for batch in batches:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            last = rest.iloc[-1]
            open_ = ((rest["fixed"] == last["fixed"]) & (rest["held"] == last["held"])).to_numpy()
            if not open_.all():  # the last bucket may go on in the next batch
                yield solved(rest[~open_].reset_index(drop=True))
                rest = rest[open_]
        if rest is not None and len(rest):
            yield solved(rest.reset_index(drop=True))

    return buckets.repartition("fixed", "held").sortWithinPartitions("fixed", "held").mapInPandas(
        search, "a long, b long")


def links(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): pairs that connect all fingerprints linked within ``distance`` bits.

    A pair is a member and the root of a group that links hold together, so its two ends may
    differ in more bits.

    ``distinct`` has one column ``fp`` without repeats.
    """
    masks, parts = [0], []
    rest = distinct.select(F.lit(0).cast("long").alias("fixed"), "fp")
    while True:
        buckets = dealt(rest, masks, distance)
        masks = sorted({c for m in masks for c in blocks(m, distance)})
        crowded, n = counted_stage(
            buckets.groupBy("fixed", "held").count().filter(F.col("count") > BUCKET)
            .select("fixed", "held"), "crowded", F.lit(True))
        free = min(64 - m.bit_count() for m in masks)
        if not n or 1 << free <= BUCKET or free <= distance:
            parts.append(bucket_links(buckets, distance))
            break
        parts.append(bucket_links(buckets.join(crowded, ["fixed", "held"], "left_anti"), distance))
        rest = stage(buckets.join(crowded, ["fixed", "held"], "left_semi")
                     .select("fixed", "fp"), "crowded-rows")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    words: int = SHINGLE, distance: int = DISTANCE,
) -> DataFrame:
    """(id, fp, text_hash, component_id, component): every row with its fingerprint's component.

    ``component_id`` is the least id that links reach, ``component`` the least fingerprint.
    Null and empty texts have no words and hence fingerprint zero, which links like any other.
    A null id takes part but is never the least unless the whole component is without ids.
    Repeated rows stay. An empty table gives an empty result.
    """
    marked = stage(docs.select(
        F.col(id_col).alias("id"), fingerprint(text_col, words).alias("fp"),
        F.xxhash64(text_col).alias("text_hash")), "fingerprints")
    least = stage(marked.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    found = components(
        least.select(F.col("fp").alias("id")), stage(links(least.select("fp"), distance), "links"))
    named = least.join(found.toDF("fp", "component"), "fp")
    tops = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.select("fp", "component").join(tops, "component")
    return marked.join(named, "fp").select("id", "fp", "text_hash", "component_id", "component")


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    words: int = SHINGLE, distance: int = DISTANCE,
) -> DataFrame:
    """The rows of ``docs`` that stay when each component keeps the document with the least id.

    Among rows of that id the one with the least text hash stays; equal rows become one.
    """
    rows = near_duplicates(docs, id_col, text_col, words, distance)
    kept, repeated = counted_stage(
        rows.filter(F.col("id").eqNullSafe(F.col("component_id")))
        .groupBy("component", F.col("id").alias("_id"))
        .agg(F.min("text_hash").alias("_hash"), F.count("*").alias("_rows")),
        "kept", F.col("_rows") > 1)
    kept = kept.select("_id", "_hash").distinct()
    key = docs[id_col].eqNullSafe(kept["_id"]) & (F.xxhash64(docs[text_col]) == kept["_hash"])
    out = docs.join(kept, key, "left_semi")
    return out.dropDuplicates([id_col, text_col]) if repeated else out
