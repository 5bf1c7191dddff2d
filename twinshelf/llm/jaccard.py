"""Jaccard join of word n-gram sets by a token-group matrix.

Equal sets are one. Similar sets are put into groups: first by their least shingle hash, in pieces
of bounded size, whose members are compared, then again by the least under other hashes, where
components still meet; what links is a component, and the groups of the matrix are the pieces
of components. The matrix has a row for a token and each group whose
members hold it. Two sets that link share a token among the rarest few of each, however ties
are broken, so the candidate table needs only these few of each member. A candidate pair of
groups is looked at only if they share as many of these few as a link leaves no choice but to
share, and is opened only if some set of the one has enough tokens in the union of the other: the
overlap with the union bounds that with any member.

The components of all links are the result, so one link between two groups is enough, a group
being connected already, and groups of one component never meet. Thousands of near copies
thus cost comparisons within pieces only, not all of their pairs.

Which tokens are rare is told by a table of ``SLOTS`` counters over all shingles. Any fixed order
gives whole results; a good one keeps the passages that many documents share out of the few.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.grid import self_pairs
from ..operators.linkage import components
from ..session import release, stage
from .batches import utf8

WORDS, SHARE = 5, 80
#: Counters of the shingles' frequencies, and tasks whose counters are added up together.
SLOTS, TASKS = 1 << 21, 64
#: Tokens of a group, tokens that a set counts for at least, partners opened in one task group.
GROUP, LEAST, PARTNERS = 1 << 16, 512, 64
#: Odd multipliers, under each of which a set has a least shingle hash.
LEASTS = (1, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
#: Bytes whose words are held as objects at a time; columns of an incidence matrix.
STRETCH, COLUMNS = 4 << 20, 1 << 16

_SPACE = re.compile(rb"[ \t-\r]")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _word_hashes(text: bytes) -> np.ndarray:
    parts, start = [], 0
    while start < len(text):
        gap = _SPACE.search(text, start + STRETCH)
        end = gap.start() if gap else len(text)
        words = text[start:end].lower().split()
        parts.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
        start = end
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the text's runs of ``words`` words, of all words if fewer."""
    found = _word_hashes(text)
    if not len(found):
        return found
    k = min(words, len(found))
    runs = np.zeros(len(found) - k + 1, np.uint64)
    for i in range(k):
        runs = runs * _ODD + found[i:len(runs) + i]
    runs ^= runs >> np.uint64(31)
    runs *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(runs ^ (runs >> np.uint64(29)))


def frequencies(docs: DataFrame, text_col: str, words: int) -> np.ndarray:
    """How many shingles of all texts fall in each slot, as a share of the mean, in 256ths."""
    width = SLOTS // 64

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for text in utf8(batch.column(0)):
                np.add.at(total, _slot(shingles(text, words)), 1)
        total = total.astype(np.int32)
        parts = [total[i:i + width].tobytes() for i in range(0, SLOTS, width)]
        lane = TaskContext.get().partitionId() // TASKS
        yield pa.RecordBatch.from_arrays(
            [pa.array([lane] * 64), pa.array(range(64)), pa.array(parts, pa.binary())],
            names=["lane", "part", "counts"])

    def added(part: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(width, np.int64)
        for counts in part["counts"]:
            total += np.frombuffer(counts, np.int32)
        total = np.minimum(total, np.iinfo(np.int32).max).astype(np.int32)
        return part.iloc[:1].assign(counts=[total.tobytes()])

    schema = "lane long, part long, counts binary"
    tables = docs.select(F.col(text_col).cast("string")).mapInArrow(count, schema)
    for keys in (["lane", "part"], ["part"]):  # TASKS tables at a time, then what they came to
        tables = tables.groupBy(*keys).applyInPandas(added, schema)
    whole = np.zeros(SLOTS, np.int64)
    for row in tables.collect():
        whole[row["part"] * width:(row["part"] + 1) * width] = np.frombuffer(row["counts"], np.int32)
    mean = max(whole.mean(), 1.0)
    return np.minimum(whole / mean * 256, 65535).astype(np.uint16)


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)


def _ranks(tokens: np.ndarray, often: np.ndarray) -> np.ndarray:
    """The fixed order of tokens: by the frequency of their slots, then by the hash."""
    return (often[_slot(tokens)].astype(np.uint64) << np.uint64(48)) | (tokens >> np.uint64(16))


def _set_id(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def signatures(docs: DataFrame, id_col: str, text_col: str, words: int, share: int) -> DataFrame:
    """(doc, set, n, least, rare): each text's set, its least hashes and its rarest tokens' ranks.

    The rarest are as many as a set may miss in one that it links with, and one more.
    """
    spark = docs.sparkSession
    often = spark.sparkContext.broadcast(frequencies(docs, text_col, words))

    @F.arrow_udf("struct<set: long, n: long, least: array<long>, rare: array<long>>")
    def of(column: pa.Array) -> pa.Array:
        rows, rare = [], []
        for text in utf8(column):
            tokens = shingles(text, words)
            if not len(tokens):
                rows.append((0, 0, [0] * len(LEASTS)))
                rare.append(tokens)
                continue
            ranks = _ranks(tokens, often.value)
            usual = tokens[ranks < np.uint64(1024 << 48)]  # not beyond four times the mean
            if 2 * len(usual) < len(tokens):  # a copy of a frequent text, but for a few words
                usual = tokens
            least = [int((usual * np.uint64(x)).min().view(np.int64)) for x in LEASTS]
            missed = len(tokens) - -(-share * len(tokens) // 100)
            rare.append(np.unique(ranks[ranks <= np.partition(ranks, missed)[missed]]))
            rows.append((_set_id(tokens), len(tokens), least))
        sets, n, least = (pa.array([r[i] for r in rows], kind) for i, kind in enumerate(
            (pa.int64(), pa.int64(), pa.list_(pa.int64()))))
        ends = np.cumsum([0] + [len(x) for x in rare]).astype(np.int32)
        flat = np.concatenate(rare).view(np.int64) if rare else np.empty(0, np.int64)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
        return pa.StructArray.from_arrays([sets, n, least, lists], ["set", "n", "least", "rare"])

    marked = docs.select(F.col(id_col).alias("doc"), of(F.col(text_col)).alias("s"))
    return stage(marked.select("doc", "s.*"), "signatures")


def tokens_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, words: int,
              repeated: bool) -> DataFrame:
    """``wanted`` (set, doc, …) with the tokens of each set as the bytes of 64-bit numbers."""
    @F.arrow_udf("binary")
    def of(sets: pa.Array, column: pa.Array) -> pa.Array:
        found = [shingles(text, words) for text in utf8(column)]
        # Another row may have the same id and another text.
        return pa.array([x.tobytes() if _set_id(x) == s else None
                         for s, x in zip(sets.to_pylist(), found)], pa.binary())

    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text"))
    # The asked-for sets grow with the table, so they are not broadcast at any size.
    met = wanted.hint("merge").join(texts, F.col("doc").eqNullSafe(F.col("_doc"))).withColumn(
        "tokens", of.asNondeterministic()("set", "_text")  # or a filter would call it once more
    ).filter("tokens IS NOT NULL").drop("_doc", "_text")
    return met.dropDuplicates([c for c in met.columns if c != "tokens"]) if repeated else met


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """How many tokens each two of the sets share."""
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, code = np.unique(flat, return_inverse=True)
    out = np.zeros((len(sets), len(sets)))
    for start in range(0, int(code.max()) + 1, COLUMNS):
        here = (code >= start) & (code < start + COLUMNS)
        held = np.zeros((len(sets), COLUMNS if code.max() >= COLUMNS else int(code.max()) + 1), np.float32)
        held[row[here], code[here] - start] = 1
        out += held @ held.T
    return out


def _linked(common: np.ndarray, n: np.ndarray, m: np.ndarray, share: int) -> np.ndarray:
    return 100 * common >= share * (n + m - common)


def piece_links(ids: list[int], sets: list[np.ndarray], share: int) -> list[tuple[int, int]]:
    """(member, root) that hold together what links within a piece."""
    n = np.array([len(x) for x in sets])
    near = _linked(_overlaps(sets), n[:, None], n[None, :], share)
    root = np.arange(len(ids))
    while True:  # the least place that links reach
        best = np.where(near, root[None, :], len(ids)).min(axis=1)
        best = best[best]
        if (best == root).all():
            return [(ids[i], ids[r]) for i, r in enumerate(root) if i != r]
        root = best


def group_link(ours: list[np.ndarray], theirs: list[np.ndarray], share: int) -> tuple[int, int] | None:
    """Places of one linked pair between two groups, if any.

    A set with fewer tokens in the other group's union than a link needs is not compared, and a
    group none of whose sets is left is not opened.
    """
    union = np.unique(np.concatenate(theirs))
    m = np.array([len(x) for x in theirs])
    for i, one in enumerate(ours):
        place = np.minimum(np.searchsorted(union, one), len(union) - 1)
        held = one[union[place] == one]
        if 100 * len(held) < share * max(len(one), m.min()):
            continue
        for j in np.flatnonzero((100 * np.minimum(m, len(one)) >= share * np.maximum(m, len(one)))):
            place = np.minimum(np.searchsorted(theirs[j], held), m[j] - 1)
            common = int((theirs[j][place] == held).sum())
            if _linked(common, len(one), int(m[j]), share):
                return i, int(j)
    return None


def _pieced(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` (set, n, component, key) in pieces of each key of about ``GROUP`` tokens.

    ``pivot`` is a set of the key, ``apart`` whether the key has sets of several components.
    """
    cost = F.greatest(F.col("n"), F.lit(LEAST))
    totals = rows.groupBy(key).agg(
        F.ceil(F.sum(cost) / GROUP).alias("pieces"), F.min("set").alias("pivot"),
        (F.min("component") < F.max("component")).alias("apart"))
    return rows.join(totals, key).withColumn("piece", F.pmod(F.xxhash64("set", F.lit(5)), "pieces"))


def _lanes(rows: DataFrame, keys: list[str], cost: Column, large: Column) -> DataFrame:
    """``rows`` with a column ``lane``: small groups share one, a large group has one of its own."""
    total = rows.agg(F.sum(cost)).first()[0] or 0
    lanes = F.lit(max(1, -(-int(total) // GROUP)))
    return rows.withColumn("lane", F.when(large, F.xxhash64(*keys)).otherwise(
        F.pmod(F.xxhash64(*keys), lanes)))


def _shared(sets: DataFrame) -> DataFrame:
    """The sets that have one of their least hashes in common with another."""
    each = sets.select("set", "doc", F.posexplode("least").alias("at", "hash"))
    many = each.groupBy("at", "hash").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    return each.join(many, ["at", "hash"]).select("set", "doc").distinct()


def _similar(sets: DataFrame, tokens: DataFrame, at: int, share: int) -> DataFrame:
    """(a, b): links within the groups of sets that have the same ``at``-th least hash.

    The pieces of a group share one member, its pivot, which brings most of a family together.
    """
    dealt = _pieced(sets.select("set", "n", "component", F.col("least")[at].alias("least")),
                    "least").filter("apart")
    pivots = dealt.filter("set = pivot").withColumn(
        "piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    placed = dealt = stage(dealt.filter("set <> pivot").unionByName(pivots), "similar")
    cost = F.greatest(F.col("n"), F.lit(LEAST))
    dealt = _lanes(dealt, ["least", "piece"], cost, F.col("pieces") > 1).select(
        "set", "least", "piece", "lane")

    def solve(part: pd.DataFrame) -> pd.DataFrame:
        links = []
        for _, group in part.groupby(["least", "piece"], sort=False):
            links += piece_links(group["set"].tolist(),
                                 [np.frombuffer(x, np.uint64) for x in group["tokens"]], share)
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    found = stage(dealt.join(tokens, "set").groupBy("lane").applyInPandas(
        solve, "a long, b long"), "similar-links")
    release(placed)
    return found


def matrix(rare: DataFrame) -> DataFrame:
    """(token, group, component) of the tokens that groups of different components have among their ``rare``."""
    rows = rare.repartition("token").groupBy("token", "group").agg(F.first("component").alias("component"))
    ends = rows.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return stage(rows.join(ends.filter("low <> high").select("token"), "token"), "matrix")


def candidates(cells: DataFrame) -> DataFrame:
    """(a_group, b_group, common): how many of the cells' tokens groups of different components share."""
    met = self_pairs(cells, ["token"], "group")
    return met.filter("a_component <> b_component").groupBy("a_group", "b_group").agg(
        F.count(F.lit(1)).alias("common"))


def _between(docs: DataFrame, sets: DataFrame, rare: DataFrame, how: tuple, share: int) -> DataFrame:
    """(a, b): a link for each two groups of different components that link."""
    grouped = stage(_pieced(sets, "component").select(
        "set", "doc", "n", "n_rare", "component", F.xxhash64("component", "piece").alias("group")),
        "groups")
    postings = grouped.select("set", "component", "group").hint("merge").join(rare, "set").select(
        F.explode("rare").alias("token"), "component", "group")
    sizes = grouped.groupBy("group").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.sum("n").alias("tokens"),
        F.min(F.col("n_rare") - F.col("n")).alias("spare"))
    a, b = (sizes.select([F.col(c).alias(f"{x}_{c}") for c in sizes.columns]) for x in "ab")
    # A link of sets of x and y tokens shares at least ``needed``, so of all its tokens, and of its
    # rare ones, the one whose rare ones end earlier in the order lacks x - needed at most.
    needed = share * (F.col("a_low") + F.col("b_low")) / (100 + share)
    fits = ((100 * F.col("a_high") >= share * F.col("b_low"))
            & (100 * F.col("b_high") >= share * F.col("a_low"))
            & (F.col("common") >= F.least("a_spare", "b_spare") + needed))
    # The larger group stays, the smaller one is sent to it.
    first = F.struct("a_tokens", "a_group") >= F.struct("b_tokens", "b_group")
    cells = matrix(postings)
    pairs = stage(
        candidates(cells).join(a, "a_group").join(b, "b_group").filter(fits).select(
            F.when(first, F.col("a_group")).otherwise(F.col("b_group")).alias("host"),
            F.when(first, F.col("b_group")).otherwise(F.col("a_group")).alias("guest")), "group-pairs")
    release(cells)
    there = pairs.select(F.explode(F.array("host", "guest")).alias("group")).distinct()
    wanted = stage(grouped.join(there, "group").select("set", "doc", "group"), "wanted")
    release(grouped)
    members = stage(tokens_of(docs, wanted, *how).groupBy("group").agg(
        F.collect_list(F.struct("set", "tokens")).alias("members")), "members")
    release(wanted)
    buckets = pairs.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).alias("buckets"))
    placed = pairs.join(buckets, "host").withColumn(
        "bucket", F.pmod(F.xxhash64("guest"), "buckets"))
    placed = _lanes(placed, ["host", "bucket"], F.lit(GROUP // PARTNERS), F.col("buckets") > 1)
    guests = placed.join(members.withColumnRenamed("group", "guest"), "guest").select(
        "lane", "host", "members")
    hosts = placed.select("lane", "host").distinct().join(
        members.withColumnRenamed("group", "host"), "host").select("lane", "host", "members")

    def unpacked(cell) -> tuple[list[int], list[np.ndarray]]:
        return [m["set"] for m in cell], [np.frombuffer(m["tokens"], np.uint64) for m in cell]

    def solve(ours: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        homes, out = dict(zip(ours["host"], map(unpacked, ours["members"]))), []
        for host, cell in zip(others["host"], others["members"]):
            (ids, sets_), (guest_ids, guest_sets) = homes[host], unpacked(cell)
            found = group_link(guest_sets, sets_, share)
            if found:
                out.append((guest_ids[found[0]], ids[found[1]]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    guests = guests.toDF(*guests.columns)  # or both sides' columns go by one name
    found = stage(hosts.groupBy("lane").cogroup(guests.groupBy("lane")).applyInPandas(
        solve, "a long, b long"), "between")
    release(members)
    release(pairs)
    return found


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
    share: int = SHARE,
) -> DataFrame:
    """(id, n_shingles, set, component_id): every row with the component of its shingle set.

    Two sets link when 100 * intersection >= ``share`` * union. A text of fewer words is one
    shingle; a null text or one without words has none, links with nothing and is a component
    by itself. Repeated rows stay and link. ``component_id`` is the least id that links
    reach; a null id takes part, but is the least only where a component has no other. An empty
    table gives an empty result. Columns other than the two named play no part.
    """
    if not 0 < share <= 100 or words < 1:
        raise ValueError("share is a per cent above 0, words at least 1")
    marked = signatures(docs, id_col, text_col, words, share)
    rows = marked.filter("n > 0").groupBy("set", "doc").agg(
        F.first("n").alias("n"), F.first("least").alias("least"),
        F.first(F.size("rare")).alias("n_rare"), F.count(F.lit(1)).alias("copies"))
    sets = stage(rows.groupBy("set").agg(
        F.min("doc").alias("doc"), F.first("n").alias("n"), F.first("least").alias("least"),
        F.first("n_rare").alias("n_rare"),
        F.max("copies").alias("copies")), "sets")
    repeated = sets.filter("copies > 1").limit(1).count() > 0
    sets = sets.drop("copies")
    how = (id_col, text_col, words, repeated)
    ids = sets.select(F.col("set").alias("id"))
    tokens = stage(tokens_of(docs, stage(_shared(sets), "shared"), *how).select("set", "tokens"), "tokens")
    known, within = sets.withColumn("component", F.col("set")), None
    for at in range(len(LEASTS)):
        more = _similar(known, tokens, at, share)
        within = more if within is None else within.unionByName(more)
        found = stage(components(ids, within), "similar-components")
        known = sets.join(found.toDF("set", "component"), "set")
    release(tokens)
    rare = marked.filter("n > 0").select("set", "doc", "rare")
    rare = rare.join(sets.select("set", F.col("doc").alias("one")).hint("merge"), "set").filter(
        F.col("doc").eqNullSafe(F.col("one"))).select("set", "rare")
    if repeated:
        rare = rare.dropDuplicates(["set"])
    between = _between(docs, known, rare, how, share)
    joined = components(ids, stage(within.unionByName(between), "links"))
    named = joined.toDF("set", "component")
    least = named.join(sets.select("set", "doc"), "set").groupBy("component").agg(
        F.min("doc").alias("component_id"))
    named = named.join(least, "component").select("set", "component_id")
    linked = marked.filter("n > 0").join(named, "set").select("doc", "n", "set", "component_id")
    alone = marked.filter("n = 0").select("doc", "n", "set", F.col("doc").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("doc").alias("id"), F.col("n").alias("n_shingles"), "set", "component_id")
