"""The trie of conversation beginnings, with totals rolled up by bands of depth.

A node is a distinct sequence of first turns. Its key is the depth and the exclusive or of two
64-bit hashes of (turn, place) over the turns, so it is a running total that blocks of a long
conversation add up apart from each other. A node goes by its least member and its depth.

Totals over subtrees go up in bands of ``HEIGHT`` depths. A node's own figures explode only to
its ancestors within the band; the tops of the bands, with what is now known of their band, are a
tree of a ``HEIGHT``-th of the depth, which is rolled up in the same way; and each top's completed
total then goes to the nodes of the band above it. A node is exploded to ``HEIGHT`` ancestors at
most, and a trie of depth D takes log D rounds to the base ``HEIGHT``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import number_within
from ..session import counted_stage, stage

HEIGHT = 16
#: Turns of a conversation that one window adds up, and ends that one blob of ids holds.
STRETCH, ENDS = 256, 8192
#: Conversations share a beginning with the first of their hundred, of up to five turns.
FAMILY, LENGTHS = 100, 6

KEY = ["depth", "k1", "k2"]


def turns(df: DataFrame) -> DataFrame:
    """(conv, pos, h1, h2, points): the turns of each conversation numbered 1, 2, 3 …"""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    hashed = df.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), "turn",
        F.xxhash64(F.lit(1), role, text).alias("h1"), F.xxhash64(F.lit(2), role, text).alias("h2"),
        F.char_length(text).cast("long").alias("points"))
    return number_within(hashed, "conv", ["turn", "h1", "h2"], "pos").drop("turn")


def rebuilt(told: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv, pos, h1, h2, points), (conv, length)) of the rebuilt conversations."""
    family = F.col("conv") - F.col("conv") % FAMILY
    borrows = F.crc32(F.col("conv").cast("string").cast("binary")) % LENGTHS
    convs = told.groupBy("conv").agg(F.max("pos").alias("n")).select(
        "conv", "n", family.alias("family"), borrows.alias("h"))
    first = convs.select(F.col("conv").alias("family"), F.col("n").alias("there"))
    convs = stage(convs.join(first, "family", "left").select(
        "conv", "n", "family", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("m")), "convs")
    # A family's first conversation is asked for by a hundred others at most.
    heads = told.filter(F.col("pos") < LENGTHS).withColumnRenamed("conv", "family")
    lent = convs.filter("m > 0").select("conv", "family", "h").join(heads, "family").filter(
        F.col("pos") <= F.col("h")).select("conv", "pos", "h1", "h2", "points")
    # Only where the first conversation is short do a conversation's own turns move up.
    moved = convs.filter("m < h").select("conv", (F.col("h") - F.col("m")).alias("up"))
    own = told.filter(F.col("pos") > borrows).join(moved, "conv", "left").select(
        "conv", (F.col("pos") - F.coalesce("up", F.lit(0))).alias("pos"), "h1", "h2", "points")
    lengths = convs.select(
        "conv", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    return lent.unionByName(own), lengths


def _running(rows: DataFrame, deepest: int) -> DataFrame:
    """``rows`` (conv, pos, k1, k2, …) with k1 and k2 as exclusive ors of all up to each place."""
    block = F.floor((F.col("pos") - 1) / STRETCH)
    so_far = Window.partitionBy("conv", "block").orderBy("pos")
    inner = rows.withColumn("block", block).withColumns(
        {k: F.bit_xor(k).over(so_far) for k in ("k1", "k2")})
    if deepest <= STRETCH:
        return inner.drop("block")
    blocks = rows.withColumn("block", block).groupBy("conv", "block").agg(
        F.bit_xor("k1").alias("k1"), F.bit_xor("k2").alias("k2"))
    before = _running(blocks.withColumn("pos", F.col("block") + 1).drop("block"),
                      -(-deepest // STRETCH))
    before = before.select("conv", F.col("pos").alias("block"), F.col("k1").alias("c1"),
                           F.col("k2").alias("c2"))
    return inner.join(before, ["conv", "block"], "left").withColumns({
        "k1": F.col("k1").bitwiseXOR(F.coalesce("c1", F.lit(0))),
        "k2": F.col("k2").bitwiseXOR(F.coalesce("c2", F.lit(0))),
    }).drop("block", "c1", "c2")


def paths(told: DataFrame) -> tuple[DataFrame, int]:
    """(conv, depth, k1, k2, up1, up2, points, last): every node that a conversation passes.

    ``up1`` and ``up2`` are the key of the node above; ``last`` marks the node it ends at.
    """
    rows, lengths = rebuilt(told)
    deepest = lengths.agg(F.max("length")).first()[0] or 0
    marks = {f"e{i}": F.xxhash64(F.lit(i), "h1", "h2", "pos") for i in (1, 2)}
    rows = rows.withColumns(marks).select(
        "conv", "pos", F.col("e1").alias("k1"), F.col("e2").alias("k2"), "e1", "e2", "points")
    below = _running(rows, deepest).select(
        "conv", F.col("pos").alias("depth"), "k1", "k2",
        F.col("k1").bitwiseXOR(F.col("e1")).alias("up1"),
        F.col("k2").bitwiseXOR(F.col("e2")).alias("up2"), "points")
    none = F.lit(0).cast("long")
    top = lengths.select("conv", none.alias("depth"), *[none.alias(c) for c in (
        "k1", "k2", "up1", "up2", "points")])
    return below.unionByName(top).join(lengths, "conv").withColumn(
        "last", F.col("depth") == F.col("length")).drop("length"), deepest


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEY).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def rollup(walked: DataFrame, nodes: DataFrame, deepest: int, height: int = HEIGHT) -> DataFrame:
    """(depth, k1, k2, leaves, saved): the nodes' figures added up over their subtrees.

    ``walked`` (conv, depth, k1, k2) has the nodes on each conversation's way, ``nodes`` (conv,
    depth, k1, k2, leaves, saved) each node once, by a conversation that passes it.
    """
    band = F.floor(F.col("depth") / height).alias("band")
    entry = F.struct(*KEY)
    ways = walked.groupBy("conv", band).agg(F.collect_list(entry).alias("way"))
    own = nodes.groupBy("conv", band).agg(
        F.collect_list(F.struct("depth", "leaves", "saved")).alias("own"))

    def below(figure: str) -> Column:
        return F.aggregate("own", F.lit(0).cast("long"), lambda t, e: F.when(
            e["depth"] >= F.col("at.depth"), t + e[figure]).otherwise(t)).alias(figure)

    within = _summed(
        own.join(ways, ["conv", "band"]).select("own", F.explode("way").alias("at"))
        .select("at.*", below("leaves"), below("saved")))
    if deepest < height:
        return within
    within = stage(within, "bands")
    tops = F.col("depth") % height == 0
    rank = (F.col("depth") / height).cast("long").alias("depth")
    named = nodes.filter(tops).select("conv", *KEY)
    upper = rollup(
        walked.filter(tops).select("conv", rank, "k1", "k2"),
        named.join(within, KEY).select("conv", rank, "k1", "k2", "leaves", "saved"),
        deepest // height, height)
    done = named.join(
        upper.withColumn("depth", F.col("depth") * height), KEY).filter(F.col("depth") > 0)
    handed = done.select("conv", (F.floor(F.col("depth") / height) - 1).alias("band"),
                         "leaves", "saved").join(ways, ["conv", "band"])
    handed = handed.select(F.explode("way").alias("at"), "leaves", "saved").select(
        "at.*", "leaves", "saved")
    return _summed(within.unionByName(handed))


def ends_digest(ends: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256) from (depth, k1, k2, conv), for any number of ends of a node.

    The ends are sorted over the whole table and joined to blobs of ``ENDS`` ids; a hash runs
    over a node's blobs one by one, so no task holds all ends of a node at once.
    """
    schema = "depth long, k1 long, k2 long, first long, ids string"

    def blobs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            size = batch.groupby(KEY, sort=False).cumcount() // ENDS
            found = batch.assign(ids=batch["conv"].astype(str)).groupby(
                [*KEY, size], sort=False).agg(first=("conv", "min"), ids=("ids", ",".join))
            yield found.reset_index()[[*KEY, "first", "ids"]]

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, running = None, None
        for batch in batches:
            out = []
            for *here, ids in batch[[*KEY, "ids"]].itertuples(index=False):
                if here != key:
                    if key is not None:
                        out.append((*key, running.hexdigest()))
                    key, running = here, hashlib.sha256(ids.encode())
                else:
                    running.update(b"," + ids.encode())
            yield pd.DataFrame(out, columns=[*KEY, "ends_sha256"])
        if key is not None:
            yield pd.DataFrame([(*key, running.hexdigest())], columns=[*KEY, "ends_sha256"])

    sorted_ends = ends.select(*KEY, "conv").repartitionByRange(*KEY, "conv").sortWithinPartitions(
        *KEY, "conv").mapInPandas(blobs, schema)
    return sorted_ends.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInPandas(
        digests, "depth long, k1 long, k2 long, ends_sha256 string")


def trie(df: DataFrame, height: int = HEIGHT) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    ``df`` has conv_id, turn, role and text; other columns play no part. Turns go by ``turn``,
    null first, equal ones by hashes of role and text; repeated rows are turns of their own. Null
    roles and texts are empty ones. Rows without a conv_id take no part. Conversations and texts
    may be of any length. An empty table has no conversations and gives no node, not even the root.
    """
    walked, deepest = paths(stage(turns(df), "turns"))
    walked, _ = counted_stage(walked, "paths", F.lit(True))
    nodes = stage(walked.groupBy(*KEY).agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.max("points").alias("points"),
        F.max("up1").alias("up1"), F.max("up2").alias("up2")), "nodes")
    above = [(F.col("depth") - 1).alias("depth"), F.col("up1").alias("k1"), F.col("up2").alias("k2")]
    children = nodes.filter("depth > 0").select(*above).groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = stage(nodes.join(children, KEY, "left").na.fill(0, ["n_children"]), "nodes")
    totals = rollup(
        walked.select("conv", *KEY),
        nodes.select("conv", *KEY, (F.col("n_children") == 0).cast("long").alias("leaves"),
                     ((F.col("n_convs") - 1) * F.col("points")).alias("saved")),
        deepest, height)
    # The root has the most children and is one row; other hot parents are left to adaptive joins.
    root = F.broadcast(nodes.filter("depth = 0").select(F.col("conv").alias("top")))
    parents = nodes.select(F.col("depth").alias("d"), F.col("k1").alias("up1"), F.col("k2").alias("up2"),
                           F.col("conv").alias("parent"))
    deeper = nodes.filter("depth > 1").withColumn("d", F.col("depth") - 1).join(
        parents, ["d", "up1", "up2"]).select(*KEY, "parent")
    named = nodes.filter("depth = 1").join(root).select(*KEY, F.col("top").alias("parent"))
    whole = nodes.join(totals, KEY).join(
        deeper.unionByName(named), KEY, "left").join(ends_digest(walked.filter("last")), KEY, "left")
    return whole.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"),
        "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
