"""Hierarchical linkage cut at a distance, by rounds over a table of close pairs.

Every cluster picks its nearest neighbour, equal distances in a fixed order; clusters that pick
each other merge, all over the table at once; the pairs are renamed to the merged
clusters and aggregated; and so on until no pair is left. Complete, average and single linkage
are reducible, so merging mutual nearest neighbours gives the same tree as merging the
globally closest pair each time, and no merge within the cut needs a pair beyond it. Each
round is a handful of partially aggregated shuffles over the remaining pairs. A cluster is named
by its least member id.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import counted_stage, release, stage
from .grid import side_blocks
from .ordering import number_rows
from .similarity import DIGITS, SLACK, cosine_pairs, sparse_dot, sparse_sum

MERGE = "round int, left long, right long, distance double, size long"


def _within(cut: float, inclusive: bool):
    distance, cut = F.col("d"), round(cut, DIGITS)
    return distance <= cut if inclusive else distance < cut


def _mutual(edges: DataFrame) -> DataFrame:
    """Edges that are the best choice of both their ends.

    Equal distances are ordered by a hash of the ends. By id, a group of equally close clusters
    would all choose its least member and merge one per round; by hash, a fixed share of them
    merges each round.
    """
    tie = F.md5(F.concat_ws("-", "a", "b")).alias("tie")
    choice = F.struct("d", tie, "a", "b", "na", "nb").alias("choice")
    ends = edges.select(F.explode(F.array("a", "b")).alias("v"), choice)
    best = ends.groupBy("v").agg(F.min("choice").alias("choice"))
    return (
        best.groupBy("choice").agg(F.count(F.lit(1)).alias("votes"))
        .filter("votes = 2").select("choice.*").drop("tie")
    )


def _renamed(edges: DataFrame, merged: DataFrame) -> DataFrame:
    """Edges under the new names, with how many old clusters stand behind each end."""
    names = merged.select(
        F.explode(F.array("a", "b")).alias("old"),
        F.col("a").alias("new"),
        (F.col("na") + F.col("nb")).alias("n"),
    )
    for side in ("a", "b"):
        end = names.select(
            F.col("old").alias(side), F.col("new").alias(f"{side}_new"),
            F.col("n").alias(f"{side}_n"),
        )
        edges = edges.join(end, side, "left")
    x = F.coalesce("a_new", "a")
    y = F.coalesce("b_new", "b")
    nx = F.coalesce("a_n", "na")
    ny = F.coalesce("b_n", "nb")
    parts = (F.when(F.col("a_new").isNull(), 1).otherwise(2)
             * F.when(F.col("b_new").isNull(), 1).otherwise(2))
    return edges.filter(x != y).select(
        F.least(x, y).alias("a"), F.greatest(x, y).alias("b"), "d",
        F.when(x < y, nx).otherwise(ny).alias("na"),
        F.when(x < y, ny).otherwise(nx).alias("nb"),
        parts.alias("parts"),
    )


class _Sums:
    """Sums of the clusters' vectors: one table at first, and one of the merged clusters a round.

    A cluster's sum stands in the last table that has its id. Every ``TABLES`` rounds the current
    ones are written together.
    """

    TABLES = 12

    def __init__(self, sides: DataFrame, sizes: DataFrame):
        def whole(column: str) -> Column:
            return F.transform(column, lambda e: F.struct(
                e.number.alias("number"), (e.weight * F.col("copies")).alias("weight"))).alias(column)

        self.tables = [stage(sides.join(sizes, "id").select("id", whole("a"), whole("b")), "sums")]

    def current(self, ids: DataFrame | None = None) -> DataFrame:
        """(id, a, b) of the given ids, or of all that have not been merged into another."""
        versions = rows = None
        for version, table in enumerate(self.tables):
            marked = table.withColumn("version", F.lit(version))
            rows = marked if rows is None else rows.unionByName(marked)
        versions = rows.select("id", "version") if ids is None else rows.select("id", "version").join(ids, "id")
        last = versions.groupBy("id").agg(F.max("version").alias("version"))
        return rows.join(last, ["id", "version"]).drop("version")

    def merge(self, merged: DataFrame) -> None:
        """The sums of merged clusters, each under its less id."""
        left = self.current(merged.select(F.col("a").alias("id"))).toDF("left", "la", "lb")
        right = self.current(merged.select(F.col("b").alias("id"))).toDF("right", "ra", "rb")
        pairs = merged.select(F.col("a").alias("left"), F.col("b").alias("right"))

        def added(x: str, y: str) -> Column:
            return sparse_sum(*[F.col(f"{c}.{f}") for c in (x, y) for f in ("number", "weight")])

        table = stage(pairs.join(left, "left").join(right, "right").select(
            F.col("left").alias("id"), added("la", "ra").alias("a"), added("lb", "rb").alias("b")), "sums")
        self.tables.append(table)
        if len(self.tables) > self.TABLES:
            whole = stage(self.current(), "sums")
            for old in self.tables:
                release(old)
            self.tables = [whole]

    def distances(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` (a, b, na, nb) with the mean distance ``d`` of their records."""
        ends = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        sums = self.current(ends)
        left = sums.select(F.col("id").alias("a"), F.col("a").alias("x"))
        right = sums.select(F.col("id").alias("b"), F.col("b").alias("y"))
        near = sparse_dot("x.number", "x.weight", "y.number", "y.weight")
        return pairs.join(left, "a").join(right, "b").select(
            "a", "b", F.round(1.0 - near / (F.col("na") * F.col("nb")), DIGITS).alias("d"), "na", "nb")


EDGE = ["a", "b", "d", "na", "nb"]
#: Edges whose remaining rounds one task goes through: many short jobs would take longer.
FINISH = 1_000_000


def _chosen(a: np.ndarray, b: np.ndarray, d: np.ndarray, names: np.ndarray) -> np.ndarray:
    """The places of the edges that are the best choice of both their ends, as ``_mutual`` has them."""
    least = np.full(len(names), np.inf)
    for end in (a, b):
        np.minimum.at(least, end, d)
    # Only equal distances go by the hash, and only edges that are least at both ends can be chosen.
    at_a, at_b = d == least[a], d == least[b]
    some = np.flatnonzero(at_a | at_b)
    x, y = a[some], b[some]
    crowd = np.bincount(np.concatenate((x[at_a[some]], y[at_b[some]])), minlength=len(names)) > 1
    tied = crowd[x] & at_a[some] | crowd[y] & at_b[some]
    tie = np.zeros(len(some), "S32")
    tie[tied] = [hashlib.md5(f"{v}-{w}".encode()).hexdigest() for v, w in zip(
        names[x[tied]].tolist(), names[y[tied]].tolist())]
    place = np.empty(len(some), np.int64)
    place[np.lexsort((y, x, tie))] = np.arange(len(some))
    best = np.full(len(names), len(some))
    for end, there in ((x, at_a[some]), (y, at_b[some])):
        np.minimum.at(best, end[there], place[there])
    return some[(best[x] == place) & (best[y] == place)]


def _finished(edges: DataFrame, method: str, after_round: int, by: Sequence[str] = ()) -> DataFrame:
    """The merges of all rounds over at most ``FINISH`` edges of each group, the same as job by job."""
    def merged(part: pd.DataFrame) -> pd.DataFrame:
        names = np.unique(np.concatenate([part["a"].to_numpy(), part["b"].to_numpy()]))
        a, b = (np.searchsorted(names, part[end].to_numpy()) for end in "ab")
        d, na, nb = (part[column].to_numpy() for column in ("d", "na", "nb"))
        out = []
        for step in count(after_round + 1):
            if not len(a):
                return pd.concat(out)
            pair = _chosen(a, b, d, names)
            size = na[pair] + nb[pair]
            out.append(pd.DataFrame({"round": step, "left": names[a[pair]], "right": names[b[pair]],
                                     "distance": d[pair], "size": size}))
            new, grown, olds = np.arange(len(names)), np.zeros(len(names), np.int64), np.ones(len(names), int)
            new[b[pair]] = a[pair]
            grown[a[pair]] = grown[b[pair]] = size
            olds[a[pair]] = olds[b[pair]] = 2
            x, y, parts = new[a], new[b], olds[a] * olds[b]
            nx, ny = np.where(olds[a] > 1, grown[a], na), np.where(olds[b] > 1, grown[b], nb)
            left, less = x != y, x < y
            x, y, nx, ny = (np.where(less, v, w)[left] for v, w in ((x, y), (y, x), (nx, ny), (ny, nx)))
            d, parts, key = d[left], parts[left], x * len(names) + y
            order = np.argsort(key, kind="stable")

            def starts(*columns: np.ndarray) -> np.ndarray:
                first = np.ones(len(key), bool)
                first[1:] = np.any([c[order][1:] != c[order][:-1] for c in columns], axis=0)
                return np.flatnonzero(first)

            first = starts(key)
            if len(starts(key, nx, ny, parts)) > len(first):  # one name with several sizes
                order = np.lexsort((parts, ny, nx, key))
                first = starts(key, nx, ny, parts)
            x, y, nx, ny, parts = (c[order][first] for c in (x, y, nx, ny, parts))
            d = (np.maximum if method == "complete" else np.minimum).reduceat(
                d[order], first) if len(first) else d[:0]
            if method == "complete":
                # A missing part pair lies beyond the cut, and so does the merged pair.
                whole = np.diff(np.append(first, len(key))) == parts
                x, y, nx, ny, d = (c[whole] for c in (x, y, nx, ny, d))
            a, b, na, nb = x, y, nx, ny

    return edges.groupBy(*by).applyInPandas(lambda part: merged(part[EDGE]), MERGE)


def _by_components(
    edges: DataFrame, left: int, cut: float, inclusive: bool, method: str, after_round: int,
) -> tuple[DataFrame, int]:
    """``_rounds`` over edges whose connected components do not touch each other.

    Components of at most half of ``FINISH`` edges are dealt to tasks, each of which goes through
    all rounds of its own; a round's number is the same as if all were gone through together. The
    edges of larger components go on by jobs.
    """
    ends = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    of = stage(components(ends, edges.select("a", "b")), "components")
    held = edges.join(of.toDF("a", "part"), "a")
    large = held.groupBy("part").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "large", F.col("n") > FINISH // 2).select("part", "large")
    dealt, rest = counted_stage(held.join(large, "part").select(
        *EDGE, "large", F.pmod(F.xxhash64("part"), F.lit(-(-4 * left // FINISH))).alias("lane")),
        "dealt", F.col("large"), "large")
    release(of)
    merges = stage(_finished(dealt.filter("NOT large"), method, after_round, ["lane"]), "last-merges")
    last = merges.agg(F.max("round")).first()[0] or after_round
    if rest:
        found, late = _rounds(dealt.filter("large").select(*EDGE), cut, inclusive, method,
                              after_round=after_round, apart=False)
        merges, last = merges.unionByName(found), max(last, late)
    return merges, last


def _rounds(
    edges: DataFrame, cut: float, inclusive: bool, method: str, sums: _Sums | None = None,
    after_round: int = 0, apart: bool = True,
) -> tuple[DataFrame | None, int]:
    """(merges, the last round) over staged ``edges`` within the cut, from ``after_round`` on."""
    merges = table = None
    left = edges.count()
    if method != "average" and apart and left > FINISH > 1:
        return _by_components(edges, left, cut, inclusive, method, after_round)
    for step in count(after_round + 1):  # every round merges a pair at least
        if not left:
            return merges, step - 1
        if method != "average" and left <= FINISH:
            rest = stage(_finished(edges, method, step - 1), "last-merges")
            last = rest.agg(F.max("round")).first()[0]
            return rest if merges is None else merges.unionByName(rest), last
        merged = _mutual(edges)
        if method == "average":
            merged = stage(merged, "merged")
            sums.merge(merged)
        renamed = _renamed(edges, merged)
        if method == "average":
            # Only distances of clusters that changed are found anew.
            same = renamed.filter("parts = 1").select(*EDGE)
            met = renamed.filter("parts > 1").select("a", "b", "na", "nb").distinct()
            after = same.unionByName(
                sums.distances(stage(met, "met")).filter(_within(cut, inclusive)))
        else:
            after = renamed.groupBy("a", "b", "na", "nb", "parts").agg(
                F.count(F.lit(1)).alias("seen"),
                (F.max("d") if method == "complete" else F.min("d")).alias("d"),
            )
            if method == "complete":
                # A missing part pair lies beyond the cut, and so does the merged pair.
                after = after.filter("seen = parts")
        # The merges and the edges after them go to one table, so a round is one job.
        rows = merged.select(F.lit(True).alias("merge"), *EDGE).unionByName(
            after.select(F.lit(False).alias("merge"), *EDGE)
        )
        before, (table, left) = table, counted_stage(rows, "round", ~F.col("merge"), "merge")
        if before is not None:
            release(before, "merge=false")
        part = table.filter("merge").select(
            F.lit(step).alias("round"), F.col("a").alias("left"), F.col("b").alias("right"),
            F.col("d").alias("distance"), (F.col("na") + F.col("nb")).alias("size"),
        )
        merges = part if merges is None else merges.unionByName(part)
        if step % 50 == 0:
            merges = stage(merges, "merges")
        edges = table.filter(~F.col("merge")).select(*EDGE)


def _edges(pairs: DataFrame, sizes: DataFrame, cut: float, inclusive: bool) -> DataFrame:
    """The pairs within the cut with the sizes of their ends, staged.

    The pairs are written first: where Spark cannot tell how many there are, it would broadcast them.
    """
    n = sizes.select("id", "copies")
    near = stage(pairs.select("a", "b", F.round(1.0 - F.col("sim"), DIGITS).alias("d"))
                 .filter(_within(cut, inclusive)), "near")
    edges = stage(
        near.join(n.select(F.col("id").alias("a"), F.col("copies").alias("na")), "a")
        .join(n.select(F.col("id").alias("b"), F.col("copies").alias("nb")), "b")
        .select(*EDGE), "edges")
    release(near)
    return edges


def linkage(
    pairs: DataFrame, sizes: DataFrame, cut: float, method: str = "complete",
    inclusive: bool = False, sides: DataFrame | None = None,
) -> DataFrame:
    """Merges (round, left, right, distance, size) up to ``cut``.

    ``pairs`` (a, b, sim) must hold every pair within the cut, ``sizes`` (id, copies) the
    record count of each id. ``method`` is complete, single or average; average linkage needs
    ``sides`` (id, a, b), sparse vectors whose product a·b of two ids is their similarity, and
    takes its distances from cluster sums. The ``size`` counts records. Single linkage by rounds
    takes as many as a chain is long; ``single_linkage`` gives the same tree in few.
    """
    if method not in ("complete", "single", "average"):
        raise ValueError(f"unknown method {method}")
    edges = _edges(pairs, sizes, cut, inclusive)
    sums = _Sums(sides, sizes.select("id", "copies")) if method == "average" else None
    merges, _ = _rounds(edges, cut, inclusive, method, sums)
    return _staged(merges, pairs.sparkSession)


def _staged(merges: DataFrame | None, spark) -> DataFrame:
    return spark.createDataFrame([], MERGE) if merges is None else stage(merges, "merges")


#: Members of a cluster that are compared with those of another at a time, and partners of these.
MEMBERS, PARTNERS = 256, 64


def _farthest(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """``pairs`` (a, b) of clusters with ``sim``, the least similarity between their members.

    ``members`` (id, cluster, vector). Clusters are cut into pieces, and a piece is compared with
    the pieces of its partners, so no task holds a whole cluster or all of its partners.
    """
    held = members.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).alias("pieces"))
    pieces = stage(members.join(held, "cluster").withColumn(
        "piece", F.pmod(F.xxhash64("id"), "pieces")).groupBy("cluster", "piece").agg(
        F.collect_list("vector.number").alias("numbers"),
        F.collect_list("vector.weight").alias("weights")), "cluster-pieces")
    ends = pieces.select("cluster", "piece")
    met = pairs.join(ends.toDF("a", "ap"), "a").join(ends.toDF("b", "bp"), "b")
    crowd = met.groupBy("a", "ap").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).alias("lanes"))
    met = met.join(crowd, ["a", "ap"]).withColumn("lane", F.pmod(F.xxhash64("b", "bp"), "lanes"))
    hosts = met.select("a", "ap", "lane").distinct().join(
        pieces.toDF("a", "ap", "numbers", "weights"), ["a", "ap"])
    guests = met.select("a", "ap", "lane", "b", "bp").join(
        pieces.toDF("b", "bp", "numbers", "weights"), ["b", "bp"])

    def compare(host: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        if not len(host) or not len(others):
            return pd.DataFrame({"a": [], "b": [], "sim": []})
        one = host.iloc[0]
        known = np.unique(np.concatenate(list(one["numbers"])))
        ours = _rows(one["numbers"], one["weights"], known)
        least = [(ours @ _rows(n, w, known).T).min() for n, w in zip(others["numbers"], others["weights"])]
        return pd.DataFrame({"a": one["a"], "b": others["b"], "sim": least})

    guests = guests.toDF(*guests.columns)  # or both sides' columns go by one name
    where = ["a", "ap", "lane"]
    least = hosts.groupBy(*where).cogroup(guests.groupBy(*where)).applyInPandas(
        compare, "a long, b long, sim double")
    return least.groupBy("a", "b").agg(F.min("sim").alias("sim"))


def _rows(numbers, weights, known: np.ndarray) -> np.ndarray:
    """Sparse vectors written out over the ``known`` numbers."""
    out = np.zeros((len(numbers), len(known)))
    for row, (n, w) in enumerate(zip(numbers, weights)):
        at = np.minimum(np.searchsorted(known, n), len(known) - 1)
        here = known[at] == n
        out[row, at[here]] = np.asarray(w)[here]
    return out


def complete_by_bands(
    vectors: DataFrame, sizes: DataFrame, cut: float, inclusive: bool = False,
    bands: Sequence[float] = (0.25, 0.5, 0.75),
) -> DataFrame:
    """Merges of complete linkage up to a loose ``cut``, without a table of all pairs within it.

    ``vectors`` (id, vector) are unit vectors, ``sizes`` (id, copies) as for ``linkage``. The pairs
    within the first band, a share of the cut, are found and merged. From then on a cluster is
    stood for by its least member: clusters whose members are all within the next band have
    members that stand for them within it, and a mean similarity no less than the band's, which
    their sums tell. Only the pairs left are compared member by member. Merges come in order
    of distance, so those of a lower band are those of the whole cut.
    """
    spark = vectors.sparkSession
    copies = sizes.select("id", "copies")
    merges, last, held = None, 0, copies
    for share in [*sorted(bands), 1.0]:
        top = cut if share == 1.0 else cut * share
        within = inclusive if share == 1.0 else True
        stand = vectors.join(held.select("id"), "id")
        pairs = cosine_pairs(stand, max(1.0 - top, SLACK))
        if merges is not None:
            of = clusters(copies.select("id"), merges)
            members = stage(vectors.join(of, "id").select("id", "cluster", "vector"), "members")
            pairs = _loose(stage(pairs, "standing"), members, top)
        found, last = _rounds(_edges(pairs, held, top, within), top, within, "complete",
                              after_round=last)
        if found is not None:
            merges = stage(found if merges is None else merges.unionByName(found), "merges")
            of = clusters(copies.select("id"), merges)
            held = stage(copies.join(of, "id").groupBy(F.col("cluster").alias("id")).agg(
                F.sum("copies").alias("copies")), "held")
    return _staged(merges, spark)


def _loose(pairs: DataFrame, members: DataFrame, top: float) -> DataFrame:
    """(a, b, sim) of clusters by their least similar members, of those that may be within ``top``."""
    counts = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    large = counts.filter("n > 1")
    both = pairs.join(counts.toDF("a", "an"), "a").join(counts.toDF("b", "bn"), "b")
    single = both.filter("an = 1 AND bn = 1").select("a", "b", "sim")
    entries = members.join(large, "cluster").select("cluster", F.explode("vector").alias("e"))
    means = entries.groupBy("cluster", "e.number").agg(F.sum("e.weight").alias("weight")).groupBy(
        "cluster").agg(F.sort_array(F.collect_list(F.struct("number", "weight"))).alias("sum"))
    alone = members.join(counts.filter("n = 1"), "cluster").select("cluster", F.transform(
        "vector", lambda e: F.struct(e.number.alias("number"), e.weight.alias("weight"))).alias("sum"))
    means = stage(means.unionByName(alone), "cluster-sums")
    near = sparse_dot("x.number", "x.weight", "y.number", "y.weight") / (F.col("an") * F.col("bn"))
    likely = both.filter("an > 1 OR bn > 1").join(means.toDF("a", "x"), "a").join(
        means.toDF("b", "y"), "b").withColumn("mean", near).filter(
        F.col("mean") >= 1.0 - top - SLACK).select("a", "b")
    return single.unionByName(_farthest(stage(likely, "likely"), members))


#: Edges of a spanning forest that one task puts in order.
FOREST = 50_000


def single_linkage(pairs: DataFrame, sizes: DataFrame, cut: float, inclusive: bool = False) -> DataFrame:
    """Merges (round, left, right, distance, size) of single linkage up to ``cut``.

    They are the minimum spanning forest of the pairs, which Borůvka's rounds find: every component
    takes its least edge to another, all over the table at once, and the components those edges
    connect are one from then on, so their number at least halves in a round. Edges are ordered
    by distance, then by a hash of their ends. The forest's edges in that order are the merges: an
    edge merges the two clusters that lesser ones have made. ``round`` is its place.
    """
    spark = pairs.sparkSession
    tie = F.md5(F.concat_ws("-", "a", "b")).alias("tie")
    near = _edges(pairs, sizes, cut, inclusive)
    edges = stage(near.select(
        F.struct("d", tie, "a", "b").alias("edge"), F.col("a").alias("x"), F.col("b").alias("y")), "edges")
    release(near)
    forest = None
    while edges.limit(1).count():
        ends = edges.select(F.explode(F.array("x", "y")).alias("v"), "edge", "x", "y")
        chosen = stage(ends.groupBy("v").agg(F.min(F.struct("edge", "x", "y")).alias("least"))
                       .select("least.*").distinct(), "chosen")
        part = chosen.select("edge.*")
        forest = part if forest is None else forest.unionByName(part)
        of = stage(components(edges.select(F.explode(F.array("x", "y")).alias("id")).distinct(),
                              chosen.select(F.col("x").alias("a"), F.col("y").alias("b"))), "components")
        moved = edges.join(of.toDF("x", "cx"), "x").join(of.toDF("y", "cy"), "y").filter("cx <> cy")
        # Of parallel edges between two components only the least can be in the forest.
        moved = moved.groupBy(F.least("cx", "cy").alias("x"), F.greatest("cx", "cy").alias("y")).agg(
            F.min("edge").alias("edge"))
        before, edges = edges, stage(moved, "edges")
        release(before)
        release(of)
    if forest is None:
        return spark.createDataFrame([], MERGE)
    return stage(_in_order(stage(forest, "forest"), sizes.select("id", "copies")), "merges")


def _in_order(forest: DataFrame, sizes: DataFrame) -> DataFrame:
    """The forest's edges (d, tie, a, b) as merges of the clusters that all lesser edges have made.

    The edges are numbered and the numbers halved again and again: what the lower half of a
    range connects is one vertex to its upper half, and both halves go on by themselves, all
    ranges at once, until one has ``FOREST`` edges, which a task goes through one by one.
    """
    numbered = number_rows(forest, ["d", "tie", "a", "b"], "round")
    rows = numbered.join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b").select(
        (F.col("round") - 1).alias("at"), "d", F.col("a").alias("x"), F.col("na").alias("nx"),
        F.col("b").alias("y"), F.col("nb").alias("ny"))
    rows, total = counted_stage(rows, "ordered", F.lit(True))
    width = 1
    while width < total:
        width *= 2
    while width > FOREST:
        part = F.floor(F.col("at") / width).alias("part")
        lower = F.col("at") % width < width // 2
        low = rows.filter(lower).select(part, "x", "nx", "y", "ny")
        vertex = F.struct("part", F.col("v")).alias("id")
        ends = low.select("part", F.explode(F.array(
            F.struct(F.col("x").alias("v"), F.col("nx").alias("n")),
            F.struct(F.col("y").alias("v"), F.col("ny").alias("n")))).alias("e")).select(
            "part", "e.*").distinct()
        links = low.select(F.struct("part", F.col("x").alias("v")).alias("a"),
                           F.struct("part", F.col("y").alias("v")).alias("b"))
        of = components(ends.select(vertex), links).join(ends.select(vertex, "n"), "id")
        whole = of.groupBy("cluster").agg(F.sum("n").alias("n"))
        of = stage(of.select("id", "cluster").join(whole, "cluster").select(
            F.col("id.part").alias("part"), F.col("id.v").alias("v"),
            F.col("cluster.v").alias("c"), "n"), "halves")
        upper = rows.filter(~lower).withColumn("part", part)
        for end in ("x", "y"):
            upper = upper.join(of.toDF("part", end, f"c{end}", f"m{end}"), ["part", end], "left").withColumns({
                end: F.coalesce(f"c{end}", end), f"n{end}": F.coalesce(f"m{end}", f"n{end}")})
        before, rows = rows, stage(
            rows.filter(lower).unionByName(upper.select(*rows.columns)), "ordered")
        release(before)
        width //= 2

    def merged(part: pd.DataFrame) -> pd.DataFrame:
        top, size, out = {}, {}, []

        def found(v: int, n: int) -> int:
            if v not in top:
                top[v], size[v] = v, n
            while top[v] != v:
                top[v] = v = top[top[v]]
            return v

        for at, d, x, nx, y, ny in part.sort_values("at").itertuples(index=False):
            left, right = sorted((found(x, nx), found(y, ny)))
            top[right] = left
            size[left] += size[right]
            out.append((at + 1, left, right, d, size[left]))
        return pd.DataFrame(out, columns=["round", "left", "right", "distance", "size"])

    return rows.groupBy(F.floor(F.col("at") / width)).applyInPandas(
        lambda part: merged(part[["at", "d", "x", "nx", "y", "ny"]]), MERGE)


#: Clusters that one task links to the end.
FEW = 256


def ward(vectors: DataFrame, sizes: DataFrame) -> DataFrame:
    """All merges (round, left, right, distance, size) of Ward's linkage of ``vectors`` (id, vector).

    A cluster is its size, the sum of its vectors and the sum of their squared lengths. The distance
    of two is the root of 2·m·n / (m + n) times the squared distance of their means. In a round
    clusters that are each other's nearest merge; a cluster's nearest stays so until it is
    merged, so only new clusters and those that lost their nearest look for one, block by
    block against all others. The last ``FEW`` clusters are linked in one task.
    """
    spark = vectors.sparkSession
    held = vectors.join(sizes.select("id", "copies"), "id").select(
        "id", F.col("copies").cast("double").alias("n"), F.lit(0).alias("born"),
        F.col("vector.number").alias("numbers"),
        F.transform("vector", lambda e: e.weight * F.col("copies")).alias("weights"))
    held, left = counted_stage(held, "ward", F.lit(True))
    merges, nearest = None, None
    for step in count(1):
        if left <= FEW:
            last = held.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(
                lambda part: _ward_to_the_end(part, step), MERGE)
            return stage(last if merges is None else merges.unionByName(last), "merges")
        if nearest is None:
            looking = held.select("id")
        else:
            alive = held.select(F.col("id").alias("other"), "born")
            # A nearest that merged is gone, or goes on as a new cluster under the same id.
            kept = nearest.join(held.filter(F.col("born") < step - 1).select("id"), "id", "left_semi").join(
                alive.filter(F.col("born") < step - 1).select("other"), "other", "left_semi")
            looking = held.select("id").join(kept, "id", "left_anti")
        found = _nearest(held, looking)
        if nearest is not None:
            found = found.unionByName(kept.select(*found.columns))
        before, nearest = nearest, stage(found, "nearest")
        if before is not None:
            release(before)
        pair = [F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"), "d"]
        merged = stage(nearest.select(*pair).groupBy("a", "b").agg(
            F.count(F.lit(1)).alias("votes"), F.min("d").alias("d")).filter("votes = 2"), "merged")
        names = merged.select(F.explode(F.array("a", "b")).alias("id"), F.col("a").alias("to"))
        moved = held.join(names, "id")
        sums = moved.select(F.col("to").alias("id"), "n", F.arrays_zip("numbers", "weights").alias("v"),
                            (F.col("id") == F.col("to")).alias("first"))
        ours = sums.filter("first").select("id", "n", F.col("v").alias("x"))
        theirs = sums.filter("NOT first").select("id", F.col("n").alias("m"), F.col("v").alias("y"))
        joined = ours.join(theirs, "id").withColumn("s", sparse_sum(
            "x.numbers", "x.weights", "y.numbers", "y.weights"))
        new = joined.select("id", (F.col("n") + F.col("m")).alias("n"), F.lit(step).alias("born"),
                            F.col("s.number").alias("numbers"), F.col("s.weight").alias("weights"))
        part = new.select("id", "n").join(merged, new["id"] == merged["a"]).select(
            F.lit(step).alias("round"), F.col("a").alias("left"), F.col("b").alias("right"),
            F.col("d").alias("distance"), F.col("n").cast("long").alias("size"))
        part = stage(part, "merges")
        merges = part if merges is None else merges.unionByName(part)
        old, (held, left) = held, counted_stage(
            held.join(names, "id", "left_anti").unionByName(new), "ward", F.lit(True))
        release(old)


def _ward_distances(left: pd.DataFrame, right: pd.DataFrame) -> np.ndarray:
    known = np.unique(np.concatenate([*left["numbers"], *right["numbers"], np.empty(0, np.int64)]))
    n, m = left["n"].to_numpy()[:, None], right["n"].to_numpy()[None, :]
    x = _rows(left["numbers"], left["weights"], known) / n
    y = _rows(right["numbers"], right["weights"], known) / m.T
    apart = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * x @ y.T
    return np.sqrt(np.maximum(np.round(2 * n * m / (n + m) * apart, 10), 0.0))


def _nearest(held: DataFrame, looking: DataFrame) -> DataFrame:
    """(id, other, d): the nearest other cluster of each one in ``looking``."""
    every = held.select(F.lit(0).alias("all"), *held.columns)
    ours, theirs = side_blocks(every.join(looking, "id", "left_semi"), every, ["all"], block=512)

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"id": [], "other": [], "d": []})
        d = _ward_distances(left, right)
        a, b = left["id"].to_numpy()[:, None], right["id"].to_numpy()[None, :]
        d[a == b] = np.inf
        i, j = np.nonzero((d == d.min(axis=1, keepdims=True)) & (a != b))
        return pd.DataFrame({"id": a[i, 0], "other": b[0, j], "d": d[i, j]})

    theirs = theirs.toDF(*theirs.columns)
    where = ["all", "_p", "_q"]
    met = ours.groupBy(*where).cogroup(theirs.groupBy(*where)).applyInPandas(
        best, "id long, other long, d double")
    tie = F.md5(F.concat_ws("-", F.least("id", "other"), F.greatest("id", "other")))
    return met.groupBy("id").agg(F.min(F.struct("d", tie.alias("tie"), "other")).alias("least")).select(
        "id", "least.other", "least.d")


def _ward_to_the_end(part: pd.DataFrame, step: int) -> pd.DataFrame:
    """The merges of a few clusters one by one, by the recurrence of Lance and Williams."""
    part = part.sort_values("id", ignore_index=True)
    ids, n = part["id"].tolist(), part["n"].to_numpy(float).copy()
    d = _ward_distances(part, part) ** 2
    np.fill_diagonal(d, np.inf)
    alive, out = np.ones(len(ids), bool), []
    tie = {}
    for _ in range(len(ids) - 1):
        seen = np.round(d, 10)
        low = seen.min()
        near = np.argwhere(np.triu(seen == low, 1)).tolist()
        i, j = min(near, key=lambda p: tie.setdefault(tuple(p), hashlib.md5(
            f"{ids[p[0]]}-{ids[p[1]]}".encode()).hexdigest()))
        out.append((step, ids[i], ids[j], math.sqrt(max(low, 0.0)), int(n[i] + n[j])))
        rest = alive & (np.arange(len(ids)) != i) & (np.arange(len(ids)) != j)
        grown = ((n[i] + n) * d[i] + (n[j] + n) * d[j] - n * d[i, j]) / (n[i] + n[j] + n)
        d[i, rest] = d[rest, i] = grown[rest]
        d[j, :] = d[:, j] = np.inf
        n[i] += n[j]
        alive[j] = False
        step += 1
    return pd.DataFrame(out, columns=["round", "left", "right", "distance", "size"])


def cut_to(merges: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """The merges of a whole tree that leave ``k`` clusters of the ``ids``: all but the highest.

    Equal heights go by round, ``left`` and ``right``. A merge stands above those that it is made of, as
    distances do not fall on the way up.
    """
    if k < 1:
        raise ValueError("at least one cluster is left")
    keep = max(0, ids.count() - k)
    ordered = number_rows(merges, ["distance", "round", "left", "right"], "place")
    return ordered.filter(F.col("place") <= keep).drop("place")


def clusters(ids: DataFrame, merges: DataFrame) -> DataFrame:
    """(id, cluster) for every id: follow the merges to the least member.

    Each merge retires its right cluster once, so the merges form a forest. Its depth is at
    most the number of rounds, and every pass halves what is left of it.
    """
    parents = merges.select(F.col("right").alias("id"), F.col("left").alias("up"), "round")
    rounds = parents.agg(F.max("round")).first()[0] or 0
    parents = parents.drop("round")
    depth = 1
    while depth < rounds:
        above = parents.select(F.col("id").alias("up"), F.col("up").alias("top"))
        parents = parents.join(above, "up", "left").select(
            "id", F.coalesce("top", "up").alias("up")
        )
        if rounds > 16:  # each pass names the one before it twice
            parents = stage(parents, "parents")
        depth *= 2
    return ids.join(parents, "id", "left").select(
        "id", F.coalesce("up", "id").alias("cluster")
    )


def components(ids: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, cluster): connected components, which is single linkage at the pairs' cut.

    A round has three steps. Every vertex sees the least label among itself and its
    neighbours; every label hooks on to the least label that one of its vertices saw; every
    vertex, now under that label, takes the label of its label, as labels are vertices too.
    Whole trees of labels move at once and paths double, so long chains take a logarithmic
    number of rounds. The loop ends when no vertex sees a lower label, which every
    graph reaches, as each round before that retires a label. Neighbours and vertices are
    reduced by ``min`` with partial aggregation, so a hub is no special case.
    """
    # Both ways at once, so the pairs are found once.
    both = F.array(*[F.struct(F.col(x).alias("id"), F.col(y).alias("other"))
                     for x, y in ("ab", "ba")])
    links = stage(pairs.select(F.inline(both)), "links")
    labels = stage(links.groupBy("id").agg(
        F.least(F.col("id"), F.min("other")).alias("label")
    ), "labels")
    while True:
        seen = links.join(labels.toDF("other", "near"), "other").groupBy("id").agg(
            F.min("near").alias("near")
        )
        looked, moving = counted_stage(
            labels.join(seen, "id").select(
                "id", F.col("label").alias("old"), F.least("label", "near").alias("low")),
            "looked", F.col("low") < F.col("old"),
        )
        if not moving:
            release(looked)
            return ids.join(labels, "id", "left").select(
                "id", F.coalesce("label", "id").alias("cluster")
            )
        hooks = looked.groupBy("old").agg(F.min("low").alias("up"))
        hooked = looked.join(hooks, "old").select("id", F.col("up").alias("label"))
        settled = stage(hooked.join(hooked.toDF("label", "top"), "label").select(
            "id", F.col("top").alias("label")), "labels")
        release(looked)
        release(labels)
        labels = settled


def merge_tree(merges: DataFrame) -> DataFrame:
    """The merges as a numbered table in order of distance."""
    return number_rows(merges, ["distance", "left", "right"], "step")
