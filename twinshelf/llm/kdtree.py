"""Exact top-k search by inner product with KD-trees per shard.

Vectors are dealt to shards of about ``SHARD``. A shard's tree splits at the median of the
widest dimension down to leaves of ``LEAF`` vectors; every node has the tight box around its
vectors. The largest inner product that a box allows is the sum over dimensions of the larger
of query times lower and query times upper side. A search takes nodes from a queue, best bound
first, and stops when the bound falls below the k-th score found so far. That score goes along
from one shard to the next, so later shards are pruned by what earlier ones held.

Queries meet shards in blocks: a task searches one block in the few trees of a lane, one tree
after the other, and the lanes' results are merged by rank. Trees and blocks lie in the work folder,
from which a task reads its own, so neither is copied for each meeting nor passes the driver.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import counted_stage, opened, release, shared_uri, stage

SHARD, LEAF = 16_384, 64
#: Queries in a block, the least number of trees that one task searches in turn, and lanes at most.
BLOCK, LANE, LANES = 512, 4, 32
LARGEST = 1 << 53  # integers up to this are exact as doubles


def finite(vector: Column) -> Column:
    """Neither null nor holding a null, infinite or undefined component."""
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


class KdTree:
    """Boxes and leaves over the rows of a matrix; nodes come after their parents."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        order = np.lexsort((ids,))
        self.low, self.high, self.child, self.span = [], [], [], []
        stack = [(0, len(ids), -1)]
        while stack:
            a, z, parent = stack.pop()
            part = vectors[order[a:z]]
            low, high = part.min(axis=0), part.max(axis=0)
            number = len(self.low)
            self.low.append(low)
            self.high.append(high)
            self.child.append([])
            self.span.append((a, z))
            if parent >= 0:
                self.child[parent].append(number)
            if z - a > leaf and (high > low).any():
                widest = int(np.argmax(high - low))
                middle = (z - a) // 2
                order[a:z] = order[a:z][np.argpartition(part[:, widest], middle, kind="introselect")]
                stack += [(a + middle, z, number), (a, a + middle, number)]
        self.low, self.high = np.array(self.low), np.array(self.high)
        self.ids, self.vectors = ids[order], vectors[order]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The largest inner product that each node's box allows for each query."""
        return (np.where(queries > 0, queries, 0) @ self.high.T
                + np.where(queries < 0, queries, 0) @ self.low.T)

    def search(self, query: np.ndarray, own: int, bounds: np.ndarray, best: list, k: int) -> None:
        """Add to ``best``, a heap of (score, -id) with the worst first, of k at most."""
        queue = [(-bounds[0], 0)]
        while queue:
            bound, node = heapq.heappop(queue)
            if len(best) == k and -bound < best[0][0]:
                return
            if self.child[node]:
                for below in self.child[node]:
                    heapq.heappush(queue, (-bounds[below], below))
                continue
            a, z = self.span[node]
            scores = self.vectors[a:z] @ query
            if len(best) == k:
                places = np.flatnonzero(scores >= best[0][0])
            else:
                places = np.arange(z - a)
            for score, name in zip(scores[places].tolist(), self.ids[a:z][places].tolist()):
                found = (int(score), -name)
                if name == own or len(best) == k and found <= best[0]:
                    continue
                (heapq.heapreplace if len(best) == k else heapq.heappush)(best, found)


def matrix(rows: pd.Series, width: int) -> np.ndarray:
    """Integer vectors as a matrix, shorter ones filled with zeros."""
    out = np.zeros((len(rows), width), np.int64)
    for at, row in enumerate(rows):
        out[at, :len(row)] = row
    return out


def exact(a: np.ndarray, b: np.ndarray) -> type:
    """A number type in which inner products of rows of both are exact."""
    size = max(1, int(np.abs(a.astype(object)).max(initial=0))) * max(
        1, int(np.abs(b.astype(object)).max(initial=0))) * max(1, a.shape[1])
    return np.float64 if size < LARGEST else object


def packed(folder: str, column: str, part: int) -> list[bytes]:
    """What a part of a staged table has in its binary column; a part without rows has no folder."""
    fs, path = opened(folder)
    path = f"{path}/part={part}"
    if fs.get_file_info(path).type == pyarrow.fs.FileType.NotFound:
        return []
    return pq.read_table(path, columns=[column], filesystem=fs, partitioning=None,
                         use_threads=False).column(column).to_pylist()


def top_k(
    vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id",
    vector_col: str = "embedding", scale: int = 256, shard: int = SHARD, block: int = BLOCK,
) -> DataFrame:
    """(query_id, rank, id, score): for each row that meets ``queries``, its k best others.

    Vectors are floor(scale * x) per component; null vectors and those with null or non-finite
    components take no part. Shorter vectors count as filled with zeros. Ties go to the lesser
    id. Repeated rows each count, as candidates and as queries; rows of the query's id are its own.
    A null id takes no part. Scores beyond 64 bits are cut to the range of a long. An empty table
    gives an empty result; columns other than the two named play no part.
    """
    rows = vectors.filter(F.col(id_col).isNotNull() & finite(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("long"))
        .alias("v"), F.coalesce(queries, F.lit(False)).alias("asked"),
        F.monotonically_increasing_id().alias("row"))
    rows = stage(rows, "search-vectors")
    n, width, asked = rows.agg(
        F.count("*"), F.max(F.size("v")), F.count_if("asked")).first()
    shards, blocks_ = -(-n // shard) or 1, -(-asked // block) or 1
    width = width or 0

    def build(rows_: pd.DataFrame) -> pd.DataFrame:
        ids, values = rows_["id"].to_numpy(), matrix(rows_["v"], width)
        return pd.DataFrame({"part": rows_["part"].head(1), "tree": [
            pickle.dumps(vars(KdTree(ids, values)))]})

    def pack(rows_: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": rows_["part"].head(1), "asked": [
            pickle.dumps((rows_["id"].to_numpy(), matrix(rows_["v"], width)))]})

    deal = F.xxhash64("row")  # not by value: a third of all rows may be equal

    def apart(some: DataFrame, n: int, make: Callable, column: str) -> str:
        """The folder of ``some`` rows, made into one object for each of n parts."""
        made = some.withColumn("part", F.pmod(deal, F.lit(n))).groupBy("part").applyInPandas(
            make, f"part long, {column} binary")
        staged, _ = counted_stage(made, f"{column}-parts", F.lit(True), parts="part")
        return shared_uri(vectors.sparkSession, staged.staged_at)

    trees = apart(rows, shards, build, "tree")
    asked_blocks = apart(rows.filter("asked"), blocks_, pack, "asked")
    release(rows)
    lane = max(LANE, -(-shards // LANES))
    lanes = -(-shards // lane)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for task in batch["id"].tolist():
                for asked_ in packed(asked_blocks, "asked", task % blocks_):
                    yield meet(*pickle.loads(asked_), task // blocks_)

    def meet(ids: np.ndarray, values: np.ndarray, nth: int) -> pd.DataFrame:
        best: list[list] = [[] for _ in ids]
        for number in range(nth * lane, min((nth + 1) * lane, shards)):
            for held in packed(trees, "tree", number):
                tree = KdTree.__new__(KdTree)
                vars(tree).update(pickle.loads(held))
                kind = exact(tree.vectors, values)
                for name in ("low", "high", "vectors"):
                    setattr(tree, name, getattr(tree, name).astype(kind))
                asked_as = values.astype(kind)
                bounds = tree.bounds(asked_as)
                for at, own in enumerate(ids.tolist()):
                    tree.search(asked_as[at], own, bounds[at], best[at], k)
        out = [(own, -name, max(-(1 << 63), min((1 << 63) - 1, score)))
               for own, found in zip(ids.tolist(), best) for score, name in found]
        return pd.DataFrame(out, columns=["query_id", "id", "score"]).astype("int64")

    found = vectors.sparkSession.range(0, blocks_ * lanes, 1, blocks_ * lanes).mapInPandas(
        search, "query_id long, id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "id", "score")
