"""Exact similarity joins on sparse and dense unit vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import counted_stage, opened, shared_uri, stage
from .grid import side_blocks, self_pairs

DIGITS = 12
SLACK = 1e-9
# Share of a bound that may lie beyond the common terms looked at. A larger share means fewer
# term matches to sum up and more pairs to compare in full.
LOOSE = 0.92


@F.arrow_udf(T.DoubleType())
def sparse_dot(an: pa.Array, aw: pa.Array, bn: pa.Array, bw: pa.Array) -> pa.Array:
    """Dot products of two columns of sparse vectors, the whole batch at once.

    Term numbers rise within a vector, so (row, term) codes rise over the batch and one
    binary search finds all shared terms. A missing vector is empty.
    """
    rows = len(an)

    def flat(numbers: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        sizes = numbers.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        return np.repeat(np.arange(rows), sizes), numbers.flatten().to_numpy()

    a_row, a_term = flat(an)
    b_row, b_term = flat(bn)
    if not len(a_term) or not len(b_term):
        return pa.array(np.zeros(rows))
    terms, code = np.unique(np.concatenate([a_term, b_term]), return_inverse=True)
    a_code = a_row * len(terms) + code[: len(a_term)]
    b_code = b_row * len(terms) + code[len(a_term):]
    at = np.minimum(np.searchsorted(b_code, a_code), len(b_code) - 1)
    shared = b_code[at] == a_code
    product = aw.flatten().to_numpy()[shared] * bw.flatten().to_numpy()[at[shared]]
    return pa.array(np.bincount(a_row[shared], weights=product, minlength=rows))


_SPARSE = T.ArrayType(T.StructType([
    T.StructField("number", T.LongType()), T.StructField("weight", T.DoubleType())]))


@F.arrow_udf(_SPARSE)
def sparse_sum(an: pa.Array, aw: pa.Array, bn: pa.Array, bw: pa.Array) -> pa.Array:
    """Sums of two columns of sparse vectors, numbers rising; a missing vector is empty."""
    rows = len(an)
    row, number, weight = [], [], []
    for numbers, weights in ((an, aw), (bn, bw)):
        sizes = numbers.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        row.append(np.repeat(np.arange(rows), sizes))
        number.append(numbers.flatten().to_numpy())
        weight.append(weights.flatten().to_numpy())
    row, number, weight = map(np.concatenate, (row, number, weight))
    order = np.lexsort((number, row))
    row, number, weight = row[order], number[order], weight[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (number[1:] != number[:-1])
    first = np.flatnonzero(new)
    total = np.add.reduceat(weight, first) if len(first) else weight
    entries = pa.StructArray.from_arrays(
        [pa.array(number[first], pa.int64()), pa.array(total, pa.float64())], ["number", "weight"])
    ends = np.concatenate(([0], np.cumsum(np.bincount(row[first], minlength=rows))))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), entries)


def weighted_pairs(
    vectors: DataFrame, weights: dict[str, float], at_least: float,
) -> DataFrame:
    """Pairs (a, b, sim) with ``sum(weight * cosine) >= at_least``, each once, a < b.

    ``vectors`` has ``id`` and one vector column per feature. A feature that no match can do
    without must itself reach ``(at_least - other weights) / weight``; all such features
    together form the join key, so a popular value of one of them (a brand) does not bring
    all its records together. If every feature is dispensable, some feature must still
    reach ``at_least / sum(weights)`` and each is joined on its own.

    The join runs rarest term first. What a pair can still gain from a common term on is at
    most the product of the two vectors' lengths from there on (``tail``). Common terms whose
    product is below ``LOOSE`` of the feature's bound are not looked at, so those looked at must
    make up the rest, and only pairs that pass are compared in full. Popular terms stand at
    the end of the vectors, where the product is small.
    """
    if at_least <= 0:
        raise ValueError("at_least must be positive: otherwise every pair qualifies")
    total = sum(weights.values())
    bounds = {f: (at_least - (total - w)) / w for f, w in weights.items()}
    needed = {f: b for f, b in bounds.items() if b > SLACK}
    searches = [needed] if needed else [{f: at_least / total} for f in weights]
    found = None
    for search in searches:
        index = vectors.select("id", F.lit(1.0).alias("share"), *search)
        for feature, bound in search.items():
            index = index.withColumn(feature, F.explode(feature)).filter(
                F.col(f"{feature}.tail") >= LOOSE * bound - SLACK
            ).withColumns({
                "share": F.col("share") * F.col(f"{feature}.weight"),
                f"{feature}_tail": F.col(f"{feature}.tail"),
                feature: F.col(f"{feature}.number"),
            })
        met = self_pairs(index, list(search))
        for feature, bound in search.items():
            reach = F.col(f"a_{feature}_tail") * F.col(f"b_{feature}_tail")
            met = met.filter(reach >= LOOSE * bound - SLACK)
        least = math.prod((1 - LOOSE) * bound for bound in search.values())
        met = (
            met.groupBy("a_id", "b_id")
            .agg(F.sum(F.col("a_share") * F.col("b_share")).alias("common"))
            .filter(F.col("common") >= least - SLACK).drop("common")
        )
        found = met if found is None else found.unionByName(met)
    # A brand-less or term-less record has no row in the index: it is similar to nothing.
    candidates = found if len(searches) == 1 else found.distinct()
    sides = candidates.join(
        vectors.select(F.col("id").alias("a_id"), *[F.col(f).alias(f"a_{f}") for f in weights]),
        "a_id",
    ).join(
        vectors.select(F.col("id").alias("b_id"), *[F.col(f).alias(f"b_{f}") for f in weights]),
        "b_id",
    )
    score = None
    for feature, weight in weights.items():
        part = weight * sparse_dot(
            F.col(f"a_{feature}.number"), F.col(f"a_{feature}.weight"),
            F.col(f"b_{feature}.number"), F.col(f"b_{feature}.weight"),
        )
        score = part if score is None else score + part
    return sides.select(
        F.col("a_id").alias("a"), F.col("b_id").alias("b"), F.round(score, DIGITS).alias("sim")
    ).filter(F.col("sim") >= round(at_least, DIGITS))


def cosine_pairs(
    vectors: DataFrame, at_least: float, vector: str = "vector", entries: int | None = None,
    forest: bool = False,
) -> DataFrame:
    """All pairs (a, b, sim) of sparse unit vectors with cosine at least ``at_least``, a < b.

    Common terms of many vectors meet far more often than there are pairs, so neither these meetings
    nor vectors beside each pair are ever listed. The vectors lie in blocks of about ``entries``
    entries in the work folder. A task reads a block and holds it against others, one after
    the other, as sparse matrices of bounded size; only similar pairs come out of it. The bounds
    are those of ``weighted_pairs``. Blocks stand in a circle and each meets those of the half
    behind it, so every two meet once and all tasks have as much to do.

    With ``forest`` a task leaves out pairs whose ends others of its pairs connect: for who wants
    the connected components only. Each of the pairs that are left is a similar one.
    """
    if at_least <= 0:
        raise ValueError("at_least must be positive: otherwise every pair qualifies")
    rows = vectors.filter("id is not null").select("id", *[
        F.col(f"{vector}.{part}").alias(part) for part in ("number", "weight", "tail")])
    held = rows.agg(F.sum(F.size("number"))).first()[0] or 0
    blocks = max(1, -(-held // (entries or ENTRIES)))
    place = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    placed = rows.withColumn("block", place).repartition("block")
    staged, _ = counted_stage(placed, "cosine-blocks", F.lit(True), parts="block")
    spark = vectors.sparkSession
    folder = shared_uri(spark, staged.staged_at)
    reach = blocks // 2 + 1
    alone = blocks * reach // (3 * spark.sparkContext.defaultParallelism)
    run = max(1, min(RUN, alone), -(-reach // 32))
    runs = -(-reach // run)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for task in batch.column(0).to_pylist():
                first, nth = task % blocks, task // blocks
                own = Block.read(folder, first)
                if own is None:
                    continue
                index = Index(own, at_least, forest)
                for step in range(nth * run, min((nth + 1) * run, reach)):
                    if 2 * step == blocks and first >= step:
                        continue  # the half across the circle meets from one side only
                    other = own if step == 0 else Block.read(folder, (first + step) % blocks)
                    if other is not None:
                        yield from index.meet(other)

    kind = vectors.schema["id"].dataType.simpleString()
    return spark.range(0, blocks * runs, 1, blocks * runs).mapInArrow(
        compare, f"a {kind}, b {kind}, sim double")


#: Entries of a block of vectors, blocks to a task (fewer where that leaves cores idle), and the
#: cells and meetings of terms that a task looks at in one go. A row is compared with so many others
#: first where these may connect it with the rest.
ENTRIES, RUN, TOGETHER, FIRST = 2_000_000, 8, 500_000, 4


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each start, one behind the other."""
    out = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    out += np.arange(len(out))
    return out


@dataclass
class Block:
    """Sparse vectors: their entries one behind the other, numbers rising within a vector."""

    ids: pa.Array
    names: np.ndarray
    starts: np.ndarray
    number: np.ndarray
    weight: np.ndarray
    tail: np.ndarray

    @staticmethod
    def read(folder: str, block: int) -> Block | None:
        """A block of the folder, or None if it holds no rows."""
        fs, path = opened(f"{folder}/block={block}")
        if fs.get_file_info(path).type == pa.fs.FileType.NotFound:
            return None
        rows = pq.read_table(path, filesystem=fs, partitioning=None, use_threads=False)
        lists = [rows.column(c).combine_chunks() for c in ("number", "weight", "tail")]
        ids = rows.column("id").combine_chunks()
        starts = np.concatenate(([0], np.cumsum(lists[0].value_lengths().to_numpy())))
        return Block(ids, ids.to_numpy(zero_copy_only=False), starts.astype(np.int64),
                     *[x.flatten().to_numpy() for x in lists])


class Places:
    """Where each of some different numbers stands, looked up for many at once by hash."""

    SPREAD = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, numbers: np.ndarray):
        bits = max(4, (4 * len(numbers)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.place = np.full(1 << bits, -1, np.int32)
        left, at = np.arange(len(numbers), dtype=np.int32), self._slots(numbers)
        while len(left):
            free = self.place[at] < 0
            self.place[at[free]] = left[free]  # of those that take one slot the last has it
            lost = self.place[at] != left
            left, at = left[lost], at[lost] + 1 & self.last
        self.held = np.zeros(1 << bits, np.int64)
        taken = self.place >= 0
        self.held[taken] = numbers[self.place[taken]]

    def _slots(self, numbers: np.ndarray) -> np.ndarray:
        return (numbers.astype(np.uint64) * self.SPREAD >> self.shift).astype(np.int64)

    def of(self, numbers: np.ndarray) -> np.ndarray:
        """The place of each number, or -1."""
        at = self._slots(numbers)
        out = self.place[at]
        left = np.flatnonzero((self.held[at] != numbers) & (out >= 0))
        at = at[left]
        while len(left):
            at = at + 1 & self.last
            found = self.place[at]
            out[left] = found
            on = (self.held[at] != numbers[left]) & (found >= 0)
            left, at = left[on], at[on]
        # A number that is nowhere ended at a free slot, whose place is -1.
        return out


class Joined:
    """Rows of a block, and of another one behind them, by what the pairs found connect."""

    def __init__(self, rows: int):
        self.rows, self.next = rows, rows
        self.label = np.arange(rows)

    def beside(self, others: int) -> None:
        """Rows of another block take the place of those of the one before."""
        self.label = np.concatenate(
            (self.label[:self.rows], np.arange(self.next, self.next + others)))
        self.next += others

    def connect(self, row: int, others: np.ndarray) -> np.ndarray:
        """Connects a row with ``others``, and says which of them that takes."""
        label, first = np.unique(self.label[others], return_index=True)
        self.label[np.isin(self.label, label)] = self.label[row]
        return first


class Index:
    """A block with its entries by term, those with the longest tails first."""

    def __init__(self, block: Block, at_least: float, forest: bool = False):
        self.block, self.at_least = block, at_least
        self.joined = Joined(len(block.names)) if forest else None
        self.reach = LOOSE * at_least - SLACK
        self.terms, code = np.unique(block.number, return_inverse=True)
        self.code = code.astype(np.int32)
        self.places = Places(self.terms)
        row = np.repeat(np.arange(len(block.names), dtype=np.int32), np.diff(block.starts))
        kept = np.flatnonzero(block.tail >= self.reach)
        # Terms are four apart, tails are at most one: a term's entries stand together.
        key = code[kept] * 4.0 - block.tail[kept]
        order = np.argsort(key, kind="stable")
        kept, self.key = kept[order], key[order]
        self.row, self.weight = row[kept], block.weight[kept]
        ends = np.searchsorted(code[kept], np.arange(len(self.terms) + 1))
        self.first, self.size = ends[:-1], np.diff(ends)
        # The longest and the shortest tail of a term's entries; below any bound if there are none.
        self.longest, self.shortest = np.full((2, len(self.terms)), -2.0)
        held = np.flatnonzero(self.size)
        self.longest[held] = block.tail[kept[self.first[held]]]
        self.shortest[held] = block.tail[kept[ends[1:][held] - 1]]

    def meet(self, other: Block) -> Iterator[pa.RecordBatch]:
        """The similar pairs of the block with another one, or within it."""
        n, sizes = len(self.block.names), np.diff(other.starts)
        if not len(self.terms) or not len(other.number):
            return
        if self.joined and other is not self.block:
            self.joined.beside(len(sizes))
        entry = np.flatnonzero(other.tail >= self.reach)
        code = self.places.of(other.number[entry])
        entry, code = entry[code >= 0], code[code >= 0]
        row = np.repeat(np.arange(len(sizes)), sizes)[entry]
        start, tail = self.first[code], other.tail[entry]
        least = np.maximum(self.reach / np.maximum(tail, 1e-300), -1.0)
        met = np.where(self.longest[code] >= least, self.size[code], 0)
        some = np.flatnonzero((met > 0) & (self.shortest[code] < least))
        met[some] = np.maximum(0, np.searchsorted(
            self.key, code[some] * 4.0 - least[some], side="right") - start[some])
        total = np.concatenate(([0], np.cumsum(np.bincount(row, met, len(sizes)).astype(np.int64))))
        of_row = np.searchsorted(row, np.arange(len(sizes) + 1))
        enough = (1 - LOOSE) * self.at_least - SLACK
        a = 0
        while a < len(sizes):
            b = int(np.searchsorted(total, total[a] + TOGETHER, side="right")) - 1
            b = max(a + 1, min(b, a + TOGETHER // n, len(sizes)))
            x, y = of_row[a], of_row[b]
            if total[b] > total[a]:
                here = _ranges(start[x:y], met[x:y])
                common = self.weight[here] * np.repeat(other.weight[entry[x:y]], met[x:y])
                cell = np.repeat((row[x:y] - a) * n, met[x:y]) + self.row[here]
                common = np.bincount(cell, common, (b - a) * n)
                left, own = np.divmod(np.flatnonzero((common > 0) & (common >= enough)), n)
                left += a
                if other is self.block:
                    apart = other.names[left] < self.block.names[own]
                    left, own = left[apart], own[apart]
                yield from self._similar(other, left, own)
            a = b

    def _similar(
        self, other: Block, left: np.ndarray, own: np.ndarray,
    ) -> Iterator[pa.RecordBatch]:
        """The pairs of other's rows ``left``, which rise, with the block's whose cosine is enough."""
        block, out = self.block, []
        least, joined = round(self.at_least, DIGITS), self.joined
        behind = 0 if other is block else len(block.names)
        whole = np.zeros(len(self.terms))
        lengths = np.diff(block.starts)
        cuts = [0, *(np.flatnonzero(np.diff(left)) + 1).tolist(), len(left)] if len(left) else [0]
        for a, b in zip(cuts, cuts[1:]):
            x, all_rows = int(left[a]), own[a:b]
            if joined:
                all_rows = all_rows[joined.label[all_rows] != joined.label[behind + x]]
                if not len(all_rows):
                    continue
            entries = slice(other.starts[x], other.starts[x + 1])
            terms = self.places.of(other.number[entries])
            known = terms >= 0
            terms = terms[known]
            whole[terms] = other.weight[entries][known]
            most = max(1, TOGETHER // max(1, int(lengths[all_rows].max())))
            step = min(most, FIRST) if joined else most
            while len(all_rows):
                rows, all_rows = all_rows[:step], all_rows[step:]
                here = _ranges(block.starts[rows], lengths[rows])
                sims = np.round(np.add.reduceat(
                    whole[self.code[here]] * block.weight[here],
                    np.cumsum(lengths[rows]) - lengths[rows]), DIGITS)
                rows, sims = rows[sims >= least], sims[sims >= least]
                if joined and len(rows):
                    first = joined.connect(behind + x, rows)
                    rows, sims = rows[first], sims[first]
                    all_rows = all_rows[joined.label[all_rows] != joined.label[behind + x]]
                step = min(most, step * FIRST)
                if len(rows):
                    out.append((np.full(len(rows), x), rows, sims))
            whole[terms] = 0
        if out:
            left, own, sims = map(np.concatenate, zip(*out))
            one, two = other.names[left], block.names[own]
            a, b = (np.where(one < two, x, y) for x, y in ((one, two), (two, one)))
            yield pa.RecordBatch.from_pydict({
                "a": pa.array(a, block.ids.type), "b": pa.array(b, block.ids.type), "sim": sims})


#: Number of the entry that stands for the constant in rows of 1 - S.
CONSTANT = -1
#: Columns of the Gram matrix that one task multiplies, and vectors that it multiplies by them.
COLUMNS, ROWS = 256, 20_000
#: Entries of a block of vectors written out in full.
CELLS = 4_000_000


def gram_table(vectors: DataFrame) -> DataFrame:
    """(k, l, g): the sum of copies * weight k * weight l over ``vectors`` (id, copies, vector)."""
    one = vectors.select("copies", "vector", F.explode("vector").alias("x"))
    upper = (
        one.select("copies", "x", F.explode("vector").alias("y"))
        .filter(F.col("x.number") <= F.col("y.number"))
        .groupBy(F.col("x.number").alias("k"), F.col("y.number").alias("l"))
        .agg(F.sum(F.col("copies") * F.col("x.weight") * F.col("y.weight")).alias("g"))
    )
    both = F.when(F.col("k") == F.col("l"), F.array(F.struct("k", "l"))).otherwise(
        F.array(F.struct("k", "l"), F.struct(F.col("l").alias("k"), F.col("k").alias("l"))))
    return upper.select(F.explode(both).alias("at"), "g").select("at.*", "g")


def _flat(column: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """(row of each entry, all entries one behind the other) of a column of arrays."""
    sizes = column.map(len).to_numpy()
    return np.repeat(np.arange(len(column)), sizes), np.concatenate(
        column.to_numpy()) if len(column) else np.empty(0)


def _written_out(numbers: pd.Series, weights: pd.Series, known: np.ndarray) -> np.ndarray:
    """Rows × ``known`` numbers; entries of other numbers are left out."""
    out = np.zeros((len(numbers), len(known)))
    if out.size:
        row, number = _flat(numbers)
        at = np.minimum(np.searchsorted(known, number), len(known) - 1)
        here = known[at] == number
        out[row[here], at[here]] = _flat(weights)[1][here]
    return out


def profile_vectors(sparse: DataFrame, copies: DataFrame, distances: bool = False) -> DataFrame:
    """(id, a, b): sparse vectors whose product a·b of two ids is the cosine of their profiles.

    An id's profile is its row of the N×N similarity matrix. With unit rows V the matrix is
    S = V·Vᵀ, and the product of its rows i and j is vᵢ·G·vⱼ with G = Vᵀ·V. G is terms × terms; it
    stays a table, which is multiplied with the vectors by blocks of its columns. ``a`` is vᵢ·G and
    ``b`` is vᵢ, both over the length of the profile. ``distances`` does the same for
    rows of 1 - S, in which a constant stands beside the terms. ``copies`` (id, copies) gives every
    record its part in G.

    An ``a`` has an entry for each term that occurs beside one of the id's, so it is as long as
    the vocabulary at most.
    """
    vectors = stage(sparse.join(copies, "id").select(
        "id", "copies", F.transform("vector", lambda e: F.struct(
            e.number.alias("number"), e.weight.alias("weight"))).alias("vector")), "gram-vectors")
    gram = gram_table(vectors)
    if distances:
        constant = F.struct(F.lit(CONSTANT).cast("long").alias("number"), F.lit(1.0).alias("weight"))
        with_one = vectors.withColumn("vector", F.concat(F.array(constant), "vector"))
        signed = F.when((F.col("k") == CONSTANT) != (F.col("l") == CONSTANT), -F.col("g"))
        gram = gram_table(with_one).withColumn("g", F.coalesce(signed, "g"))
        vectors = with_one
    gram = stage(gram, "gram")
    terms, rows = gram.agg(F.countDistinct("l")).first()[0], vectors.count()
    columns, chunks = max(1, -(-terms // COLUMNS)), max(1, -(-rows // ROWS))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = vectors.select(
        "id", F.col("vector.number").alias("numbers"), F.col("vector.weight").alias("weights"),
        F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int").alias("chunk"),
        every(columns).alias("block"))
    right = gram.select(
        "k", "l", "g", every(chunks).alias("chunk"),
        F.pmod(F.xxhash64("l"), F.lit(columns)).cast("int").alias("block"))

    products = left.groupBy("chunk", "block").cogroup(right.groupBy("chunk", "block")).applyInPandas(
        _multiply, "id long, numbers array<long>, values array<double>, square double")
    whole = products.groupBy("id").agg(
        F.array_sort(F.flatten(F.collect_list(F.arrays_zip("numbers", "values")))).alias("product"),
        F.sqrt(F.greatest(F.sum("square"), F.lit(0.0))).alias("length"))

    def scaled(column: str, number: str, weight: str) -> Column:
        return F.transform(column, lambda e: F.struct(
            e[number].alias("number"), (e[weight] / F.col("length")).alias("weight")))

    return whole.filter("length > 0").join(vectors, "id").select(
        "id", scaled("product", "numbers", "values").alias("a"),
        scaled("vector", "number", "weight").alias("b"))


def _multiply(one: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
    """Vectors by a block of the Gram matrix's columns, and the block's part of v·G·v."""
    out, squares = [], [np.empty(0)]
    if len(one) and len(other):
        k, row = np.unique(other["k"].to_numpy(), return_inverse=True)
        columns, column = np.unique(other["l"].to_numpy(), return_inverse=True)
        block = np.zeros((len(k), len(columns)))
        block[row, column] = other["g"].to_numpy()
        step = max(1, CELLS // len(k))
        for start in range(0, len(one), step):
            part = one.iloc[start:start + step]
            found = _written_out(part["numbers"], part["weights"], k) @ block
            squares.append((found * _written_out(part["numbers"], part["weights"], columns)).sum(axis=1))
            for i, values in zip(part["id"], found):
                there = np.flatnonzero(values)
                out.append((i, columns[there], values[there]))
    return pd.DataFrame(out, columns=["id", "numbers", "values"]).assign(square=np.concatenate(squares))


def profile_pairs(profiles: DataFrame, at_least: float, pivots: int = 64) -> DataFrame:
    """All pairs (a, b, sim) of ``profile_vectors`` with cosine at least ``at_least``.

    Angles obey the triangle inequality. Every profile lives in the cell of its nearest pivot
    and visits each lower-numbered cell that a partner could live in: one whose pivot is at
    most two cut angles farther than its own. So every similar pair meets exactly once. A cell
    is compared block by block, each a matrix product of bounded size that only yields the
    similar pairs. The pivots only affect speed; they are picked by hash, ``pivots`` or as
    many as have ``CELLS`` entries.
    """
    lists = stage(profiles.select("id", *[
        F.col(f"{side}.{part}").alias(side + part[0]) for side in "ab" for part in ("number", "weight")
    ]), "profiles")
    longest = lists.agg(F.max(F.size("an"))).first()[0]
    if longest is None:
        return lists.select(F.col("id").alias("a"), F.col("id").alias("b"),
                            F.lit(1.0).alias("sim")).filter(F.lit(False))
    chosen = pd.DataFrame(
        [row.asDict() for row in lists.select("id", "an", "aw").orderBy(F.xxhash64("id"), "id")
         .limit(max(1, min(pivots, CELLS // max(longest, 1)))).collect()])
    known = np.unique(_flat(chosen["an"])[1])
    centres = _written_out(chosen["an"], chosen["aw"], known)
    cut = math.acos(max(min(at_least - SLACK, 1.0), -1.0)) + SLACK

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            step = max(1, CELLS // max(len(known), 1))
            for start in range(0, len(batch), step):
                part = batch.iloc[start:start + step]
                rows = _written_out(part["bn"], part["bw"], known)
                angles = np.arccos(np.clip(rows @ centres.T, -1.0, 1.0))
                home = angles.argmin(axis=1)
                near = angles <= angles.min(axis=1, keepdims=True) + 2 * cut
                row, cell = np.nonzero(near & (np.arange(len(centres)) <= home[:, None]))
                yield pd.DataFrame({"id": part["id"].to_numpy()[row], "cell": cell,
                                    "home": home[row] == cell})

    places = stage(lists.select("id", "bn", "bw").mapInPandas(
        place, "id long, cell int, home boolean"), "cells")
    least = round(at_least, DIGITS)

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": [], "sim": []})
        terms = np.unique(_flat(right["bn"])[1])
        sims = _written_out(left["an"], left["aw"], terms) @ _written_out(
            right["bn"], right["bw"], terms).T
        sims = np.round(sims, DIGITS)
        a_id, b_id = left["id"].to_numpy()[:, None], right["id"].to_numpy()[None, :]
        apart = ~right["home"].to_numpy()[None, :] | (a_id < b_id)
        i, j = np.nonzero((sims >= least) & apart)
        a, b = a_id[i, 0], b_id[0, j]
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b), "sim": sims[i, j]})

    block = int(min(4000, max(64, CELLS // max(longest, 1))))
    homes, everyone = side_blocks(places.filter("home").select("id", "cell"), places, ["cell"],
                                  block=block)
    homes = homes.join(lists.select("id", "an", "aw"), "id")
    others = everyone.join(lists.select("id", "bn", "bw"), "id")
    others = others.toDF(*others.columns)  # or both sides' columns go by one name
    where = ["cell", "_p", "_q"]
    return homes.groupBy(*where).cogroup(others.groupBy(*where)).applyInPandas(
        compare, "a long, b long, sim double")
