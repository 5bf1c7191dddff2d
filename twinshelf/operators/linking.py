"""Field comparisons, scores and the pairs that reach a score.

Records are first collapsed to profiles: one row per distinct combination of key and compared
values, named by the least record id, with the number of records. A result row is a pair of
profiles with both counts, so copies never multiply. To find the pairs with at least ``k``
agreeing comparisons, each choice of ``k`` comparisons is joined on what agreement implies
(equal values, or a shared rare part of the string) and the survivors are compared in full.
Nothing is joined on the candidate key alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce
from itertools import combinations
from math import comb
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import edit_similarity, jaro_winkler_similarity
from ..session import stage
from .grid import side_blocks, side_pairs

SLACK = 1e-9
#: Records of a profile that are paired with those of another at a time.
PIECE = 1000
#: Pairs of records that one task lists.
LISTED = 2_000_000
#: Pairs of a matrix of shared bigrams in the time of one pair met by a part, least number of met
#: pairs of a key that is worth matrices, rows on each side of one, and bigrams at a time.
CHEAPER, MANY, SIDE, WIDE = 16, 200_000, 2000, 4096


@dataclass(frozen=True)
class Compare:
    """One field comparison that yields 1 (agree) or 0.

    ``method`` is exact, edit or jaro_winkler; the latter two agree from ``threshold`` on, which
    is above 0. Low thresholds have weak join keys: edit similarity of two thirds or less joins on
    lengths, and Jaro-Winkler similarity of 0.8 or less on any character in common.
    """

    left: str
    right: str
    label: str
    method: str = "exact"
    threshold: float = 0.85

    def __post_init__(self) -> None:
        if self.method not in ("exact", "edit", "jaro_winkler"):
            raise ValueError(f"unknown method {self.method}")
        if self.method != "exact" and not 0 < self.threshold <= 1:
            raise ValueError("a threshold is above 0 and at most 1")

    @property
    def by_length(self) -> bool:
        """Whether two agreeing strings may have no bigram in common."""
        return self.method == "edit" and self.threshold <= 2 / 3

    def agree(self, left: Column, right: Column) -> Column:
        if self.method == "exact":
            return F.coalesce((left == right).cast("int"), F.lit(0))
        score = {"edit": edit_similarity, "jaro_winkler": jaro_winkler_similarity}[self.method]
        return (score(left, right) >= self.threshold).cast("int")

    @property
    def cost(self) -> int:
        return ["exact", "edit", "jaro_winkler"].index(self.method)

    def reach(self) -> float:
        """Shortest possible partner, as a share of a string's length."""
        if self.method == "edit":
            return self.threshold
        jaro = (self.threshold - 0.4) / 0.6
        return max(3 * jaro - 2, 0.0)

    def prefix_size(self, length: Column) -> Column:
        """How many of its rarest parts a string must show to meet every partner.

        Edit: one edit touches two bigrams, and a partner allows at most
        ``(1 - t) * longer`` edits. Jaro-Winkler: agreement implies a least number of common
        characters, ``reach`` of the length for the worst partner.
        """
        if self.method == "edit":
            longest = F.floor(length / self.threshold + SLACK)
            return 2 * F.floor((1 - self.threshold) * longest + SLACK) + 1
        return length - F.ceil(self.reach() * length - SLACK) + 1


def shared_parts(values: DataFrame, compare: Compare) -> DataFrame:
    """(value, parts, whole): the rarest parts of each distinct string, as far as they are needed,
    and all of them.

    Parts are bigrams (edit) or characters (Jaro-Winkler); a repeat is a part of its own. All
    values are ordered by the same part frequencies, which makes the prefixes comparable.
    """
    length = F.length("value")
    if compare.by_length:
        # The lengths of shorter partners and its own: two strings share one if, and only if,
        # the shorter is long enough for the longer.
        least = F.ceil(compare.threshold * length - SLACK)
        lengths = F.sequence(least, length.cast("long"))
        return values.select("value", lengths.alias("parts"), lengths.alias("whole"))
    width = 2 if compare.method == "edit" else 1
    spots = F.sequence(F.lit(1), length - (width - 1))
    cut = F.when(
        length >= width,
        F.transform(spots, lambda i: F.substring(F.col("value"), i, F.lit(width))),
    ).otherwise(F.array(F.concat(F.lit("="), F.col("value"))))
    counted = values.select("value", F.explode(cut).alias("part")).groupBy("value", "part").count()
    numbered = counted.select(
        "value", "part", F.explode(F.sequence(F.lit(1), F.col("count").cast("int"))).alias("nth")
    )
    # Numbered by popularity, rarest first: plain numbers compare fast in the join.
    order = numbered.groupBy("part", "nth").agg(F.count(F.lit(1)).alias("popularity")).orderBy(
        "popularity", "part", "nth"
    ).select("part", "nth", F.monotonically_increasing_id().alias("number"))
    ranked = numbered.join(stage(order, "part-order"), ["part", "nth"]).groupBy("value").agg(
        F.sort_array(F.collect_list("number")).alias("whole")
    )
    size = F.greatest(compare.prefix_size(length), F.lit(1)).cast("int")
    return ranked.select("value", F.slice("whole", F.lit(1), size).alias("parts"), "whole")


def _bigram_rows(lists: pa.ChunkedArray, known: np.ndarray, start: int) -> np.ndarray:
    """Rows × ``WIDE`` of the ``known`` numbers from ``start`` on: 1 where a list holds one."""
    flat = pa.concat_arrays(lists.chunks)
    row = np.repeat(np.arange(len(flat)), flat.value_lengths().to_numpy())
    at = np.searchsorted(known, flat.flatten().to_numpy()) - start
    out = np.zeros((len(flat), min(WIDE, len(known) - start)), np.float32)
    here = (at >= 0) & (at < out.shape[1])
    out[row[here], at[here]] = 1
    return out


def near_in_matrices(
    left: DataFrame, right: DataFrame, keys: list[str], lead: Compare, itself: bool,
) -> DataFrame:
    """Rows of the same ``keys`` that hold enough bigrams in common, as columns ``a_`` and ``b_``.

    One edit touches two bigrams, so strings that agree share all bigrams of the longer but two an
    edit. The shared ones of ``SIDE`` by ``SIDE`` rows are one matrix product.
    """
    kept = [c for c in left.columns if c not in (*keys, "whole")]
    label, share, reach, ordered = lead.label, 1 - lead.threshold, lead.reach(), bool(itself)

    def compare(one: pa.Table, other: pa.Table) -> pa.Table:
        known = np.unique(np.concatenate([t["whole"].combine_chunks().flatten().to_numpy()
                                          if len(t) else [] for t in (one, other)]))
        n, m = (pc.utf8_length(t[label]).to_numpy() for t in (one, other))
        found = np.zeros((len(one), len(other)), np.float32)
        if found.size:
            for start in range(0, len(known), WIDE):
                found += _bigram_rows(one["whole"], known, start) @ _bigram_rows(
                    other["whole"], known, start).T
            long = np.maximum(n[:, None], m[None, :])
            least = np.array([max(size - 1 - 2 * int(share * size + SLACK), 0)
                              for size in range(int(long.max()) + 1)], np.float32)
            enough = (found >= least[long]) & (
                np.minimum(n[:, None], m[None, :]) >= reach * long - SLACK)
        else:
            enough = np.zeros(found.shape, bool)
        i, j = map(pa.array, np.nonzero(enough))
        if ordered:
            apart = pc.less(one["id"].combine_chunks().take(i), other["id"].combine_chunks().take(j))
            i, j = i.filter(apart), j.filter(apart)
        columns = [t[c].combine_chunks().take(at) for t, at in ((one, i), (other, j)) for c in kept]
        return pa.table(columns, names=[f"{side}_{c}" for side in "ab" for c in kept])

    homes, guests = side_blocks(left, right, keys, block=SIDE)
    guests = guests.toDF(*guests.columns)  # or both sides' columns go by one name
    where = [*keys, "_p", "_q"]
    types = dict(left.dtypes)
    return homes.groupBy(*where).cogroup(guests.groupBy(*where)).applyInArrow(
        compare, ", ".join(f"`{side}_{c}` {types[c]}" for side in "ab" for c in kept))


def profiles(
    df: DataFrame, id_col: str, key: str | None, fields: dict[str, str], side: str,
) -> DataFrame:
    """(id, copies, [key], one column per comparison label)."""
    columns = [F.col(f"`{source}`").alias(label) for label, source in fields.items()]
    if key is not None:
        columns.append(F.col(f"`{key}`").alias(f"{side}_key"))
        df = df.filter(F.col(f"`{key}`").isNotNull())
    names = [*fields, *([f"{side}_key"] if key is not None else [])]
    return (
        df.select(F.col(f"`{id_col}`").alias("_id"), *columns)
        .groupBy(*names)
        .agg(F.min("_id").alias("id"), F.count(F.lit(1)).alias("copies"))
    )


@dataclass(frozen=True)
class Linkage:
    """Two sides, the key pairs that may meet (None: all) and the comparisons.

    For one table against itself pass the same frame twice with ``itself=True``; the
    comparisons must then have equal left and right fields.
    """

    left: DataFrame
    right: DataFrame
    left_id: str
    right_id: str
    compares: tuple[Compare, ...]
    keys: DataFrame | None = None
    left_on: str | None = None
    right_on: str | None = None
    itself: bool = False

    @cached_property
    def _sides(self) -> dict[str, DataFrame]:
        """Full profiles of both sides, written once for all the joins over them."""
        keyed = self.keys is not None
        left = stage(
            profiles(self.left, self.left_id, self.left_on if keyed else None,
                     {c.label: c.left for c in self.compares}, "left"),
            "left-profiles",
        )
        if self.itself:
            right = left.withColumnRenamed("left_key", "right_key")
        else:
            right = stage(
                profiles(self.right, self.right_id, self.right_on if keyed else None,
                         {c.label: c.right for c in self.compares}, "right"),
                "right-profiles",
            )
        return {"left": left, "right": right}

    @cached_property
    def _pairing(self) -> DataFrame | None:
        return None if self.keys is None else stage(self.keys, "keys")

    @cached_property
    def _parts(self) -> dict[str, DataFrame]:
        """Join parts of the strings of each inexact comparison, pooled over both sides."""
        found = {}
        for c in self.compares:
            if c.method != "exact":
                values = (
                    self._sides["left"].select(F.col(c.label).alias("value"))
                    .union(self._sides["right"].select(F.col(c.label).alias("value")))
                    .filter("value IS NOT NULL").distinct()
                )
                values = stage(values, "values")
                found[c.label] = stage(shared_parts(values, c), "parts")
                longest = values.agg(F.max(F.length("value"))).first()[0] or 0
                self._edits[c.label] = int((1 - c.threshold) * longest + SLACK)
        return found

    @cached_property
    def _edits(self) -> dict[str, int]:
        """Per comparison: no agreeing pair of strings can be more edits apart than this."""
        return {}

    def _side(self, side: str, labels: list[str]) -> DataFrame:
        whole = self._sides[side]
        if len(labels) == len(self.compares):
            return whole
        names = [*labels, *([f"{side}_key"] if self.keys is not None else [])]
        return whole.groupBy(*names).agg(
            F.min("id").alias("id"), F.sum("copies").alias("copies")
        )

    def _agreeing(self, chosen: tuple[Compare, ...], labels: list[str]) -> DataFrame:
        """Profile pairs over ``labels`` on which all of ``chosen`` agree, each once.

        For one table: pairs of different profiles only, a's id < b's id.
        """
        left, right = self._side("left", labels), self._side("right", labels)
        join_on: list[str] = []
        if self.keys is not None:
            left = left.join(self._pairing, "left_key").drop("left_key")
            join_on.append("right_key")
        for c in chosen:
            if c.method == "exact":
                join_on.append(f"={c.label}")
                left = left.withColumn(f"={c.label}", F.col(c.label))
                right = right.withColumn(f"={c.label}", F.col(c.label))
        fuzzy = sorted((c for c in chosen if c.method != "exact"), key=lambda c: c.cost)
        if fuzzy:
            lead = fuzzy[0]
            parts = self._parts[lead.label].withColumnRenamed("value", lead.label)
            left = left.join(parts, lead.label)
            right = right.join(parts, lead.label)

        def fits() -> Column:
            checks = []
            if fuzzy:
                # A pair that shares several parts is kept at the first of them only.
                shared = F.array_intersect("a_parts", "b_parts")
                short = F.least(F.length(f"a_{lead.label}"), F.length(f"b_{lead.label}"))
                long = F.greatest(F.length(f"a_{lead.label}"), F.length(f"b_{lead.label}"))
                checks = [short >= F.ceil(lead.reach() * long - SLACK),
                          F.array_min(shared) == F.col("part")]
            if self.itself:
                checks.append(F.col("a_id") < F.col("b_id"))
            return reduce(lambda p, q: p & q, checks, F.lit(True))

        if not join_on and not fuzzy:
            raise ValueError("a score of 0 asks for every pair")
        keep = ["id", "copies", *labels]
        names = [f"{side}_{c}" for side in "ab" for c in keep]
        if not fuzzy:
            met = side_pairs(left, right, join_on, where=fits)
        else:
            in_matrices = None
            if lead.method == "edit" and not lead.by_length:
                if not join_on:
                    left, right = (df.withColumn("_one", F.lit(0)) for df in (left, right))
                    join_on = ["_one"]
                crowded = self._crowded(left, right, join_on)
                both = [df.select(*join_on, *keep, "whole").join(crowded, join_on, "left_semi")
                        for df in (left, right)]
                in_matrices = near_in_matrices(*both, join_on, lead, self.itself).select(*names)
                left, right = (df.join(crowded, join_on, "left_anti") for df in (left, right))
            left, right = (df.drop("whole").withColumn("part", F.explode("parts"))
                           for df in (left, right))
            met = side_pairs(left, right, [*join_on, "part"], where=fits).select(*names)
            met = met if in_matrices is None else met.unionByName(in_matrices)
        for c in fuzzy:
            if c.method == "edit":
                # With a fixed bound Spark stops early; the exact rule follows.
                least = F.levenshtein(f"a_{c.label}", f"b_{c.label}", self._edits[c.label])
                met = met.filter(least >= 0)
            met = met.filter(c.agree(F.col(f"a_{c.label}"), F.col(f"b_{c.label}")) == 1)
        return met.select(*names)

    def _crowded(self, left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
        """The ``keys`` whose rows meet by parts more often than matrices of all are worth."""
        rows, parts = [], []
        for df, n in ((left, "l"), (right, "r")):
            rows.append(df.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias(n)))
            parts.append(df.select(*keys, F.explode("parts").alias("part")).groupBy(
                *keys, "part").agg(F.count(F.lit(1)).cast("double").alias(n)))
        met = parts[0].join(parts[1], [*keys, "part"]).groupBy(*keys).agg(
            F.sum(F.col("l") * F.col("r")).alias("met"))
        found = met.join(rows[0], keys).join(rows[1], keys).filter(
            (F.col("met") >= MANY) & (F.col("met") * CHEAPER >= F.col("l") * F.col("r")))
        return stage(found.select(*keys), "crowded")

    def matches(self, at_least: int) -> DataFrame:
        """Candidate profile pairs on which at least so many comparisons agree.

        Columns: left_id, right_id, n_left, n_right, n_pairs, one 0/1 column per comparison,
        score. For one table, a profile with several records also pairs with itself.
        """
        labels = [c.label for c in self.compares]
        scored = None
        done: list[tuple[Compare, ...]] = []
        for chosen in combinations(self.compares, at_least):
            met = self._agreeing(chosen, labels)
            # What the choice holds agrees; the others are looked at here, once, and a pair that
            # an earlier choice holds as well has come from there.
            marks = {c.label: F.lit(1) if c in chosen else
                     c.agree(F.col(f"a_{c.label}"), F.col(f"b_{c.label}")) for c in self.compares}
            part = met.select(
                F.col("a_id").alias("left_id"), F.col("b_id").alias("right_id"),
                F.col("a_copies").alias("n_left"), F.col("b_copies").alias("n_right"),
                (F.col("a_copies") * F.col("b_copies")).alias("n_pairs"),
                *[marks[label].alias(label) for label in labels])
            for other in done:
                part = part.filter(reduce(add, [
                    F.coalesce(F.col(c.label), F.lit(0)) for c in other]) < at_least)
            done.append(chosen)
            scored = part if scored is None else scored.unionByName(part)
        if self.itself:
            agreeing = reduce(add, [F.col(label).isNotNull().cast("int") for label in labels])
            own = self._side("left", labels).filter("copies > 1").filter(agreeing >= at_least)
            scored = scored.unionByName(own.select(
                F.col("id").alias("left_id"), F.col("id").alias("right_id"),
                F.col("copies").alias("n_left"), F.col("copies").alias("n_right"),
                (F.col("copies") * (F.col("copies") - 1) / 2).cast("long").alias("n_pairs"),
                *[F.col(label).isNotNull().cast("int").alias(label) for label in labels],
            ))
        score = reduce(add, [F.col(label) for label in labels])
        return stage(scored.withColumn("score", score), "matches")

    def members(self, side: str) -> DataFrame:
        """(profile, record): every record of a side with the profile that it belongs to.

        A profile goes by its least record, as in ``matches``. Records without a key are left out
        where keys say who may meet. Rows meet by a hash of all values and are then compared.
        """
        whole = self._sides[side]
        df, id_col = (self.left, self.left_id) if side == "left" else (self.right, self.right_id)
        on = self.left_on if side == "left" or self.itself else self.right_on
        columns = {c.label: c.left if side == "left" else c.right for c in self.compares}
        if self.keys is not None:
            columns[f"{side}_key"] = on
        own = df.select(F.col(f"`{id_col}`").alias("record"), *[
            F.col(f"`{source}`").alias(f"own_{label}") for label, source in columns.items()])
        own = own.withColumn("hash", F.xxhash64(*[f"own_{label}" for label in columns]))
        named = whole.withColumn("hash", F.xxhash64(*columns))
        same = reduce(lambda p, q: p & q, [
            F.col(f"own_{label}").eqNullSafe(F.col(label)) for label in columns])
        return own.join(named, "hash").filter(same).select(F.col("id").alias("profile"), "record")

    def record_pairs(
        self, matches: DataFrame, left_texts: DataFrame | None = None,
        right_texts: DataFrame | None = None,
    ) -> DataFrame:
        """``matches`` of profiles as pairs of records: left_record and right_record beside all
        that is known of the profiles' match.

        ``left_texts`` and ``right_texts`` (record, and one column more), if given, are joined to
        the records of their side before these are paired; records without a row have no pair.

        A profile's records lie in pieces of about ``PIECE``, and every two pieces of a match are
        expanded by themselves, spread over the tasks, so neither a profile with a third of all
        records nor the product of two sizes is in one place. For one table, pairs within a
        profile are each met once, the lesser record on the left.
        """
        def pieces(side: str, texts: DataFrame | None) -> DataFrame:
            members = self.members(side)
            entry = F.struct("record")
            if texts is not None:
                members = members.join(texts, "record")
                entry = F.struct("record", *[c for c in texts.columns if c != "record"])
            held = self._sides[side].select(
                F.col("id").alias("profile"), F.ceil(F.col("copies") / PIECE).alias("cuts"))
            return members.join(held, "profile").withColumn(
                "piece", F.pmod(F.xxhash64("record"), "cuts")).groupBy("profile", "piece").agg(
                F.collect_list(entry).alias("records"))

        def spread(n: str) -> Column:
            return F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col(n) / PIECE) - 1))

        met = matches.withColumn("_p", spread("n_left")).withColumn("_q", spread("n_right"))
        own = F.col("left_id") == F.col("right_id") if self.itself else F.lit(False)
        if self.itself:
            if left_texts is not None or right_texts is not None:
                raise ValueError("texts are for two tables")
            met = met.filter(~own | (F.col("_p") <= F.col("_q")))
        left = pieces("left", left_texts).toDF("left_id", "_p", "_l")
        right = pieces("left" if self.itself else "right", right_texts).toDF("right_id", "_q", "_r")
        # So many parts that each lists a bounded number of pairs: by size alone few bytes of
        # matches, which stand for very many pairs, would go to one task.
        listed = matches.agg(F.sum("n_pairs")).first()[0] or 0
        met = met.join(left, ["left_id", "_p"]).join(right, ["right_id", "_q"]).repartition(
            max(1, -(-listed // LISTED)), "left_id", "_p", "right_id", "_q")
        rows = met.withColumn("_a", F.explode("_l")).withColumn("_b", F.explode("_r"))
        if self.itself:
            rows = rows.filter(~own | (F.col("_p") < F.col("_q")) | (
                F.col("_a.record") < F.col("_b.record")))
        swapped = own & (F.col("_a.record") > F.col("_b.record"))
        found = []
        for name, side, other, texts in (("left_record", "_a", "_b", left_texts),
                                         ("right_record", "_b", "_a", right_texts)):
            found.append(F.when(swapped, F.col(f"{other}.record")).otherwise(
                F.col(f"{side}.record")).alias(name))
            found += [F.col(f"{side}.{c}") for c in (texts.columns if texts is not None else [])
                      if c != "record"]
        return rows.select(*found, *matches.columns)

    def _agreeing_count(self, chosen: tuple[Compare, ...]) -> DataFrame:
        """One row: the number of candidate record pairs on which all of ``chosen`` agree."""
        labels = [c.label for c in chosen]
        if all(c.method == "exact" for c in chosen):
            left = self._side("left", labels)
            right = self._side("right", labels)
            on = list(labels)
            if self.keys is not None:
                left, on = left.join(self._pairing, "left_key"), [*labels, "right_key"]
            if not on:
                total = right.agg(F.coalesce(F.sum("copies"), F.lit(0))).scalar()
                met = left.select((F.col("copies") * total).alias("n"))
            else:
                met = left.join(right.withColumnRenamed("copies", "others"), on).select(
                    (F.col("copies") * F.col("others")).alias("n")
                )
            if not self.itself:
                return met.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
            # Ordered pairs, each record with itself among them.
            own = self._side("left", labels)
            for label in labels:
                own = own.filter(F.col(label).isNotNull())
            alone = own.agg(F.coalesce(F.sum("copies"), F.lit(0))).scalar()
            return met.agg(
                ((F.coalesce(F.sum("n"), F.lit(0)) - alone) / 2).cast("long").alias("n")
            )
        n = self._agreeing(chosen, labels).select(
            (F.col("a_copies") * F.col("b_copies")).alias("n")
        )
        if self.itself:
            own = self._side("left", labels)
            for label in labels:
                own = own.filter(F.col(label).isNotNull())
            n = n.unionByName(own.select(
                (F.col("copies") * (F.col("copies") - 1) / 2).cast("long").alias("n")
            ))
        return n.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))

    def histogram(self) -> DataFrame:
        """(score, n_pairs) over all candidate record pairs, highest score first.

        Counted by inclusion and exclusion over the choices of agreeing comparisons, so
        neither the pairs that agree on nothing nor those of a popular value are ever listed.
        Scores that no pair has are left out.
        """
        k = len(self.compares)
        totals = None
        for size in range(k + 1):
            for chosen in combinations(self.compares, size):
                one = self._agreeing_count(chosen).select(F.lit(size).alias("size"), "n")
                totals = one if totals is None else totals.unionByName(one)
        per_size = totals.groupBy("size").agg(F.sum("n").alias("n"))
        shares = F.array(*[
            F.struct(F.lit(size).alias("size"), F.lit(score).alias("score"),
                     F.lit((-1) ** (size - score) * comb(size, score)).alias("factor"))
            for score in range(k + 1) for size in range(score, k + 1)
        ])
        return (
            per_size.withColumn("s", F.explode(shares))
            .filter("size = s.size")
            .groupBy(F.col("s.score").alias("score"))
            .agg(F.sum(F.col("n") * F.col("s.factor")).alias("n_pairs"))
            .filter("n_pairs > 0")
            .orderBy(F.desc("score"))
        )


def listing(
    matches: DataFrame, left_lookup: DataFrame, right_lookup: DataFrame,
) -> DataFrame:
    """Matches with the lookup text of both sides, by left id then score, both descending.

    The lookups are (left_id, left_lookup) and (right_id, right_lookup).
    """
    return (
        matches.join(left_lookup, "left_id", "left")
        .join(right_lookup, "right_id", "left")
        .select("left_id", "right_id", "score", "n_left", "n_right",
                "left_lookup", "right_lookup")
        .orderBy(F.desc("left_id"), F.desc("score"), "right_id")
    )
