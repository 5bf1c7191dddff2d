"""Fuzzy left join: every left record with its best right record.

A column pair scores the shared token weight over the larger side's token weight, where a
token's weight is its idf over both tables; the score is the mean over the column pairs.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean, word_tokens
from ..session import stage
from .grid import side_pairs
from .selection import copies

DIGITS = 9
SLACK = 1e-7


def default_tokens(text: Column) -> Column:
    return F.array_distinct(word_tokens(clean(text)))


def _profiles(df: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    named = df.select(
        F.col(f"`{id_col}`").alias("record"),
        *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(f"c{i}")
          for i, c in enumerate(columns)],
    )
    return copies(named, [f"c{i}" for i in range(len(columns))], "record")


def _tokens(profiles: DataFrame, width: int, tokens) -> DataFrame:
    """(id, copies, col, token), each token once per column."""
    each = F.explode(F.array(*[
        F.struct(F.lit(i).alias("col"), tokens(F.col(f"c{i}")).alias("tokens"))
        for i in range(width)
    ]))
    return profiles.select("id", "copies", each.alias("field")).select(
        "id", "copies", F.col("field.col").alias("col"),
        F.explode("field.tokens").alias("token"),
    )


def _mass(entries: str, column: int) -> Column:
    own = F.filter(entries, lambda e: e.col == column)
    return F.aggregate(own, F.lit(0.0), lambda total, e: total + e.idf)


def _weighted(tokens: DataFrame, idf: DataFrame, width: int) -> DataFrame:
    """(id, masses, entries): a profile's tokens with their weights, and the sum per column."""
    gathered = tokens.join(idf, ["col", "token"]).groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("col", "token", "idf"))).alias("entries")
    )
    masses = F.array(*[_mass("entries", i) for i in range(width)])
    return gathered.withColumn("masses", masses)


def best_matches(
    left: DataFrame, right: DataFrame, left_on: list[str], right_on: list[str],
    left_id: str, right_id: str, tokens=default_tokens,
) -> tuple[DataFrame, DataFrame]:
    """(left profiles, best): the distinct left texts and the best right record of each.

    The first pass joins on the rarest token of the left text and gives a score that the best
    match must reach. The second joins on its tokens, rarest first, up to the point where those
    left out cannot make up that score together; the result is exact, and a good first match
    keeps popular tokens out of the join.
    """
    width = len(left_on)
    lefts = stage(_profiles(left, left_id, left_on), "left-texts")
    rights = stage(_profiles(right, right_id, right_on), "right-texts")
    left_tokens, right_tokens = (_tokens(p, width, tokens) for p in (lefts, rights))
    n = (
        lefts.select("copies").unionByName(rights.select("copies"))
        .agg(F.sum("copies")).scalar()
    )
    idf = (
        left_tokens.unionByName(right_tokens)
        .groupBy("col", "token").agg(F.sum("copies").alias("df"))
        .withColumn("n", n)
        .select("col", "token", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))
    )
    idf = stage(idf, "idf")
    left_entries = stage(_weighted(left_tokens, idf, width), "left-entries")
    right_entries = stage(_weighted(right_tokens, idf, width), "right-entries")
    right_index = right_tokens.select("id", "col", "token")
    popularity = stage(
        right_index.groupBy("col", "token").agg(F.count(F.lit(1)).alias("popularity")),
        "popularity",
    )

    def scored(probes: DataFrame) -> DataFrame:
        """(left, right, score) for all right texts that share a probe (id, col, token)."""
        pairs = side_pairs(probes, right_index, ["col", "token"]).select(
            "a_id", "b_id"
        ).distinct()
        a = left_entries.select(F.col("id").alias("a_id"), F.col("entries").alias("a"),
                                F.col("masses").alias("a_mass"))
        b = right_entries.select(F.col("id").alias("b_id"), F.col("entries").alias("b"),
                                 F.col("masses").alias("b_mass"))
        met = pairs.join(a, "a_id").join(b, "b_id").withColumn(
            "shared", F.array_intersect("a", "b")
        )
        parts = []
        for i in range(width):
            common = _mass("shared", i)
            larger = F.greatest(F.get("a_mass", F.lit(i)), F.get("b_mass", F.lit(i)))
            parts.append(F.when(larger > 0, common / larger).otherwise(0.0))
        score = F.round(reduce(add, parts) / width, DIGITS)
        return met.select(F.col("a_id").alias("left"), F.col("b_id").alias("right"),
                          score.alias("score"))

    def best(pairs: DataFrame) -> DataFrame:
        pick = F.min(F.struct((-F.col("score")).alias("loss"), F.col("right")))
        return pairs.groupBy("left").agg(pick.alias("pick")).select(
            F.col("left").alias("id"), (-F.col("pick.loss")).alias("score"),
            F.col("pick.right").alias("right"),
        )

    # First pass: the rarest token that the right side knows. A left text without any has no
    # match and drops out here.
    known = left_entries.select("id", "masses", F.explode("entries").alias("e")).select(
        "id", "e.col", "e.token",
        (F.col("e.idf") / F.get("masses", F.col("e.col")) / width).alias("share"),
    ).join(popularity, ["col", "token"])
    ranked = stage(
        known.groupBy("id").agg(
            F.sort_array(F.collect_list(F.struct("popularity", "col", "token", "share")))
            .alias("probes")
        ),
        "probes",
    )
    lead = ranked.select("id", F.col("probes")[0].alias("e")).select("id", "e.col", "e.token")
    first = stage(best(scored(lead)), "first-matches")

    # Second pass: leave out the most popular tokens for as long as their shares together
    # stay below the first score.
    tail = F.aggregate(
        F.reverse("probes"),
        F.struct(F.lit(0.0).alias("mass"), F.lit(0).alias("n")),
        lambda acc, e: F.struct(
            (acc.mass + e.share).alias("mass"),
            (acc.n + F.when(acc.mass + e.share < F.col("score") - SLACK, 1).otherwise(0))
            .alias("n"),
        ),
    )
    probes = (
        ranked.join(first.select("id", "score"), "id")
        .withColumn("keep", F.size("probes") - tail.n)
        .select("id", F.explode(F.slice("probes", F.lit(1), F.col("keep"))).alias("e"))
        .select("id", "e.col", "e.token")
    )
    return lefts, best(scored(probes))


def fuzzy_left_join(
    left: DataFrame, right: DataFrame, left_on: list[str], right_on: list[str],
    left_id: str, right_id: str, tokens=default_tokens,
) -> DataFrame:
    """Left rows, ``best_match_score`` and the columns of the best right row (null if none)."""
    lefts, best = best_matches(left, right, left_on, right_on, left_id, right_id, tokens)
    keyed = left.select("*", *[
        F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(f"c{i}")
        for i, c in enumerate(left_on)
    ])
    texts = [f"c{i}" for i in range(len(left_on))]
    named = lefts.join(best, "id", "left").select(
        *texts, F.col("score").alias("best_match_score"), F.col("right").alias("_right")
    )
    chosen = right.withColumn("_right", F.col(f"`{right_id}`"))
    return keyed.join(named, texts, "left").drop(*texts).join(chosen, "_right", "left").drop(
        "_right"
    )
