"""Match two catalogues: pool both sides, weigh several features, cluster them together."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import linkage as tree
from ..operators.selection import copies
from ..operators.similarity import weighted_pairs
from ..operators.vectors import CATALOGUE_WEIGHTING, Weighting, distinct_vectors, vectors
from ..session import stage


def _same(value: Column) -> Column:
    return value


@dataclass(frozen=True)
class Feature:
    """A compared field: where it comes from on each side, its weight and its terms."""

    name: str
    left: str
    right: str
    weight: float
    normalise: Callable[[Column], Column] = _same
    tokenise: Callable[[Column], Column] = text.space_tokens


TITLE = Feature("title", "name", "name", 0.5, normalise=text.split_digits)
UNIT_TITLE = Feature("title", "name", "name", 0.5,
                     normalise=lambda value: text.join_unit(value, "gb"))
BRAND = Feature("brand", "brand", "brand", 0.5, tokenise=text.whole_token)


def tfidf(weighting: Weighting = CATALOGUE_WEIGHTING,
          stop_words: Sequence[str] = tuple(text.CATALOGUE_STOP_WORDS),
          ngrams: tuple[int, int] = (1, 3)):
    """The default vectoriser: (texts, tokens, name) -> unit vectors. See ``vectors``."""
    def run(texts: DataFrame, tokens: Column, name: str) -> DataFrame:
        terms = text.ngrams(text.drop_words(tokens, stop_words), ngrams)
        return vectors(texts, terms, weighting, name)[0]
    return run


def complete_linkage(cut: float = 0.42, inclusive: bool = False, method: str = "complete"):
    """The default clusterer: (pairs, sizes) -> merges, and the similarity it needs."""
    def run(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
        return tree.linkage(pairs, sizes, cut, method, inclusive)
    run.at_least = 1.0 - cut
    return run


@dataclass(frozen=True)
class Matched:
    records: DataFrame  # side, id, cluster_id
    merges: DataFrame
    clusters: DataFrame  # cluster_id, n_left, n_right


@dataclass(frozen=True)
class Matcher:
    """Vectoriser, similarity and clusterer are functions and may each be replaced."""

    features: Sequence[Feature] = (TITLE, BRAND)
    vectorise: Callable = field(default_factory=tfidf)
    similarity: Callable[[DataFrame, dict[str, float], float], DataFrame] = weighted_pairs
    cluster: Callable = field(default_factory=complete_linkage)

    def pooled(self, left: DataFrame, right: DataFrame, left_id: str, right_id: str) -> DataFrame:
        """(side, record, one normalised column per feature)."""
        sides = []
        for side, df, id_col in (("left", left, left_id), ("right", right, right_id)):
            sides.append(df.select(
                F.lit(side).alias("side"), F.col(id_col).alias("record"),
                *[f.normalise(F.col(getattr(f, side))).alias(f.name) for f in self.features],
            ))
        return sides[0].unionByName(sides[1])

    def feature_vectors(self, texts: DataFrame) -> DataFrame:
        """(id, one vector column per feature) over distinct feature combinations."""
        wide = texts.select("id")
        for f in self.features:
            source = texts.select("id", "copies", F.col(f.name))
            one = self.vectorise(source, f.tokenise(F.col(f.name)), f.name)
            wide = wide.join(one, "id", "left")
        return stage(wide, "features")

    def texts(self, pooled: DataFrame) -> DataFrame:
        names = [f.name for f in self.features]
        # Ids of both sides live in one space: the left keeps even numbers, the right odd.
        tagged = pooled.withColumn(
            "key", F.col("record") * 2 + F.when(F.col("side") == "left", 0).otherwise(1)
        )
        return stage(copies(tagged, names, "key"), "texts")

    def match(self, left: DataFrame, right: DataFrame, left_id: str, right_id: str) -> Matched:
        """Cluster both catalogues together. ``cluster_id`` names the least pooled member.

        The cross-side matches of a cluster are its left records with its right records; they
        are reported by their counts, since listing them is quadratic for a large cluster.
        """
        pooled = self.pooled(left, right, left_id, right_id)
        texts = self.texts(pooled)
        wide = self.feature_vectors(texts)
        weights = {f.name: f.weight for f in self.features}
        termless = F.coalesce(*[F.col(n) for n in weights]).isNull()
        vector_ids, one = distinct_vectors(wide.filter(~termless), texts, list(weights))
        pairs = self.similarity(one, weights, self.cluster.at_least)
        merges = self.cluster(pairs, one.select("id", "copies"))
        labels = tree.clusters(one.select("id"), merges)
        labels = (
            texts.select("id").join(vector_ids, "id", "left")
            .join(labels.toDF("vector_id", "cluster"), "vector_id", "left")
            .select("id", F.coalesce("cluster", "id").alias("cluster"))
        )
        names = [f.name for f in self.features]
        named = texts.join(labels, "id").select(
            *[F.col(n).alias(f"t_{n}") for n in names], F.col("cluster").alias("cluster_id")
        )
        # Null-safe: a missing brand is a value of its own when texts are collapsed.
        same = [pooled[n].eqNullSafe(named[f"t_{n}"]) for n in names]
        on = same[0]
        for condition in same[1:]:
            on = on & condition
        records = stage(
            pooled.join(named, on, "left").select(
                "side", F.col("record").alias("id"), "cluster_id"
            ),
            "matched",
        )
        sides = records.groupBy("cluster_id").agg(
            F.count(F.when(F.col("side") == "left", 1)).alias("n_left"),
            F.count(F.when(F.col("side") == "right", 1)).alias("n_right"),
        )
        return Matched(records, merges, sides)
