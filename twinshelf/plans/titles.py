"""Cluster records by their titles: normalise, weigh, join by similarity, link, list."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import linkage as tree
from ..operators.selection import copies
from ..operators.similarity import cosine_pairs, profile_pairs, profile_vectors
from ..operators.vectors import LABELLED_WEIGHTING, Weighting, distinct_vectors, vectors
from ..session import release, stage


#: The least similarity that counts as having something in common.
LEAST = 1e-9


@dataclass(frozen=True)
class TitleTerms:
    """How a title becomes terms. Each part may be replaced by any column function."""

    normalise: Callable[[Column], Column] = text.tidy_title
    tokenise: Callable[[Column], Column] = text.word_tokens
    stop_words: Sequence[str] = ()
    ngrams: tuple[int, int] = (1, 3)

    def __call__(self, title: Column) -> Column:
        tokens = text.drop_words(self.tokenise(self.normalise(title)), self.stop_words)
        return text.ngrams(tokens, self.ngrams)


def distinct_titles(records: DataFrame, id_col: str, title: str, terms: TitleTerms) -> DataFrame:
    """(id, copies, title): one row per distinct normalised title."""
    tidy = records.select(F.col(id_col).alias("record"), terms.normalise(F.col(title))
                          .alias("title"))
    return copies(tidy, ["title"], "record")


@dataclass(frozen=True)
class TitleClusters:
    """``texts`` (id, copies, title), the merges, ``labels`` (id, cluster) of the texts, and
    ``members`` (record, id): the text of every record, also of one without a title."""

    texts: DataFrame
    merges: DataFrame | None
    labels: DataFrame
    members: DataFrame

    def records(self) -> DataFrame:
        """(id, cluster) of every record."""
        return self.members.join(self.labels, "id").select(
            F.col("record").alias("id"), "cluster"
        )


def text_of_records(
    records: DataFrame, id_col: str, title: str, terms: TitleTerms, texts: DataFrame,
) -> DataFrame:
    """(record, id): every record with the id of its normalised title.

    The titles meet by hash and are then compared, so that the join carries no long keys.
    """
    tidy = records.select(F.col(id_col).alias("record"), terms.normalise(F.col(title))
                          .alias("own")).withColumn("hash", F.xxhash64("own"))
    named = texts.select("id", "title").withColumn("hash", F.xxhash64("title"))
    same = (tidy["hash"] == named["hash"]) & F.col("own").eqNullSafe(F.col("title"))
    return tidy.join(named, same).select("record", "id")


def cluster_titles(
    records: DataFrame, id_col: str, title: str, terms: TitleTerms = TitleTerms(),
    weighting: Weighting = LABELLED_WEIGHTING, cut: float = 0.88, method: str = "complete",
    inclusive: bool = False, space: str = "cosine", bands: Sequence[float] | None = None,
    k: int | None = None,
) -> TitleClusters:
    """Hierarchical clusters of titles.

    ``space`` says which rows are compared by cosine: the term vectors themselves (cosine), the
    rows of their similarity matrix (profile) or of their distance matrix (distance profile).
    ``method`` is complete, average, single (components only, without merges), single tree or
    ward. ``bands`` finds the pairs of complete linkage on term vectors band by band, for loose
    cuts. Ward's linkage has the whole tree as merges and ``k`` clusters in place of a cut.
    Records with the same title share its cluster; a title without terms is its own.
    """
    texts = stage(distinct_titles(records, id_col, title, terms), "titles")
    tokens = text.drop_words(terms.tokenise(F.col("title")), terms.stop_words)
    sparse, _ = vectors(texts, text.ngrams(tokens, terms.ngrams), weighting)
    named, one = distinct_vectors(sparse, texts, ["vector"])
    release(sparse)  # the distinct ones are a table of their own
    sizes = one.select("id", "copies")
    members = stage(text_of_records(records, id_col, title, terms, texts), "members")
    ids = sizes.select("id")
    if method == "ward":
        if k is None or space != "cosine":
            raise ValueError("Ward's linkage takes term vectors and a number of clusters")
        merges = tree.ward(one.select("id", "vector"), sizes)
        labels = tree.clusters(ids, stage(tree.cut_to(merges, ids, k), "cut"))
        return TitleClusters(texts, merges, _labelled(texts, named, labels), members)
    if space == "cosine" and (cut > 1 or (cut == 1 and inclusive)):
        # Weights are not negative, so every two titles with a term are within the cut.
        return TitleClusters(texts, None, _one_cluster(texts, named), members)
    if bands is not None:
        if method != "complete" or space != "cosine":
            raise ValueError("bands are for complete linkage of term vectors")
        merges = tree.complete_by_bands(one.select("id", "vector"), sizes, cut, inclusive, bands)
        return TitleClusters(texts, merges, _labelled(texts, named, tree.clusters(ids, merges)), members)
    sides = None
    if space == "cosine":
        # All pairs are within an inclusive cut, so those that connect the others are enough.
        pairs = cosine_pairs(one, max(1.0 - cut, LEAST), forest=method == "single" and inclusive)
        if method == "average":
            vector = F.transform("vector", lambda e: F.struct(
                e.number.alias("number"), e.weight.alias("weight")))
            sides = one.select("id", vector.alias("a"), vector.alias("b"))
    else:
        sides = stage(profile_vectors(one.select("id", "vector"), sizes,
                                      distances=space == "distance profile"), "sides")
        pairs = profile_pairs(sides, 1.0 - cut)
    if method == "single":
        d = F.round(1.0 - F.col("sim"), 12)
        near = d <= round(cut, 12) if inclusive else d < round(cut, 12)
        merges = None
        labels = tree.components(ids, pairs.filter(near))
    elif method == "single tree":
        merges = tree.single_linkage(pairs, sizes, cut, inclusive)
        labels = tree.components(ids, merges.select(F.col("left").alias("a"), F.col("right").alias("b")))
    else:
        merges = tree.linkage(pairs, sizes, cut, method, inclusive, sides)
        labels = tree.clusters(ids, merges)
    return TitleClusters(texts, merges, _labelled(texts, named, labels), members)


def _labelled(texts: DataFrame, named: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, cluster) of all texts from those of the distinct vectors."""
    return (
        texts.select("id").join(named, "id", "left")
        .join(labels.toDF("vector_id", "cluster"), "vector_id", "left")
        .select("id", F.coalesce("cluster", "id").alias("cluster"))
    )


def _one_cluster(texts: DataFrame, named: DataFrame) -> DataFrame:
    """(id, cluster): all texts with a term under the least of them, the others alone."""
    least = F.broadcast(named.agg(F.min("id").alias("least")))  # one row
    return texts.select("id").join(named.select("id", "vector_id"), "id", "left").join(least).select(
        "id", F.when(F.col("vector_id").isNotNull(), F.col("least")).otherwise(F.col("id"))
        .alias("cluster")
    )


def assignments(
    records: DataFrame, id_col: str, title: str, found: TitleClusters,
    terms: TitleTerms = TitleTerms(), carry: Sequence[str] = (),
) -> DataFrame:
    """Every record with its cluster, beside the columns to compare it with, by cluster.

    Record ids are unique; a null title is a title of its own kind.
    """
    listed = records.select(
        F.col(id_col).alias("id"), *carry, terms.normalise(F.col(title)).alias("title")
    )
    clusters = found.records().withColumnRenamed("cluster", "new_cluster")
    return (
        listed.join(clusters, "id")
        .select("id", *carry, "new_cluster", "title")
        .orderBy("new_cluster", "id")
    )
