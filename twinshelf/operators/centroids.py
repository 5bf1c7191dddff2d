"""Clusterings with a fixed number of clusters."""

from __future__ import annotations

from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .vectors import Weighting, kept_terms, record_count, term_counts, vocabulary


def ml_vectors(
    texts: DataFrame, terms: Column, weighting: Weighting,
) -> DataFrame:
    """(id, copies, features): the same TF-IDF vectors as Spark ML vectors.

    Only the kept vocabulary passes the driver: with a least share of texts or with
    ``max_features`` it does not grow with their number. Texts without a kept term are left
    out; they have no direction to cluster by.
    """
    kept = (
        kept_terms(vocabulary(term_counts(texts, terms)), record_count(texts), weighting)
        .select("term", "idf").orderBy("term").collect()
    )
    if not kept:
        raise ValueError("no term is left within the vocabulary bounds")
    listed = texts.select("id", "copies", terms.alias("terms"))
    counted = CountVectorizerModel.from_vocabulary(
        [row.term for row in kept], inputCol="terms", outputCol="counts"
    ).transform(listed)
    scaled = ElementwiseProduct(
        scalingVec=Vectors.dense([row.idf for row in kept]),
        inputCol="counts", outputCol="scaled",
    ).transform(counted)
    unit = Normalizer(inputCol="scaled", outputCol="features").transform(scaled)
    return unit.filter(F.aggregate(vector_to_array("counts"), F.lit(0.0), lambda t, v: t + v) > 0
                       ).select("id", "copies", "features")


def kmeans(
    vectors: DataFrame, k: int, seed: int = 7, distance: str = "euclidean",
) -> DataFrame:
    """(id, copies, cluster) by k-means over distinct texts weighted by their copies."""
    model = KMeans(
        k=k, seed=seed, distanceMeasure=distance, weightCol="copies", predictionCol="cluster"
    ).fit(vectors)
    return model.transform(vectors).select("id", "copies", "cluster")


def bisecting_kmeans(
    vectors: DataFrame, k: int, seed: int = 7, distance: str = "euclidean",
) -> DataFrame:
    """(id, copies, cluster) by repeated two-way splits until there are ``k`` clusters.

    This stands for the fixed-count tree cuts: like Ward's tree it keeps the variance within
    clusters small, from the top down, and it needs no pair table.
    """
    model = BisectingKMeans(
        k=k, seed=seed, distanceMeasure=distance, weightCol="copies", predictionCol="cluster"
    ).fit(vectors)
    return model.transform(vectors).select("id", "copies", "cluster")
