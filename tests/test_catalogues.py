import random

from pyspark.sql import functions as F

from twinshelf.functions import text
from twinshelf.operators import centroids
from twinshelf.operators.vectors import Weighting
from twinshelf.plans.catalogues import Matcher, complete_linkage, tfidf
from twinshelf.sources.tables import keyed_update


def shops(spark):
    pick = random.Random(9)
    names = ["red ring 8gb", "red ring 16gb", "blue rod", "old plate", "new anvil"]
    make = lambda n: [(i, pick.choice(names), pick.choice(["Acme", "Bolt", None]))
                      for i in range(n)]
    schema = "id long, name string, brand string"
    return spark.createDataFrame(make(30), schema), spark.createDataFrame(make(40), schema)


def test_two_catalogues_share_clusters(spark):
    left, right = shops(spark)
    matcher = Matcher(vectorise=tfidf(Weighting()), cluster=complete_linkage(0.42))
    found = matcher.match(left, right, "id", "id")
    records = found.records.collect()
    assert sorted((r.side, r.id) for r in records) == sorted(
        [("left", i) for i in range(30)] + [("right", i) for i in range(40)])
    label = {(r.side, r.id): r.cluster_id for r in records}
    texts = {}
    for side, df in (("left", left), ("right", right)):
        for r in df.collect():
            assert texts.setdefault((r.name, r.brand), label[side, r.id]) == label[side, r.id]
    # Titles apart by one number and of the same brand are the same product at this cut; a
    # different brand is not.
    assert texts["blue rod", "Acme"] != texts["blue rod", "Bolt"]
    counts = found.clusters.agg(F.sum("n_left"), F.sum("n_right")).first()
    assert tuple(counts) == (30, 40)
    back = keyed_update(left, found.records.filter("side = 'left'").select("id", "cluster_id"),
                        "id")
    assert back.count() == 30 and back.filter("cluster_id IS NULL").count() == 0


def test_fixed_number_of_clusters(spark):
    rows = [(i, 1 + i % 2, t) for i, t in enumerate(
        ["red ring", "ring red red", "blue rod", "rod blue blue", "old plate", "plate old old"])]
    texts = spark.createDataFrame(rows, "id long, copies long, title string")
    ready = centroids.ml_vectors(texts, text.word_tokens(F.col("title")), Weighting())
    for run in (centroids.kmeans, centroids.bisecting_kmeans):
        got = {r.id: r.cluster for r in run(ready, 3).collect()}
        assert [got[0] == got[1], got[2] == got[3], got[4] == got[5]] == [True] * 3
        assert len(set(got.values())) == 3
