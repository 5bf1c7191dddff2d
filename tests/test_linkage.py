import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from twinshelf.operators import linkage as tree
from twinshelf.plans.titles import TitleTerms, assignments, cluster_titles
from twinshelf.operators.vectors import Weighting


def by_hand(points, sizes, cut, method, inclusive):
    """Merge the closest clusters one pair at a time; (clusters, merge distances)."""
    groups = {i: [i] for i in points}
    heights = []

    def distance(a, b):
        ds = [1 - float(points[x] @ points[y]) for x in groups[a] for y in groups[b]]
        ws = [sizes[x] * sizes[y] for x in groups[a] for y in groups[b]]
        return round({"complete": max(ds), "single": min(ds),
                      "average": float(np.dot(ds, ws)) / sum(ws)}[method], 12)

    while len(groups) > 1:
        d, a, b = min((distance(a, b), a, b) for a in groups for b in groups if a < b)
        if not (d <= cut if inclusive else d < cut):
            break
        groups[a] += groups.pop(b)
        heights.append(d)
    return {frozenset(g) for g in groups.values()}, sorted(heights)


def random_points(n, seed, dims=3):
    pick = np.random.default_rng(seed)
    rows = np.abs(pick.normal(size=(n, dims)))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    return dict(enumerate(rows))


def vectors_of(spark, points):
    rows = [(i, [(n, float(w)) for n, w in enumerate(p) if w]) for i, p in points.items()]
    return spark.createDataFrame(rows, "id long, vector array<struct<number: long, weight: double>>")


def with_tails(spark, points):
    """Vectors as the similarity join wants them: each entry with the length from there on."""
    rows = [(i, [(n, float(w), float(np.linalg.norm(p[n:]))) for n, w in enumerate(p) if w])
            for i, p in points.items()]
    return spark.createDataFrame(
        rows, "id long, vector array<struct<number: long, weight: double, tail: double>>")


def groups_of(labels):
    found = {}
    for row in labels.collect():
        found.setdefault(row.cluster, set()).add(row.id)
    return {frozenset(g) for g in found.values()}


@pytest.mark.parametrize("method,cut,seed", [
    ("complete", 0.1, 1), ("complete", 0.3, 2), ("average", 0.08, 3), ("average", 0.2, 4),
    ("single", 0.02, 5),
])
def test_linkage_equals_step_by_step_merging(spark, method, cut, seed):
    points = random_points(40, seed)
    sizes = {i: 1 + i % 3 for i in points}
    pairs = [(a, b, float(points[a] @ points[b])) for a in points for b in points
             if a < b and 1 - points[a] @ points[b] <= cut]
    pairs = spark.createDataFrame(pairs, "a long, b long, sim double").repartition(3)
    copies = spark.createDataFrame(list(sizes.items()), "id long, copies long")
    sides = vectors_of(spark, points).select("id", F.col("vector").alias("a"), F.col("vector").alias("b"))
    merges = tree.linkage(pairs, copies, cut, method, inclusive=True, sides=sides)
    labels = tree.clusters(copies.select("id"), merges).collect()
    found = {}
    for row in labels:
        found.setdefault(row.cluster, set()).add(row.id)
    clusters, heights = by_hand(points, sizes, cut, method, True)
    assert {frozenset(g) for g in found.values()} == clusters
    assert all(name == min(group) for name, group in found.items())
    got = sorted(r.distance for r in merges.collect())
    assert len(got) == len(heights)
    assert all(math.isclose(x, y, abs_tol=1e-9) for x, y in zip(got, heights))
    tops = {r.left: r.size for r in merges.orderBy("round").collect()}
    assert all(tops[name] == sum(sizes[i] for i in g) for name, g in found.items() if len(g) > 1)
    if method == "single":
        near = pairs.filter(1 - F.col("sim") <= cut)
        same = tree.components(copies.select("id"), near).collect()
        assert {(r.id, r.cluster) for r in same} == {(r.id, r.cluster) for r in labels}


def test_cut_is_strict_unless_inclusive(spark):
    pairs = spark.createDataFrame([(1, 2, 0.5)], "a long, b long, sim double")
    copies = spark.createDataFrame([(1, 1), (2, 1)], "id long, copies long")
    assert tree.linkage(pairs, copies, 0.5).count() == 0
    assert tree.linkage(pairs, copies, 0.5, inclusive=True).count() == 1


def test_a_long_chain_settles(spark):
    n = 70
    pairs = spark.createDataFrame([(i, i + 1) for i in range(n)], "a long, b long")
    ids = spark.range(n + 2)
    got = {r.id: r.cluster for r in tree.components(ids, pairs).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, n + 1: n + 1}


def rising_from_both_ends(n):
    return [*range(0, n, 2), *range(n - 1, 0, -2)]


@pytest.mark.parametrize("path", [
    rising_from_both_ends(2000), random.Random(5).sample(range(2000), 2000)])
def test_long_paths_settle_in_few_rounds(spark, monkeypatch, path):
    rounds, counted = [], tree.counted_stage
    monkeypatch.setattr(tree, "counted_stage", lambda *a: rounds.append(1) or counted(*a))
    pairs = spark.createDataFrame(list(zip(path, path[1:])), "a long, b long")
    got = tree.components(spark.range(len(path)), pairs).collect()
    assert {r.cluster for r in got} == {0} and len(got) == len(path)
    assert len(rounds) < 20


def test_records_without_a_title_stay(spark):
    rows = [(1, "red ring"), (2, "red ring"), (3, None), (4, "red  RING"), (5, ""), (6, None)]
    records = spark.createDataFrame(rows, "id long, name string")
    how = {"terms": TitleTerms(ngrams=(1, 1)), "weighting": Weighting()}
    found = cluster_titles(records, "id", "name", cut=0.5, **how)
    listed = {r.id: r.new_cluster for r in assignments(records, "id", "name", found).collect()}
    assert set(listed) == {1, 2, 3, 4, 5, 6} and listed[1] == listed[2] and listed[3] == listed[6]
    for method in ("complete", "single"):  # everything with a term is within such a cut
        wide = cluster_titles(records, "id", "name", cut=90, method=method, inclusive=True, **how)
        assert len({r.cluster for r in wide.records().filter("id in (1, 2, 4)").collect()}) == 1


def test_titles_end_to_end(spark):
    pick = random.Random(8)
    names = ["red ring 8 gb", "red ring 16 gb", "blue rod", "blue bolt", "RED ring: 8 gb", "!!!"]
    # A third of all rows are copies of one title.
    rows = [(i, "red ring 8 gb" if i % 3 == 0 else pick.choice(names)) for i in range(60)]
    records = spark.createDataFrame(rows, "id long, name string").withColumn("old", F.lit(1))
    found = cluster_titles(records, "id", "name", TitleTerms(ngrams=(1, 1)), Weighting(), cut=0.5)
    listed = assignments(records, "id", "name", found, TitleTerms(), carry=["old"]).collect()
    assert [r.id for r in listed] == [r.id for r in sorted(listed, key=lambda r: (r.new_cluster, r.id))]
    assert sorted(r.id for r in listed) == list(range(60))
    cluster = {}
    for row in listed:
        assert cluster.setdefault(row.title, row.new_cluster) == row.new_cluster
    again = cluster_titles(records.repartition(5), "id", "name", TitleTerms(ngrams=(1, 1)),
                           Weighting(), cut=0.5)
    assert sorted(map(tuple, again.labels.collect())) == sorted(map(tuple, found.labels.collect()))
    steps = tree.merge_tree(found.merges).orderBy("step").collect()
    assert [r.step for r in steps] == list(range(1, len(steps) + 1))
    assert [r.distance for r in steps] == sorted(r.distance for r in steps)


def test_many_equal_distances_merge_in_few_rounds(spark):
    n = 60
    pairs = spark.createDataFrame(
        [(a, b, 0.9) for a in range(n) for b in range(a + 1, n)], "a long, b long, sim double"
    )
    copies = spark.range(n).select("id", F.lit(1).alias("copies"))
    merges = tree.linkage(pairs, copies, 0.5)
    assert merges.count() == n - 1
    assert {r.cluster for r in tree.clusters(copies.select("id"), merges).collect()} == {0}


def test_sums_are_written_anew_for_changed_clusters_only(spark, monkeypatch):
    monkeypatch.setattr(tree._Sums, "TABLES", 3)
    points = random_points(60, 11)
    pairs = spark.createDataFrame(
        [(a, b, float(points[a] @ points[b])) for a in points for b in points if a < b],
        "a long, b long, sim double")
    copies = spark.createDataFrame([(i, 1 + i % 4) for i in points], "id long, copies long")
    sides = vectors_of(spark, points).select("id", F.col("vector").alias("a"), F.col("vector").alias("b"))
    merges = tree.linkage(pairs, copies, 0.3, "average", inclusive=True, sides=sides)
    expected, heights = by_hand(points, {i: 1 + i % 4 for i in points}, 0.3, "average", True)
    assert groups_of(tree.clusters(copies.select("id"), merges)) == expected
    got = sorted(r.distance for r in merges.collect())
    assert all(math.isclose(x, y, abs_tol=1e-9) for x, y in zip(got, heights, strict=True))


def kruskal(pairs, sizes):
    """Merges of single linkage by going through the pairs in order."""
    top, size, out = {i: i for i in sizes}, dict(sizes), []

    def found(v):
        while top[v] != v:
            v = top[v]
        return v

    tie = lambda a, b: hashlib.md5(f"{a}-{b}".encode()).hexdigest()
    for d, _, a, b in sorted((round(1 - s, 12), tie(a, b), a, b) for a, b, s in pairs):
        x, y = sorted((found(a), found(b)))
        if x != y:
            top[y] = x
            size[x] += size[y]
            out.append((x, y, d, size[x]))
    return out


@pytest.mark.parametrize("forest", [50_000, 5])
def test_single_linkage_merges_equal_going_through_the_pairs(spark, monkeypatch, forest):
    monkeypatch.setattr(tree, "FOREST", forest)
    pick = random.Random(3)
    # Many equal distances, a hub, and parts that never meet.
    pairs = [(a, b, round(pick.random(), 1)) for a in range(50) for b in range(a + 1, 50)
             if pick.random() < 0.1 and a % 3 != 2 and b % 3 != 2]
    pairs += [(0, b, 0.9) for b in range(51, 90)] + [(2, 5, 1.0)]
    sizes = {i: 1 + i % 3 for i in range(95)}
    df = spark.createDataFrame(list(dict.fromkeys(pairs)), "a long, b long, sim double")
    copies = spark.createDataFrame(list(sizes.items()), "id long, copies long")
    for cut in (0.55, 1.0):
        got = tree.single_linkage(df.repartition(3), copies, cut, inclusive=True).orderBy("round").collect()
        expected = kruskal([p for p in dict.fromkeys(pairs) if round(1 - p[2], 12) <= cut], sizes)
        assert [(r.left, r.right, r.distance, r.size) for r in got] == expected
    assert tree.single_linkage(df, copies, -1.0).count() == 0


def test_single_linkage_of_a_path_of_rising_distances(spark):
    n = 300
    pairs = [(i, i + 1, 1 - i / 1000) for i in range(n)]
    df = spark.createDataFrame(pairs, "a long, b long, sim double")
    copies = spark.range(n + 1).select("id", F.lit(1).cast("long").alias("copies"))
    got = tree.single_linkage(df, copies, 1.0).orderBy("round").collect()
    assert [(r.left, r.right, r.size) for r in got] == [(0, i + 1, i + 2) for i in range(n)]


@pytest.mark.parametrize("seed,cut", [(5, 0.5), (6, 0.88)])
def test_complete_linkage_by_bands(spark, monkeypatch, seed, cut):
    monkeypatch.setattr(tree, "MEMBERS", 4)
    monkeypatch.setattr(tree, "PARTNERS", 2)
    pick = np.random.default_rng(seed)
    rows = np.where(pick.random((60, 12)) < 0.4, pick.random((60, 12)), 0) + np.eye(60, 12)
    points = dict(enumerate(rows / np.linalg.norm(rows, axis=1, keepdims=True)))
    copies = spark.createDataFrame([(i, 1 + i % 2) for i in points], "id long, copies long")
    merges = tree.complete_by_bands(with_tails(spark, points), copies, cut, bands=(0.2, 0.5, 0.8))
    expected, heights = by_hand(points, {i: 1 for i in points}, cut, "complete", False)
    assert groups_of(tree.clusters(copies.select("id"), merges)) == expected
    got = sorted(r.distance for r in merges.collect())
    assert all(math.isclose(x, y, abs_tol=1e-9) for x, y in zip(got, heights, strict=True))
    sizes = {r.left: r.size for r in merges.orderBy("round").collect()}
    assert all(sizes[min(g)] == sum(1 + i % 2 for i in g) for g in expected if len(g) > 1)


def ward_by_hand(points, sizes):
    groups = {i: (sizes[i], points[i] * sizes[i]) for i in points}
    out = []
    while len(groups) > 1:
        def apart(a, b):
            (n, x), (m, y) = groups[a], groups[b]
            return round(2 * n * m / (n + m) * float(((x / n - y / m) ** 2).sum()), 10)
        d, a, b = min((apart(a, b), a, b) for a in groups for b in groups if a < b)
        (n, x), (m, y) = groups[a], groups.pop(b)
        groups[a] = n + m, x + y
        out.append((a, b, math.sqrt(d), n + m))
    return out


@pytest.mark.parametrize("few", [256, 6])
def test_ward_equals_step_by_step(spark, monkeypatch, few):
    monkeypatch.setattr(tree, "FEW", few)
    points = random_points(70, 21, dims=5)
    sizes = {i: 1 + i % 5 for i in points}
    copies = spark.createDataFrame(list(sizes.items()), "id long, copies long")
    merges = tree.ward(vectors_of(spark, points), copies)
    expected = ward_by_hand(points, sizes)
    got = sorted((r.distance, r.left, r.right, r.size) for r in merges.collect())
    assert [(a, b, n) for _, a, b, n in got] == [(a, b, n) for a, b, d, n in sorted(
        expected, key=lambda m: (m[2], m[0], m[1]))]
    assert all(math.isclose(x[0], y, abs_tol=1e-7) for x, y in zip(got, sorted(m[2] for m in expected)))
    for k in (1, 7, 70, 90):
        kept = tree.cut_to(merges, copies.select("id"), k)
        labels = groups_of(tree.clusters(copies.select("id"), kept))
        assert len(labels) == min(k, 70)
        top = {i: i for i in points}
        for a, b, _, _ in expected[:max(0, 70 - k)]:
            top = {i: a if t == b else t for i, t in top.items()}
        assert labels == {frozenset(i for i in top if top[i] == t) for t in set(top.values())}
    with pytest.raises(ValueError):
        tree.cut_to(merges, copies.select("id"), 0)
    assert tree.ward(vectors_of(spark, points).limit(0), copies).count() == 0


@pytest.mark.parametrize("method", ["complete", "single"])
def test_last_rounds_in_one_task_are_the_rounds_of_jobs(spark, monkeypatch, method):
    points = random_points(40, 9)
    far = 2 ** 60  # ids that a double does not hold
    pairs = spark.createDataFrame(
        [(far + a, far + b, round(float(points[a] @ points[b]), 1)) for a in points for b in points if a < b],
        "a long, b long, sim double")
    sizes = spark.createDataFrame([(far + i, i % 3 + 1) for i in points], "id long, copies long")
    found = []
    for bound in (0, 300, tree.FINISH):
        monkeypatch.setattr(tree, "FINISH", bound)
        found.append(sorted(map(tuple, tree.linkage(pairs, sizes, 0.6, method, True).collect())))
    assert found[0] and found[0] == found[1] == found[2]


@pytest.mark.parametrize("method", ["complete", "single"])
def test_components_link_by_themselves_as_all_together(spark, monkeypatch, method):
    rows, first = [], 2 ** 60
    for group in range(12):  # one of 28 points, the others smaller
        points = random_points(28 if group == 5 else 3 + group % 6, 20 + group)
        rows += [(first + a, first + b, round(float(points[a] @ points[b]), 1))
                 for a in points for b in points if a < b]
        first += 100
    ids = sorted({x for a, b, _ in rows for x in (a, b)})
    pairs = spark.createDataFrame(rows, "a long, b long, sim double").repartition(5)
    sizes = spark.createDataFrame([(i, i % 3 + 1) for i in ids], "id long, copies long")
    found, rounds = [], []
    monkeypatch.setattr(tree, "_mutual", lambda edges, f=tree._mutual: rounds.append(1) or f(edges))
    for bound, by_jobs in ((0, True), (100, True), (len(rows) - 1, False), (tree.FINISH, False)):
        monkeypatch.setattr(tree, "FINISH", bound)
        rounds.clear()
        found.append(sorted(map(tuple, tree.linkage(pairs, sizes, 0.9, method, True).collect())))
        assert bool(rounds) == by_jobs
    assert found[0] and found[0] == found[1] == found[2] == found[3]


def test_pairs_of_unknown_number_are_not_broadcast(spark, monkeypatch):
    points = vectors_of(spark, random_points(30, 3))
    from twinshelf.operators.similarity import cosine_pairs
    pairs = cosine_pairs(points.withColumn("vector", F.transform("vector", lambda e: F.struct(
        e.number.alias("number"), e.weight.alias("weight"), F.lit(1.0).alias("tail")))), 0.5)
    sizes = points.select("id", F.lit(1).cast("long").alias("copies"))
    plan = tree._edges(pairs, sizes, 0.5, True)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan and "Join" not in plan
    assert tree.linkage(pairs, sizes, 0.5, inclusive=True).count()
