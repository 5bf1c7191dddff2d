import math
import random

import numpy as np
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinshelf.functions import text
from twinshelf.operators import grid, similarity
from twinshelf.operators import vectors as v
from twinshelf.session import stage


def sparse_of(spark, rows, name="vector"):
    texts = spark.createDataFrame(rows, "id long, copies long, title string")
    return v.vectors(texts, text.word_tokens(F.col("title")), v.Weighting(), name)


def dense_of(sparse, name="vector"):
    rows = {r.id: {e.number: e.weight for e in r[name]} for r in sparse.collect() if r[name]}
    numbers = sorted({n for row in rows.values() for n in row})
    return {i: np.array([row.get(n, 0.0) for n in numbers]) for i, row in rows.items()}


def random_titles(n, words, seed):
    pick = random.Random(seed)
    # A popular word in a third of the titles, the others less and less common.
    pool = [f"w{i}" for i in range(words) for _ in range(max(1, words // (i + 1)))]
    return [(i, pick.randint(1, 3), " ".join(pick.choices(pool, k=pick.randint(1, 6))))
            for i in range(n)]


@pytest.mark.parametrize("at_least", [0.12, 0.5, 0.8])
def test_cosine_pairs_equal_brute_force(spark, at_least):
    sparse, _ = sparse_of(spark, random_titles(120, 25, 1))
    rows = dense_of(sparse)
    expected = {
        (a, b): float(rows[a] @ rows[b]) for a in rows for b in rows
        if a < b and round(float(rows[a] @ rows[b]), 12) >= at_least
    }
    got = {(r.a, r.b): r.sim for r in similarity.cosine_pairs(sparse, at_least).collect()}
    assert set(got) == set(expected)
    assert all(math.isclose(got[k], expected[k], abs_tol=1e-9) for k in got)


@pytest.mark.parametrize("entries", [11, 40, 90])
@pytest.mark.parametrize("at_least", [1e-9, 0.3, 0.8])
def test_cosine_pairs_of_many_blocks_list_no_candidates(spark, entries, at_least):
    sparse = stage(sparse_of(spark, random_titles(60, 25, 5))[0], "vectors")
    rows = dense_of(sparse)
    expected = {(a, b) for a in rows for b in rows
                if a < b and round(float(rows[a] @ rows[b]), 12) >= at_least}
    found = similarity.cosine_pairs(sparse, at_least, entries=entries)
    got = [(r.a, r.b) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == expected
    # Term by term meetings, and vectors beside each pair, went through joins and shuffles before.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("weights", [{"t": 0.5, "b": 0.5}, {"t": 0.9, "b": 0.1}])
@pytest.mark.parametrize("at_least", [0.3, 0.58])
def test_weighted_pairs_equal_brute_force(spark, weights, at_least):
    rows = random_titles(100, 20, 2)
    pick = random.Random(3)
    t, _ = sparse_of(spark, rows, "t")
    brands = [(i, 1, f"brand{pick.choice([0, 0, 0, 1, 2, 3])}") for i, _, _ in rows if i % 9]
    b, _ = sparse_of(spark, brands, "b")
    wide = t.join(b, "id", "full")
    t_rows, b_rows = dense_of(wide, "t"), dense_of(wide, "b")

    def sim(x, y):
        parts = (weights["t"], t_rows), (weights["b"], b_rows)
        return sum(w * float(m[x] @ m[y]) for w, m in parts if x in m and y in m)

    ids = [r[0] for r in rows]
    expected = {(x, y) for x in ids for y in ids if x < y and round(sim(x, y), 12) >= at_least}
    got = similarity.weighted_pairs(wide, weights, at_least)
    assert {(r.a, r.b) for r in got.collect()} == expected


@pytest.mark.parametrize("distances", [False, True])
def test_profile_cosine_equals_rows_of_the_matrix(spark, distances):
    rows = random_titles(60, 12, 4)
    sparse, _ = sparse_of(spark, rows)
    copies = {i: n for i, n, _ in rows}
    unit = dense_of(sparse)
    whole = np.array([unit[i] for i in unit for _ in range(copies[i])])
    names = [i for i in unit for _ in range(copies[i])]
    matrix = whole @ whole.T
    matrix = 1 - matrix if distances else matrix
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    first = {i: names.index(i) for i in unit}
    at_least = 0.9 if distances else 0.7
    expected = {(a, b) for a in unit for b in unit
                if a < b and matrix[first[a]] @ matrix[first[b]] >= at_least}
    sizes = spark.createDataFrame([(i, copies[i]) for i in unit], "id long, copies long")
    profiles = similarity.profile_vectors(sparse, sizes, distances)
    got = {(r.a, r.b): r.sim for r in similarity.profile_pairs(profiles, at_least, pivots=5).collect()}
    assert set(got) == expected
    assert all(math.isclose(got[a, b], matrix[first[a]] @ matrix[first[b]], abs_tol=1e-9) for a, b in got)


def test_profiles_by_blocks_of_the_gram_matrix(spark, monkeypatch):
    rows = random_titles(80, 40, 7)
    sparse, _ = sparse_of(spark, rows)
    sizes = spark.createDataFrame([(i, n) for i, n, _ in rows], "id long, copies long")
    whole = similarity.profile_pairs(similarity.profile_vectors(sparse, sizes), 0.6)
    expected = sorted(map(tuple, whole.collect()))
    for name, value in (("COLUMNS", 7), ("ROWS", 25), ("CELLS", 90)):
        monkeypatch.setattr(similarity, name, value)
    again = similarity.profile_pairs(similarity.profile_vectors(sparse, sizes), 0.6)
    got = sorted(map(tuple, again.collect()))
    assert [x[:2] for x in got] == [x[:2] for x in expected]
    assert all(math.isclose(x[2], y[2], abs_tol=1e-9) for x, y in zip(got, expected))


def test_grid_meets_every_pair_once_whatever_the_block(spark):
    pick = random.Random(5)
    rows = [(i, pick.choice([0, 0, 0, 1, 2]), f"x{i}") for i in range(60)]
    df = spark.createDataFrame(rows, "id long, k int, x string")
    key = {i: k for i, k, _ in rows}
    expected = sorted((a, b) for a in key for b in key if a < b and key[a] == key[b])
    for block in (1000, 7):
        met = grid.self_pairs(df, ["k"], block=block).collect()
        assert sorted((r.a_id, r.b_id) for r in met) == expected
        assert all(r.a_x == f"x{r.a_id}" and r.b_x == f"x{r.b_id}" for r in met)
    left, right = df.filter("id % 2 = 0"), df.filter("id % 2 = 1")
    crossed = sorted((a, b) for a in key for b in key
                     if a % 2 == 0 and b % 2 == 1 and key[a] == key[b])
    met = grid.side_pairs(left, right, ["k"], block=5).collect()
    assert sorted((r.a_id, r.b_id) for r in met) == crossed


def test_profiles_of_a_large_vocabulary(spark):
    # 20,000 terms, five of them in each title and one in every title.
    pick = random.Random(9)
    titles = [(i, 1, "all " + " ".join(f"t{(7 * i + j) % 20_000}" for j in range(4)))
              for i in range(0, 3000)] + [(3000 + i, 2, f"t{i} x{i} y{i} z{i} u{i} v{i}") for i in range(2500)]
    sparse, vocab = sparse_of(spark, titles)
    assert vocab.count() >= 15_000
    sizes = sparse.select("id", F.when(F.col("id") < 3000, 1).otherwise(2).alias("copies"))
    profiles = stage(similarity.profile_vectors(sparse, sizes), "profiles")
    got = {(r.a, r.b): r.sim for r in similarity.profile_pairs(profiles, 0.995).collect()}
    rows = {r.id: {e.number: e.weight for e in r.vector} for r in sparse.collect()}
    holders = {}
    for i, row in rows.items():
        for n, w in row.items():
            holders.setdefault(n, []).append((i, w, 1 if i < 3000 else 2))

    def profile(i):
        out = {}
        for n, w in rows[i].items():
            for j, x, _ in holders[n]:
                out[j] = out.get(j, 0.0) + w * x
        scale = math.sqrt(sum(s * s * (1 if j < 3000 else 2) for j, s in out.items()))
        return {j: s / scale for j, s in out.items()}

    for a, b in pick.sample(sorted(got), min(40, len(got))) + [(0, 1), (2, 2900), (5, 3100), (3000, 4000)]:
        x, y = profile(a), profile(b)
        sim = sum(s * y.get(j, 0.0) * (1 if j < 3000 else 2) for j, s in x.items())
        assert math.isclose(got[a, b], sim, abs_tol=1e-9) if (a, b) in got else sim < 0.995 + 1e-9


def test_sums_of_sparse_vectors(spark):
    kind = "array<struct<number: long, weight: double>>"
    rows = [(1, [(1, 1.0), (4, 2.0)], [(2, 1.0), (4, 0.5)]), (2, None, [(7, 1.0)]), (3, [], None)]
    df = spark.createDataFrame(rows, f"id long, x {kind}, y {kind}")
    got = {r.id: [tuple(e) for e in r.s] for r in df.select("id", similarity.sparse_sum(
        "x.number", "x.weight", "y.number", "y.weight").alias("s")).collect()}
    assert got == {1: [(1, 1.0), (2, 1.0), (4, 2.5)], 2: [(7, 1.0)], 3: []}


@pytest.mark.parametrize("entries, at_least", [(60, 0.5), (10_000, 0.3)])
def test_a_forest_of_pairs_connects_what_all_pairs_connect(spark, entries, at_least):
    sparse, _ = sparse_of(spark, random_titles(300, 60, seed=11))
    sparse = stage(sparse, "forest-test")
    every = {(r.a, r.b): r.sim for r in similarity.cosine_pairs(sparse, at_least, entries=entries).collect()}
    some = {(r.a, r.b): r.sim for r in similarity.cosine_pairs(
        sparse, at_least, entries=entries, forest=True).collect()}
    assert some.items() <= every.items() and len(some) < len(every)

    def connected(pairs):
        label = {}

        def top(x):
            while label.setdefault(x, x) != x:
                x = label[x]
            return x
        for a, b in pairs:
            low, high = sorted((top(a), top(b)))
            label[high] = low
        return {x: top(x) for x in label}
    assert connected(some) == connected(every)


def test_places_of_numbers_by_hash():
    rng = np.random.default_rng(2)
    held = np.unique(np.concatenate([rng.integers(0, 1 << 62, 3000), (1 << 33) + np.arange(3000)]))
    asked = np.concatenate([held, rng.integers(0, 1 << 62, 3000), [0, 1 << 33]])
    expected = {n: i for i, n in enumerate(held.tolist())}
    assert similarity.Places(held).of(asked).tolist() == [expected.get(n, -1) for n in asked.tolist()]
    crowded = np.arange(200) * 0  # nothing is found among no numbers
    assert (similarity.Places(np.empty(0, np.int64)).of(crowded) == -1).all()


@pytest.mark.parametrize("crowded", [False, True])
def test_distinct_vectors_by_hash_are_those_by_value(spark, monkeypatch, crowded):
    if crowded:  # every vector has the hash of every other
        monkeypatch.setattr(v, "_hash", lambda names: F.lit(7).cast("long"))
    else:  # whole vectors are no keys
        monkeypatch.setattr(DataFrame, "groupBy", lambda self, *c, f=DataFrame.groupBy: f(self, *c) if
                            "vector" not in c else pytest.fail("grouped by vector"))
    rows = [(i, 1 + i % 3, t) for i, (_, _, t) in enumerate(random_titles(60, 8, seed=4))]
    rows += [(100 + i, 2, t) for i, _, t in rows[:20]] + [(5, 4, rows[5][2]), (None, 1, "w1 w2")]
    texts = spark.createDataFrame(rows, "id long, copies long, title string")
    sparse, _ = v.vectors(texts, text.word_tokens(F.col("title")), v.Weighting())
    of = {r.id: tuple(map(tuple, r.vector)) for r in sparse.collect()}
    copies, least = {}, {}
    for i, n, _ in rows:
        if i in of and i is not None:
            copies[of[i]] = copies.get(of[i], 0) + n
            least[of[i]] = min(least.get(of[i], i), i)
    named, one = v.distinct_vectors(sparse, texts, ["vector"])
    assert sorted(map(tuple, named.select("id", "vector_id").collect())) == sorted(
        (i, least[of[i]]) for i, _, _ in rows if i in of and i is not None)
    assert {(r.id, r.copies): tuple(map(tuple, r.vector)) for r in one.collect()} == {
        (least[x], copies[x]): x for x in copies}
