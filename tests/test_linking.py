import random

import pytest
from pyspark.sql import functions as F

from twinshelf.functions import strings
from twinshelf.functions.strings import jaro_winkler
from twinshelf.operators import linking
from twinshelf.operators import candidates as c
from twinshelf.operators.fuzzy import fuzzy_left_join
from twinshelf.operators.linking import Compare, Linkage, listing


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def agree(compare, a, b):
    if a is None or b is None:
        return 0
    if compare.method == "exact":
        return int(a == b)
    if compare.method == "edit":
        longer = max(len(a), len(b))
        return int(longer == 0 or 1 - edits(a, b) / longer >= compare.threshold)
    return int(jaro_winkler(a, b) >= compare.threshold)


COMPARES = (
    Compare("town", "town", "town"),
    Compare("name", "name", "name", "edit", 0.85),
    Compare("street", "street", "street", "jaro_winkler", 0.85),
)


def typo(pick, word):
    chars = list(word)
    for _ in range(pick.choice([0, 0, 1, 1, 2, 3])):
        at = pick.randrange(len(chars) + 1)
        chars[at:at + pick.randint(0, 1)] = pick.choice(["", "x", "y"])
    return "".join(chars)


def records(seed, n=70):
    pick = random.Random(seed)
    names = ["saint mary hospital", "general clinic", "north county health", "a", ""]
    streets = ["12 main street", "400 oak avenue", "7 elm road", ""]
    rows = []
    for i in range(n):
        if i % 3 == 0:  # a third of all rows are copies
            rows.append((i, "CA", "springfield", names[0], streets[0]))
        else:
            rows.append((
                i, pick.choice(["CA", "CA", "NY", "TX", "WA", None]),
                pick.choice(["springfield", "albany", None]),
                pick.choice([None, typo(pick, pick.choice(names))]) if i % 10 == 1
                else typo(pick, pick.choice(names)),
                typo(pick, pick.choice(streets)),
            ))
    return rows


FIELDS = {"town": 2, "name": 3, "street": 4}


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, state string, town string, name string, "
                                       "street string")


def near(left, right, rows_l, rows_r):
    ranks = {k: i for i, k in enumerate(sorted({r[1] for r in rows_l + rows_r} - {None}))}
    return (left[1] in ranks and right[1] in ranks
            and abs(ranks[left[1]] - ranks[right[1]]) <= 1)


def expand(matches, rows_l, rows_r, itself=False):
    """Record pairs behind the profile pairs, with their scores."""
    def members(rows, key):
        same = next(r for r in rows if r[0] == key)
        return [r[0] for r in rows if r[1:] == same[1:]]

    pairs = {}
    for m in matches:
        for a in members(rows_l, m.left_id):
            for b in members(rows_r, m.right_id):
                if itself and m.left_id == m.right_id and a >= b:
                    continue
                pair = (min(a, b), max(a, b)) if itself else (a, b)
                assert pair not in pairs
                pairs[pair] = m.score
    return pairs


@pytest.mark.parametrize("pairing", ["full", "block", "neighbours"])
@pytest.mark.parametrize("at_least", [1, 2])
def test_matches_equal_brute_force(spark, pairing, at_least):
    rows_l, rows_r = records(1), records(2)
    left, right = frame(spark, rows_l), frame(spark, rows_r)
    meets = {
        "full": lambda a, b: True,
        "block": lambda a, b: a[1] is not None and a[1] == b[1],
        "neighbours": lambda a, b: near(a, b, rows_l, rows_r),
    }[pairing]
    keys = {
        "full": lambda: None,
        "block": lambda: c.block_keys(left, right, "state", "state"),
        "neighbours": lambda: c.neighbour_keys(left, right, "state", "state"),
    }[pairing]()
    expected, histogram = {}, {}
    for a in rows_l:
        for b in rows_r:
            if meets(a, b):
                score = sum(agree(x, a[FIELDS[x.label]], b[FIELDS[x.label]]) for x in COMPARES)
                histogram[score] = histogram.get(score, 0) + 1
                if score >= at_least:
                    expected[a[0], b[0]] = score
    work = Linkage(left, right, "id", "id", COMPARES, keys, "state", "state")
    got = work.matches(at_least).collect()
    if pairing == "full":  # profiles without the key may differ in state
        rows_l = [(r[0], None, *r[2:]) for r in rows_l]
        rows_r = [(r[0], None, *r[2:]) for r in rows_r]
    assert expand(got, rows_l, rows_r) == expected
    if at_least == 1:
        counts = work.histogram().collect()
        assert {r.score: r.n_pairs for r in counts} == histogram
        assert [r.score for r in counts] == sorted(histogram, reverse=True)


def test_dedupe_lists_each_unordered_pair_once(spark):
    rows = records(3)
    df = frame(spark, rows)
    compares = (Compare("name", "name", "name", "edit", 0.85),)
    keys = c.neighbour_keys(df, df, "state", "state")
    work = Linkage(df, df, "id", "id", compares, keys, "state", "state", itself=True)
    expected, total = {}, 0
    for a in rows:
        for b in rows:
            if a[0] < b[0] and near(a, b, rows, rows):
                total += 1
                if agree(compares[0], a[3], b[3]):
                    expected[a[0], b[0]] = 1
    thin = [(r[0], r[1], r[3]) for r in rows]
    assert expand(work.matches(1).collect(), thin, thin, itself=True) == expected
    assert {r.score: r.n_pairs for r in work.histogram().collect()} == {
        1: len(expected), 0: total - len(expected)}
    blocks = c.self_candidate_blocks(keys, df, "state")
    assert blocks.agg(F.sum("n_pairs")).first()[0] == total


def test_candidate_sizes(spark):
    rows_l, rows_r = records(4), records(5)
    left, right = frame(spark, rows_l), frame(spark, rows_r)
    keys = c.neighbour_keys(left, right, "state", "state")
    total = sum(near(a, b, rows_l, rows_r) for a in rows_l for b in rows_r)
    assert c.candidate_blocks(keys, left, right, "state", "state").agg(
        F.sum("n_pairs")).first()[0] == total
    assert c.full_size(left, right).first().n_pairs == len(rows_l) * len(rows_r)
    with pytest.raises(ValueError):
        c.neighbour_keys(left, right, "state", "state", window=2)


@pytest.mark.parametrize("method,threshold", [
    ("edit", 0.3), ("edit", 0.5), ("edit", 0.67), ("edit", 1.0), ("jaro_winkler", 0.05),
    ("jaro_winkler", 0.6), ("jaro_winkler", 0.8)])
def test_any_threshold(spark, method, threshold):
    rows_l, rows_r = records(6), records(7)
    rows_l.append((900, "s", "t", "", ""))
    rows_r += [(901, "s", "t", "", ""), (902, "s", "t", "a", "b")]
    compare = Compare("name", "name", "name", method, threshold)
    work = Linkage(frame(spark, rows_l), frame(spark, rows_r), "id", "id", (compare,))
    expected = {(a[0], b[0]): 1 for a in rows_l for b in rows_r if agree(compare, a[3], b[3])}
    thin_l, thin_r = ([(r[0], None, r[3]) for r in rows] for rows in (rows_l, rows_r))
    assert expand(work.matches(1).collect(), thin_l, thin_r) == expected


def test_thresholds_outside_the_range_are_refused():
    for threshold in (0.0, 1.1):
        with pytest.raises(ValueError):
            Compare("a", "b", "c", "edit", threshold)
    with pytest.raises(ValueError):
        Compare("a", "b", "c", "metaphone", 0.7)


def test_many_jaro_winkler_scores_equal_the_plain_ones(spark):
    pick = random.Random(13)
    word = lambda: "".join(pick.choice("abcé😀 ") for _ in range(pick.choice([0, 1, 2, 5, 9, 30, 64])))
    pairs = [(word(), word()) for _ in range(8000)]
    for _ in range(4000):  # copies with a few changes, up to the longest that a mask holds
        one = [pick.choice("abcdefgh") for _ in range(pick.randint(1, 64))]
        other = list(one)
        for _ in range(pick.randint(0, 4)):
            i, j = pick.randrange(len(other)), pick.randrange(len(other))
            other[i], other[j] = other[j], pick.choice("abcdz")
        pairs.append(("".join(one), "".join(other)))
    got = strings.jaro_winkler_many(*map(list, zip(*pairs)))
    assert [strings.jaro_winkler(a, b) for a, b in pairs] == got.tolist()
    odd = [("x" * 70, "x" * 69 + "y"), (None, "a"), ("b", None), ("", ""), ("a", "a"), ("a" * 65, "")]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(odd + pairs[:200])], "id long, a string, b string")
    scores = {r.id: r.s for r in df.select("id", strings.jaro_winkler_similarity("a", "b").alias("s")).collect()}
    assert all(scores[i] == (0.0 if None in p else strings.jaro_winkler(*p))
               for i, p in enumerate(odd + pairs[:200]))


def test_listing_keeps_matches_without_a_lookup(spark):
    matches = spark.createDataFrame(
        [(1, 5, 2, 1, 1), (2, 6, 3, 1, 1), (2, 7, 2, 1, 1)],
        "left_id long, right_id long, score int, n_left long, n_right long",
    )
    lefts = spark.createDataFrame([(1, "x")], "left_id long, left_lookup string")
    rights = spark.createDataFrame([(6, "y")], "right_id long, right_lookup string")
    rows = listing(matches, lefts, rights).collect()
    assert [(r.left_id, r.score, r.left_lookup) for r in rows] == [
        (2, 3, None), (2, 2, None), (1, 2, "x")]


def test_fuzzy_join_equals_brute_force(spark):
    import math
    rows_l, rows_r = records(6), [r for r in records(7) if r[0] % 2]
    left = frame(spark, rows_l)
    right = frame(spark, rows_r).toDF("rid", "rstate", "rtown", "rname", "rstreet")
    got = {r.id: r for r in fuzzy_left_join(
        left, right, ["name", "town", "state"], ["rname", "rtown", "rstate"], "id", "rid"
    ).collect()}
    assert sorted(got) == [r[0] for r in rows_l]
    places = (3, 2, 1)

    def tokens(row, place):
        return set((row[place] or "").split())

    weight = {}
    for place in places:
        df = {}
        for row in rows_l + rows_r:
            for token in tokens(row, place):
                df[token] = df.get(token, 0) + 1
        n = len(rows_l) + len(rows_r)
        weight[place] = {t: math.log((1 + n) / (1 + k)) + 1 for t, k in df.items()}

    def score(a, b):
        total = 0.0
        for place in places:
            mass = [sum(weight[place][t] for t in tokens(x, place)) for x in (a, b)]
            if max(mass) > 0:
                common = tokens(a, place) & tokens(b, place)
                total += sum(weight[place][t] for t in common) / max(mass)
        return round(total / 3, 9)

    for row in rows_l:
        best = min((-score(row, b), b[0]) for b in rows_r)
        found = got[row[0]]
        if best[0] == 0:
            assert found.rid is None and found.best_match_score is None
        else:
            assert abs(found.best_match_score + best[0]) < 1e-8
            assert found.rid == best[1]


@pytest.mark.parametrize("piece", [1000, 7])
def test_record_pairs_of_profiles(spark, monkeypatch, piece):
    monkeypatch.setattr(linking, "PIECE", piece)
    pick = random.Random(12)
    # A third of all records are one profile; some values and keys are missing.
    def table(start, n):
        return [(start + i, *(("k1", "red", "ring") if i % 3 == 0 else (
            pick.choice(["k1", "k2", None]), pick.choice(["red", "blue", None]), pick.choice(["ring", "rod"]))))
            for i in range(n)]
    rows, others = table(0, 45), table(100, 40)
    schema = "id long, key string, colour string, name string"
    left, right = spark.createDataFrame(rows, schema), spark.createDataFrame(others, schema)
    compares = (Compare("colour", "colour", "same_colour"), Compare("name", "name", "same_name"))
    for keyed in (True, False):
        keys = c.block_keys(left, right, "key", "key") if keyed else None
        link = Linkage(left, right, "id", "id", compares, keys, "key", "key")
        got = [(r.left_record, r.right_record, r.score) for r in link.record_pairs(link.matches(1)).collect()]
        expected = [(a[0], b[0], (a[2] == b[2] is not None) + (a[3] == b[3])) for a in rows for b in others
                    if (not keyed or a[1] == b[1] is not None)]
        assert sorted(got) == sorted(p for p in expected if p[2] >= 1)
    link = Linkage(left, left, "id", "id", compares, c.neighbour_keys(left, left, "key", "key", 1),
                   "key", "key", itself=True)
    got = [(min(r.left_record, r.right_record), max(r.left_record, r.right_record))
           for r in link.record_pairs(link.matches(2)).collect()]
    expected = [(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[1] == b[1] is not None
                and a[2] == b[2] is not None and a[3] == b[3]]
    assert sorted(got) == expected


@pytest.mark.parametrize("itself", [False, True])
def test_crowded_keys_are_compared_in_matrices(spark, monkeypatch, itself):
    for name, value in (("MANY", 0), ("CHEAPER", 1e9), ("SIDE", 5)):
        monkeypatch.setattr(linking, name, value)
    rows_l = records(3)
    rows_r = rows_l if itself else records(4)
    left = frame(spark, rows_l)
    right = left if itself else frame(spark, rows_r)
    compare = (Compare("name", "name", "name", "edit", 0.85),)
    work = Linkage(left, right, "id", "id", compare, c.block_keys(left, right, "state", "state"),
                   "state", "state", itself=itself)
    assert work._crowded(*[df.withColumn("parts", F.array(F.lit(1))) for df in (
        work._sides["left"].withColumnRenamed("left_key", "right_key"), work._sides["right"])],
        ["right_key"]).count() > 1
    got = [(r.left_record, r.right_record) for r in work.record_pairs(work.matches(1)).select(
        "left_record", "right_record").collect()]
    expected = [(a[0], b[0]) for a in rows_l for b in rows_r
                if a[1] is not None and a[1] == b[1] and agree(compare[0], a[3], b[3])]
    if itself:
        expected = [pair for pair in expected if pair[0] < pair[1]]
        got = [tuple(sorted(pair)) for pair in got]
    assert sorted(got) == sorted(expected)
