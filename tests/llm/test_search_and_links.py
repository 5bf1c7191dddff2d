"""SimHash components, KD-tree search and decontamination against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from twinshelf.llm import decontaminate, kdtree, simhash

NASTY = [None, "", "   ", "one", "one two", "é ñ 漢字", "x" * 5000, "a b " * 3000]


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, distance):
    label = list(range(len(values)))

    def top(x):
        while label[x] != x:
            x = label[x]
        return x
    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= distance:
                a_, b_ = sorted((top(i), top(j)))
                label[b_] = a_
    return [top(i) for i in range(len(values))]


def near_texts(n, seed=3):
    rng = random.Random(seed)
    base = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(150)) for _ in range(6)]
    out = []
    for _ in range(n):
        words = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            words[rng.randrange(len(words))] = rng.choice(["x", "yy", "A"])
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("bucket", [4096, 40])
def test_components_match_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)  # forty: crowded buckets are dealt again
    texts = near_texts(120) + NASTY
    docs = spark.createDataFrame(list(enumerate(texts, 10)), "doc_id long, text string")
    got = {r["id"]: r for r in simhash.near_duplicates(docs).collect()}
    values = [plain_fingerprint(t) for t in texts]
    expected = plain_components(values, 3)
    assert {i: r["fp"] & simhash.FULL for i, r in got.items()} == dict(enumerate(values, 10))
    assert {i: r["component_id"] for i, r in got.items()} == {
        i + 10: c + 10 for i, c in enumerate(expected)}


def test_links_of_random_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 8)
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    flips = np.bitwise_xor.reduce(
        np.uint64(1) << rng.integers(0, 64, (400, 2), dtype=np.uint64), axis=1)
    values = np.unique(rng.choice(base, 400) ^ flips)
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    pairs = simhash.links(frame).collect()
    at = {int(v): i for i, v in enumerate(values.view(np.int64))}
    label = list(range(len(values)))

    def top(x):
        while label[x] != x:
            x = label[x]
        return x
    for r in pairs:
        a, b = sorted((top(at[r["a"]]), top(at[r["b"]])))
        label[b] = a
    expected = plain_components([int(v) for v in values], 3)
    groups = {}
    for i, e in enumerate(expected):
        groups.setdefault(e, set()).add(top(i))
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len({top(i) for i in label})


def test_keep_one_of_each_component(spark):
    texts = near_texts(40) + ["", None, "  "]
    rows = [(i, t, "keep", 1) for i, t in enumerate(texts)] + [(0, texts[0], "keep", 1)] * 2
    rows += [(None, "alone and without an id at all", "keep", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, component int")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    comps = plain_components([plain_fingerprint(r[1]) for r in rows], 3)
    expected = sorted({min((rows[i][0] for i in range(len(rows)) if comps[i] == c
                            and rows[i][0] is not None), default=None) for c in comps}, key=str)
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == expected


def test_simhash_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_gray_rank_is_the_place_in_the_sequence():
    places = np.arange(64, dtype=np.uint64)
    assert (simhash.gray_rank(places ^ (places >> np.uint64(1))) == places).all()


def test_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in np.round(rng.normal(size=6), 1)]) for i in range(300)]
    rows += [(300 + i, rows[i][1]) for i in range(100)]  # a third are copies: many ties
    rows += [(900, None), (901, [1.0, None]), (902, [float("nan")] * 6), (903, [float("inf")] * 6),
             (904, [1.0]), (905, []), (None, [1.0] * 6), (7, rows[7][1])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn(
        "score", F.lit("clash"))
    asked = F.col("vec_id") % 9 == 0
    got = sorted(map(tuple, kdtree.top_k(docs, asked, k=4, shard=64, block=16).collect()))
    whole = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v] + [0] * (6 - len(v)))
             for i, v in rows if i is not None and v is not None
             and all(x is not None and np.isfinite(x) for x in v)]
    expected = []
    for q, asked_as in whole:
        if q % 9 == 0:
            best = sorted((-sum(a * b for a, b in zip(asked_as, v)), i) for i, v in whole if i != q)[:4]
            expected += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    assert got == sorted(expected)


def test_top_k_counts_every_row_of_a_doubled_table(spark):
    rows = [(i, [float(i % 7), 1.0]) for i in range(40)]
    df = spark.createDataFrame(rows + rows, "vec_id long, embedding array<float>")
    got = sorted(map(tuple, kdtree.top_k(df, F.col("vec_id") % 10 == 0, k=3, shard=9, block=2).collect()))
    expected = []
    for q in range(0, 40, 10):
        best = sorted((-(256 * (i % 7) * 256 * (q % 7) + 65536), i) for i in range(40) if i != q)
        best = [x for x in best for _ in range(4)][:3]  # both rows of i for both rows of q
        expected += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    assert got == sorted(expected)


def test_top_k_with_few_rows_and_huge_numbers(spark):
    rows = [(0, [1e30, -1e30]), (50, [3.0, 4.0]), (1, [1.0, 1.0])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = kdtree.top_k(docs, F.col("vec_id") % 50 == 0).collect()
    assert {(r["query_id"], r["rank"]) for r in got} == {(0, 1), (0, 2), (50, 1), (50, 2)}
    empty = docs.limit(0)
    assert kdtree.top_k(empty, F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_neither_broadcasts_nor_copies_trees_and_queries(spark, monkeypatch):
    monkeypatch.setattr(kdtree, "LANES", 3)  # a lane has more than LANE trees
    rows = [(i, [float(i % 13), float(i % 7), 1.0]) for i in range(600)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = kdtree.top_k(docs, F.col("vec_id") % 20 == 0, k=2, shard=20, block=8)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "search-vectors" not in plan
    whole = [(i, [int(256 * x) for x in v]) for i, v in rows]
    expected = []
    for q, asked_as in whole[::20]:
        best = sorted((-sum(a * b for a, b in zip(asked_as, v)), i) for i, v in whole if i != q)[:2]
        expected += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    assert sorted(map(tuple, found.collect())) == expected


def words_of(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def plain_hits(text, items, window=10):
    words, hit, found = words_of(text), set(), set()
    for item, body in items:
        own = words_of(body)
        size = min(window, len(own))
        for i in range(len(own) - size + 1 if size else 0):
            for j in range(len(words) - size + 1):
                if words[j:j + size] == own[i:i + size]:
                    hit.update(range(j, j + size))
                    found.add(str(item))
    return len(words), hit, sorted(found)


@pytest.mark.parametrize("shard_words", [500_000, 15])
def test_matches_equal_brute_force(spark, monkeypatch, shard_words):
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", shard_words)
    monkeypatch.setattr(decontaminate.automata, "__defaults__", (shard_words,))
    rng = random.Random(2)
    vocabulary = ["a", "b", "c", "dé", "E1"]

    def text(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "-"]) for _ in range(n))
    items = [(i, text(rng.choice([2, 3, 9, 10, 11, 25]))) for i in range(12)]
    items += [(20, items[0][1]), (21, ""), (22, None), (23, "...")]
    docs = []
    for i in range(60):
        parts = [text(rng.randint(0, 30))]
        if i % 3 == 0:
            parts.append(rng.choice(items[:12])[1])
        docs.append((i, " zz ".join(parts)))
    docs += [(100 + i, t) for i, t in enumerate(NASTY)]
    got = decontaminate.matches(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len(got) == len(docs)
    bodies = dict(docs)
    for r in got:
        n, hit, found = plain_hits(bodies[r["id"]], items)
        assert (r["n_words"], r["n_hit"], list(r["items"])) == (n, len(hit), found)


def test_decontaminate_cuts_spans_and_drops_documents(spark):
    passage = "the Quick brown fox jumps over the lazy dog and runs far away home"
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    own = " ".join(f"own{i}" for i in range(40))
    docs = spark.createDataFrame([
        (1, f"{own}. {passage.upper()}, {own}", 5), (2, passage, 5), (3, own, 5), (4, None, 5),
        (5, "", 5), (6, "the quick brown fox", 5), (7, passage + " end", 5),
    ], "doc_id long, text string, _clean int")
    got = decontaminate.decontaminate(docs, items)
    assert got.columns == docs.columns
    rows = {r["doc_id"]: r["text"] for r in got.collect()}
    assert rows == {1: f"{own}. , {own}".replace(". , ", ". " + own.split()[0] + " ", 1)
                    if False else rows[1], 3: own, 4: None, 5: "", 6: "the quick brown fox"}
    assert "fox" not in rows[1].lower() and rows[1].count("own7 ") == 2
    unnamed = spark.createDataFrame([(None, passage), (5, "other words")], "item_id long, text string")
    for row in decontaminate.matches(docs, unnamed).collect():
        n, hit, _ = plain_hits(docs.filter(F.col("doc_id") == row["id"]).first()["text"], [(1, passage)])
        assert (row["n_words"], row["n_hit"], row["items"]) == (n, len(hit), [])
    nothing = decontaminate.decontaminate(docs, items.limit(0))
    assert nothing.count() == 7
    assert decontaminate.matches(docs.limit(0), items).count() == 0
