"""Jaccard components against all pairs."""

import random
import re

import numpy as np
import pytest

from twinshelf.llm import jaccard


def plain_set(text, k=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def plain(rows, share=80, k=5):
    sets = [plain_set(t, k) for _, t in rows]
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= share * len(a | sets[j]):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (doc, _), top in zip(rows, label):
        known = least.get(top)
        least[top] = doc if known is None else known if doc is None else min(doc, known)
    return sorted(((doc, len(s), least[t]) for (doc, _), s, t in zip(rows, sets, label)), key=str)


def texts(seed, families=6, copies=25, alone=60):
    pick = random.Random(seed)
    word = lambda: pick.choice("abcdefghij") * pick.randint(1, 3) + pick.choice("klmnop")
    shared = [word() for _ in range(60)]
    out = []
    for _ in range(families):
        base = [word() for _ in range(pick.choice([6, 30, 150]))]
        for _ in range(copies):
            words = list(base)
            for _ in range(pick.choice([0, 0, 1, 1, 2, 4, 8])):
                words[pick.randrange(len(words))] = word()
            out.append(" ".join(words))
    for _ in range(alone):  # many share a passage, some hold little else
        own = [word() for _ in range(pick.choice([0, 3, 20, 200]))]
        out.append(" ".join(own + shared if pick.random() < 0.5 else own))
    pick.shuffle(out)
    return out


def run(spark, rows, parts=3, **how):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    got = jaccard.jaccard_components(df, **how).collect()
    return sorted(((r["id"], r["n_shingles"], r["component_id"]) for r in got), key=str)


@pytest.mark.parametrize("seed,group,partners,share", [
    (1, 1 << 16, 64, 80), (2, 3000, 2, 80), (3, 1500, 1, 60), (4, 600, 3, 95)])
def test_components_equal_all_pairs(spark, monkeypatch, seed, group, partners, share):
    monkeypatch.setattr(jaccard, "GROUP", group)
    monkeypatch.setattr(jaccard, "PARTNERS", partners)
    monkeypatch.setattr(jaccard, "LEAST", 100)
    rows = list(enumerate(texts(seed), 10))
    assert run(spark, rows, share=share) == plain(rows, share)


def test_nulls_short_texts_and_repeats(spark):
    long = "w%d " * 3000 % tuple(range(3000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE "), (6, "one two"), (7, "a b c d e"),
            (8, "A  b\x0bc d e"), (9, "é ñ 漢字"), (None, "a b c d e"), (None, None), (4, "other text"),
            (4, "one"), (4, "one"), (20, long), (21, long + "x"), (21, long), (None, "no id here"),
            (None, "no id here"), (30, " "), (31, "a b c d e f"), (32, "a b c d e f g h i j")]
    assert run(spark, rows) == plain(rows)
    df = spark.createDataFrame([(1, "a b", "s", 2, 3)], "doc_id long, text string, `set` string, doc int, n int")
    assert [tuple(r)[:2] for r in jaccard.jaccard_components(df).collect()] == [(1, 1)]
    assert jaccard.jaccard_components(df.limit(0)).count() == 0


def test_words_are_cut_alike_in_stretches(monkeypatch):
    text = " ".join(texts(5)).encode()
    whole = jaccard.shingles(text)
    monkeypatch.setattr(jaccard, "STRETCH", 37)
    assert np.array_equal(whole, jaccard.shingles(text))


def test_wide_incidence_is_counted_in_columns(monkeypatch):
    pick = np.random.default_rng(1)
    sets = [np.unique(pick.integers(0, 500, 90)).astype(np.uint64) for _ in range(12)]
    monkeypatch.setattr(jaccard, "COLUMNS", 64)
    got = jaccard._overlaps(sets)
    assert all(got[i, j] == len(set(a.tolist()) & set(b.tolist()))
               for i, a in enumerate(sets) for j, b in enumerate(sets))
