"""The conversation trie against dictionaries."""

import hashlib
import random
import zlib

import pytest

from twinshelf.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [x[1:] for x in sorted(v, key=lambda x: x[0])] for c, v in own.items()}
    new = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        new[c] = tuple(own.get(c - c % 100, [])[:h] + v[h:])
    members, ends = {}, {}
    for c, v in new.items():
        for d in range(len(v) + 1):
            members.setdefault(v[:d], []).append(c)
        ends.setdefault(v, []).append(c)
    children = {}
    for key in members:
        if key:
            children.setdefault(key[:-1], []).append(key)
    leaves, saved = {}, {}
    for key in sorted(members, key=len, reverse=True):
        below = children.get(key, [])
        leaves[key] = sum(leaves[k] for k in below) if below else 1
        saved[key] = (len(members[key]) - 1) * (len(key[-1][1]) if key else 0) + sum(
            saved[k] for k in below)
    return {(min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children.get(k, [])),
             leaves[k], saved[k], hashlib.sha256(",".join(
                 map(str, sorted(ends.get(k, [])))).encode()).hexdigest())
            for k, m in members.items()}


def conversations(seed, convs, long=()):
    pick = random.Random(seed)
    rows = []
    for c in range(convs):
        c = c * 3 if c % 5 else c  # some of a hundred, most first ones absent
        common = pick.random() < 0.4  # these begin, and often go on, alike
        for t in range(pick.choice([1, 2, 3, 6, 8])):
            text = f"hello {t}" if common and pick.random() < 0.9 else f"é{pick.randint(0, 3)}" * t
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", text))
    for c, n in long:
        rows += [(c, t, "user", f"turn {t // 2}") for t in range(n)]
    pick.shuffle(rows)
    return rows


def same(spark, rows, **how):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = [tuple(r) for r in prefix_trie.trie(df, **how).collect()]
    assert len(got) == len(set(got)) and set(got) == plain(rows)


@pytest.mark.parametrize("seed,height", [(1, 16), (2, 2), (3, 3)])
def test_nodes_equal_brute_force(spark, seed, height):
    same(spark, list(dict.fromkeys(conversations(seed, 250))), height=height)


def test_long_conversations_take_several_levels(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "STRETCH", 8)
    monkeypatch.setattr(prefix_trie, "ENDS", 3)
    rows = conversations(4, 40, long=[(10_001, 150), (10_002, 150), (10_003, 90), (10_100, 149)])
    same(spark, list(dict.fromkeys(rows)), height=4)


def test_nulls_ties_and_extra_columns(spark):
    rows = [
        (1, None, "user", "first"), (1, 0, None, "a"), (1, 1, "user", None), (1, 2, "user", ""),
        (2, 5, None, None), (None, 1, "user", "nobody's"), (7, None, None, None),
        (300, 1, "user", "same"), (300, 1, "user", "same"), (300, 1, "user", "same"),
        (301, -4, "user", "same"), (-150, 1, "user", "x" * 100_000), (302, 1, "", "same"),
    ]
    same(spark, rows)
    df = spark.createDataFrame([(*r, 0, 1, "z") for r in rows], SCHEMA + ", pos int, depth int, k1 string")
    assert df.count() and {tuple(r) for r in prefix_trie.trie(df).collect()} == plain(rows)


def test_conversations_all_alike(spark):
    rows = [(c, t, "user", f"t{t}") for c in range(120) for t in range(7)]
    same(spark, rows, height=3)


def test_ties_do_not_depend_on_the_order_of_rows(spark):
    rows = [(c, 1, "user", f"t{t}") for c in range(30) for t in range(7)]
    a, b = ({tuple(r) for r in prefix_trie.trie(spark.createDataFrame(x, SCHEMA)).collect()}
            for x in (rows, rows[::-1]))
    assert a == b


def test_an_empty_table_has_no_node(spark):
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).count() == 0
