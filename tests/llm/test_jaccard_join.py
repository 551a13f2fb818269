import random
import re
from collections import Counter

import numpy as np
import pytest

from webglean.llm import jaccard_join


def grams(text):
    lower = (text or "").encode()
    lower = re.sub(rb"[A-Z]", lambda m: m[0].lower(), lower)
    words = re.findall(rb"[^\x20\x09-\x0D]+", lower)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [(k, grams(t)) for k, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(sets):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return Counter((k, len(s), None if k is None else least[find(i)]) for i, (k, s) in enumerate(sets))


def made(seed, groups=30, copies=6):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = rng.choices(words, k=60)
    rows = []
    for _ in range(groups):
        base = rng.choices(words, k=rng.choice([6, 20, 80, 200]))
        if rng.random() < 0.5:
            base += passage
        for _ in range(rng.randrange(1, copies)):
            own = list(base)
            for _ in range(rng.randrange(6)):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((len(rows), " ".join(own)))
    return rows


ODD = [
    (9000, None), (9001, ""), (9002, " \t\n\x0b\x0c\r "), (9003, "One two"), (9004, "one  TWO\n"), (9005, "two one"),
    (9006, "a b c d e"), (9007, "a b c d e"), (None, "a b c d e"), (9006, "other text of one id here"),
    (9008, "É b c d e"), (9009, "é b c d e"), (9010, "x y z v w " * 20_000), (9011, "x y z v w " * 10_000),
    (9012, "a\x1cb c d e f g"), (None, None),
]


def answer(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n", "'x' AS set")
    return Counter(tuple(r) for r in jaccard_join.join_components(df, **options).collect())


@pytest.mark.parametrize("options, hot, unit", [
    ({}, 32, 500_000), ({"counted": 300, "block": 400}, 32, 500), ({"counted": 3000}, 3, 500_000),
    ({"counted": 900}, 2, 1500),
])
def test_like_brute_force(spark, monkeypatch, options, hot, unit):
    monkeypatch.setattr(jaccard_join, "HOT", hot)
    monkeypatch.setattr(jaccard_join, "UNIT", unit)
    monkeypatch.setattr(jaccard_join, "LEAST_BITS", 0 if options else 6)
    rows = made(4) + ODD
    assert answer(spark, rows, **options) == brute(rows)


def test_empty_table(spark):
    assert answer(spark, ODD[:0]) == Counter()


def test_tree_finds_what_brute_force_finds():
    rng = np.random.default_rng(8)
    for _ in range(60):
        rows = []
        for _ in range(6):
            base = rng.integers(0, 200, rng.integers(1, 30))
            for _ in range(rng.integers(1, 6)):
                own = np.unique(np.where(rng.random(len(base)) < 0.1, rng.integers(0, 200, len(base)), base))
                rows.append(own.astype(np.uint64))
        rows = list({r.tobytes(): r for r in rows}.values())
        rows.sort(key=lambda r: r.astype(">u8").tobytes())
        sizes = np.array([len(r) for r in rows])
        links = jaccard_join._tree_links(rows, sizes, None, 75)
        root = jaccard_join_roots(len(rows), links)
        pairs = [
            (i, j) for i in range(len(rows)) for j in range(i)
            if 175 * len(np.intersect1d(rows[i], rows[j])) >= 75 * (sizes[i] + sizes[j])
        ]
        assert root == jaccard_join_roots(len(rows), pairs)


def jaccard_join_roots(n, links):
    root = list(range(n))
    for _ in range(n):
        for i, j in links:
            root[i] = root[j] = min(root[i], root[j])
    return root


def _sequences(draw, universe, count, share):
    rows, sizes = {}, {}
    for _ in range(count):
        row = np.unique(draw.choice(universe, draw.integers(1, universe + 1))).astype(np.uint64)
        more = int(draw.integers(0, 2))  # a shingle that no other set has
        rows[row.tobytes()] = row
        sizes[row.tobytes()] = len(row) + (more if len(row) * 100 >= share * (len(row) + more) else 0)
    order = sorted(rows, key=lambda k: rows[k].astype(">u8").tobytes())
    return [rows[k] for k in order], np.array([sizes[k] for k in order])


def _classes(n, pairs):
    root = list(range(n))
    for _ in range(n):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    return root


@pytest.mark.parametrize("share", [50, 75, 100])
def test_tree_equals_all_pairs(share):
    draw = np.random.default_rng(share)
    for _ in range(60):
        rows, sizes = _sequences(draw, int(draw.integers(3, 12)), 25, share)
        sets = [set(r.tolist()) for r in rows]
        for sides in (None, draw.integers(0, 2, len(rows))):
            pairs = [
                (i, j) for i in range(len(rows)) for j in range(i)
                if (sides is None or sides[i] != sides[j])
                and (100 + share) * len(sets[i] & sets[j]) >= share * (sizes[i] + sizes[j])
            ]
            links = jaccard_join._tree_links(rows, sizes, sides, share)
            assert _classes(len(rows), links) == _classes(len(rows), pairs)


def test_steps_grow_with_the_block(monkeypatch):
    """Sets that form one block by shingles of two neighbours only."""
    steps, common = [], jaccard_join._common
    monkeypatch.setattr(jaccard_join, "_common", lambda *a: steps.append(1) or common(*a))
    draw, taken = np.random.default_rng(1), []
    for n in (500, 2_000):
        rows = [np.unique(np.append(10**6 + draw.choice(50 * n, 98), [i, i + 1])).astype(np.uint64) for i in range(n)]
        rows.sort(key=lambda r: r.astype(">u8").tobytes())
        assert jaccard_join._tree_links(rows, np.array([len(r) for r in rows]), None, 75) == []
        taken.append(len(steps))
        steps.clear()
    assert taken[1] < 6 * taken[0]
