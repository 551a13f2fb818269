import hashlib
import re

import pytest
from pyspark.sql import functions as F

from webglean.llm import mixing

SHAPE = "doc_id long, source string, text string, size int, _row int"


def filled(sizes, weights, epochs, total=None):
    """Targets by handing the excess out again and again."""
    caps = {k: epochs * n for k, n in sizes.items()}
    target = {k: 0.0 for k in sizes}
    free = {k for k in sizes if weights.get(k, 0) > 0}
    left = float(sum(sizes.values()) if total is None else total)
    while free and left > 1e-6:
        weight = sum(weights[k] for k in free)
        share = {k: left * weights[k] / weight for k in free}
        over = {k for k in free if target[k] + share[k] > caps[k]}
        for k in free:
            gain = min(share[k], caps[k] - target[k])
            target[k] += gain
            left -= gain
        free -= over
        if not over:
            break
    return target


def test_targets_like_water(spark):
    sizes = {"a": 1000, "b": 10, "c": 500, "d": 1, None: 90, "e": 0, "f": 70, "g": 70}
    weights = {"a": 1, "b": 50, "c": 2, "d": 9, None: 4, "e": 3, "f": 0}
    rows = [(k, n, weights.get(k)) for k, n in sizes.items()]
    df = spark.createDataFrame(rows, "source string, source_size long, weight long")
    for epochs, total in ((3, None), (1, None), (4, 700), (2, 10**6)):
        want = filled(sizes, weights, epochs, total)
        got = {r.source: r.target for r in mixing.targets(df, epochs, total).collect()}
        assert got == pytest.approx(want)


def docs_of(spark):
    rows = []
    for i in range(900):
        source = "hot" if i % 3 else ["x", "y", None, "tiny"][i % 4]
        rows.append((i, source, "w " * (i * 7919 % 97 + 1), i, 0))
    rows += [(1, "x", "same \x0b row", 1, 1), (1, "x", "same \x0b row", 1, 1), (2, "x", None, 2, 2), (3, "y", "", 3, 3)]
    rows += [(None, "y", "nul id\x00here éé", 4, 4), (5, "empty", None, 5, 5), (6, "huge", "long " * 300_000, 6, 6)]
    return spark.createDataFrame(rows, SHAPE)


def test_takes_words_near_the_target_and_reruns_agree(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LAST_ROWS", 5)  # several passes over the draws
    docs = docs_of(spark)
    weights = spark.createDataFrame(
        [("hot", 1), ("x", 8), ("y", 2), (None, 3), ("tiny", 0), ("empty", 2), ("huge", 200)],
        "source string, weight int",
    )
    def rows(df):
        shown = df.columns.index("text")
        return sorted((tuple(r[:shown]) + tuple(r[shown + 1:]) for r in df.collect()), key=str)

    mixed = mixing.mix(docs, weights, seed=4)
    assert mixed.columns == [
        "doc_id", "source", "text", "_row", "size", "source_size", "target", "repeats", "taken"
    ]
    again = mixing.mix(docs.repartition(5), weights, seed=4)
    got = rows(mixed)
    assert len(got) == docs.count() and got == rows(again)
    assert got != rows(mixing.mix(docs, weights, seed=5))
    by = {}
    for r in mixed.collect():
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        assert r.taken == r["size"] * r.repeats <= 3 * r["size"]
        all_words, taken, target, largest = by.get(r.source, (0, 0, 0, 0))
        by[r.source] = all_words + r["size"], taken + r.taken, r.target, max(largest, r["size"])
        assert r.source_size is not None
    for source, (all_words, taken, target, largest) in by.items():
        assert target <= 3 * all_words and abs(taken - target) <= largest / 2 + 1e-6, source
    assert by["tiny"][1] == 0 and by["empty"][0] == 0
    copies = mixing.copies(mixed.drop("text"))
    assert copies.count() == mixed.agg(F.sum("repeats")).first()[0]


def test_stop_equals_a_sorted_source(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LAST_ROWS", 3)
    docs = docs_of(spark).filter("source = 'hot'")
    weights = spark.createDataFrame([("hot", 1)], "source string, weight int")
    mixed = mixing.mix(docs, weights, total=30_001)
    got = {r.doc_id: r.repeats for r in mixed.collect()}
    rows, total = [], 0
    for r in docs.collect():
        draw = hashlib.md5(f"0:{r.doc_id}:{hashlib.md5(r.text.encode()).hexdigest()}".encode()).hexdigest()
        rows.append((draw, r.doc_id, len(r.text.split())))
        total += rows[-1][2]
    whole, rest = divmod(30_001, total)
    ends = 0
    for _, doc, n in sorted(rows):
        ends += n
        assert got[doc] == whole + (2 * ends - n <= 2 * rest)


def test_empty_and_one_key(spark):
    weights = spark.createDataFrame([("a", 1)], "source string, weight int")
    none = spark.createDataFrame([], SHAPE)
    assert mixing.mix(none, weights).collect() == []
    assert mixing.mix(none, mixing.cycled_weights(none, (5, 2))).collect() == []
    same = spark.createDataFrame([(1, "a", "one two", 0, 0)] * 50, SHAPE)
    assert {r.repeats for r in mixing.mix(same, weights, total=130).collect()} == {1}
    turns = spark.createDataFrame([(i, s, "t", 0, 0) for i, s in enumerate(["b", None, "B", "é"])], SHAPE)
    got = {r.source: r.weight for r in mixing.cycled_weights(turns, (5, 2, 1)).collect()}
    assert got == {"B": 5, "b": 2, "é": 1, None: 5}
