import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from webglean.llm import queries, resampling
from checks.compare import connect, rows_of

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = [
    "The cat's 3 CATS, the cat; Ünïcode ÜNÏCODE 漢字 the_cat\x00the", "", None, "one", "b a " * 12, "!!! ??? ---",
    "la la la " * 9, "long " * 4000 + "x" * 5000, "the target words of a benchmark " * 5, "the cat " * 10, "the cat " * 10,
]


def features(text, longest):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return grams, len(words)


def plain(texts, target, longest, buckets, percent, least, seed=2024):
    def counted(all_texts):
        return Counter(zlib.crc32(g.encode()) % buckets for t in all_texts for g in features(t, longest)[0])

    s, t = counted(texts), counted(target)
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    rows = []
    for doc, text in enumerate(texts):
        grams, n = features(text, longest)
        weight = sum(gain[zlib.crc32(g.encode()) % buckets] for g in grams) // len(grams) if grams else 0
        h = int(hashlib.sha256(f"{seed}:{doc}".encode()).hexdigest()[:8], 16)
        rows.append([doc, n, len(grams), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0]))
    rank = {r[0]: i + 1 for i, r in enumerate(able[: len(able) * percent // 100])}
    return [(*r, rank.get(r[0])) for r in rows]


@pytest.mark.parametrize("longest, piece", [(1, 1 << 20), (1, 50), (3, 50), (2, 1 << 20)])
def test_equals_plain_counting(spark, monkeypatch, longest, piece):
    monkeypatch.setattr(resampling, "PIECE", piece)
    target = ["the target words of a benchmark", None, "the cat"]
    docs = spark.createDataFrame(
        [(i, t, 0, "kept") for i, t in enumerate(TEXTS)], "doc_id long, text string, weight int, _found string"
    )
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    gain = resampling.gains(
        resampling.bucket_counts(docs, longest, 300), resampling.bucket_counts(goal, longest, 300), 300
    )
    scored = resampling.score(docs, gain, longest)
    assert scored.columns == ["doc_id", "text", "_found", "n_words", "n_features", "weight", "score"]
    drawn = resampling.draw(scored.drop("text", "_found"), 60, 3)
    got = sorted(tuple(r) for r in drawn.collect())
    assert [tuple(r) for r in got] == plain(TEXTS, target, longest, 300, 60, 3)


def test_slots_tell_equal_keys_apart(monkeypatch):
    rng = np.random.default_rng(3)
    grams = [b"g%d" % i for i in rng.integers(0, 300, 5000)]
    monkeypatch.setattr(resampling.xxhash, "xxh64_intdigest", lambda g: int(g[1:]) % 7 * 0x9E3779B97F4A7C15 % 2**64)
    slot, holder = resampling.intern(grams)
    found = {}
    for gram, at in zip(grams, slot.tolist()):
        assert found.setdefault(gram, at) == at and grams[holder[at]] == gram
    assert len(set(found.values())) == len(found) == (holder >= 0).sum()
    assert resampling.intern([])[0].tolist() == []


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    gain = resampling.gains(resampling.bucket_counts(none), resampling.bucket_counts(none))
    assert not gain.any()
    assert resampling.draw(resampling.score(none, gain).drop("text")).collect() == []
    odd = spark.createDataFrame([(None, None), (None, "a " * 30), (None, "a " * 30)], "doc_id long, text string")
    drawn = resampling.draw(resampling.score(odd, gain), 100)
    assert sorted((r.n_words, r["rank"] or 0) for r in drawn.collect()) == [(0, 0), (30, 1), (30, 2)]


@pytest.mark.parametrize("name", ["op11_water_filling", "op13_importance"])
def test_queries_equal_their_sql(spark, name):
    df = queries.REGISTERED[name](spark, SF_DIR)
    answer = connect(SF_DIR).execute(queries.SQL[name])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(
        [d[0] for d in answer.description], answer.fetchall()
    )
