import zlib
from collections import Counter, defaultdict

import pytest

from webglean.llm import queries, sharding


def check(rows, texts, shards):
    counts = Counter(r.shard for r in rows)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and len(rows) == len(texts)
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts.get(s, 0)))
    want = Counter((k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in texts)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    assert {r.law for r in rows} <= {"rows"} and all(r.grown_shard is None for r in rows)


def test_copies_meet(spark):
    texts = [(i, f"text {i}") for i in range(300)]
    texts += [(1000 + i, f"pair {i // 2}") for i in range(200)]
    texts += [(2000 + i, f"group {i % 7}") for i in range(70)] + [(None, "null id")] * 3
    texts += [(3000 + i, None) for i in range(4)] + [(4000, ""), (4000, ""), (5, "long " * 50_000)]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("shard", sharding.F.lit("x"))
    rows = sharding.shard_rows(df, 8).collect()
    check(rows, texts, 8)
    held = defaultdict(set)
    for r in rows:
        if r["size"] > 1:  # null and empty texts look alike here
            held[r["size"], r.text_crc32].add(r.shard)
    assert all(len(shards) == 1 for shards in held.values())


@pytest.mark.parametrize("copies", [250, 400])
def test_a_hot_text_leaves_the_others_together(spark, copies):
    texts = [(i, "same" if i < copies else f"own {i // 2}") for i in range(400)]
    rows = sharding.shard_rows(spark.createDataFrame(texts, "doc_id long, text string"), 8).collect()
    check(rows, texts, 8)
    held = defaultdict(set)
    for r in rows:
        held[r.doc_id // 2].add(r.shard)
    assert all(len(held[i // 2]) == 1 for i in range(copies, 400))


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_rows(spark, n):
    texts = [(i, "a") for i in range(n)]
    check(sharding.shard_rows(spark.createDataFrame(texts, "doc_id long, text string")).collect(), texts, 8)


def test_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    texts = [tuple(r) for r in docs.collect()]
    rows = queries.op4_label_propagation(spark, "/root/testdata/sf0.01").collect()
    check(rows, texts, 8)
    held = defaultdict(set)
    for r in rows:
        held[r["size"], r.text_crc32].add(r.shard)
    assert sum(len(s) - 1 for s in held.values()) == 0
