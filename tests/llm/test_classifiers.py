import zlib

import numpy as np
import pytest

from webglean.llm import quality, queries, toxicity

SF_DIR = "/root/testdata/sf0.01"


def area(scores, truth):
    scores, truth = np.array(scores), np.array(truth, bool)
    good, bad = scores[truth], scores[~truth]
    return (np.greater.outer(good, bad) + 0.5 * np.equal.outer(good, bad)).mean()


@pytest.mark.parametrize("query, label, least", [
    (queries.op1_toxicity, "toxic", 0.95), (queries.op2_quality, "quality", 0.98),
])
def test_held_out_rows(spark, query, label, least):
    rows = {r.doc_id: r for r in query(spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert len(rows) == docs
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    assert all(0 <= r.score <= 1 for r in rows.values())
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    pairs = [(rows[x.doc_id].score, x[label]) for x in labels if rows[x.doc_id].held_out]
    assert area(*zip(*pairs)) >= least


def tables(spark):
    docs = [(i, f"good plain words number {i}", "a", 1.0) for i in range(60)]
    docs += [(100 + i, f"you utter zorkface, {i} you zorkface!!", "b", 1.0) for i in range(60)]
    docs += [(None, "you zorkface", None, None), (300, None, "c", 1.0), (301, "", "c", 1.0)]
    docs += [(302, "you zorkface " * 30_000, "c", 1.0), (5, "good plain words", "c", 1.0)]
    labels = [(i, int(i < 100), int(i >= 100)) for i in [*range(60), *range(100, 160)]]
    labels += [(None, 1, 1), (7, None, None), (8, 1, 0), (301, 1, 0)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, features string, score double"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


@pytest.mark.parametrize("operator", [toxicity, quality])
def test_odd_rows(spark, operator):
    docs, labels = tables(spark)
    model = operator.train(docs, labels)
    got = operator.score(docs, model)
    assert sorted(got.columns) == sorted(docs.columns)
    rows = got.collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r.score for r in rows}
    assert by[300] == by[301]
    bad = [r.score for r in rows if "zorkface" in (r.text or "")]
    good = [r.score for r in rows if "plain" in (r.text or "")]
    assert min(bad) > max(good) if operator is toxicity else max(bad) < min(good)
    assert operator.score(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("operator", [toxicity, quality])
def test_no_labels(spark, operator):
    docs, labels = tables(spark)
    model = operator.train(docs, labels.limit(0))
    assert {r.score for r in operator.score(docs, model).collect()} == {0.0 if operator is toxicity else 0.5}


def test_slots_are_those_of_each_text_alone():
    texts = ["a b&&& c".encode(), b"", "é ü é é".encode(), b"x " * 40]
    slots, owner = quality._slots(texts, 18)
    for i, text in enumerate(texts):
        assert sorted(slots[owner == i]) == sorted(quality._slots([text], 18)[0])
