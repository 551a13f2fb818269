import hashlib
import re

import corpus_pipeline
import pytest

from test_jaccard_join import brute, grams

SF_DIR = "/root/testdata/sf0.001"
NAMES = [name for name, _ in corpus_pipeline.STAGES]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """What every stage returned, by name; "documents" is the input."""
    folder, docs = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = {"documents": docs}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(f"{folder}/{i}")
        docs = found[name] = spark.read.parquet(f"{folder}/{i}")
    return found


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(tables):
    for name in NAMES[:-1]:
        assert tables[name].columns == tables["documents"].columns


def test_toxic_documents_go_and_the_rest_stays(spark, tables):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    before, after = texts(tables["documents"]), texts(tables["toxicity"])
    assert set(after) < set(before)
    gone = set(before) - set(after)
    assert sum(labels.get(i) == 0 for i in gone) == 0
    assert sum(labels.get(i) == 1 for i in gone) > 0


def test_one_of_each_group(tables):
    before, after = texts(tables[NAMES[0]]), texts(tables[NAMES[1]])
    want = {k for (k, _, component) in brute(sorted(before.items())) if k == component}
    assert set(after) == want


def test_benchmarks_go(spark, tables):
    before, after = texts(tables[NAMES[1]]), texts(tables[NAMES[2]])
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    holding = {k for k, t in before.items() if any(item in t for item in items)}
    assert not holding & set(after)
    for gone in set(before) - set(after) - holding:
        assert any(len(grams(before[gone]) & grams(item)) > 2 for item in items)


def test_people_are_hidden_and_ids_decode(tables):
    before, after = texts(tables[NAMES[2]]), texts(tables[NAMES[3]])
    assert set(before) == set(after)
    for k, text in before.items():
        for value in re.findall(r"[\w.+-]+@[\w.-]+\w|\b\d{16}\b|\b[0-9a-f]{40}\b", text):
            assert value not in after[k]
        if not re.search(r"[\d@]", text):
            assert after[k] == text
    assert all(r.n_chars == len(after[r.doc_id]) for r in tables[NAMES[3]].collect())
    import hashlib

    rows = tables[NAMES[4]].collect()
    assert {r.doc_id: r.decoded_sha256 for r in rows} == {
        k: hashlib.sha256(t.encode()).hexdigest() for k, t in after.items()
    }


def test_run_gives_the_last_stage(spark, tables):
    got = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(str, got.collect())) == sorted(map(str, tables[NAMES[-1]].collect()))


def test_a_task_holds_one_python_worker_at_a_time(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "web")], "doc_id long, text string, lang string, source string")
    got = corpus_pipeline.tokenise(spark, docs, SF_DIR)
    assert got._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert [(r.doc_id, r.decoded_sha256) for r in got.collect()] == [(1, hashlib.sha256(b"a b").hexdigest())]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_odd_rows_of_a_stage(spark, name, stage):
    docs = spark.createDataFrame(
        [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "plain words", None, "s", 11), (2, "plain words", None, "s", 11)],
        spark.read.parquet(f"{SF_DIR}/documents.parquet").schema,
    )
    out = stage(spark, docs, SF_DIR)
    assert out.count() == 4
    assert stage(spark, docs.limit(0), SF_DIR).count() == 0


