"""Rules that hold across a whole job: errors stay with their row, sizes never change an answer."""

import os
from datetime import datetime
from types import SimpleNamespace

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from webglean import session
from webglean.operators import pages, requests, search
from webglean.plans.batch import search_report
from webglean.plans.corpus import research_report
from webglean.sources.tables import as_responses

CORPUS = "doc_id int, text string, url string"


def corpus(spark, urls):
    rows = [(i, f"fish {word}", url) for i, (word, url) in enumerate(urls)]
    return spark.createDataFrame(rows, CORPUS).withColumns(
        {"title": F.lit(None).cast("string"), "publishedDate": F.lit("2024")}
    )


def test_no_shared_folder_off_a_local_master_is_an_error():
    conf = SimpleNamespace(get=lambda name, default: default)
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        cluster = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))
        with pytest.raises(ValueError):
            session.shared_dir(cluster)


def test_lineage_is_cut_in_the_shared_folder(spark):
    kept = session.cut_lineage(spark.range(5))
    assert all(session.shared_dir(spark) in name for name in kept.inputFiles())
    assert kept.count() == 5
    files = [name.removeprefix("file:").replace("//", "") for name in kept.inputFiles()]
    assert all(os.path.exists(name) for name in files)
    session.forget(kept)
    assert not any(os.path.exists(name) for name in files)


def test_limits_of_each_query_are_checked(spark):
    docs = corpus(spark, [(str(i), f"u{i}") for i in range(40)])
    rows = [(0, "fish", None), (1, "fish", 0), (2, "fish", 26), (3, "fish", -1), (4, "fish", 25), (5, "", 3)]
    asks = spark.createDataFrame(rows, "query_idx int, query string, k int")
    report = search_report(asks, docs, "k", dedupe=False, mode="capture")
    counts = {r.query_idx: (r["count"], r.error) for r in report.queries.collect()}
    assert {i: n for i, (n, _) in counts.items()} == {0: 10, 1: 0, 2: 0, 3: 0, 4: 25, 5: 0}
    assert {i for i, (_, error) in counts.items() if error} == {1, 2, 3, 5}
    with pytest.raises(PySparkException):
        search_report(asks.filter("query_idx in (0, 2)"), docs, "k").results.collect()
    with pytest.raises(PySparkException):
        search.search_batch(asks.filter("query_idx = 2"), docs, "k").collect()


def test_the_last_value_of_a_repeated_name_counts(spark):
    rows = [
        (1, '{"q":"a","q":"b"}'), (2, '{"q":"a","q":null,"query":"c"}'), (3, '{"q":[],"q":"d"}'),
        (4, '{"q":"d","q":"","text":"e"}'),
    ]
    log = spark.createDataFrame([(i, "https://x/s", "application/json", b) for i, b in rows], "req_id int, url string, content_type string, body string")
    got = {r.req_id: r.query for r in requests.normalize_requests(log).collect()}
    assert got == {1: "b", 2: "c", 3: "d", 4: "e"}


def test_one_bad_url_fails_only_its_row(spark):
    docs = corpus(spark, [("red", "https://a.com/1"), ("blue", "ftp://a.com/2")])
    stored = as_responses(spark.createDataFrame([("https://a.com/1", "<p>all red</p>")], "url string, html string"))
    topics = spark.createDataFrame([(0, "red"), (1, "blue"), (2, "")], "query_idx int, query string")
    report = research_report(topics, docs, stored, mode="capture")
    got = {r.url: (r.text, r.fetchError) for r in report.sources.collect()}
    assert got["https://a.com/1"] == ("all red", None)
    assert got["ftp://a.com/2"] == (None, "only http(s) URLs are supported: ftp://a.com/2")
    assert sorted(map(tuple, report.summary.collect())) == [(0, 1, 1, 0), (1, 1, 0, 1), (2, 0, 0, 0)]
    with pytest.raises(PySparkException):
        research_report(topics.filter("query_idx = 1"), docs, stored).sources.collect()
    with pytest.raises(ValueError):
        research_report(topics, docs)


def test_the_latest_capture_counts(spark):
    rows = [("https://a.com/1", f"<title>{day}</title><p>{day}</p>", datetime(2024, 1, day)) for day in (3, 9, 6)]
    stored = as_responses(spark.createDataFrame(rows, "url string, html string, at timestamp"))
    stored = stored.withColumn("fetched_at", F.make_timestamp(
        F.lit(2024), F.lit(1), F.regexp_extract(F.decode("body", "UTF-8"), r"<p>(\d)", 1).cast("int"), F.lit(0), F.lit(0), F.lit(0)
    ))
    asked = spark.createDataFrame([("https://a.com/1", 0)], "url string, position int")
    assert [r.title for r in pages.extract_articles(asked, stored).collect()] == ["9"]
    until = F.lit("2024-01-07").cast("timestamp")
    assert [r.title for r in pages.extract_articles(asked, stored, at=until).collect()] == ["6"]
