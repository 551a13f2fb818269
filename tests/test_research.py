from pyspark.sql import functions as F

from webglean.operators.research import research, research_summary
from webglean.plans.corpus import research_report
from webglean.sources.tables import as_responses

HITS = "topic string, rank int, url string, title string, publishedDate string, text string"


def test_research_merges_articles_into_sources(spark):
    hits = spark.createDataFrame([
        ("t", 1, "u1", "T1", "d1", "s1"), ("t", 2, "u2", "T2", None, "s2"),
        ("dup", 1, "u1", None, None, "first"), ("dup", 2, "u1", "", None, "last"), ("dup", 3, None, "x", None, "no url"),
        ("dup", 4, " u1 ", "y", None, "spaces"), ("dup", 5, "u9", "z", None, "not fetched"),
    ], HITS)
    articles = spark.createDataFrame(
        [("u1", "Page title", "FULL ONE", None), ("u2", None, "", "HTTP 403")], "url string, title string, text string, error string"
    )
    sources = research(hits, articles)
    got = {(r.topic, r["rank"]): (r.title, r.snippet, r.text, r.fetchError) for r in sources.collect()}
    assert got == {
        ("t", 1): ("T1", "s1", "FULL ONE", None), ("t", 2): ("T2", "s2", None, "HTTP 403"),
        ("dup", 1): (None, "first", None, None), ("dup", 2): ("Page title", "last", "FULL ONE", None),
        ("dup", 3): ("x", "no url", None, None), ("dup", 4): ("y", "spaces", None, None), ("dup", 5): ("z", "not fetched", None, None),
    }
    topics = spark.createDataFrame([("t",), ("dup",), ("none",)], "topic string")
    summary = {r.topic: tuple(r)[1:] for r in research_summary(topics, sources).collect()}
    assert summary == {"t": (2, 1, 1), "dup": (5, 1, 0), "none": (0, 0, 0)}


def test_snippets_only(spark):
    hits = spark.createDataFrame([("t", 1, "u1", "T1", None, "s1")], HITS)
    row = research(hits, None, fetch_full=False).first()
    assert (row.snippet, row.text, row.fetchError) == ("s1", None, None)


def test_research_report(spark):
    corpus = spark.createDataFrame(
        [(1, "red fish", "https://a.com/1"), (2, "blue fish", "https://a.com/2")], "doc_id int, text string, url string"
    ).withColumns({"title": F.lit(None).cast("string"), "publishedDate": F.lit("2024")})
    pages = spark.createDataFrame([("https://a.com/1", "<title>Red</title><p>All about red fish</p>")], "url string, html string")
    topics = spark.createDataFrame([(0, "fish"), (1, "bird")], "query_idx int, query string")
    report = research_report(topics, corpus, as_responses(pages))
    got = {r.url: (r.title, r.text, r.fetchError) for r in report.sources.collect()}
    assert got == {"https://a.com/1": ("Red", "All about red fish", None), "https://a.com/2": (None, None, "HTTP 404")}
    nothing = research_report(topics.filter("query_idx = 1"), corpus, as_responses(pages))
    assert nothing.summary.collect() == [(1, 0, 0, 0)] and nothing.sources.isEmpty()
    assert sorted(map(tuple, report.summary.collect())) == [(0, 2, 1, 1), (1, 0, 0, 0)]
