"""A third of all rows on one key: the plans must split it and the results must stay whole."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from webglean.operators import search
from webglean.operators.pages import parse_robots, robots_allowed
from webglean.operators.research import research, research_summary

# Thresholds for megabyte-sized test data; a cluster keeps Spark's defaults.
SMALL_SCALE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@contextmanager
def scaled_down(spark):
    for key, value in SMALL_SCALE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in SMALL_SCALE:
            spark.conf.unset(key)


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_host_is_split(spark):
    n = 60_000
    urls = spark.range(0, n, 1, 16).select(
        F.concat(
            F.lit("https://"),
            F.when(F.col("id") % 3 == 0, F.lit("hot.com")).otherwise(F.concat(F.lit("h"), F.col("id") % 5000, F.lit(".com"))),
            F.lit("/"), F.when(F.col("id") % 2 == 0, "private/").otherwise("open/"), F.md5(F.col("id").cast("string")),
        ).alias("url")
    )
    robots = spark.range(5000).select(
        F.lit("https").alias("scheme"), F.concat(F.lit("h"), "id", F.lit(".com")).alias("authority"),
        F.lit(200).alias("status"), F.lit("User-agent: *\nDisallow:").alias("body"),
    ).union(spark.createDataFrame([("https", "hot.com", 200, "User-agent: *\nDisallow: /private")]))
    with scaled_down(spark):
        checked = robots_allowed(urls, parse_robots(robots))
        rows = checked.collect()
    assert "skew=true" in final_plan(checked)
    assert len(rows) == n
    blocked = [r.url for r in rows if not r.allowed]
    assert len(blocked) == n // 6 and all("hot.com/private" in u for u in blocked)


def test_hot_url_and_hot_topic_keep_every_source(spark):
    n = 60_000
    # A third of all topics cite one URL; a third of all rows belong to one topic.
    hits = spark.range(0, n, 1, 16).select(
        F.when(F.col("id") % 3 == 1, F.lit(-1)).otherwise(F.col("id")).alias("topic"),
        (F.col("id") + 1).alias("rank"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), F.col("id"))).alias("url"),
        F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("publishedDate"),
        F.md5(F.col("id").cast("string")).alias("text"),
    )
    articles = hits.select("url").distinct().select(
        "url", F.lit("page").alias("title"), F.concat(F.lit("text of "), "url").alias("text"), F.lit(None).cast("string").alias("error")
    )
    with scaled_down(spark):
        sources = research(hits, articles)
        rows = sources.select("url", "text").collect()
        topics = hits.select("topic").distinct()
        summary = {r.topic: (r.sourceCount, r.fetched) for r in research_summary(topics, sources).collect()}
    assert len(rows) == n and all(r.text == f"text of {r.url}" for r in rows)
    assert summary[-1] == (n // 3, n // 3) and summary[0] == (1, 1) and len(summary) == n - n // 3 + 1


def test_common_term_is_salted_when_queries_are_many(spark, monkeypatch):
    monkeypatch.setattr(search, "BROADCAST_ROWS", 0)
    corpus = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("common word"), "id").alias("text")
    )
    queries = spark.range(50).select(F.col("id").alias("query_idx"), F.concat(F.lit("common word"), "id").alias("query"))
    ranked = search.rank_documents(queries, corpus, 3)
    got = ranked.collect()
    assert "_salt" in final_plan(ranked)
    assert len(got) == 150
    assert all(r.doc_id == r.query_idx for r in got if r["rank"] == 1)
