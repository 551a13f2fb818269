"""Input tables of the registered queries, derived from whole driver tables."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SMALL_FILE = 64 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A driver table. ``spread`` deals a small one-file table out to all cores: its single row
    group would otherwise keep all the text work in one task. Large tables have many row groups.
    """
    path = f"{sf_dir}/{name}.parquet"
    df = spark.read.parquet(path)
    if spread and os.path.isfile(path) and os.path.getsize(path) < SMALL_FILE:
        # By the id: dealing rows out in turn would sort them first, to be repeatable.
        df = df.repartition(spark.sparkContext.defaultParallelism, df.columns[0])
    return df


def queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All benchmark texts as queries; more than half are too long."""
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_idx"), F.col("text").alias("query")
    )


def valid_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries(spark, sf_dir).filter(F.length("query") <= 200)


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents; equal texts share a URL, so exact copies and repeated hits meet in the merge."""
    return table(spark, sf_dir, "documents", spread=True).select(
        "doc_id",
        "text",
        F.concat(F.lit("doc://"), F.md5("text")).alias("url"),
        F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("title"),
        F.lit(None).cast("string").alias("publishedDate"),
    )


def chat_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as result rows; turns of the assistant have no URL."""
    url = F.concat(
        F.lit("https://chat.example/"), F.col("conv_id").cast("string"), F.lit("/"),
        F.col("turn").cast("string"),
    )
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("query_idx"),
        (F.col("turn") + 1).alias("rank"),
        F.when(F.col("role") != "assistant", url).alias("url"),
        F.when(F.col("role") != "user", F.col("role")).alias("title"),
        F.when(F.col("turn") == 0, F.lit("2024-01-01")).alias("publishedDate"),
        "text",
    )


def page_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        F.lit(0).alias("query_idx"), F.col("page_id").alias("rank"), "url",
        F.lit("page").alias("title"), F.lit(None).cast("string").alias("publishedDate"),
        F.col("html").alias("text"),
    )


def _when(*cases: tuple[str, object]) -> Column:
    """First matching LIKE pattern on the URL."""
    chain = F
    for pattern, value in cases:
        chain = chain.when(F.col("url").like(pattern), F.lit(value))
    return chain


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a snapshot; answer kinds follow from the URL."""
    return table(spark, sf_dir, "pages", spread=True).select(
        "url",
        F.concat(F.col("url"), F.lit("&seen=1")).alias("final_url"),
        _when(("%spam-farm%", 403), ("%?page=%", 500)).otherwise(200).alias("status"),
        _when(
            ("%.html%", "text/html; charset=utf-8"), ("%utm_source%", "application/PDF"),
            ("%/es/%", "application/xhtml+xml"), ("%#top", "text/plain"),
        ).alias("content_type"),
        _when(("%/fr/%", "utf-8")).alias("encoding"),
        F.encode("html", "UTF-8").alias("body"),
        _when(("%cheap-pills%", "connect timeout")).alias("transport_error"),
        F.timestamp_add(
            "SECOND", F.col("page_id"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
        ).alias("fetched_at"),
    )


# Fixed value: a time at which some pages have their second capture.
CAPTURES_AT = "2024-01-02 00:01:40"


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page three times, a day apart, with another title the second time and no page the third."""
    first = responses(spark, sf_dir)
    day = F.expr("INTERVAL 1 DAY")
    second = first.withColumns({
        "body": F.concat(F.encode(F.lit("<title>second</title>"), "UTF-8"), "body"), "fetched_at": F.col("fetched_at") + day,
    })
    third = first.withColumns({"status": F.lit(410), "fetched_at": F.col("fetched_at") + day + day})
    return first.union(second).union(third)


def page_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page URL, again with spaces around it, and a variant that has no snapshot."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    again = pages.select(
        (F.col("page_id") + 1_000_000_000).alias("page_id"),
        F.concat(F.lit(" \t"), F.col("url"), F.lit("\n")).alias("url"),
    )
    missing = pages.select(
        (F.col("page_id") + 2_000_000_000).alias("page_id"), F.concat("url", F.lit("!gone")).alias("url")
    )
    return pages.union(again).union(missing).select("url", F.col("page_id").alias("position"))


# The robots texts of the three kinds of hosts.
ROBOTS_COM = "User-agent: *\nDisallow: /en/ # english\nAllow: /fr/\n"
ROBOTS_NET = (
    "User-agent: WebGlean\r\nUser-agent: other\r\nAllow: /en/1\r\nDisallow: /en/\r\n\r\n"
    "User-agent: *\r\nDisallow: /\r\n"
)
ROBOTS_ORG = (
    "Sitemap: http://s.example/map.xml\nDisallow: /\nUser-agent: nobody\nDisallow: /\n\n"
    "User-agent: *\nCrawl-delay: 5\nDisallow:\n"
)


def robots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A robots answer for every host that has a page."""
    hosts = table(spark, sf_dir, "pages").select(
        F.regexp_extract("url", "^([a-z]+)://", 1).alias("scheme"),
        F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1).alias("authority"),
    ).distinct()
    host = F.col("authority")
    return hosts.select(
        "scheme",
        "authority",
        F.when(host.like("www.%.org"), 404).otherwise(200).alias("status"),
        F.when(host.like("%.com"), F.lit(ROBOTS_COM)).when(host.like("%.net"), F.lit(ROBOTS_NET))
        .otherwise(F.lit(ROBOTS_ORG)).alias("body"),
    )


def _k() -> Column:
    return F.get_json_object("props", "$.k")


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a search request, one spelling per event type."""
    kind, value = F.col("event_type"), F.col("value").cast("string")
    url = (
        F.when(kind == "view", F.concat(F.lit("http://s.example/search?q=view+"), _k(), F.lit("%20x&count="), value))
        .when(kind == "click", F.concat(F.lit("/search?search=old&limit="), _k()))
        .when(kind == "purchase", F.lit("/search?n=7"))
        .when(kind == "error", F.lit("/search?q=&keyword=caf%C3%A9&exclude=a.com,%20b.com"))
        .otherwise(F.lit("/search"))
    )
    body = (
        F.when(kind == "click", F.concat(
            F.lit('{"search": "new '), _k(), F.lit('", "max_results": '), value,
            F.lit(', "exclude": ["a.com", " b.org "]}')))
        .when(kind == "purchase", F.concat(F.lit("query=form+"), _k(), F.lit("&exclude=x.com+y.com")))
        .when(kind == "error", F.lit('{"q": broken'))
        .when(kind == "signup", F.concat(
            F.lit('{"input": "sign up", "num": "'), _k(), F.lit('", "blacklist": "p.com, q.com"}')))
    )
    content_type = (
        F.when(kind.isin("click", "error"), F.lit("application/json"))
        .when(kind == "purchase", F.lit("application/x-www-form-urlencoded"))
        .when(kind == "signup", F.lit("text/plain"))
    )
    return table(spark, sf_dir, "events", spread=True).select(
        F.col("event_id").alias("req_id"), url.alias("url"), content_type.alias("content_type"),
        body.alias("body"),
    )


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a search answer, one payload shape per event type."""
    kind, value = F.col("event_type"), F.col("value").cast("string")
    structured = (
        F.when(kind == "view", F.concat(
            F.lit('{"results":[{"url":"u'), _k(), F.lit('","title":"T","publishedDate":null,"text":"é '),
            value, F.lit('"},{"url":null}]}')))
        .when(kind == "purchase", F.lit('{"other":1}'))
        .when(kind == "error", F.lit('{"results":null}'))
    )
    content = (
        F.when(kind == "click", F.array(
            F.lit("not json"), F.concat(F.lit('{"results":[{"url":"b'), _k(), F.lit('"}]}'))))
        .when(kind.isin("purchase", "error"), F.array(
            F.concat(F.lit('{"results":[5,{"url":"x'), _k(), F.lit('"}]}')), F.lit('{"results":[{"url":"late"}]}')))
    )
    return table(spark, sf_dir, "events", spread=True).select(
        F.col("event_id").alias("query_idx"), structured.alias("structured"), content.alias("content")
    )
