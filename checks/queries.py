"""The registered queries: one per operator, each over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from webglean.functions.encodings import cap_and_decode
from webglean.functions.html import (
    block_text, extract_title, pick_root, strip_hidden, strip_noise, strip_tags_fallback,
)
from webglean.functions.text import truncate_text
from webglean.operators import pages, requests, results, search, traffic
from webglean.plans.answers import answer_requests
from webglean.plans.batch import search_report
from webglean.plans.corpus import ResearchReport, research_report
from webglean.sources.payloads import parse_payloads
from webglean.sources.reports import batch_lines, bridge_documents, fetch_lines, report_json, research_documents
from webglean.sources.tables import load_queries, load_responses

from . import inputs
from .inputs import table

SEARCH_TEXT = "the and of their inside"


def o01_load_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.split("text", "\n").alias("asks"))
    return load_queries(lists, "asks", keep=("conv_id", "turn"))


def o02_parse_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_payloads(inputs.answers(spark, sf_dir))


def o03_load_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = load_responses(spark, f"{sf_dir}/pages.parquet")
    return loaded.select("url", "final_url", "status", F.octet_length("body").alias("body_bytes"))


def o04_write_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", "text", F.lit(None).cast("string").alias("publishedDate")
    )
    return report_json(rows)


def o05_validate_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = inputs.queries(spark, sf_dir).withColumn("turn", F.lit(-1).cast("long"))
    chat = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("query_idx"), F.col("text").alias("query"), "turn"
    )
    checked = requests.validate_queries(asked.union(chat), mode="capture")
    return checked.select("query_idx", "turn", "error")


def o06_validate_max_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") != "signup", F.floor("value").cast("int")).alias("max_results"),
    )
    return requests.validate_max_results(events, mode="capture")


def o07_clamp_max_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").alias("from_text"),
        F.concat(F.lit(" "), F.col("value").cast("string")).alias("from_fraction"),
        F.col("value").alias("from_number"),
    )
    for column in ("from_text", "from_fraction", "from_number"):
        events = requests.clamp_max_results(events, column)
    return events


def o08_normalize_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = requests.normalize_requests(inputs.request_log(spark, sf_dir))
    return read.withColumn("exclude", F.array_join("exclude", "|"))


def o09_split_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("text").alias("exclude"))
    listed = requests.split_exclude(texts)
    return listed.select("conv_id", "turn", F.size("exclude").alias("n"), F.array_join("exclude", "|").alias("items"))


def o10_exclude_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = results.exclude_domains(inputs.page_hits(spark, sf_dir), ["SPAM-farm", "example.net", "utm_", "/9"])
    return kept.select("rank", "url")


def o10_exclude_domains_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    hosts = table(spark, sf_dir, "pages").select(
        F.regexp_extract("url", "^http://([^/?#]*)", 1).alias("pattern")
    ).filter(F.col("pattern") != "")
    kept = results.exclude_domains_table(inputs.page_hits(spark, sf_dir), hosts)
    return kept.select("rank", "url")


def o10_exclude_domains_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More than a thousand patterns of all lengths, blanks too, against long and odd URLs."""
    ids = table(spark, sf_dir, "documents").select(F.concat(F.lit("Item/"), F.col("doc_id"), F.lit("/x")).alias("pattern"))
    events = table(spark, sf_dir, "events").select(F.concat(F.lit("e"), F.col("event_id"), F.lit("-")).alias("pattern"))
    paths = table(spark, sf_dir, "pages").select(F.substring("url", -9, 9).alias("pattern")).filter(F.length("pattern") == 9)
    odd = spark.range(3).select(F.when(F.col("id") == 0, "").when(F.col("id") == 1, "  ").alias("pattern"))
    # Numbers that tables have and numbers that none has.
    number = F.when(F.col("rank") % 4 < 2, F.col("rank")).otherwise(-F.col("rank") - 1)
    hits = inputs.page_hits(spark, sf_dir).select(
        "query_idx", "rank",
        F.when(F.col("rank") % 10 == 3, F.lit(None)).when(
            F.col("rank") % 2 == 0, F.concat(F.lit("HTTPS://é.com/"), F.repeat(F.lit("a"), 500), F.lit("/ITEM/"), number, F.lit("/x")),
        ).otherwise(F.concat(F.lit("https://b.com/"), F.col("rank"), F.lit("e"), number, F.lit("-"))).alias("url"),
    )
    patterns = ids.union(events).union(paths).union(odd)
    return results.exclude_domains_table(hits, patterns).select("rank", "url")


def o11_drop_urlless(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.drop_urlless(inputs.chat_hits(spark, sf_dir)).select("query_idx", "rank", "url")


def o12_to_compat_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.to_compat_rows(inputs.chat_hits(spark, sf_dir))


def o13_to_display_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = inputs.chat_hits(spark, sf_dir)
    silent = table(spark, sf_dir, "benchmark").select((-F.col("item_id") - 1).alias("query_idx"))
    return results.to_display_lines(hits, hits.select("query_idx").distinct().union(silent))


def o14_allow_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = table(spark, sf_dir, "pages").select("page_id", "url")
    return requests.allow_hosts(
        urls, "url", r"[a-z0-9-]+\.[a-z0-9-]+\.example\.(?:com|net)", r"\.example\.([a-z0-9-]+)"
    )


def o15_check_fetch_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = inputs.page_urls(spark, sf_dir).select("url").union(
        inputs.corpus(spark, sf_dir).select("url")
    )
    return requests.check_fetch_urls(urls, mode="capture")


def o16_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = search.search(SEARCH_TEXT, inputs.corpus(spark, sf_dir), 25)
    return hits.select("rank", "url", "title", "text", "score")


def _batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search_batch(inputs.valid_queries(spark, sf_dir), inputs.corpus(spark, sf_dir), 10)


def o17_search_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batch(spark, sf_dir)


def o17_search_batch_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows where every term in more than 20 documents counts as common."""
    return search.search_batch(
        inputs.valid_queries(spark, sf_dir), inputs.corpus(spark, sf_dir), 10, rare_docs=20
    )


def o18_fetch_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = pages.dedupe_urls(inputs.page_urls(spark, sf_dir))
    found = pages.fetch_snapshot(urls, inputs.responses(spark, sf_dir))
    return found.select(
        "url", "position", "final_url", "status", "content_type", F.octet_length("body").alias("body_bytes")
    )


def _research(spark: SparkSession, sf_dir: str) -> ResearchReport:
    page_text = pages.extract_text(table(spark, sf_dir, "pages", spread=True), "html", None)
    corpus = page_text.select(
        F.col("page_id").alias("doc_id"), "text", "url",
        F.when(F.col("url").like("https%"), F.col("title")).alias("title"),
        F.lit("2024").alias("publishedDate"),
    )
    return research_report(
        inputs.valid_queries(spark, sf_dir), corpus, inputs.responses(spark, sf_dir),
        inputs.robots(spark, sf_dir), k=5,
    )


def o19_research(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _research(spark, sf_dir).sources


def o20_merge_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = results.merge_results(_batch(spark, sf_dir))
    return merged.select("query_idx", "rank", "url", "title")


def o20_merge_keep_urlless(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages_twice = inputs.page_hits(spark, sf_dir).withColumns(
        {"query_idx": F.lit(-1).cast("long"), "url": F.regexp_extract("url", "^(https?://[^/]*)", 1)}
    )
    hits = inputs.chat_hits(spark, sf_dir).unionByName(pages_twice)
    return results.merge_results(hits).select("query_idx", "rank", "url")


def o21_dedupe_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.dedupe_urls(inputs.page_urls(spark, sf_dir))


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.validate_queries(inputs.queries(spark, sf_dir), mode="capture")


def o22_query_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.query_stats(_outcomes(spark, sf_dir), _batch(spark, sf_dir))


def o23_batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_report(
        inputs.queries(spark, sf_dir), inputs.corpus(spark, sf_dir), 10, mode="capture"
    ).summary


def _articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract_articles(
        inputs.page_urls(spark, sf_dir), inputs.responses(spark, sf_dir), inputs.robots(spark, sf_dir)
    )


def o24_fetch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.fetch_summary(_articles(spark, sf_dir))


def o25_research_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _research(spark, sf_dir).summary


def o26_nest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = results.nest_report(inputs.chat_hits(spark, sf_dir), ["query_idx"])
    return nested.select(
        "query_idx", F.size("results").alias("n"),
        F.array_join(F.transform("results", lambda r: r["text"]), "|").alias("texts"),
    )


def o26_batch_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = search_report(inputs.queries(spark, sf_dir), inputs.corpus(spark, sf_dir), 10, mode="capture")
    return batch_lines(report.queries, report.results.drop("score"), report.summary)


def o26_fetch_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles = _articles(spark, sf_dir)
    return fetch_lines(articles, inputs.page_urls(spark, sf_dir), pages.fetch_summary(articles))


def o26_research_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = _research(spark, sf_dir)
    return research_documents(report.sources, report.summary)


def o27_parse_robots(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = pages.parse_robots(inputs.robots(spark, sf_dir))
    # "outer" and the filter behind it: a plain explode would push a size test below the parsing.
    listed = rules.select("scheme", "authority", F.posexplode_outer("rules").alias("rule_no", "rule"))
    return listed.filter(F.col("rule_no").isNotNull()).select(
        "scheme", "authority", "rule_no", F.col("rule.allow").alias("allow"), F.col("rule.path").alias("path")
    )


def o28_robots_allowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = pages.parse_robots(inputs.robots(spark, sf_dir))
    return pages.robots_allowed(table(spark, sf_dir, "pages").select("page_id", "url"), rules)


def o29_classify_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = pages.robots_allowed(
        inputs.responses(spark, sf_dir), pages.parse_robots(inputs.robots(spark, sf_dir))
    )
    error = pages.classify_response(
        F.col("status"), F.col("content_type"), F.col("transport_error"), F.col("allowed")
    )
    return checked.select("url", error.alias("error"))


def o30_cap_and_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    latin = F.col("html").rlike("^[\\x{00}-\\x{FF}]*$")
    encoded = table(spark, sf_dir, "pages", spread=True).select(
        "page_id",
        F.when(latin, F.encode("html", "ISO-8859-1")).otherwise(F.encode("html", "UTF-8")).alias("body"),
        F.when(latin, F.lit("ISO-8859-1")).alias("encoding"),
    )
    return encoded.select("page_id", cap_and_decode(F.col("body"), F.col("encoding")).alias("html"))


def o30_decode_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad bytes, a Windows page, a rare and an unknown encoding, and a body that is too long."""
    kind = F.col("page_id") % 5
    ascii_only = F.encode(F.regexp_replace("html", "[^\\x00-\\x7F]", ""), "UTF-8")
    encoded = table(spark, sf_dir, "pages", spread=True).select(
        "page_id", kind.alias("kind"),
        F.when(kind == 0, F.concat(F.encode("html", "UTF-8"), F.unhex(F.lit("FF"))))
        .when(kind == 1, F.concat(ascii_only, F.unhex(F.lit("80"))))
        .when(kind == 2, F.encode("html", "UTF-16LE")).when(kind == 3, F.encode("html", "UTF-8"))
        .otherwise(ascii_only).alias("body"),
        F.when(kind == 1, "Windows-1252").when(kind == 2, "utf-16-le").when(kind == 3, "x-none").alias("encoding"),
    )
    long, short = (cap_and_decode(F.col("body"), F.col("encoding"), n) for n in (2_000_000, 1000))
    return encoded.select("page_id", F.when(F.col("kind") == 4, short).otherwise(long).alias("html"))


def o31_extract_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages", spread=True).select(
        "page_id", strip_hidden("html").alias("clean")
    ).select("page_id", extract_title("clean").alias("title"))


def o32_strip_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages", spread=True).select(
        "page_id", strip_hidden("html").alias("clean")
    ).select("page_id", strip_noise("clean").alias("bare"))


def o33_pick_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    return o32_strip_noise(spark, sf_dir).select("page_id", pick_root("bare").alias("root"))


def o34_block_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return o33_pick_root(spark, sf_dir).select("page_id", block_text("root").alias("text"))


def o35_strip_tags_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages", spread=True).select("page_id", strip_tags_fallback("html").alias("text"))


def o36_truncate_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        truncate_text(F.col("text")).alias("cut_default"),
        truncate_text(F.col("text"), 120).alias("cut_short"),
        truncate_text(F.col("text"), 0).alias("uncut"),
    )


def o37_article_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _articles(spark, sf_dir)


def o37_latest_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several captures of every URL up to a time, and URLs that are no web addresses."""
    odd = table(spark, sf_dir, "pages").select(F.concat(F.lit("ftp://"), "page_id").alias("url"), F.col("page_id").alias("position"))
    return pages.extract_articles(
        inputs.page_urls(spark, sf_dir).union(odd), inputs.captures(spark, sf_dir), inputs.robots(spark, sf_dir),
        mode="capture", at=F.lit(inputs.CAPTURES_AT).cast("timestamp_ntz"),
    )


def o38_rate_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")
    )
    granted = traffic.rate_schedule(events, "event_type", "ts", "event_id", 2.5)
    return granted.select("event_id", "event_type", "wait_us", "granted_at")


def o38_rate_schedule_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rate whose step is no whole number of microseconds; every key is cut into blocks."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")
    )
    granted = traffic.rate_schedule(events, "event_type", "ts", "event_id", 7, hot_rows=100)
    return granted.select("event_id", "event_type", "wait_us", "granted_at")


def o39_peak_in_flight(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "user_id",
        "ts",
        F.timestamp_add("MILLISECOND", F.round(F.col("value") * 60000).cast("long"), "ts").alias("until"),
    )
    return traffic.peak_in_flight(events, "user_id", "ts", "until", cap=3)


def _answers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    asks = table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("req_id"),
        F.concat(F.lit("/search?n=3&exclude=doc://0,doc://f&q="), F.url_encode("text")).alias("url"),
        F.lit(None).cast("string").alias("content_type"),
        F.lit(None).cast("string").alias("body"),
    )
    return answer_requests(asks, inputs.corpus(spark, sf_dir))


def answer_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request log to compatible rows, end to end: chat questions against the documents."""
    return _answers(spark, sf_dir)[1].select("req_id", "rank", "url", "title", "publishedDate")


def o26_bridge_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bridge_documents(*_answers(spark, sf_dir))


REGISTERED = {
    name: function
    for name, function in list(globals().items())
    if name.startswith("o") and name[1:3].isdigit() or name == "answer_log"
}
