"""Page snapshots to articles: robots check, response check, decoding, extraction, truncation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import html, robots as rules_of, urls as u
from ..functions.encodings import decode_known, decode_rare, is_rare
from ..functions.text import blank_to_null, is_blank, strip, truncate_text
from .membership import LISTED_HASHES, keep_listed
from .requests import check_fetch_urls
from .sizing import is_small

# Limits and error texts of the fetch step.
MAX_BYTES = 2_000_000
MAX_CHARS = 8_000
TEXT_TYPES = ("text/html", "application/xhtml", "text/plain")
NO_URLS = "no URLs to fetch"
ROBOTS_ERROR = "blocked by robots.txt"
NOT_FOUND = 404
DEFAULT_USER_AGENT = "webglean/1.0"

# What tells captures of a URL apart without their bodies; the latest has the largest.
CAPTURE_KEY = ("fetched_at", "final_url", "status", "content_type", "transport_error")


def dedupe_urls(urls: DataFrame, position: str = "position") -> DataFrame:
    """Trimmed, non-blank URLs with the position where each was first seen."""
    trimmed = urls.select(strip(F.col("url")).alias("url"), position)
    return trimmed.filter(~is_blank(F.col("url"))).groupBy("url").agg(
        F.min(position).alias(position)
    )


def parse_robots(robots: DataFrame, user_agent: str = DEFAULT_USER_AGENT) -> DataFrame:
    """``(scheme, authority, rules)``: the ordered rules that apply to the agent, per host.

    ``robots(scheme, authority, status, body)``, one row per host. An answer other than 200 means no
    rules, as does a host without a row; ``rules`` is null where no group applies. Works inside each
    row, without a shuffle. Filter on ``rules`` only behind a join: a filter right here would be
    pushed below the parsing steps and repeat them.
    """
    return (
        robots.filter(F.col("status") == 200)
        .select("scheme", "authority", rules_of.directives(F.col("body")).alias("_lines"))
        .withColumn("_starts", rules_of.group_starts(F.col("_lines")))
        .select(
            "scheme",
            "authority",
            rules_of.rule_groups(F.col("_lines"), F.col("_starts")).alias("_groups"),
        )
        .select(
            "scheme",
            "authority",
            rules_of.rules_for(F.col("_groups"), user_agent).alias("rules"),
        )
    )


def robots_allowed(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Add ``allowed``. ``rules`` is the output of ``parse_robots``.

    A plain equality join on the host: one row per host on the rules side, so Spark can split a host
    with very many URLs over tasks (adaptive skew join) and repeat only that host's rules.
    """
    keyed = urls.withColumns(
        {"_scheme": u.scheme(F.col("url")), "_authority": u.authority(F.col("url"))}
    )
    hosts = rules.select(
        F.col("scheme").alias("_scheme"), F.col("authority").alias("_authority"),
        F.col("rules").alias("_rules"),
    )
    joined = keyed.join(hosts, ["_scheme", "_authority"], "left")
    return joined.select(
        *urls.columns, rules_of.is_allowed(F.col("_rules"), F.col("url")).alias("allowed")
    )


def classify_response(
    status: Column, content_type: Column, transport_error: Column, allowed: Column
) -> Column:
    """Why a page yields no article, or null: robots, transport, HTTP status, content type."""
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    readable = kind == ""
    for accepted in TEXT_TYPES:
        readable = readable | F.contains(kind, F.lit(accepted))
    return (
        F.when(~allowed, F.lit(ROBOTS_ERROR))
        .when(transport_error.isNotNull(), transport_error)
        .when(status >= 400, F.concat(F.lit("HTTP "), status.cast("string")))
        .when(~readable, F.concat(F.lit("unsupported content-type: "), kind))
    )


def latest_capture(captures: DataFrame) -> DataFrame:
    """One row per URL: the latest by ``CAPTURE_KEY``; ties by the other columns, nulls come first."""
    rest = [c for c in captures.columns if c != "url" and c not in CAPTURE_KEY]
    last = captures.groupBy("url").agg(F.max(F.struct(*CAPTURE_KEY, *rest)).alias("_last"))
    return last.select("url", "_last.*").select(*captures.columns)


def only_latest(captures: DataFrame, few: bool | None = None) -> DataFrame:
    """Captures that can be the latest of their URL, with their bodies and without a shuffle of them.

    The choice is made on narrow columns, in one aggregation. Captures equal in all of those stay, as
    do a few others where the URLs are many; ``latest_capture`` ends it behind the parsing.
    """
    latest = captures.groupBy("url").agg(F.max(F.struct(*CAPTURE_KEY)).alias("_last"))
    hashes = latest.select(F.xxhash64("url", "_last").alias("_hash"))
    return keep_listed(captures, F.xxhash64("url", F.struct(*CAPTURE_KEY)), hashes, few)


def fetch_snapshot(urls: DataFrame, responses: DataFrame) -> DataFrame:
    """Look each URL up among the snapshots; a URL without one gets status 404.

    ``responses`` has one row per URL, so the join has no hot key on that side.
    """
    columns = [c for c in responses.columns if c != "url"]
    found = responses.withColumn("_found", F.lit(True))
    joined = urls.join(found, "url", "left")
    missing = F.col("_found").isNull()
    return joined.select(
        *urls.columns,
        *[F.when(missing, F.lit(NOT_FOUND)).otherwise(F.col(c)).alias(c) if c == "status"
          else F.when(missing, F.col("url")).otherwise(F.col(c)).alias(c) if c == "final_url"
          else F.col(c) for c in columns],
    )


def extract_text(pages: DataFrame, source: str = "html", max_chars: int | None = MAX_CHARS) -> DataFrame:
    """Add ``title``, ``text`` and ``chars`` from an HTML column.

    The steps are separate projections so that each pattern runs once per page.
    """
    kept = pages.columns
    given = pages.withColumn("_given", F.coalesce(F.col(source), F.lit("")))
    clean = given.withColumn("_clean", html.strip_hidden("_given"))
    titled = clean.withColumns({"title": html.extract_title("_clean"), "_bare": html.strip_noise("_clean")})
    rooted = titled.withColumn("_root", html.pick_root("_bare"))
    texts = rooted.withColumn(
        "_text",
        F.coalesce(
            blank_to_null(html.block_text("_root")),
            blank_to_null(html.inline_text("_root", "\n")),
            html.strip_tags_fallback("_given"),
        ),
    )
    cut = texts.withColumn("text", truncate_text(F.col("_text"), max_chars))
    return cut.select(*kept, "title", "text", F.length("text").alias("chars"))


def read_articles(
    responses: DataFrame, max_bytes: int = MAX_BYTES, max_chars: int | None = MAX_CHARS
) -> DataFrame:
    """Article columns for every snapshot: no shuffle, and usable on a streaming table as well.

    Returns ``(url, final_url, status, content_type, transport_error, fetched_at, title, text)``.
    Pages that yield no article are not decoded. Pages in rare encodings are a branch of their own, the
    only one with Python; it is left out where a look at the encodings finds none.
    """
    usable = classify_response(
        F.col("status"), F.col("content_type"), F.col("transport_error"), F.lit(True)
    ).isNull()
    plain = ["url", "final_url", "status", "content_type", "transport_error", "fetched_at"]
    rare = usable & is_rare(F.col("encoding"))
    given = (F.col("body"), F.col("encoding"), max_bytes)
    known = F.when(usable, decode_known(*given)).alias("_html")
    if not responses.isStreaming and responses.filter(rare).isEmpty():
        decoded = responses.select(*plain, known)
    else:
        decoded = responses.filter(~rare).select(*plain, known).unionByName(
            responses.filter(rare).select(*plain, decode_rare(*given).alias("_html"))
        )
    return extract_text(decoded, "_html", max_chars).select(*plain, "title", "text")


def article_record(fetched: DataFrame) -> DataFrame:
    """``(url, finalUrl, status, title, text, chars, fetchedAt, error)`` from looked-up articles.

    Needs ``allowed`` and the columns of ``read_articles``. A blocked URL was never fetched and a
    transport error has no answer: both keep null status, final URL and time.
    """
    error = classify_response(
        F.col("status"), F.col("content_type"), F.col("transport_error"), F.col("allowed")
    )
    answered = F.col("allowed") & F.col("transport_error").isNull()
    return fetched.withColumns({"error": error, "_answered": answered}).select(
        "url",
        F.when(F.col("_answered"), F.col("final_url")).alias("finalUrl"),
        F.when(F.col("_answered"), F.col("status")).alias("status"),
        F.when(F.col("error").isNull(), F.col("title")).alias("title"),
        F.when(F.col("error").isNull(), F.coalesce("text", F.lit(""))).otherwise("").alias("text"),
        F.when(F.col("error").isNull(), F.length(F.coalesce("text", F.lit("")))).otherwise(0)
        .alias("chars"),
        F.when(F.col("_answered"), _utc_text(fetched, "fetched_at")).alias("fetchedAt"),
        "error",
    )


def _utc_text(df: DataFrame, column: str) -> Column:
    value = F.col(column)
    if isinstance(df.schema[column].dataType, T.TimestampType):
        value = F.to_utc_timestamp(value, F.current_timezone())
    return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def extract_articles(
    urls: DataFrame,
    responses: DataFrame,
    robots: DataFrame | None = None,
    user_agent: str = DEFAULT_USER_AGENT,
    max_bytes: int = MAX_BYTES,
    max_chars: int | None = MAX_CHARS,
    position: str = "position",
    mode: str = "fail",
    at: Column | None = None,
) -> DataFrame:
    """One article record per distinct URL, in one job.

    ``urls(url, position)``, ``responses`` as from ``load_responses``, ``robots(scheme, authority,
    status, body)`` or None to skip the check. A URL that is not http(s) stops the job; with
    ``mode="capture"`` it only gets that error. No URL at all raises ValueError. Of several captures
    of a URL the latest counts, or the latest up to the time ``at``. Pages that nobody may or does ask
    for and older captures are dropped before they are decoded, by hashes or a Bloom filter. Pages
    shrink to their article text before the lookup by URL, so page bodies are never shuffled.
    """
    listed = urls.select(strip(F.col("url")).alias("url")).filter(~is_blank(F.col("url")))
    if listed.isEmpty():
        raise ValueError(NO_URLS)
    wanted = check_fetch_urls(dedupe_urls(urls, position), "url", mode)
    if robots is None:
        checked = wanted.withColumn("allowed", F.lit(True))
    else:
        checked = robots_allowed(wanted, parse_robots(robots, user_agent))
    asked = responses if at is None else responses.filter(F.col("fetched_at") <= at)
    useful = checked.filter(F.col("allowed") & F.col("url").rlike("(?i)^https?://"))
    hashes = useful.select(F.xxhash64("url").alias("_hash"))
    few = is_small(hashes, LISTED_HASHES)
    asked = keep_listed(asked, F.xxhash64("url"), hashes, few)
    # A URL has one latest capture, so few URLs have few.
    asked = only_latest(asked, few)
    articles = latest_capture(read_articles(asked, max_bytes, max_chars))
    fetched = fetch_snapshot(checked, articles)
    records = article_record(fetched)
    if mode != "capture":
        return records
    return _with_url_errors(records)


def _with_url_errors(records: DataFrame) -> DataFrame:
    checked = check_fetch_urls(records.withColumnRenamed("error", "_fetch_error"), "url", "capture")
    bad = F.col("error").isNotNull()
    return checked.select(
        "url",
        F.when(~bad, F.col("finalUrl")).alias("finalUrl"),
        F.when(~bad, F.col("status")).alias("status"),
        F.when(~bad, F.col("title")).alias("title"),
        F.when(~bad, F.col("text")).otherwise("").alias("text"),
        F.when(~bad, F.col("chars")).otherwise(0).alias("chars"),
        F.when(~bad, F.col("fetchedAt")).alias("fetchedAt"),
        F.coalesce("error", "_fetch_error").alias("error"),
    )


def fetch_summary(articles: DataFrame) -> DataFrame:
    """One row ``(total, errorCount, requested)`` over article records."""
    return articles.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~is_blank(F.col("error"))).alias("errorCount"),
        F.count("url").alias("requested"),
    )
