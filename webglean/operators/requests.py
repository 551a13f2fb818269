"""Operators on queries, URLs to fetch and request logs, before any search runs.

Checks come in two modes: ``capture`` adds an ``error`` column, ``fail`` stops the job at the first
bad row. The failing expression sits inside the columns that are kept, so pruning cannot drop it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import limits, urls
from ..functions.text import is_blank, strip

# Parameter names in order of preference, and error texts.
QUERY_NAMES = ("q", "query", "search", "keyword", "text", "input")
LIMIT_NAMES = ("maxResults", "max_results", "count", "limit", "num", "n")
EXCLUDE_NAMES = ("exclude", "excludeDomains", "exclude_domains", "blacklist")
NO_QUERY = 'no query found; send ?q=... or JSON {"query":...}'
QUERY_NOT_TEXT = "query is not a text"
ENDPOINT_EMPTY = "endpoint URL is empty"
ENDPOINT_NOT_HTTPS = "endpoint URL must use https, got '%s://...'"
ENDPOINT_BAD_HOST = "endpoint URL host is not allowed: %s"
ONLY_HTTP = "only http(s) URLs are supported: "


def _apply(df: DataFrame, checked: str, error: Column, mode: str) -> DataFrame:
    if mode == "capture":
        return df.withColumn("error", error)
    if mode == "fail":
        stop = F.raise_error(error).cast(df.schema[checked].dataType)
        return df.withColumn(checked, F.when(error.isNotNull(), stop).otherwise(F.col(checked)))
    raise ValueError(f"mode must be 'fail' or 'capture', not {mode!r}")


def validate_queries(queries: DataFrame, mode: str = "fail") -> DataFrame:
    """Empty or too long queries. By default one bad query fails the batch before any search."""
    return _apply(queries, "query", limits.query_error(F.col("query")), mode)


def validate_max_results(df: DataFrame, column: str = "max_results", mode: str = "fail") -> DataFrame:
    """Null passes; anything but a whole number from 1 to 25 is an error."""
    error = limits.max_results_error(F.col(column), df.schema[column].dataType)
    return _apply(df, column, error, mode)


def clamp_max_results(df: DataFrame, column: str = "max_results") -> DataFrame:
    """Permissive form: missing or unreadable becomes 10, the rest is clamped to 1..25."""
    kind = df.schema[column].dataType
    return df.withColumn(column, limits.clamp_max_results(F.col(column), kind))


def split_exclude(df: DataFrame, column: str = "exclude") -> DataFrame:
    """An exclude list as an array: text is split on commas and white space, array items trimmed."""
    if isinstance(df.schema[column].dataType, T.ArrayType):
        return df.withColumn(column, limits.trim_exclude(F.col(column)))
    return df.withColumn(column, limits.split_exclude(F.col(column)))


def allow_hosts(
    df: DataFrame, url: str, host_regex: str, part_regex: str | None = None, mode: str = "capture"
) -> DataFrame:
    """Only https URLs whose whole host matches; ``host_part`` is a named piece of the host."""
    location = F.col(url)
    host = urls.hostname(location)
    error = (
        F.when(is_blank(location), F.lit(ENDPOINT_EMPTY))
        .when(
            urls.scheme(location) != "https",
            F.format_string(
                ENDPOINT_NOT_HTTPS,
                F.coalesce(F.nullif(urls.scheme(location), F.lit("")), location),
            ),
        )
        .when(
            ~host.rlike("^(?:" + host_regex + ")$"),
            F.format_string(
                ENDPOINT_BAD_HOST, F.coalesce(F.nullif(host, F.lit("")), location)
            ),
        )
    )
    if part_regex is not None:
        part = F.nullif(F.regexp_extract(location, part_regex, 1), F.lit(""))
        df = df.withColumn("host_part", part)
    return _apply(df, url, error, mode)


def check_fetch_urls(df: DataFrame, url: str = "url", mode: str = "fail") -> DataFrame:
    """Trimmed URLs must start with http:// or https://."""
    trimmed = df.withColumn(url, strip(F.col(url)))
    bad = ~F.coalesce(F.col(url), F.lit("")).rlike("(?i)^https?://")
    error = F.when(bad, F.concat(F.lit(ONLY_HTTP), F.coalesce(F.col(url), F.lit(""))))
    return _apply(trimmed, url, error, mode)


def normalize_requests(requests: DataFrame) -> DataFrame:
    """``(req_id, query, max_results, exclude, error)`` from a log ``(req_id, url, content_type, body)``.

    Body values replace query-string values of the same name; then the first name that has a value
    wins, so ``q`` in the query string beats ``query`` in the body. A body that cannot be read is
    ignored. An empty JSON list hides the query-string value of its name, and is then skipped.
    """
    content_type = F.lower(F.coalesce(F.col("content_type"), F.lit("")))
    is_form = F.contains(content_type, F.lit("form")) & ~F.contains(content_type, F.lit("json"))
    read = requests.select(
        "req_id",
        urls.form_pairs(urls.query_string(F.coalesce(F.col("url"), F.lit("")))).alias("_query"),
        urls.form_pairs(F.when(is_form, F.col("body")).otherwise("")).alias("_form"),
        F.from_json(F.when(~is_form, F.col("body")), "MAP<STRING,VARIANT>").alias("_json"),
    )
    entries = read.select(
        "req_id",
        F.concat(_json_entries("_json"), _text_entries("_form"), _text_entries("_query")).alias("_entries"),
    )
    hidden = F.transform(F.filter("_entries", lambda e: e["empty_list"]), lambda e: e["name"])
    usable = entries.withColumn("_hidden", hidden).select(
        "req_id",
        F.filter("_entries", lambda e: ~F.array_contains("_hidden", e["name"])).alias("_entries"),
    )
    return usable.select(
        "req_id",
        _first_given(QUERY_NAMES).alias("_q"),
        _first_given(LIMIT_NAMES).alias("_max"),
        _first_given(EXCLUDE_NAMES).alias("_exclude"),
    ).select(
        "req_id",
        _text_of("_q").alias("query"),
        F.when(F.col("_max.text").isNotNull(), limits.clamp_text(F.col("_max.text")))
        .when(F.col("_max.json").isNotNull(), limits.clamp_variant(F.col("_max.json")))
        .otherwise(F.lit(limits.DEFAULT_RESULTS)).alias("max_results"),
        _list_of("_exclude").alias("exclude"),
        F.when(F.col("_q").isNull() | _falsy("_q"), F.lit(NO_QUERY))
        .when(_text_of("_q").isNull(), F.lit(QUERY_NOT_TEXT)).alias("error"),
    )


def _json_entries(column: str) -> Column:
    """Body values as ``array<struct<name, text, json, empty_list>>``, without nulls and ``""``."""
    pairs = F.coalesce(F.map_entries(column), F.array().cast("array<struct<key:string,value:variant>>"))
    # Of a repeated name the last value counts.
    pairs = F.reverse(pairs)
    names = F.transform(pairs, lambda e: e["key"])
    last = F.filter(pairs, lambda e, i: F.array_position(names, e["key"]) == i + 1)
    given = F.filter(
        last, lambda e: ~F.is_variant_null(e["value"]) & (F.to_json(e["value"]) != '""')
    )
    return F.transform(
        given,
        lambda e: F.struct(
            e["key"].alias("name"),
            F.lit(None).cast("string").alias("text"),
            e["value"].alias("json"),
            (F.to_json(e["value"]) == "[]").alias("empty_list"),
        ),
    )


def _text_entries(column: str) -> Column:
    return F.transform(
        column,
        lambda p: F.struct(
            p["name"].alias("name"),
            p["value"].alias("text"),
            F.lit(None).cast("variant").alias("json"),
            F.lit(False).alias("empty_list"),
        ),
    )


def _first_given(names: tuple[str, ...]) -> Column:
    """The entry of the first listed name that has one, body before query string, or null."""
    listed = F.array(*[F.lit(n) for n in names])
    mine = F.filter("_entries", lambda e: e["name"].isin(*names))
    best = F.array_min(F.transform(mine, lambda e: F.array_position(listed, e["name"])))
    return F.get(F.filter(mine, lambda e: F.array_position(listed, e["name"]) == best), F.lit(0))


def _text_of(column: str) -> Column:
    value = F.col(f"{column}.json")
    json_text = F.when(
        F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string")
    )
    return F.coalesce(F.col(f"{column}.text"), json_text)


def _falsy(column: str) -> Column:
    return F.coalesce(
        F.to_json(F.col(f"{column}.json")).isin("0", "0.0", "-0", "-0.0", "false", "{}"), F.lit(False)
    )


def _list_of(column: str) -> Column:
    value = F.col(f"{column}.json")
    items = F.try_variant_get(value, "$", "array<string>")
    return (
        F.when(F.startswith(F.schema_of_variant(value), F.lit("ARRAY")), limits.trim_exclude(items))
        .otherwise(
            limits.split_exclude(
                F.coalesce(F.col(f"{column}.text"), F.try_variant_get(value, "$", "string"))
            )
        )
    )
