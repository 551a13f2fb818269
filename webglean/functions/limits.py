"""Input rules: query text, result counts, exclude lists. Errors are strings, null means valid."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from .text import WHITESPACE, strip

# Limits of the search interface and its error texts.
MAX_QUERY_CHARS = 200
MIN_RESULTS = 1
MAX_RESULTS = 25
DEFAULT_RESULTS = 10
QUERY_EMPTY = "query is empty"
QUERY_TOO_LONG = "query must be <= 200 characters (got %d)"
RESULTS_NOT_INTEGER = "max_results must be an integer"
RESULTS_OUT_OF_RANGE = "max_results must be between 1 and 25"

_INTEGER_KINDS = ("TINYINT", "SMALLINT", "INT", "BIGINT")


def query_error(query: Column) -> Column:
    too_long = F.format_string(QUERY_TOO_LONG, F.length(query))
    return (
        F.when(F.coalesce(strip(query), F.lit("")) == "", F.lit(QUERY_EMPTY))
        .when(F.length(query) > MAX_QUERY_CHARS, too_long)
    )


def max_results_error(value: Column, data_type: T.DataType) -> Column:
    """Strict form: an integer in range, or null for "no limit sent"."""
    wrong_type = F.when(value.isNotNull(), F.lit(RESULTS_NOT_INTEGER))
    if isinstance(data_type, T.VariantType):
        # schema_of_variant reports every whole number as BIGINT; JSON 5.0 reports a decimal.
        whole = F.schema_of_variant(value).isin(*_INTEGER_KINDS)
        number = F.try_variant_get(value, "$", "bigint")
        return (
            F.when(value.isNull() | F.is_variant_null(value), F.lit(None).cast("string"))
            .when(~whole, F.lit(RESULTS_NOT_INTEGER))
            .when(~number.between(MIN_RESULTS, MAX_RESULTS), F.lit(RESULTS_OUT_OF_RANGE))
        )
    if not isinstance(data_type, T.IntegralType):
        return wrong_type
    return F.when(~value.between(MIN_RESULTS, MAX_RESULTS), F.lit(RESULTS_OUT_OF_RANGE))


def _clamp(number: Column) -> Column:
    bounded = F.greatest(F.lit(float(MIN_RESULTS)), F.least(F.lit(float(MAX_RESULTS)), number))
    return F.coalesce(F.when(number.isNotNull(), bounded).cast("int"), F.lit(DEFAULT_RESULTS))


def clamp_text(raw: Column) -> Column:
    """Permissive form for text: a whole number is clamped to the range, all else is the default."""
    # Underscores between digits are allowed; the second pass takes those that share a digit.
    joined = F.regexp_replace(strip(raw), r"([0-9])_([0-9])", "$1$2")
    joined = F.regexp_replace(joined, r"([0-9])_([0-9])", "$1$2")
    digits = F.when(F.contains(raw, F.lit("_")), joined).otherwise(strip(raw))
    whole = F.when(digits.rlike(r"^[+\-]?[0-9]+$"), digits.try_cast("double"))
    return _clamp(whole)


def clamp_variant(raw: Column) -> Column:
    """Permissive form for JSON values: numbers lose their fraction, text follows the text rule."""
    kind = F.schema_of_variant(raw)
    number = F.try_variant_get(raw, "$", "double")
    flag = F.try_variant_get(raw, "$", "boolean").cast("double")
    text = F.try_variant_get(raw, "$", "string")
    return (
        F.when(kind == "STRING", clamp_text(text))
        .when(kind == "BOOLEAN", _clamp(flag))
        .when(kind.rlike(r"^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), _clamp(number))
        .otherwise(F.lit(DEFAULT_RESULTS))
    )


def clamp_max_results(raw: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.VariantType):
        return clamp_variant(raw)
    if isinstance(data_type, T.NumericType):
        return _clamp(raw.cast("double"))
    if isinstance(data_type, T.BooleanType):
        return _clamp(raw.cast("int").cast("double"))
    return clamp_text(raw)


def split_exclude(raw: Column) -> Column:
    """A text list on commas and white space, blanks dropped."""
    parts = F.split(F.coalesce(raw, F.lit("")), "[," + WHITESPACE + "]+")
    return F.filter(parts, lambda p: p != "")


def trim_exclude(items: Column) -> Column:
    """An array keeps its items whole: trimmed, blanks dropped."""
    trimmed = F.transform(F.coalesce(items, F.array().cast("array<string>")), strip)
    return F.filter(trimmed, lambda p: F.coalesce(p, F.lit("")) != "")
