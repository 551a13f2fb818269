"""Text expressions. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark import SparkContext
from pyspark.sql import Column, functions as F

# Every code point Unicode counts as white space lies below U+3001.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

ELLIPSIS = "…"
TOKEN = r"[\p{L}\p{N}]+"


def strip(col: Column) -> Column:
    """Remove Unicode white space at both ends (Spark's ``trim`` only removes U+0020)."""
    return F.btrim(col, F.lit(WHITESPACE))


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def is_blank(col: Column) -> Column:
    """Null or empty, the test used for URLs and error strings."""
    return F.coalesce(col, F.lit("")) == ""


def truncate_text(col: Column, max_chars: int | None = 8000) -> Column:
    """Cut to ``max_chars`` characters and add an ellipsis; ``None`` or 0 means no cut.

    The ellipsis comes on top, so a cut text has at most ``max_chars + 1`` characters.
    """
    if not max_chars:
        return col
    cut = F.concat(F.rtrim(F.left(col, F.lit(max_chars)), F.lit(WHITESPACE)), F.lit(ELLIPSIS))
    return F.when(F.length(col) > max_chars, cut).otherwise(col)


def tokens(col: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.regexp_extract_all(F.lower(F.coalesce(col, F.lit(""))), F.lit(TOKEN), F.lit(0))


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)``, with the value worked out once however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def built_once(make: Callable[..., Column]) -> Callable[..., Column]:
    """``make(column, ..)``, remembered where the column is given by name.

    A long expression takes thousands of small calls to the JVM to build, and none to use again.
    """
    known: dict[tuple, Column] = {}

    @wraps(make)
    def built(column: Column | str, *rest: object) -> Column:
        if not isinstance(column, str):
            return make(column, *rest)
        key = (id(SparkContext._gateway), column, *rest)
        if key not in known:
            known[key] = make(F.col(column), *rest)
        return known[key]

    return built
