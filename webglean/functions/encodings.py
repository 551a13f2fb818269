"""Bytes to text. UTF-8, ASCII, Latin-1 and Windows-1252 are decoded inside the JVM."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, functions as F, types as T
from pyspark.sql.functions import pandas_udf

# Names web servers use for the encodings handled without Python.
UTF8_NAMES = ("utf-8", "utf8")
ASCII_NAMES = ("ascii", "us-ascii")
LATIN1_NAMES = ("iso-8859-1", "iso8859-1", "latin-1", "latin1")
CP1252_NAMES = ("windows-1252", "cp1252")

_HIGH = "".join(chr(c) for c in range(0x80, 0x100))
_C1 = "".join(chr(c) for c in range(0x80, 0xA0))
_CP1252 = "".join(bytes([c]).decode("cp1252", "replace") for c in range(0x80, 0xA0))


@pandas_udf(T.StringType())
def _decode_other(body: pd.Series, encoding: pd.Series) -> pd.Series:
    def one(raw: bytes | None, name: str | None) -> str | None:
        if raw is None:
            return None
        try:
            return bytes(raw).decode(name, "replace")
        except LookupError:
            return bytes(raw).decode("utf-8", "replace")

    return pd.Series([one(b, n) for b, n in zip(body, encoding)], dtype=object)


_KNOWN = (*UTF8_NAMES, *ASCII_NAMES, *LATIN1_NAMES, *CP1252_NAMES)


def _name(encoding: Column) -> Column:
    return F.lower(F.coalesce(encoding, F.lit(UTF8_NAMES[0])))


def is_rare(encoding: Column) -> Column:
    """Whether it takes Python to decode this encoding; never null."""
    return ~_name(encoding).isin(*_KNOWN)


def decode_known(body: Column, encoding: Column, max_bytes: int = 2_000_000) -> Column:
    """``cap_and_decode`` for encodings that are not rare; null for others. Stays inside the JVM."""
    capped, name = F.substring(body, 1, max_bytes), _name(encoding)
    latin1 = F.decode(capped, "ISO-8859-1")
    return (
        F.when(name.isin(*UTF8_NAMES), F.make_valid_utf8(capped.cast("string")))
        .when(name.isin(*LATIN1_NAMES), latin1)
        .when(name.isin(*CP1252_NAMES), F.translate(latin1, _C1, _CP1252))
        .when(name.isin(*ASCII_NAMES), F.translate(latin1, _HIGH, "�" * len(_HIGH)))
    )


def decode_rare(body: Column, encoding: Column, max_bytes: int = 2_000_000) -> Column:
    """``cap_and_decode`` for any encoding, in Python; an unknown name falls back to UTF-8."""
    return _decode_other(F.substring(body, 1, max_bytes), _name(encoding))


def cap_and_decode(body: Column, encoding: Column, max_bytes: int = 2_000_000) -> Column:
    """The first ``max_bytes`` bytes as text; bad bytes become U+FFFD, no encoding means UTF-8.

    All rows pass a Python worker, those of known encodings without their bytes. Where rows can be
    split first, ``decode_known`` and ``decode_rare`` keep the former away from Python. If ``encoding``
    is a constant, Spark folds the unused branch away.
    """
    rare = F.when(is_rare(encoding), body)
    return F.when(~is_rare(encoding), decode_known(body, encoding, max_bytes)).otherwise(
        decode_rare(rare, encoding, max_bytes)
    )
