"""Byte-level BPE by dynamic programming over byte prefixes.

For every prefix of a byte string exactly one token can be the last of its encoding. ``BytePairs``
knows the vocabulary and which two tokens may stand side by side; ``PrefixEncoder`` keeps the last
token of every prefix, so appending bytes costs only the new bytes, and an edit costs the bytes
around it. ``encode`` and ``decode`` apply both to a text column.

Nulls are empty texts, an empty text has no tokens and decodes to no bytes. Columns of the input
stay; a column with the name of a result column is replaced.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import cache

import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F

from .batches import short_batches, working

# Pieces whose ids a worker remembers before it starts over.
REMEMBERED = 400_000


class BytePairs:
    """A vocabulary given as rank per byte string, and the pairs of tokens that stay apart."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.pairs: dict[tuple[int, int], int] = {}
        self.seen: dict[tuple[int, int], bool] = {}
        # The two parts that the last merge of a token joined. Lower ranks are known before higher.
        for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut], rank), ranks.get(token[cut:], rank)
                if a < rank and b < rank and self.apart(a, b):
                    self.left[rank], self.right[rank] = a, b
                    self.pairs[a, b] = rank
                    break
        # No merge leads to the tokens left out here, so no encoding holds them.
        self.usable = {t: r for t, r in ranks.items() if len(t) == 1 or r in self.left}
        self.tails = {t[i:] for t in self.usable for i in range(len(t))}

    def neighbours(self, a: int, b: int) -> bool:
        """``apart``, remembered."""
        known = self.seen.get((a, b))
        if known is None:
            if len(self.seen) >= REMEMBERED:
                self.seen.clear()
            known = self.seen[a, b] = self.apart(a, b)
        return known

    def apart(self, a: int, b: int) -> bool:
        """Whether the bytes of ``a`` then ``b`` encode to just these two tokens.

        Merges are undone from the latest on. If the two parts that meet at the border have a
        merge of their own that comes before the one just undone, it would have happened instead.
        """
        limit = 1 << 60
        left, right, pairs = self.left, self.right, self.pairs
        while True:
            merged = pairs.get((a, b))
            if merged is not None and merged < limit:
                return False
            if a > b and a in right or b not in left:
                if a not in right:
                    return True
                limit, a = a, right[a]
            else:  # of equal merges the left one comes first
                limit, b = b + 1, left[b]


class PrefixEncoder:
    """The last token of every prefix of a growing or edited byte string."""

    def __init__(self, pairs: BytePairs, data: bytes = b""):
        self.pairs = pairs
        self.data = bytearray()
        self.last: list[int] = []
        self.append(data)

    def append(self, more: bytes) -> None:
        start = len(self.data)
        self.data += more
        self._fill(bytes(self.data), start, len(self.data))

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Replace ``data[start:end]``; the number of prefixes that had to be worked out again.

        A last token depends on the bytes and last tokens at most one longest token before it. Once
        that many in a row equal the old ones behind the edit, the rest is the same as well.
        """
        kept, old = self.last[end:], len(self.data)
        self.data[start:end] = new
        data, shift = bytes(self.data), len(new) - (end - start)
        del self.last[start:]
        self._fill(data, start, start + len(new))
        worked, same = len(new), 0
        for at in range(start + len(new), old + shift):
            self._fill(data, at, at + 1)
            worked += 1
            same = same + 1 if self.last[at] == kept[at - shift - end] else 0
            if same >= self.pairs.longest:
                self.last += kept[at + 1 - shift - end :]
                break
        return worked

    def _fill(self, data: bytes, start: int, stop: int) -> None:
        last, usable, tails = self.last, self.pairs.usable, self.pairs.tails
        neighbours, seen = self.pairs.neighbours, self.pairs.seen
        for end in range(start + 1, stop + 1):
            fits, begin = [], end - 1
            while begin >= 0 and (tail := data[begin:end]) in tails:
                if tail in usable:
                    fits.append((begin, usable[tail]))
                begin -= 1
            for before, token in reversed(fits):
                if not before:
                    last.append(token)
                    break
                fit = seen.get((last[before - 1], token))
                if fit is None:
                    fit = neighbours(last[before - 1], token)
                if fit:
                    last.append(token)
                    break
            else:
                raise ValueError(f"byte {data[end - 1]} is not in the vocabulary")

    def ids(self) -> list[int]:
        found, end, bytes_of = [], len(self.data), self.pairs.bytes_of
        while end:
            token = self.last[end - 1]
            found.append(token)
            end -= len(bytes_of[token])
        return found[::-1]


def _read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: lines of a base64 token and its rank."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


@cache
def load_ranks(path: str) -> BytePairs:
    """Made once in a worker."""
    return BytePairs(_read_ranks(path))


@cache
def _tokens(path: str) -> dict[int, bytes]:
    """What decoding needs: much less than encoding."""
    return {rank: token for token, rank in _read_ranks(path).items()}


class _Pieces(dict):
    """Little-endian ids of a piece of text, worked out at its first use."""

    def __init__(self, pairs: BytePairs):
        super().__init__()
        self.pairs = pairs

    def __missing__(self, piece: str) -> bytes:
        data = piece.encode()
        whole = self.pairs.usable.get(data)  # a token that merges lead to is its own encoding
        found = PrefixEncoder(self.pairs, data).ids() if whole is None else [whole]
        ids = array("I", found).tobytes()
        if len(self) >= REMEMBERED:
            self.clear()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


@cache
def _pieces(path: str) -> _Pieces:
    return _Pieces(load_ranks(path))


@cache
def _cutter(pattern: str) -> regex.Pattern:
    # White space is Unicode's: unlike Python's it leaves out the separators U+001C to U+001F.
    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def _drop() -> None:
    for kept in (_pieces, load_ranks, _tokens):
        kept.cache_clear()


def encode_text(text: str, path: str, pattern: str) -> bytes:
    """Ids of one text as little-endian unsigned 32-bit integers; every match apart."""
    return b"".join(map(_pieces(path).__getitem__, _cutter(pattern).findall(text)))


def encode(
    df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids",
    count: str = "n_tokens",
) -> DataFrame:
    """Add ``ids`` (little-endian unsigned 32-bit integers) and ``count``."""

    @F.pandas_udf("binary")
    def encoded(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        working("bpe", _drop)
        for batch in texts:
            yield pd.Series([encode_text(x or "", path, pattern) for x in batch], dtype=object)

    df = short_batches(df).withColumn(ids, encoded(F.col(text)))
    return df.withColumn(count, (F.octet_length(ids) / 4).cast("long"))


def decode(df: DataFrame, path: str, ids: str = "token_ids", to: str = "decoded") -> DataFrame:
    """Add ``to``: the bytes of ``ids``; null ids give no bytes."""

    @F.pandas_udf("binary")
    def decoded(column: Iterator[pd.Series]) -> Iterator[pd.Series]:
        working("bpe", _drop)
        of = _tokens(path).__getitem__
        for batch in column:
            yield pd.Series([b"".join(map(of, array("I", x or b""))) for x in batch], dtype=object)

    return short_batches(df).withColumn(to, decoded(F.col(ids)))
