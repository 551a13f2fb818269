"""Importance resampling: documents drawn by how much their n-grams look like a target text.

Features are runs of words, hashed to a fixed number of buckets. The gain of a bucket is the scaled
logarithm of its share in the target over its share in the corpus. A document's weight is the mean gain
of its features; with seeded noise added, the highest scores are a draw without replacement.

Python sees pieces of about ``PIECE`` bytes, whole texts piece by piece. There every n-gram is
interned in an open-addressed NumPy table: its xxhash64 key names the first slot to try, a claim of an
empty slot by several is won by the last, and a slot counts as found only if its n-gram's bytes are
the same, so equal keys of different n-grams stay apart. Slots hold bucket and count; the slot ids of
the occurrences gather the gains. Tasks send on one count a bucket.

Null and empty texts have no features and weight 0. A null id draws noise as an empty one; repeated
rows count each. Rows with null, infinite or no features in the target are nothing special: an empty
target or corpus has gains from the smoothing alone, and empty tables give empty tables. Columns named
like those added are replaced; all others stay.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.scan import numbered
from ..session import cut_lineage, forget

_RANK = "__rank__"

BUCKETS = 10_000
PIECE = 1 << 20

# Digits, small letters and all bytes of other scripts make words; capitals become small.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def intern(grams: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The slot of every occurrence, and for every slot an occurrence of its n-gram, or -1."""
    n = len(grams)
    keys = np.fromiter(map(xxhash.xxh64_intdigest, grams), np.uint64, n)
    size = 1 << max(3, (2 * n).bit_length())
    holder = np.full(size, -1, np.int64)
    slot = (keys & np.uint64(size - 1)).astype(np.int64)
    left = np.arange(n)
    while len(left):
        at = slot[left]
        free = holder[at] < 0
        holder[at[free]] = left[free]
        held = holder[at]
        same = keys[held] == keys[left]
        check = np.flatnonzero(same)
        same[check] = [grams[a] == grams[b] for a, b in zip(left[check].tolist(), held[check].tolist())]
        left = left[~same]
        slot[left] = (slot[left] + 1) & (size - 1)
    return slot, holder


def _pieces(texts: list[str | None], longest: int) -> Iterator[tuple[list[bytes], list[int], list[int]]]:
    """N-grams of some texts in pieces, with the number of n-grams and of words of every text."""
    grams: list[bytes] = []
    counts, words = [0] * len(texts), [0] * len(texts)
    held = 0
    for i, text in enumerate(texts):
        data = (text or "").encode().translate(_FOLD)
        start, before = 0, []
        while start < len(data):
            stop = data.find(b" ", start + PIECE)
            stop = len(data) if stop < 0 else stop
            fresh = data[start:stop].split()
            run = before + fresh
            found = list(fresh)
            for n in range(2, longest + 1):
                found += [
                    b" ".join(run[end - n : end]) for end in range(max(n, len(before) + 1), len(run) + 1)
                ]
            grams += found
            counts[i] += len(found)
            words[i] += len(fresh)
            before = run[-(longest - 1) :] if longest > 1 else []
            held += stop - start
            start = stop
            if held > PIECE:
                yield grams, counts, words
                grams, held = [], 0
                counts, words = [0] * len(texts), [0] * len(texts)
    yield grams, counts, words


def _interned(grams: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The slot of every occurrence; bucket and count of every slot."""
    slot, holder = intern(grams)
    bucket = np.zeros(len(holder), np.int64)
    used = np.flatnonzero(holder >= 0)
    bucket[used] = [zlib.crc32(grams[i]) % buckets for i in holder[used].tolist()]
    return slot, bucket, np.bincount(slot, minlength=len(holder))


def bucket_counts(df: DataFrame, longest: int = 1, buckets: int = BUCKETS, text: str = "text") -> DataFrame:
    """``bucket, features`` over all texts; buckets without features have no row."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for grams, _, _ in _pieces(batch["text"].tolist(), longest):
                _, bucket, count = _interned(grams, buckets)
                np.add.at(total, bucket, count)
        full = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": full, "features": total[full]})

    texts = df.select(F.col(text).cast("string").alias("text"))
    parts = texts.mapInPandas(counted, "bucket long, features long")
    return parts.groupBy("bucket").agg(F.sum("features").alias("features"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket from two tables of ``bucket_counts``: ``buckets`` rows at most."""
    sides = []
    for side in (corpus, target):
        count = np.zeros(buckets)
        for row in side.collect():
            count[row.bucket] = row.features
        sides.append(count)
    s, t = sides
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _noise(seed: int, key: str) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of a digest of the id."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def score(
    docs: DataFrame, gain: np.ndarray, longest: int = 1, seed: int = 2024, key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Add ``n_words, n_features, weight, score``; no row moves. ``gain`` has one number a bucket."""
    buckets = len(gain)

    @F.pandas_udf("n_words long, n_features long, weight long")
    def weighed(column: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in column:
            texts = batch.tolist()
            features, words, sums = (np.zeros(len(texts), np.int64) for _ in range(3))
            for grams, count, length in _pieces(texts, longest):
                slot, bucket, _ = _interned(grams, buckets)
                ends = np.cumsum([0, *count])
                summed = np.concatenate([[0], np.cumsum(gain[bucket][slot])])
                sums += summed[ends[1:]] - summed[ends[:-1]]
                features += count
                words += length
            yield pd.DataFrame({
                "n_words": words, "n_features": features,
                "weight": np.where(features > 0, sums // np.maximum(features, 1), 0),
            })

    added = ("n_words", "n_features", "weight")
    rows = docs.select(F.struct(*docs.columns).alias("_row"), _noise(seed, key).alias("_noise"),
                       weighed(F.col(text).cast("string")).alias("_found"))
    return rows.select(
        *[F.col("_row")[c].alias(c) for c in docs.columns if c not in (*added, "score")],
        *[F.col("_found")[c].alias(c) for c in added],
        (F.col("_found")["weight"] + F.col("_noise")).alias("score"),
    )


def draw(scored: DataFrame, percent: int = 10, min_words: int = 20, key: str = "doc_id") -> DataFrame:
    """Add ``rank``: 1, 2, 3, ... over the highest scores of ``percent`` of the documents with at least
    ``min_words`` words, ties to the smaller id, a null id last; null for all others.

    All rows are sorted, in ranges, with the columns that they have: pass narrow ones.
    """
    able = F.col("n_words") >= min_words
    order = [
        F.when(able, F.col("score")).desc_nulls_last(), F.col(key).asc_nulls_last(),
        F.col("n_features").asc(), F.col("weight").asc(),
    ]
    # Counted, sampled for the ranges and dealt out: written once, so texts are scored once.
    scored = cut_lineage(scored.drop("rank"))
    drawn = scored.filter(able).count() * percent // 100
    placed = numbered(scored, order, _RANK)
    forget(scored)
    return placed.withColumn("rank", F.when(F.col(_RANK) <= drawn, F.col(_RANK))).drop(_RANK)
