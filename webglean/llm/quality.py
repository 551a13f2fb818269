"""Quality: logistic regression over hashed word n-grams, learned by FTRL-proximal updates.

A token is a run of letters, digits and bytes of other scripts, or a run of signs. Single tokens and
neighbouring pairs are hashed to ``2**BITS`` weights; a pair of equal tokens has a slot of its own,
so repetition shows whatever the word. A text's vector holds the share of every slot among its
n-grams, and a score is the logistic function of one sparse dot product.

Learning deals a bounded sample of labelled rows to groups; each runs through its rows with
follow-the-regularised-leader updates from the common state, and the states are averaged by slot.

Scores are between 0 and 1; null and empty texts get that of a text without n-grams, all texts 0.5
without labels. A column with the name of the score is replaced, all other columns and rows stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage, forget
from .labels import labelled

BITS = 18
# At most so many labelled rows are learned from, in so many groups, so many times.
SAMPLE = 24_000
GROUPS = 4
EPOCHS = 3
# FTRL-proximal: learning rate, its start, and the two penalties.
ALPHA, BETA, L1, L2 = 0.6, 1.0, 0.02, 1e-4
SCALE = 20.0
# Texts are hashed together up to so many bytes; a longer one alone.
CHUNK = 1 << 20

_PRIME, _REPEAT = 0x9E3779B97F4A7C15, 0x5851F42D4C957F2D
_KIND = np.full(256, 2, np.uint8)
_KIND[:33] = 0
_KIND[127:] = 1
for _a, _z in ("09", "AZ", "az"):
    _KIND[ord(_a) : ord(_z) + 1] = 1


class Model(NamedTuple):
    weights: np.ndarray
    bias: float


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _slots(texts: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all n-grams of some texts, and the text of each."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    kind = _KIND[data]
    begins = np.flatnonzero((kind != 0) & (np.concatenate([[0], kind[:-1]]) != kind))
    if not len(begins):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.flatnonzero((kind != 0) & (np.concatenate([kind[1:], [0]]) != kind)) + 1
    # Hash of a token: a polynomial of its bytes, from prefix sums, moved to power 0.
    inverse = pow(_PRIME, -1, 1 << 64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((data + np.uint64(1)) * _powers(len(data), _PRIME))])
    words = (sums[ends] - sums[begins]) * _powers(len(data), inverse)[begins]
    edges = np.cumsum([len(t) + 1 for t in texts])
    text = np.searchsorted(edges, begins, side="right")
    near = text[1:] == text[:-1]
    pairs = words[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + words[1:]
    pairs = np.where(words[:-1] == words[1:], np.uint64(_REPEAT), pairs)[near]
    grams = np.concatenate([words, pairs])
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    return (grams >> np.uint64(64 - bits)).astype(np.int64), np.concatenate([text, text[1:][near]])


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > CHUNK:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def _dots(texts: list[bytes], model: Model, bits: int) -> np.ndarray:
    out = np.zeros(len(texts))
    for a, b in _chunks(texts):
        slots, text = _slots(texts[a:b], bits)
        sums = np.bincount(text, model.weights[slots], b - a)
        out[a:b] = SCALE * sums / np.maximum(1, np.bincount(text, minlength=b - a))
    return out + model.bias


def score(df: DataFrame, model: Model, text: str = "text", to: str = "score", bits: int = BITS) -> DataFrame:
    """Add the score of every row; no row moves. The model has ``2**bits`` weights, so its size is
    fixed."""

    @F.pandas_udf("double")
    def scored(column: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in column:
            dots = _dots([(x or "").encode() for x in batch], model, bits)
            yield pd.Series(1 / (1 + np.exp(-np.clip(dots, -35, 35))))

    return df.withColumn(to, scored(F.col(text).cast("string")))


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    steps = (BETA + np.sqrt(n)) / ALPHA + L2
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / steps)


def _run(texts: list[bytes], labels: np.ndarray, z: np.ndarray, n: np.ndarray, bits: int) -> None:
    """FTRL-proximal updates of ``z`` and ``n`` in place, a row after the other. Slot ``2**bits`` is
    the bias."""
    for text, label in zip(texts, labels):
        slots, counts = np.unique(_slots([text], bits)[0], return_counts=True)
        at = np.append(slots, 1 << bits)
        x = np.append(SCALE * counts / max(1, counts.sum()), 1.0)
        w = _weights(z[at], n[at])
        share = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
        g = (share - label) * x
        z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
        n[at] += g * g


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
    label: str = "quality", sample: int = SAMPLE, bits: int = BITS, epochs: int = EPOCHS,
) -> Model:
    """Learn from at most ``sample`` labelled rows of ``docs`` that are not held out."""
    group = F.pmod(F.xxhash64(F.lit("group"), "text"), F.lit(GROUPS)).alias("group")
    rows = labelled(docs, labels, label, sample, key, text)
    rows = cut_lineage(rows.select(group, "text", "label", F.xxhash64("text", F.col(key)).alias("turn")))
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    for _ in range(epochs):
        state = (z, n)

        def learned(part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values("turn")
            own_z, own_n = state[0].copy(), state[1].copy()
            _run([t.encode() for t in part["text"]], part["label"].to_numpy(), own_z, own_n, bits)
            at = np.flatnonzero((own_n != 0) | (own_z != 0))
            return pd.DataFrame({"slot": at, "z": own_z[at], "n": own_n[at]})

        # At most ``sample`` rows in GROUPS groups; at most 2**bits + 1 slots come back.
        states = rows.groupBy("group").applyInPandas(learned, "slot long, z double, n double")
        mean = states.groupBy("slot").agg(F.avg("z").alias("z"), F.avg("n").alias("n")).toPandas()
        z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
        z[mean["slot"]], n[mean["slot"]] = mean["z"], mean["n"]
    forget(rows)
    w = _weights(z, n)
    return Model(w[:-1], float(w[-1]))
