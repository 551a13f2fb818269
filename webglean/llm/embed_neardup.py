"""Near-duplicate vectors by sorted projection passes.

Every pass orders the vectors by label and the concatenated signs of their products with random
directions, taken from the centre of the label, and compares each with its next ``WINDOW`` neighbours
by exact cosine. A pair seen in several passes counts once, as both sides know their place in all
passes. Links of all passes together make the components.

Each vector's chance of being missed is measured: in every pass the row ``WINDOW`` places off, on
either side, tells how many signs a partner has to share to be in the window, and the distance to the
centre bounds how often a partner at the limit shares one. The number of passes first follows from
size and spread of the labels, and is raised once if these measures ask for it and the exact
comparison would cost more. Vectors that may still be missed more often than ``MISSED``, and those
with ``DENSE`` links or more, whose neighbours a window may not hold, are compared with all vectors
of their label, in blocks, and pairs that no window held are added. Equal vectors are one with a weight. Blocks return counts and spanning links, never all pairs.

Vectors that are null, zero, or hold null or non-finite components link with nothing, as do null
labels, null ids and vectors of other lengths. Rows that share an id are one vector, the smallest of
them by (label, components).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..session import cut_lineage, forget
from .components import components

WINDOW = 64
DENSE = 16
BLOCK = 1024
MISSED = 0.001
# Rows of the two sides of a block of the exact comparison.
SIDES = (2048, 4096)
BITS = 32
SEED = 11
_LINKS = "rid long, other long, seen long, n long, missed double"


def near_duplicates(
    df: DataFrame, limit: float = 0.93, key: str = "vec_id", vector: str = "embedding",
    label: str = "label", window: int = WINDOW, dense: int = DENSE,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept``, a row an id."""
    rows = df.select(
        F.col(key).cast("long").alias("vec_id"), F.struct(
            F.col(label).cast("string").alias("label"),
            F.col(vector).cast("array<double>").alias("x"),
        ).alias("v"),
    ).groupBy("vec_id").agg(F.min("v").alias("v")).select("vec_id", "v.*")
    usable = F.coalesce(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull()
        & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
        & F.exists("x", lambda c: c != 0), F.lit(False),
    )
    text = F.concat_ws(",", F.col("x").cast("array<string>"))
    rows = cut_lineage(rows.withColumn(
        "print", F.when(usable, F.sha2(F.concat_ws("|", F.hex("label"), text), 256))
    ))
    once = cut_lineage(
        rows.filter("print is not null").groupBy("print").agg(
            F.min("vec_id").alias("rid"), F.count(F.lit(1)).alias("weight"),
            F.first("label").alias("label"), F.first("x").alias("x"),
        ).withColumn("group", F.concat_ws(":", F.size("x").cast("string"), "label"))
    )
    centres = _centres(once)
    passes = centres.agg(F.max(_passes(window, limit))).first()[0] or 1
    most = centres.agg(F.max(_most())).first()[0] or 1
    once = cut_lineage(_spread(once, centres, limit))
    placed, links, sums = _pass(once, passes, limit, window)
    need = _raised(sums, passes)
    if passes < need <= most:
        forget(placed, links, sums)
        placed, links, sums = _pass(once, need, limit, window)
    crowded = sums.filter((F.col("seen") >= dense) | (F.col("missed") > math.log(MISSED)))
    more = cut_lineage(_dense_links(placed, cut_lineage(crowded.select("rid")), limit, window))
    links = links.union(more)
    sums = links.groupBy("rid").agg(F.sum("n").alias("n"))
    pairs = links.filter("other is not null").select(F.col("rid").alias("a"), F.col("other").alias("b"))
    found = once.select("print", "rid", "weight").join(sums, "rid", "left").join(
        components(pairs).withColumnRenamed("node", "rid"), "rid", "left"
    ).select(
        "print", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("component", "rid").alias("component_id"),
    )
    return rows.select("vec_id", "print").join(found, "print", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        (F.coalesce("component_id", "vec_id") == F.col("vec_id")).alias("kept"),
    ).withColumn("kept", F.coalesce("kept", F.lit(True)))


def _centres(once: DataFrame) -> DataFrame:
    """``group, size, centre``: the mean of the vectors of a group, each of length one."""

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = [(g, len(part), _matrix(part).sum(axis=0).tolist()) for g, part in batch.groupby("group")]
            yield pd.DataFrame(parts, columns=["group", "size", "total"])

    parts = once.select("group", "x").mapInPandas(summed, "group string, size long, total array<double>")
    sums = parts.select("group", "size", F.posexplode("total").alias("at", "total")).groupBy("group", "at").agg(
        F.sum("size").alias("size"), F.sum("total").alias("total")
    )
    centre = F.array_sort(F.collect_list(F.struct("at", (F.col("total") / F.col("size")).alias("c"))))
    return cut_lineage(sums.groupBy("group").agg(
        F.first("size").alias("size"), F.transform(centre, lambda c: c["c"]).alias("centre")
    ))


def _most() -> Column:
    """Passes beyond which comparing all vectors of a group costs less, as rows carry their places."""
    return F.greatest(F.lit(64), F.ceil(F.sqrt("size") / 2)).cast("int")


def _agree(square: Column, limit: float) -> Column:
    """How often a sign is shared with a vector within the limit, at the squared distance to the centre."""
    chord = F.least(F.lit(1.0), F.sqrt(F.lit(2 - 2 * limit) / F.greatest(square, F.lit(1e-12))))
    return 1 - F.asin(chord) / math.pi


def _passes(window: int, limit: float) -> Column:
    """Passes that all miss a pair of cosine ``limit`` less than once in a thousand if signs from the
    centre are even, for groups where they cost less than the exact comparison; else 1."""
    square = 1 - F.aggregate("centre", F.lit(0.0), lambda a, c: a + c * c)
    bits = F.greatest(F.lit(1.0), F.log2(F.col("size") / window) + 2)
    need = F.ceil(math.log(MISSED) / F.log1p(-F.pow(_agree(square, limit), bits)))
    return F.when((F.col("size") > window) & (need <= _most()), need).otherwise(1).cast("int")


def _spread(once: DataFrame, centres: DataFrame, limit: float) -> DataFrame:
    """Vectors with the centre of their group and ``agree``, the share of signs a partner has in common."""

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            square = np.zeros(len(batch))
            for _, at in batch.groupby(batch["x"].map(len)).indices.items():
                part = batch.iloc[at]
                square[at] = ((_matrix(part) - np.stack(part["centre"])) ** 2).sum(axis=1)
            yield batch.assign(square=square)

    rows = once.join(centres.select("group", "centre"), "group")
    rows = rows.mapInPandas(measured, StructType([*rows.schema, StructField("square", DoubleType())]))
    # Half a turn or more: nothing is known about a partner's signs.
    near = F.col("square") > 2 - 2 * limit
    return rows.withColumn("agree", F.when(near, _agree(F.col("square"), limit)).otherwise(0.0)).drop("square")


def _pass(once: DataFrame, passes: int, limit: float, window: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Places in all passes, links of the windows, and their sums a vector."""
    placed = _placed(once, passes)
    links = cut_lineage(_window_links(placed, limit, window))
    sums = cut_lineage(links.groupBy("rid").agg(F.sum("seen").alias("seen"), F.sum("missed").alias("missed")))
    return placed, links, sums


def _raised(sums: DataFrame, passes: int) -> int:
    """Passes after which all but a twentieth of the vectors would be missed no more than ``MISSED``."""
    need = F.least(F.lit(1e9), F.lit(passes * math.log(MISSED)) / F.least("missed", F.lit(-1e-9)))
    return math.ceil(sums.agg(F.percentile_approx(need, 0.95)).first()[0] or 0)


def _placed(once: DataFrame, passes: int) -> DataFrame:
    """Vectors with their places in all passes; places count on from pass to pass."""

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, part in batch.groupby(batch["x"].map(len)):
                draw = np.random.default_rng([SEED, size]).standard_normal((size, passes * BITS))
                signs = ((_matrix(part) - np.stack(part["centre"])) @ draw > 0).reshape(len(part), passes, BITS)
                keys = signs @ (1 << np.arange(BITS, dtype=np.int64))[::-1]
                yield pd.DataFrame({
                    "rid": np.repeat(part["rid"].to_numpy(), passes),
                    "group": np.repeat(part["group"].to_numpy(), passes),
                    "pass": np.tile(np.arange(passes), len(part)), "key": keys.ravel(),
                })

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            at = np.arange(done, done + len(batch))
            done += len(batch)
            yield batch.assign(part=part, at=at)

    order = ["pass", "group", "key", "rid"]
    keys = once.select("rid", "group", "x", "centre").mapInPandas(hashed, "rid long, group string, pass int, key long")
    ranged = keys.repartitionByRange(*order).sortWithinPartitions(*order).select("rid", "pass", "key")
    local = cut_lineage(ranged.mapInPandas(counted, "rid long, pass int, key long, part int, at long"))
    # A row for each partition of the sort.
    sizes = {r.part: r.n for r in local.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    base, bases = 0, {}
    for part in sorted(sizes):
        bases[part], base = base, base + sizes[part]
    start = F.element_at(F.create_map(*[F.lit(x) for kv in bases.items() for x in kv]), F.col("part")) if bases else F.lit(0)
    places = local.groupBy("rid").agg(
        F.array_sort(F.collect_list(F.struct("pass", (start + F.col("at")).alias("place"), "key"))).alias("s")
    ).select("rid", F.col("s.place").alias("places"), F.col("s.key").alias("keys"))
    placed = cut_lineage(once.drop("centre").join(places, "rid"))
    forget(local)
    return placed


def _matrix(part: pd.DataFrame) -> np.ndarray:
    x = np.stack(part["x"]).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # squares of very large or small numbers
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest position reachable through the pairs (i, j), for each of n positions."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _result(ids: np.ndarray, weights: np.ndarray, i: np.ndarray, j: np.ndarray, fresh: np.ndarray) -> pd.DataFrame:
    """Counts of the fresh pairs, and spanning links of all."""
    n = len(ids)
    a, b = i[fresh], j[fresh]
    seen = np.bincount(a, minlength=n) + np.bincount(b, minlength=n)
    total = np.bincount(a, weights[b], n) + np.bincount(b, weights[a], n)
    root = _roots(n, i, j)
    used = np.flatnonzero((seen > 0) | (root != np.arange(n)))
    other = pd.array(ids[root[used]], "Int64")
    other[root[used] == used] = pd.NA
    return pd.DataFrame({
        "rid": ids[used], "other": other, "seen": seen[used],
        "n": np.rint(total[used]).astype(np.int64), "missed": 0.0,
    })


def _missed(keys: np.ndarray, agree: np.ndarray, window: int) -> np.ndarray:
    """Logarithm of the chance that the window does not hold a partner, for sorted keys of one pass."""
    shared = np.full(len(keys), -1)  # signs shared with the nearest rows out of the window
    if len(keys) > window:
        same = BITS - np.frexp((keys[window:] ^ keys[:-window]).astype(np.float64))[1]
        shared[:-window] = same
        shared[window:] = np.maximum(shared[window:], same)
    found = np.where(shared < 0, 1.0, agree ** (shared + 1.0))
    return np.log1p(-np.minimum(np.where(shared < BITS, found, 0.0), 1 - 1e-12))


def _window_links(placed: DataFrame, limit: float, window: int) -> DataFrame:
    at = F.posexplode("places").alias("pass", "place")
    rows = placed.select("rid", "group", "weight", "x", "agree", "places", "keys", at)
    rows = rows.withColumn("key", F.element_at("keys", F.col("pass") + 1)).drop("keys")
    block = F.floor(F.col("place") / BLOCK)
    first = F.col("place") % BLOCK
    # The first rows of a block also go to the one before, whose last windows reach into it, and the
    # last ones to the one behind.
    blocks = F.array(block, F.when(first < window, block - 1), F.when(first >= BLOCK - window, block + 1))
    rows = rows.withColumn("block", F.explode(F.filter(blocks, lambda b: b >= 0)))

    def linked(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("place")
        ids, weights = part["rid"].to_numpy(), part["weight"].to_numpy()
        places, passes = np.stack(part["places"]), part["pass"].to_numpy()
        groups = pd.factorize(part["group"])[0]
        own = part["place"].to_numpy() // BLOCK == part["block"].to_numpy()
        found, missed = [np.zeros((0, 2), np.int64)], np.zeros(len(part))
        for group in np.unique(groups):  # only one length of vectors at a time
            for turn in np.unique(passes[groups == group]):
                at = np.flatnonzero((groups == group) & (passes == turn))
                x = _matrix(part.iloc[at])
                missed[at] = _missed(part["key"].to_numpy()[at], part["agree"].to_numpy()[at], window)
                for c in range(0, len(at), 256):
                    near = x[c : c + 256] @ x[c : c + 256 + window].T
                    a, b = np.nonzero(near >= limit)
                    a, b = at[a + c], at[b + c]
                    gap = part["place"].to_numpy()[b] - part["place"].to_numpy()[a]
                    keep = (gap > 0) & (gap <= window) & own[a]
                    found.append(np.stack([a[keep], b[keep]], 1))
        i, j = np.concatenate(found).T
        before = np.abs(places[i] - places[j]) <= window
        before &= np.arange(places.shape[1]) < passes[i][:, None]
        chance = pd.DataFrame({"rid": ids[own], "other": pd.NA, "seen": 0, "n": 0, "missed": missed[own]})
        chance["other"] = chance["other"].astype("Int64")
        return pd.concat([_result(ids, weights, i, j, ~before.any(axis=1)), chance])

    return rows.groupBy("block").applyInPandas(linked, _LINKS)


def _dense_links(placed: DataFrame, crowded: DataFrame, limit: float, window: int) -> DataFrame:
    marked = placed.join(crowded.withColumn("dense", F.lit(True)), "rid", "left")
    marked = cut_lineage(marked.withColumn("dense", F.coalesce("dense", F.lit(False))))
    sizes = marked.groupBy("group").agg(
        F.ceil(F.count_if("dense") / SIDES[0]).alias("asked"),
        F.ceil(F.count(F.lit(1)) / SIDES[1]).alias("all"),
    ).filter("asked > 0")
    rows = marked.join(sizes, "group")
    turn = F.xxhash64("rid")
    left = rows.filter("dense").withColumn("q", F.pmod(turn, "asked")).withColumn(
        "r", F.explode(F.sequence(F.lit(0).cast("long"), F.col("all") - 1))
    )
    right = rows.withColumn("r", F.pmod(turn, "all")).withColumn(
        "q", F.explode(F.sequence(F.lit(0).cast("long"), F.col("asked") - 1))
    )
    columns = ["group", "q", "r", "rid", "weight", "x", "places", "dense"]
    both = left.select(*columns, F.lit(True).alias("asks")).union(
        right.select(*columns, F.lit(False).alias("asks"))
    )

    def linked(part: pd.DataFrame) -> pd.DataFrame:
        asks = part["asks"].to_numpy()
        a, b = part[asks], part[~asks]
        if not len(a) or not len(b):
            return pd.DataFrame({"rid": [], "other": [], "seen": [], "n": [], "missed": []})
        ids, place = np.unique(np.concatenate([a["rid"], b["rid"]]), return_inverse=True)
        weights = np.zeros(len(ids), np.int64)
        weights[place] = np.concatenate([a["weight"], b["weight"]])
        at_a, at_b = place[: len(a)], place[len(a) :]
        rid_a, rid_b = a["rid"].to_numpy()[:, None], b["rid"].to_numpy()[None, :]
        x, y, found = _matrix(a), _matrix(b), [np.zeros((0, 2), np.int64)]
        places_a, places_b = np.stack(a["places"]), np.stack(b["places"])
        for c in range(0, len(a), 256):
            # A pair of two dense vectors is compared twice, and counted from its smaller id.
            ours = rid_a[c : c + 256]
            pairs = (x[c : c + 256] @ y.T >= limit) & (ours != rid_b)
            pairs &= ~b["dense"].to_numpy()[None, :] | (ours < rid_b)
            found.append(np.argwhere(pairs) + [c, 0])
        i, j = np.concatenate(found).T
        known = np.zeros(len(i), bool)
        for turn in range(places_a.shape[1]):
            known |= np.abs(places_a[i, turn] - places_b[j, turn]) <= window
        return _result(ids, weights, at_a[i], at_b[j], ~known)

    return both.groupBy("group", "q", "r").applyInPandas(linked, _LINKS)
