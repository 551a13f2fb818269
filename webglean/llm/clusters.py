"""Centroid clustering of whole-number vectors, with bounds that loosen by geometry.

A vector keeps an upper bound of the distance to its own centroid and a lower bound of the distance
to all others. While the first is below the second it cannot change sides and nothing is measured.
Only ambiguous vectors are compared with every centroid, in exact integers.

After a round the centroids move. The upper bound grows by the own centroid's drift. The lower bound
falls by less than the largest drift: all vectors of a cluster lie in a sphere around its centroid.
In the plane through that centre and another centroid's old and new place, the distance to the two
places can differ by the drift times the cosine of the angle at the middle between them at most, as
|x - p| + |x - q| >= 2 |x - (p + q) / 2|. The lines from the middle that touch the sphere give the least
such angle, and with it how much nearer the other centroid can have come to any vector inside.

Every round writes vectors with their bounds as a table in the shared folder, with one row a cluster
and task that holds exact sums; the driver sees ``clusters * dims`` numbers a round. Both parameters
should stay in the thousands. A round that moves no centroid ends the work, as all others would
repeat it.

Vectors that are null, of another length, or hold a null or a component that is not finite have no
row. Components are cut where squared distances would no longer be exact in 64 bits: at 64 dimensions
and a scale of 1,024 beyond 185,000 on both sides. Repeated and null keys keep their rows. With fewer vectors than clusters each is a centroid; an empty
table gives an empty one. Other columns are not carried. A sum beyond 64 bits is null.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import cut_lineage, forget

# Bounds are doubles: they get this much room, far above what rounding adds up to.
ROOM = 1e-9


class Moved(NamedTuple):
    """Centroids of a round, and how they came about: drift, and how far lower bounds loosen."""

    centers: np.ndarray
    drift: np.ndarray
    loosen: np.ndarray


def whole_vectors(df: DataFrame, dims: int, scale: int, key: str, vector: str) -> DataFrame:
    """``key, vec``: vectors of ``dims`` finite components as whole numbers, rounded down."""
    parts = F.col(vector).cast("array<double>")
    finite = F.forall(parts, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    # Twice this, squared and summed over the components, is below 2**63.
    most = float(min((1 << 31) - 1, math.isqrt((1 << 61) // dims)))
    cut = F.transform(parts, lambda x: F.floor(F.greatest(F.lit(-most), F.least(F.lit(most), x * scale))))
    kept = F.when((F.size(parts) == dims) & finite, cut)
    return df.select(F.col(key).alias("key"), kept.alias("vec")).filter(F.col("vec").isNotNull())


def first_centers(vectors: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors whose keys have the smallest hashes, in that order; ties by components."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit("")))
    rows = vectors.orderBy(F.sha2(named, 256), "vec").limit(clusters).select("vec").collect()
    return np.array([r.vec for r in rows], np.int64)


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """By how much the lower bound of vectors of every cluster falls, at most.

    ``radius[i]`` bounds the distance of the vectors of cluster i from ``old[i]``.
    """
    out = np.zeros(len(old))
    move = (new - old).astype(float)
    drift = np.sqrt((move**2).sum(1))
    for j in np.flatnonzero(drift):
        off = old - (old[j] + new[j]) / 2
        away = np.sqrt((off**2).sum(1))
        cosine = np.clip(off @ move[j] / np.maximum(away * drift[j], 1e-300), -1, 1)
        # Half the angle under which the sphere is seen from the middle of the move.
        half = np.arcsin(np.minimum(1, radius / np.maximum(away, 1e-300)))
        nearer = drift[j] * np.maximum(0, np.cos(np.maximum(0, np.arccos(cosine) - half)))
        nearer = np.where(radius >= away, drift[j], nearer)
        nearer[j] = 0
        out = np.maximum(out, nearer)
    return out * (1 + ROOM)


def _squares(vectors: np.ndarray, center: np.ndarray) -> np.ndarray:
    return ((vectors - center) ** 2).sum(1)


def _scan(vectors: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, ...]:
    """Nearest centroid (ties: the smaller number), its distance, and the next distance."""
    squares = np.stack([_squares(vectors, c) for c in centers], 1)
    cluster = squares.argmin(1)
    rows = np.arange(len(vectors))
    least = squares[rows, cluster]
    squares[rows, cluster] = np.iinfo(np.int64).max
    after = np.sqrt(squares.min(1)) if len(centers) > 1 else np.full(len(vectors), np.inf)
    return cluster, np.sqrt(least), after


def _assigned(
    vectors: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, moved: Moved
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """New clusters and bounds, and how many vectors were compared with all centroids."""
    upper = upper + moved.drift[cluster]
    lower = lower - moved.loosen[cluster]
    unsure = np.flatnonzero(upper * (1 + ROOM) + ROOM >= lower)
    own = moved.centers[cluster[unsure]]
    upper[unsure] = np.sqrt(((vectors[unsure] - own) ** 2).sum(1))
    unsure = unsure[upper[unsure] * (1 + ROOM) + ROOM >= lower[unsure]]
    if len(unsure):
        cluster[unsure], upper[unsure], lower[unsure] = _scan(vectors[unsure], moved.centers)
    return cluster, upper, lower, len(unsure)


def _state_type(key: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("key", key), T.StructField("vec", T.BinaryType()),
        T.StructField("cluster", T.IntegerType()), T.StructField("upper", T.DoubleType()),
        T.StructField("lower", T.DoubleType()), T.StructField("sums", T.ArrayType(T.LongType())),
        T.StructField("rows", T.LongType()), T.StructField("scanned", T.LongType()),
    ])


def _round(state: DataFrame, key: T.DataType, moved: Moved) -> DataFrame:
    """One assignment of all vectors. Rows with ``sums`` are a task's sums of one cluster, with the
    largest upper bound in ``upper`` and the number of full comparisons in ``scanned``."""
    clusters, dims = moved.centers.shape

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, rows = np.zeros((clusters, dims), np.int64), np.zeros(clusters, np.int64)
        radius, scanned, shape = np.zeros(clusters), 0, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            vectors = _whole(batch.column("vec"), dims)
            if "cluster" in batch.schema.names:
                cluster = batch.column("cluster").to_numpy(False).astype(np.int64)
                upper, lower = (batch.column(c).to_numpy(False) for c in ("upper", "lower"))
                cluster, upper, lower, compared = _assigned(vectors, cluster, upper, lower, moved)
            else:
                cluster, upper, lower = _scan(vectors, moved.centers)
                compared = n
            order = np.argsort(cluster, kind="stable")
            found, starts = np.unique(cluster[order], return_index=True)
            sums[found] += np.add.reduceat(vectors[order], starts)
            rows += np.bincount(cluster, minlength=clusters)
            radius[found] = np.maximum(radius[found], np.maximum.reduceat(upper[order], starts))
            scanned += compared
            keys = batch.column("key")
            shape = shape or _shape(keys.type)
            empty = [pa.nulls(n, f.type) for f in list(shape)[5:]]
            vec = pa.array([row.tobytes() for row in vectors.astype("<i4")], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [keys, vec, pa.array(cluster.astype(np.int32)), pa.array(upper), pa.array(lower), *empty],
                schema=shape,
            )
        if shape is not None:
            full = np.flatnonzero(rows)
            yield pa.RecordBatch.from_arrays([
                pa.nulls(len(full), shape.field("key").type), pa.nulls(len(full), pa.binary()),
                pa.array(full.astype(np.int32)), pa.array(radius[full] * (1 + ROOM)),
                pa.nulls(len(full), pa.float64()), pa.array(list(sums[full]), pa.list_(pa.int64())),
                pa.array(rows[full]), pa.array([scanned] + [0] * (len(full) - 1), pa.int64()),
            ], schema=shape)

    return state.mapInArrow(assign, _state_type(key))


def _shape(key: pa.DataType) -> pa.Schema:
    return pa.schema([
        ("key", key), ("vec", pa.binary()), ("cluster", pa.int32()), ("upper", pa.float64()),
        ("lower", pa.float64()), ("sums", pa.list_(pa.int64())), ("rows", pa.int64()),
        ("scanned", pa.int64()),
    ])


def _whole(column: pa.Array, dims: int) -> np.ndarray:
    """A batch of vectors, as packed 32-bit numbers or as lists, in rows of 64-bit numbers."""
    if pa.types.is_list(column.type) or pa.types.is_large_list(column.type):
        return column.flatten().to_numpy(False).reshape(-1, dims).astype(np.int64)
    packed = b"".join(column.to_pylist())
    return np.frombuffer(packed, "<i4").reshape(-1, dims).astype(np.int64)


def _summed(state: DataFrame, clusters: int, dims: int) -> tuple[np.ndarray, ...]:
    """Exact sums, rows and radius of every cluster, and all full comparisons."""
    parts = state.filter(F.col("sums").isNotNull())
    sums, rows = np.zeros((clusters, dims), np.int64), np.zeros(clusters, np.int64)
    radius, scanned = np.zeros(clusters), 0
    whole = parts.groupBy("cluster").agg(
        F.sum("rows").alias("rows"), F.max("upper").alias("radius"), F.sum("scanned").alias("scanned")
    )
    for row in whole.collect():
        rows[row.cluster], radius[row.cluster] = row["rows"], row.radius
        scanned += row.scanned
    spread = parts.select("cluster", F.posexplode("sums").alias("at", "x"))
    for row in spread.groupBy("cluster", "at").agg(F.sum("x").alias("x")).collect():
        sums[row.cluster, row["at"]] = row.x
    return sums, rows, radius, scanned


class Clustering(NamedTuple):
    """``vectors(key, cluster, distance)``, final centroids, and full comparisons of every round."""

    vectors: DataFrame
    centers: np.ndarray
    scanned: list[int]


def cluster_vectors(
    df: DataFrame, clusters: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024,
    seed: int = 3, key: str = "vec_id", vector: str = "embedding",
) -> Clustering:
    """Assign every vector to its nearest centroid after ``rounds`` rounds. Distances are squared."""
    kept = whole_vectors(df, dims, scale, key, vector)
    kind = kept.schema["key"].dataType
    centers = first_centers(kept, clusters, seed)
    if not len(centers):
        none = T.StructType([
            T.StructField("key", kind), T.StructField("cluster", T.IntegerType()),
            T.StructField("distance", T.LongType()),
        ])
        return Clustering(df.sparkSession.createDataFrame([], none), centers, [])
    still = np.zeros(len(centers))
    state = cut_lineage(_round(kept, kind, Moved(centers, still, still)))
    compared = []
    for _ in range(rounds):
        sums, rows, radius, scanned = _summed(state, len(centers), dims)
        compared.append(scanned)
        moved = np.where(rows[:, None] > 0, sums // np.maximum(rows, 1)[:, None], centers)
        if (moved == centers).all():
            break
        drift = np.sqrt(((moved - centers).astype(float) ** 2).sum(1)) * (1 + ROOM)
        step = Moved(moved, drift, loosening(centers, moved, radius))
        vectors = state.filter(F.col("sums").isNull()).select("key", "vec", "cluster", "upper", "lower")
        state, old = cut_lineage(_round(vectors, kind, step)), state
        forget(old)
        centers = moved
    return Clustering(_distances(state, centers), centers, compared)


def _distances(state: DataFrame, centers: np.ndarray) -> DataFrame:
    @F.pandas_udf("long")
    def distance(vec, cluster):
        own = centers[cluster.to_numpy()]
        packed = np.frombuffer(b"".join(vec), "<i4").reshape(-1, centers.shape[1])
        return type(cluster)(((packed.astype(np.int64) - own) ** 2).sum(1))

    return state.filter(F.col("sums").isNull()).select(
        "key", "cluster", distance("vec", "cluster").alias("distance")
    )


def center_digest(center: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, center.tolist())).encode()).hexdigest()


def with_inertia(found: Clustering) -> DataFrame:
    """``vectors`` with ``cluster_inertia``, ``inertia`` and ``centroid_sha256``; at most one row a
    cluster passes through the driver."""
    spark = found.vectors.sparkSession
    vectors = cut_lineage(found.vectors)
    sums = vectors.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("all"))
    parts = {row.cluster: int(row["all"]) for row in sums.collect()}
    whole = sum(parts.values())
    rows = [
        (c, _fits(n), _fits(whole), center_digest(found.centers[c])) for c, n in sorted(parts.items())
    ]
    shape = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    return vectors.join(F.broadcast(spark.createDataFrame(rows, shape)), "cluster")


def _fits(n: int) -> int | None:
    return n if n < 1 << 63 else None
