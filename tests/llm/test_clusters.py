import hashlib

import numpy as np
from pyspark.sql import functions as F

from webglean.llm import clusters, queries
from checks.compare import connect, rows_of

SF_DIR = "/root/testdata/sf0.001"


def plain(ids, vectors, k, rounds, seed):
    """Every round compares everything, in whole numbers."""
    order = sorted(range(len(ids)), key=lambda i: hashlib.sha256(f"{seed}:{ids[i]}".encode()).hexdigest())
    centers = [vectors[i] for i in order[:k]]

    def nearest():
        out = []
        for v in vectors:
            squares = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centers]
            out.append((squares.index(min(squares)), min(squares)))
        return out

    for _ in range(rounds):
        found = nearest()
        for c in range(len(centers)):
            own = [v for v, f in zip(vectors, found) if f[0] == c]
            if own:
                centers[c] = [sum(x) // len(own) for x in zip(*own)]
    return nearest(), centers


def table_of(spark, ids, vectors):
    return spark.createDataFrame(
        [(i, [x / 1024 for x in v]) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>"
    ).repartition(3)


def test_equals_plain_rounds_and_compares_less(spark):
    rng = np.random.default_rng(7)
    middles = rng.integers(-3000, 3000, (9, 5))
    vectors = (middles[rng.integers(0, 9, 700)] + rng.integers(-500, 500, (700, 5))).tolist()
    vectors += [vectors[0]] * 40 + [[0] * 5] * 3
    ids = list(range(len(vectors)))
    want, centers = plain(ids, vectors, 6, 7, 3)
    found = clusters.cluster_vectors(table_of(spark, ids, vectors), clusters=6, rounds=7, dims=5)
    got = {r.key: (r.cluster, r.distance) for r in found.vectors.collect()}
    assert got == dict(enumerate(want))
    assert found.centers.tolist() == centers
    assert found.scanned[0] == len(ids) and max(found.scanned[2:]) < len(ids) / 2


def test_ties_go_to_the_smaller_number(spark):
    vectors = [[0, 0], [10, 0], [5, 0], [5, 3], [0, 0], [10, 0]]
    for rounds in (0, 1, 5):
        want, _ = plain(range(6), vectors, 3, rounds, 3)
        found = clusters.cluster_vectors(table_of(spark, range(6), vectors), clusters=3, rounds=rounds, dims=2)
        assert {r.key: (r.cluster, r.distance) for r in found.vectors.collect()} == dict(enumerate(want))


def test_loosening_holds_and_is_less_than_drift():
    rng = np.random.default_rng(11)
    less = 0
    for _ in range(200):
        k, dims = 5, 4
        old = rng.normal(0, 10, (k, dims)).round().astype(np.int64)
        new = (old + rng.normal(0, 3, (k, dims))).round().astype(np.int64)
        radius = rng.uniform(0, 8, k)
        drift = np.sqrt(((new - old) ** 2).sum(1))
        loosen = clusters.loosening(old, new, radius)
        for i in range(k):
            others = [j for j in range(k) if j != i]
            away = rng.normal(0, 1, (400, dims))
            away *= radius[i] * rng.uniform(0, 1, (400, 1)) ** 0.2 / np.linalg.norm(away, axis=1, keepdims=True)
            points = old[i] + away
            nearer = max(
                (np.linalg.norm(points - old[j], axis=1) - np.linalg.norm(points - new[j], axis=1)).max()
                for j in others
            )
            assert nearer <= loosen[i] + 1e-9 <= drift[others].max() * (1 + 1e-8) + 1e-9
            less += loosen[i] < 0.9 * drift[others].max()
    assert less > 100


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, -0.0005]), (1, [0.5, -0.0005]), (None, [0.25, 1.0]), (2, None), (3, []), (4, [1.0, 2.0, 3.0]),
        (5, [None, 1.0]), (6, [nan, 1.0]), (7, [1.0, -inf]), (8, [1e30, -1e30]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("key", F.lit(1))
    found = clusters.cluster_vectors(df, clusters=8, rounds=3, dims=2)
    got = clusters.with_inertia(found).collect()
    assert sorted((r.key is None, r.key) for r in got) == [(False, 1), (False, 1), (False, 8), (True, None)]
    assert len(found.centers) == 4
    one = clusters.cluster_vectors(df.filter("vec_id = 1"), clusters=1, rounds=2, dims=2)
    assert [(r.cluster, r.distance) for r in one.vectors.collect()] == [(0, 0)] * 2
    assert one.centers.tolist() == [[512, -1]]
    none = clusters.cluster_vectors(df.filter("vec_id = 2"), dims=2)
    assert clusters.with_inertia(none).collect() == []


def test_query_equals_its_sql(spark):
    df = queries.op12_geometric_drift(spark, SF_DIR)
    answer = connect(SF_DIR).execute(queries.SQL["op12_geometric_drift"])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(
        [d[0] for d in answer.description], answer.fetchall()
    )
