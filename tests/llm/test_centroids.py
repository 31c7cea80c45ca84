import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from urnalake.llm import centroids


def brute(rows, k, rounds, dim, scale, seed):
    kept = []
    for key, v in rows:
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v):
            kept.append((key, [math.floor(scale * x) for x in v]))

    def order(row):
        digest = hashlib.sha256(f"{seed}:{row[0]}".encode()).hexdigest() if row[0] is not None else "~"
        return digest, row[0] or 0, row[1]

    middles = [v for _, v in sorted(kept, key=order)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), c) for c, m in enumerate(middles))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for c, members in groups.items():
            middles[c] = [sum(column) // len(members) for column in zip(*members, strict=True)]
    out = [(key, nearest(v)[1], nearest(v)[0]) for key, v in kept]
    return sorted(out, key=str), middles


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    df = df.withColumn("id", F.lit("x")).withColumn("v", F.lit(1)).withColumn("cluster", F.lit(7))
    out, middles = centroids.clustered(df, **options)
    return sorted(map(tuple, out.select("vec_id", "cluster", "distance").collect()), key=str), middles.tolist()


@pytest.mark.parametrize(("seed", "dim", "k", "scale", "spread"), [(1, 4, 7, 256, 2.0), (2, 2, 12, 1, 4.0), (3, 64, 5, 256, 1.0)])
def test_equals_brute_force(spark, seed, dim, k, scale, spread):
    rng = random.Random(seed)
    rows = [(i, [float(np.float32(rng.uniform(-spread, spread))) for _ in range(dim)]) for i in range(200)]
    rows += [rows[3]] * 40 + [(900 + i, rows[5][1]) for i in range(40)]
    options = {"k": k, "rounds": 4, "dimensions": dim, "scale": scale, "seed": 2}
    assert run(spark, rows, **options) == brute(rows, k, 4, dim, scale, 2)


def test_odd_rows(spark):
    rows = [(1, [0.5, 1.0]), (1, [0.5, 1.0]), (2, None), (3, [1.0]), (4, [None, 1.0]), (5, [float("nan"), 1.0]),
            (6, [float("inf"), 0.0]), (None, [3.0, 3.0]), (7, []), (8, [-0.001, 0.0])]
    options = {"k": 3, "rounds": 2, "dimensions": 2, "scale": 256, "seed": 2}
    assert run(spark, rows, **options) == brute(rows, 3, 2, 2, 256, 2)
    assert run(spark, rows[2:3], **options) == ([], [])
    empty, middles = centroids.clustered(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert centroids.with_inertia(empty, middles).collect() == []


def test_ties_and_more_centroids_than_vectors(spark):
    rows = [(i, [0.0, 0.0]) for i in range(5)] + [(9, [2.0, 0.0]), (10, [1.0, 0.0])]
    options = {"k": 40, "rounds": 3, "dimensions": 2, "scale": 1, "seed": 2}
    got = run(spark, rows, **options)
    assert got == brute(rows, 40, 3, 2, 1, 2)
    assert len(got[1]) == 7


def test_zero_favours_the_smaller_number():
    middles = np.array([[0, 0], [4, 0], [0, 4], [4, 4]])
    planes = centroids.bisectors(middles)
    assert centroids.winners(np.array([[2, 0], [2, 2], [3, 2], [0, 2]]), *planes).tolist() == [0, 0, 1, 0]


def test_largest_components_are_exact():
    rng = random.Random(3)
    most = centroids.MOST
    middles = np.array([[rng.choice([most, -most, most - 1]) for _ in range(64)] for _ in range(6)])
    vectors = np.array([[rng.choice([most, -most, 1 - most]) for _ in range(64)] for _ in range(50)])
    got = centroids.winners(vectors, *centroids.bisectors(middles))
    for v, c in zip(vectors.tolist(), got.tolist(), strict=True):
        assert c == min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), i) for i, m in enumerate(middles.tolist()))[1]


def test_components_that_are_too_large_raise(spark):
    with pytest.raises(PySparkException):
        run(spark, [(1, [1e9, 0.0])], k=1, rounds=1, dimensions=2, scale=256, seed=2)
