import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from urnalake.llm import topk


def brute(candidates, queries, k):
    candidates = sorted((i, tuple(v)) for i, v in candidates if i is not None and v is not None and None not in v)
    queries = {(i, tuple(v)) for i, v in queries if i is not None and v is not None and None not in v}
    out = []
    for q, v in queries:
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in candidates if i != q and len(w) == len(v))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def found(spark, candidates, queries, k):
    a, b = (spark.createDataFrame(x, "vec_id long, embedding array<long>").withColumn("id", F.lit(0)).withColumn("v", F.lit("x")) for x in (candidates, queries))
    return sorted(map(tuple, topk.nearest(a, b, k).collect()))


@pytest.mark.parametrize(("seed", "dim", "spread", "k"), [(1, 8, 50, 5), (2, 3, 2, 7), (3, 16, 1000, 1)])
def test_equals_brute_force(spark, seed, dim, spread, k):
    rng = random.Random(seed)
    rows = [(i, [rng.randint(-spread, spread) for _ in range(dim)]) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]
    queries = rows[::11] + [(5000, [0] * dim)]
    assert found(spark, rows, queries, k) == brute(rows, queries, k)


def test_odd_rows(spark):
    rows = [(1, [1, 2]), (1, [1, 2]), (2, None), (3, [1, None]), (None, [5, 5]), (4, [3, 4]), (5, [1, 2, 3]), (6, [])]
    assert found(spark, rows, rows, 5) == brute(rows, rows, 5)
    assert found(spark, rows, [], 5) == found(spark, [], rows, 5) == []


def test_scores_that_do_not_fit_raise(spark):
    rows = [(50, [3 * 10**9, 10**9]), (51, [3 * 10**9, 2 * 10**9])]
    with pytest.raises(PySparkException, match="64 bits"):
        found(spark, rows, rows, 5)
    with pytest.raises(PySparkException, match="64 bits"):
        spark.createDataFrame([([1e17],)], "e array<double>").select(topk.whole_components(F.col("e"))).collect()


def test_whole_components(spark):
    rows = [([0.5, -0.001],), ([float("nan"), 1.0],), ([float("inf")],), ([None, 1.0],), (None,), ([],)]
    df = spark.createDataFrame(rows, "e array<float>")
    assert [r[0] for r in df.select(topk.whole_components(F.col("e"))).collect()] == [[128, -1], None, None, None, None, []]


def test_candidates_are_eliminated(monkeypatch):
    """Clustered vectors: the bound leaves most candidates unseen, and the result is exact."""
    rng = np.random.default_rng(1)
    centres = rng.integers(-2000, 2000, (20, 8))
    vectors = np.concatenate([c + rng.integers(-20, 20, (500, 8)) for c in centres])
    ids = np.arange(len(vectors))
    pivots = vectors[rng.integers(0, len(vectors), 32)].astype(float)
    looked = []
    lexsort = np.lexsort
    monkeypatch.setattr(topk.np, "lexsort", lambda keys: looked.append(len(keys[0])) or lexsort(keys))
    rows = list(topk.search_block(vectors[:1], [0], vectors, ids, pivots, 3))
    monkeypatch.undo()
    scores = vectors @ vectors[0]
    best = sorted((-int(scores[i]), i) for i in ids if i != 0)[:3]
    assert rows == [(0, i, -s) for s, i in best]
    assert sum(looked) < len(vectors) / 2
