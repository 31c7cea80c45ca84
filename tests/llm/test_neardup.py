import random

import numpy as np
import pytest
from brute import invented, near_duplicates
from pyspark.sql import functions as F

from urnalake.llm import neardup
from urnalake.llm.graph import components


def found(spark, docs, parts=4):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(df).collect()}


@pytest.mark.parametrize(("seed", "length"), [(1, 300), (2, 25), (3, 110)])
def test_equals_brute_force(spark, seed, length):
    docs = list(enumerate(invented(seed, 150, length)))
    assert found(spark, docs) == near_duplicates(docs)


def test_links_at_the_threshold(spark):
    """Sets of 4k shingles of which 3k are shared by 4k together, for small and large k."""
    docs, rng = [], random.Random(4)
    for number, k in enumerate((1, 2, 5, 15, 16, 21, 22, 30, 80)):
        shared = [f"s{number}x{i}" for i in range(3 * k + 4)]
        docs.append((10 * number, " ".join(shared)))
        docs.append((10 * number + 1, " ".join([*shared, *(f"t{number}x{i}" for i in range(k))])))
        docs.append((10 * number + 2, " ".join([*shared, *(f"u{rng.random()}" for _ in range(k + 1))])))
    assert found(spark, docs) == near_duplicates(docs)


def test_chain_and_copies(spark):
    """Each text is near the next one only; copies join their text's component."""
    base = [f"w{i}" for i in range(200)]
    docs = []
    for i in range(12):
        docs.append((i, " ".join(base[8 * i :] + [f"n{j}" for j in range(8 * i)])))
    docs += [(100 + i, docs[5][1].upper()) for i in range(30)]
    docs += [(200, "Other text"), (201, "other TEXT"), (202, "othér text")]
    assert found(spark, docs) == near_duplicates(docs)


def test_large_group_of_near_copies(spark):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(400):
        own = list(base)
        own[rng.randrange(120)] = f"v{i}"
        docs.append((i, " ".join(own)))
    got = found(spark, docs)
    assert {v[1] for v in got.values()} == {0}


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "one two"), (5, "one two"), (5, "one two"), (None, "one two"), (6, "one two")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit(1)).withColumn("n", F.lit("x"))
    got = sorted(map(tuple, neardup.near_duplicates(df).collect()), key=str)
    assert got == sorted(
        [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (5, 1, 4, False),
         (None, 1, None, True), (6, 1, 6, True)], key=str,
    )
    assert neardup.near_duplicates(df.limit(0)).collect() == []


def test_estimate_is_near_the_similarity():
    rng = np.random.default_rng(2)
    for share in (0.3, 0.6, 0.9):
        estimates = []
        for _ in range(60):
            values = np.unique(rng.integers(0, 2**64, 3000, dtype=np.uint64))
            n = int(len(values) * (1 - share) / 2)
            mixed = rng.permutation(values)
            a, b = np.sort(mixed[n:]), np.sort(np.delete(mixed, np.s_[n : 2 * n]))
            estimates.append(neardup.estimated_similarity(neardup.registers_of(a), neardup.registers_of(b)))
        assert abs(np.mean(estimates) - share) < 0.04


def test_registers_are_minima():
    rng = np.random.default_rng(3)
    values = np.sort(rng.integers(0, 2**64, 5000, dtype=np.uint64))
    whole, part = neardup.registers_of(values), neardup.registers_of(values[::2])
    assert (whole >= part).all() and (part > 0).all()


@pytest.mark.parametrize("n", [1, 3, 20, 300])
def test_empty_buckets_are_filled(n):
    values = np.sort(np.random.default_rng(n).integers(0, 2**64, n, dtype=np.uint64))
    registers = neardup.registers_of(values)
    assert (registers > 0).all() and len(np.unique(registers)) <= n


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)]
    edges += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(None, 3), (7, 7)]
    rng.shuffle(edges)
    names = {x: x for e in edges for x in e if None not in e and e[0] != e[1]}
    for _ in names:
        for a, b in edges:
            if a in names and b in names:
                names[a] = names[b] = min(names[a], names[b])
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["component"] for r in got.collect()} == names


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
