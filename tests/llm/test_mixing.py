import numpy as np
import pytest
from pyspark.sql import functions as F

from urnalake.llm import mixing


def raked(cells, targets, rounds=500):
    """cells: {(a, b, c): tokens}; targets: a {value: share} for each place."""
    keys = [k for k, n in cells.items()]
    w = np.array([cells[k] for k in keys], float)
    shares = []
    for place, target in enumerate(targets):
        present = {k[place] for k in keys if cells[k] > 0}
        total = sum(s for v, s in target.items() if v in present)
        shares.append({v: s / total for v, s in target.items() if v in present})
    for _ in range(rounds):
        for place in range(len(targets)):
            sums = {}
            for k, x in zip(keys, w, strict=True):
                sums[k[place]] = sums.get(k[place], 0.0) + x
            w = np.array([x * shares[place].get(k[place], 0.0) / sums[k[place]] if x else 0.0 for k, x in zip(keys, w, strict=True)])
    return dict(zip(keys, w, strict=True))


def test_rake_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    cells = {(f"s{i}", f"l{j}", f"t{k}"): int(rng.integers(0, 5000)) for i in range(5) for j in range(3) for k in range(2)}
    targets = [{f"s{i}": i + 1.0 for i in range(7)}, {"l0": 5.0, "l1": 3.0, "l2": 2.0}, {"t0": 1.0, "t1": 1.0}]
    df = spark.createDataFrame([(*k, n) for k, n in cells.items()], "source string, lang string, topic string, tokens long")
    given = {n: spark.createDataFrame(list(t.items()), "value string, share double") for n, t in zip(mixing.MARGINS, targets, strict=True)}
    got = {(r["source"], r["lang"], r["topic"]): r["weight"] for r in mixing.rake(df, given)[0].collect()}
    expected = raked(cells, targets)
    assert got.keys() == expected.keys()
    assert all(got[k] == pytest.approx(expected[k], rel=1e-3, abs=1e-9) for k in got)


def test_targets_that_contradict_each_other_are_reported(spark):
    rows = [("a", "x", "p", 10), ("b", "y", "p", 10)]
    df = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    targets = {"source": [("a", 0.5), ("b", 0.5)], "lang": [("x", 0.9), ("y", 0.1)], "topic": [("p", 1.0)]}
    given = {n: spark.createDataFrame(t, "value string, share double") for n, t in targets.items()}
    with pytest.warns(UserWarning, match="not converged"):
        weights, off = mixing.rake(df, given)
    assert {r["source"]: round(r["weight"], 6) for r in weights.collect()} == {"a": 0.9, "b": 0.1}
    assert off == pytest.approx(0.8)


def test_given_topics(spark):
    df = spark.createDataFrame([(1, "a b", "s", "en", "law"), (2, "c", "s", "en", None)], "doc_id long, text string, source string, lang string, about string")
    got = mixing.mixed(df, topic="about").collect()
    assert {r["doc_id"]: r["topic"] for r in got} == {1: "law", 2: None}
    assert all(r["deviation"] <= mixing.TOLERANCE for r in got)


def test_query_meets_its_targets(spark):
    rows = mixing.op8_mixing(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 1000
    assert max(r["probability"] for r in rows) == 1.0
    total = sum(r["n_tokens"] * r["probability"] for r in rows)
    for name, power in mixing.TEMPERS.items():
        present, expected = {}, {}
        for r in rows:
            present[r[name]] = present.get(r[name], 0) + r["n_tokens"]
            expected[r[name]] = expected.get(r[name], 0.0) + r["n_tokens"] * r["probability"] / total
        whole = sum(n**power for n in present.values())
        for value, n in present.items():
            assert expected[value] == pytest.approx(n**power / whole, rel=1e-3)


def test_draws_follow_the_probabilities(spark):
    rows = mixing.op8_mixing(spark, "/root/testdata/sf0.01").collect()
    mean = sum(r["probability"] for r in rows)
    spread = sum(r["probability"] * (1 - r["probability"]) for r in rows) ** 0.5
    assert abs(sum(r["kept"] for r in rows) - mean) < 4 * spread
    assert all(r["kept"] for r in rows if r["probability"] == 1.0)


def test_odd_rows(spark):
    rows = [(1, "a b c", None, "en"), (1, "a b c", None, "en"), (2, None, "s", None), (3, "", "s", "en"), (None, "x y", "=", "null"), (4, "word " * 100_000, "s", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").withColumn("kept", F.lit("theirs")).withColumn("tokens", F.lit(9))
    got = mixing.mixed(df).collect()
    assert len(got) == 6
    assert sorted(r["n_tokens"] for r in got) == [0, 0, 2, 3, 3, 100_000]
    assert all(r["kept"] and r["probability"] == 1.0 for r in got if r["n_tokens"] == 0)
    assert len({r["kept"] for r in got if r["doc_id"] == 1}) == 1
    assert mixing.mixed(df.limit(0)).collect() == []


def test_value_without_target_is_left_out(spark):
    df = spark.createDataFrame([(1, "a b", "x", "en"), (2, "a b", "y", "en")], "doc_id long, text string, source string, lang string")
    one = spark.createDataFrame([("=x", 1.0)], "value string, share double")
    rest = {n: spark.createDataFrame([(v, 1.0)], "value string, share double") for n, v in (("lang", "=en"), ("topic", "=prose"))}
    got = {r["doc_id"]: (r["probability"], r["kept"]) for r in mixing.mixed(df, {"source": one, **rest}).collect()}
    assert got == {1: (1.0, True), 2: (0.0, False)}
