import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from urnalake.llm import trie


def brute(rows):
    talks = {}
    for key, turn, role, text in rows:
        if key is not None:
            talks.setdefault(key, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {}
    for key, turns in talks.items():
        digest = {t: hashlib.md5(f"{len(t[2])}:{t[2]}{t[3]}".encode()).hexdigest() for t in turns}
        own[key] = [t[2:] for t in sorted(turns, key=lambda t: (t[:2], digest[t]))]
    whole = {}
    for key, turns in own.items():
        h = zlib.crc32(str(key).encode()) % 9
        block = key - (abs(key) % 5) * (1 if key >= 0 else -1)
        whole[key] = tuple(own.get(block, [])[:h] + turns[h:])
    members = {}
    for key, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(key)
    leaves = {p for p in members if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in members)}
    out = []
    for p, keys in members.items():
        below = [q for q in members if q[: len(p)] == p]
        ends = ",".join(map(str, sorted(k for k in keys if whole[k] == p)))
        out.append((
            min(keys), len(p), min(members[p[:-1]]) if p else None, len(keys), sum(len(q) == len(p) + 1 for q in below),
            sum(q in leaves for q in below), sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumn("path", F.lit("x")).withColumn("block", F.lit(1)).withColumn("n", F.lit(2))
    out = trie.trie(trie.borrowed(trie.sequences(df)), **options)
    return sorted(map(tuple, out.collect()), key=str)


def invented(seed, count, words):
    rng = random.Random(seed)
    rows = []
    for key in range(count):
        if rng.random() < 0.3:
            talk = ["same start", "same", "end é"]
        else:
            talk = ["same start"] * (rng.random() < 0.5) + [rng.choice(words) for _ in range(rng.randint(0, 12))]
        rows += [(key, t, "user" if t % 2 else "assistant", text) for t, text in enumerate(talk)]
    return rows


@pytest.mark.parametrize(("seed", "count", "range_turns"), [(1, 60, 20), (2, 90, 5), (3, 40, 10_000), (4, 70, 1)])
def test_equals_brute_force(spark, seed, count, range_turns):
    rows = invented(seed, count, ["a", "b", "ünï", "a longer text", ""])
    assert run(spark, rows, range_turns=range_turns) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (5, None, "user", "null turn first"), (5, 0, None, None), (5, 0, "user", "tie"), (5, 0, "user", "tie"), (None, 1, "user", "lost"),
        (7, 1, "user", "x" * 100_000), (-3, 0, "user", "negative"), (-5, 0, "user", "block"), (10, 0, "", ""), (11, 0, None, ""),
        (2**62, 0, "user", "large"), (8, 0, "us", "er"), (9, 0, "use", "r"),
    ]
    for turns in (1, 1000):
        assert run(spark, rows, range_turns=turns) == brute(rows)
    assert run(spark, rows[:0]) == run(spark, [(None, 1, "user", "x")]) == []


def test_long_paths_across_ranges(spark):
    """Two long conversations that differ in their last turns only, each a range of its own."""
    rows = [(key, t, "user", f"turn {t}" if t < 300 else f"{key} {t}") for key in (5, 10, 15) for t in range(303)]
    assert run(spark, rows, range_turns=1) == brute(rows)


def test_classes_are_passed_on_in_parts(spark, monkeypatch):
    rows = invented(5, 80, ["a", "b"])
    monkeypatch.setattr(trie, "HELD_BYTES", 1)
    batches = [trie._record([list(range(80))], ["conv_id"]).append_column("path", trie.pa.array(["p", "q"] * 40))]
    parts = list(trie._gathered(batches))
    assert len(parts) == 80
    monkeypatch.undo()
    assert run(spark, rows, range_turns=30) == brute(rows)


def test_siblings_are_balanced():
    tree = trie.TernaryTree()
    for i in trie.middle_first(1023):
        tree.insert([i])

    def height(node):
        return 1 + max(height(tree.low[node]), height(tree.high[node])) if node else 0

    assert height(tree.inside[0]) == 10
    assert sorted(trie.middle_first(10)) == list(range(10))
