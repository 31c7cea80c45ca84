"""Substring dedup: windows repeated at one length alone are extended to twice that length.

The seed level has windows of a quarter of the final length. Of the seeds inside a final window
the one with the smallest hash stands for it, so equal final windows have equal seeds and a few
per cent of all seeds need to be compared. Neighbouring final windows with the same seed form a
run. A run whose seed occurs once is dropped; runs equal as a whole are settled at once; what is
left is extended to windows of twice the seed, and where these repeat to the final length, which
decides.

Skew: a task sends the first of its equal runs (or windows) only, the others are known to be
repeats already. A seed that has very many different runs within one task is not gathered: these
runs go to the next level directly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from urnalake.checks.registry import check
from urnalake.llm.common import ship, table
from urnalake.llm.words import BASE, OTHER_BASE, extend, mix, sliding, window_hashes, word_hashes, words_of

WINDOW = 20
#: Words that a task hashes at a time; longer texts are taken in overlapping pieces.
PIECE_WORDS = 400_000
#: Different runs of a seed within one piece of work, beyond which the seed counts as hot.
HOT_RUNS = 64
#: A piece of work has fewer than 2**PLACE_BITS words.
PLACE_BITS = 20

_OPEN, _REPEAT, _EXTEND = 0, 1, 2
_RUNS = "k1 long, k2 long, id long, tag int, start int, n int, kind int"
_FIELDS = [("k1", pa.int64()), ("k2", pa.int64()), ("id", pa.int64()), ("tag", pa.int32()),
           ("start", pa.int32()), ("n", pa.int32()), ("kind", pa.int32())]


def _pieces(ids, tags, texts, size: int) -> Iterator[tuple[np.ndarray, list]]:
    """Word hashes of some texts at a time and whose they are: (id, tag, offset, words)."""
    hashes, owners, held = [], [], 0
    for i, text in enumerate(texts):
        h = word_hashes(words_of(text))
        if len(h) < size:
            continue
        for offset in range(0, len(h) - size + 1, PIECE_WORDS):
            part = h[offset : offset + PIECE_WORDS + size - 1]
            hashes.append(part)
            owners.append((ids[i], tags[i], offset, len(part)))
            held += len(part)
            if held >= PIECE_WORDS:
                yield np.concatenate(hashes), owners
                hashes, owners, held = [], [], 0
    if hashes:
        yield np.concatenate(hashes), owners


def _spread(owners) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per word: the piece it is in, its text's id and tag, its position in the text."""
    ids, tags, offsets, lengths = (np.array(x, np.int64) for x in zip(*owners, strict=True))
    piece = np.repeat(np.arange(len(lengths)), lengths)
    begins = np.cumsum(lengths) - lengths
    return piece, ids[piece], tags[piece], np.arange(len(piece)) - begins[piece] + offsets[piece]


def _first_of_equal(keys: list[np.ndarray], ids, starts) -> tuple[np.ndarray, np.ndarray]:
    """(order, leader): rows sorted by keys and place; for each sorted row its group's first row."""
    order = np.lexsort((starts, ids, *keys[::-1]))
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    firsts = np.flatnonzero(new)
    return order, order[firsts][np.cumsum(new) - 1]


def _runs_of(hashes: np.ndarray, owners, size: int, seed: int) -> dict[str, np.ndarray]:
    piece, ids, tags, at = _spread(owners)
    seeds = mix(window_hashes(hashes, seed))
    chosen = _marked_minima(seeds, size - seed + 1)
    valid = piece[: len(chosen)] == piece[size - 1 :][: len(chosen)]
    new = valid.copy()
    new[1:] &= (chosen[1:] != chosen[:-1]) | ~valid[:-1]
    begin = np.flatnonzero(new)
    number = np.cumsum(new)[valid] - 1
    n = np.bincount(number, minlength=len(begin))
    # The hash of all words of a run, from prefix sums of words times powers of an odd base.
    powers = np.cumprod(np.full(len(hashes), OTHER_BASE))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes) * powers)])
    inverse = np.uint64(pow(int(OTHER_BASE), -1, 1 << 64))
    inverses = np.cumprod(np.full(len(hashes), inverse))
    length = n + size - 1
    content = mix((sums[begin + length] - sums[begin]) * inverses[begin] + length.astype(np.uint64))
    return {
        "k1": seeds[chosen[begin]], "k2": content, "id": ids[begin], "tag": tags[begin],
        "start": at[begin], "n": n,
    }


def _settle_locally(runs: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Adds ``kind``: repeats of a run that this task has seen earlier, runs of hot seeds."""
    order, leader = _first_of_equal([runs["k1"], runs["k2"]], runs["id"], runs["start"])
    runs = {name: values[order] for name, values in runs.items()}
    position = np.empty(len(order), np.int64)
    position[order] = np.arange(len(order))
    leader = position[leader]
    later = (runs["id"] != runs["id"][leader]) | (runs["start"] != runs["start"][leader])
    kind = np.where(later, _REPEAT, _OPEN)
    open_rows = np.flatnonzero(kind == _OPEN)
    k1 = runs["k1"][open_rows]
    new = np.ones(len(k1), bool)
    new[1:] = k1[1:] != k1[:-1]
    group_start = np.flatnonzero(new)[np.cumsum(new) - 1] if len(k1) else np.zeros(0, np.int64)
    kind[open_rows[np.arange(len(k1)) - group_start >= HOT_RUNS]] = _EXTEND
    settled = kind != _OPEN
    runs["k1"] = np.where(settled, _own_key(runs), runs["k1"])
    return runs | {"kind": kind}


def _batch(columns: dict[str, np.ndarray], fields) -> pa.RecordBatch:
    arrays = [
        pa.array(columns[name].view(np.int64) if columns[name].dtype == np.uint64 else columns[name].astype(kind.to_pandas_dtype()), kind)
        for name, kind in fields
    ]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def _seed_runs(docs: DataFrame, size: int, seed: int) -> DataFrame:
    fields = _FIELDS

    def run(batches):
        for batch in batches:
            ids, tags = batch.column("id").to_pylist(), batch.column("tag").to_pylist()
            texts = (x.as_py() for x in batch.column("text"))
            for hashes, owners in _pieces(ids, tags, texts, size):
                yield _batch(_settle_locally(_runs_of(hashes, owners, size, seed)), fields)

    return docs.select("id", "tag", "text").mapInArrow(run, _RUNS)


def _judge_runs(runs: DataFrame) -> DataFrame:
    """Runs that are repeats, and those whose seed has another run: these are extended."""
    seed = Window.partitionBy("k1")
    equal = Window.partitionBy("k1", "k2")
    place = F.struct("id", "start")
    kind = (
        F.when(F.col("kind") != _OPEN, F.col("kind"))
        .when(place > F.col("first"), F.lit(_REPEAT))
        .when(F.col("several"), F.lit(_EXTEND))
    )
    return (
        runs.withColumn("several", F.min("k2").over(seed) != F.max("k2").over(seed))
        .withColumn("first", F.min(place).over(equal))
        .select("id", "tag", "start", "n", kind.alias("kind"))
        .where("kind IS NOT NULL")
    )


def _levels(size: int, seed: int) -> list[int]:
    """Seed length doubled up to half the final length, then the final length itself."""
    lengths = []
    while seed * 4 <= size:
        seed *= 2
        lengths.append(seed)
    return [*lengths, size]


def _pair_hashes(h: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits per window of ``length`` words; doubled windows are made of two halves."""
    out = []
    for base in (BASE, OTHER_BASE):
        level, reach = window_hashes(h, seed, base), seed
        while reach * 2 <= length:
            level, reach = extend(level, level, reach, base), reach * 2
        out.append(mix(level if reach == length else window_hashes(h, length, base)))
    return out[0], out[1]


def _extended(docs: DataFrame, size: int, seed: int, length: int) -> DataFrame:
    """The runs that survived so far, keyed by windows of ``length`` words, and the repeats.

    ``docs`` has each text's judged runs in ``runs``. Below the final length the window around
    the seed is taken, so a run gives one or two rows; at the final length each window is a row.
    """
    fields = _FIELDS
    names = [name for name, _ in fields]

    def rows_of(text: str, i: int, t: int, start, n, kind) -> dict[str, np.ndarray]:
        repeats = kind == _REPEAT
        first, end = _merged(start[repeats], start[repeats] + n[repeats] + size - 1)
        start, n = start[~repeats], n[~repeats]
        at = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
        at, count, one, two = _keys(text, at) if len(at) else (at, at, at.view(np.uint64), at.view(np.uint64))
        place = mix(first.astype(np.uint64) + mix(np.full(len(first), i % (1 << 63), np.uint64)))
        total = len(at) + len(first)
        return {
            "k1": np.concatenate([one, place]), "k2": np.concatenate([two, place]),
            "id": np.full(total, i, np.int64), "tag": np.full(total, t, np.int64),
            "start": np.concatenate([at, first]), "n": np.concatenate([count, end - first - size + 1]),
            "kind": np.repeat([_OPEN, _REPEAT], [len(at), len(first)]),
        }

    def _keys(text: str, at: np.ndarray):
        h = word_hashes(words_of(text))
        one, two = _pair_hashes(h, length, seed)
        if length == size:
            return at, np.ones(len(at), np.int64), one[at], two[at]
        seeds = _chosen_seeds(h, size, seed)[at]
        window = np.where(seeds + length <= at + size, seeds, seeds + seed - length)
        new = np.ones(len(at), bool)
        new[1:] = (window[1:] != window[:-1]) | (at[1:] != at[:-1] + 1)
        begin = np.flatnonzero(new)
        return at[begin], np.diff(np.append(begin, len(at))), one[window[begin]], two[window[begin]]

    def run(batches):
        held, count = [], 0
        for batch in batches:
            ids, tags = batch.column("id").to_pylist(), batch.column("tag").to_pylist()
            for i, (text, judged) in enumerate(zip(batch.column("text"), batch.column("runs"), strict=True)):
                start, n, kind = (
                    np.asarray(judged.values.field(name).to_numpy(zero_copy_only=False), np.int64)
                    for name in ("start", "n", "kind")
                )
                order = np.argsort(start, kind="stable")
                held.append(rows_of(text.as_py(), ids[i], tags[i], start[order], n[order], kind[order]))
                count += len(held[-1]["id"])
                if count >= PIECE_WORDS:
                    yield _batch(_settle(_joined(held, names), length == size), fields)
                    held, count = [], 0
        if count:
            yield _batch(_settle(_joined(held, names), length == size), fields)

    return docs.mapInArrow(run, _RUNS)


def _joined(held: list[dict], names: list[str]) -> dict[str, np.ndarray]:
    return {name: np.concatenate([x[name] for x in held]) for name in names}


def _chosen_seeds(h: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Per final window the place of the seed that stands for it: smallest hash, then leftmost.

    Hashes are compared by their upper bits, in pieces, so that a place fits beside them.
    """
    out = []
    for offset in range(0, len(h) - size + 1, PIECE_WORDS):
        part = h[offset : offset + PIECE_WORDS + size - 1]
        out.append(_marked_minima(mix(window_hashes(part, seed)), size - seed + 1) + offset)
    return np.concatenate(out)


def _marked_minima(seeds: np.ndarray, width: int) -> np.ndarray:
    low = np.uint64((1 << PLACE_BITS) - 1)
    marked = (seeds & ~low) | np.arange(len(seeds), dtype=np.uint64)
    return (sliding(marked, width, np.minimum) & low).astype(np.int64)


def _settle(rows: dict[str, np.ndarray], final: bool) -> dict[str, np.ndarray]:
    """Settles what this task can tell alone: of equal windows here, those at the first place (at
    the final length) or the first two places (below it) are sent to be compared; the others are
    repeats, or to be extended."""
    order, leader = _first_of_equal([rows["k1"], rows["k2"]], rows["id"], rows["start"])
    rows = {name: values[order] for name, values in rows.items()}
    position = np.empty(len(order), np.int64)
    position[order] = np.arange(len(order))
    leader = position[leader]
    later = (rows["id"] != rows["id"][leader]) | (rows["start"] != rows["start"][leader])
    if not final:
        moved = np.ones(len(order), np.int64)
        moved[1:] = (leader[1:] != leader[:-1]) | (rows["id"][1:] != rows["id"][:-1]) | (rows["start"][1:] != rows["start"][:-1])
        place = np.cumsum(moved)
        later &= place - place[leader] >= 2
    again = later & (rows["kind"] == _OPEN)
    rows["kind"] = np.where(again, _REPEAT if final else _EXTEND, rows["kind"])
    rows["k1"] = np.where(again, _own_key(rows), rows["k1"])
    return rows


def _own_key(rows: dict[str, np.ndarray]) -> np.ndarray:
    """Settled rows need no partner: a key of their own spreads them."""
    return mix(rows["id"].astype(np.uint64) * BASE + rows["start"].astype(np.uint64))


def _merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping [start, end) joined."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > reach[:-1]
    last = np.append(np.flatnonzero(new)[1:], len(start)) - 1
    return start[new], reach[last]


def _judge_level(rows: DataFrame) -> DataFrame:
    """Below the final length: runs whose window is at several places are extended further."""
    equal = Window.partitionBy("k1", "k2")
    place = F.struct("id", "start")
    kind = F.when(F.col("kind") != _OPEN, F.col("kind")).when(F.col("several"), F.lit(_EXTEND))
    return (
        rows.withColumn("several", F.min(place).over(equal) != F.max(place).over(equal))
        .select("id", "tag", "start", "n", kind.alias("kind"))
        .where("kind IS NOT NULL")
    )


def _judge_windows(rows: DataFrame) -> DataFrame:
    """At the final length: windows that are repeats of an earlier one."""
    equal = Window.partitionBy("k1", "k2")
    return (
        rows.withColumn("first", F.min(F.struct("id", "start")).over(equal))
        .where((F.col("kind") == _REPEAT) | (F.struct("id", "start") > F.col("first")))
        .select("id", "tag", "start", "n")
    )


def repeated_spans(docs: DataFrame, size: int = WINDOW, seed: int | None = None) -> DataFrame:
    """(id, tag, spans) for texts with words to remove; ``docs`` as :func:`_keyed` gives it.

    Spans are (start, n): n windows from word ``start`` on, n + size - 1 words.
    """
    seed = seed or max(1, size // 4)
    ship(docs.sparkSession)
    judged = _judge_runs(_seed_runs(docs, size, seed))
    for length in _levels(size, seed):
        runs = judged.groupBy("id", "tag").agg(F.collect_list(F.struct("start", "n", "kind")).alias("runs"))
        rows = _extended(docs.join(runs, ["id", "tag"]), size, seed, length)
        judged = _judge_windows(rows) if length == size else _judge_level(rows)
    return judged.groupBy("id", "tag").agg(F.collect_list(F.struct("start", "n")).alias("spans"))


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, tag, text, row): null ids before all others; the tag parts texts that share an id."""
    others = [F.col(c) for c in docs.columns if c != text]
    return docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))).alias("id"),
        # Never null by its type, so inner joins add no filter and all joins read one exchange.
        F.coalesce((F.xxhash64(F.col(text)) % (2**31)).cast("int"), F.lit(0)).alias("tag"),
        F.col(text).alias("text"),
        F.struct(*others).alias("row"),
    )


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """(row, n_words, n_removed, kept): every document without the words of repeated windows.

    A window is ``size`` consecutive words of one document. Its words go if the same words also
    start earlier (smaller id, or same document and earlier place), judged on the input. ``row``
    holds the other columns as they were, ``kept`` the words left, joined by one space. Null text
    has no words, texts shorter than a window are kept, null ids come before all others, rows
    equal in id and text are one document and kept or cut alike, rows that share an id only are
    told apart by their texts and have the same place. An empty table gives no rows.

    Documents are shuffled once, by id; both joins read that exchange. Everything else that
    moves is some numbers per run of windows.
    """
    keyed = _keyed(docs, key, text)
    found = keyed.join(repeated_spans(keyed, size), ["id", "tag"], "left")
    row_type = keyed.schema["row"].dataType.simpleString()

    def cut(batches):
        for batch in batches:
            words_n, removed_n, kept = [], [], []
            for text_value, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                words = words_of(text_value.as_py())
                words_n.append(len(words))
                if spans.is_valid:
                    start = spans.values.field("start").to_numpy(zero_copy_only=False)
                    n = spans.values.field("n").to_numpy(zero_copy_only=False)
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + n + size - 1, -1)
                    stay = np.cumsum(edge)[:-1] == 0
                    words = [w for w, s in zip(words, stay.tolist(), strict=True) if s]
                removed_n.append(words_n[-1] - len(words))
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(words_n, pa.int64()), pa.array(removed_n, pa.int64()), pa.array(kept, pa.string())],
                names=["row", "n_words", "n_removed", "kept"],
            )

    return found.select("row", "text", "spans").mapInArrow(
        cut, f"row {row_type}, n_words long, n_removed long, kept string"
    )


SQL = r"""
WITH split AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS w FROM split, unnest(range(1, len(words) - 18)) t(i)
), firsts AS (
  SELECT w, min({'d': doc_id, 'i': i}) AS f FROM windows GROUP BY w HAVING count(*) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM windows JOIN firsts USING (w) WHERE {'d': doc_id, 'i': i} > f
), dropped AS (
  SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN ps IS NULL THEN words ELSE list_filter(words, lambda w, i: NOT list_contains(ps, i)) END, ' ')) AS kept_sha256
FROM split LEFT JOIN dropped USING (doc_id)
"""


@check(SQL)
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed",
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )
