"""Near duplicates by HyperMinHash: compressed registers, banding, estimate, verification.

A document's set is its distinct 5-word shingles. One hash per shingle picks a bucket; a bucket
keeps its smallest hash as a leading-zero count plus mantissa bits, an empty one takes those of a
bucket drawn for it. Bands of registers are the keys under which similar sets meet. Small sets
meet under their rarest shingles instead: with a similarity of at least t, two sets share one of
the first n - ceil(t n) + 1 in any common order, so no link of small sets depends on chance.

Groups of copies are never expanded into pairs. Equal sets are one class. In each bucket a class
is compared with one leader; classes that verified links connect need no further comparison.
Only where a bucket still holds several components, classes outside its largest component are
compared with others: those with which they share one of their rarest shingles, as many as the
sizes of the two ask for, and which the estimate from the registers leaves possible.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from urnalake.checks.registry import check
from urnalake.llm.common import ship, table, written
from urnalake.llm.graph import components
from urnalake.llm.words import mix, window_hashes, word_hashes

SHINGLE = 5
#: A link needs PARTS[0] * |union| <= PARTS[1] * |intersection|, that is 0.75 or more.
PARTS = (75, 100)
REGISTERS = 256
#: Registers in a band. At the threshold similarity a pair meets in none of the 64 bands with a
#: probability of 3e-11; sets that share a tenth meet with one of 0.6 per cent.
BAND = 4
#: Bits of a register: six for the leading zeros, the rest mantissa.
MANTISSA_BITS = 10
#: Sets of fewer shingles fill too few buckets and meet by their rarest shingles.
FULL_FROM = 64
#: Standard errors below the threshold down to which an estimate is verified.
DOUBT = 5.0

_SKETCH = "id long, n long, set_a long, set_b long, registers binary, shingles array<long>"


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct shingle hashes of a text, sorted; a shorter text is one shingle."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # of bytes: A-Z only
    if not words:
        return np.zeros(0, np.uint64)
    hashes = word_hashes(words)
    if len(hashes) < SHINGLE:
        return mix(window_hashes(hashes, len(hashes)) + np.uint64(len(hashes)))
    return np.unique(mix(window_hashes(hashes, SHINGLE)))


def registers_of(shingles: np.ndarray) -> np.ndarray:
    """HyperMinHash registers; larger values are smaller hashes."""
    registers = np.zeros(REGISTERS, np.uint16)
    if not len(shingles):
        return registers
    bucket_bits = np.uint64(REGISTERS.bit_length() - 1)
    bucket = (shingles >> (np.uint64(64) - bucket_bits)).astype(np.int64)
    rest = (shingles << bucket_bits) | np.uint64(1)
    first = np.ones(len(bucket), bool)  # shingles are sorted: a bucket's smallest comes first
    first[1:] = bucket[1:] != bucket[:-1]
    rest = rest[first]
    zeros = 63 - _top_bit(rest)
    mantissa = (rest << zeros.astype(np.uint64) << np.uint64(1)) >> np.uint64(64 - MANTISSA_BITS)
    mantissa ^= np.uint64((1 << MANTISSA_BITS) - 1)  # so that order holds among equal zeros too
    registers[bucket[first]] = ((zeros + 1).astype(np.uint64) << np.uint64(MANTISSA_BITS)) | mantissa
    # Empty buckets draw others in an order of their own until one is filled.
    empty, filled, draw = np.flatnonzero(registers == 0), registers.copy(), 0
    while len(empty):
        draw += 1
        donor = mix(empty.astype(np.uint64) + np.uint64(draw * REGISTERS)) % np.uint64(REGISTERS)
        filled[empty] = registers[donor.astype(np.int64)]
        empty = empty[filled[empty] == 0]
    return filled


def _top_bit(values: np.ndarray) -> np.ndarray:
    top = np.zeros(len(values), np.int64)
    for step in (32, 16, 8, 4, 2, 1):
        high = values >> np.uint64(step)
        move = high > 0
        values = np.where(move, high, values)
        top += np.where(move, step, 0)
    return top


def estimated_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal registers, less the expected chance collisions."""
    # Registers of different shingles agree in the leading zeros about every third time (counts
    # are geometric) and then in the mantissa with 2**-bits.
    chance = 2.0**-MANTISSA_BITS / 3
    return max(0.0, (float((a == b).mean()) - chance) / (1 - chance))


def _samples(n: int) -> float:
    """Buckets that n shingles fill on average: registers that count as independent."""
    return REGISTERS * (1 - (1 - 1 / REGISTERS) ** n)


def _small_part(n: int) -> int:
    """Of the first so many elements in a common order, two linked sets share one."""
    return n - -(-PARTS[0] * n // PARTS[1]) + 1


def _largest_small() -> int:
    """Sets up to this size can be linked with one of fewer than FULL_FROM shingles."""
    return (FULL_FROM - 1) * PARTS[1] // PARTS[0]


def sketches(docs: DataFrame) -> DataFrame:
    """(id, n, 128-bit digest of the set, registers of large sets, shingles of small ones)."""
    ship(docs.sparkSession)
    most = _largest_small()

    def run(batches):
        for batch in batches:
            n, one, two, registers, small = [], [], [], [], []
            for text in batch.column("text"):
                shingles = shingle_set(text.as_py())
                digest = xxhash.xxh3_128_intdigest(shingles.tobytes())
                n.append(len(shingles))
                one.append((digest >> 64) - (1 << 63))
                two.append((digest & (2**64 - 1)) - (1 << 63))
                registers.append(registers_of(shingles).tobytes() if len(shingles) >= FULL_FROM else b"")
                small.append(shingles.view(np.int64) if len(shingles) <= most else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()),
                 pa.array(registers, pa.binary()), pa.array(small, pa.list_(pa.int64()))],
                names=["id", "n", "set_a", "set_b", "registers", "shingles"],
            )

    return docs.select("id", "text").mapInArrow(run, _SKETCH)


def _band_keys(classes: DataFrame) -> DataFrame:
    """(key, id): the bands of each large set."""

    def run(batches):
        salts = mix(np.arange(1, REGISTERS // BAND + 1, dtype=np.uint64))
        for batch in batches:
            registers = np.frombuffer(b"".join(batch.column("registers").to_pylist()), np.uint16)
            bands = registers.astype(np.uint64).reshape(-1, REGISTERS // BAND, BAND)
            packed = np.zeros(bands.shape[:2], np.uint64)
            for column in range(BAND):
                packed = (packed << np.uint64(16)) | bands[:, :, column]
            keys = mix(packed ^ salts[None, :])
            ids = np.repeat(batch.column("id").to_numpy(), REGISTERS // BAND)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(ids)], names=["key", "id"])

    return classes.where(f"n >= {FULL_FROM}").select("id", "registers").mapInArrow(run, "key long, id long")


def _rare_keys(classes: DataFrame) -> DataFrame:
    """(key, id): the rarest shingles of each small set, as many as links need."""
    small = classes.where(f"n <= {_largest_small()}").select("id", "n", F.explode("shingles").alias("key"))
    counts = small.groupBy("key").agg(F.count(F.lit(1)).alias("sets"))
    place = F.row_number().over(Window.partitionBy("id").orderBy("sets", "key"))
    part = F.col("n") - F.ceil(F.col("n") * PARTS[0] / PARTS[1]) + 1
    return small.join(counts, "key").withColumn("place", place).where(F.col("place") <= part).select("key", "id")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough, compared on their whole texts."""
    ship(pairs.sparkSession)
    one = texts.select(F.col("id").alias("a"), F.col("packed").alias("text_a"))
    two = texts.select(F.col("id").alias("b"), F.col("packed").alias("text_b"))
    low, high = PARTS

    def run(batches):
        for batch in batches:
            keep = []
            for text_a, text_b in zip(batch.column("text_a"), batch.column("text_b"), strict=True):
                a, b = shingle_set(_unpacked(text_a.as_py())), shingle_set(_unpacked(text_b.as_py()))
                shared = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(bool(shared) and high * shared >= low * (len(a) + len(b) - shared))
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(keep)) for c in (batch.column("a"), batch.column("b"))], names=["a", "b"]
            )

    rows = pairs.select("a", "b").join(one, "a").join(two, "b")
    return rows.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _packed(docs: DataFrame) -> DataFrame:
    """Texts compressed, as they travel and are kept for verification."""

    def run(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = [pack.compress((t.as_py() or "").encode("utf-8", "surrogatepass")) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.binary())], names=["id", "packed"])

    return docs.select("id", "text").mapInArrow(run, "id long, packed binary")


def _unpacked(packed: bytes) -> str:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(packed).decode("utf-8", "surrogatepass")


def _similar_by_estimate(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs that sizes and registers don't rule out; small sets are compared as they are."""
    low, high = PARTS
    margin = DOUBT * math.sqrt(low * (high - low)) / high

    def similar(a: bytes, b: bytes, n_a: int, n_b: int, few_a: list[int], few_b: list[int]) -> bool:
        if min(n_a, n_b) * high < max(n_a, n_b) * low:
            return False
        if few_a and few_b:
            shared = len(set(few_a).intersection(few_b))
            return high * shared >= low * (n_a + n_b - shared)
        estimate = estimated_similarity(np.frombuffer(a, np.uint16), np.frombuffer(b, np.uint16))
        return estimate >= low / high - margin / math.sqrt(_samples(min(n_a, n_b)))

    def run(batches):
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("ra", "rb", "na", "nb", "sa", "sb"))
            keep = pa.array([similar(*row) for row in zip(*columns, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], names=["a", "b"])

    sides = [
        classes.select(F.col("id").alias(c), *(F.col(x).alias(f"{x[0]}{c}") for x in ("registers", "n", "shingles")))
        for c in "ab"
    ]
    rows = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "ra", "rb", "na", "nb", "sa", "sb")
    return rows.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) per document.

    Words are maximal runs without space or ASCII space controls, with A-Z lower-cased. Sets are
    linked at a similarity of 0.75 or more, exactly verified; a component is what links reach,
    named by its smallest id, which is the document kept. Null and wordless texts have the empty
    set, linked with nothing. Rows that share an id are one node, linked as any of their texts
    is; they are kept or go together. Null ids take no part in links and are kept. An empty table
    gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    sketched = written(sketches(rows), "neardup-sketches")
    linked = sketched.where("n > 0 AND id IS NOT NULL")
    classes = linked.groupBy("set_a", "set_b").agg(
        F.min("id").alias("id"), F.first("n").alias("n"),
        F.first("registers").alias("registers"), F.first("shingles").alias("shingles"),
    )
    classes = written(classes, "neardup-classes")
    buckets = written(_in_company(_band_keys(classes).unionByName(_rare_keys(classes))), "neardup-buckets")
    wanted = buckets.select("id").distinct()
    texts = written(_packed(rows).join(wanted, "id", "left_semi"), "neardup-texts")

    # A bucket's leader is the member that meets most others over all its buckets: of a text and
    # its edited copies that is the text. A class goes with the leader it meets most often.
    sizes = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    central = buckets.join(sizes, "key").groupBy("id").agg(F.sum("size").alias("met"))
    leader = F.max_by("id", F.struct("met", -F.col("id")))
    leaders = buckets.join(central, "id").groupBy("key").agg(leader.alias("leader"))
    led = buckets.join(leaders, "key").where("id <> leader")
    best = led.groupBy("id", "leader").count().groupBy("id").agg(F.max_by("leader", F.struct("count", "leader")).alias("b"))
    first = written(verified(best.select(F.col("id").alias("a"), "b"), texts), "neardup-links")
    joined = components(first, "neardup-components")

    # Buckets that still hold several components.
    placed = buckets.join(joined, buckets["id"] == joined["node"], "left").select(
        "key", "id", F.coalesce("component", "id").alias("component")
    )
    placed = written(placed, "neardup-placed")
    largest = (
        placed.groupBy("key", "component").count().groupBy("key")
        .agg(F.max_by("component", F.struct("count", "component")).alias("largest"), F.count(F.lit(1)).alias("parts"))
        .where("parts > 1").select("key", "largest")
    )
    mixed = placed.join(largest, "key")
    mixed = mixed.groupBy("id", "component").agg(F.max(F.col("component") != F.col("largest")).alias("outside"))
    mixed = written(mixed, "neardup-mixed")
    across = _possible_pairs(texts.join(mixed, "id"))
    second = verified(_similar_by_estimate(across, classes), texts)
    links = first.select("a", "b").unionByName(second)

    # Rows of one id with different sets are one node too, as the id is all that links name.
    names = components(links, "neardup-components")
    by_set = classes.join(names, classes["id"] == names["node"], "left").select(
        "set_a", "set_b", F.coalesce("component", "id").alias("component")
    )
    out = sketched.join(by_set, ["set_a", "set_b"], "left").select(
        F.col("id"), F.col("n").alias("n_shingles"),
        F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component")).otherwise(F.col("id")).alias("component_id"),
    )
    return out.select(
        F.col("id").alias(key), "n_shingles", "component_id", F.col("component_id").eqNullSafe(F.col("id")).alias("kept")
    )


def _possible_pairs(texts: DataFrame) -> DataFrame:
    """(a, b) of different components that may be linked, once each.

    What two sets of different components share are crossing shingles, those that texts of several
    components have. Two linked sets of n and m shingles share at least c = PARTS[0] * (n + m) /
    (PARTS[0] + PARTS[1]). Of u crossing shingles, the rarest first, one of the first u - c + 1
    is therefore among such of the other set. As c is at least PARTS[0] / PARTS[1] of n, most
    texts send no shingle at all; places and sizes travel along, so the exact c of a pair is
    looked at where it meets.
    """
    ship(texts.sparkSession)
    low, high = PARTS
    names = ["id", "own", "component", "outside", "n", "shingle"]

    def run(batches):
        for batch in batches:
            for i, component, outside, packed in zip(*(batch.column(c) for c in ("id", "component", "outside", "packed")), strict=True):
                shingles = shingle_set(_unpacked(packed.as_py()))
                count = len(shingles)
                own = xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)
                row = (i.as_py(), own, component.as_py(), outside.as_py(), count)
                columns = [pa.array(np.full(count, value)) for value in row]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(shingles.view(np.int64))], names=names)

    # An id with several texts has several sets: ``own`` tells them apart.
    rows = texts.select("id", "component", "outside", "packed").mapInArrow(
        run, "id long, own long, component long, outside boolean, n long, shingle long"
    )
    rows = written(rows, "neardup-shingles")
    crossing = rows.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("sets"), F.min("component").alias("one"), F.max("component").alias("other")
    ).where("one <> other").select("shingle", "sets")
    text = Window.partitionBy("id", "own")
    ranked = rows.join(crossing, "shingle").withColumns(
        {"place": F.row_number().over(text.orderBy("sets", "shingle")), "u": F.count(F.lit(1)).over(text)}
    )
    first = F.col("u") - F.ceil(F.col("n") * low / high) + 1
    sent = written(ranked.where(F.col("place") <= first).drop("sets", "own"), "neardup-prefixes")

    x, y = (sent.select("shingle", *(F.col(c).alias(c + side) for c in sent.columns if c != "shingle")) for side in "xy")
    common = F.ceil((F.col("nx") + F.col("ny")) * low / (low + high))
    pairs = x.where("outsidex").join(y, "shingle").where("componentx <> componenty AND NOT (outsidey AND idy < idx)").where(
        (F.col("placex") <= F.col("ux") - common + 1) & (F.col("placey") <= F.col("uy") - common + 1)
        & (F.col("nx") * low <= F.col("ny") * high) & (F.col("ny") * low <= F.col("nx") * high)
    )
    return pairs.select(F.least("idx", "idy").alias("a"), F.greatest("idx", "idy").alias("b")).distinct()


def _in_company(keys: DataFrame) -> DataFrame:
    """The rows of keys that several classes have."""
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return keys.join(shared.select("key"), "key", "left_semi")


SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS s FROM split
), sizes AS (SELECT doc_id, len(s)::BIGINT AS n FROM sets
), items AS (SELECT doc_id, unnest(s) AS x FROM sets
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id
), near AS (
  SELECT a, b FROM pairs JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
  WHERE 100 * shared >= 75 * (s.n + t.n - shared)
), links AS (
  SELECT a, b FROM near UNION ALL SELECT b, a FROM near
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sizes UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT doc_id, n AS n_shingles, min(b) AS component_id, min(b) = doc_id AS kept
FROM sizes JOIN reach ON doc_id = a GROUP BY doc_id, n
"""


@check(SQL)
def op7_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
