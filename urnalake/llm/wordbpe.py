"""Byte-level BPE by a shuffle of distinct words: each is encoded once for the whole corpus.

Texts are cut into words by the split pattern. A task's words form bundles of documents. A bundle
keeps its words as numbers, in the order of their positions, and sends each distinct word once to
the partition that the word's hash names, packed with the bundle's other words that go there.
There every word is merged once, whichever bundles ask for it, and its ids go back to them. In the
bundle, ids take the place of the numbers, position by position. Decoding joins ids with the table
of token bytes.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urnalake.checks.registry import check
from urnalake.llm.common import ship, table
from urnalake.llm.scripts import BEYOND_LATIN, NEWER, for_latin, with_older_classes

#: Characters of text in a bundle, unless a single text has more.
BUNDLE_CHARS = 12 << 20
#: Characters that are cut into words at a time.
PIECE_CHARS = 1 << 20
#: Bytes of a word beyond which pairs wait in a heap.
LONG_WORD = 48
#: Rows of ids that are decoded at a time.
ROWS_AT_A_TIME = 500


class Splitter:
    """Texts to words: the matches of a split pattern, as the rank files' library finds them."""

    def __init__(self, pattern: str):
        import regex

        self.usual, self.latin, self.older = regex.compile(pattern), for_latin(pattern), with_older_classes(pattern)

    def words(self, text: str) -> Iterator[list[str]]:
        """The words of a text in order, in lists for pieces of the text."""
        for piece in _pieces(text):
            if not BEYOND_LATIN.search(piece):
                yield self.latin.findall(piece)
            else:
                yield (self.older if NEWER.search(piece) else self.usual).findall(piece)


def _pieces(text: str) -> Iterator[str]:
    """A long text cut in front of single spaces, which no word goes across."""
    begin = 0
    while len(text) - begin > 2 * PIECE_CHARS:
        end = text.find(" ", begin + PIECE_CHARS)
        while 0 < end < len(text) - 1 and (text[end - 1].isspace() or text[end + 1].isspace()):
            end = text.find(" ", end + 1)
        if not 0 < end < len(text) - 1:
            break
        yield text[begin:end]
        begin = end
    yield text[begin:] if begin else text


def read_ranks(content: bytes) -> dict[bytes, int]:
    """The token bytes and ranks of a rank file."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line)}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a word: the leftmost pair of lowest rank is merged until none is left."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > LONG_WORD:
        return _merge_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    none = 1 << 62
    pairs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
    while pairs:
        lowest = min(pairs)
        if lowest == none:
            break
        i = pairs.index(lowest)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
    return [ranks[p] for p in parts]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """:func:`merge` with a heap of pairs; a pair that has changed since is passed over."""
    n = len(word)
    end, after, before, alive = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n

    def rank(i: int) -> int | None:
        return ranks.get(word[i : end[after[i]]]) if after[i] < n else None

    heap = [(r, i, end[after[i]]) for i in range(n - 1) if (r := rank(i)) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or after[i] >= n or end[after[i]] != stop:
            continue
        gone = after[i]
        alive[gone], end[i], after[i] = False, end[gone], after[gone]
        if after[i] < n:
            before[after[i]] = i
        for j in (i, before[i]):
            if j >= 0 and (r := rank(j)) is not None:
                heapq.heappush(heap, (r, j, end[after[j]]))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = after[i]
    return out


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers below 2**32, compressed by their bytes' places."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


class _Bundle:
    """Documents of one task whose words share one numbering, in the order they first appear."""

    def __init__(self, number: int):
        self.number, self.chars, self.numbering = number, 0, {}
        self.keys, self.counts, self.positions = [], [], []
        self.content = xxhash.xxh3_64()

    def add(self, key: pa.Scalar, text: str, splitter: Splitter) -> None:
        count, numbering = 0, self.numbering
        for words in splitter.words(text):
            for word in dict.fromkeys(words):
                numbering.setdefault(word, len(numbering))
            self.positions.append(np.fromiter(map(numbering.__getitem__, words), np.uint32, len(words)))
            count += len(words)
        self.keys.append(key)
        self.counts.append(count)
        self.chars += len(text)
        self.content.update(text.encode("utf-8"))

    def name(self) -> int:
        """The same for the same texts in the same task only."""
        place = f"{TaskContext.get().partitionId()}/{self.number}/{self.content.hexdigest()}"
        return xxhash.xxh3_64_intdigest(place.encode()) - (1 << 63)


def _bundles(batches, splitter: Splitter) -> Iterator[_Bundle]:
    bundle = _Bundle(0)
    for batch in batches:
        for key, text in zip(batch.column("id"), batch.column("text"), strict=True):
            bundle.add(key, text.as_py() or "", splitter)
            if bundle.chars >= BUNDLE_CHARS:
                yield bundle
                bundle = _Bundle(bundle.number + 1)
    if bundle.keys:
        yield bundle


def _cut(rows: DataFrame, pattern: str, buckets: int) -> DataFrame:
    """Bundles as rows of two kinds.

    With a bucket: the numbers and the bytes of the bundle's distinct words that their hash sends
    there. Without one: the bundle's documents as numbers of their words, position by position.
    """
    key_type = rows.schema["id"].dataType.simpleString()
    names = ["bundle", "bucket", "keys", "counts", "words", "numbers", "body"]

    def run(batches):
        splitter = Splitter(pattern)
        for bundle in _bundles(batches, splitter):
            kinds = [pa.int64(), pa.int64(), pa.list_(bundle.keys[0].type), pa.binary(), pa.int64(), pa.binary(), pa.binary()]
            words = [w.encode("utf-8") for w in bundle.numbering]
            bucket = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            pack, name, out = zstandard.ZstdCompressor(level=1), bundle.name(), []
            for numbers in np.split(order, cuts) if len(order) else []:
                some = [words[i] for i in numbers]
                lengths = np.array([len(w) for w in some], "<u4")
                body = len(some).to_bytes(4, "little") + lengths.tobytes() + b"".join(some)
                out.append((name, int(bucket[numbers[0]]), None, None, None, _pack(numbers), pack.compress(body)))
            positions = np.concatenate(bundle.positions) if bundle.positions else np.zeros(0, np.uint32)
            keys = [k.as_py() for k in bundle.keys]
            out.append((name, None, keys, _pack(np.array(bundle.counts, np.int64)), len(words), _pack(positions), None))
            columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"bundle long, bucket long, keys array<{key_type}>, counts binary, words long, numbers binary, body binary"
    return rows.mapInArrow(run, schema)


def _words_sent(cut: DataFrame) -> DataFrame:
    """The rows with words. A column filter would go below the exchange, and make it another one."""

    def run(batches):
        for batch in batches:
            yield batch.filter(batch.column("bucket").is_valid()).select(["bundle", "bucket", "numbers", "body"])

    return cut.mapInArrow(run, "bundle long, bucket long, numbers binary, body binary")


def _encoded(sent: DataFrame, get_ranks) -> DataFrame:
    """(bundle, numbers, sizes, ids): the words of a partition merged once each."""

    def run(batches):
        ranks = get_ranks()
        known: dict[bytes, bytes] = {}
        for batch in batches:
            for bundle, numbers, packed in zip(*(batch.column(c) for c in ("bundle", "numbers", "body")), strict=True):
                body = zstandard.ZstdDecompressor().decompress(packed.as_py())
                count = int.from_bytes(body[:4], "little")
                ends = np.cumsum(np.frombuffer(body, "<u4", count, 4), dtype=np.int64) + 4 + 4 * count
                found, begin = [], 4 + 4 * count
                for end in ends.tolist():
                    word = body[begin:end]
                    ids = known.get(word)
                    if ids is None:
                        ids = known[word] = np.array(merge(word, ranks), "<u4").tobytes()
                    found.append(ids)
                    begin = end
                sizes = np.array([len(f) // 4 for f in found], "<u4")
                values = [bundle.as_py(), numbers.as_py(), _pack(sizes), _pack(np.frombuffer(b"".join(found), "<u4"))]
                kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=["bundle", "numbers", "sizes", "ids"]
                )

    return sent.select("bundle", "numbers", "body").mapInArrow(run, "bundle long, numbers binary, sizes binary, ids binary")


def _reassembled(answers: pa.Table, bundles: pa.Table) -> Iterator[pa.Table]:
    """(id, ids) per document of the bundle, from the ids of its words."""
    bundles = bundles.filter(bundles.column("bucket").is_null())
    if not bundles.num_rows:
        return
    words = bundles.column("words")[0].as_py()
    sizes, begins, parts, held = np.full(words, -1, np.int64), np.zeros(words, np.int64), [], 0
    for numbers, size, ids in zip(*(answers.column(c) for c in ("numbers", "sizes", "ids")), strict=True):
        at, size, ids = _unpack(numbers.as_py()), _unpack(size.as_py()).astype(np.int64), _unpack(ids.as_py())
        sizes[at] = size
        begins[at] = held + np.cumsum(size) - size
        parts.append(ids)
        held += len(ids)
    if (sizes < 0).any():
        raise RuntimeError("texts came in another order when they were read again: write them to a table first")
    ids = np.concatenate(parts) if parts else np.zeros(0, "<u4")
    for row in range(bundles.num_rows):
        positions = _unpack(bundles.column("numbers")[row].as_py())
        counts = _unpack(bundles.column("counts")[row].as_py()).astype(np.int64)
        lengths = sizes[positions]
        ends = np.cumsum(lengths)
        # The place of each id: its word's first id, and how far into the word it is.
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins[positions] - (ends - lengths), lengths)
        stops = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        values = pa.array(ids[places].astype(np.int32))
        keys = bundles.column("keys")[row].values
        yield pa.table({"id": keys, "ids": pa.ListArray.from_arrays(pa.array(stops.astype(np.int32)), values)})


def encode(docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ids) per row: the ids of its whole text.

    Null and empty texts have no ids; repeated rows, equal and null ids each keep their row; an
    empty table has no rows; other columns are ignored. A text is one row of its bundle, however
    long; its words are cut a piece at a time.

    Words and positions leave one exchange by bundle, which both ways read. Should a lost task's
    texts come in another order when they are read again, a bundle misses words, and that raises.

    A word that all documents have is one entry per bundle, so no word is hot. The number of
    buckets is that of input or shuffle partitions, whichever is larger, so the distinct words of
    a bucket do not grow with the input where partitions do.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    key_type = rows.schema["id"].dataType.simpleString()
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.rdd.getNumPartitions())
    cut = _cut(rows, pattern, buckets).repartition(buckets, "bundle")
    answers = _encoded(_words_sent(cut).repartition(buckets, "bucket"), _shared_ranks(spark, ranks_path))
    out = answers.groupBy("bundle").cogroup(cut.groupBy("bundle")).applyInArrow(_one_table, f"id {key_type}, ids array<int>")
    return out.withColumnRenamed("id", key)


def _one_table(answers: pa.Table, bundles: pa.Table) -> pa.Table:
    found = list(_reassembled(answers, bundles))
    empty = {"id": pa.array([], bundles.schema.field("keys").type.value_type), "ids": pa.array([], pa.list_(pa.int32()))}
    return pa.concat_tables(found) if found else pa.table(empty)


_RANKS: dict[bytes, dict[bytes, int]] = {}


def _shared_ranks(spark: SparkSession, path: str):
    with open(path, "rb") as file:  # on the driver only; tasks get its fixed-size content
        shared = spark.sparkContext.broadcast(file.read())

    def get() -> dict[bytes, int]:
        if shared.value not in _RANKS:
            _RANKS.clear()
            _RANKS[shared.value] = read_ranks(shared.value)
        return _RANKS[shared.value]

    return get


def token_table(ranks: dict[bytes, int]) -> pa.Array:
    """Token bytes by id; null where an id is not used."""
    tokens: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for token, number in ranks.items():
        tokens[number] = token
    return pa.array(tokens, pa.large_binary())


def decoded(ids: np.ndarray, tokens: pa.Array) -> bytes:
    """The bytes of tokens, joined. An id without a token raises."""
    places = pa.array(ids, pa.int64())
    found = tokens.take(places) if not len(ids) or 0 <= ids.min() <= ids.max() < len(tokens) else None
    if found is None or found.null_count:
        raise ValueError("an id has no token")
    if not len(found):
        return b""
    # The values of an Arrow array lie one behind the other: they are joined already.
    _, offsets, values = found.buffers()
    begin, end = np.frombuffer(offsets, np.int64, len(found) + 1, 8 * found.offset)[[0, -1]]
    return values.slice(begin, end - begin).to_pybytes()


def decode(df: DataFrame, ranks_path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with the bytes that its array of ids stands for as last column ``into``.

    Null arrays give no bytes; an id outside of the rank file, or a null one, raises. A column
    named ``into`` is replaced; other columns and all rows stay.
    """
    get = _shared_ranks(df.sparkSession, ranks_path)
    ship(df.sparkSession)
    names = [c for c in df.columns if c != into]
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in names), f"`{into}` binary"])

    def run(batches):
        tokens = token_table(get())
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS_AT_A_TIME):
                part = batch.slice(begin, ROWS_AT_A_TIME)
                made = [decoded(x.values.to_numpy(zero_copy_only=False), tokens) if x.is_valid else b"" for x in part.column(ids)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(made, pa.binary())], names=[*names, into])

    return df.mapInArrow(run, schema)


def digests(coded: DataFrame, ranks_path: str, key: str = "doc_id") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of (id, ids); decoded in the same task."""
    get = _shared_ranks(coded.sparkSession, ranks_path)
    key_type = coded.schema[key].dataType.simpleString()

    def run(batches):
        tokens = token_table(get())
        for batch in batches:
            counts, of_ids, of_bytes = [], [], []
            for row in batch.column("ids"):
                ids = row.values.to_numpy().astype("<u4")
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(ids.tobytes()).hexdigest())
                of_bytes.append(hashlib.sha256(decoded(ids, tokens)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = coded.select(F.col(key).alias("id"), "ids")
    out = rows.mapInArrow(run, f"id {key_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", key)


def rank_file(name: str = "byte_bpe_50k.tiktoken") -> tuple[str, str]:
    """A rank file's path and the pattern that splits texts for it."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


@check()
def op13_word_shuffle_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = rank_file()
    return digests(encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, pattern), path)
