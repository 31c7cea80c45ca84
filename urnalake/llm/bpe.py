"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

Each leaf of the tree is a pair of neighbouring symbols, its value the pair's merge rank and
its place. The root is then the leftmost pair of lowest rank: it is merged, three leaves are
updated along their paths to the root, and so on until no pair can be merged. The trees of many
words stand side by side in one array, so each step runs on all words of a batch at once.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, IntegerType, StringType, StructField, StructType

from urnalake.checks.registry import check
from urnalake.llm.common import ship, table
from urnalake.llm.scripts import BEYOND_LATIN, NEWER, for_latin, lower, normal_form, with_older_classes

#: Words whose ids a task keeps at a time; beyond it the older half goes.
KEPT_WORDS = 300_000
#: Symbols (words times longest word) that are merged side by side at a time.
SIDE_BY_SIDE = 1 << 16
#: Rows whose ids or decoded texts a task holds at a time.
ROWS_AT_A_TIME = 200
#: Bytes of a word beyond which it is merged alone: few words are so long.
LONG_WORD = 64
#: Characters of a document that are looked up at a time.
PIECE_CHARS = 1 << 20

_NONE = np.int32(np.iinfo(np.int32).max)
#: Bits of a place in a tree of words of up to LONG_WORD symbols; ranks have the others.
_SHORT_BITS = 6
_PLACE_BITS = 34


class BpeModel:
    """Encoder and decoder for a tokenizer file of the kind "BPE with word ends".

    ``spec`` is the parsed file: normalizers NFC, white space to one space and lower case, a
    split pattern, bytes as printable characters, merges, and a suffix for the end of a word.
    """

    def __init__(self, spec: dict):
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocabulary: dict[str, int] = model["vocab"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*self.vocabulary.values(), *added.values()]) + 1
        self.tokens = [""] * size
        for token, number in [*self.vocabulary.items(), *added.items()]:
            self.tokens[number] = token
        self.added = {content: np.uint32(number).tobytes() for content, number in added.items()}
        self.added_pattern = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        pattern = split["pattern"]["Regex"]
        self.pattern, self.latin, self.older = regex.compile(pattern), for_latin(pattern), with_older_classes(pattern)
        if (len(model["merges"]) << _SHORT_BITS) >= int(_NONE):
            raise ValueError("too many merges for 32-bit tree values")
        names = _byte_symbols()
        self.inner = np.array([self.vocabulary.get(n, -1) for n in names], np.int32)
        self.last = np.array([self.vocabulary.get(n + self.suffix, -1) for n in names], np.int32)
        pairs, ranks, merged = [], [], []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            pairs.append((self.vocabulary[left] << 32) | self.vocabulary[right])
            ranks.append(rank)
            merged.append(self.vocabulary[left + right])
        order = np.argsort(np.array(pairs, np.int64), kind="stable")
        self.pairs = np.array(pairs, np.int64)[order]
        self.ranks = np.array(ranks, np.int32)[order]
        self.merged = np.array(merged, np.int32)[order]
        self.pair_table = {p: (r, m) for p, r, m in zip(pairs, ranks, merged, strict=True)}
        # A word of the pattern is never an added token: these mix signs and letters.
        self.known: dict[str, bytes] = dict(self.added)

    # Text to words

    def words(self, text: str) -> list[str]:
        """The words of a text in normal form and lower case. White space is in no word."""
        if BEYOND_LATIN.search(text):
            text = lower(normal_form(text))
        else:  # in normal form already
            text = text.lower()
        if not BEYOND_LATIN.search(text):
            return self.latin.findall(text)
        return (self.older if NEWER.search(text) else self.pattern).findall(text)

    def segments(self, text: str) -> list[str]:
        """The text cut at the added tokens; these stay as pieces of their own."""
        if self.added_pattern is None or not self.added_pattern.search(text):
            return [text]
        return [part for part in self.added_pattern.split(text) if part]

    # Words to ids

    def symbols(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, number per word): ids of the words' bytes, a last one with the word's end.

        Symbols that the vocabulary does not have are left out.
        """
        lengths = np.array([len(w) for w in words], np.int64)
        values = np.frombuffer(b"".join(words), np.uint8)
        symbols, ends = self.inner[values], np.cumsum(lengths) - 1
        symbols[ends] = self.last[values[ends]]
        if symbols.min(initial=0) >= 0:
            return symbols, lengths
        word_of = np.repeat(np.arange(len(words)), lengths)
        known = symbols >= 0
        return symbols[known], np.bincount(word_of[known], minlength=len(words))

    def learn(self, words: Iterable[str]) -> None:
        """Encode the words not known yet, those of similar length side by side."""
        new = sorted(((w.encode("utf-8"), w) for w in words if w not in self.known), key=lambda w: len(w[0]))
        begin = 0
        while begin < len(new):
            width, end = _width(len(new[begin][0])), begin + 1
            if len(new[begin][0]) > LONG_WORD:
                symbols, _ = self.symbols([new[begin][0]])
                self.known[new[begin][1]] = np.array(self.merge_alone(symbols.tolist()), "<u4").tobytes()
            else:
                while end < len(new) and len(new[end][0]) <= width and (end - begin) * width < SIDE_BY_SIDE:
                    end += 1
                ids, counts = self.merge(*self.symbols([w for w, _ in new[begin:end]]))
                ids, stops = ids.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
                for (_, word), start, stop in zip(new[begin:end], [0, *stops], stops, strict=False):
                    self.known[word] = ids[start:stop]
            begin = end

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged symbol) of pairs; rank ``_NONE`` where there is no merge."""
        key = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        found = (self.pairs[at] == key) & (left >= 0) & (right >= 0)
        return np.where(found, self.ranks[at], _NONE), self.merged[at]

    def merge(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words of up to LONG_WORD symbols merged as far as it goes: (ids, number per word)."""
        rows, leaves = len(counts), _width(int(counts.max(initial=1)))
        symbol = np.full((rows, leaves + 1), -1, np.int32)  # the last column is a stop
        inside = np.arange(leaves + 1)[None, :] < counts[:, None]
        symbol[inside] = symbols
        follower = np.tile(np.arange(1, leaves + 2, dtype=np.int32), (rows, 1))
        leader = np.tile(np.arange(-1, leaves, dtype=np.int32), (rows, 1))
        places = np.arange(leaves, dtype=np.int32)
        ranks, joined = self.lookup(symbol[:, :-1], symbol[:, 1:])
        tree = np.full((rows, 2 * leaves), _NONE, np.int32)
        tree[:, leaves:] = np.where(ranks < _NONE, (ranks << _SHORT_BITS) | places, _NONE)
        width = leaves // 2
        while width:
            tree[:, width : 2 * width] = np.minimum(tree[:, 2 * width : 4 * width : 2], tree[:, 2 * width + 1 : 4 * width : 2])
            width //= 2
        active = np.flatnonzero(tree[:, 1] < _NONE)
        while len(active):
            at = tree[active, 1] & ((1 << _SHORT_BITS) - 1)
            other = follower[active, at]
            behind, before = follower[active, other], leader[active, at]
            symbol[active, at], symbol[active, other] = joined[active, at], -1
            follower[active, at] = behind
            go_on, has = behind <= leaves, before >= 0
            leader[active[go_on], behind[go_on]] = at[go_on]
            # Two pairs are new, that of the symbol that is gone is none.
            row = np.concatenate([active, active[has], active])
            place = np.concatenate([at, before[has], other])
            new = len(active) + int(has.sum())
            right = np.concatenate([np.minimum(behind, leaves), at[has]])
            rank, joins = self.lookup(symbol[row[:new], place[:new]], symbol[row[:new], right])
            joined[row[:new], place[:new]] = joins
            value = np.full(len(row), _NONE, np.int32)
            value[:new] = np.where(rank < _NONE, (rank << _SHORT_BITS) | place[:new], _NONE)
            in_tree = place < leaves
            self._update(tree, row[in_tree], place[in_tree], value[in_tree])
            active = active[tree[active, 1] < _NONE]
        kept = symbol >= 0
        return symbol[kept], kept.sum(1)

    @staticmethod
    def _update(tree: np.ndarray, rows: np.ndarray, places: np.ndarray, values: np.ndarray) -> None:
        """New values for leaves, and for the nodes above them, one level after the other."""
        width = tree.shape[1] // 2
        node = places + width
        tree[rows, node] = values
        while width > 1:
            node >>= 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
            width >>= 1

    def merge_alone(self, symbol: list[int]) -> list[int]:
        """:meth:`merge` for one long sequence: the same tree, one value at a time."""
        leaves = _width(len(symbol))
        table = self.pair_table
        none = (1 << 62, 0)

        def value(left: int, right: int, place: int) -> int:
            rank = table.get((left << 32) | right, none)[0] if left >= 0 and right >= 0 else none[0]
            return (rank << _PLACE_BITS) | place if rank < none[0] else none[0]

        symbol = symbol + [-1]
        last = len(symbol) - 1
        follower, leader = list(range(1, last + 2)), list(range(-1, last))
        tree = [none[0]] * (2 * leaves)
        for place in range(last):
            tree[leaves + place] = value(symbol[place], symbol[place + 1], place)
        for node in range(leaves - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def update(place: int, new: int) -> None:
            node = leaves + place
            tree[node] = new
            node >>= 1
            while node:
                low = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == low:
                    break
                tree[node] = low
                node >>= 1

        while tree[1] < none[0]:
            at = tree[1] & ((1 << _PLACE_BITS) - 1)
            other = follower[at]
            symbol[at] = table[(symbol[at] << 32) | symbol[other]][1]
            symbol[other] = -1
            behind = follower[at] = follower[other]
            if behind < last:
                leader[behind] = at
            update(other, none[0])
            update(at, value(symbol[at], symbol[min(behind, last)], at))
            before = leader[at]
            if before >= 0:
                update(before, value(symbol[before], symbol[at], before))
        return [s for s in symbol if s >= 0]

    # Texts to ids and back

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Per text its ids as little-endian unsigned 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, list[str]]] = []
        held = 0
        for number, text in enumerate(texts):
            for piece in _pieces(text or ""):
                for segment in self.segments(piece):
                    words = [segment] if segment in self.added else self.words(segment)
                    waiting.append((number, words))
                held += len(piece)
                if held >= PIECE_CHARS:
                    self._encode_waiting(waiting, out)
                    waiting, held = [], 0
        self._encode_waiting(waiting, out)
        return [b"".join(parts) for parts in out]

    def _encode_waiting(self, waiting: list[tuple[int, list[str]]], out: list[list[bytes]]) -> None:
        if len(self.known) > KEPT_WORDS:
            newer = list(self.known.items())[len(self.known) // 2 :]
            self.known = {**dict(newer), **self.added}
        self.learn(set().union(*(words for _, words in waiting)))
        for number, words in waiting:
            out[number].append(b"".join(map(self.known.__getitem__, words)))

    def forget(self) -> None:
        """Give back the memory of words: workers stay for tasks that have other work."""
        self.known = dict(self.added)

    def decode(self, ids: bytes) -> str:
        """Tokens joined by a space: the file names no decoder, so word ends stay visible."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _pieces(text: str) -> Iterable[str]:
    """A long text cut in front of spaces, which no word and no added token has."""
    begin = 0
    while len(text) - begin > 2 * PIECE_CHARS:
        end = text.find(" ", begin + PIECE_CHARS)
        if end < 0:
            break
        yield text[begin:end]
        begin = end
    yield text[begin:] if begin else text


def _width(length: int) -> int:
    return 1 << max(1, (length - 1).bit_length())


def _byte_symbols() -> list[str]:
    """Bytes as printable characters: these stand for themselves, the others follow from 256 on."""
    printable = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)}
    symbols, extra = [], 0
    for byte in range(256):
        symbols.append(chr(byte) if byte in printable else chr(256 + extra))
        extra += byte not in printable
    return symbols


_MODELS: dict[bytes, BpeModel] = {}


def model_of(content: bytes) -> BpeModel:
    """The model of a tokenizer file's content, built once per Python worker."""
    if content not in _MODELS:
        _MODELS.clear()
        _MODELS[content] = BpeModel(json.loads(content))
    return _MODELS[content]


def _model_step(spark: SparkSession, path: str):
    with open(path, "rb") as file:  # on the driver only; tasks get its fixed-size content
        shared = spark.sparkContext.broadcast(file.read())
    ship(spark)
    return lambda: model_of(shared.value)


def _with_column(df: DataFrame, column: str, into: str, kind: DataType, step: Callable[[pa.Array], pa.Array]) -> DataFrame:
    """``df`` with ``into`` computed from ``column``, a few rows at a time."""
    kept = [c for c in df.columns if c != into or c == column]
    rows = df.select(*kept)
    names = [c for c in kept if c != into]
    schema = StructType([*(rows.schema[c] for c in names), StructField(into, kind)])

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS_AT_A_TIME):
                part = batch.slice(begin, ROWS_AT_A_TIME)
                made = step(part.column(column))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), made], names=[*names, into])
        for model in _MODELS.values():
            model.forget()

    out = rows.mapInArrow(run, schema)
    return out.select(*[c for c in df.columns if c != into], into)


def encode(docs: DataFrame, path: str, text: str = "text", into: str = "ids") -> DataFrame:
    """``docs`` with the ids of every whole text as array ``into``, the last column.

    Null and empty texts, and texts of white space only, have no ids. The column ``into`` is
    replaced if there is one; other columns and rows, also repeated ones, stay as they are.
    """
    get = _model_step(docs.sparkSession, path)

    def step(texts: pa.Array) -> pa.Array:
        return _ids_array(get().encode_batch(texts.to_pylist()))

    return _with_column(docs, text, into, ArrayType(IntegerType()), step)


def decode(df: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with the text of an array of ids as column ``into``; null ids give the empty text."""
    get = _model_step(df.sparkSession, path)

    def step(column: pa.Array) -> pa.Array:
        none = np.zeros(0, "<u4")
        values = (np.asarray(x.values, "<u4") if x.is_valid else none for x in column)
        return pa.array([get().decode(x.tobytes()) for x in values], pa.string())

    return _with_column(df, ids, into, StringType(), step)


def encode_and_digest(docs: DataFrame, path: str, text: str = "text", into: str = "ids", digest: str = "decoded_sha256") -> DataFrame:
    """:func:`encode` with one more column, the SHA-256 of what the ids decode to.

    Decoded texts stay in the task, and one Python worker does both: two steps in a row would take
    two workers a core, each with a model of its own. Both columns are replaced if they are there.
    """
    import hashlib

    get = _model_step(docs.sparkSession, path)
    names = [c for c in docs.columns if c not in (into, digest)]
    rows = docs.select(*names, *([text] if text in (into, digest) else []))
    schema = StructType([*(rows.schema[c] for c in names), StructField(into, ArrayType(IntegerType())), StructField(digest, StringType())])

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS_AT_A_TIME):
                part, model = batch.slice(begin, ROWS_AT_A_TIME), get()
                encoded = model.encode_batch(part.column(text).to_pylist())
                digests = [hashlib.sha256(model.decode(ids).encode("utf-8")).hexdigest() for ids in encoded]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), _ids_array(encoded), pa.array(digests, pa.string())], names=[*names, into, digest]
                )
        for model in _MODELS.values():
            model.forget()

    return rows.mapInArrow(run, schema)


def _ids_array(encoded: list[bytes]) -> pa.Array:
    offsets = np.cumsum([0, *(len(x) // 4 for x in encoded)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(encoded), "<i4")))


def token_digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encoded, and decoded again from the ids.

    Both steps run where the text is, so neither ids nor decoded texts travel. Null texts count
    as empty, rows are kept one for one, an empty table gives no rows.
    """
    import hashlib

    get = _model_step(docs.sparkSession, path)
    key_type = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            model = get()
            counts, ids_digests, text_digests = [], [], []
            for ids in model.encode_batch(batch.column("text").to_pylist()):
                counts.append(len(ids) // 4)
                ids_digests.append(hashlib.sha256(ids).hexdigest())
                text_digests.append(hashlib.sha256(model.decode(ids).encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_digests), pa.array(text_digests)],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )
        for model in _MODELS.values():
            model.forget()

    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    out = rows.mapInArrow(run, f"id {key_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", key)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@check()
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"), tokenizer_path())
