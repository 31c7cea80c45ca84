"""Prefix trie of conversations: ternary search trees per range shard, merged at the boundaries.

A turn's token is a fixed-width digest of role and text with the text's length in bytes, so a
conversation is the string of its tokens, and texts do not travel. Equal conversations are one
class. Classes are cut into ranges of their token strings: a prefix that several ranges share lies
on the path of a range's first or last class. All other prefixes belong to one range alone.

Per range, tokens become dictionary codes and the classes enter a ternary search tree, the middle
one first, so that the trees over siblings are balanced. One sweep without recursion from the
newest node to the root adds up members, leaves and savings. What lies on a range's first and last
path is added up across ranges, and from there to all ancestors by doubling the reach of a step.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from urnalake.checks.registry import check
from urnalake.llm.common import ship, table, written

#: Hex digits of a token: 32 of the digest, 8 of the text's bytes.
TOKEN = 40
#: Turns of a range, on average: a task holds one range at a time.
RANGE_TURNS = 100_000
#: Bytes of classes a task gathers before it passes them on.
HELD_BYTES = 16 << 20
#: First turns may come from another conversation; how many at most.
MOST_BORROWED = 8

NO_IDS = hashlib.sha256(b"").hexdigest()


def token(role: Column, text: Column) -> Column:
    """A turn as TOKEN characters: equal for equal roles and texts, null counting as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    named = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.md5(named.cast("binary")), F.lpad(F.hex(F.octet_length(text)), 8, "0"))


def sequences(rows: DataFrame) -> DataFrame:
    """(conv_id, tokens, block) with the tokens in the order of turns, null turns first.

    Turns with the same number go by their token, repeated rows are repeated turns, rows without
    conv_id belong to no conversation. Partitions hold ranges of conv_ids, blocks of five ids
    whole, which is what :func:`borrowed` and :func:`classes` need: all in one exchange.
    """
    own = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        token(F.col("role"), F.col("text")).alias("token"),
    ).where("conv_id IS NOT NULL")
    placed = own.withColumn("block", F.col("conv_id") - F.col("conv_id") % 5).repartitionByRange("block")
    turns = F.array_sort(F.collect_list(F.struct("turn", "token")))
    return placed.groupBy("block", "conv_id").agg(F.transform(turns, lambda t: t["token"]).alias("tokens"))


def borrowed(conversations: DataFrame) -> DataFrame:
    """``conversations`` whose first h turns come from the one that their block is named by.

    h is the CRC-32 of the conv_id modulo 9; the turns behind the first h stay.
    """
    lent = F.when(F.col("conv_id") == F.col("block"), F.slice("tokens", 1, MOST_BORROWED))
    lender = F.max(lent).over(Window.partitionBy("block"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_BORROWED + 1)).cast("int")
    lent_part = F.slice(F.coalesce(F.col("lender"), F.array().cast("array<string>")), F.lit(1), F.col("h"))
    own_part = F.slice("tokens", F.col("h") + 1, F.greatest(F.size("tokens"), F.lit(1)))
    out = conversations.withColumns({"lender": lender, "h": h})
    return out.withColumn("tokens", F.concat(lent_part, own_part)).select("block", "conv_id", "tokens")


def classes(conversations: DataFrame) -> DataFrame:
    """(path, conv_id, n, ends): per distinct conversation its smallest id, number, ids' digest.

    Partitions must hold ranges of conv_ids. The ids of a class are joined per partition first;
    a class that many have is one row per partition then, hashed as a stream in order of ids.
    """
    ship(conversations.sparkSession)

    def gather(batches):
        for paths, found in _gathered(batches):
            yield _record([paths, [f[0] for f in found], [f[1] for f in found], [",".join(f[2]) for f in found]], ["path", "first", "n", "ids"])

    def merge(batches):
        path, least, count, digest = None, 0, 0, None
        for batch in batches:
            out: list[tuple] = []
            for row_path, first, n, ids in zip(*(batch.column(c).to_pylist() for c in ("path", "first", "n", "ids")), strict=True):
                if row_path != path:
                    if path is not None:
                        out.append((path, least, count, digest.hexdigest()))
                    path, least, count, digest = row_path, first, 0, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
                count += n
            if out:
                yield _record(list(zip(*out, strict=True)), ["path", "conv_id", "n", "ends"])
        if path is not None:
            yield _record([[path], [least], [count], [digest.hexdigest()]], ["path", "conv_id", "n", "ends"])

    rows = conversations.select("conv_id", F.array_join("tokens", "").alias("path")).sortWithinPartitions("conv_id")
    gathered = rows.mapInArrow(gather, "path string, first long, n long, ids string")
    ordered = gathered.repartition("path").sortWithinPartitions("path", "first")
    return ordered.mapInArrow(merge, "path string, conv_id long, n long, ends string")


def _gathered(batches) -> Iterator[tuple[list[str], list[list]]]:
    held: dict[str, list] = {}
    size = 0
    for batch in batches:
        for key, path in zip(batch.column("conv_id").to_pylist(), batch.column("path").to_pylist(), strict=True):
            found = held.get(path)
            if found is None:
                held[path] = [key, 1, [str(key)]]
                size += len(path) + 200
            else:
                found[1] += 1
                found[2].append(str(key))
                size += 80
            if size > HELD_BYTES:
                yield list(held), list(held.values())
                held, size = {}, 0
    if held:
        yield list(held), list(held.values())


def _record(columns: list, names: list[str]) -> pa.RecordBatch:
    kinds = {"path": pa.string(), "ids": pa.string(), "ends": pa.string()}
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds.get(n, pa.int64())) for n, c in zip(names, columns, strict=True)], names=names
    )


class TernaryTree:
    """Sequences of codes; node 0 is the root of the trie, every other node the end of a prefix.

    ``low`` and ``high`` lead to siblings, ``inside`` to the first of a node's children (in the
    tree over them), ``above`` to the prefix one code shorter.
    """

    def __init__(self):
        self.code, self.low, self.high, self.inside, self.above = [-1], [0], [0], [0], [0]

    def insert(self, codes: list[int]) -> list[int]:
        """The nodes of the sequence's prefixes, the root first."""
        path, node = [0], 0
        for code in codes:
            link, at, place = self.inside, self.inside[node], node
            while at and self.code[at] != code:
                place, link = at, self.low if code < self.code[at] else self.high
                at = link[at]
            if not at:
                at = link[place] = len(self.code)
                for column, value in ((self.code, code), (self.low, 0), (self.high, 0), (self.inside, 0), (self.above, node)):
                    column.append(value)
            path.append(at)
            node = at
        return path


def middle_first(count: int) -> Iterator[int]:
    """0 to count - 1: the middle, then those of both halves, and so on."""
    waiting = [(0, count)]
    for low, high in waiting:
        if low < high:
            middle = (low + high) // 2
            yield middle
            waiting += [(low, middle), (middle + 1, high)]


_NODE = (
    "range int, boundary boolean, key string, parent_key string, depth long, conv_id long, parent_conv_id long,"
    " n_convs long, n_children long, n_leaves long, saved long, bytes long, ends string"
)
_NODE_NAMES = [part.split()[0] for part in _NODE.split(", ")]


def range_nodes(paths: list[bytes], ids: list[int], counts: list[int], ends: list[str], number: int) -> pa.RecordBatch:
    """The trie nodes of one range of sorted distinct paths.

    A boundary node has only what hangs below it off the boundary: children, leaves, savings.
    """
    tokens = [np.frombuffer(p, f"S{TOKEN}") for p in paths]
    dictionary, codes = np.unique(np.concatenate(tokens), return_inverse=True)
    lengths = [int(t[-8:], 16) for t in dictionary.tolist()]
    cuts = np.cumsum([len(t) for t in tokens])[:-1]
    coded = [part.tolist() for part in np.split(codes, cuts)]

    tree = TernaryTree()
    last_node, edges = {}, []
    for i in middle_first(len(coded)):
        path = tree.insert(coded[i])
        last_node[path[-1]] = i
        if i in (0, len(coded) - 1):
            edges.append((i, path))
    key: dict[int, str] = {}
    for i, path in edges:
        digest = hashlib.sha256()
        for depth, node in enumerate(path):
            if depth:
                digest.update(paths[i][(depth - 1) * TOKEN : depth * TOKEN])
            key[node] = digest.hexdigest()

    total = len(tree.code)
    members, children, leaves, saved, depth = ([0] * total for _ in range(5))
    least = [1 << 63] * total
    for node in range(1, total):  # a prefix is older than what extends it
        depth[node] = depth[tree.above[node]] + 1
    for node in range(total - 1, -1, -1):
        i = last_node.get(node)
        if i is not None:
            members[node] += counts[i]
            least[node] = min(least[node], ids[i])
        above = tree.above[node]
        if node not in key:
            leaves[node] += not children[node]
            saved[node] += (members[node] - 1) * lengths[tree.code[node]]
            children[above] += 1
            leaves[above] += leaves[node]
            saved[above] += saved[node]
        if node:
            members[above] += members[node]
            least[above] = min(least[above], least[node])

    def up(node: int) -> int | None:
        return tree.above[node] if node else None

    nodes = range(total)
    parents = [up(n) for n in nodes]
    columns = [
        [number] * total, [n in key for n in nodes], [key.get(n) for n in nodes], [key.get(p) for p in parents], depth, least,
        [None if p is None or p in key else least[p] for p in parents], members, children, leaves, saved,
        [lengths[tree.code[n]] if n else 0 for n in nodes], [ends[last_node[n]] if n in last_node else None for n in nodes],
    ]
    kinds = [pa.int32(), pa.bool_(), pa.string(), pa.string(), *[pa.int64()] * 8, pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=_NODE_NAMES)


def trie(conversations: DataFrame, range_turns: int = RANGE_TURNS) -> DataFrame:
    """One row per distinct prefix of turns, the empty one included.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256):
    smallest member, turns, the parent's smallest member (null for the root), members, child
    nodes, childless nodes at or below, the bytes of last texts that all nodes at or below save
    by sharing, and the digest of the ids of the conversations that end here.

    Takes (conv_id, tokens) as :func:`sequences` and :func:`borrowed` give them. Conversations
    without turns are members of the root; no conversation gives no node. Copies are one class
    before the ranges are cut, so neither a hot conversation nor a hot first turn fills a range.
    """
    whole = written(classes(conversations), "trie-classes")
    turns = whole.agg(F.sum(F.length("path"))).first()[0]
    ranges = max(1, -(-int(turns or 0) // (TOKEN * range_turns)))

    def run(batches):
        held: list[list] = [[], [], [], []]
        for batch in batches:
            for column, name in zip(held, ("path", "conv_id", "n", "ends"), strict=True):
                column += batch.column(name).to_pylist()
        if held[0]:
            paths = [p.encode() for p in held[0]]
            yield range_nodes(paths, *held[1:], TaskContext.get().partitionId())

    ranged = whole.repartitionByRange(ranges, "path").sortWithinPartitions("path")
    nodes = written(ranged.mapInArrow(run, _NODE), "trie-nodes")
    shared = _merged(nodes.where("boundary"))

    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    digest = F.coalesce("ends", F.lit(NO_IDS)).alias("ends_sha256")
    parents = shared.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent"))
    top = shared.join(parents, "parent_key", "left").select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), digest,
    )
    # A child asks its own range for the parent: a prefix with very many children is in many ranges.
    own = nodes.where("boundary").select("range", "key").join(shared.select("key", "conv_id"), "key")
    own = own.select("range", F.col("key").alias("parent_key"), F.col("conv_id").alias("parent"))
    rest = nodes.where("NOT boundary").withColumnRenamed("saved", "saved_tokens").withColumn("ends_sha256", digest)
    inner = rest.where("parent_key IS NULL").select(names)
    outer = rest.where("parent_key IS NOT NULL").join(own, ["range", "parent_key"])
    outer = outer.withColumn("parent_conv_id", F.col("parent")).select(names)
    return top.select(names).unionByName(inner).unionByName(outer)


def _merged(partial: DataFrame) -> DataFrame:
    """Boundary nodes added up across ranges and, for leaves and savings, over all below them."""
    summed = partial.groupBy("key", "parent_key", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.max("bytes").alias("bytes"), F.max("ends").alias("ends"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")),
    )
    summed = written(summed, "trie-boundary")
    below = summed.groupBy("parent_key").agg(F.count(F.lit(1)).alias("more")).withColumnRenamed("parent_key", "key")
    whole = summed.join(below, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0))).drop("more")
    whole = whole.withColumns({
        "n_leaves": F.col("n_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0),
        "saved": F.col("saved") + (F.col("n_convs") - 1) * F.col("bytes"),
    })
    whole = written(whole, "trie-boundary")
    # Each round adds what lies within reach below the ancestor at that distance, then doubles it.
    reach = whole.select("key", F.col("parent_key").alias("far"), "n_leaves", "saved")
    deepest = whole.agg(F.max("depth")).first()[0] or 0
    for _ in range(int(deepest).bit_length()):
        more = reach.where("far IS NOT NULL").groupBy(F.col("far").alias("key")).agg(
            F.sum("n_leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
        )
        further = reach.select(F.col("key").alias("far"), F.col("far").alias("further"))
        reach = reach.join(more, "key", "left").join(further, "far", "left").select(
            "key", F.col("further").alias("far"), (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
        )
        reach = written(reach, "trie-boundary")
    return written(whole.drop("n_leaves", "saved").join(reach.drop("far"), "key"), "trie-boundary")


SQL = """
WITH own AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST,
    md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS s
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), borrowing AS (
  SELECT conv_id, s, (xor(4294967295, list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
    lambda a, b: list_reduce(range(8), lambda r, i: xor(r >> 1, 3988292384 * (r & 1)), xor(a, b)), 4294967295::BIGINT)) % 9) AS h
  FROM own
), whole AS (
  SELECT b.conv_id, list_concat(coalesce(l.s[1:h], []), b.s[h + 1:]) AS s
  FROM borrowing b LEFT JOIN own l ON l.conv_id = b.conv_id - b.conv_id % 5
), members AS (
  SELECT conv_id, len(s) AS n, d, s[1:d] AS p FROM whole, LATERAL unnest(range(0, len(s) + 1)) AS u(d)
), nodes AS (
  SELECT d, p, min(conv_id) AS conv_id, count(*) AS n_convs, CASE WHEN d > 0 THEN strlen(p[d].t) ELSE 0 END AS bytes,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
  FROM members GROUP BY d, p
), kids AS (SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL
), below AS (
  SELECT a AS d, n.p[1:a] AS p, sum((n.n_convs - 1) * n.bytes) AS saved_tokens, count(*) FILTER (k.p IS NULL) AS n_leaves
  FROM nodes n LEFT JOIN kids k ON k.p = n.p AND k.d = n.d, LATERAL unnest(range(0, n.d + 1)) AS u(a) GROUP BY ALL
)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
  coalesce(k.n_children, 0)::BIGINT AS n_children, b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.p = n.p AND b.d = n.d LEFT JOIN kids k ON k.p = n.p AND k.d = n.d
LEFT JOIN nodes p ON p.d = n.d - 1 AND p.p = n.p[1:n.d - 1]
"""


@check(SQL)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(borrowed(sequences(table(spark, sf_dir, "conversations"))))
