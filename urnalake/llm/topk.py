"""Exact top-k search by pivot-table elimination.

The distances of every vector to a set of pivots are computed once. For a query and a candidate,
the largest difference of their distances to the same pivot is a lower bound of their distance,
hence an upper bound of their inner product. Candidates are evaluated in the order of the bound
until no bound left reaches the k-th best score.

For the inner product to be a matter of distance, vectors get one more component that makes all
candidates equally long; queries get a zero there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from urnalake.checks.registry import check
from urnalake.llm.common import ship, table, written

#: Pivots: the vectors with the smallest hashes of their ids, so a bounded sample.
PIVOTS = 32
#: Vectors and queries that meet in one task.
CANDIDATE_BLOCK = 16_384
QUERY_BLOCK = 2_048
#: Candidates evaluated between two looks at the bound.
STEP = 256


def whole_components(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) per component; null where the vector is null or has a null or non-finite one.

    A whole number that does not fit 64 bits raises.
    """
    wide = F.transform(vector, lambda x: x.cast("double"))
    sound = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    complaint = F.raise_error(F.lit("a component does not fit 64 bits")).cast("bigint")
    return F.when(sound, F.transform(wide, lambda x: F.when(F.abs(x * scale) < 2.0**62, F.floor(x * scale)).otherwise(complaint)))


def pivot_table(vectors: DataFrame, pivots: int = PIVOTS) -> dict[int, np.ndarray]:
    """Per dimension ``pivots`` vectors at most, as a matrix on the driver."""
    rank = F.row_number().over(Window.partitionBy("dim").orderBy(F.xxhash64("id"), "id"))
    rows = vectors.select("dim", "v", rank.alias("rank")).where(F.col("rank") <= pivots).collect()
    table_of: dict[int, list] = {}
    for row in rows:
        table_of.setdefault(row["dim"], []).append(row["v"])
    return {dim: np.array(v, np.float64).reshape(len(v), dim) for dim, v in table_of.items()}


def _distances(points: np.ndarray, extra: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of points with a further component to pivots with a zero there."""
    squared = (points**2).sum(1)[:, None] + (extra**2)[:, None] + (pivots**2).sum(1)[None, :] - 2 * points @ pivots.T
    return np.sqrt(np.maximum(squared, 0.0))


def search_block(queries: np.ndarray, query_ids, vectors: np.ndarray, ids, pivots: np.ndarray, k: int) -> Iterator[tuple]:
    """(query id, vector id, score) of each query's k best in this block, ties to smaller ids.

    A vector is no candidate of the query that has its id.
    """
    if not len(vectors) or not len(queries):
        return
    largest = [float(np.abs(a.astype(np.float64)).max(initial=0.0)) for a in (queries, vectors)]
    if largest[0] * largest[1] * vectors.shape[1] >= 2.0**63:
        raise OverflowError("a score might not fit 64 bits")
    order = np.argsort(ids, kind="stable")
    vectors, ids = vectors[order], ids[order]
    as_float = vectors.astype(np.float64)
    lengths = (as_float**2).sum(1)
    longest = lengths.max()
    table_of = _distances(as_float, np.sqrt(longest - lengths), pivots)
    query_table = _distances(queries.astype(np.float64), np.zeros(len(queries)), pivots)
    own_lengths = (queries.astype(np.float64) ** 2).sum(1)
    for q, own in enumerate(query_ids):
        bound = np.abs(table_of - query_table[q]).max(1)
        # Rounding must not eliminate a vector that reaches the score exactly.
        limit = (own_lengths[q] + longest - bound**2) / 2 + 1e-6 * (1 + own_lengths[q] + longest)
        by_bound = np.argsort(-limit, kind="stable")
        best_scores, best_ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for begin in range(0, len(by_bound), STEP):
            if len(best_ids) == k and limit[by_bound[begin]] < best_scores[-1]:
                break
            some = by_bound[begin : begin + STEP]
            some = some[ids[some] != own]
            scores = np.concatenate([best_scores, vectors[some] @ queries[q]])
            found = np.concatenate([best_ids, ids[some]])
            keep = np.lexsort((found, -scores))[:k]
            best_scores, best_ids = scores[keep], found[keep]
        yield from zip([own] * len(best_ids), best_ids.tolist(), best_scores.tolist(), strict=True)


def nearest(candidates: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): each query's k highest inner products, all if fewer.

    Both tables have (id, integer vector); scores are exact integers, ties go to smaller ids. A
    query meets every vector of its dimension except those with its id; one of another dimension
    has no score with it. Null vectors, vectors with null components and null ids take no part;
    repeated candidates are candidates each; a repeated query counts once; an id with several
    vectors is ranked by each of them. Queries without candidates have no rows, nor has an empty
    table. Where components are so large that a score might not fit 64 bits, it raises.

    Queries and candidates are dealt into blocks by their ids' hash, so equal vectors or a hot
    value do not gather anywhere; each pair of blocks is a task that returns k rows per query.
    """
    ship(candidates.sparkSession)

    def tidy(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<bigint>").alias("v"))
        return rows.where("id IS NOT NULL AND v IS NOT NULL AND NOT exists(v, x -> x IS NULL)").withColumn(
            "dim", F.size("v")
        )

    vectors, asked = tidy(candidates), tidy(queries).distinct()
    vectors, asked = written(vectors, "topk-vectors"), written(asked, "topk-queries")
    pivots = candidates.sparkSession.sparkContext.broadcast(pivot_table(vectors))
    spread = 2 * candidates.sparkSession.sparkContext.defaultParallelism
    vector_blocks = max(spread, -(-vectors.count() // CANDIDATE_BLOCK))
    query_blocks = max(1, -(-asked.count() // QUERY_BLOCK))

    def dealt(df: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        placed = df.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    left = dealt(asked, "qb", query_blocks, "vb", vector_blocks)
    right = dealt(vectors, "vb", vector_blocks, "qb", query_blocks)
    columns = ["query_id", "id", "score"]

    def search(group: tuple, some: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        dim = int(group[0])
        if not len(some) or not len(block):
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in columns})
        queries_in, vectors_in = (np.array(d["v"].tolist(), np.int64).reshape(len(d), dim) for d in (some, block))
        rows = search_block(
            queries_in, some["id"].tolist(), vectors_in, block["id"].to_numpy(), pivots.value[dim], k
        )
        return pd.DataFrame(list(rows), columns=columns).astype(np.int64)

    keys = ["dim", "qb", "vb"]
    part = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(search, "query_id long, id long, score long")
    # k rows per query and block; the best per query are kept per task before they meet.
    rank = _ranked("query_id")
    return part.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def _ranked(query: str) -> Column:
    return F.row_number().over(Window.partitionBy(query).orderBy(F.desc("score"), "id"))


SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), asked AS (SELECT DISTINCT vec_id, v FROM whole WHERE vec_id % 50 = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM asked q JOIN whole c ON q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@check(SQL)
def op10_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", whole_components(F.col("embedding")).alias("embedding"))
    return nearest(rows, rows.where("vec_id % 50 = 0"), 5).withColumnRenamed("id", "vec_id")
