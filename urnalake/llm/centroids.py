"""Centroid clustering by a tournament of bisectors, in whole numbers.

Between two centroids a and b (a has the smaller number) lies the plane of the points equally far
from both: 2 x (b - a) = |b|² - |a|². Its normal 2 (b - a) and threshold |b|² - |a|² are made
once per pair. The sign of x · normal - threshold tells which one loses; zero favours the smaller
number. A vector's first champion is centroid 0, the others challenge in turn, so k - 1 sign tests
find its nearest centroid. Only the winner's distance is computed, from the components.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urnalake.checks.registry import check
from urnalake.llm.common import ship, table, written

CLUSTERS = 40
ROUNDS = 5
DIMENSIONS = 64
SCALE = 256
SEED = 2
#: Components are at most so large, whichever sign: then 64-bit tests and distances of up to
#: MOST_DIMENSIONS components are exact. A larger one raises.
MOST = 1 << 27
MOST_DIMENSIONS = 64
#: Vectors that are tested side by side.
SIDE_BY_SIDE = 4096


def sound(vector: Column, dimensions: int) -> Column:
    """Whether a vector has exactly so many components, none null or non-finite."""
    inside = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce((F.size(vector) == dimensions) & inside, F.lit(False))


def whole(vector: Column, scale: int) -> Column:
    """floor(scale * x) per component of a sound vector; beyond MOST it raises."""
    return F.transform(vector, lambda x: _checked(F.floor(x.cast("double") * scale)))


def _checked(component: Column) -> Column:
    complaint = F.lit(f"a component is beyond {MOST}: distances might not fit 64 bits")
    return F.when(F.abs(component) <= MOST, component.cast("int")).otherwise(F.raise_error(complaint).cast("int"))


def bisectors(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normals and thresholds: [a, b] belongs to centroids a < b."""
    lengths = (centroids**2).sum(1)
    return 2 * (centroids[None, :, :] - centroids[:, None, :]), lengths[None, :] - lengths[:, None]


def winners(vectors: np.ndarray, normals: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """The number of each vector's nearest centroid, after k - 1 sign tests."""
    champion = np.zeros(len(vectors), np.int64)
    for challenger in range(1, len(thresholds)):
        side = np.einsum("ij,ij->i", vectors, normals[champion, challenger]) - thresholds[champion, challenger]
        champion[side > 0] = challenger
    return champion


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray, planes: tuple[np.ndarray, np.ndarray]):
    """Pieces of a batch: (rows, vectors, winners)."""
    column, dimensions = batch.column("v"), centroids.shape[1]
    for begin in range(0, batch.num_rows, SIDE_BY_SIDE):
        part = column.slice(begin, SIDE_BY_SIDE)
        vectors = part.flatten().to_numpy().reshape(len(part), dimensions).astype(np.int64)
        yield batch.slice(begin, len(part)), vectors, winners(vectors, *planes)


def _sums(vectors: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Per cluster its number of vectors and their componentwise sum; empty clusters are absent."""

    def run(batches):
        planes = bisectors(centroids)
        counts, sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            for _, some, cluster in _assigned(batch, centroids, planes):
                counts += np.bincount(cluster, minlength=len(centroids))
                np.add.at(sums, cluster, some)
        used = np.flatnonzero(counts)
        wide = np.column_stack([counts[used], sums[used]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, wide.shape[1])), pa.array(np.tile(np.arange(wide.shape[1]), len(used))), pa.array(wide.ravel())],
            names=["cluster", "place", "part"],
        )

    parts = vectors.select("v").mapInArrow(run, "cluster long, place long, part long")
    # k * (dimensions + 1) rows at most, whatever the number of vectors.
    rows = parts.groupBy("cluster", "place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()
    found: dict[int, dict[int, Decimal]] = {}
    for row in rows:
        found.setdefault(row["cluster"], {})[row["place"]] = row["total"]
    return {c: (int(p[0]), [int(p[i]) for i in range(1, len(p))]) for c, p in found.items()}


def first_centroids(vectors: DataFrame, k: int, seed: int, dimensions: int) -> np.ndarray:
    """The k vectors with the smallest hex SHA-256 of ``seed:id``, in that order; all if fewer."""
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    rows = vectors.orderBy(rank.asc_nulls_last(), "id", "v").select("v").limit(k).collect()
    return np.array([row["v"] for row in rows], np.int64).reshape(len(rows), dimensions)


def fitted(vectors: DataFrame, k: int, rounds: int, seed: int, dimensions: int) -> np.ndarray:
    """The centroids after so many rounds. Only k sums per round come to the driver."""
    centroids = first_centroids(vectors, k, seed, dimensions)
    for _ in range(rounds):
        for cluster, (count, sums) in _sums(vectors, centroids).items():
            centroids[cluster] = [total // count for total in sums]
    return centroids


def clustered(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED,
) -> tuple[DataFrame, np.ndarray]:
    """((id, cluster, distance) per vector, the final centroids).

    Vectors that are null, have another number of components, or hold a null or non-finite one
    are left out. Components become floor(scale * x); one beyond MOST raises, as distances then
    might not fit a long. Equal distances go to the smaller centroid number. Repeated rows each
    count and each get a row. Null ids are clustered, but come last as first centroids; equal
    hashes go by id and components. Fewer vectors than k make fewer centroids; equal centroids
    leave the later one empty, and it stays where it is. An empty table has no rows and no
    centroids. Other columns are ignored. No step shuffles vectors, so copies gather nowhere.
    """
    if dimensions > MOST_DIMENSIONS:
        raise ValueError(f"distances of more than {MOST_DIMENSIONS} components might not fit 64 bits")
    ship(df.sparkSession)
    own = df.select(F.col(key).alias("id"), F.col(vector).alias("v")).where(sound(F.col("v"), dimensions))
    vectors = written(own.select("id", whole(F.col("v"), scale).alias("v")), "centroids-vectors")
    centroids = fitted(vectors, k, rounds, seed, dimensions)
    id_type = vectors.schema["id"].dataType.simpleString()

    def run(batches):
        planes = bisectors(centroids)
        for batch in batches:
            for rows, some, cluster in _assigned(batch, centroids, planes):
                distance = ((some - centroids[cluster]) ** 2).sum(1)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["id", "cluster", "distance"]
                )

    rows = vectors.mapInArrow(run, f"id {id_type}, cluster int, distance long")
    return rows.withColumnRenamed("id", key), centroids


def with_inertia(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``rows`` with the summed distances of their cluster and of all, and their centroid's digest."""
    spark = rows.sparkSession
    rows = written(rows, "centroids-assigned")
    sums = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum"))
    sums = {row["cluster"]: int(row["sum"]) for row in sums.collect()}  # k rows at most
    total = sum(sums.values())
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    known = [(c, s, total, digests[c]) for c, s in sums.items()]
    facts = spark.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(facts), "cluster")  # k rows


_WHOLE_SQL = """
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""
_ROUND_SQL = """
, a{0} AS MATERIALIZED (
  SELECT id, v, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT i.id, i.v, m.c, list_inner_product(i.v, i.v) - 2 * list_inner_product(i.v, m.v) + list_inner_product(m.v, m.v) AS d
    FROM items i CROSS JOIN c{0} m
  ) GROUP BY id, v
), c{1} AS MATERIALIZED (
  SELECT m.c, coalesce(n.v, m.v) AS v FROM c{0} m LEFT JOIN (
    SELECT c, list(s ORDER BY i) AS v FROM (
      SELECT c, i, floor(sum(v[i]) / count(*)) AS s FROM a{0}, range(1, 65) AS r(i) GROUP BY c, i
    ) GROUP BY c
  ) n ON n.c = m.c
)"""

SQL = f"""
WITH items AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY vec_id, v) AS id FROM ({_WHOLE_SQL})
), c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY h NULLS LAST, vec_id, v) - 1)::INTEGER AS c, v
  FROM (SELECT *, sha256('2:' || vec_id::VARCHAR) AS h FROM items)
  QUALIFY c < 40
){"".join(_ROUND_SQL.format(i, i + 1) for i in range(6))}
SELECT i.vec_id, a.c AS cluster, a.d::BIGINT AS distance, sum(a.d) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia,
  sum(a.d) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(list_transform(m.v, lambda x: x::BIGINT::VARCHAR), ',')) AS centroid_sha256
FROM a5 a JOIN items i USING (id) JOIN c5 m ON m.c = a.c
"""


@check(SQL)
def op11_bisector_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, centroids = clustered(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return with_inertia(rows, centroids)
