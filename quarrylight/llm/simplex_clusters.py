"""Exact integer k-means in which n-simplex projections decide most assignments.

Pivots are a few centroids of earlier rounds. With the distances of a point to all pivots,
the point is the apex of a simplex whose base are the pivots: its first coordinates place
its foot in the pivots' space, the last is its height above it. For two points the
Euclidean distance of their apices is a lower bound of their true distance, and the distance
with one apex turned below the base is an upper bound. The bounds of a vector and a
centroid differ by four times the product of their heights, so they are the tighter the
closer the centroids are to the pivots' space. Apices of the vectors are kept beside them;
each round builds the apices of the centroids, drops for each vector the centroids whose
lower bound lies above the smallest upper bound, and compares the others by exact integer
distances. Once that takes more than half of all distances, the present centroids become
pivots, which costs one distance to each and leaves bounds that coincide. Bounds are widened
by far more than the rounding of their sums, so no centroid is dropped wrongly, and a
vector left with one centroid needs no distance at all until the last round.

Only k x d sums leave the tasks: each task adds up its vectors per centroid, Spark adds the
tasks' sums, and the driver gets k rows a round. Vectors are never shuffled, so a vector in
a third of all rows costs nothing more than its bytes. Rounds read a table in the shared
folder, from which lost tasks are repeated.

Results in special cases: rows with a null, an empty array, another number of components or
a null, infinite or undefined component are left out; repeated ids are separate vectors, tied
start vectors count in the order of their components, a null id comes last; with fewer kept
vectors than k there are as many centroids as vectors; an empty table gives no rows. Scaled
components beyond 2^27 count as 2^27, so that every squared distance fits a long. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrylight.functions.batches import map_batches
from quarrylight.functions.vectors import from_matrix, to_matrix
from quarrylight.llm.common import staged, table

CLUSTERS, ROUNDS, WIDTH, SCALE = 8, 10, 64, 1024
#: Share of all distances from which on a round asks for new pivots.
RENEW = 0.5
SALT = "3:"
_LIMIT = 1 << 27
#: A pivot this close to the space of the earlier ones, by squared height over squared distance, adds nothing.
_FLAT = 1e-4
#: Bounds are widened by this share of the squared distances to the first pivot.
_SLACK = 1e-7


@dataclass(frozen=True)
class Simplex:
    """The base of the projection: pivots (integers) and the triangular coordinates of their simplex."""

    pivots: np.ndarray
    base: np.ndarray

    @classmethod
    def build(cls, vectors: np.ndarray) -> Simplex:
        """A base from the vectors that stand out of the space of the ones before."""
        kept, rows = [0], []
        for i in range(1, len(vectors)):
            edges = (vectors[[*kept[1:], i]] - vectors[0]).astype(np.float64)
            foot = np.linalg.solve(np.array(rows), edges[:-1] @ edges[-1]) if rows else np.zeros(0)
            square = edges[-1] @ edges[-1]
            height = square - foot @ foot
            if square > 0 and height > _FLAT * square:
                rows = [np.append(r, 0.0) for r in rows] + [np.append(foot, np.sqrt(height))]
                kept.append(i)
        return cls(vectors[kept], np.array(rows).reshape(len(kept) - 1, len(kept) - 1))

    def distances(self, vectors: np.ndarray) -> np.ndarray:
        """Exact squared distances to the pivots."""
        return np.stack([((vectors - p) ** 2).sum(axis=1) for p in self.pivots], axis=1)

    def apices(self, squares: np.ndarray) -> np.ndarray:
        """Coordinates from squared distances to the pivots: foot, then height."""
        first = squares[:, :1].astype(np.float64)
        edges = (self.base**2).sum(axis=1)
        inner = (first + edges - squares[:, 1:]) / 2.0
        foot = np.linalg.solve(self.base, inner.T).T if len(self.base) else inner
        height = np.sqrt(np.maximum(first[:, 0] - (foot * foot).sum(axis=1), 0.0))
        return np.column_stack([foot, height])


def _bounds(points: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distances between points and centres, from their apices."""
    foot = (points[:, None, :-1] - centers[None, :, :-1]) ** 2
    foot = foot.sum(axis=2)
    slack = _SLACK * ((points**2).sum(axis=1)[:, None] + (centers**2).sum(axis=1)[None, :]) + 1.0
    low = foot + (points[:, None, -1] - centers[None, :, -1]) ** 2 - slack
    return low, foot + (points[:, None, -1] + centers[None, :, -1]) ** 2 + slack


def nearest(vectors: np.ndarray, points: np.ndarray, centers: np.ndarray, apices: np.ndarray) -> tuple[np.ndarray, int]:
    """The nearest centre of each vector, the lower number on ties, and how many distances that took."""
    low, high = _bounds(points, apices)
    possible = low <= high.min(axis=1, keepdims=True)
    several = np.flatnonzero(possible.sum(axis=1) > 1)
    cluster = possible.argmax(axis=1)
    row, center = np.nonzero(possible[several])
    square = np.full((len(several), len(centers)), np.iinfo(np.int64).max)
    square[row, center] = ((vectors[several[row]] - centers[center]) ** 2).sum(axis=1)
    cluster[several] = square.argmin(axis=1)
    return cluster, len(row)


def _scaled(column: pa.Array, width: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that are kept, and floor(scale * x) of their components."""
    sized = pc.fill_null(pc.equal(pc.list_value_length(column), width), False).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(sized)
    values = pc.cast(column.take(pa.array(at)).flatten(), pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, width)
    fine = np.isfinite(values).all(axis=1)
    return at[fine], np.clip(np.floor(values[fine] * scale), -_LIMIT, _LIMIT).astype(np.int64)


def scaled(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """``id`` and the integer ``vector`` of the kept rows."""
    source = df.select(F.col(id_col).alias("id"), F.col(vector).alias("vector"))
    schema = T.StructType([T.StructField("id", source.schema["id"].dataType), T.StructField("vector", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, whole = _scaled(batch.column("vector"), width, scale)
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(at)), from_matrix(whole)], names=["id", "vector"])

    return map_batches(source, run, schema)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _first(vectors: DataFrame, count: int) -> np.ndarray:
    """The ``count`` vectors with the smallest digests of their ids."""
    digest = F.sha2(F.concat(F.lit(SALT), F.col("id").cast("string")), 256)
    found = vectors.select(digest.alias("digest"), "vector").orderBy(F.asc_nulls_last("digest"), "vector").limit(count).collect()
    return np.array([r["vector"] for r in found], np.int64)


def _projected(vectors: DataFrame, simplex: Simplex) -> DataFrame:
    """Beside each vector its apex, from the distances to the pivots."""
    fields = [*vectors.schema.fields, T.StructField("apex", T.ArrayType(T.DoubleType()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                apices = simplex.apices(simplex.distances(_matrix(batch.column("vector"))))
                yield pa.RecordBatch.from_arrays([*batch.columns, from_matrix(apices)], names=["id", "vector", "apex"])

    return map_batches(vectors, run, T.StructType(fields))


def _sums(projected: DataFrame, simplex: Simplex, centers: np.ndarray) -> DataFrame:
    """cluster, n, sums: one row per centre and task, added up by Spark; ``compared`` counts exact distances."""
    k, width = centers.shape
    apices = simplex.apices(simplex.distances(centers))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total, compared = np.zeros(k, np.int64), np.zeros((k, width), np.int64), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column("vector"))
            cluster, took = nearest(vectors, to_matrix(batch.column("apex")), centers, apices)
            compared += took
            for c in np.unique(cluster):
                mine = vectors[cluster == c]
                count[c] += len(mine)
                total[c] += mine.sum(axis=0)
        share = np.zeros(k, np.int64)
        share[0] = compared
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(k, dtype=np.int32)), pa.array(count), from_matrix(total), pa.array(share)],
            names=["cluster", "n", "sums", "compared"],
        )

    parts = map_batches(projected.select("vector", "apex"), partial, "cluster int, n long, sums array<long>, compared long")
    return parts.groupBy("cluster").agg(
        F.sum("n").alias("n"),
        F.array(*[F.sum(F.col("sums")[i].cast("decimal(38,0)")) for i in range(width)]).alias("sums"),
        F.sum("compared").alias("compared"),
    )


@dataclass(frozen=True)
class Clustering:
    """Final centroids, the vectors with their apices, and the share of distances each round took."""

    centers: np.ndarray
    simplex: Simplex | None
    projected: DataFrame
    compared: tuple[float, ...]

    def assign(self) -> DataFrame:
        """id, cluster and squared distance of every vector."""
        id_type = self.projected.schema["id"].dataType
        schema = T.StructType([T.StructField("id", id_type), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
        centers, simplex = self.centers, self.simplex
        if simplex is None:
            return self.projected.sparkSession.createDataFrame([], schema)
        apices = simplex.apices(simplex.distances(centers))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    vectors = _matrix(batch.column("vector"))
                    cluster, _ = nearest(vectors, to_matrix(batch.column("apex")), centers, apices)
                    square = ((vectors - centers[cluster]) ** 2).sum(axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id"), pa.array(cluster.astype(np.int32)), pa.array(square)], names=["id", "cluster", "distance"]
                    )

        return map_batches(self.projected, run, schema)


def fit(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, renew: float = RENEW) -> Clustering:
    """``rounds`` rounds of integer k-means over (id, vector), from the first ``k`` vectors by digest.

    The apices of the last pivots stay persisted until the caller unpersists ``projected``.
    """
    vectors = staged(vectors, "vectors")
    centers = _first(vectors, k)
    if not len(centers):
        return Clustering(np.zeros((0, 0), np.int64), None, vectors, ())
    simplex, projected, compared = None, None, [1.0]
    for _ in range(rounds):
        if compared[-1] > renew:
            earlier = simplex.pivots[:k] if simplex else centers[:0]
            simplex = Simplex.build(np.concatenate([centers, earlier]))
            if projected:
                projected.unpersist()
            projected = _projected(vectors, simplex).persist(StorageLevel.MEMORY_AND_DISK)
        found = _sums(projected, simplex, centers).collect()
        compared.append(sum(r["compared"] for r in found) / (sum(r["n"] for r in found) * len(centers)))
        for r in found:
            if r["n"]:
                centers[r["cluster"]] = [int(s) // r["n"] for s in r["sums"]]
    return Clustering(centers, simplex, projected, tuple(compared[1:]))


def report(clustering: Clustering) -> DataFrame:
    """Per vector its cluster and distance, the inertia of both, and the digest of its centroid."""
    spark = clustering.projected.sparkSession
    assigned = staged(clustering.assign(), "assigned")
    clustering.projected.unpersist()
    inertia = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    # k rows from here on
    names = [(c, ",".join(map(str, center.tolist()))) for c, center in enumerate(clustering.centers)]
    texts = spark.createDataFrame(names, "cluster int, components string")
    total = inertia.agg(F.sum("cluster_inertia").alias("inertia"))
    described = inertia.join(texts, "cluster").crossJoin(total).withColumn("centroid_sha256", F.sha2("components", 256))
    return assigned.join(F.broadcast(described.drop("components")), "cluster").select(
        "id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = report(fit(scaled(table(spark, sf_dir, "embeddings"))))
    return found.withColumnRenamed("id", "vec_id")


def _round_sql(number: int) -> str:
    """One round: assign to the centres of the round before, then their exact floored means."""
    return f"""
a{number} AS (SELECT v.vec_id, v.x, arg_min(c.c, ({_distance("v.x", "c.x")}, c.c)) AS c FROM v, c{number - 1} c GROUP BY v.vec_id, v.x),
m{number} AS (SELECT c, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM a{number}, range(1, {WIDTH + 1}) r(i) GROUP BY c, i),
n{number} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM m{number} GROUP BY c),
c{number} AS (SELECT o.c, coalesce(n.x, o.x) AS x FROM c{number - 1} o LEFT JOIN n{number} n USING (c))"""


def _distance(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"


SQL = f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda e: floor({SCALE} * e::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = {WIDTH} AND list_bool_and(list_transform(embedding, lambda e: coalesce(isfinite(e), false)))),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('{SALT}' || vec_id)) - 1 AS c, x FROM v
  ORDER BY sha256('{SALT}' || vec_id) LIMIT {CLUSTERS}),
{",".join(_round_sql(i) for i in range(1, ROUNDS + 1))},
d AS MATERIALIZED (
  SELECT v.vec_id, unnest(arg_min({{'c': c.c, 'd': {_distance("v.x", "c.x")}, 'x': c.x}}, ({_distance("v.x", "c.x")}, c.c))) FROM v, c{ROUNDS} c GROUP BY v.vec_id)
SELECT vec_id, c::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(x, ',')) AS centroid_sha256
FROM d
"""
