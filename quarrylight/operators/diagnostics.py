"""Samples, certainty, silhouette, cluster profiles and boundary documents."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.batches import add_columns
from ..functions.vectors import VECTOR, argmax, as_vector, from_matrix, pair_distances, second_largest, to_matrix
from ..session import scratch_path, ship

# Limits of the certainty report.
HIGH_CERTAINTY = 0.8
DUAL_MEMBERSHIP = 0.15
# A block of a silhouette in bytes: its points, and their sums by cluster.
SILHOUETTE_BLOCK_BYTES = 32 << 20
# Rows of one block that are compared with rows of another at a time.
_STRIP, _SPAN = 256, 4096


def row_sample(df: DataFrame, size: int, seed: int = 42, id_col: str = "id") -> DataFrame:
    """``size`` rows without replacement: those with the lowest md5(seed:id).

    The digest spreads ids evenly, so rows above a cut a little beyond the wanted
    share are dropped where they are read and the final sort sees about ``size``
    rows, however large the table. Should the cut leave too few, it is not used.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    keyed = df.withColumn("_key", key)
    n = df.count()
    share = (size + 10.0 * math.sqrt(size) + 100.0) / max(n, 1)
    if share < 0.5:
        near = keyed.filter(F.col("_key") < f"{int(share * 16**12):012x}")
        if near.count() >= size:
            keyed = near
    return keyed.orderBy("_key", id_col).limit(size).drop("_key")


def hard_assignment(df: DataFrame, membership: str = "membership") -> DataFrame:
    """Add ``cluster``, the position of the largest membership."""
    return df.withColumn("cluster", argmax(F.col(membership)))


def certainty_metrics(df: DataFrame, membership: str = "membership") -> DataFrame:
    """One row: mean certainty, share of high certainty, share of dual membership."""
    u = df.select(
        F.array_max(membership).alias("top"), second_largest(F.col(membership)).alias("second")
    )
    return u.agg(
        F.count("*").alias("n"),
        F.avg("top").alias("mean_certainty"),
        F.avg((F.col("top") > HIGH_CERTAINTY).cast("double")).alias("pct_high_certainty"),
        F.avg("second").alias("mean_second"),
        F.avg(F.coalesce(F.col("second") > DUAL_MEMBERSHIP, F.lit(False)).cast("double")).alias(
            "frac_dual_membership"
        ),
    )


@dataclass(frozen=True)
class _Labellings:
    """Side by side, the clusters of several labellings: names, sizes and first columns."""

    names: tuple[np.ndarray, ...]
    counts: tuple[np.ndarray, ...]

    @property
    def firsts(self) -> np.ndarray:
        return np.cumsum([0] + [len(n) for n in self.names])

    def columns(self, labels: np.ndarray) -> np.ndarray:
        """The column of each row's cluster in each labelling."""
        return np.stack([np.searchsorted(n, labels[:, j]) + first for j, (n, first) in enumerate(zip(self.names, self.firsts))], axis=1)

    def indicator(self, labels: np.ndarray) -> np.ndarray:
        member = np.zeros((len(labels), int(self.firsts[-1])))
        np.put_along_axis(member, self.columns(labels), 1.0, axis=1)
        return member

    def scores(self, labels: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """The silhouette of each row in each labelling, from its sums of distances to all clusters."""
        out = np.zeros(labels.shape)
        at = np.arange(len(labels))
        for j, (counts, first, home) in enumerate(zip(self.counts, self.firsts, self.columns(labels).T)):
            total, home = sums[:, first:first + len(counts)], home - first
            inner = total[at, home] / np.maximum(counts[home] - 1, 1)
            mean = total / counts
            mean[at, home] = np.inf
            outer = mean.min(axis=1)
            top = np.maximum(inner, outer)
            fair = (counts[home] > 1) & np.isfinite(outer) & (top > 0)
            out[fair, j] = (outer[fair] - inner[fair]) / top[fair]
        return out


def _label_matrix(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def _tile(known: _Labellings, pairs: pa.Table) -> pa.Table:
    """Sums of distances by cluster for the rows of two blocks, or of one with itself."""
    pairs = pairs.combine_chunks()
    low, high = pairs.column("low")[0].as_py(), pairs.column("high")[0].as_py()
    block = pairs.column("block").to_numpy()
    row, points = pairs.column("row").to_numpy(), to_matrix(pairs.column("vector"))
    labels = _label_matrix(pairs.column("labels").combine_chunks(), pairs.num_rows)
    left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
    sums = np.zeros((pairs.num_rows, int(known.firsts[-1])))
    for first in range(0, len(right), _SPAN):
        span = right[first:first + _SPAN]
        to_span = known.indicator(labels[span])
        for start in range(0, len(left), _STRIP):
            strip = left[start:start + _STRIP]
            gaps = pair_distances(points[strip], points[span])
            sums[strip] += gaps @ to_span
            if low != high:
                sums[span] += gaps.T @ known.indicator(labels[strip])
    return pa.table({"row": row, "sums": from_matrix(sums)})


def _scored(df: DataFrame, labels: Column, vector: str, id_col: str, block_bytes: int) -> DataFrame:
    """id, labels, silhouettes; ``labels`` is an array of clusters."""
    spark = df.sparkSession
    path = scratch_path(spark, "points")
    df.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), labels.cast("array<int>").alias("labels"),
        as_vector(vector).alias("vector"),
    ).write.parquet(path)
    points = spark.read.parquet(path)
    found = points.select(F.posexplode("labels").alias("place", "cluster")).groupBy("place", "cluster").count().collect()
    n, size = points.agg(F.count("*"), F.coalesce(F.sum(8 * F.size("vector") + 16), F.lit(0))).first()
    places = range(1 + max((r["place"] for r in found), default=-1))
    ordered = [sorted((r["cluster"], r["count"]) for r in found if r["place"] == j) for j in places]
    known = _Labellings(
        tuple(np.array([c for c, _ in x]) for x in ordered), tuple(np.array([k for _, k in x], dtype=np.float64) for x in ordered)
    )
    # As many blocks as their bound asks for, and enough pairs of blocks for all cores. A row
    # has a sum for every cluster of every labelling, which can outweigh its vector.
    size += 8 * n * int(known.firsts[-1])
    blocks = max(math.ceil(size / block_bytes), math.ceil(math.sqrt(4 * spark.sparkContext.defaultParallelism)))
    blocks = max(1, min(blocks, n))
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    placed = points.select("row", "labels", "vector", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"), other.alias("other"))
    pairs = placed.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")).drop("other")
    ship(spark)
    parts = pairs.groupBy("low", "high").applyInArrow(lambda t: _tile(known, t), "row long, sums array<double>")
    sums = parts.groupBy("row").agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums"))

    def score(labels: pa.Array, totals: pa.Array) -> list[pa.Array]:
        return [from_matrix(known.scores(_label_matrix(labels, len(labels)), to_matrix(totals)))]

    rows = points.select("row", "id", "labels").join(sums, "row")
    scored = add_columns(rows, ["labels", "sums"], [T.StructField("silhouettes", VECTOR)], score, drop=["sums"])
    return scored.drop("row")


def silhouette_rows(
    df: DataFrame,
    vector: str = "vector",
    cluster: str = "cluster",
    id_col: str = "id",
    block_bytes: int = SILHOUETTE_BLOCK_BYTES,
) -> DataFrame:
    """Euclidean silhouette of every row: id, cluster, silhouette.

    Exact, so its work is the square of the rows; hand in :func:`row_sample` of a large
    table for an estimate. Rows are dealt out to blocks of bounded size, and each pair of
    blocks is one task, which computes its distances once and returns for the rows of both
    sides their sums by cluster. One aggregation adds these up: no pair is ever a row, and no
    task holds more than two blocks.
    """
    scored = _scored(df, F.array(cluster), vector, id_col, block_bytes)
    return scored.select("id", F.get("labels", F.lit(0)).alias("cluster"), F.get("silhouettes", F.lit(0)).alias("silhouette"))


def silhouettes(
    df: DataFrame, labels: str = "labels", vector: str = "vector", id_col: str = "id", block_bytes: int = SILHOUETTE_BLOCK_BYTES
) -> DataFrame:
    """place, n and mean silhouette of several labellings, the entries of an array column, from one pass over the pairs."""
    scored = _scored(df, F.col(labels), vector, id_col, block_bytes)
    return scored.select(F.posexplode("silhouettes").alias("place", "silhouette")).groupBy("place").agg(
        F.count("*").alias("n"), F.avg("silhouette").alias("silhouette")
    )


def silhouette(df: DataFrame, **columns: str) -> DataFrame:
    """One row: mean silhouette of all rows."""
    return silhouette_rows(df, **columns).agg(
        F.count("*").alias("n"), F.coalesce(F.avg("silhouette"), F.lit(0.0)).alias("silhouette")
    )


def _cluster_range(df: DataFrame, k: int) -> DataFrame:
    return df.sparkSession.range(k).select(F.col("id").cast("int").alias("cluster"))


def _category_counts(assigned: DataFrame, id_col: str, label: str) -> DataFrame:
    """Ranked categories per cluster with the size of the cluster, from one pass.

    Windows run over the counts (clusters × categories), not over the documents.
    """
    counts = assigned.groupBy("cluster", F.col(label).alias("category")).agg(
        F.count("*").alias("n"), F.min(id_col).alias("first_id")
    )
    cluster = Window.partitionBy("cluster")
    order = cluster.orderBy(F.desc("n"), F.asc("first_id"), F.asc("category"))
    return counts.withColumn("rank", F.row_number().over(order)).withColumn("size", F.sum("n").over(cluster))


def hard_profile(assigned: DataFrame, top: int = 5, id_col: str = "id", label: str = "label") -> DataFrame:
    """Categories per cluster, most frequent first: cluster, rank, category, n.

    Ties go to the category that comes first by id.
    """
    ranked = _category_counts(assigned, id_col, label).filter(F.col("rank") <= top)
    return ranked.select("cluster", "rank", "category", "n")


def hard_summary(
    assigned: DataFrame, k: int, id_col: str = "id", label: str = "label", top: int | None = None
) -> DataFrame:
    """One row per cluster 0..k-1: size, dominant category and purity.

    An empty cluster has dominant category ``unknown`` and purity 0. With ``top`` a
    map of the most frequent categories, ``hard_cat_dist``, is added.
    """
    ranked = _category_counts(assigned, id_col, label)
    stats = [
        F.max("size").alias("size"),
        F.max(F.when(F.col("rank") == 1, F.col("category"))).alias("dominant"),
        F.max("n").alias("dominant_n"),
    ]
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
        entries = F.sort_array(F.collect_list(F.struct("rank", "category", "n")))
        pairs = F.transform(entries, lambda e: F.struct(e["category"], e["n"]))
        stats.append(F.map_from_entries(pairs).alias("hard_cat_dist"))
    per_cluster = ranked.groupBy("cluster").agg(*stats)
    return (
        _cluster_range(assigned, k)
        .join(per_cluster, "cluster", "left")
        .select(
            "cluster",
            F.coalesce("size", F.lit(0)).alias("n_hard_members"),
            F.coalesce("dominant", F.lit("unknown")).alias("dominant_category"),
            F.coalesce(F.round(F.try_divide(F.col("dominant_n"), F.col("size")), 3), F.lit(0.0)).alias("purity"),
            *(["hard_cat_dist"] if top is not None else []),
        )
    )


def soft_weights(df: DataFrame, k: int, id_col: str = "id", label: str = "label", membership: str = "membership") -> DataFrame:
    """Summed membership per cluster and category: cluster, category, weight, first_id.

    Sums are taken per category with one column per cluster and turned to rows
    afterwards, so a document is never multiplied by the number of clusters.
    """
    sums = F.array(*[F.sum(F.get(F.col(membership), i)) for i in range(k)])
    per_category = df.groupBy(F.col(label).alias("category")).agg(
        sums.alias("sums"), F.min(id_col).alias("first_id")
    )
    return per_category.select("category", "first_id", F.posexplode("sums").alias("cluster", "weight"))


def soft_profile(df: DataFrame, k: int, top: int = 5, digits: int = 1, **columns: str) -> DataFrame:
    """Heaviest categories per cluster: cluster, rank, category, weight."""
    order = Window.partitionBy("cluster").orderBy(F.desc("weight"), F.asc("first_id"), F.asc("category"))
    return (
        soft_weights(df, k, **columns)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top)
        .select("cluster", "rank", "category", F.round("weight", digits).alias("weight"))
    )


def last_part(name: Column) -> Column:
    """The part of a dotted name after the last dot."""
    return F.substring_index(name, ".", -1)


def cluster_labels(df: DataFrame, k: int, id_col: str = "id", label: str = "label") -> DataFrame:
    """Per cluster: dominant category, size, purity, category counts and soft weights."""

    ranked = soft_profile(df, k, id_col=id_col, label=label)
    entries = F.sort_array(F.collect_list(F.struct("rank", "category", "weight")))
    pairs = F.transform(entries, lambda e: F.struct(e["category"], e["weight"]))
    soft = ranked.groupBy("cluster").agg(F.map_from_entries(pairs).alias("soft_cat_weights"))
    return hard_summary(df, k, id_col, label, top=5).join(soft, "cluster", "left")


def cluster_report(df: DataFrame, k: int, id_col: str = "id", label: str = "label") -> DataFrame:
    """The printed summary, one row per cluster: place, sizes and the top three weights."""
    soft = soft_profile(df, k, 3, id_col=id_col, label=label)
    pair = F.concat_ws("=", last_part(F.col("category")), F.round("weight", 0).cast("bigint").cast("string"))
    texts = (
        soft.withColumn("pair", pair)
        .groupBy("cluster")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "pair"))).alias("pairs"))
        .select("cluster", F.concat_ws(" | ", F.transform("pairs", lambda p: p["pair"])).alias("soft_weights"))
    )
    # k rows from here on, so one ordered window is safe.
    place = F.row_number().over(Window.orderBy(F.desc("n_hard_members"), F.asc("cluster")))
    return (
        hard_summary(df, k, id_col, label)
        .join(texts, "cluster", "left")
        .select(
            place.alias("place"),
            "cluster",
            "n_hard_members",
            F.round("purity", 2).alias("purity"),
            last_part(F.col("dominant_category")).alias("dominant"),
            "soft_weights",
        )
    )


def top_memberships(membership: Column, n: int, digits: int = 4) -> Column:
    """The n largest memberships as an array of (cluster, u), lowest cluster on ties."""
    pairs = F.transform(membership, lambda u, i: F.struct((-u).alias("minus"), i.alias("cluster")))
    top = F.slice(F.sort_array(pairs), 1, n)
    return F.transform(
        top, lambda p: F.struct(p["cluster"].alias("cluster"), F.round(-p["minus"], digits).alias("u"))
    )


def boundary_documents(df: DataFrame, n: int = 20, id_col: str = "id", label: str = "label") -> DataFrame:
    """The n documents with the lowest certainty and their top three clusters."""
    certain = df.select(
        F.col(id_col).alias("id"), F.col(label).alias("label"), "membership", F.array_max("membership").alias("c")
    )
    return (
        certain.orderBy(F.round("c", 10), "id")
        .limit(n)
        .select("id", "label", F.round("c", 4).alias("certainty"), top_memberships(F.col("membership"), 3).alias("top3"))
    )


def category_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """Documents per category, most frequent first."""
    return df.groupBy(F.col(label).alias("category")).agg(F.count("*").alias("n_docs")).orderBy(
        F.desc("n_docs"), F.asc("category")
    )
