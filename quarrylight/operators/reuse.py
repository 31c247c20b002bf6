"""Answered queries as a table: seeding, lookup, capacity, statistics and sweeps.

Entries live in buckets, one per dominant cluster, and a bucket is cut to ``cap``
rows. The whole table is therefore at most clusters × cap rows, which is what makes
sending it to the tasks safe; each lookup is then a map over the incoming queries
without any shuffle. A table that was not cut is joined in parts; for a stream, whose rows
cannot be grouped, the tasks go through its parts one after the other.

Entry columns: entry_id, query, vector, membership, cluster, result, arrival,
hit_count and position (place within the bucket, the first one wins ties).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.batches import add_columns
from ..functions.vectors import SIMILARITY_DIGITS, as_vector, to_matrix
from ..session import scratch_path, ship
from ..sources.schemas import ENTRIES
from .diagnostics import top_memberships

# Similarity needed for reuse, and entries per bucket.
THRESHOLD = 0.85
BUCKET_CAP = 500
# Thresholds of the sweep, and the upper limit and text of each band.
SWEEP = (0.70, 0.75, 0.80, 0.85, 0.90, 0.95)
SWEEP_BANDS = (
    (0.75, "aggressive: too many false positives"),
    (0.82, "liberal: cross-topic matches possible"),
    (0.87, "RECOMMENDED: genuine paraphrases matched"),
    (0.92, "conservative: near-verbatim only"),
)
SWEEP_LAST = "strict: nearly exact-match"
# Similarity reported when a bucket is empty.
NOTHING = -1.0
# Largest part of the entry table sent to the tasks, in bytes.
ENTRY_BLOCK_BYTES = 64 << 20
# Similarities that a task of a join of parts computes at a time.
_CELLS = 4 << 20


def is_blank(query: Column) -> Column:
    """Whether a query is missing or white space, whatever the served check strips."""
    return ~F.coalesce(query, F.lit("")).rlike(r"(?U)[^\s\x1c-\x1f]")


def split_blank(queries: DataFrame, query: str = "query") -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): blank and missing queries are not looked up."""
    blank = is_blank(F.col(query))
    return queries.filter(~blank), queries.filter(blank)


def compact(entries: DataFrame, cap: int = BUCKET_CAP) -> DataFrame:
    """Keep the ``cap`` best entries per bucket, by hits and then by recency.

    The ranking is cut before the exchange, so a bucket that holds most of the table
    ships at most ``cap`` rows per task.
    """
    best = Window.partitionBy("cluster").orderBy(F.desc("hit_count"), F.desc("arrival"), F.asc("entry_id"))
    return entries.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= cap)


def seed_entries(answered: DataFrame, cap: int | None = BUCKET_CAP) -> DataFrame:
    """Store fresh entries in arrival order under the bucket limit; without ``cap`` all of them.

    Adds hit_count 0 and ``position``. A bucket that never overflowed keeps arrival
    order; one that did was sorted newest first when it last overflowed.
    """
    fresh = answered.withColumn("hit_count", F.lit(0).cast("bigint"))
    if cap is None:
        return _numbered_in_buckets(fresh)
    sizes = answered.groupBy("cluster").agg(F.count("*").alias("_offered"))
    kept = compact(fresh, cap).join(sizes, "cluster")
    position = F.when(F.col("_offered") > cap, F.col("place")).otherwise(F.col("_offered") - F.col("place") + 1)
    return kept.withColumn("position", position.cast("bigint")).drop("place", "_offered")


def _numbered_in_buckets(fresh: DataFrame) -> DataFrame:
    """All entries with their place in arrival order within the bucket.

    The table is sorted in ranges, so a hot bucket is spread over several tasks, and written;
    a place is that within the range behind the entries of the ranges before.
    """
    spark = fresh.sparkSession
    path = scratch_path(spark, "entries")
    order = [F.asc("cluster"), F.asc("arrival"), F.desc("entry_id")]
    ranges = fresh.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = ranges.withColumn("_at", F.monotonically_increasing_id())
    numbered.write.parquet(path)
    rows = spark.read.schema(numbered.schema).parquet(path).withColumn("_range", F.shiftright("_at", 33))
    pieces = rows.groupBy("cluster", "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    # One row per bucket and range.
    before = F.sum("_n").over(Window.partitionBy("cluster").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = pieces.select("cluster", "_range", (F.coalesce(before, F.lit(0)) + 1 - F.col("_first")).alias("_start"))
    placed = rows.join(F.broadcast(starts), ["cluster", "_range"]).withColumn("position", F.col("_at") + F.col("_start"))
    return placed.select(*fresh.columns, "position")


def save_entries(entries: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write the table by bucket, so a lookup for some clusters reads only those."""
    entries.write.mode(mode).partitionBy("cluster").parquet(path)


def load_entries(spark: SparkSession, path: str) -> DataFrame:
    """Read a saved table; also an empty one, whose files hold no bucket."""
    return spark.read.schema(ENTRIES).parquet(path)


def _found_fields(entries: DataFrame) -> list[T.StructField]:
    return [
        T.StructField("best_similarity", T.DoubleType()),
        T.StructField("best_position", T.LongType()),
        T.StructField("best_id", entries.schema["entry_id"].dataType),
    ]


_Stored = tuple[np.ndarray, np.ndarray, pa.Array]


def _buckets(part: pa.Table) -> dict[int, _Stored]:
    """Vectors, positions and ids of a part of the table by bucket, each in bucket order."""
    buckets: dict[int, _Stored] = {}
    if part.num_rows:
        part = part.filter(pc.is_valid(part.column("cluster"))).combine_chunks()
        cluster = part.column("cluster").to_numpy()
        position = part.column("position").to_numpy()
        ids = pa.concat_arrays(part.column("entry_id").chunks)
        vectors = to_matrix(part.column("vector"))
        order = np.lexsort((position, cluster))
        for c in np.unique(cluster):
            mine = order[cluster[order] == c]
            buckets[int(c)] = (vectors[mine], position[mine], ids.take(pa.array(mine)))
    return buckets


def _search_parts(
    queries: DataFrame, parts: Sequence[Broadcast[dict[int, _Stored]]], exclude_self: bool, fields: list[T.StructField]
) -> DataFrame:
    """Best entry of the query's bucket in the parts of the table, of which a task holds one at a time."""
    kind = to_arrow_type(fields[2].dataType)

    def find(query_id: pa.Array, cluster_of: pa.Array, vector: pa.Array) -> list[pa.Array]:
        rows = to_matrix(vector)
        clusters = cluster_of.to_numpy(zero_copy_only=False)
        ids_of = query_id.to_numpy(zero_copy_only=False)
        best, place = np.full(len(rows), NOTHING), np.full(len(rows), -1, dtype=np.int64)
        name = pa.nulls(len(rows), kind)
        asked = np.unique(clusters[cluster_of.is_valid().to_numpy(zero_copy_only=False)])
        for shared in parts:
            part = shared.value
            for c in asked:
                if int(c) not in part:
                    continue
                stored, positions, entry_ids = part[int(c)]
                chosen = np.full(len(rows), -1, dtype=np.int64)
                whole = np.flatnonzero(clusters == c)
                step = max(1, _CELLS // len(stored))
                for start in range(0, len(whole), step):
                    mine = whole[start : start + step]
                    sims = np.round(rows[mine] @ stored.T, SIMILARITY_DIGITS)
                    if exclude_self:
                        sims[ids_of[mine][:, None] == entry_ids.to_numpy(zero_copy_only=False)[None, :]] = -np.inf
                    # Entries are in bucket order, and argmax takes the first of equals.
                    top = sims.argmax(axis=1)
                    value = sims[np.arange(len(mine)), top]
                    held, at = best[mine], place[mine]
                    better = (value > held) | ((value == held) & (at >= 0) & (positions[top] < at))
                    best[mine[better]] = value[better]
                    place[mine[better]] = positions[top[better]]
                    chosen[mine[better]] = top[better]
                taken = entry_ids.take(pa.array(chosen, mask=chosen < 0))
                name = pc.if_else(pa.array(chosen >= 0), taken, name)
            del part
            if len(parts) > 1 and getattr(shared, "_path", None):
                shared.__dict__.pop("_value", None)  # read again from the executor's disk for the next batch
        return [pa.array(best), pa.array(place, mask=place < 0), name]

    return add_columns(queries, ["query_id", "cluster", "vector"], fields, find)


def _join_parts(queries: DataFrame, stored: DataFrame, exclude_self: bool, fields: list[T.StructField]) -> DataFrame:
    """Best entry of the query's bucket, from a join of parts of the table with blocks of queries.

    Every bucket has as many parts and blocks as its own size asks for, so a hot one is
    spread and a small one is not multiplied. The best entries of the parts are merged by
    a maximum, which starts before the shuffle.
    """
    spark = queries.sparkSession
    path = scratch_path(spark, "lookups")
    # Numbered rows are kept in a table, so that a lost task finds them under the same numbers.
    rows = queries.select(F.struct(*[queries[c] for c in queries.columns]).alias("row"), F.monotonically_increasing_id().alias("at"))
    rows.write.parquet(path)
    kept = spark.read.schema(rows.schema).parquet(path)
    asked = kept.select("at", "row.query_id", F.col("row.cluster").cast("bigint").alias("cluster"), "row.vector")
    stored = stored.withColumn("cluster", F.col("cluster").cast("bigint"))

    def pieces(df: DataFrame, name: str) -> DataFrame:
        size = F.sum(8 * F.size("vector") + 8)
        return df.groupBy("cluster").agg(F.ceil(size / ENTRY_BLOCK_BYTES).cast("int").alias(name))

    def places(name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(name) - 1))

    split = pieces(stored, "parts").join(pieces(asked, "blocks"), "cluster")
    ours = asked.join(split, "cluster").select(
        "at", "query_id", "vector", "cluster", F.pmod("at", "blocks").cast("int").alias("block"), places("parts").alias("part")
    )
    theirs = stored.join(split, "cluster").select(
        "entry_id", "position", "vector", "cluster", F.pmod(F.xxhash64("entry_id"), "parts").cast("int").alias("part"),
        places("blocks").alias("block"),
    )
    found_type = T.StructType([T.StructField("at", T.LongType()), *fields])
    kinds = [to_arrow_type(f.dataType) for f in found_type]

    def best(mine: pa.Table, part: pa.Table) -> pa.Table:
        found: list[list[pa.Array]] = [[] for _ in kinds]
        if mine.num_rows and part.num_rows:
            part = part.take(pa.array(np.argsort(part.column("position").to_numpy(), kind="stable")))
            queried, entry_ids = (t.column(c).to_numpy() for t, c in ((mine, "query_id"), (part, "entry_id")))
            rows, vectors = (to_matrix(t.column("vector").combine_chunks()) for t in (mine, part))
            step = max(1, _CELLS // part.num_rows)
            for start in range(0, mine.num_rows, step):
                sims = np.round(rows[start : start + step] @ vectors.T, SIMILARITY_DIGITS)
                if exclude_self:
                    sims[queried[start : start + step, None] == entry_ids[None, :]] = -np.inf
                top = sims.argmax(axis=1)
                value = sims[np.arange(len(top)), top]
                hits = np.flatnonzero(value > NOTHING)
                at, chosen = pa.array(start + hits), pa.array(top[hits])
                columns = mine.column("at").take(at), pa.array(value[hits]), part.column("position").take(chosen), part.column("entry_id").take(chosen)
                for held, column in zip(found, columns):
                    held.extend(column.chunks if isinstance(column, pa.ChunkedArray) else [column])
        columns = [pa.chunked_array(held, kind) for held, kind in zip(found, kinds)]
        return pa.Table.from_arrays(columns, names=found_type.fieldNames())

    ship(spark)
    key = ["cluster", "part", "block"]
    pairs = ours.groupBy(*key).cogroup(theirs.groupBy(*key)).applyInArrow(best, found_type)
    # The lowest place wins among equal similarities.
    merged = pairs.groupBy("at").agg(
        F.max(F.struct("best_similarity", (-F.col("best_position")).alias("place"), "best_id")).alias("best")
    )
    return kept.join(merged, "at", "left").select(
        *[F.col("row").getField(c).alias(c) for c in queries.columns],
        F.coalesce("best.best_similarity", F.lit(NOTHING)).alias("best_similarity"),
        (-F.col("best.place")).alias("best_position"),
        F.col("best.best_id").alias("best_id"),
    )


def best_entries(queries: DataFrame, entries: DataFrame, exclude_self: bool = False) -> DataFrame:
    """Add the most similar entry of the bucket: best_similarity, best_position, best_id.

    ``queries`` needs query_id, cluster and vector. With ``exclude_self`` an entry
    does not match the query that has its id.
    """
    return _best_entries(queries, entries, exclude_self)[0]


def _best_entries(queries: DataFrame, entries: DataFrame, exclude_self: bool) -> tuple[DataFrame, bool]:
    """The lookups, and whether the entries, texts included, are proven small.

    A small table is sent to the tasks. A larger one is joined in parts, and no entry
    passes the driver. Streams cannot be grouped again, so for them the parts of a larger table
    are sent one after the other, and a task goes through all of them with each batch of queries. Repeated
    and null query ids are looked up the same way as anything else.
    """
    columns = ["entry_id", "cluster", "position", as_vector("vector").alias("vector")]
    plain = entries.select(*columns)
    stored = entries.select(*columns, F.length("query").alias("chars")).persist()
    found = queries.withColumn("vector", as_vector("vector"))
    fields = _found_fields(entries)
    try:
        size = stored.agg(F.sum(8 * F.size("vector") + 8 + F.coalesce("chars", F.lit(0)))).first()[0] or 0
        parts = max(1, math.ceil(size / ENTRY_BLOCK_BYTES))
        if parts > 1 and not queries.isStreaming:
            return _join_parts(found, plain, exclude_self, fields), False
        shared = []
        for number in range(parts):
            part = stored if parts == 1 else stored.filter(F.pmod(F.xxhash64("entry_id"), F.lit(parts)) == number)
            shared.append(queries.sparkSession.sparkContext.broadcast(_buckets(part.drop("chars").toArrow())))
    finally:
        stored.unpersist()
    return _search_parts(found, shared, exclude_self, fields), parts == 1


def decide(found: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Turn best entries into hits: adds hit, matched_id and similarity.

    A miss has no match but keeps the best similarity.
    """
    hit = F.col("best_similarity") >= threshold
    return (
        found.withColumn("hit", hit)
        .withColumn("matched_id", F.when(hit, F.col("best_id")))
        .withColumnRenamed("best_similarity", "similarity")
        .drop("best_position", "best_id")
    )


def lookup(queries: DataFrame, entries: DataFrame, threshold: float = THRESHOLD, exclude_self: bool = False) -> DataFrame:
    """Look each query up in a fixed entry table; adds matched_query to :func:`decide`."""
    found, small = _best_entries(queries, entries, exclude_self)
    texts = entries.select(F.col("entry_id").alias("matched_id"), F.col("query").alias("matched_query"))
    # Broadcast behind the check of the size; beyond it AQE picks the join.
    return decide(found, threshold).join(F.broadcast(texts) if small else texts, "matched_id", "left")


def sweep_band(theta: Column) -> Column:
    """The sweep's text for a threshold."""
    text = F.lit(SWEEP_LAST)
    for limit, band in reversed(SWEEP_BANDS):
        text = F.when(theta <= limit, F.lit(band)).otherwise(text)
    return text


def threshold_sweep(found: DataFrame, thresholds: Sequence[float] = SWEEP) -> DataFrame:
    """Hit rate and mean similarity of hits per threshold, from one lookup.

    All thresholds are aggregated in the same pass over the best similarities.
    """
    best = F.col("best_similarity")
    stats = [F.count("*").alias("n")]
    for i, theta in enumerate(thresholds):
        stats.append(F.count_if(best >= theta).alias(f"hits_{i}"))
        stats.append(F.avg(F.when(best >= theta, best)).alias(f"mean_{i}"))
    wide = found.agg(*stats)
    rows = F.array(
        *[
            F.struct(
                F.lit(float(theta)).alias("theta"),
                F.col(f"hits_{i}").alias("hits"),
                F.coalesce(F.try_divide(F.col(f"hits_{i}"), F.col("n")), F.lit(0.0)).alias("hit_rate"),
                F.coalesce(F.col(f"mean_{i}"), F.lit(0.0)).alias("avg_similarity"),
            )
            for i, theta in enumerate(thresholds)
        ]
    )
    return wide.select(F.inline(rows)).withColumn("description", sweep_band(F.col("theta")))


def hit_evaluation(looked_up: DataFrame, expected: str = "expected_hit") -> DataFrame:
    """Counts per (expected, actual) outcome."""
    return looked_up.groupBy(F.col(expected).alias("expected_hit"), "hit").agg(F.count("*").alias("n"))


def reuse_stats(log: DataFrame, entries: DataFrame) -> DataFrame:
    """One row: total_entries, hit_count, miss_count, hit_rate.

    ``log`` holds one row per lookup with ``hit``; counters survive evictions.
    """
    counters = log.agg(F.count_if("hit").alias("hit_count"), F.count_if(~F.col("hit")).alias("miss_count"))
    size = entries.agg(F.count("*").alias("total_entries"))
    merged = counters.unionByName(size, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("total_entries", "hit_count", "miss_count")]
    )
    looked_up = F.col("hit_count") + F.col("miss_count")
    rate = F.coalesce(F.round(F.try_divide(F.col("hit_count"), looked_up), 4), F.lit(0.0))
    return merged.withColumn("hit_rate", rate)


def bucket_sizes(entries: DataFrame) -> DataFrame:
    """Entries per non-empty bucket."""
    return entries.groupBy("cluster").agg(F.count("*").alias("n_entries"))


def flush(entries: DataFrame) -> DataFrame:
    """An empty table of the same shape; write it over the old one."""
    return entries.sparkSession.createDataFrame([], entries.schema)


def membership_map(membership: Column, n: int = 5) -> Column:
    """The n largest memberships as a map from cluster (text) to membership."""
    pairs = F.transform(
        top_memberships(membership, n), lambda p: F.struct(p["cluster"].cast("string"), p["u"])
    )
    return F.map_from_entries(pairs)


def with_cluster_label(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Add cluster_label, ``unknown`` for clusters without one."""
    names = labels.select("cluster", F.col("dominant_category").alias("_label"))
    return (
        df.join(names, "cluster", "left")
        .withColumn("cluster_label", F.coalesce("_label", F.lit("unknown")))
        .drop("_label")
    )
