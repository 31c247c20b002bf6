"""Replay of a query log: look up, reuse on a hit, store on a miss.

Each bucket is a state machine over its arrivals, so its rows are handled in order
by one task, as they come off a sorted shuffle: at no time does the task hold more
than one Arrow batch and the at most ``cap`` entries of the bucket. Within a batch
all similarities are two matrix products, and only the bookkeeping is row by row.
What is costly per query (embedding before, retrieval after) is set-based.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.batches import map_batches
from ..functions.vectors import SIMILARITY_DIGITS, as_vector, to_matrix
from .reuse import BUCKET_CAP, NOTHING, THRESHOLD

_CHUNK = 256


def _no_numbers() -> np.ndarray:
    return np.empty(0, dtype=np.int64)


@dataclass
class Bucket:
    """Entries of one bucket, each in a slot of its own.

    A full bucket drops the entry with the fewest hits, among those the oldest, the
    new one included; dropping also puts the entries in order of (hits, age), both
    descending, which decides between equal similarities until the next drop.
    ``ranked`` holds the hits at the last drop, ``stored`` the order of storing.
    """

    ids: np.ndarray = field(default_factory=_no_numbers)
    stored: np.ndarray = field(default_factory=_no_numbers)
    hits: np.ndarray = field(default_factory=_no_numbers)
    ranked: np.ndarray = field(default_factory=_no_numbers)
    vectors: np.ndarray | None = None
    count: int = 0
    dropped: bool = False

    def replay(self, ids: np.ndarray, rows: np.ndarray, threshold: float, cap: int) -> list[tuple]:
        """Take in arrivals in order: (hit, source id, similarity, evicted id) each."""
        out = []
        for start in range(0, len(ids), _CHUNK):
            part = slice(start, start + _CHUNK)
            out.extend(self._chunk(ids[part], rows[part], threshold, cap))
        return out

    def _first_of(self, equal: np.ndarray, stored: np.ndarray, ranked: np.ndarray) -> int:
        """The slot that comes first in bucket order."""
        if not self.dropped:
            return int(equal[stored[equal].argmin()])
        return int(equal[np.lexsort((-stored[equal], -ranked[equal]))[0]])

    def _chunk(self, ids: np.ndarray, rows: np.ndarray, threshold: float, cap: int) -> list[tuple]:
        size = len(self.ids)
        pool = rows if self.vectors is None else np.concatenate([self.vectors, rows])
        first = len(pool) - len(rows)
        sims = np.round(rows @ pool.T, SIMILARITY_DIGITS)
        room = min(cap, size + len(rows))
        # Column of the pool, id, order of storing, hits and ranked hits per slot.
        column, known, stored, hits, ranked = np.zeros((5, room), dtype=np.int64)
        column[:size] = np.arange(size)
        known[:size], stored[:size], hits[:size], ranked[:size] = self.ids, self.stored, self.hits, self.ranked
        out: list[tuple] = []
        for i in range(len(rows)):
            best = NOTHING
            if size:
                here = sims[i, column[:size]]
                at = int(here.argmax())
                if here[at] > NOTHING:
                    best = float(here[at])
            if size and best > NOTHING and best >= threshold:
                equal = np.flatnonzero(here == best)
                if len(equal) > 1:
                    at = self._first_of(equal, stored, ranked)
                hits[at] += 1
                out.append((True, int(known[at]), best, None))
                continue
            evicted = None
            if size < cap:
                slot, size = size, size + 1
            else:
                unused = np.flatnonzero(hits[:size] == 0)
                slot = int(unused[stored[unused].argmin()]) if len(unused) else -1
                evicted = int(known[slot]) if slot >= 0 else int(ids[i])
            if slot >= 0:
                column[slot], known[slot], stored[slot], hits[slot], ranked[slot] = first + i, ids[i], self.count, 0, 0
            if evicted is not None:
                ranked[:size] = hits[:size]
                self.dropped = True
            self.count += 1
            out.append((False, None, best, evicted))
        self.ids, self.stored, self.hits, self.ranked = known[:size], stored[:size], hits[:size], ranked[:size]
        self.vectors = pool[column[:size]]
        return out


def log_schema(id_type: T.DataType) -> T.StructType:
    """Columns of a replay log for ids of a type."""
    return T.StructType(
        [
            T.StructField("query_id", id_type),
            T.StructField("cluster", T.IntegerType()),
            T.StructField("hit", T.BooleanType()),
            T.StructField("source_id", id_type),
            T.StructField("similarity", T.DoubleType()),
            T.StructField("evicted_id", id_type),
        ]
    )


LOG = log_schema(T.LongType())


def replay(
    queries: DataFrame,
    threshold: float = THRESHOLD,
    cap: int = BUCKET_CAP,
    partitions: int | None = None,
) -> DataFrame:
    """Replay (query_id, arrival, cluster, vector) in (arrival, query_id) order.

    Ids and arrivals may be of any type that sorts. Returns query_id, cluster, hit, source_id (the stored query whose answer is
    reused), similarity (best one even on a miss) and evicted_id.
    """
    spark = queries.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        queries.select(
            "query_id",
            "arrival",
            F.col("cluster").cast("int").alias("cluster"),
            as_vector("vector").alias("vector"),
        )
        .repartition(partitions, "cluster")
        .sortWithinPartitions("cluster", "arrival", "query_id")
        .select("query_id", "cluster", "vector")
    )

    log_type = log_schema(queries.schema["query_id"].dataType)
    names = log_type.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Buckets know entries by the place of their row in the task; ``known`` has the
        # ids of the entries that are left, and of one batch.
        current, bucket, seen = None, Bucket(), 0
        known: dict[int, object] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            clusters = batch.column(1).to_numpy(zero_copy_only=False)
            ids = np.arange(seen, seen + batch.num_rows)
            seen += batch.num_rows
            known.update(zip(ids.tolist(), batch.column(0).to_pylist()))
            rows = to_matrix(batch.column(2))
            bounds = np.concatenate([[0], np.flatnonzero(np.diff(clusters)) + 1, [len(clusters)]])
            log: list[tuple] = []
            for begin, end in zip(bounds[:-1], bounds[1:]):
                if clusters[begin] != current:
                    current, bucket = clusters[begin], Bucket()
                log.extend(bucket.replay(ids[begin:end], rows[begin:end], threshold, cap))
            hit, source, best, evicted = zip(*log)
            kind = batch.column(0).type
            source, evicted = ([None if x is None else known[x] for x in xs] for xs in (source, evicted))
            known = {x: known[x] for x in bucket.ids.tolist()}
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(hit, pa.bool_()),
                    pa.array(source, kind),
                    pa.array(best, pa.float64()),
                    pa.array(evicted, kind),
                ],
                names=names,
            )

    return map_batches(ordered, run, log_type)


def surviving_entries(log: DataFrame) -> DataFrame:
    """Entries left after a replay: entry_id, cluster, hit_count."""
    stored = log.filter(~F.col("hit")).select(F.col("query_id").alias("entry_id"), "cluster")
    evicted = log.filter(F.col("evicted_id").isNotNull()).select(F.col("evicted_id").alias("entry_id"))
    hits = log.filter("hit").groupBy(F.col("source_id").alias("entry_id")).agg(F.count("*").alias("hits"))
    return (
        stored.join(evicted, "entry_id", "left_anti")
        .join(hits, "entry_id", "left")
        .select("entry_id", "cluster", F.coalesce("hits", F.lit(0)).alias("hit_count"))
    )
