"""Query reuse on streams: lookup against a fixed table, and replay with state."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import islice
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.vectors import as_vector
from ..operators.replay import Bucket, log_schema
from ..operators.reuse import BUCKET_CAP, THRESHOLD, best_entries, decide
from ..session import ship

# The state store that keeps state on disk; state of several variables needs it.
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ON_DISK = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Rows of one bucket that are sorted in memory, and rows replayed or stored at a time.
PIECE_ROWS = 65_536
_CHUNK_ROWS = 256


def stream_lookup(queries: DataFrame, entries: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Stateless form: a stream of routed queries against a fixed entry table."""
    return decide(best_entries(queries, entries), threshold)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


class _Replay(StatefulProcessor):
    """The state of a bucket: per slot an entry and its uses, and rows that wait to be merged.

    Of a batch only the slots that changed are written back.
    """

    def __init__(self, threshold: float, cap: int, id_type: T.DataType, arrival_type: T.DataType, piece_rows: int):
        self.threshold, self.cap, self.piece_rows = threshold, cap, piece_rows
        self.id_type, self.arrival_type = id_type, arrival_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        long, vectors = T.LongType(), T.BinaryType()
        slot = _struct(slot=T.IntegerType())
        rows = _struct(arrivals=T.ArrayType(self.arrival_type), ids=T.ArrayType(self.id_type), vectors=vectors)
        self.counter = handle.getValueState("counter", _struct(count=long, dropped=T.BooleanType()))
        self.entries = handle.getMapState("entries", slot, _struct(id=self.id_type, stored=long, vector=vectors))
        self.uses = handle.getMapState("uses", slot, _struct(hits=long, ranked=long))
        self.waiting = handle.getMapState("waiting", _struct(run=T.IntegerType(), part=T.IntegerType()), rows)

    def handleInputRows(self, key: tuple[Any, ...], rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        bucket, names = self._load()
        before = {"stored": bucket.stored, "hits": bucket.hits, "ranked": bucket.ranked}
        # Numbers below stand for ids: first those of the slots, then the arrivals.
        known, seen = dict(enumerate(names)), len(names)
        for piece in self._in_order(rows):
            ids = piece["query_id"].tolist()
            numbers = np.arange(seen, seen + len(ids))
            seen += len(ids)
            known.update(zip(numbers.tolist(), ids))
            log = bucket.replay(numbers, _matrix(piece["vector"]), self.threshold, self.cap)
            hit, source, best, evicted = zip(*log)
            source, evicted = ([None if x is None else known[x] for x in xs] for xs in (source, evicted))
            known = {x: known[x] for x in bucket.ids.tolist()}
            yield pd.DataFrame(
                {
                    "query_id": piece["query_id"].to_numpy(),
                    "cluster": np.full(len(ids), key[0], dtype=np.int32),
                    "hit": hit,
                    "source_id": pd.Series(source, dtype=object),
                    "similarity": best,
                    "evicted_id": pd.Series(evicted, dtype=object),
                }
            )
        self._save(bucket, [known[x] for x in bucket.ids.tolist()], before)

    def close(self) -> None:
        pass

    def _load(self) -> tuple[Bucket, list[Any]]:
        if not self.counter.exists():
            return Bucket(), []
        count, dropped = self.counter.get()
        entries = [value for _, value in sorted((k[0], tuple(v)) for k, v in self.entries.iterator())]
        uses = [value for _, value in sorted((k[0], tuple(v)) for k, v in self.uses.iterator())]
        hits, ranked = np.array(uses, dtype=np.int64).reshape(-1, 2).T.copy()
        stored = np.array([e[1] for e in entries], dtype=np.int64)
        vectors = np.stack([np.frombuffer(e[2]) for e in entries]) if entries else None
        return Bucket(np.arange(len(entries)), stored, hits, ranked, vectors, int(count), bool(dropped)), [e[0] for e in entries]

    def _save(self, bucket: Bucket, names: list[Any], before: dict[str, np.ndarray]) -> None:
        self.counter.update((bucket.count, bucket.dropped))
        kept = len(before["stored"])
        new = np.arange(len(names)) >= kept
        changed = {}
        for what, old in before.items():
            now = getattr(bucket, what)
            changed[what] = new.copy()
            changed[what][:kept] |= now[:kept] != old
        for slot in np.flatnonzero(changed["stored"]).tolist():
            self.entries.updateValue((slot,), (names[slot], int(bucket.stored[slot]), bucket.vectors[slot].tobytes()))
        for slot in np.flatnonzero(changed["hits"] | changed["ranked"] | changed["stored"]).tolist():
            self.uses.updateValue((slot,), (int(bucket.hits[slot]), int(bucket.ranked[slot])))

    def _in_order(self, rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The rows by (arrival, query_id): sorted at once, or in runs that wait in the state and are merged."""
        held, size, runs = [], 0, 0
        for frame in rows:
            held.append(frame)
            size += len(frame)
            if size >= self.piece_rows:
                self._store(runs, _sorted(held))
                held, size, runs = [], 0, runs + 1
        if not runs:
            if size:
                yield _sorted(held)
            return
        if size:
            self._store(runs, _sorted(held))
            runs += 1
        merged = heapq.merge(*(self._stored(run) for run in range(runs)), key=lambda row: row[:2])
        while piece := list(islice(merged, _CHUNK_ROWS)):
            yield pd.DataFrame(piece, columns=["arrival", "query_id", "vector"])

    def _store(self, run: int, frame: pd.DataFrame) -> None:
        for part, start in enumerate(range(0, len(frame), _CHUNK_ROWS)):
            piece = frame.iloc[start : start + _CHUNK_ROWS]
            vectors = _matrix(piece["vector"]).tobytes()
            self.waiting.updateValue((run, part), (piece["arrival"].tolist(), piece["query_id"].tolist(), vectors))

    def _stored(self, run: int) -> Iterator[tuple[Any, Any, np.ndarray]]:
        part = 0
        while self.waiting.containsKey((run, part)):
            arrivals, ids, vectors = self.waiting.getValue((run, part))
            self.waiting.removeKey((run, part))
            yield from zip(arrivals, ids, np.frombuffer(vectors).reshape(len(ids), -1))
            part += 1


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_list()).astype(np.float64)


def _sorted(frames: list[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(frames, ignore_index=True).sort_values(["arrival", "query_id"], ignore_index=True)


def stream_replay(
    queries: DataFrame, threshold: float = THRESHOLD, cap: int = BUCKET_CAP, piece_rows: int = PIECE_ROWS
) -> DataFrame:
    """Stateful form of the replay, keyed by cluster.

    ``queries`` streams (query_id, arrival, cluster, vector); ids and arrivals are of any
    type that sorts, and neither is null. Within a micro-batch arrivals are put in order;
    limit the batch with the source's own options. A bucket's rows beyond ``piece_rows``
    are sorted in runs of that many, which wait on disk in the state and are merged, so a
    task holds at most one run and the bucket's ``cap`` entries. Sets the session's state
    store to the one on disk.
    """
    spark = queries.sparkSession
    ship(spark)
    spark.conf.set(_PROVIDER, _ON_DISK)
    keyed = queries.select(
        "query_id", "arrival", F.col("cluster").cast("int").alias("cluster"), as_vector("vector").alias("vector")
    )
    id_type, arrival_type = (keyed.schema[c].dataType for c in ("query_id", "arrival"))
    return keyed.groupBy("cluster").transformWithStateInPandas(
        _Replay(threshold, cap, id_type, arrival_type, piece_rows), log_schema(id_type), "append", "none"
    )
