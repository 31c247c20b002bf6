"""Work on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T

from ..session import ship


# Tasks per core of a pass in which every task returns a summary of a fixed size.
_SUMMARY_TASKS_PER_CORE = 4
# Text that is counted at a time, and rows of any kind.
SLICE_BYTES = 4 << 20


def text_slices(batches: Iterator[pa.RecordBatch], position: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges with about ``limit`` bytes in a text column; a longer text comes alone."""
    for batch in batches:
        if batch.num_rows:
            sizes = pc.fill_null(pc.binary_length(batch.column(position)), 0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes, dtype=np.int64)
            start = 0
            while start < batch.num_rows:
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
                yield batch.slice(start, stop - start)
                start = stop


def even_slices(batches: Iterator[pa.RecordBatch], position: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges with about ``limit`` bytes in a column, by the mean of their batch."""
    for batch in batches:
        step = max(1, batch.num_rows * limit // max(1, batch.column(position).nbytes))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def map_batches(
    df: DataFrame,
    run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: T.StructType,
    summary: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """``mapInArrow`` with this package at hand in the tasks.

    With ``summary`` each task returns about the same amount however much it read, so
    neighbouring input partitions are read by one task: what is shuffled afterwards
    grows with the cores and not with the data. ``tasks`` bounds their number further,
    where a summary is large beside its share of the input. Batches stream through
    either way.
    """
    ship(df.sparkSession)
    if summary:
        most = _SUMMARY_TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism
        df = df.coalesce(most if tasks is None else max(1, min(most, tasks)))
    return df.mapInArrow(run, schema)


def add_columns(
    df: DataFrame,
    inputs: Sequence[str],
    fields: Sequence[T.StructField],
    compute: Callable[..., Sequence[pa.Array]],
    drop: Sequence[str] = (),
    slices: Callable[[Iterator[pa.RecordBatch], int], Iterator[pa.RecordBatch]] | None = None,
) -> DataFrame:
    """Append ``fields`` computed from the ``inputs`` columns, batch by batch.

    Columns in ``drop`` are not sent back from the Python worker. With ``slices``
    batches are cut by the size of the first input.

    An operator of its own and not a UDF column: the optimiser can neither copy it
    into a filter below nor merge it into an array lambda, so it runs once per row.
    """
    fields = list(fields)
    taken = {f.name for f in fields} | set(drop)
    kept = df.select(*[c for c in df.columns if c not in taken or c in inputs])
    positions = [kept.columns.index(c) for c in inputs]
    passed = [i for i, c in enumerate(kept.columns) if c not in taken]
    schema = T.StructType([kept.schema.fields[i] for i in passed] + fields)
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, positions[0]) if slices else batches:
            if batch.num_rows:
                added = compute(*(batch.column(i) for i in positions))
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in passed), *added], names=names)

    return map_batches(kept, run, schema)
