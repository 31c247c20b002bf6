"""What the operators share: staging, row keys, and words of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylight.session import scratch_path

SLICE_BYTES = 4 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, so nothing recomputes it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole(text: str | Column = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def text_hash(text: str | Column = "text") -> Column:
    """With doc_id it names a row by its content; equal rows share results."""
    return F.xxhash64(whole(text))


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Null-safe equality of the named columns."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, one after the other, and the n + 1 offsets."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_of(batch: pa.RecordBatch) -> pa.Array:
    """The text column, on its own or in the struct column ``row``."""
    if "text" in batch.schema.names:
        return batch.column("text")
    row = batch.column("row")
    return row.flatten()[row.type.get_field_index("text")]


def rows(docs: DataFrame, *also: str) -> DataFrame:
    """Each row as one struct ``row``, so that no extra column can clash with a computed one."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *also)


def slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges of about ``limit`` text bytes; a longer text comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(text_of(batch)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, end - start)
            start = end


_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[[*range(33, 39), *range(40, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


class Words:
    """Space-separated words of a slice: owner row, dense ids and the distinct words.

    With ``marks``, words also end between an ASCII letter and a punctuation mark other
    than the apostrophe.
    """

    def __init__(self, column: pa.Array, lower: bool = False, marks: bool = False) -> None:
        data, offsets = text_bytes(column)
        if lower:
            data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
        inside = ~_SPACE[data]
        before = np.empty(len(data), bool)
        before[1:] = inside[:-1]
        heads = offsets[:-1][np.diff(offsets) > 0]
        before[heads] = False
        if marks and len(data) > 1:
            letter, mark = _LETTER[data], _MARK[data]
            cut = np.flatnonzero((letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:])) + 1
            before[cut] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.empty(len(data), bool)
        after[:-1] = inside[1:]
        tails = offsets[1:][np.diff(offsets) > 0] - 1
        after[tails] = False
        if marks and len(data) > 1:
            after[cut - 1] = False
        lengths = np.flatnonzero(inside & ~after) + 1 - starts
        self.data, self.offsets, self.inside, self.starts = data, offsets, inside, starts
        self.bounds = np.searchsorted(starts, offsets)
        self.per_row = np.diff(self.bounds)
        self.row = np.repeat(np.arange(len(offsets) - 1), self.per_row)
        ends = np.zeros(len(lengths) + 1, np.int64)
        np.cumsum(lengths, out=ends[1:])
        packed = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(data[inside])]
        )
        encoded = packed.dictionary_encode()
        self.ids = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.distinct = encoded.dictionary

    def sum_by_row(self, flags: np.ndarray) -> np.ndarray:
        """Sums of one value per byte, by row."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges [start, start + length)."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)
