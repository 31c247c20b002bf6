"""Packing of token pieces into sequences: best fit, then swaps until bins empty.

Words between ASCII spaces and marks are tokenized once for several slices, as no token spans
those, and remembered up to a bound; slices that hold the name of a special token are only split at spaces. Id 1 ends each document. Documents
longer than a sequence are cut; whole pieces of one sequence need no packing. The others
are dealt into blocks of at most ``BLOCK`` pieces by an exact shuffle; each block is packed
by best fit and then improved: moves, one-for-one and two-for-one exchanges that raise the
sum of squared fills, until no exchange between any two underfull bins helps. A block leaves
about one sequence that is not full, so blocks cost one sequence in tens of thousands.

Null text is the empty text and gives one piece of one token. Repeated rows are packed
each. An empty table gives no rows.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrylight.llm.common import Words, ragged, slices, staged, table
from quarrylight.session import ship

LENGTH = 4096
END_ID = 1
BLOCK = 100_000
#: Text that is tokenized at a time.
SLICE = 3 << 20
#: Bytes of words and ids that are remembered from slice to slice.
REMEMBERED = 12 << 20
_COLUMNS = ("piece", "start", "length", "ids_crc32")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Encoder:
    """Ids of words. Words of letters only are one token run each, so many go in one text."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.ends[[i for word, i in self.tokenizer.get_vocab().items() if word.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.words = pa.array([], pa.large_string())
        self.ids, self.starts, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _each(self, words: list[str]) -> list[np.ndarray]:
        found = []
        for i in range(0, len(words), 2048):
            encodings = self.tokenizer.encode_batch_fast(words[i : i + 2048], add_special_tokens=False)
            found += [np.array(e.ids, np.uint32) for e in encodings]
        return found

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat, sizes = [], []
        for i in range(0, len(words), 512):
            chunk = words[i : i + 512]
            [encoding] = self.tokenizer.encode_batch_fast([" ".join(chunk)], add_special_tokens=False)
            ids = np.array(encoding.ids, np.uint32)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(chunk):
                flat.append(ids)
                sizes.append(np.diff(ends, prepend=0))
            else:  # a letter that the tokenizer's tables do not know as one
                each = self._each(chunk)
                flat += each
                sizes.append(np.array([len(x) for x in each]))
        return np.concatenate(flat), np.concatenate(sizes)

    def _tokenized(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, and start and number of those of each word."""
        letters = pc.utf8_is_alpha(words).to_numpy(zero_copy_only=False).astype(bool)
        sizes = np.zeros(len(words), np.int64)
        starts = np.zeros(len(words), np.int64)
        flat, at = [], 0
        if letters.any():
            ids, n = self._joined(words.filter(pa.array(letters)).to_pylist())
            flat.append(ids)
            sizes[letters], starts[letters] = n, np.cumsum(n) - n
            at = len(ids)
        if not letters.all():
            each = self._each(words.filter(pa.array(~letters)).to_pylist())
            n = np.array([len(x) for x in each])
            flat += each
            sizes[~letters], starts[~letters] = n, at + np.cumsum(n) - n
        return (np.concatenate(flat) if flat else np.zeros(0, np.uint32)), starts, sizes

    def __call__(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and start and number of those of each of the distinct words."""
        words = words.cast(pa.large_string())
        if self.words.nbytes + self.ids.nbytes + self.starts.nbytes + self.sizes.nbytes > REMEMBERED:
            self._forget()
        at = pc.index_in(words, value_set=self.words)
        new = at.is_null()
        if at.null_count:
            ids, starts, sizes = self._tokenized(words.filter(new))
            n = len(self.words)
            self.words = pa.concat_arrays([self.words, words.filter(new)])
            self.starts = np.concatenate((self.starts, len(self.ids) + starts))
            self.ids, self.sizes = np.concatenate((self.ids, ids)), np.concatenate((self.sizes, sizes))
            place = pc.fill_null(at, 0).to_numpy(zero_copy_only=False).astype(np.int64)
            place[new.to_numpy(zero_copy_only=False).astype(bool)] = np.arange(n, len(self.words))
        else:
            place = at.to_numpy(zero_copy_only=False)
        return self.ids, self.starts[place], self.sizes[place]


@lru_cache(maxsize=1)
def _encoder(path: str) -> _Encoder:
    """One for all tasks of a worker."""
    return _Encoder(path)


def tokenize(column: pa.Array, encoder: _Encoder, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a slice, one document after the other, and the n + 1 offsets."""
    special = pc.any(pc.match_substring(column, "oftext|>", ignore_case=True)).as_py()
    words = Words(column, lower=not special, marks=not special)
    flat, starts, sizes = encoder(words.distinct)
    flat = np.append(flat, np.uint32(end_id))
    starts, sizes = np.append(starts, len(flat) - 1), np.append(sizes, 1)
    sequence = np.insert(words.ids, words.bounds[1:], len(sizes) - 1)
    lengths = sizes[sequence]
    ends = np.concatenate(([0], np.cumsum(lengths)))
    last_word = words.bounds[1:] + np.arange(1, len(words.bounds))
    return flat[ragged(starts[sequence], lengths)], np.concatenate(([0], ends[last_word]))


def _pieces(path: str, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for part in slices(batches, SLICE):
            ids, offsets = tokenize(part.column("text"), encoder)
            ids = ids.astype("<u4")
            totals = np.diff(offsets)
            counts = -(-totals // length)
            row = np.repeat(np.arange(len(totals)), counts)
            piece = ragged(np.zeros(len(counts), np.int64), counts)
            start = piece * length
            size = np.minimum(length, totals[row] - start)
            at = offsets[row] + start
            crc = [zlib.crc32(ids[a : a + n].tobytes()) for a, n in zip(at.tolist(), size.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(pa.array(row)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(size, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                names=["doc_id", *_COLUMNS],
            )

    return run


def pieces(docs: DataFrame, length: int = LENGTH, path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece of every document."""
    ship(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )
    return docs.mapInArrow(_pieces(path or vocabulary_path(), length), schema)


def best_fit(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Item numbers by bin: longest first, each into the fullest bin that takes it."""
    bins: list[list[int]] = []
    by_space: list[list[int]] = [[] for _ in range(length + 1)]
    open_spaces = 0  # bit s: a bin with s tokens of space exists
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fitting = open_spaces >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            chosen = by_space[space].pop()
            if not by_space[space]:
                open_spaces &= ~(1 << space)
            bins[chosen].append(item)
        else:
            chosen, space = len(bins), length
            bins.append([item])
        if space > size:
            by_space[space - size].append(chosen)
            open_spaces |= 1 << (space - size)
    return bins


def improve(bins: list[list[int]], sizes: np.ndarray, length: int) -> list[list[int]]:
    """Raise the sum of squared fills by moves and exchanges between underfull bins.

    Tokens only flow from an emptier bin to a fuller one, so every step raises the sum. A
    pass works on the bins from the emptiest on, each until it is empty or no step helps;
    a bin that became emptier meets the bins before it in the next pass. Passes go on until
    one changes nothing: then no step is left for any two bins.
    """
    packing = [list(b) for b in bins]
    fill = [int(sizes[b].sum()) for b in packing]
    while _Pass(packing, fill, sizes, length).run():
        pass
    return [b for b in packing if b]


class _Pass:
    """The bins that are still to be worked on, by space and by the sizes of their items."""

    def __init__(self, bins: list[list[int]], fill: list[int], sizes: np.ndarray, length: int) -> None:
        self.bins, self.fill, self.sizes, self.length = bins, fill, sizes, length
        self.version = [0] * len(bins)  # -1: not a target any more
        self.queue: list[tuple[int, int, int]] = []
        self.by_space: list[set[int]] = [set() for _ in range(length + 1)]
        self.spaces = 0  # bit s: a bin with s tokens of space
        self.holders: list[list[tuple[int, int, int]]] = [[] for _ in range(length + 1)]  # by item size, widest first
        self.reach = np.full(length + 1, -1)  # size + widest space of a bin that holds it
        for i, b in enumerate(bins):
            if b and fill[i] < length:
                self._add(i)

    def _sizes(self, i: int) -> set[int]:
        return {int(x) for x in self.sizes[self.bins[i]]}

    def _add(self, i: int) -> None:
        space = self.length - self.fill[i]
        heappush(self.queue, (self.fill[i], i, self.version[i]))
        self.by_space[space].add(i)
        self.spaces |= 1 << space
        for size in self._sizes(i):
            heappush(self.holders[size], (-space, i, self.version[i]))
            self.reach[size] = max(self.reach[size], size + space)

    def _drop(self, i: int, version: int) -> None:
        """Take bin ``i`` out, as it is filled now."""
        space = self.length - self.fill[i]
        self.by_space[space].discard(i)
        if not self.by_space[space]:
            self.spaces &= ~(1 << space)
        self.version[i] = version
        for size in self._sizes(i):
            heap = self.holders[size]
            while heap and heap[0][2] != self.version[heap[0][1]]:
                heappop(heap)
            self.reach[size] = size - heap[0][0] if heap else -1

    def run(self) -> bool:
        changed = False
        while self.queue:
            _, source, version = heappop(self.queue)
            if version != self.version[source]:
                continue
            self._drop(source, -1)
            while self.bins[source] and (step := self._step(source)):
                target, out, back = step
                changed = True
                self._drop(target, self.version[target] + 1)
                for item in out:
                    self.bins[source].remove(item)
                if back is not None:
                    self.bins[target].remove(back)
                    self.bins[source].append(back)
                self.bins[target].extend(out)
                moved = int(self.sizes[out].sum()) - (int(self.sizes[back]) if back is not None else 0)
                self.fill[source] -= moved
                self.fill[target] += moved
                if self.fill[target] < self.length:
                    self._add(target)
        return changed

    def _step(self, source: int) -> tuple[int, list[int], int | None] | None:
        """(target, items that go there, item that comes back): a move, or the exchange with the largest flow."""
        own: dict[int, list[int]] = {}
        for item in self.bins[source]:
            own.setdefault(int(self.sizes[item]), []).append(item)
        distinct = sorted(own, reverse=True)
        for size in distinct:  # a move takes a whole item away
            if fitting := self.spaces >> size:
                space = size + (fitting & -fitting).bit_length() - 1
                return min(self.by_space[space]), [own[size][0]], None
        values = np.array(distinct)
        ones, others = np.triu_indices(len(values))
        several = np.array([len(own[x]) > 1 for x in distinct])
        pairs = (ones != others) | several[ones]
        ones, others = ones[pairs], others[pairs]
        totals = np.concatenate((values, values[ones] + values[others]))
        # The smallest size that may come back for each total: its bin has room for the rest.
        back = np.searchsorted(np.maximum.accumulate(self.reach), totals)
        flow = totals - back
        best = int(np.argmax(flow))
        if flow[best] <= 0:
            return None
        target = self.holders[back[best]][0][1]
        if best < len(values):
            out = [own[distinct[best]][0]]
        else:
            x, y = distinct[ones[best - len(values)]], distinct[others[best - len(values)]]
            out = [own[x][0], own[y][1 if x == y else 0]]
        returned = next(x for x in self.bins[target] if self.sizes[x] == back[best])
        return target, out, returned


def _pack(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if whole is None or not whole.num_rows:
            return
        sizes = whole.column("length").to_numpy()
        bins = improve(best_fit(sizes, length), sizes, length)
        order = np.array([x for b in bins for x in b], np.int64)
        counts = np.array([len(b) for b in bins])
        number = np.repeat(np.arange(len(bins)), counts)
        ends = np.cumsum(sizes[order])
        firsts = np.cumsum(counts) - counts
        offset = ends - sizes[order]
        offset -= np.repeat(offset[firsts], counts)
        base = TaskContext.get().partitionId() << 33
        placed = whole.take(pa.array(order))
        placed = placed.append_column("sequence_id", pa.array(number + base, pa.int64()))
        yield from placed.append_column("offset", pa.array(offset, pa.int64())).combine_chunks().to_batches(100_000)

    return run


def pack(items: DataFrame, length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """``items`` (with a column length) with sequence_id and offset, at most ``block`` per task.

    ``items`` should be a table, as it is counted first.
    """
    ship(items.sparkSession)
    blocks = max(1, -(-items.count() // block))
    schema = T.StructType(
        items.schema.fields + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    return items.repartition(blocks).mapInArrow(_pack(length), schema)


def pack_documents(docs: DataFrame, length: int = LENGTH, path: str | None = None) -> DataFrame:
    return pack(staged(pieces(docs, length, path), "pieces"), length)


def query(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
