"""Periodic runs: stretches of words that repeat with a fixed distance, and texts without the repeats.

A run is a stretch of words with smallest period q (words q apart are equal) of at least
``max(least, 2 q)`` words that cannot be extended on either side. They are found by
internal pattern matching:

* The suffixes of the words are sorted by doubling, within each document. Round k gives
  every stretch of 2^k words the start of its class in the suffix array, and these names
  answer common extensions to the right and to the left.
* A dyadic block is a stretch of B = 2^k words at a multiple of B. For its period q the
  run holds, among its first words, a block with q between 2 B - 1 and 4 B - 2 (up to 6 for
  B = 2) that occurs again q words on. Each block asks a wavelet matrix over the suffix
  array for its next occurrences in that window (range successor: the smallest position
  not before a given one, within the interval of the block's class).
* Occurrences that overlap the block form a progression: one difference d stands for all
  of them up to the end of the stretch with period d, and the search goes on behind it.
  Every other occurrence gives a candidate period, which is extended both ways. Of
  candidates with one stretch the smallest period counts.

Texts are handled in slices, each by its own task; no row leaves its partition, so a hot
source or a group of copies costs what its bytes cost. One document is never split:
memory is about 150 bytes for each word of a slice or of a longer single text.

Results in special cases: null and empty texts and texts without words have no runs and
the empty text; null, repeated and tied ids are independent rows; extra columns stay as
they are whatever their names (they travel in one struct); an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrylight.functions.batches import map_batches
from quarrylight.llm.common import Words, rows, slices, table, text_of, whole

#: Words a run has at least.
LEAST = 12
SLICE_BYTES = 2 << 20

RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])


class Suffixes:
    """Suffix array of several word sequences and the names of their stretches of 2^k words."""

    def __init__(self, ids: np.ndarray, owner: np.ndarray, ends: np.ndarray) -> None:
        """``owner`` is the sequence of each word, ``ends`` where that sequence ends."""
        n = len(ids)
        key = owner * (int(ids.max(initial=0)) + 1) + ids
        self.order = np.argsort(key, kind="stable")
        active, rank = self._named(np.arange(n), key[self.order], np.zeros(n, np.int64), self.order)
        self.names, self.members = [rank.astype(np.int32)], [active]
        step = 1
        while len(active):
            follower = active + step
            second = np.where(follower < ends[active], rank[np.minimum(follower, n - 1)], -1)
            first = rank[active]
            order = np.argsort(first * (n + 1) + second + 1, kind="stable")
            active, first, second = active[order], first[order], second[order]
            heads = np.flatnonzero(np.r_[True, first[1:] != first[:-1]])
            slots = first + np.arange(len(active)) - np.repeat(heads, np.diff(np.r_[heads, len(active)]))
            self.order[slots] = active
            rank = rank.copy()
            active, rank = self._named(slots, first * (n + 1) + second + 1, rank, active)
            self.names.append(rank.astype(np.int32))
            self.members.append(active)
            step *= 2

    @staticmethod
    def _named(slots: np.ndarray, keys: np.ndarray, rank: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Name sorted positions by the slot of the first with their key; those not alone."""
        if not len(at):
            return at, rank
        new = np.r_[True, keys[1:] != keys[:-1]]
        rank[at] = np.maximum.accumulate(np.where(new, slots, 0))
        alone = new & np.r_[new[1:], True]
        return at[~alone], rank

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of equal words from positions a and b on."""
        off = np.zeros(len(a), np.int64)
        last = len(self.names[0]) - 1
        for k in range(len(self.names) - 1, -1, -1):
            x, y, name = a + off, b + off, self.names[k]
            same = (y <= last) & (name[np.minimum(x, last)] == name[np.minimum(y, last)])
            off[same] += 1 << k
        return off

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of equal words before positions a < b."""
        off = np.zeros(len(a), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            x, y, name = a - off - (1 << k), b - off - (1 << k), self.names[k]
            same = (x >= 0) & (name[np.maximum(x, 0)] == name[np.maximum(y, 0)])
            off[same] += 1 << k
        return off


class WaveletMatrix:
    """Sequence of numbers below 2^bits, asked for the next value within a range of places."""

    def __init__(self, values: np.ndarray, limit: int) -> None:
        self.bits = max(1, int(limit).bit_length())
        self.zeros = []
        for bit in range(self.bits - 1, -1, -1):
            low = (values >> bit) & 1 == 0
            count = np.zeros(len(values) + 1, np.int32)
            np.cumsum(low, out=count[1:])
            self.zeros.append(count)
            values = np.concatenate([values[low], values[~low]])

    def successor(self, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Smallest value of at least ``least`` at the places [low, high), or -1."""
        smaller = np.zeros(len(low), np.int64)
        a, b = low.copy(), high.copy()
        for level, count in enumerate(self.zeros):
            za, zb, all_zeros = count[a], count[b], count[-1]
            one = (least >> (self.bits - 1 - level)) & 1 == 1
            smaller += np.where(one, zb - za, 0)
            a = np.where(one, all_zeros + a - za, za)
            b = np.where(one, all_zeros + b - zb, zb)
        found = smaller < high - low
        a, b, rank = low[found], high[found], smaller[found]
        value = np.zeros(len(a), np.int64)
        for level, count in enumerate(self.zeros):
            za, zb, all_zeros = count[a], count[b], count[-1]
            one = rank >= zb - za
            rank = np.where(one, rank - (zb - za), rank)
            value = value << 1 | one
            a = np.where(one, all_zeros + a - za, za)
            b = np.where(one, all_zeros + b - zb, zb)
        out = np.full(len(low), -1, np.int64)
        out[found] = value
        return out


def _candidates(suffixes: Suffixes, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, period) of blocks that occur again at a distance their level looks at."""
    if len(suffixes.members) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Only stretches of two words that occur again are ever asked for.
    pairs = np.zeros(len(begins) + 1, np.int64)
    slot = np.empty(len(begins), np.int64)
    slot[suffixes.order] = np.arange(len(begins))
    pairs[slot[suffixes.members[1]] + 1] = 1
    kept = pairs[1:] == 1
    before = np.cumsum(pairs)
    matrix = WaveletMatrix(suffixes.order[kept], len(begins))
    at, period = [], []
    for k in range(1, len(suffixes.members)):
        size = 1 << k
        members = suffixes.members[k]
        blocks = members[(members - begins[members]) % size == 0]
        if not len(blocks):
            continue
        names = suffixes.names[k]
        counts = np.bincount(names[members], minlength=len(begins))
        low = before[names[blocks]]
        high = low + counts[names[blocks]]
        least = blocks + (1 if size == 2 else 2 * size - 1)
        most = np.minimum(blocks + (6 if size == 2 else 4 * size - 2), len(begins) - 1)
        if size > 2:
            again = matrix.successor(low, high, blocks + 1)
            overlap = (again > 0) & (again - blocks <= size // 2)
            ends = again[overlap] + suffixes.forward(blocks[overlap], again[overlap])
            least[overlap] = np.maximum(least[overlap], ends - size + 1)
        going = least <= most
        while going.any():
            blocks, low, high, least, most = (x[going] for x in (blocks, low, high, least, most))
            found = matrix.successor(low, high, least)
            going = (found >= 0) & (found <= most)
            at.append(blocks[going])
            period.append(found[going] - blocks[going])
            least = found + 1
            going &= least <= most
    nothing = np.zeros(0, np.int64)
    return np.concatenate([nothing, *at]), np.concatenate([nothing, *period])


def find_runs(ids: np.ndarray, bounds: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, ...]:
    """(sequence, start, length, period) of the runs of the sequences ids[bounds[i]:bounds[i + 1]].

    Sorted by sequence, start and period; starts count from the sequence's first word.
    """
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    begins, ends = bounds[:-1][owner], bounds[1:][owner]
    suffixes = Suffixes(ids, owner, ends)
    at, period = _candidates(suffixes, begins)
    stop = at + period + suffixes.forward(at, at + period)
    start = at - suffixes.backward(at, at + period)
    long = stop - start >= np.maximum(least, 2 * period)
    start, stop, period = start[long], stop[long], period[long]
    order = np.lexsort((period, stop, start))
    start, stop, period = start[order], stop[order], period[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    start, stop, period = start[first], stop[first], period[first]
    order = np.lexsort((period, start))
    start, stop, period = start[order], stop[order], period[order]
    sequence = owner[start] if len(start) else start
    return sequence, start - bounds[:-1][sequence], stop - start, period


def _lists(counts: np.ndarray, values: pa.Array) -> pa.Array:
    ends = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), values)


def _measured(least: int, batch: pa.RecordBatch) -> tuple[pa.Array, pa.Array]:
    """Runs and collapsed text of each row."""
    words = Words(text_of(batch))
    n = len(words.offsets) - 1
    sequence, start, length, period = find_runs(words.ids, words.bounds, least)
    change = np.zeros(len(words.ids) + 1, np.int64)
    begin = words.bounds[:-1][sequence] + start
    np.add.at(change, begin + period, 1)
    np.add.at(change, begin + length, -1)
    kept = np.cumsum(change[:-1]) == 0
    left = words.distinct.take(pa.array(words.ids[kept])).cast(pa.large_string())
    left = pc.binary_join(_lists(np.bincount(words.row[kept], minlength=n), left), pa.scalar(" ", pa.large_string()))
    found = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], names=["start", "length", "period"])
    return _lists(np.bincount(sequence, minlength=n), found), left.cast(pa.string())


def with_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``row`` (all columns of ``docs``), ``runs`` by start, then period, and the ``collapsed`` text.

    Words are runs of characters other than ASCII space. A word goes from the collapsed
    text if a run contains it after the run's first period; the others are joined by one
    space.
    """
    packed = rows(docs)
    schema = T.StructType([*packed.schema.fields, T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE_BYTES):
            yield pa.RecordBatch.from_arrays([batch.column(0), *_measured(least, batch)], names=["row", "runs", "collapsed"])

    return map_batches(packed, run, schema)


def echo(docs: DataFrame) -> DataFrame:
    """doc_id and text, where documents with crc32(doc_id) a multiple of ten get a periodic end.

    With n words and g a tenth of the checksum, the words from number a = g mod n on repeat
    the first p = 1 + (n - a) div (3 + g mod 8) of them. Rows without an id stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all(whole(), F.lit("([^\\x20\\x09-\\x0D]+)"), 1)
    split = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    n, g, a, p = (F.col(name) for name in ("n", "g", "a", "p"))
    placed = (
        split.withColumn("n", F.coalesce(F.size("words"), F.lit(0)))
        .withColumn("a", F.when(n > 0, g % n))
        .withColumn("p", 1 + F.floor((n - a) / (3 + g % 8)))
    )
    number = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
    echoed = F.concat_ws(" ", F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("words", number(i))))
    return placed.select("doc_id", F.when(n > 0, echoed).otherwise(F.col("text")).alias("text"))


def report(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Per document: number of runs, the longest one, and digests of all runs and of the collapsed text."""
    found = with_runs(docs, least)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        best.alias("best"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id",
        "n_runs",
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).cast("long").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents, every tenth of them with a periodic end."""
    return report(echo(table(spark, sf_dir, "documents").select("doc_id", "text")))
