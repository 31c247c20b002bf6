"""Language-model scores from a probabilistic suffix tree over words.

Tokens are the words of a text, A-Z lower-cased, and one end. States of the tree are
contexts of up to ``depth`` words. A context s is a candidate with ``least`` or more
occurrences in the training texts. It is retained if its next words diverge from those of
its longest retained shorter suffix s': the gain

    sum over next words w of  c(s w) ln( P'(w | s) / P(w | s') ),
    P'(w | s) = (c(s w) - 1 + prior P(w | s')) / (c(s) - 1 + prior),

must be at least ``divergence`` for each occurrence of s. P' leaves the scored occurrence
out, so that words seen once behind s speak against it. Distributions are smoothed towards
the shorter state, P(w | s) = (c(s w) + prior P(w | s')) / (c(s) + prior), from the root
P(w) = (c(w) + 1/2) / (N + (V + 1) / 2). A word is scored in the longest retained suffix of
what stands before it in its text; the score is the sum of log10 P.

No task or driver holds the tree, and nothing is broadcast but N and V. Texts are packed into
slices; a slice names its distinct n-grams by hashed keys, with its own training counts, and
sends them to the keys' buckets. A bucket adds up equal keys and answers every slice
that asked, in the order of its keys, so each slice gets the part of the tree its texts meet.
Rounds alternate counts of the next length, asked only behind contexts with enough
occurrences, and sums of gains by context, to which each n-gram is added by the first
slice that holds it. A frequent word or passage is one key for each slice, however often it
occurs. Gains are added as whole numbers, so results do not depend on the slices. Slices
are a table bucketed by slice, so joins with the answers leave them where they are.

Results in special cases: null and empty texts have the end only; a null id counts as
the empty text's checksum (training) and stays null; repeated ids are separate texts; an
empty table gives no rows; without training texts every base probability is 1. A long
text is a slice of its own, about 100 bytes a word while it is handled. Other columns
are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrylight.functions.batches import map_batches
from quarrylight.llm.common import Words, slices, staged, table
from quarrylight.session import scratch_path

#: Longest context in words, fewest occurrences of a context, gain in nats per occurrence, weight of the shorter state.
DEPTH, LEAST, DIVERGENCE, PRIOR = 2, 4, 0.2, 256.0
SLICE_BYTES = 4 << 20
#: Tokens of all texts for each bucket.
BUCKET_TOKENS = 1_000_000
#: Files of the table of slices; Spark's own limit of buckets.
MOST_FILES = 100_000
#: Gains are added in units of 2^-16.
_UNIT = 1 << 16
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: No word holds a space.
_END = b" "


def _pack(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes, first bytes first; sorted keys as their differences."""
    if values.dtype == np.uint64:
        values = np.diff(values, prepend=np.uint64(0))
    flat = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize)
    return zstandard.ZstdCompressor(level=1).compress(flat.T.tobytes())


def _unpack(packed: bytes, dtype: type) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    values = np.ascontiguousarray(flat.reshape(width, -1).T).view(dtype).ravel()
    return np.cumsum(values, dtype=np.uint64) if dtype is np.uint64 else values


def _mixed(keys: np.ndarray, salt: int) -> np.ndarray:
    """Keys spread over all 64 bits; different salts give unrelated keys."""
    keys = keys + np.uint64((salt * 2 + 1) * int(_BASE) & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        keys = (keys ^ (keys >> np.uint64(shift))) * np.uint64(factor)
    return keys ^ (keys >> np.uint64(31))


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, the place of one of each, and the number of the key at each place."""
    order = np.argsort(keys)
    ranked = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    number = np.empty(len(keys), np.int32)
    number[order] = np.cumsum(new, dtype=np.int32) - 1
    return ranked[new], order[new], number


@dataclass(frozen=True)
class Settings:
    depth: int = DEPTH
    least: int = LEAST
    divergence: float = DIVERGENCE
    prior: float = PRIOR


# -- slices -----------------------------------------------------------------------


def _sliced(docs: DataFrame) -> DataFrame:
    """Texts packed into slices: ids, whether held out, tokens, and 96-bit digests of the distinct words.

    Tokens are numbers of words in the order of their digests.
    """
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("slice", T.LongType()),
            T.StructField("ids", T.ArrayType(id_type)),
            T.StructField("held", T.ArrayType(T.BooleanType())),
            T.StructField("sizes", T.ArrayType(T.IntegerType())),
            T.StructField("tokens", T.BinaryType()),
            T.StructField("names", T.BinaryType()),
            T.StructField("more", T.BinaryType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("train_tokens", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for part in slices(batches, SLICE_BYTES):
            words = Words(part.column("text"), lower=True)
            end = len(words.distinct)
            digests = b"".join(xxhash.xxh3_128_digest(w) for w in [*words.distinct.to_pylist(), _END])
            names, more = np.frombuffer(digests, ">u8").astype(np.uint64).reshape(-1, 2).T
            more = (more >> np.uint64(32)).astype(np.int32)
            order = np.lexsort((more, names))
            number_of = np.empty(end + 1, np.int32)
            number_of[order] = np.arange(end + 1)
            tokens = number_of[np.insert(words.ids, words.bounds[1:], end)]
            sizes = words.per_row + 1
            held = part.column("held").to_numpy(zero_copy_only=False).astype(bool)
            one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number]), one(part.column("doc_id")), one(pa.array(held)), one(pa.array(sizes.astype(np.int32))),
                    *(pa.array([_pack(x)], pa.binary()) for x in (tokens, names[order], more[order])),
                    pa.array([len(tokens)]), pa.array([int(sizes[~held].sum())]),
                ],
                names=schema.fieldNames(),
            )
            number += 1

    return map_batches(docs, run, schema)


class Slice:
    """The positions of a slice, taken from round to round by the buckets' answers.

    ``before`` is the number of training occurrences of the n-gram that ends at a position, as
    long as a context of the next round; ``p`` is the probability of its token in the longest
    state known so far.
    """

    def __init__(self, row: dict, settings: Settings) -> None:
        self.settings = settings
        self.tokens = _unpack(row["tokens"], np.int32)
        sizes = np.asarray(row["sizes"], np.int64)
        self.starts = np.cumsum(sizes) - sizes
        self.place = (np.arange(len(self.tokens)) - np.repeat(self.starts, sizes)).astype(np.int32)
        self.train = np.repeat(~np.asarray(row["held"], bool), sizes)
        self.digests = _unpack(row["names"], np.uint64)
        self.hashes = self.digests[self.tokens]
        self.keys, self.number = self.digests, self.tokens

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the distinct words and their training counts."""
        return self.digests, np.bincount(self.tokens[self.train], minlength=len(self.digests))

    def take_words(self, totals: np.ndarray, n: int, v: int) -> None:
        self.counts, self.size = totals, n + 0.5 * (v + 1)
        self.before = totals[self.tokens]
        self.p = (self.before + 0.5) / self.size

    def grams(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the distinct n-grams of a context of ``length`` words and a token, and their training counts."""
        enough = np.zeros(len(self.tokens), bool)
        enough[1:] = self.before[:-1] >= self.settings.least
        self.at = np.flatnonzero(enough & (self.place >= length))
        shifted = np.zeros_like(self.hashes)
        shifted[1:] = self.hashes[:-1] * _BASE
        shifted += self.digests[self.tokens]
        self.hashes = shifted
        keys, self.example, self.gram = _distinct(_mixed(self.hashes[self.at], length))
        # a context is an n-gram of the round before, and named like it
        context = self.number[self.at - 1]
        used = np.zeros(len(self.keys), bool)
        used[context] = True
        self.context_keys, self.context = self.keys[used], (np.cumsum(used, dtype=np.int32) - 1)[context]
        self.keys, self.number = keys, np.full(len(self.tokens), -1, np.int32)
        self.number[self.at] = self.gram
        return keys, np.bincount(self.gram[self.train[self.at]], minlength=len(keys))

    def take_grams(self, totals: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the contexts and the gains of the n-grams that this slice is the first to hold."""
        self.totals = totals[self.gram]
        self.occurred = self.before[self.at - 1]
        mine = np.flatnonzero(first & (totals > 0))
        place = self.example[mine]
        count, occurred, shorter = totals[mine].astype(np.float64), self.occurred[place], self.p[self.at[place]]
        prior = self.settings.prior
        gain = count * np.log((count - 1 + prior * shorter) / ((occurred - 1 + prior) * shorter))
        # sums of whole numbers, exact in doubles
        gains = np.bincount(self.context[place], np.rint(gain * _UNIT), minlength=len(self.context_keys))
        return self.context_keys, gains.astype(np.int64)

    def step(self) -> None:
        """Make the counted n-grams the contexts of the next length, keeping what the test of this one needs."""
        self.tested = (self.at, self.context, self.totals, self.occurred)
        self.before = np.zeros(len(self.tokens), np.int64)
        self.before[self.at] = self.totals

    def take_gains(self, gains: np.ndarray) -> None:
        """Move the positions behind retained contexts into these states."""
        at, context, totals, occurred = self.tested
        kept = gains[context] >= self.settings.divergence * _UNIT * occurred
        at, totals, occurred = at[kept], totals[kept], occurred[kept]
        prior = self.settings.prior
        self.p[at] = (totals + prior * self.p[at]) / (occurred + prior)

    def scores(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Known tokens, base score and score of each text."""
        add = lambda values: np.add.reduceat(values, self.starts)
        base = np.log10((self.counts + 0.5) / self.size)
        return add((self.counts > 0).astype(np.int64)[self.tokens]), add(base[self.tokens]), add(np.log10(self.p))


def _ahead(row: dict, settings: Settings, n: int, v: int) -> tuple[Slice, list]:
    """A slice after all answers it has, and its next requests (kind, keys, values)."""
    part = Slice(row, settings)
    requests = [(0, *part.words())]
    for number, answer in enumerate(row["answers"]):
        requests = []
        if number == 0:
            part.take_words(answer[0][0], n, v)
        if number > 1:
            part.take_gains(answer[1][0])
        if 0 < number <= settings.depth:
            requests.append((1, *part.take_grams(*answer[0])))
            part.step()
        if number < settings.depth:
            requests.append((0, *part.grams(number + 1)))
    return part, requests


# -- rounds -----------------------------------------------------------------------

_SLICE = ("slice", "held", "sizes", "tokens", "names", "more")
_REQUEST = "bucket long, slice long, kind int, keys binary, more binary, counts binary"
_ANSWER = "slice long, kind int, bucket long, totals binary, first binary, n_known long"


def _requests(batch: pa.RecordBatch, settings: Settings, n: int, v: int, buckets: int) -> Iterator[pa.RecordBatch]:
    for row in _rows(batch):
        _, requests = _ahead(row, settings, n, v)
        out: list = [[], [], [], [], [], []]
        more = _unpack(row["more"], np.int32) if "more" in row else np.zeros(0, np.int32)
        for kind, keys, values in requests:
            bucket = ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            heads = np.flatnonzero(np.diff(bucket, prepend=-1))
            for start, stop in zip(heads, [*heads[1:], len(bucket)]):
                packed = (_pack(x[start:stop]) for x in (keys, more, values))
                mine = (int(bucket[start]) * 2 + kind, row["slice"], kind, *packed)
                for column, value in zip(out, mine):
                    column.append(value)
        types = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(out, types)], names=["bucket", "slice", "kind", "keys", "more", "counts"]
        )


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Slices of a batch, each with its answers: by round and kind, (totals, first) in the order of keys."""
    for i in range(batch.num_rows):
        row = {name: batch.column(name)[i].as_py() for name in batch.schema.names if name in _SLICE}
        answers = []
        for name in batch.schema.names:
            if name.startswith("answer"):
                kinds: dict = {}
                for kind in (0, 1):
                    mine = sorted((a for a in batch.column(name)[i].as_py() or [] if a["kind"] == kind), key=lambda a: a["bucket"])
                    totals = [_unpack(a["totals"], np.int64) for a in mine]
                    first = [np.unpackbits(np.frombuffer(a["first"], np.uint8))[: len(t)] for a, t in zip(mine, totals)]
                    nothing = np.zeros(0, np.int64)
                    kinds[kind] = (np.concatenate([nothing, *totals]), np.concatenate([nothing, *first]).astype(bool))
                answers.append(kinds)
        yield row | {"answers": answers}


def _added(requests: pa.Table) -> pa.Table:
    """Sums of equal keys of one bucket, answered to every slice; the lowest slice with a key is its first."""
    requests = requests.sort_by("slice")
    keys = [_unpack(x.as_py(), np.uint64) for x in requests.column("keys")]
    more = [_unpack(x.as_py(), np.int32) for x in requests.column("more")]
    sizes = np.array([len(k) for k in keys])
    joined, values = np.concatenate(keys), np.concatenate([_unpack(x.as_py(), np.int64) for x in requests.column("counts")])
    rest = np.concatenate(more)
    order = np.lexsort((rest, joined)) if len(rest) else np.argsort(joined, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = joined[order][1:] != joined[order][:-1]
    if len(rest):
        new[1:] |= rest[order][1:] != rest[order][:-1]
    heads = np.flatnonzero(new)
    sums = np.add.reduceat(values[order], heads)
    totals, first = np.empty(len(order), np.int64), np.empty(len(order), bool)
    totals[order] = np.repeat(sums, np.diff(np.append(heads, len(order))))
    first[order] = new
    cuts = np.cumsum(sizes)[:-1]
    known = np.zeros(len(sizes), np.int64)
    known[0] = (sums > 0).sum()
    return pa.table(
        {
            "slice": requests.column("slice"), "kind": requests.column("kind"), "bucket": requests.column("bucket"),
            "totals": pa.array([_pack(t) for t in np.split(totals, cuts)], pa.binary()),
            "first": pa.array([np.packbits(f).tobytes() for f in np.split(first, cuts)], pa.binary()),
            "n_known": pa.array(known),
        }
    )


def _answered(state: DataFrame, settings: Settings, n: int, v: int, buckets: int) -> DataFrame:
    """The answers to the next requests of all slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _requests(batch, settings, n, v, buckets)

    asked = map_batches(state, run, _REQUEST)
    return asked.groupBy("bucket").applyInArrow(_added, _ANSWER)


def _joined(state: DataFrame, answers: DataFrame, number: int) -> DataFrame:
    """``state`` with its answers. Both are bucketed by slice, so neither moves."""
    by_slice = answers.groupBy("slice").agg(F.collect_list(F.struct("kind", "bucket", "totals", "first")).alias(f"answer{number}"))
    return state.join(by_slice.hint("merge"), "slice", "left")


class _Tables:
    """Tables bucketed by slice, so that joins by slice leave them where they are."""

    def __init__(self, spark: SparkSession, files: int) -> None:
        self.spark, self.files, self.names = spark, files, []

    def store(self, df: DataFrame) -> DataFrame:
        name = f"quarrylight_slices_{uuid.uuid4().hex}"
        df.write.bucketBy(self.files, "slice").option("path", scratch_path(self.spark, "slices")).format("parquet").saveAsTable(name)
        self.names.append(name)
        return self.spark.table(name)

    def drop(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE {name}")


def score(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each (doc_id, text, held).

    Texts with ``held`` are scored and not learned from.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", "held")
    text_bytes = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    files = min(MOST_FILES, max(text_bytes // SLICE_BYTES + 1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    tables = _Tables(spark, files)
    parts = tables.store(_sliced(docs))
    size = parts.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.coalesce(F.sum("train_tokens"), F.lit(0))).first()
    n, v, buckets = size[1], 0, 1 + size[0] // BUCKET_TOKENS
    state = parts.select("slice", "ids", "held", "sizes", "tokens", "names")
    for number in range(settings.depth + 2 if settings.depth else 1):
        asking = state.drop("ids") if number else parts.select(*_SLICE)
        answers = tables.store(_answered(asking, settings, n, v, buckets).repartition(files, "slice"))
        if number == 0:
            v = answers.agg(F.coalesce(F.sum("n_known"), F.lit(0))).first()[0]
        state = _joined(state, answers, number)
    scored = staged(_scored(state, settings, n, v), "scores")
    tables.drop()
    return scored


def _scored(state: DataFrame, settings: Settings, n: int, v: int) -> DataFrame:
    """The texts of all slices with their measures."""
    id_type = state.schema["ids"].dataType.elementType
    schema = T.StructType(
        [
            T.StructField("doc_id", id_type), T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
            T.StructField("n_known", T.LongType()), T.StructField("train_tokens", T.LongType()),
            T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(_rows(batch)):
                part, _ = _ahead(row, settings, n, v)
                known, base, found = part.scores()
                ids = batch.column("ids")[i].values
                sizes = np.asarray(row["sizes"], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(row["held"], pa.bool_()), pa.array(sizes), pa.array(known), pa.array(np.full(len(sizes), n)), pa.array(base), pa.array(found)],
                    names=schema.fieldNames(),
                )

    return map_batches(state, run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, learned from four fifths of them by checksum of the id."""
    docs = table(spark, sf_dir, "documents")
    checksum = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return score(docs.select("doc_id", "text", (checksum % 5 == 1).alias("held")))
