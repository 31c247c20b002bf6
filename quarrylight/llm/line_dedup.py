"""Removal of lines that repeat, exactly or within one word of another, over all documents.

Lines are the ``\\n``-separated parts with a word. Equal lines are one line at its earliest
place, in the order of doc_id, text hash, line number. Lines of ten or more words are also
within the bound of each other if one word is replaced, put in or left out. Candidates are
distinct lines that share a beginning or an end with another, up to half of their words: an
edit of one word leaves one of the two untouched, so no pair is lost. Each emits its deletion
neighbourhood, the line without each word in turn and the whole line, as hashed keys.
Equal keys with equal places are a replaced word; a whole line that equals another's
deletion is a word more. The distance is then verified on the words. A line goes if an
earlier line lies within its bound, whether or not that one stays.

Groups of equal keys are reduced to their earliest member by aggregation, so that a line in
a third of all documents, or thousands of lines of one template, make one row per task and
no pairs. Null text has no lines; blank lines always stay. A null doc_id ranks last. Rows
with equal doc_id and text are one document, and each gets its result. An empty table gives
no rows. Extra columns are kept by ``remove_lines``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrylight.llm.common import rows, same, slices, staged, table, text_hash, whole
from quarrylight.llm.decontaminate import _small
from quarrylight.session import ship

#: Shortest line, in words, that a near line may replace; at least twice ENDS.
MIN_WORDS = 10
#: Fewest words at either end that name a candidate; longer lines use twice, four times as many, and so on.
ENDS = 5
_MASK = (1 << 64) - 1
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _end_lengths(n: int) -> list[int]:
    """Lengths of the ends that a line of n words shares with lines of n - 1 to n + 1 words."""
    found = set()
    for m in (n - 1, n, n + 1):
        if m >= MIN_WORDS:
            found.add(ENDS << (m // (2 * ENDS)).bit_length() - 1)
    return sorted(h for h in found if h <= n)


def _texts(part: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in part.column("text").cast(pa.large_binary()).to_pylist()]


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        row, line, high, low, ends = [], [], [], [], []
        for r, text in enumerate(_texts(part)):
            for i, raw in enumerate(text.split(b"\n")):
                words = raw.split()
                if not words:
                    continue
                digest = xxhash.xxh3_128_intdigest(raw)
                row.append(r)
                line.append(i)
                high.append(_signed(digest >> 64))
                low.append(_signed(digest & _MASK))
                here = []
                if len(words) >= MIN_WORDS:
                    for h in _end_lengths(len(words)):
                        here.append(_signed(xxhash.xxh64_intdigest(b" ".join(words[:h]), 2 * h)))
                        here.append(_signed(xxhash.xxh64_intdigest(b" ".join(words[-h:]), 2 * h + 1)))
                ends.append(here)
        taken = pa.array(row, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id").take(taken), part.column("hash").take(taken), pa.array(line, pa.int32())]
            + [pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(ends, pa.list_(pa.int64()))],
            names=["doc_id", "hash", "line", "high", "low", "ends"],
        )


def _variants_of(words: list[bytes]) -> np.ndarray:
    """Hashes of the words without each one in turn, then of all of them."""
    h = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
    n = len(h)
    powers = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, _BASE))), dtype=np.uint64)
    shifted = h[1:] * powers[: n - 1]
    before = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * powers[:n], dtype=np.uint64)))
    after = np.concatenate((np.cumsum(shifted[::-1], dtype=np.uint64)[::-1], np.zeros(1, np.uint64)))
    # the length tells a line from one that ends in words whose hashes vanish
    return np.concatenate((before[:n] + after + np.uint64(n - 1), before[n:] + np.uint64(n)))


def _neighbourhood(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        row, line, sizes, keys, whole_line = [], [], [], [], []
        for r, (text, wanted) in enumerate(zip(_texts(part), part.column("lines").to_pylist())):
            parts = text.split(b"\n")
            for i in wanted:
                words = parts[i].split()
                row.append(r)
                line.append(i)
                sizes.append(len(words) + 1)
                keys.append(_variants_of(words))
                whole_line.append(b" ".join(words))
        if not row:
            continue
        sizes = np.array(sizes)
        at = np.repeat(np.arange(len(sizes)), sizes)
        ends = np.cumsum(sizes)
        place = np.arange(len(at)) - np.repeat(ends - sizes, sizes)
        place[ends - 1] = -1
        taken = pa.array(np.array(row)[at])
        words = pa.array(whole_line, pa.large_binary()).take(pa.array(np.where(place < 0, at, 0), mask=place >= 0))
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id").take(taken),
                part.column("hash").take(taken),
                pa.array(np.array(line)[at], pa.int32()),
                pa.array(np.concatenate(keys).view(np.int64)),
                pa.array(place, pa.int32()),
                words.cast(pa.binary()),
            ],
            names=["doc_id", "hash", "line", "key", "place", "words"],
        )


def _within_one(a: list[bytes], b: list[bytes]) -> bool:
    """Whether at most one word is replaced, put in or left out."""
    if abs(len(a) - len(b)) > 1:
        return False
    same_start = 0
    while same_start < min(len(a), len(b)) and a[same_start] == b[same_start]:
        same_start += 1
    skip_a, skip_b = same_start + (len(a) >= len(b)), same_start + (len(b) >= len(a))
    return a[skip_a:] == b[skip_b:]


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("words").to_pylist(), batch.column("other").to_pylist())
        fits = pa.array([_within_one(a.split(), b.split()) for a, b in pairs], pa.bool_())
        yield batch.select(["pos"]).filter(fits)


def _pos() -> Column:
    """A line's place; its order is that of documents and lines."""
    return F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id"), F.col("hash"), F.col("line")).alias("pos")


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", text_hash().alias("hash"), docs["text"].cast("string").alias("text"))


def lines(docs: DataFrame) -> DataFrame:
    """Every line with a word: place, digest, and the keys of its ends if it is long."""
    ship(docs.sparkSession)
    docs = _hashed(docs)
    kinds = [("line", T.IntegerType()), ("high", T.LongType()), ("low", T.LongType()), ("ends", T.ArrayType(T.LongType()))]
    schema = T.StructType([docs.schema["doc_id"], docs.schema["hash"], *[T.StructField(n, k) for n, k in kinds]])
    return docs.mapInArrow(_lines, schema)


def distinct_lines(found: DataFrame) -> DataFrame:
    return found.select("high", "low", "ends", _pos()).groupBy("high", "low").agg(
        F.min("pos").alias("pos"), F.count(F.lit(1)).alias("n"), F.min("ends").alias("ends")
    )


def _candidates(distinct: DataFrame) -> DataFrame:
    """doc_id, hash and the numbers of its earliest lines that share an end with another line."""
    ends = distinct.select("pos", F.explode("ends").alias("end"))
    shared = ends.groupBy("end").agg(F.min("pos").alias("a"), F.max("pos").alias("b")).filter("a < b").select("end")
    few = staged(ends.join(_small(staged(shared, "ends")), "end", "left_semi").select("pos"), "sharing")
    return few.select("pos.doc_id", "pos.hash", "pos.line").groupBy("doc_id", "hash").agg(
        F.collect_set("line").alias("lines")
    )


def _near(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """The places of distinct lines with an earlier line within one word."""
    few = _small(staged(_candidates(distinct), "candidates"))
    texts = _hashed(docs)
    texts = texts.join(few, same(texts, few, "doc_id", "hash")).select(
        texts["doc_id"], texts["hash"], "text", "lines"
    )
    kinds = [("line", T.IntegerType()), ("key", T.LongType()), ("place", T.IntegerType()), ("words", T.BinaryType())]
    schema = T.StructType([texts.schema["doc_id"], texts.schema["hash"], *[T.StructField(n, k) for n, k in kinds]])
    keys = staged(texts.mapInArrow(_neighbourhood, schema).select("key", "place", "words", _pos()), "neighbourhood")
    # A line can have a key at two places, so this keeps a few keys too many, and no fewer.
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    few_keys = staged(keys.join(_small(staged(shared, "keys")), "key", "left_semi").select("key", "place", "pos"), "shared")
    replaced = few_keys.groupBy("key", "place").agg(F.min("pos").alias("a"))
    entire = few_keys.filter("place < 0").groupBy("key").agg(F.min("pos").alias("w"))
    parts = few_keys.filter("place >= 0").groupBy("key").agg(F.min("pos").alias("d"))
    bounds = replaced.join(entire, "key", "left").join(parts, "key", "left").select(
        "key", "place",
        F.least("a", F.when(F.col("place") < 0, F.col("d")).otherwise(F.col("w"))).alias("other"),
    )
    pairs = few_keys.join(_small(staged(bounds, "bounds")), ["key", "place"]).filter("other < pos")
    pairs = pairs.groupBy("pos").agg(F.min("other").alias("other"))
    known = keys.filter("place < 0").select("pos", "words")
    checked = pairs.join(known, "pos").join(known.select(F.col("pos").alias("other"), F.col("words").alias("second")), "other")
    checked = checked.select("pos", "words", F.col("second").alias("other"))
    return checked.mapInArrow(_verified, checked.select("pos").schema)


def repeated_lines(docs: DataFrame) -> DataFrame:
    """doc_id, hash and the sorted numbers of the lines that go, where there are any."""
    found = staged(lines(docs), "lines")
    distinct = staged(distinct_lines(found), "distinct")
    near = staged(_near(docs, distinct), "near").withColumn("near", F.lit(True))
    marked = distinct.select("high", "low", "pos", "n").join(near, "pos", "left")
    marked = staged(marked.filter("n > 1 OR near").select("high", "low", F.col("pos").alias("kept"), "near"), "marked")
    placed = found.select("high", "low", _pos())
    gone = placed.join(_small(marked), ["high", "low"]).filter("near OR pos != kept").select("pos.doc_id", "pos.hash", "pos.line")
    return gone.groupBy("doc_id", "hash").agg(
        F.array_sort(F.collect_set("line")).alias("gone")
    )


def report(docs: DataFrame) -> DataFrame:
    """Per document its lines and the numbers, from 0, of those that go."""
    gone = staged(repeated_lines(docs), "gone")
    base = docs.select("doc_id", text_hash().alias("hash"), F.size(F.split(whole(), "\n")).cast("long").alias("n_lines"))
    return base.join(gone, same(base, gone, "doc_id", "hash"), "left").select(
        base["doc_id"], "n_lines",
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join("gone", ","), F.lit("")).alias("removed_lines"),
    )


def remove_lines(docs: DataFrame, least_left: float = 0.0) -> DataFrame:
    """``docs`` without the lines that go; documents of which no word is left go as well.

    So do documents that keep less than the share ``least_left`` of their characters: what is
    left of a near copy are fragments cut out of their context. n_chars, where it is a column,
    counts the new text. Other columns stay, whatever their names.
    """
    gone = staged(repeated_lines(docs), "gone")
    base = rows(docs, text_hash(docs["text"]).alias("hash"))
    joined = base.join(gone, F.col("row.doc_id").eqNullSafe(gone["doc_id"]) & (base["hash"] == gone["hash"]), "left")
    before = F.col("row.text")
    left = F.array_join(F.filter(F.split(before, "\n"), lambda x, i: ~F.array_contains("gone", i)), "\n")
    cut = joined.select("row", F.col("gone").isNotNull().alias("cut"), F.when(F.col("gone").isNull(), before).otherwise(left).alias("text"))
    enough = F.col("text").rlike(r"[^\x20\x09-\x0D]") & (F.length("text") >= least_left * F.length(before))
    kept = cut.filter(~F.col("cut") | enough)
    columns = {c: F.col("row").getField(c) for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in columns:
        counted = F.length("text").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(F.col("cut"), counted).otherwise(columns["n_chars"])
    return kept.select(*[c.alias(name) for name, c in columns.items()])


def query(spark, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))
