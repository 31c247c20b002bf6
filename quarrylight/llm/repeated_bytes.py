"""Removal of every byte that a repeated 200-byte string covers.

A window is a 200-byte string inside one document. Its anchor is the 64-byte gram in it
with the smallest hash, the leftmost of equals, so equal windows have equal anchors at equal
places. Consecutive windows with one anchor form a segment. Anchors are counted over the
corpus, and only segments whose anchor occurs again are read from their texts. Equal
segments that meet in a slice are decided there and sent once; all segments of an anchor
then meet in one sorted shuffle file, which a task reads in sequence, in blocks.

In a block the segments are aligned on their anchors and the suffix order of the collection
is built column by column, from the right: each round puts the next symbol of every segment
before its suffix, which sorts the collection by (symbol, order of the round before), the
step of a multi-document Burrows-Wheeler construction, and updates the common prefixes of
neighbours by range minima. Windows whose common prefix with a neighbour reaches 200 bytes
are repeated. Alignment makes it the positional form of the transform: suffixes of different
columns are never equal windows, so they need not be merged, and a block takes time in
proportion to its bytes. A segment whose anchor is very frequent is cut into parts of eight
windows that meet by the 193 bytes all eight share, which spreads a hot anchor.

Null text is empty and loses nothing, as do texts below 200 bytes. Repeated rows repeat
each other. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrylight.llm.common import slices, staged, table, text_bytes, text_hash
from quarrylight.session import ship

LENGTH = 200
GRAM = 64
#: An anchor with more segments than this is split by what surrounds it.
HOT = 50_000
#: Windows in a part of such a segment.
PART = 8
#: Segments that a task joins at a time; more only if one key has more.
BLOCK = 20_000
_REACH = LENGTH - GRAM  # windows start at most so far before their anchor
_CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64, for one chunk."""
    if not _POWERS:
        n = _CHUNK + 2 * LENGTH
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            _POWERS.append(np.cumprod(np.append(np.ones(1, np.uint64), np.full(n, base, np.uint64)), dtype=np.uint64))
    return _POWERS[0], _POWERS[1]


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    up, down = _powers()
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:], dtype=np.uint64)
    h = (total[GRAM:] - total[: n - GRAM + 1]) * down[: n - GRAM + 1]
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Document, anchor, first window, last window (places in ``data``) and anchor hash of all segments."""
    found = []
    mask = np.uint64((1 << 21) - 1)
    for base in range(0, max(0, len(data) - LENGTH + 1), _CHUNK):
        part = data[base : base + _CHUNK + LENGTH - 1]
        h = _gram_hashes(part)
        low = (h & ~mask) | np.arange(len(h), dtype=np.uint64)
        width = 1
        while 2 * width <= _REACH + 1:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        rest = _REACH + 1 - width
        low = np.minimum(low[: len(low) - rest], low[rest:])
        anchor = (low & mask).astype(np.int64)
        window = np.arange(base, base + len(anchor))
        doc = np.searchsorted(offsets, window, "right") - 1
        valid = window + LENGTH <= offsets[doc + 1]
        window, anchor, doc = window[valid], anchor[valid], doc[valid]
        if not len(window):
            continue
        new = np.ones(len(window), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(window)) - 1
        found.append((doc[first], anchor[first] + base, window[first], window[last], h[anchor[first]].view(np.int64)))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*found))


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        data, offsets = text_bytes(part.column("text"))
        doc, anchor, first, last, key = segments(data, offsets)
        # one number: the first window, how far on the anchor lies, and how many windows follow
        place = (first - offsets[doc]) << 16 | (anchor - first) << 8 | (last - first)
        row = pa.array(doc)
        yield pa.RecordBatch.from_arrays(
            [part.column("hash").take(row), pa.array(key), pa.array(place)], names=["hash", "key", "place"]
        )


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _parts(text: bytes, s: dict) -> Iterator[tuple[int, int, int, int]]:
    """key, anchor, first and last window of a segment, or of its parts if its anchor is hot."""
    window = s["place"] >> 16
    anchor, end = window + (s["place"] >> 8 & 255), window + (s["place"] & 255)
    if not s["hot"]:
        yield s["key"], anchor, window, end
        return
    while window <= end:
        number = (window - anchor + _REACH) // PART
        low = number * PART + anchor - _REACH  # of all windows that such a part can have
        last = min(end, low + PART - 1)
        core = text[low + PART - 1 : low + LENGTH]
        yield _signed(xxhash.xxh64_intdigest(core, number)), anchor, window, last
        window = last + 1


def _send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each distinct segment of a slice once; those found twice are decided."""
    for part in slices(batches):
        texts = part.column("text").cast(pa.large_binary()).to_pylist()
        seen: dict[tuple[int, bytes], list[tuple[int, int, int, int]]] = {}
        for row, (text, parts) in enumerate(zip(texts, part.column("segments").to_pylist())):
            for s in parts:
                for key, anchor, first, last in _parts(text, s):
                    seen.setdefault((key, text[first : last + LENGTH]), []).append((row, first, last, anchor - first))
        rows = []  # row, key, first (-1: nobody asks), windows, align, bytes (null: decided)
        for (key, text), places in seen.items():
            row, first, last, align = places[0]
            if len(places) == 1:
                rows.append((row, key, first, last - first + 1, align, text))
                continue
            rows.append((row, key, -1, last - first + 1, align, text))
            rows += [(r, _signed(xxhash.xxh64_intdigest(f"{key}:{r}:{f}")), f, w - f + 1, 0, None) for r, f, w, _ in places]
        if not rows:
            continue
        row, key, first, windows, align, text = zip(*rows)
        row = pa.array(row, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [part.column("hash").take(row), pa.array(key, pa.int64()), pa.array(first, pa.int64()),
             pa.array(windows, pa.int64()), pa.array(align, pa.int64()), pa.array(text, pa.binary())],
            names=["hash", "key", "first", "windows", "align", "segment"],
        )


def repeated_windows(key: np.ndarray, align: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Number of the segment, and window in it, of all windows that another segment of its key has.

    ``order`` holds the segments by key and by their suffix from the current column on,
    ``prefix`` the common prefix of each with the one before. The array ``symbols`` taken in
    this order is the round's column of the transform.
    """
    sizes = np.array([len(t) for t in texts])
    flat = np.frombuffer(b"".join(texts), np.uint8)
    base = np.cumsum(sizes) - sizes + align  # place of column 0 in ``flat``
    begin, end = -align, sizes - align
    by_end = np.argsort(-end, kind="stable")
    _, group = np.unique(key, return_inverse=True)
    order, prefix = np.zeros(0, np.int64), np.zeros(0, np.int64)
    entered = 0
    found_at, found_window = [], []
    for column in range(int(end.max()) - 1, int(begin.min()) - 1, -1):
        upto = entered
        while upto < len(by_end) and end[by_end[upto]] > column:
            upto += 1
        if upto > entered:  # their suffix was empty until now
            order = np.concatenate((by_end[entered:upto], order))
            prefix = np.concatenate((np.zeros(upto - entered, np.int64), prefix))
            entered = upto
        stays = begin[order] <= column
        if not stays.all():
            kept = np.flatnonzero(stays)
            if not len(kept):
                order, prefix = order[:0], prefix[:0]
                continue
            prefix = np.minimum.reduceat(prefix[: kept[-1] + 1], np.append(0, kept[:-1] + 1))
            order = order[kept]
        if not len(order):
            continue
        symbols = flat[base[order] + column]
        rank = group[order] * 256 + symbols
        moved = np.argsort(rank, kind="stable")
        rank, left, right = rank[moved], moved[:-1], moved[1:]
        new = np.zeros(len(order), np.int64)
        new[1:] = prefix[right]
        gaps = np.flatnonzero((right != left + 1) & (rank[1:] == rank[:-1]))
        if len(gaps):
            bounds = np.empty(2 * len(gaps), np.int64)
            bounds[::2], bounds[1::2] = left[gaps] + 1, right[gaps] + 1
            new[gaps + 1] = np.minimum.reduceat(np.append(prefix, 0), bounds)[::2]
        new += 1
        new[0] = 0
        new[1:][rank[1:] != rank[:-1]] = 0
        order, prefix = order[moved], new
        if column <= 0:
            equal = prefix >= LENGTH
            equal[:-1] |= equal[1:].copy()
            hit = order[equal]
            found_at.append(hit)
            found_window.append(column - begin[hit])
    if not found_at:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_at), np.concatenate(found_window)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole keys, of about BLOCK rows, from sorted batches."""
    rest: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        rest.append(batch)
        held += batch.num_rows
        if held < BLOCK:
            continue
        whole = pa.Table.from_batches(rest)
        key = whole.column("key").to_numpy()
        cut = int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0
        if cut:
            yield whole.slice(0, cut)
            rest = whole.slice(cut).to_batches()
            held = whole.num_rows - cut
    if rest:
        yield pa.Table.from_batches(rest)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in _blocks(batches):
        texts = block.column("segment").to_pylist()
        first, windows = block.column("first").to_numpy(), block.column("windows").to_numpy()
        decided = np.array([t is None for t in texts])
        at, start, stop = [np.flatnonzero(decided)], [first[decided]], [first[decided] + windows[decided] - 1]
        asked = np.flatnonzero(~decided)
        if len(asked) > 1:
            key, align = block.column("key").to_numpy()[asked], block.column("align").to_numpy()[asked]
            which, window = repeated_windows(key, align, [texts[i] for i in asked])
            order = np.lexsort((window, which))
            which, window = asked[which[order]], window[order]
            which, window = which[first[which] >= 0], window[first[which] >= 0]
            new = np.ones(len(which), bool)
            new[1:] = (which[1:] != which[:-1]) | (window[1:] != window[:-1] + 1)
            heads = np.flatnonzero(new)
            tails = np.append(heads[1:], len(which)) - 1 if len(heads) else heads
            at.append(which[heads])
            start.append(first[which[heads]] + window[heads])
            stop.append(first[which[heads]] + window[tails])
        at = pa.array(np.concatenate(at))
        hashed = block.column("hash").combine_chunks()
        yield pa.RecordBatch.from_arrays(
            [hashed.take(at), pa.array(np.concatenate(start)), pa.array(np.concatenate(stop) + LENGTH)],
            names=["hash", "start", "stop"],
        )


def _merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    found: list[tuple[int, int]] = []
    for start, stop in sorted((s["start"], s["stop"]) for s in spans or ()):
        if found and start <= found[-1][1]:
            found[-1] = (found[-1][0], max(stop, found[-1][1]))
        else:
            found.append((start, stop))
    return found


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        kept, counts = [], []
        for text, spans in zip(part.column("text").cast(pa.large_binary()).to_pylist(), part.column("spans").to_pylist()):
            text = text or b""
            merged = _merged(spans)
            left, at = [], 0
            for start, stop in merged:
                left.append(text[at:start])
                at = stop
            kept.append(b"".join(left) + text[at:])
            counts.append((len(text), len(text) - len(kept[-1]), len(merged)))
        n_bytes, n_removed, n_spans = zip(*counts)
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), *[pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)],
             pa.array([hashlib.sha256(x).hexdigest() for x in kept]), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", text_hash().alias("hash"), docs["text"].cast("string").alias("text"))


def spans(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """Text hash and the byte spans (start, stop) of repeated windows, where there are any.

    Equal texts have equal spans, so a text's hash names its rows all along.
    """
    ship(docs.sparkSession)
    docs = _hashed(docs).drop("doc_id")
    anchors = staged(docs.mapInArrow(_anchors, "hash long, key long, place long"), "anchors")
    shared = anchors.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key", (F.col("n") > hot).alias("hot"))
    # No broadcasts here: anchors and spans grow with the texts.
    few = anchors.join(shared, "key").groupBy("hash").agg(F.collect_set(F.struct("key", "place", "hot")).alias("segments"))
    few = staged(few, "segments")
    sent = docs.join(few, "hash").select("hash", "text", "segments")
    sent = sent.mapInArrow(_send, "hash long, key long, first long, windows long, align long, segment binary")
    found = sent.repartition("key").sortWithinPartitions("key").mapInArrow(_compare, "hash long, start long, stop long")
    return found.groupBy("hash").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))


def cut(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, counts, the digest of the remaining bytes and the bytes themselves."""
    found = staged(spans(docs, hot), "spans")
    docs = _hashed(docs)
    joined = docs.join(found, "hash", "left").select("doc_id", "text", "spans")
    kinds = [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")]
    kinds += [T.StructField("kept_sha256", T.StringType()), T.StructField("kept", T.BinaryType())]
    return joined.mapInArrow(_cut, T.StructType([docs.schema["doc_id"], *kinds]))


def query(spark, sf_dir: str) -> DataFrame:
    return cut(table(spark, sf_dir, "documents")).drop("kept")
