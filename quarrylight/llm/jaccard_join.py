"""Exact join of documents by the Jaccard distance of their word n-gram sets.

The distance is a metric; documents link within radius r = 1 - percent / 100. Unrelated documents are
at distance 1 from nearly every document, so the first pivots are the shingles themselves,
as sets of one: a document lies in the regions of its rarest shingles, in so many that a
link cannot miss all common regions (|x| - ceil(percent |x| / 100) + 1 of them). Shingles that are
frequent within slices of the corpus come last in the order, so they make no regions; the
order can be any, so this costs no link. Sizes are distances from the empty set, scaled:
each region is cut into size bands, and documents are replicated into the next band, which
is the triangle inequality's window. The smallest document of a region and band is its
pivot; regions with one pivot are one.

Within a region a bound on the distance comes first: sets are hashed to parity bitmaps,
whose Hamming distance is a metric and never exceeds the number of different shingles.
Documents joined by pairs that it cannot exclude form coarse regions. These are joined
exactly: distances to a pivot, links within r, and for the next pivot only those documents
whose distance to the earlier pivots lies within r of its own. Regions of more than a
fixed number of rows or shingles are dealt out as pairs of blocks.

Shingles are hashed to 64 bits, and equal sets are joined once as a class, named by 128
bits; copies never meet in pairs. Null text is empty; documents without words have no shingles and link
with nothing. Repeated rows and equal doc_ids are rows of their own. A component without a
doc_id has a null id. An empty table gives no rows. Extra columns pass ``keep_one``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrylight.llm.common import Words, rows, same, slices, staged, table, text_hash
from quarrylight.llm.decontaminate import _small
from quarrylight.llm.graph import components
from quarrylight.session import ship

#: Words of a shingle; a link needs 100 * intersection >= percent * union. These are the
#: query's, and what functions take if nothing else is given.
SHINGLE, PERCENT = 4, 85
#: A shingle in so many documents of a slice is reported as frequent.
LOCAL = 4
#: So many of the most frequent shingles, at most, are moved to the end of the order.
FREQUENT = 1 << 18
#: Rows of a region, and shingles of a coarse region, that one task takes.
ROWS, SHINGLES = 20_000, 4_000_000
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = Words(column, lower=True)
    distinct = [xxhash.xxh64_intdigest(w) for w in words.distinct.to_pylist()]
    h = np.array(distinct, np.uint64)[words.ids] if distinct else np.zeros(0, np.uint64)
    runs = max(0, len(h) - size + 1)
    s = np.full(runs, np.uint64(size))
    for i in range(size):
        s = s * _MULTIPLIER + h[i : i + runs]
    s = _mixed(s)
    found = []
    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        if b - a >= size:
            found.append(np.unique(s[a : b - size + 1]))
        elif b > a:
            one = np.array([b - a], np.uint64)
            for w in h[a:b]:
                one = one * _MULTIPLIER + w
            found.append(_mixed(one))
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def _class_of(shingles: np.ndarray) -> bytes:
    """128 bits: of ten billion sets no two different ones may have one name."""
    return xxhash.xxh3_128_digest(shingles.tobytes())


def parity(shingles: np.ndarray) -> bytes:
    """One bit per hash value, set if an odd number of shingles has it."""
    bits = 64
    while bits < len(shingles):
        bits *= 2
    counts = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def _signatures(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "hash", "n", "class", "bits", "key", "count"]
        for part in slices(batches):
            sets = shingle_sets(part.column("text"), size)
            n = [len(s) for s in sets]
            of = [_class_of(s) if len(s) else None for s in sets]
            bits = [parity(s) if len(s) else None for s in sets]
            none = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("hash"), pa.array(n, pa.int64()), pa.array(of, pa.binary()),
                 pa.array(bits, pa.binary()), none, none], names=names,
            )
            keys, counts = np.unique(np.concatenate(sets), return_counts=True)
            often = counts >= LOCAL
            if often.any():
                k = int(often.sum())
                nothing = [pa.nulls(k, t) for t in (part.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.binary(), pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    nothing + [pa.array(keys[often].view(np.int64)), pa.array(counts[often], pa.int64())], names=names
                )

    return run


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n + -percent * n // 100 + 1


def band_width(percent: int = PERCENT) -> float:
    """Logarithm of the widest ratio of the sizes of two linked sets, and a little more."""
    return math.log(1 / (percent / 100 - 0.001))


def _prefixes(frequent_keys, frequent_ranks, size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, ranks = frequent_keys.value, frequent_ranks.value
        seen: set[bytes] = set()  # classes of this task
        for part in slices(batches):
            keys, classes, sizes, counts = [], [], [], []
            for s in shingle_sets(part.column("text"), size):
                if not len(s) or (of := _class_of(s)) in seen:
                    continue
                seen.add(of)
                p = prefix_length(len(s), percent)
                if len(known):
                    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    rank = np.where(known[at] == s, ranks[at], 0)
                    if rank.any():
                        s = s[np.argsort(rank, kind="stable")]
                keys.append(s[:p].view(np.int64))
                classes.append(of)
                sizes.append(len(s))
                counts.append(len(keys[-1]))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys)), pa.array(classes, pa.binary()).take(pa.array(np.repeat(np.arange(len(classes)), counts))),
                     pa.array(np.repeat(np.array(sizes, np.int64), counts))],
                    names=["key", "class", "n"],
                )

    return run


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of equal keys in sorted batches, whole, also across batches."""
    rest: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            key = tuple(c[a] for c in columns)
            if last is not None and key != last:
                yield pa.Table.from_batches(rest)
                rest = []
            rest.append(batch.slice(a, b - a))
            last = key
    if rest:
        yield pa.Table.from_batches(rest)


def _fold(bits: bytes, size: int) -> np.ndarray:
    x = np.frombuffer(bits, np.uint8)
    while len(x) > size:
        half = len(x) // 2
        x = x[:half] ^ x[half:]
    return x


def _coarse(percent: int):
    """Edges that connect all members of a region which the bitmaps cannot keep apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for region in groups(batches, ["pivot", "band", "i", "j"]):
            classes = np.array(region.column("class").to_pylist(), object)
            if len(classes) < 2:
                continue
            n = region.column("n").to_numpy()
            raw = region.column("bits").to_pylist()
            width = min(map(len, raw))
            bits = np.stack([_fold(x, width) for x in raw])
            left = np.arange(len(classes))
            while len(left):
                root, queue, left = left[0], [left[0]], left[1:]
                while queue and len(left):
                    x = queue.pop()
                    apart = np.bitwise_count(bits[left] ^ bits[x]).sum(1, dtype=np.int64)
                    near = (100 + percent) * apart <= (100 - percent) * (n[left] + n[x])
                    queue += left[near].tolist()
                    b += classes[left[near]].tolist()
                    a += [classes[root]] * int(near.sum())
                    left = left[~near]
            if len(a) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])
                a, b = [], []
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return run


def region_join(sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that connect exactly the components of all links between the sets.

    Each round takes a pivot and its distances to the others. A document within the radius
    joins the pivot's component. Documents already connected with the pivot, or whose
    distances to an earlier pivot differ by more than the radius, are not compared.
    """
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    flags = np.zeros(ids.max() + 1, bool)
    component = np.arange(m)
    kept: list[np.ndarray] = []  # distances to earlier pivots
    radius = (100 - percent) / 100 + 1e-9
    links = []
    for pivot in range(m):
        if pivot and (component == component[0]).all():
            break
        others = np.arange(pivot + 1, m)
        open_ = component[others] != component[pivot]
        open_ &= (100 * sizes[others] >= percent * sizes[pivot]) & (100 * sizes[pivot] >= percent * sizes[others])
        for d in kept:
            open_ &= ~(np.abs(d[others] - d[pivot]) > radius)
        others = others[open_]
        if not len(others):
            continue
        mine = ids[ends[pivot] - sizes[pivot] : ends[pivot]]
        flags[mine] = True
        if 2 * len(others) >= m:
            total = np.concatenate(([0], np.cumsum(flags[ids])))
            common = total[ends[others]] - total[ends[others] - sizes[others]]
        else:
            common = np.array([np.count_nonzero(flags[ids[ends[x] - sizes[x] : ends[x]]]) for x in others])
        flags[mine] = False
        union = sizes[others] + sizes[pivot] - common
        for x in others[100 * common >= percent * union].tolist():
            links.append((pivot, x))
            component[component == component[x]] = component[pivot]
        if len(kept) < 8:
            d = np.full(m, np.nan)  # nan: not compared, nothing known
            d[others] = 1 - common / union
            d[pivot] = 0
            kept.append(d)
    return links


def _exact(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for region in groups(batches, ["region", "i", "j"]):
            classes = region.column("class").to_pylist()
            sets = [np.frombuffer(x, np.uint64) for x in region.column("shingles").to_pylist()]
            links = region_join(sets, percent) if len(sets) > 1 else []
            if links:
                a, b = zip(*[(classes[x], classes[y]) for x, y in links])
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return run


def _full_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1 << 20):
            sets = shingle_sets(part.column("text"), size)
            yield pa.RecordBatch.from_arrays(
                [pa.array([_class_of(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["class", "shingles"],
            )

    return run


def _in_blocks(df: DataFrame, keys: list[str], weight, limit: int) -> DataFrame:
    """``df`` with a pair (i, j) of blocks: (0, 0), unless its group weighs more than ``limit``.

    A heavier group is dealt into blocks, and each row goes to all pairs with its block, so
    every two rows of a group meet in a task that holds at most about ``limit``.
    """
    heavy = df.groupBy(*keys).agg(F.ceil(2 * F.sum(weight) / limit).cast("int").alias("blocks"))
    heavy = staged(heavy.filter("blocks > 2"), "heavy")
    if heavy.isEmpty():
        return df.withColumns({"i": F.lit(0), "j": F.lit(0)})
    own = F.pmod(F.xxhash64("class"), F.coalesce("blocks", F.lit(1))).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1),
        lambda k: F.struct(F.least(own, k).alias("i"), F.greatest(own, k).alias("j")),
    )
    return df.join(_small(heavy), keys, "left").withColumn("pair", F.explode(pairs)).select(*df.columns, "pair.i", "pair.j")


def _dealt(df: DataFrame, keys: list[str], function: Callable) -> DataFrame:
    """``function`` over the groups of ``keys``, sorted within partitions."""
    return df.repartition(*keys).sortWithinPartitions(*keys, "n", "class").mapInArrow(function, "a binary, b binary")


def signatures(docs: DataFrame, size: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """doc_id, hash, n, class and bits per row; and the frequent shingles with their counts."""
    ship(docs.sparkSession)
    docs = docs.select("doc_id", text_hash().alias("hash"), docs["text"].cast("string").alias("text"))
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("hash", T.LongType()), T.StructField("n", T.LongType()), T.StructField("class", T.BinaryType()),
         T.StructField("bits", T.BinaryType()), T.StructField("key", T.LongType()), T.StructField("count", T.LongType())]
    )
    found = staged(docs.mapInArrow(_signatures(size), schema), "signatures")
    frequent = found.filter("key IS NOT NULL").groupBy("key").agg(F.sum("count").alias("count"))
    return found.filter("n IS NOT NULL").drop("key", "count"), frequent


def _regions(docs: DataFrame, frequent: DataFrame, size: int, percent: int) -> DataFrame:
    """pivot, band, class and n of all regions with two members or more."""
    spark = docs.sparkSession
    top = frequent.orderBy(F.desc("count"), "key").limit(FREQUENT).collect()  # at most FREQUENT rows
    keys = np.array([r["key"] for r in top], np.int64).view(np.uint64)
    counts = np.array([r["count"] for r in top], np.int64)
    order = np.argsort(keys)
    known, ranks = spark.sparkContext.broadcast(keys[order]), spark.sparkContext.broadcast(counts[order])
    texts = docs.select(docs["text"].cast("string").alias("text"))
    places = texts.mapInArrow(_prefixes(known, ranks, size, percent), "key long, class binary, n long")
    # Places are dealt by key once; both windows read them so. A key in very many documents
    # is among the frequent ones, and what is left of it streams through its task and may spill.
    of_key, of_region = Window.partitionBy("key"), Window.partitionBy("key", "band")
    few = places.withColumns({"x": F.min("class").over(of_key), "y": F.max("class").over(of_key)}).filter("x < y")
    band = F.floor(F.log(F.col("n").cast("double")) / band_width(percent)).cast("int")
    few = few.select("key", "class", "n", F.explode(F.array(band, band + 1)).alias("band"))
    member = F.struct("n", "class")
    regions = few.withColumns({"p": F.min(member).over(of_region), "q": F.max(member).over(of_region)}).filter("p != q")
    return regions.select(F.col("p.class").alias("pivot"), "band", "class", "n").distinct()


def links(docs: DataFrame, signed: DataFrame, frequent: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Pairs of classes that connect exactly what links connect."""
    regions = staged(_regions(docs, frequent, size, percent), "regions")
    bits = signed.filter("class IS NOT NULL").select("class", "bits").dropDuplicates(["class"])
    with_bits = _in_blocks(regions, ["pivot", "band"], F.lit(1), ROWS).join(bits, "class")
    coarse = staged(_dealt(with_bits, ["pivot", "band", "i", "j"], _coarse(percent)), "coarse")
    region = staged(components(coarse).select(F.col("node").alias("class"), F.col("label").alias("region")), "coarse-regions")
    first = signed.select("class", "n", F.struct("doc_id", "hash").alias("row")).join(_small(region), "class")
    first = first.groupBy("class", "region", "n").agg(F.min("row").alias("row"))
    first = staged(first.select("class", "region", "n", "row.doc_id", "row.hash"), "first")
    texts = docs.select("doc_id", text_hash().alias("hash"), docs["text"].cast("string").alias("text"))
    few = _small(first.select("doc_id", "hash"))
    texts = texts.join(few, same(texts, few, "doc_id", "hash"), "left_semi").select("text")
    sets = texts.mapInArrow(_full_sets(size), "class binary, shingles binary").dropDuplicates(["class"])
    members = _in_blocks(first.select("class", "region", "n"), ["region"], F.col("n"), SHINGLES)
    return staged(_dealt(members.join(sets, "class"), ["region", "i", "j"], _exact(percent)), "links")


def _joined(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, hash, n_shingles, component_id and, for rows with shingles, the component's ``first`` row."""
    signed, frequent = signatures(docs, size)
    labels = components(links(docs, signed, frequent, size, percent)).select(F.col("node").alias("class"), "label")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")
    classes = signed.filter("class IS NOT NULL").groupBy("class").agg(F.min(row).alias("smallest"))
    classes = classes.join(labels, "class", "left").withColumn("label", F.coalesce("label", "class"))
    classes = staged(classes, "classes")
    lowest = classes.groupBy("label").agg(F.min("smallest").alias("first"))
    named = classes.join(lowest, "label").select("class", "first")
    has, none = signed.filter("class IS NOT NULL"), signed.filter("class IS NULL")
    names = ["doc_id", "hash", F.col("n").alias("n_shingles")]
    return has.join(named, "class").select(*names, F.col("first.doc_id").alias("component_id"), "first").unionByName(
        none.select(*names, F.col("doc_id").alias("component_id")), allowMissingColumns=True
    )


def join(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, hash, n_shingles and component_id of every row."""
    return _joined(docs, size, percent).drop("first")


def keep_one(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of each component, with all its columns.

    Documents are ordered by their ids, null last, then by their texts' hashes. Of rows with
    equal doc_id and text the one whose JSON form has the smallest digest stays, and one of
    rows that are equal in all columns. Documents without words are in no component and stay.
    Other columns may have any names.
    """
    found = staged(_joined(docs, size, percent).filter("n_shingles > 0").select("doc_id", "hash", "first"), "near")
    first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("hash") == F.col("first.hash"))
    marked = found.groupBy("doc_id", "hash", first.alias("stays")).agg((F.count(F.lit(1)) > 1).alias("repeated"))
    marked = staged(marked.filter("repeated OR NOT stays"), "near-marked")
    base = rows(docs, text_hash(docs["text"]).alias("hash"))
    pair = lambda other: F.col("row.doc_id").eqNullSafe(other["doc_id"]) & (base["hash"] == other["hash"])
    few = _small(marked.select("doc_id", "hash"))
    single = base.join(few, pair(few), "left_anti").select("row")
    several = _small(marked.filter("stays").select("doc_id", "hash"))
    equal = base.join(several, pair(several), "left_semi")
    # partial minima: thousands of equal rows make one row per task
    one = equal.groupBy(F.col("row.doc_id").alias("doc_id"), "hash").agg(F.min_by("row", F.sha2(F.to_json("row"), 256)).alias("row"))
    kept = single.unionByName(one.select("row"))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents")).drop("hash")
