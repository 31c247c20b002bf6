"""Removal of benchmark passages from training text, in DataFrame functions only.

A window is ten consecutive words of an item, or all words of a shorter one. Pass one cuts
each document into consecutive blocks of five words: every occurrence of a window covers
one block, so documents without a block in the broadcast set of five-word benchmark grams
hold no window (shorter windows use blocks of half their length). Pass two lists the token
windows of the few documents left, looks them up by hash, verifies the words and merges the
hits. Benchmark sets are broadcast below a checked size and shuffled above it.

Null text has no words. A null item_id reads as the empty text; rows of one item_id form
one item. Documents with equal doc_id and text get equal results each. An empty table or
an empty benchmark works as such. Extra columns are kept by the removals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylight.llm.common import rows, same, staged, table, text_hash, whole

WINDOW = 10
BROADCAST_BYTES = 8 << 20
#: Everything between words.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _spaced(text: Column) -> Column:
    """The words with one space between them."""
    return F.trim(F.regexp_replace(text, _BETWEEN, " "))


def _n_words(spaced: Column) -> Column:
    n = F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit(""))) + 1
    return F.when(spaced == "", F.lit(0)).otherwise(n).cast("long")


def _windows(words: Column, n: Column | int) -> Column:
    """(pos, window) for all runs of n words."""
    n = F.lit(n) if isinstance(n, int) else n
    at = F.when(F.size(words) >= n, F.sequence(F.lit(0), F.size(words) - n))
    return F.transform(
        at, lambda i: F.struct(i.alias("pos"), F.array_join(F.slice(words, i + 1, n), " ").alias("window"))
    )


def _words(spaced: Column) -> Column:
    return F.when(spaced != "", F.split(spaced, " "))


def bench_windows(bench: DataFrame, size: int = WINDOW) -> DataFrame:
    """Each distinct window with its number of words and the items that hold it."""
    spaced = _spaced(F.translate(whole(), _UPPER, _LOWER))
    items = bench.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), spaced.alias("spaced"))
    items = items.filter(F.col("spaced") != "").select("item", _words(F.col("spaced")).alias("words"))
    n = F.least(F.size("words"), F.lit(size))
    return (
        items.select("item", n.alias("n"), F.explode(_windows(F.col("words"), n)).alias("w"))
        .groupBy("n", F.col("w.window").alias("window"))
        .agg(F.collect_set("item").alias("items"))
        .withColumn("key", F.xxhash64("window"))
    )


def _small(df: DataFrame, limit: int = BROADCAST_BYTES, **columns: Column) -> DataFrame:
    """``df`` with a broadcast hint if its measured bytes allow it."""
    size = F.lit(64)
    for name, kind in df.dtypes:
        size = size + (F.coalesce(F.length(F.col(name).cast("string")), F.lit(0)) if kind != "bigint" else F.lit(8))
    total = df.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(df) if total <= limit else df


def suspects(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc_id, hash) of all documents that may hold a window."""
    half = F.floor((F.col("n") + 1) / 2).cast("int")
    grams = windows.select(half.alias("b"), F.explode(_windows(F.split("window", " "), half)).alias("w"))
    # lower() folds more letters than A-Z, so it can only add suspects
    grams = staged(grams.select("b", F.xxhash64("b", F.lower("w.window")).alias("gram")).distinct(), "grams")
    sizes = [r["b"] for r in grams.select("b").distinct().collect()]  # at most half a window's numbers
    spaced = docs.select("doc_id", text_hash().alias("hash"), _spaced(F.lower(whole())).alias("spaced"))
    found = None
    for b in sizes:
        pattern = "[^ ]+" + " [^ ]+" * (b - 1)
        blocks = F.regexp_extract_all("spaced", F.lit(pattern), F.lit(0))
        part = spaced.select("doc_id", "hash", F.explode(F.array_distinct(blocks)).alias("block"))
        part = part.select("doc_id", "hash", F.xxhash64(F.lit(b), "block").alias("gram"))
        found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.select("doc_id", text_hash().alias("hash")).limit(0)
    return found.join(_small(grams.select("gram")), "gram", "left_semi").select("doc_id", "hash").distinct()


def hits(docs: DataFrame, windows: DataFrame, flagged: DataFrame) -> DataFrame:
    """doc_id, hash, the merged word spans, n_hit and the sorted item names, where there are any."""
    tagged = docs.select("doc_id", text_hash().alias("hash"), whole().alias("text"))
    few = tagged.join(flagged, same(tagged, flagged, "doc_id", "hash"), "left_semi")
    few = few.select("doc_id", "hash", _words(_spaced(F.translate("text", _UPPER, _LOWER))).alias("words"))
    lengths = [r["n"] for r in windows.select("n").distinct().collect()]  # at most a window's numbers
    found = None
    for n in lengths:
        part = few.select("doc_id", "hash", F.explode(_windows(F.col("words"), n)).alias("w"))
        part = part.select("doc_id", "hash", F.lit(n).alias("n"), "w.*", F.xxhash64("w.window").alias("key"))
        found = part if found is None else found.unionByName(part)
    known = _small(windows)
    spans = (
        found.join(known, ["n", "key", "window"])
        .groupBy("doc_id", "hash")
        .agg(
            F.array_sort(F.collect_set(F.struct("pos", "n"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
    )
    n_hit = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("total")),
        lambda a, x: F.struct(
            F.greatest(a["end"], x["pos"] + x["n"]).alias("end"),
            (a["total"] + F.greatest(F.lit(0), x["pos"] + x["n"] - F.greatest(a["end"], x["pos"]))).alias("total"),
        ),
        lambda a: a["total"],
    )
    return spans.withColumn("n_hit", n_hit.cast("long"))


def search(docs: DataFrame, bench: DataFrame, size: int = WINDOW) -> DataFrame:
    """``hits`` of all documents, as a table."""
    windows = staged(bench_windows(bench, size), "windows")
    flagged = staged(suspects(docs, windows), "suspects")
    if windows.isEmpty() or flagged.isEmpty():
        kinds = "hash long, spans array<struct<pos:int,n:int>>, items array<string>, n_hit long"
        empty = docs.select("doc_id").limit(0)
        return empty.select("doc_id", *[F.lit(None).cast(k).alias(n) for n, k in _fields(kinds)])
    return staged(hits(docs, windows, _small(flagged)), "hits")


def _fields(kinds: str) -> list[tuple[str, str]]:
    from pyspark.sql import types as T

    return [(f.name, f.dataType.simpleString()) for f in T._parse_datatype_string(kinds).fields]


def report(docs: DataFrame, bench: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per document the words, hit words and items."""
    found = _small(search(docs, bench, size).select("doc_id", "hash", "n_hit", "items"))
    base = docs.select("doc_id", text_hash().alias("hash"), _n_words(_spaced(whole())).alias("n_words"))
    return base.join(found, same(base, found, "doc_id", "hash"), "left").select(
        base["doc_id"],
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def remove_documents(docs: DataFrame, bench: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows without any window, with all their columns."""
    found = _small(search(docs, bench, size).select("doc_id", "hash"))
    base = rows(docs, text_hash(docs["text"]).alias("of"))
    match = F.col("row.doc_id").eqNullSafe(found["doc_id"]) & (base["of"] == found["hash"])
    return base.join(found, match, "left_anti").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def remove_spans(docs: DataFrame, bench: DataFrame, size: int = WINDOW) -> DataFrame:
    """All rows, texts without the hit words; what stands between words stays."""
    found = _small(search(docs, bench, size).select("doc_id", "hash", "spans"))
    base = rows(docs, text_hash(docs["text"]).alias("of"))
    match = F.col("row.doc_id").eqNullSafe(found["doc_id"]) & (base["of"] == found["hash"])
    joined = base.join(found, match, "left").select("row", "spans")
    hit = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["pos"], s["pos"] + s["n"] - 1))))
    words = F.regexp_extract_all("row.text", F.lit(_WORD), F.lit(0))
    left = F.transform(words, lambda w, i: F.when(F.array_contains(hit, i), F.lit("")).otherwise(w))
    between = F.split("row.text", _WORD, -1)
    rebuilt = F.array_join(F.zip_with(between, left, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    text = F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(rebuilt)
    return joined.select(*[(text if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n)),
h AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
p AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
q AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN q USING (doc_id)
"""
