"""Quality rules with thresholds that follow each language and source.

Every document is measured once. The measures are counted in histograms with five
significant bits per bucket: a quantile sketch of bounded size and relative error (1/16)
whose merge is addition, so it is the same under any partitioning. A document is an
outlier if a measure lies beyond the upper fence of its (language, source), taken from the
sketch of the language, or of all rows, where the finer one has too few documents.

Null text counts as empty; null languages and sources form groups of their own. Repeated
rows are measured and returned each. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrylight.llm.common import Words, rows, slices, staged, table, text_of
from quarrylight.session import ship

#: measure -> least distance from quartile to fence is three of these (parts of 10,000).
UNITS = {"symbols": 200, "dup_lines": 2000, "repeats": 700}
MIN_DOCS = 100
_SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
_BLANK = " \t\n\x0b\x0c\r"


def _dup_lines(text: str | None) -> tuple[int, int]:
    lines = [x for x in (text or "").split("\n") if x.strip(_BLANK)]
    return len(lines) - len(set(lines)), len(lines)


def _repeat_words(words: Words) -> np.ndarray:
    n = len(words.ids)
    covered = np.zeros(n, bool)
    if n >= 3:
        ids, row = words.ids, words.row
        pairs, _ = pd.factorize(ids[:-1] * (len(words.distinct) + 1) + ids[1:])
        triples, _ = pd.factorize(pairs[:-1] * (len(words.distinct) + 1) + ids[2:])
        at = np.flatnonzero(row[:-2] == row[2:])
        codes, _ = pd.factorize(row[at] * (n + 1) + triples[at])
        again = at[np.bincount(codes)[codes] >= 2] if len(at) else at
        for shift in range(3):
            covered[again + shift] = True
    return np.bincount(words.row[covered], minlength=len(words.per_row))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        text = text_of(part)
        words = Words(text)
        lines = np.array([_dup_lines(t) for t in text.to_pylist()], np.int64).reshape(-1, 2)
        lead = words.inside & ((words.data & 0xC0) != 0x80)
        counts = (
            words.per_row,
            words.sum_by_row(lead),
            words.sum_by_row(_SYMBOLS[words.data]),
            lines[:, 0],
            _repeat_words(words),
            lines[:, 1],
        )
        kept = [part.column(name) for name in part.schema.names if name != "text"]
        names = [name for name in part.schema.names if name != "text"]
        yield pa.RecordBatch.from_arrays(
            kept + [pa.array(c, pa.int64()) for c in counts], names=names + list(_COUNTS)
        )


def measure(docs: DataFrame) -> DataFrame:
    """The counts of each whole text beside all columns but text."""
    ship(docs.sparkSession)
    kept = [f for f in docs.schema.fields if f.name != "text"]
    return docs.mapInArrow(_measure, T.StructType(kept + [T.StructField(n, T.LongType()) for n in _COUNTS]))


def _ratios() -> dict[str, Column]:
    """Parts of 10,000, as whole numbers."""
    parts = {"symbols": "n_symbols / word_chars", "dup_lines": "n_dup_lines / n_lines", "repeats": "n_repeat_words / n_words"}
    ratio = lambda part, of: F.expr(f"10000 * {part} div greatest({of}, 1)")
    return {m: ratio(*x.split(" / ")) for m, x in parts.items()}


_KEYS = ("lang_key", "source_key")


def _keyed(measured: DataFrame) -> DataFrame:
    key = lambda name: F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit(""))
    return measured.withColumns({"lang_key": key("lang"), "source_key": key("source")})


def sketch(measured: DataFrame) -> DataFrame:
    """Bucket counts per language, source and measure; adding them merges sketches."""
    values = F.explode(
        F.array(*[F.struct(F.lit(m).alias("measure"), r.alias("v")) for m, r in _ratios().items()])
    )
    shift = F.greatest(F.length(F.bin("v")) - 5, F.lit(0))
    return (
        _keyed(measured)
        .select(*_KEYS, values.alias("x"))
        .select(*_KEYS, "x.measure", "x.v")
        .withColumn("shift", shift)
        .select(*_KEYS, "measure", F.expr("shiftleft(shiftright(v, shift), shift)").alias("bucket"))
        .groupBy(*_KEYS, "measure", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def fences(sketches: DataFrame, units: dict[str, int] = UNITS, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per (language, source): the fence of each measure."""
    spark = sketches.sparkSession
    levels = [list(_KEYS), ["lang_key"], []]
    merged = None
    for keys in levels:
        group = [*keys, "measure"]
        upto = Window.partitionBy(*group).orderBy("bucket")
        ranked = (
            sketches.groupBy(*group, "bucket").agg(F.sum("n").alias("n"))
            .withColumn("upto", F.sum("n").over(upto))
            .withColumn("total", F.sum("n").over(Window.partitionBy(*group)))
            .groupBy(*group)
            .agg(
                F.max("total").alias("total"),
                F.min(F.when(F.col("upto") * 4 >= F.col("total"), F.col("bucket"))).alias("q1"),
                F.min(F.when(F.col("upto") * 4 >= F.col("total") * 3, F.col("bucket"))).alias("q3"),
            )
        )
        unit = F.create_map(*[x for m, u in units.items() for x in (F.lit(m), F.lit(u))])[F.col("measure")]
        level = ranked.select(
            *group,
            F.struct(
                (F.col("total") >= min_docs).alias("enough"),
                (F.col("q3") + 3 * F.greatest(F.col("q3") - F.col("q1"), unit)).alias("fence"),
            ).alias(f"level{len(keys)}"),
        )
        merged = level if merged is None else merged.join(level, group)
    fence = (
        F.when(F.col("level2.enough"), F.col("level2.fence"))
        .when(F.col("level1.enough"), F.col("level1.fence"))
        .otherwise(F.col("level0.fence"))
    )
    one = [F.max(F.when(F.col("measure") == m, fence)).alias(f"fence_{m}") for m in units]
    return merged.groupBy(*_KEYS).agg(*one)


def _verdicts(measured: DataFrame, limits: DataFrame) -> DataFrame:
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    within = F.lit(True)
    for m, ratio in _ratios().items():
        within = within & (ratio <= F.col(f"fence_{m}"))
    return (
        _keyed(measured)
        .join(limits, list(_KEYS), "left")
        .withColumn("base_failed", base)
        .withColumn("kept", ~base & within)
        .drop(*_KEYS)
    )


def judge(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, lang, source, counts, fences, base rule and verdict of every document."""
    measured = staged(measure(docs.select("doc_id", "lang", "source", "text")), "quality")
    return _verdicts(measured, staged(fences(sketch(measured), min_docs=min_docs), "fences"))


def keep_good(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns.

    Texts are measured in both passes, so none is shuffled: the fences are a small table
    of known size, which Spark broadcasts if it is below its threshold.
    """
    counts = measure(docs.select("lang", "source", "text"))
    limits = staged(fences(sketch(counts), min_docs=min_docs), "fences")
    judged = _verdicts(measure(rows(docs, "lang", "source")), limits)
    return judged.filter("kept").select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "fence_symbols", "fence_dup_lines", "fence_repeats",
    )


SQL = r"""
WITH t AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
      FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM t)),
tri AS (SELECT doc_id, i, w, lead(w, 1) OVER d AS w2, lead(w, 2) OVER d AS w3 FROM w
        WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, w3, count(*) OVER (PARTITION BY doc_id, w, w2, w3) AS n FROM tri)
        WHERE w3 IS NOT NULL AND n >= 2),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
wc AS (SELECT doc_id, count(*) AS n, sum(length(w)) AS c FROM w GROUP BY doc_id),
ln AS (SELECT doc_id, count(*) AS n, count(DISTINCT l) AS d
       FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM t)
       WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT t.doc_id, coalesce('=' || lang, '') AS lk, coalesce('=' || source, '') AS sk,
        coalesce(wc.n, 0)::BIGINT AS n_words, coalesce(wc.c, 0)::BIGINT AS word_chars,
        (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
        coalesce(ln.n - ln.d, 0)::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
        coalesce(ln.n, 0)::BIGINT AS n_lines
      FROM t LEFT JOIN wc USING (doc_id) LEFT JOIN ln USING (doc_id) LEFT JOIN cov USING (doc_id)),
r AS (SELECT *, 10000 * n_symbols // greatest(word_chars, 1) AS symbols,
        10000 * n_dup_lines // greatest(n_lines, 1) AS dup_lines,
        10000 * n_repeat_words // greatest(n_words, 1) AS repeats FROM m),
v AS (SELECT lk, sk, unnest(['symbols', 'dup_lines', 'repeats']) AS measure,
        unnest([symbols, dup_lines, repeats]) AS v FROM r),
b AS (SELECT lk, sk, measure, (v >> greatest(length(bin(v)) - 5, 0)) << greatest(length(bin(v)) - 5, 0) AS bucket FROM v),
s AS (SELECT lk, sk, measure, bucket, count(*) AS n, sum(count(*)) OVER (PARTITION BY lk, sk, measure ORDER BY bucket) AS u,
        sum(count(*)) OVER (PARTITION BY lk, sk, measure) AS z, 2 AS lev FROM b GROUP BY lk, sk, measure, bucket
      UNION ALL SELECT lk, NULL, measure, bucket, count(*), sum(count(*)) OVER (PARTITION BY lk, measure ORDER BY bucket),
        sum(count(*)) OVER (PARTITION BY lk, measure), 1 FROM b GROUP BY lk, measure, bucket
      UNION ALL SELECT NULL, NULL, measure, bucket, count(*), sum(count(*)) OVER (PARTITION BY measure ORDER BY bucket),
        sum(count(*)) OVER (PARTITION BY measure), 0 FROM b GROUP BY measure, bucket),
q AS (SELECT lev, lk, sk, measure, max(z) AS z, min(bucket) FILTER (u * 4 >= z) AS q1, min(bucket) FILTER (u * 4 >= z * 3) AS q3
      FROM s GROUP BY lev, lk, sk, measure),
f AS (SELECT *, (q3 + 3 * greatest(q3 - q1, CASE measure WHEN 'symbols' THEN 200 WHEN 'dup_lines' THEN 2000 ELSE 700 END))::BIGINT
        AS fence FROM q),
g AS (SELECT a.lk, a.sk, a.measure,
        CASE WHEN a.z >= 100 THEN a.fence WHEN l.z >= 100 THEN l.fence ELSE e.fence END AS fence
      FROM f a JOIN f l ON a.lev = 2 AND l.lev = 1 AND a.lk = l.lk AND a.measure = l.measure
      JOIN f e ON e.lev = 0 AND e.measure = a.measure),
p AS (SELECT lk, sk, max(fence) FILTER (measure = 'symbols') AS fence_symbols,
        max(fence) FILTER (measure = 'dup_lines') AS fence_dup_lines,
        max(fence) FILTER (measure = 'repeats') AS fence_repeats FROM g GROUP BY lk, sk),
k AS (SELECT r.*, p.* EXCLUDE (lk, sk), (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed
      FROM r JOIN p USING (lk, sk))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  (NOT base_failed AND symbols <= fence_symbols AND dup_lines <= fence_dup_lines AND repeats <= fence_repeats) AS kept,
  fence_symbols, fence_dup_lines, fence_repeats
FROM k
"""
