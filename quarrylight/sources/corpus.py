"""Corpus readers. The contract is (doc_id, text, label), one row per document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..functions import text
from ..functions.batches import add_columns, text_slices
from ..functions.terms import clean_letters
from .schemas import CORPUS, PARALLEL_ARRAYS

CLEANED = T.StructField("cleaned", T.StringType())


def as_corpus(df: DataFrame, doc_id: str = "doc_id", body: str = "text", label: str = "label") -> DataFrame:
    """Any table with an id, a text and a label column."""
    return df.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.col(body).alias("text"),
        F.col(label).cast("string").alias("label"),
    )


def read_parquet(spark: SparkSession, path: str, **columns: str) -> DataFrame:
    """A Parquet corpus; only the three columns are read."""
    return as_corpus(spark.read.parquet(path), **columns)


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """A corpus with one JSON object per line."""
    return spark.read.schema(CORPUS).json(path)


def read_parallel_arrays(spark: SparkSession, path: str) -> DataFrame:
    """A corpus file that holds one object of parallel arrays.

    The format puts a whole file into one value, so a large corpus should come as
    several files or as Parquet. Documents are numbered through all files in the order
    of their names: a file's first number is the sum of the sizes of those before.
    """
    whole = spark.read.schema(PARALLEL_ARRAYS).option("multiLine", True).json(path)
    files = whole.select(F.col("_metadata.file_path").alias("file"), F.arrays_zip("documents", "labels").alias("d"))
    # One row per file, each of which is a value of its own, so one window is safe.
    sizes = files.groupBy("file").agg(F.sum(F.coalesce(F.size("d"), F.lit(0))).alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    rows = files.join(starts, "file").select("first", F.posexplode_outer("d").alias("place", "d"))
    return rows.filter(F.col("place").isNotNull()).select(
        (F.col("first") + F.col("place")).cast("bigint").alias("doc_id"),
        F.col("d.documents").alias("text"),
        F.col("d.labels").alias("label"),
    )


def spread(df: DataFrame, key: str = "doc_id", partitions: int | None = None) -> DataFrame:
    """Split a table that was read in fewer tasks than there are cores.

    A file with a single row group is one task however large the cluster is. Tables
    that already come in enough tasks are left alone.
    """
    wanted = partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= wanted:
        return df
    return df.repartition(wanted, key)


def clean_corpus(docs: DataFrame, keep_text: bool = True, letters: bool = True) -> DataFrame:
    """Add ``cleaned``, with the placeholder for texts that are too short.

    The values of ``or_placeholder(clean_document(text))``; letters are found with arrays,
    which takes a fraction of the time of a pattern. Without ``letters`` that last step is
    left to the operator that reads the column, which so needs no other worker beside its own.
    """
    stripped = docs.withColumn("cleaned", text.strip_document(F.col("text")))
    kept = stripped if keep_text else stripped.drop("text")
    if not letters:
        return kept
    return add_columns(kept, ["cleaned"], [CLEANED], lambda t: [clean_letters(t)], slices=text_slices)


def clean_queries(queries: DataFrame, query: str = "query", full: bool = False) -> DataFrame:
    """Add ``cleaned``: the served cleaning, or with ``full`` that of documents."""
    cleaner = text.clean_document if full else text.clean_query
    return queries.withColumn("cleaned", cleaner(F.col(query)))
