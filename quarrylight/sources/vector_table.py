"""The vector table: building, appending, reading by id, saving and loading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.vectors import as_vector

# Fixed value: characters of raw text kept as a preview.
PREVIEW_CHARS = 200


def build(vectors: DataFrame, docs: DataFrame) -> DataFrame:
    """Join (doc_id, vector) with (doc_id, text, label) into the table's columns.

    Every vector stays; one without a document has the label ``unknown`` and an empty
    preview. The text is cut before the join, so previews are all that is shuffled.
    """
    details = docs.select(
        "doc_id",
        F.col("label").cast("string").alias("label"),
        F.substring("text", 1, PREVIEW_CHARS).alias("text_preview"),
    )
    return vectors.join(details, "doc_id", "left").select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("id"),
        as_vector("vector").alias("vector"),
        F.coalesce("label", F.lit("unknown")).alias("label"),
        F.col("doc_id").alias("doc_idx"),
        F.coalesce("text_preview", F.lit("")).alias("text_preview"),
    )


def append(table: DataFrame, more: DataFrame) -> DataFrame:
    """Append rows; columns the new rows lack become null, ids may repeat.

    Each row carries its id and its vector, so the two cannot differ in number; rows
    that miss either are refused.
    """
    missing = {"id", "vector"} - set(more.columns)
    if missing:
        raise ValueError(f"rows to append lack {sorted(missing)}")
    checked = more.filter(
        F.when(F.col("id").isNull() | F.col("vector").isNull(), F.raise_error(F.lit("id or vector is null")).cast("boolean")).otherwise(F.lit(True))
    )
    return table.unionByName(checked, allowMissingColumns=True)


def repeated_ids(table: DataFrame) -> DataFrame:
    """Ids that occur more than once, with their number of rows."""
    return table.groupBy("id").agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def get_by_ids(table: DataFrame, wanted: DataFrame, order: str) -> DataFrame:
    """Rows for the requested (position, id); ids not in the table are skipped.

    Ids may be requested several times. Where an id is stored several times, the row
    stored last wins, that with the largest ``order``, chosen by a partial aggregate
    before the shuffle.
    """
    columns = [c for c in table.columns if c != "id"]
    latest = F.max_by(F.struct(*columns), F.col(order)).alias("row")
    last = table.groupBy("id").agg(latest).select("id", "row.*")
    return wanted.join(last, "id").orderBy("position")


def count(table: DataFrame) -> int:
    """Rows in the table."""
    return table.count()


def save(table: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write the table as Parquet."""
    table.write.mode(mode).parquet(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    """Read a saved table."""
    return spark.read.parquet(path)
