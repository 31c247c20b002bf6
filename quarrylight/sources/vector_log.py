"""A vector table that grows by numbered batches.

Every append is a folder of its own, named by its number and valid once it was written
to the end. What a row replaces follows from the number of its batch and its place in
it, so callers need no order column; a batch sent again, as a restarted job or stream
does, changes nothing. :func:`compact` writes the rows that still count as a base that
stands for all batches up to its number; readers take the newest base and what follows,
and :func:`vacuum` deletes what lies behind. Any of these may be stopped and run again.
There is one writer at a time.

Null ids or vectors are refused. Columns a batch lacks are null. An empty batch counts as
sent. The names ``batch`` and ``place`` are the log's own and refused in rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.vectors import as_vector
from ..session import complete_tables, discard, is_complete

# Digits of a batch number in a folder's name, so that names sort like numbers.
_DIGITS = 18


def _name(batch: int) -> str:
    return f"{batch:0{_DIGITS}d}"


def _parts(spark: SparkSession, path: str) -> tuple[str | None, list[str]]:
    """The newest base, if any, and the batches it does not stand for."""
    base = next(reversed(complete_tables(spark, f"{path}/base")), None)
    batches = complete_tables(spark, f"{path}/batches")
    return base, [b for b in batches if base is None or b > base]


def append(path: str, rows: DataFrame, batch: int) -> bool:
    """Store ``rows`` (id, vector, ...) as a batch; returns whether it was new.

    Of equal ids in one batch the last in the order of the frame counts. Batches may
    arrive out of order, but not behind a base that stands for their number already.
    """
    spark = rows.sparkSession
    clashing = {"batch", "place"} & set(rows.columns)
    if clashing or not {"id", "vector"} <= set(rows.columns):
        raise ValueError(f"rows need id and vector and may not have {sorted(clashing) or 'batch or place'}")
    if not 0 <= batch < 10**_DIGITS:
        raise ValueError("a batch has a number from 0 on")
    base = next(reversed(complete_tables(spark, f"{path}/base")), None)
    target = f"{path}/batches/{_name(batch)}"
    if (base is not None and _name(batch) <= base) or is_complete(spark, target):
        return False
    bad = F.col("id").isNull() | F.col("vector").isNull()
    checked = rows.withColumn("vector", as_vector("vector")).filter(
        F.when(bad, F.raise_error(F.lit("id or vector is null")).cast("boolean")).otherwise(F.lit(True))
    )
    numbered = checked.withColumn("batch", F.lit(batch).cast("bigint")).withColumn("place", F.monotonically_increasing_id())
    numbered.write.mode("overwrite").parquet(target)
    return True


def read(spark: SparkSession, path: str) -> DataFrame:
    """All rows stored since the newest base and those of the base, with batch and place."""
    base, batches = _parts(spark, path)
    folders = ([] if base is None else [f"{path}/base/{base}"]) + [f"{path}/batches/{b}" for b in batches]
    if not folders:
        raise FileNotFoundError(f"nothing was appended to {path}")
    return spark.read.option("mergeSchema", "true").parquet(*folders)


def _newest(rows: DataFrame) -> DataFrame:
    """The last row of each id; partial maxima are taken before the shuffle."""
    columns = [c for c in rows.columns if c != "id"]
    last = F.max_by(F.struct(*columns), F.struct("batch", "place")).alias("row")
    return rows.groupBy("id").agg(last).select("id", "row.*")


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The table as it stands: one row per id, the one stored last."""
    return _newest(read(spark, path)).drop("batch", "place")


def get(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The newest rows of the requested (position, id); unknown ids are skipped.

    Ids may be requested several times. Rows of other ids drop out before the maxima.
    """
    asked = wanted.select("id").distinct()
    rows = _newest(read(spark, path).join(asked, "id", "left_semi")).drop("batch", "place")
    return wanted.select("position", "id").join(rows, "id")


def summary(spark: SparkSession, path: str) -> DataFrame:
    """One row: n_batches behind the base, n_rows stored, n_ids, n_overwritten."""
    n_batches = len(_parts(spark, path)[1])
    per_id = read(spark, path).groupBy("id").agg(F.count("*").alias("n"))
    counts = per_id.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_ids"))
    return counts.select(F.lit(n_batches).alias("n_batches"), "n_rows", "n_ids", (F.col("n_rows") - F.col("n_ids")).alias("n_overwritten"))


def compact(spark: SparkSession, path: str) -> bool:
    """Write the rows that count as a new base; returns whether there was anything to do."""
    base, batches = _parts(spark, path)
    if not batches:
        return False
    _newest(read(spark, path)).write.mode("overwrite").parquet(f"{path}/base/{batches[-1]}")
    return True


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete older bases and the batches the newest one stands for; returns how many.

    Frames read before a compaction may still name them, so this is a step of its own.
    """
    bases = complete_tables(spark, f"{path}/base")
    if not bases:
        return 0
    old = [f"{path}/base/{b}" for b in bases[:-1]]
    old += [f"{path}/batches/{b}" for b in complete_tables(spark, f"{path}/batches") if b <= bases[-1]]
    for folder in old:
        discard(spark, folder)
    return len(old)
