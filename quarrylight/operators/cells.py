"""Exact cosine top-k over a table partitioned by cells, most of which a query skips.

A row belongs to the cell of its nearest centre. Of a cell the shortest and the longest
row and the range [lo, hi] of the cosines t between its rows and the centre are kept. A
query with cosine a to the centre then has at most the cosine a t + sqrt(1 - a²) sqrt(1 - t²),
for the best t in [lo, hi], with any row of the cell; its length and that of the longest
row, or the shortest one below zero, make a product of it. Zero rows have no cosine.

A query first reads the cells of the highest bounds that hold k rows between them. Of
the others it needs only those whose bound reaches its k-th similarity so far: what the
rest holds would rank behind. Cells are folders, so those no query of a block needs are
not opened, and queries are dealt to blocks by their nearest cell, so that a block needs
few. The bounds of a cell are a handful of numbers; the collection is not shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.batches import add_columns, map_batches
from ..functions.vectors import SIMILARITY_DIGITS, as_vector, to_matrix, unit_rows
from ..session import scratch_path
from .kmeans import nearest
from .search import _CELLS, QUERY_BLOCK_BYTES, QUERY_BLOCK_ROWS, _columns, _output_schema, _rank
from .topk import BestK

# Room for rounding between a bound and the similarities it bounds.
_MARGIN = 1e-9


@dataclass(frozen=True)
class CellTable:
    """A table partitioned by ``cell`` at ``path``, with the bounds of its cells.

    The arrays have one entry per cell and are what the driver holds.
    """

    path: str
    schema: T.StructType
    directions: np.ndarray
    rows: np.ndarray
    lowest: np.ndarray
    highest: np.ndarray
    shortest: np.ndarray
    longest: np.ndarray

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(f"{self.path}/rows")

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """(queries, cells): the largest product with a row of the cell, -inf if it is empty."""
        lengths = np.sqrt((queries * queries).sum(axis=1, keepdims=True))
        cosine = np.clip(unit_rows(queries) @ self.directions.T, -1.0, 1.0)
        # Concave in t with its top at t = cosine.
        t = np.clip(cosine, self.lowest, self.highest)
        most = cosine * t + np.sqrt(1.0 - cosine**2) * np.sqrt(1.0 - t**2)
        bound = lengths * most * np.where(most > 0.0, self.longest, self.shortest) + _MARGIN * (1.0 + lengths)
        return np.where(self.rows > 0, bound, -np.inf)


def build_cells(corpus: DataFrame, centers: np.ndarray, path: str) -> CellTable:
    """Write ``corpus`` (id, vector, ...) by nearest centre below ``path`` and measure the cells.

    Rows go to the folders of their cells from the tasks that read them. A column named
    ``cell`` is refused. The number of centres is the bound of what the driver holds.
    """
    if "cell" in corpus.columns:
        raise ValueError("the corpus has a column named cell")
    spark = corpus.sparkSession
    centers = np.asarray(centers, dtype=np.float64)
    directions = unit_rows(centers)

    def place(vectors: pa.Array) -> list[pa.Array]:
        rows = to_matrix(vectors)
        if not len(rows):
            return [pa.array([], pa.int32()), pa.array([], pa.float64()), pa.array([], pa.float64())]
        cell = nearest(rows, centers)
        length = np.sqrt((rows * rows).sum(axis=1))
        cosine = np.clip((unit_rows(rows) * directions[cell]).sum(axis=1), -1.0, 1.0)
        return [pa.array(cell.astype(np.int32)), pa.array(cosine, mask=length == 0.0), pa.array(length)]

    fields = [T.StructField("cell", T.IntegerType()), T.StructField("__cosine", T.DoubleType()), T.StructField("__length", T.DoubleType())]
    placed = add_columns(corpus.withColumn("vector", as_vector("vector")), ["vector"], fields, place)
    placed.write.partitionBy("cell").parquet(f"{path}/rows")
    stored = spark.read.schema(placed.schema).parquet(f"{path}/rows")
    measures = stored.groupBy("cell").agg(
        F.count("*").alias("n"),
        F.coalesce(F.min("__cosine"), F.lit(0.0)).alias("lo"),
        F.coalesce(F.max("__cosine"), F.lit(0.0)).alias("hi"),
        F.min("__length").alias("shortest"),
        F.max("__length").alias("longest"),
    )
    found = {r["cell"]: r for r in measures.collect()}
    empty = dict.fromkeys(("n", "lo", "hi", "shortest", "longest"), 0.0)
    n, lo, hi, shortest, longest = (np.array([found.get(c, empty)[name] for c in range(len(centers))], dtype=np.float64) for name in empty)
    kept = T.StructType([f for f in placed.schema.fields if not f.name.startswith("__")])
    lo, hi = np.maximum(lo - _MARGIN, -1.0), np.minimum(hi + _MARGIN, 1.0)
    return CellTable(path, kept, directions, n.astype(np.int64), lo, hi, shortest, longest)


def _first_cells(bounds: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """(queries, cells): the cells of the highest bounds that hold k rows between them."""
    order = np.argsort(-bounds, axis=1, kind="stable")
    held = np.cumsum(rows[order], axis=1)
    wanted = np.zeros(bounds.shape, dtype=bool)
    np.put_along_axis(wanted, order, (held - rows[order] < k) & (rows[order] > 0), axis=1)
    return wanted


def _search(
    table: CellTable, stored: DataFrame, block: pa.Table, wanted: np.ndarray, k: int, columns: Sequence[str], schema: T.StructType
) -> DataFrame:
    """The k best rows of each query within the cells it wants, by task."""
    spark = stored.sparkSession
    needed = np.flatnonzero(wanted.any(axis=0)).tolist()
    ids, vectors = _columns(block)
    shared = spark.sparkContext.broadcast((ids, to_matrix(vectors), {c: np.flatnonzero(wanted[:, c]) for c in needed}))
    rows = stored.filter(F.col("cell").isin(needed)).select(*columns, "vector", "cell")
    names, width = schema.fieldNames(), len(columns)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, matrix, asking = shared.value
        best = BestK(len(matrix), k)
        for batch in batches:
            cell = batch.column(width + 1).to_numpy(zero_copy_only=False)
            # A file holds one cell, so a batch has few runs.
            edges = np.concatenate([[0], np.flatnonzero(np.diff(cell)) + 1, [len(cell)]]) if len(cell) else []
            for first, last in zip(edges[:-1], edges[1:]):
                of = asking[int(cell[first])]
                step = max(1, _CELLS // len(of))
                for start in range(first, last, step):
                    part = batch.slice(start, min(step, last - start))
                    sims = np.round(matrix[of] @ to_matrix(part.column(width)).T, SIMILARITY_DIGITS)
                    best.offer(sims, part.columns[:width], of)
        found = best.batch(query_ids, names)
        if found is not None:
            yield found

    return map_batches(rows, partial, schema, summary=True)


def _blocks(queries: DataFrame, table: CellTable, block_bytes: int) -> tuple[DataFrame, int]:
    """The queries with the number of their block; one nearest cell fills blocks of its own
    if it has enough queries, the small ones share blocks with their neighbours."""
    def home(vectors: pa.Array) -> list[pa.Array]:
        rows = to_matrix(vectors)
        return [pa.array(table.bounds(rows).argmax(axis=1).astype(np.int32) if len(rows) else [], pa.int32())]

    homed = add_columns(queries, ["vector"], [T.StructField("home", T.IntegerType())], home)
    path = scratch_path(queries.sparkSession, "cell-queries")
    homed.write.parquet(path)
    homed = queries.sparkSession.read.schema(homed.schema).parquet(path)
    sizes = homed.groupBy("home").agg(F.sum(8 * F.size("vector")).alias("bytes"), F.count("*").alias("n")).orderBy("home").collect()
    starts, parts, n_blocks, room = {}, {}, 0, 0.0
    for r in sizes:
        share = max(r["bytes"] / block_bytes, r["n"] / QUERY_BLOCK_ROWS)
        if share <= room:
            room -= share
        else:
            parts[r["home"]], room = math.ceil(share), max(0.0, 1.0 - share)
            n_blocks += parts[r["home"]]
        starts[r["home"]] = n_blocks - parts.setdefault(r["home"], 1)
    if not sizes:
        return homed.withColumn("block", F.lit(0)), 0
    first = F.create_map(*[F.lit(x) for pair in starts.items() for x in pair])
    split = F.create_map(*[F.lit(x) for pair in parts.items() for x in pair])
    block = first[F.col("home")] + F.pmod(F.xxhash64("query_id"), split[F.col("home")]).cast("int")
    return homed.withColumn("block", block).drop("home"), n_blocks


def cell_topk(
    queries: DataFrame,
    table: CellTable,
    k: int = 10,
    payload: Sequence[str] = (),
    block_bytes: int = QUERY_BLOCK_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """``search.cosine_topk`` over a cell table, and what it read.

    Returns (query_id, rank, id, similarity, payload) and, per block of queries, the
    pairs of a query and a stored row (``pairs``), those compared (``compared``), and the
    cells opened in either pass (``cells_first``, ``cells_second``). Equal rows to a
    search without cells: a cell whose bound equals the k-th similarity is read too,
    since an equal similarity with a lower id ranks first. Query ids may not repeat.
    Each pass is written to the shared folder before the next one starts.
    """
    spark = queries.sparkSession
    stored = table.read(spark)
    columns = ["id", *payload]
    queries = queries.select("query_id", as_vector("vector").alias("vector"))
    schema = _output_schema(queries, stored, columns)
    dealt, n_blocks = _blocks(queries, table, block_bytes)
    found, report = scratch_path(spark, "cell-topk"), []
    for number in range(n_blocks):
        block = dealt.filter(F.col("block") == number).drop("block").toArrow().combine_chunks()
        if not block.num_rows:
            continue
        bounds = table.bounds(to_matrix(block.column("vector")))
        first = _first_cells(bounds, table.rows, k)
        opening = scratch_path(spark, "cell-first")
        _rank(_search(table, stored, block, first, k, columns, schema), k).write.parquet(opening)
        opened = spark.read.parquet(opening)
        last = opened.filter(F.col("rank") == k).select("query_id", "similarity").toArrow()
        reached = dict(zip(last.column(0).to_pylist(), last.column(1).to_pylist()))
        bar = np.array([reached.get(q, -np.inf) for q in block.column("query_id").to_pylist()])
        second = ~first & (bounds >= bar[:, None]) & (table.rows > 0)
        if second.any():
            more = _search(table, stored, block, second, k, columns, schema)
            opened = _rank(opened.drop("rank").select(*schema.fieldNames()).unionByName(more), k)
        opened.write.mode("append").parquet(found)
        compared = int(((first | second) * table.rows[None, :]).sum())
        opens = [int(w.any(axis=0).sum()) for w in (first, second)]
        report.append((number, block.num_rows, int(table.rows.sum()) * block.num_rows, compared, *opens))
    visits = spark.createDataFrame(
        report, "block int, n_queries long, pairs long, compared long, cells_first int, cells_second int"
    )
    ranked = T.StructType([schema["query_id"], T.StructField("rank", T.IntegerType()), *(schema[c] for c in ("id", "similarity", *payload))])
    result = spark.read.schema(ranked).parquet(found) if report else spark.createDataFrame([], ranked)
    return result, visits
