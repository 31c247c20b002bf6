"""Fuzzy c-means: memberships, one-pass steps, the fit loop and seeding.

A membership row is a function of the row and the centres alone, so nothing of the
size of the data is carried from one iteration to the next: each pass scans the
vectors once and returns k × d sums.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from ..functions.batches import add_columns, map_batches
from ..functions.vectors import VECTOR, as_vector, from_matrix, to_matrix
from ..session import complete_tables

# Smallest distance, and the term that keeps sums away from zero.
MIN_DISTANCE = 1e-12
EPSILON = 1e-10
_MEMBERSHIP = T.StructField("membership", VECTOR)


def distances(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Euclidean distances, one centre at a time to keep memory at n × k."""
    out = np.empty((len(rows), len(centers)))
    for j, center in enumerate(centers):
        gap = rows - center
        out[:, j] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
    return out


def membership_rows(gaps: np.ndarray, m: float, query_epsilon: bool = False) -> np.ndarray:
    """Memberships of each row in each cluster, from the distances.

    Fitted form: w / (Σw + ε) with w = d^(-2/(m-1)). The query form puts ε into the
    other denominator: 1 / (d^(2/(m-1)) · Σw + ε).
    """
    if m <= 1.0:
        raise ValueError("fuzziness must be above 1")
    power = 2.0 / (m - 1.0)
    gaps = np.maximum(gaps, MIN_DISTANCE)
    nearest = gaps.min(axis=1, keepdims=True)
    # Weights relative to the nearest centre stay in the double range for any m; the
    # powers of the distances alone do not. Only ε is scaled by such a power.
    relative = (nearest / gaps) ** power
    total = relative.sum(axis=1, keepdims=True)
    if query_epsilon:
        return relative / (total + EPSILON * relative)
    with np.errstate(over="ignore"):
        return relative / (total + EPSILON * nearest**power)


def memberships(
    df: DataFrame,
    centers: np.ndarray,
    m: float = 2.0,
    vector: str = "vector",
    query_epsilon: bool = False,
    keep_vector: bool = True,
) -> DataFrame:
    """Add ``membership``, the array of memberships for given centres."""
    return add_columns(
        df.withColumn(vector, as_vector(vector)),
        [vector],
        [_MEMBERSHIP],
        lambda v: [from_matrix(membership_rows(distances(to_matrix(v), centers), m, query_epsilon))],
        drop=() if keep_vector else [vector],
    )


@dataclass(frozen=True)
class Step:
    """What one pass over the data finds out about a set of centres."""

    centers: np.ndarray
    objective: float
    delta: float


@dataclass(frozen=True)
class Candidate:
    """Centres to evaluate, and those before them."""

    centers: np.ndarray
    m: float
    previous: np.ndarray | None = None


def steps(df: DataFrame, candidates: Sequence[Candidate]) -> list[Step]:
    """Evaluate several sets of centres in one scan of (vector).

    Per-task sums are merged by Spark, and k × d numbers per candidate come back.
    The change in membership is infinite for a candidate without previous centres.
    """
    candidates = list(candidates)
    schema = T.StructType([T.StructField("sums", VECTOR), T.StructField("deltas", VECTOR)])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(c.centers.size + len(c.centers) + 1) for c in candidates]
        deltas = np.zeros(len(candidates))
        seen = False
        for batch in batches:
            if not batch.num_rows:
                continue
            seen = True
            rows = to_matrix(batch.column(0))
            for i, c in enumerate(candidates):
                gaps = distances(rows, c.centers)
                u = membership_rows(gaps, c.m)
                um = u**c.m
                totals[i] += np.concatenate([(um.T @ rows).ravel(), um.sum(axis=0), [(um * gaps**2).sum()]])
                if c.previous is not None:
                    before = membership_rows(distances(rows, c.previous), c.m)
                    deltas[i] = max(deltas[i], np.abs(u - before).max())
        if seen:
            yield pa.RecordBatch.from_arrays(
                [from_matrix(np.concatenate(totals)[None, :]), from_matrix(deltas[None, :])],
                names=["sums", "deltas"],
            )

    merged = (
        map_batches(df.select(as_vector("vector").alias("vector")), partial, schema, summary=True)
        .agg(
            Summarizer.sum(array_to_vector("sums")).alias("sums"),
            Summarizer.max(array_to_vector("deltas")).alias("deltas"),
        )
        .first()
    )
    if merged["sums"] is None or not len(merged["sums"]):
        raise ValueError("no vectors to cluster")
    sums, deltas = merged["sums"].toArray(), merged["deltas"].toArray()
    out, at = [], 0
    for c, delta in zip(candidates, deltas):
        k, d = c.centers.shape
        weighted, weight = sums[at:at + k * d].reshape(k, d), sums[at + k * d:at + k * d + k]
        change = float(delta) if c.previous is not None else float("inf")
        out.append(Step(weighted / (weight[:, None] + EPSILON), float(sums[at + k * d + k]), change))
        at += k * d + k + 1
    return out


def step(df: DataFrame, centers: np.ndarray, m: float = 2.0, previous: np.ndarray | None = None) -> Step:
    """New centres, the objective of the given ones and the change in membership."""
    return steps(df, [Candidate(centers, m, previous)])[0]


@dataclass(frozen=True)
class FuzzyModel:
    """Fitted centres with the trace of the fit."""

    centers: np.ndarray
    m: float
    objective_trace: tuple[float, ...] = ()
    delta_trace: tuple[float, ...] = ()

    @property
    def n_clusters(self) -> int:
        return len(self.centers)

    @property
    def n_iter(self) -> int:
        return len(self.objective_trace)

    def predict(
        self, df: DataFrame, vector: str = "vector", query_epsilon: bool = False, keep_vector: bool = True
    ) -> DataFrame:
        """Memberships of new rows in the fitted clusters."""
        return memberships(df, self.centers, self.m, vector, query_epsilon, keep_vector)

    def trace(self, spark: SparkSession) -> DataFrame:
        """iteration, objective, delta of the fit."""
        rows = [
            (i + 1, o, d) for i, (o, d) in enumerate(zip(self.objective_trace, self.delta_trace))
        ]
        return spark.createDataFrame(rows, "iteration int, objective double, delta double")


def fit(
    df: DataFrame,
    init_centers: np.ndarray | None = None,
    n_clusters: int = 15,
    m: float = 2.0,
    max_iter: int = 300,
    tol: float = 1e-5,
    seed: int = 42,
    id_col: str = "id",
    log: str | None = None,
) -> FuzzyModel:
    """Iterate until no membership changes by ``tol``; persist ``df`` beforehand.

    Pass t evaluates the centres of iteration t and sums up those of t + 1, so one
    iteration costs one scan. Without ``init_centers`` rows are drawn as seeds. With
    ``log`` a fit that was stopped goes on, see :func:`fit_many`.
    """
    if init_centers is None:
        init_centers = distance_seeding(df, n_clusters, seed, id_col)
    if init_centers.shape[0] != n_clusters:
        raise ValueError("one starting centre per cluster is needed")
    return fit_many(df, [(init_centers, m)], max_iter, tol, log)[0]


def fit_many(
    df: DataFrame,
    starts: Sequence[tuple[np.ndarray, float]],
    max_iter: int = 300,
    tol: float = 1e-5,
    log: str | None = None,
) -> list[FuzzyModel]:
    """Fit several (starting centres, m) side by side, sharing each scan.

    A fit that has converged drops out of the scans that follow. With ``log``, a folder
    that the driver and its successor reach, every iteration is written there as a table
    of the size of the centres, and a call with the same starts, m and ``tol`` over the
    same rows goes on behind the last one written to the end; other ones are refused.
    ``max_iter`` may differ: a finished log is cut to it or continued.
    """
    size = len(starts)
    spark = df.sparkSession
    current = [np.asarray(c, dtype=np.float64) for c, _ in starts]
    fuzziness = [m for _, m in starts]
    objectives: list[list[float]] = [[] for _ in starts]
    deltas: list[list[float]] = [[] for _ in starts]
    done = [] if log is None else _logged(spark, log, max_iter)
    if done:
        _check_log(done[0], current, fuzziness, tol)
        ahead = [np.empty(0)] * size
        for rows in done:
            for i, r in rows.items():
                current[i], ahead[i] = (np.array(r[c]).reshape(current[i].shape) for c in ("current", "ahead"))
                if r["iteration"]:
                    objectives[i].append(r["objective"])
                    deltas[i].append(r["delta"])
    else:
        ahead = [s.centers for s in steps(df, [Candidate(c, m) for c, m in zip(current, fuzziness)])]
        if log is not None:
            _write_log(spark, log, 0, [(i, fuzziness[i], tol, current[i], ahead[i], None, None) for i in range(size)])
    active = [i for i in range(size) if not deltas[i] or deltas[i][-1] >= tol]
    for iteration in range(max(1, len(done)), max_iter + 1):
        if not active:
            break
        running = list(active)
        results = steps(df, [Candidate(ahead[i], fuzziness[i], current[i]) for i in active])
        for i, result in zip(list(active), results):
            current[i], ahead[i] = ahead[i], result.centers
            objectives[i].append(result.objective)
            deltas[i].append(result.delta)
            if result.delta < tol:
                active.remove(i)
        if log is not None:
            kept = [(i, fuzziness[i], tol, current[i], ahead[i], objectives[i][-1], deltas[i][-1]) for i in running]
            _write_log(spark, log, iteration, kept)
    return [
        FuzzyModel(current[i], fuzziness[i], tuple(objectives[i]), tuple(deltas[i])) for i in range(size)
    ]


_LOG = (
    "iteration int, fit int, m double, tol double, current array<double>, ahead array<double>, objective double, delta double"
)


def _write_log(spark: SparkSession, log: str, iteration: int, fits: Sequence[tuple]) -> None:
    """One iteration of the fits still running as a table of its own."""
    rows = [(iteration, i, m, tol, c.ravel().tolist(), a.ravel().tolist(), o, d) for i, m, tol, c, a, o, d in fits]
    spark.createDataFrame(rows, _LOG).coalesce(1).write.mode("overwrite").parquet(f"{log}/{iteration:06d}")


def _logged(spark: SparkSession, log: str, last: int) -> list[dict[int, Row]]:
    """The iterations 0, 1, ... written to the end without a gap, as rows by fit."""
    names = complete_tables(spark, log)
    n = next((i for i, name in enumerate(names) if name != f"{i:06d}"), len(names))
    found: list[dict[int, Row]] = [{} for _ in range(min(n, last + 1))]
    if found:
        for r in spark.read.schema(_LOG).parquet(*[f"{log}/{i:06d}" for i in range(len(found))]).collect():
            found[r["iteration"]][r["fit"]] = r
    return found


def _check_log(first: dict[int, Row], starts: Sequence[np.ndarray], fuzziness: Sequence[float], tol: float) -> None:
    """Refuse a log of other starts; those of a fit made anew may differ in the last digits."""
    same = sorted(first) == list(range(len(starts))) and all(
        r["m"] == fuzziness[i] and r["tol"] == tol and len(r["current"]) == starts[i].size
        and np.allclose(r["current"], starts[i].ravel(), rtol=1e-6, atol=1e-9)
        for i, r in first.items()
    )
    if not same:
        raise ValueError("the log belongs to a fit with other starts, m or tol")


def distance_seeding(df: DataFrame, k: int, seed: int = 42, id_col: str = "id") -> np.ndarray:
    """k distinct rows as starting centres, each drawn ∝ squared distance so far.

    Row i of draw t is given the uniform number u that md5(seed:t:i) spells, and the
    row with the largest ln(u) / d² is taken: a draw with probability ∝ d² that does
    not depend on the partitioning. One scan per centre, one row back.
    """
    rows = df.select(F.col(id_col).alias("id"), as_vector("vector").alias("vector"))
    chosen: list[list[float]] = []
    for t in range(k):
        digits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:{t}:"), F.col("id").cast("string"))), 1, 12), 16, 10)
        u = (digits.cast("double") + 1.0) / float(2**48 + 1)
        if chosen:
            centers = np.array(chosen)

            def nearest(v: pa.Array, centers: np.ndarray = centers) -> list[pa.Array]:
                return [pa.array(distances(to_matrix(v), centers).min(axis=1) ** 2)]

            scored = add_columns(rows, ["vector"], [T.StructField("d2", T.DoubleType())], nearest)
            scored = scored.filter(F.col("d2") > 0).select("id", "vector", (F.log(u) / F.col("d2")).alias("key"))
        else:
            scored = rows.select("id", "vector", F.log(u).alias("key"))
        pick = scored.agg(F.max_by("vector", F.struct("key", "id"))).first()[0]
        if pick is None:
            raise ValueError(f"only {len(chosen)} distinct vectors for {k} centres")
        chosen.append(pick)
    return np.array(chosen)


def centers_table(spark: SparkSession, centers: np.ndarray) -> DataFrame:
    """cluster, center."""
    ids = pa.array(np.arange(len(centers), dtype=np.int32))
    return spark.createDataFrame(pa.table({"cluster": ids, "center": from_matrix(np.asarray(centers))}))


def centers_from(df: DataFrame, cluster: str = "cluster", center: str = "center") -> np.ndarray:
    """A centre table, one row per cluster, as a matrix in cluster order."""
    rows = df.select(F.col(cluster).alias("c"), as_vector(center).alias("v")).collect()
    return np.array([r["v"] for r in sorted(rows, key=lambda r: r["c"])])


def group_means(df: DataFrame, group: str, vector: str = "vector") -> DataFrame:
    """Mean vector per group as (cluster, center), with map-side partial sums."""
    mean = vector_to_array(Summarizer.mean(array_to_vector(as_vector(vector))))
    return df.groupBy(F.col(group).alias("cluster")).agg(mean.alias("center"))


def flatten(df: DataFrame, keys: Sequence[str], values: str, names: tuple[str, str]) -> DataFrame:
    """Long form of an array column: keys, position, value."""
    return df.select(*keys, F.posexplode_outer(values).alias(*names)).filter(F.col(names[0]).isNotNull())
