"""Answering queries end to end: embed, route, reuse or retrieve."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..operators.diagnostics import hard_assignment
from ..operators.fuzzy import FuzzyModel
from ..operators.reduction import LsaModel, PcaModel
from ..operators.replay import replay
from ..operators.reuse import (
    BUCKET_CAP, THRESHOLD, membership_map, seed_entries, split_blank, with_cluster_label,
)
from ..operators.search import as_results, retrieve
from ..operators.tfidf import TfidfModel
from ..session import checkpoint_root
from ..sources.corpus import clean_queries
from ..sources.schemas import ENTRIES, RESULT


@dataclass(frozen=True)
class Encoder:
    """Text to vectors: cleaning, TF-IDF, LSA and length one."""

    tfidf: TfidfModel
    lsa: LsaModel

    def encode(self, queries: DataFrame, query: str = "query", full: bool = False) -> DataFrame:
        """Add ``vector``; texts without known words get the zero vector."""
        return self.lsa.embed(self.tfidf.encode(clean_queries(queries, query, full)))


@dataclass(frozen=True)
class Router:
    """Vectors to memberships and a dominant cluster."""

    clusters: FuzzyModel
    pca: PcaModel | None = None

    def route(self, queries: DataFrame) -> DataFrame:
        """Add ``membership`` (query form) and ``cluster``."""
        if self.pca is None:
            return hard_assignment(self.clusters.predict(queries, query_epsilon=True))
        reduced = self.pca.project(queries, out="reduced")
        return hard_assignment(self.clusters.predict(reduced, "reduced", query_epsilon=True, keep_vector=False))


def prepare(queries: DataFrame, encoder: Encoder, router: Router) -> tuple[DataFrame, DataFrame]:
    """(routed, rejected): valid queries with vector and cluster, and the blank ones."""
    valid, rejected = split_blank(queries)
    return router.route(encoder.encode(valid)), rejected


def seed_table(answered: DataFrame, encoder: Encoder, router: Router, cap: int = BUCKET_CAP) -> DataFrame:
    """Entry table for answered queries (query_id, query, result, arrival)."""
    routed, _ = prepare(answered.withColumn("result", F.col("result").cast(RESULT)), encoder, router)
    entries = seed_entries(routed.withColumnRenamed("query_id", "entry_id"), cap)
    return entries.select(*ENTRIES.fieldNames())


def answer_log(
    routed: DataFrame,
    vector_table: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    cap: int = BUCKET_CAP,
    k: int = 5,
) -> DataFrame:
    """Answers to a routed query log (query_id, arrival, query, vector, membership, cluster).

    ``routed`` is read several times, so hand in a table or a persisted frame. Only
    misses are searched for; a hit takes over the result of the query it matched.
    Hits on one popular query all join with its single row, which AQE splits.
    """
    checkpoint_root(routed.sparkSession)
    # The replay is used twice below and runs in order, so it is kept: a few numbers
    # per query, in the shared folder, independent of the executors that made them.
    log = replay(routed, threshold, cap).checkpoint()
    decided = routed.join(log.drop("cluster"), "query_id").withColumn(
        "answer_id", F.coalesce("source_id", "query_id")
    )
    missed = decided.filter(~F.col("hit"))
    results = as_results(retrieve(missed.select("query_id", "vector"), vector_table, k))
    given = missed.select("query_id", F.col("query").alias("source_query")).join(results, "query_id", "left")
    # A query's answer is its own or that of its source, so every row has a key to
    # join by; misses do not gather under a null one.
    answered = decided.join(given.withColumnRenamed("query_id", "answer_id"), "answer_id", "left").withColumn(
        "matched_query", F.when(F.col("hit"), F.col("source_query"))
    )
    return with_cluster_label(answered, labels).select(
        "query_id",
        "query",
        F.col("hit").alias("cache_hit"),
        "matched_query",
        F.round("similarity", 4).alias("similarity_score"),
        "result",
        F.col("cluster").alias("dominant_cluster"),
        "cluster_label",
        membership_map(F.col("membership")).alias("membership_distribution"),
    )
