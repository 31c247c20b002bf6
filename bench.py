"""Time the headline queries: one JSON line on standard output.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Each query is run to the
end with its rows discarded; the session is warmed up beforehand.
"""

from __future__ import annotations

import json
import os
import sys
import time

from quarrylight.plans.catalogue import QUERIES
from quarrylight.session import build_session

HEADLINE = (
    "clean_documents", "token_counts", "vocabulary", "tfidf_weights", "sparse_topk", "lsa_projection",
    "lsa_embed", "vector_topk", "vector_topk_filtered", "retrieve_formatted", "fuzzy_membership",
    "fuzzy_step", "fuzzy_fit_trace", "distance_seeding", "silhouette_exact", "cluster_report",
    "boundary_docs", "reuse_lookup", "threshold_sweep", "query_replay", "answer_queries",
    "stream_replay", "bucket_compaction",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in ("vector_topk", "tfidf_weights"):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        spark.catalog.clearCache()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        spark.catalog.clearCache()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
