"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylight.llm.common import staged


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """node and label, the smallest node of its component, for every node of an edge (a, b).

    Large and small stars in turn (Kiveris et al., "Connected Components in MapReduce and
    Beyond"): each round hangs neighbours on the smallest one, by aggregations and joins,
    until nothing changes. A node in very many edges is reduced by partial minima.
    """
    edges = edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = staged(edges, "edges")
    state = _state(edges)
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("m").alias("a"), "b").filter("a != b").distinct()
        large = staged(large, "large")
        # every edge leads from the larger node to the smaller
        lowest = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(lowest, "b")
        small = small.select(F.col("m").alias("a"), "b").union(small.select(F.col("m"), F.col("a"))).filter("a != b")
        edges = staged(small.distinct(), "small")
        if (now := _state(edges)) == state:
            break
        state = now
    return edges.select(F.col("b").alias("node"), F.col("a").alias("label")).union(
        edges.select("a", F.col("a")).distinct()
    )
