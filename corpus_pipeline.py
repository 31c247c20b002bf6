"""From raw documents to packed sequences, in five stages.

Each stage works on all rows that the one before kept. The first four return the columns
of documents, more of them included: quality rules drop the documents they reject; line dedup
drops repeated lines from the texts, and documents of which less than half is left, since
the rest of a near copy is fragments; the Jaccard join keeps one row of each group of near
or equal texts, that with the smallest id; decontamination drops documents that hold a
benchmark window. The last one packs the tokens of what is left.

Null and empty texts and texts without words fail the quality rules. A null id ranks last
where ids decide. Equal rows are one row after the join. Very long texts are handled whole.
An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarrylight.llm import decontaminate, jaccard_join, line_dedup, packing, quality
from quarrylight.llm.common import staged, table

#: Near-duplicates in training data: shingles of five words, similar from 80 percent on.
SHINGLE, PERCENT = 5, 80
#: Share of its characters that a document keeps in line dedup, at least.
LEAST_LEFT = 0.5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def deduplicated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.remove_lines(docs, LEAST_LEFT)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs, SHINGLE, PERCENT)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", deduplicated_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", decontaminated),
    ("best-fit packing", packed),
]

#: The last stage needs the tokenizer, which SQL does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the documents in ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
