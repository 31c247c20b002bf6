"""Column contracts of the tables."""

from __future__ import annotations

from pyspark.sql import types as T

_VECTOR = T.ArrayType(T.DoubleType())

CORPUS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("label", T.StringType()),
    ]
)

VECTORS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("vector", _VECTOR),
        T.StructField("label", T.StringType()),
        T.StructField("doc_idx", T.LongType()),
        T.StructField("text_preview", T.StringType()),
    ]
)

RESULT = T.ArrayType(
    T.StructType(
        [
            T.StructField("id", T.StringType()),
            T.StructField("similarity", T.DoubleType()),
            T.StructField("label", T.StringType()),
            T.StructField("preview", T.StringType()),
        ]
    )
)

ENTRIES = T.StructType(
    [
        T.StructField("entry_id", T.LongType()),
        T.StructField("query", T.StringType()),
        T.StructField("vector", _VECTOR),
        T.StructField("membership", _VECTOR),
        T.StructField("cluster", T.IntegerType()),
        T.StructField("result", RESULT),
        T.StructField("arrival", T.LongType()),
        T.StructField("hit_count", T.LongType()),
        T.StructField("position", T.LongType()),
    ]
)

PARALLEL_ARRAYS = T.StructType(
    [
        T.StructField("documents", T.ArrayType(T.StringType())),
        T.StructField("labels", T.ArrayType(T.StringType())),
        T.StructField("category_indices", T.ArrayType(T.IntegerType())),
        T.StructField("category_names", T.ArrayType(T.StringType())),
        T.StructField("n_docs", T.IntegerType()),
        T.StructField("description", T.StringType()),
    ]
)
