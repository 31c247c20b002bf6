import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarrylight.functions.vectors import l2_normalise
from quarrylight.operators import search, topk
from quarrylight.sources import vector_table


def frame(spark, x, key="id", ids=None):
    ids = range(len(x)) if ids is None else ids
    kind = "string" if isinstance(list(ids)[0], str) else "long"
    return spark.createDataFrame([(i, [float(z) for z in v]) for i, v in zip(ids, x)], f"{key} {kind}, vector array<double>")


def unit(n, d=8, seed=0):
    x = np.random.default_rng(seed).standard_normal((n, d))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def brute(q, x, ids, k):
    sims = np.round(x @ q, 10)
    order = sorted(range(len(x)), key=lambda i: (-sims[i], ids[i]))[:k]
    return [(ids[i], sims[i]) for i in order]


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["id"], r["similarity"]))
    return out


@pytest.mark.parametrize("block_bytes, parts", [(1 << 25, 1), (1 << 25, 7), (400, 3)])
def test_topk_matches_brute_force(spark, block_bytes, parts):
    x, q = unit(300), unit(20, seed=1)
    x[100:200] = x[0]  # a third of the rows are copies of one
    q[3] = x[0]
    got = found(search.cosine_topk(frame(spark, q, "query_id"), frame(spark, x).repartition(parts), 7, block_bytes=block_bytes))
    assert sorted(got) == list(range(20))
    for i in range(20):
        want = brute(q[i], x, list(range(300)), 7)
        assert [a for a, _ in got[i]] == [a for a, _ in want]
        assert [s for _, s in got[i]] == pytest.approx([s for _, s in want])


def test_prefix_property_and_text_ids(spark):
    x, ids = unit(40), [f"doc_{i}" for i in range(40)]
    q = frame(spark, unit(3, seed=2), "query_id")
    five = found(search.cosine_topk(q, frame(spark, x, ids=ids), 5))
    nine = found(search.cosine_topk(q, frame(spark, x, ids=ids), 9))
    assert all(nine[i][:5] == five[i] for i in five)


def test_k_beyond_table_and_empty_sides(spark):
    x, q = frame(spark, unit(4)), frame(spark, unit(2, seed=5), "query_id")
    assert {k: len(v) for k, v in found(search.cosine_topk(q, x, 50)).items()} == {0: 4, 1: 4}
    assert search.cosine_topk(q.filter("false"), x, 3).count() == 0
    assert search.cosine_topk(q, x.filter("false"), 3).count() == 0


def test_zero_query_ranks_by_id(spark):
    got = found(search.cosine_topk(frame(spark, np.zeros((1, 8)), "query_id"), frame(spark, unit(10)), 3))
    assert got[0] == [(0, 0.0), (1, 0.0), (2, 0.0)]


def test_filter_and_padding(spark):
    x = frame(spark, unit(30))
    q = frame(spark, unit(2, seed=9), "query_id")
    only = F.col("id") >= 28
    assert all(len(v) == 2 for v in found(search.cosine_topk(q, x, 5, only)).values())
    padded = found(search.cosine_topk(q, x, 5, only, pad=True))
    for hits in padded.values():
        assert {i for i, _ in hits[:2]} == {28, 29}
        assert hits[2:] == [(0, -1.0), (1, -1.0), (2, -1.0)]


def test_retrieve_formats(spark):
    x = unit(12)
    table = frame(spark, x, ids=[f"doc_{i}" for i in range(12)]).withColumn("label", F.lit(None).cast("string"))
    table = table.withColumn("text_preview", F.repeat(F.lit("x"), 200))
    row = search.as_results(search.retrieve(frame(spark, x[:1], "query_id"), table)).first()
    assert row["result"][0] == ("doc_0", 1.0, "unknown", "x" * 120)
    assert len(row["result"]) == 5


def test_normalise(spark):
    got = {r["id"]: r["vector"] for r in l2_normalise(frame(spark, [[3.0, 4.0], [0.0, 0.0]])).collect()}
    assert got == {0: [0.6, 0.8], 1: [0.0, 0.0]}


def test_vector_table(spark, tmp_path):
    docs = spark.createDataFrame([(i, "t" * 300, f"l{i}") for i in range(4)], "doc_id long, text string, label string")
    table = vector_table.build(frame(spark, unit(4), "doc_id"), docs)
    row = table.filter("doc_idx = 2").first()
    assert (row["id"], row["label"], len(row["text_preview"])) == ("doc_2", "l2", 200)
    bare = vector_table.build(frame(spark, unit(6), "doc_id"), docs).filter("doc_idx = 5").first()
    assert (bare["id"], bare["label"], bare["text_preview"]) == ("doc_5", "unknown", "")
    whole = vector_table.append(table, table.select("id", "vector"))
    assert vector_table.count(whole) == 8
    assert vector_table.repeated_ids(whole).count() == 4
    with pytest.raises(ValueError):
        vector_table.append(table, table.select("id"))
    with pytest.raises(Exception, match="null"):
        vector_table.append(table, table.select(F.lit(None).cast("string").alias("id"), "vector")).collect()
    vector_table.save(table, str(tmp_path / "v"))
    assert sorted(vector_table.load(spark, str(tmp_path / "v")).collect()) == sorted(table.collect())


def test_get_by_ids(spark):
    table = spark.createDataFrame([("a", 1, 10), ("b", 2, 20), ("a", 3, 30)], "id string, stored int, x int")
    wanted = spark.createDataFrame([(0, "b"), (1, "zz"), (2, "a"), (3, "b")], "position int, id string")
    rows = vector_table.get_by_ids(table, wanted, order="stored").collect()
    assert [(r["position"], r["id"], r["x"]) for r in rows] == [(0, "b", 20), (2, "a", 30), (3, "b", 20)]


def test_best_k_of_many_queries_keeps_up():
    rng = np.random.default_rng(3)
    n, k, width = 120_000, 3, 12
    best = topk.BestK(n, k)
    kept = []
    for step in range(6):
        sims = np.round(rng.random((n, width)), 3)
        ids = pa.array(np.arange(step * width, (step + 1) * width))
        best.offer(sims, [ids])
        kept.append(sims)
        assert best.n_pending <= max(n * k, topk._LEAST_PENDING)
    got = best.batch(pa.array(np.arange(n)), ["query_id", "similarity", "id"]).to_pandas()
    every = np.concatenate(kept, axis=1)
    for q in range(0, n, 9973):
        mine = got[got["query_id"] == q].sort_values(["similarity", "id"], ascending=[False, True])
        want = np.lexsort((np.arange(every.shape[1]), -every[q]))[:k]
        assert mine["id"].tolist() == want.tolist()
    assert len(got) == n * k
