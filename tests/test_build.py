from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrylight.operators import reuse
from quarrylight.plans import answer, build
from quarrylight.sources.schemas import ENTRIES

TOPICS = {
    "sci.space": "rocket orbit moon launch satellite mission",
    "rec.autos": "engine brake wheel torque exhaust clutch",
    "soc.faith": "prayer church psalm gospel sermon mercy",
}


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(90):
        label = list(TOPICS)[i % 3]
        rows.append((i, "From: x@y.z\n" + " ".join(rng.choice(TOPICS[label].split(), 12)), label))
    corpus = spark.createDataFrame(rows, "doc_id long, text string, label string")
    out = str(tmp_path_factory.mktemp("build"))
    small = build.Settings(
        components=6, svd_passes=3, pca_dims=2, clusters=3, restarts=1, max_iter=20, k_sweep_iter=3, m_sweep_iter=3,
        k_grid=(2, 3), m_grid=(1.5, 2.0), boundary_docs=5,
    )
    return corpus, out, small, build.staged_build(spark, corpus, out, small)


def test_stages_run_once(spark, built):
    corpus, out, small, ran = built
    assert ran == ["features", "vectors", "clusters"]
    assert build.staged_build(spark, corpus, out, small) == []
    assert build.staged_build(spark, corpus, out + "-none", small, skip=True) == []
    assert spark.read.parquet(f"{out}/vectors").count() == 90
    assert spark.read.parquet(f"{out}/boundary_docs").count() == 5
    labels = build.load_labels(spark, out).collect()
    assert sorted(r["dominant_category"] for r in labels) == sorted(TOPICS) and all(r["purity"] == 1.0 for r in labels)
    assert 0 < spark.read.parquet(f"{out}/explained").first()["explained_ratio"] <= 1.0


def test_other_settings_and_texts_are_built_anew(spark, built, tmp_path):
    corpus, _, small, _ = built
    out = str(tmp_path / "again")
    assert build.staged_build(spark, corpus, out, small) == ["features", "vectors", "clusters"]
    assert build.staged_build(spark, corpus.repartition(5), out, small) == []
    other = replace(small, clusters=2)
    assert build.staged_build(spark, corpus, out, other) == ["clusters"]
    assert spark.read.parquet(f"{out}/centers").count() == 2
    assert build.staged_build(spark, corpus, out, other) == []
    # a stage that fails half-way is not taken for the one before it, nor for its own
    first = small.k_grid
    with pytest.raises(Exception):
        build.staged_build(spark, corpus, out, replace(other, k_grid=("none",)))
    assert build.staged_build(spark, corpus, out, replace(other, k_grid=first)) == ["clusters"]
    changed = corpus.withColumn("text", F.when(F.col("doc_id") == 3, F.lit("rocket orbit")).otherwise(F.col("text")))
    assert build.corpus_digest(changed) != build.corpus_digest(corpus)
    assert build.corpus_digest(corpus.union(corpus.limit(1))) != build.corpus_digest(corpus)


def test_features_leave_no_shuffle_files(spark, built, tmp_path):
    corpus, out, small, _ = built
    blocks = lambda: spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ").split()
    before = {name for name in blocks() if "shuffle_" in name}
    build.features_stage(spark, corpus, str(tmp_path), small)
    assert not {name for name in blocks() if "shuffle_" in name} - before
    for name in ("vocabulary", "sparse"):
        mine, first = (spark.read.parquet(f"{folder}/{name}") for folder in (tmp_path, out))
        assert mine.schema == first.schema and sorted(map(str, mine.collect())) == sorted(map(str, first.collect()))


def test_answers_end_to_end(spark, built):
    _, out, _, _ = built
    encoder, router = build.load_encoder(spark, out), build.load_router(spark, out)
    asked = [
        (0, 0, "rocket launch orbit satellite"), (1, 1, "Brake and wheel!"), (2, 2, "  "), (3, 3, "satellite orbit, rocket launch"),
        (4, 4, "zebra"), (5, 5, "gospel sermon psalm"), (6, 6, "rocket launch orbit satellite"),
    ]
    queries = spark.createDataFrame(asked, "query_id long, arrival long, query string")
    routed, rejected = answer.prepare(queries, encoder, router)
    assert [r["query_id"] for r in rejected.collect()] == [2]
    routed = routed.persist()
    rows = {r["query_id"]: r for r in answer.answer_log(routed, build.load_vectors(spark, out), build.load_labels(spark, out)).collect()}
    assert sorted(rows) == [0, 1, 3, 4, 5, 6]
    assert [rows[i]["cache_hit"] for i in (0, 1, 4, 5, 6)] == [False, False, False, False, True]
    assert rows[6]["matched_query"] == asked[0][2] and rows[6]["result"] == rows[0]["result"]
    assert rows[0]["matched_query"] is None and rows[0]["similarity_score"] == -1.0
    assert rows[0]["cluster_label"] == "sci.space" and {h["label"] for h in rows[0]["result"]} == {"sci.space"}
    assert rows[1]["cluster_label"] == "rec.autos" and rows[5]["cluster_label"] == "soc.faith"
    assert len(rows[0]["result"]) == 5 and len(rows[0]["membership_distribution"]) == 3
    routed.unpersist()


def test_full_cleaning_drops_what_the_served_one_keeps(spark, built):
    _, out, _, _ = built
    encoder = build.load_encoder(spark, out)
    query = spark.createDataFrame([(0, "> rocket\nengine")], "query_id long, query string")
    served = encoder.encode(query).first()["vector"]
    full = encoder.encode(query, full=True).first()["vector"]
    assert not np.allclose(served, full)
    assert np.linalg.norm(full) == pytest.approx(1.0)


def test_seeded_table_and_expectations(spark, built, tmp_path):
    _, out, _, _ = built
    encoder, router = build.load_encoder(spark, out), build.load_router(spark, out)
    known = [(0, "rocket orbit launch", None, 0), (1, "engine torque clutch", None, 1), (2, "psalm gospel mercy", None, 2)]
    answered = spark.createDataFrame(known, "query_id long, query string, result string, arrival long")
    answered = answered.withColumn("result", F.array(F.struct(F.lit("d").alias("id"), F.lit(0.5).alias("similarity"),
                                                              F.lit("l").alias("label"), F.lit("p").alias("preview"))))
    entries = answer.seed_table(answered, encoder, router)
    assert entries.columns == ENTRIES.fieldNames()
    reuse.save_entries(entries, str(tmp_path / "entries"))
    entries = reuse.load_entries(spark, str(tmp_path / "entries"))
    assert entries.count() == 3 and entries.first()["result"][0]["id"] == "d"
    asked = [(10, 10, "launch a rocket into orbit", True), (11, 11, "torque, engine; clutch", True), (12, 12, "zebra", False)]
    tests = spark.createDataFrame(asked, "query_id long, arrival long, query string, expected_hit boolean")
    routed, _ = answer.prepare(tests, encoder, router)
    looked_up = reuse.lookup(routed, entries, 0.85)
    matched = {r["query_id"]: r["matched_query"] for r in looked_up.collect()}
    assert matched == {10: known[0][1], 11: known[1][1], 12: None}
    counts = {(r["expected_hit"], r["hit"]): r["n"] for r in reuse.hit_evaluation(looked_up).collect()}
    assert counts == {(True, True): 2, (False, False): 1}
    reuse.save_entries(reuse.flush(entries), str(tmp_path / "entries"), "overwrite")
    assert reuse.load_entries(spark, str(tmp_path / "entries")).count() == 0


def test_features_are_built_from_texts(spark, built):
    """The vocabulary and the sparse rows of counted texts, without a table of counts."""
    import os

    from quarrylight.operators import tfidf
    from quarrylight.sources.corpus import clean_corpus

    corpus, out, small, _ = built
    assert not os.path.exists(f"{out}/counts")
    counted = tfidf.count_terms(clean_corpus(corpus)).select("doc_id", "terms")
    model = tfidf.TfidfModel.fit(counted, small.min_df, small.max_df, small.max_features)
    vocabulary = spark.read.parquet(f"{out}/vocabulary").orderBy("term_id").collect()
    assert tuple(r["term"] for r in vocabulary) == model.terms and [r["idf"] for r in vocabulary] == model.idf.tolist()
    by_id = lambda df: sorted((r["doc_id"], r["term_ids"], r["weights"]) for r in df.collect())
    assert by_id(spark.read.parquet(f"{out}/sparse")) == by_id(model.weigh(counted))


def test_distances_hold_one_array():
    """Close pairs beside large rows keep their digits, and the peak is about one array of the result."""
    import tracemalloc

    from quarrylight.functions.vectors import pair_distances

    rng = np.random.default_rng(0)
    left, right = rng.standard_normal((300, 8)) * 1000, rng.standard_normal((2000, 8))
    right[:300] = left + 1e-5
    right[300:600] = left
    want = np.sqrt(((left[:, None, :] - right[None, :, :]) ** 2).sum(axis=2))
    np.testing.assert_allclose(pair_distances(left, right), want, rtol=1e-9)
    assert pair_distances(left[:0], right).shape == (0, 2000) and pair_distances(left, right[:0]).shape == (300, 0)
    tracemalloc.start()
    pair_distances(left, right)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.6 * want.nbytes
