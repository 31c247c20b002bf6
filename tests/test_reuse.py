import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrylight.operators import replay, reuse
from quarrylight.sources.schemas import ENTRIES
from quarrylight.streaming import reuse_stream


def unit(n, d=6, seed=0, spread=0.6, groups=5):
    rng = np.random.default_rng(seed)
    middle = rng.standard_normal((groups, d))
    x = middle[np.arange(n) % groups] + spread * rng.standard_normal((n, d))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def log_frame(spark, x, cluster, parts=3):
    rows = [(i, i, int(c), [float(z) for z in v]) for i, (c, v) in enumerate(zip(cluster, x))]
    return spark.createDataFrame(rows, "query_id long, arrival long, cluster int, vector array<double>").repartition(parts)


def entries_frame(spark, x, cluster, cap=500):
    rows = [(i, f"q{i}", [float(z) for z in v], int(c), i) for i, (c, v) in enumerate(zip(cluster, x))]
    df = spark.createDataFrame(rows, "entry_id long, query string, vector array<double>, cluster int, arrival long")
    return reuse.seed_entries(df, cap)


def simulate(x, cluster, threshold, cap):
    """The log and the surviving hit counts, from a list of facts that only grows.

    A fact says which query was stored, hit or dropped at which arrival. What a bucket
    holds, and which entry comes first in it, is derived from the facts at each arrival:
    entries stand in the order of storing, until one is dropped; from then on those that
    were there at the last drop come first, by their hits up to then and by recency.
    """
    facts, out = [], []  # facts: (arrival, bucket, what, query)

    def said(what, bucket, before=None):
        return [f for f in facts if f[1] == bucket and f[2] == what and (before is None or f[0] <= before)]

    def hits(query, bucket, before=None):
        return sum(f[3] == query for f in said("hit", bucket, before))

    def place(query, bucket):
        drops = said("dropped", bucket)
        if not drops or query > drops[-1][0]:
            return (1, query, 0)
        return (0, -hits(query, bucket, drops[-1][0]), -query)

    for now in range(len(x)):
        home = int(cluster[now])
        live = {f[3] for f in said("stored", home)} - {f[3] for f in said("dropped", home)}
        near = {q: float(np.round(x[q] @ x[now], 10)) for q in live}
        best = max(near.values(), default=-1.0)
        if live and best > -1.0 and best >= threshold:
            source = min((q for q in live if near[q] == best), key=lambda q: place(q, home))
            facts.append((now, home, "hit", source))
            out.append((now, True, source, best, None))
            continue
        facts.append((now, home, "stored", now))
        victim = None
        if len(live) == cap:
            victim = min(live | {now}, key=lambda q: (hits(q, home), q))
            facts.append((now, home, "dropped", victim))
        out.append((now, False, None, max(best, -1.0), victim))
    left = {}
    for home in {int(c) for c in cluster}:
        for q in {f[3] for f in said("stored", home)} - {f[3] for f in said("dropped", home)}:
            left[q] = hits(q, home)
    return out, left


def rows_of(log):
    rows = sorted(log.collect(), key=lambda r: r["query_id"])
    return [(r["query_id"], r["hit"], r["source_id"], r["similarity"], r["evicted_id"]) for r in rows]


def same(got, want):
    assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in want]
    np.testing.assert_allclose([g[3] for g in got], [w[3] for w in want], atol=2e-10)


@pytest.mark.parametrize("cap, threshold", [(500, 0.8), (3, 0.9), (1, 0.7)])
@pytest.mark.parametrize("batch", ["7", "10000"])
def test_replay_matches_simulation(spark, cap, threshold, batch):
    x = unit(700)
    x[300:500] = x[3]  # many copies of one query
    cluster = np.where(np.arange(700) % 3 == 0, 0, np.arange(700) % 4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        log = replay.replay(log_frame(spark, x, cluster), threshold, cap).checkpoint()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    want, left = simulate(x, cluster, threshold, cap)
    same(rows_of(log), want)
    assert {r["entry_id"]: r["hit_count"] for r in replay.surviving_entries(log).collect()} == left


def test_new_entry_is_evicted_when_all_others_have_hits(spark):
    e = np.eye(4)
    x = np.array([e[0], e[1], e[0], e[1], e[2], e[2]])
    got = rows_of(replay.replay(log_frame(spark, x, [0] * 6), 0.85, 2))
    assert [(g[1], g[2], g[4]) for g in got] == [
        (False, None, None), (False, None, None), (True, 0, None), (True, 1, None), (False, None, 4), (False, None, 5),
    ]


def test_zero_vector_is_stored_and_never_matches(spark):
    got = rows_of(replay.replay(log_frame(spark, np.zeros((2, 3)), [0, 0]), 0.85))
    assert [(g[1], g[3]) for g in got] == [(False, -1.0), (False, 0.0)]


def drain(df, out):
    query = (
        df.writeStream.format("parquet").option("path", str(out / "data")).option("checkpointLocation", str(out / "state"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


@pytest.mark.parametrize("piece_rows, cap", [(100, 5), (7, 3)])
def test_stream_equals_simulation_over_micro_batches(spark, tmp_path, piece_rows, cap):
    x, cluster = unit(120), np.arange(120) % 2
    source = tmp_path / "in"
    log = log_frame(spark, x, cluster)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        for parts in ((0, 1), (2, 3)):  # the second run goes on from the first one's checkpoint
            for part in parts:
                log.filter(F.floor(F.col("query_id") / 30) == part).coalesce(1).write.mode("append").parquet(str(source))
            stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(str(source))
            query = drain(reuse_stream.stream_replay(stream, 0.9, cap, piece_rows), tmp_path)
            assert len(query.recentProgress) >= 2
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    same(rows_of(spark.read.parquet(str(tmp_path / "data"))), simulate(x, cluster, 0.9, cap)[0])


def test_stream_of_text_ids(spark, tmp_path):
    x, cluster = unit(90), np.arange(90) % 2
    named = log_frame(spark, x, cluster).withColumn("query_id", F.format_string("turn:%03d", "query_id"))
    named = named.withColumn("arrival", F.timestamp_seconds(F.col("arrival") + 1_700_000_000))
    named.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(named.schema).parquet(str(tmp_path / "in"))
    drain(reuse_stream.stream_replay(stream, 0.9, 4, piece_rows=20), tmp_path)
    got = spark.read.parquet(str(tmp_path / "data"))
    want = replay.replay(named, 0.9, 4)
    names = ["query_id", "cluster", "hit", "source_id", "evicted_id"]
    assert got.schema == want.schema
    assert sorted(map(str, got.select(names).collect())) == sorted(map(str, want.select(names).collect()))


def lookup_rows(df):
    return {r["query_id"]: (r["hit"], r["matched_id"], r["matched_query"]) for r in df.collect()}


def test_lookup_edges(spark):
    e = np.eye(3)
    entries = entries_frame(spark, np.array([e[0], e[0], e[1], [0.6, 0.8, 0.0]]), [0, 0, 0, 1])
    asked = np.array([e[0], [0.0, 1.0, 0.0], e[0], e[2], np.zeros(3)])
    found = reuse.lookup(log_frame(spark, asked, [0, 1, 7, 0, 0]), entries, 0.8)
    assert lookup_rows(found) == {
        0: (True, 0, "q0"),      # two equal entries: the one stored first
        1: (True, 3, "q3"),      # similarity equal to the threshold
        2: (False, None, None),  # empty bucket
        3: (False, None, None),
        4: (False, None, None),
    }
    sims = {r["query_id"]: r["similarity"] for r in found.collect()}
    assert sims[2] == -1.0 and sims[4] == 0.0
    empty = reuse.lookup(log_frame(spark, asked, [0] * 5), entries.filter("false"), 0.8)
    assert not any(hit for hit, _, _ in lookup_rows(empty).values()) and empty.count() == 5


def test_lookup_in_parts_equals_lookup_at_once(spark, monkeypatch):
    x, cluster = unit(120), np.arange(120) % 3
    entries, asked = entries_frame(spark, x, cluster), log_frame(spark, unit(80, seed=4), np.arange(80) % 3)
    whole = reuse.lookup(asked, entries, 0.7).orderBy("query_id").select("query_id", "hit", "matched_id", "matched_query", "similarity").collect()
    monkeypatch.setattr(reuse, "ENTRY_BLOCK_BYTES", 1000)
    parts = reuse.lookup(asked, entries, 0.7).orderBy("query_id").select("query_id", "hit", "matched_id", "matched_query", "similarity").collect()
    assert whole == parts and any(r["hit"] for r in whole)


@pytest.mark.parametrize("exclude_self", [False, True])
def test_joined_lookup_of_a_hot_bucket(spark, monkeypatch, exclude_self):
    """Most rows in one bucket, many equal entries, a null and a foreign bucket: like one plain search."""
    x = np.repeat(unit(60), 3, axis=0)
    cluster = np.where(np.arange(180) % 10 == 0, 1, 0)
    entries, asked = entries_frame(spark, x, cluster), log_frame(spark, x[::-1].copy(), np.where(np.arange(180) % 30 == 0, 8, 0))
    asked = asked.withColumn("cluster", F.when(F.col("query_id") != 7, F.col("cluster")).cast("bigint")).withColumn("at", F.lit("kept"))
    monkeypatch.setattr(reuse, "ENTRY_BLOCK_BYTES", 700)
    monkeypatch.setattr(reuse, "_CELLS", 50)
    found = reuse.best_entries(asked, entries, exclude_self)
    assert not found.isStreaming
    places = {r["entry_id"]: r["position"] for r in entries.collect()}
    got = {r["query_id"]: (r["best_similarity"], r["best_position"], r["best_id"], r["at"]) for r in found.collect()}
    assert len(got) == 180
    for i, vector in enumerate(x[::-1]):
        here = [j for j in range(180) if cluster[j] == 0] if i % 30 and i != 7 else []
        sims = {j: float(np.round(x[j] @ vector, 10)) for j in here if not (exclude_self and j == i)}
        best = max(sims.values(), default=-1.0)
        source = min((j for j in sims if sims[j] == best), key=places.get, default=None)
        assert got[i][1:] == (places.get(source), source, "kept")
        assert abs(got[i][0] - best) < 2e-10


_LOOKED_UP = ("query_id", "cluster", "hit", "matched_id", "similarity")


@pytest.mark.parametrize("block", [64 << 20, 40])
def test_lookup_of_repeated_and_null_ids(spark, monkeypatch, block):
    monkeypatch.setattr(reuse, "ENTRY_BLOCK_BYTES", block)
    e = np.eye(3)
    entries = entries_frame(spark, np.array([e[0], e[1], e[2], e[0]]), [0, 0, 1, 0])
    rows = [(5, 0, e[0]), (5, 0, e[1]), (None, 1, e[2]), (None, 0, e[2]), (7, None, e[0]), (8, 9, e[0])]
    asked = spark.createDataFrame([(q, c, v.tolist()) for q, c, v in rows], "query_id long, cluster int, vector array<double>")
    got = [tuple(r) for r in reuse.lookup(asked, entries, 0.8).select(*_LOOKED_UP).collect()]
    want = [(5, 0, True, 0, 1.0), (5, 0, True, 1, 1.0), (None, 1, True, 2, 1.0), (None, 0, False, None, 0.0),
            (7, None, False, None, -1.0), (8, 9, False, None, -1.0)]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_lookup_with_text_ids(spark, monkeypatch):
    e = np.eye(3)
    monkeypatch.setattr(reuse, "ENTRY_BLOCK_BYTES", 40)
    entries = entries_frame(spark, e, [0, 0, 0]).withColumn("entry_id", F.concat(F.lit("q:"), "entry_id"))
    asked = log_frame(spark, e[:2], [0, 0]).withColumn("query_id", F.concat(F.lit("q:"), "query_id"))
    own = reuse.lookup(asked, entries, 0.8)
    assert {r["query_id"]: r["matched_id"] for r in own.collect()} == {"q:0": "q:0", "q:1": "q:1"}
    others = reuse.lookup(asked, entries, 0.8, exclude_self=True)
    assert not any(r["hit"] for r in others.collect())


@pytest.mark.parametrize("block", [64 << 20, 1000])
def test_stream_lookup_in_parts(spark, monkeypatch, tmp_path, block):
    x, cluster = unit(60), np.arange(60) % 3
    entries, asked = entries_frame(spark, x, cluster), log_frame(spark, unit(40, seed=4), np.arange(40) % 3)
    want = reuse.lookup(asked, entries, 0.7).orderBy("query_id").select(*_LOOKED_UP).collect()
    monkeypatch.setattr(reuse, "ENTRY_BLOCK_BYTES", block)
    asked.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(asked.schema).parquet(str(tmp_path / "in"))
    query = (
        reuse_stream.stream_lookup(stream, entries, 0.7).select(*_LOOKED_UP)
        .writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).orderBy("query_id").select(*_LOOKED_UP).collect() == want


def test_seeding_keeps_the_newest_and_their_order(spark):
    entries = entries_frame(spark, unit(10), [0] * 7 + [1] * 3, cap=4)
    got = sorted((r["cluster"], r["position"], r["entry_id"]) for r in entries.collect())
    assert got == [(0, 1, 6), (0, 2, 5), (0, 3, 4), (0, 4, 3), (1, 1, 7), (1, 2, 8), (1, 3, 9)]
    assert {r["cluster"]: r["n_entries"] for r in reuse.bucket_sizes(entries).collect()} == {0: 4, 1: 3}


def test_sweep_bands_and_nested_hits(spark):
    found = reuse.best_entries(log_frame(spark, unit(60, seed=1), [0] * 60), entries_frame(spark, unit(60), [0] * 60))
    rows = reuse.threshold_sweep(found).orderBy("theta").collect()
    assert [r["theta"] for r in rows] == [0.70, 0.75, 0.80, 0.85, 0.90, 0.95]
    assert [r["hits"] for r in rows] == sorted((r["hits"] for r in rows), reverse=True)
    assert [r["description"].split(":")[0] for r in rows] == [
        "aggressive", "aggressive", "liberal", "RECOMMENDED", "conservative", "strict",
    ]
    none = reuse.threshold_sweep(found.filter("false")).collect()
    assert {(r["hits"], r["hit_rate"], r["avg_similarity"]) for r in none} == {(0, 0.0, 0.0)}


def test_stats_flush_and_evaluation(spark):
    log = spark.createDataFrame([(True, True), (True, False), (False, False)], "hit boolean, expected_hit boolean")
    entries = entries_frame(spark, unit(5), [0] * 5)
    assert tuple(reuse.reuse_stats(log, entries).first()) == (5, 2, 1, 0.6667)
    gone = reuse.flush(entries)
    assert gone.schema == entries.schema
    assert tuple(reuse.reuse_stats(log.filter("false"), gone).first()) == (0, 0, 0, 0.0)
    counts = {(r["expected_hit"], r["hit"]): r["n"] for r in reuse.hit_evaluation(log).collect()}
    assert counts == {(True, True): 1, (False, True): 1, (False, False): 1}


def test_blank_queries(spark):
    df = spark.createDataFrame([("a",), ("  ",), ("",), (None,), ("\x1c \n",), (" . ",)], "query string")
    valid, rejected = reuse.split_blank(df)
    assert sorted(r[0] for r in valid.collect()) == [" . ", "a"] and rejected.count() == 4


def test_map_and_labels(spark):
    df = spark.createDataFrame([(3, [0.05, 0.3, 0.3, 0.15, 0.12345, 0.08])], "cluster int, membership array<double>")
    got = df.select(reuse.membership_map(F.col("membership")).alias("m")).first()["m"]
    assert list(got.items()) == [("1", 0.3), ("2", 0.3), ("3", 0.15), ("4", 0.1235), ("5", 0.08)]
    labels = spark.createDataFrame([(1, "one")], "cluster int, dominant_category string")
    assert reuse.with_cluster_label(df, labels).first()["cluster_label"] == "unknown"


def test_entry_schema_names():
    assert ENTRIES.fieldNames()[:2] == ["entry_id", "query"]


@pytest.mark.parametrize("cap", [2, 4, 100])
def test_replay_with_many_equal_similarities(spark, cap):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 2, (400, 7)).astype(float)
    x[:, 0] = 1.0
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    cluster = np.arange(400) % 2
    log = replay.replay(log_frame(spark, x, cluster), 0.8, cap).checkpoint()
    want, left = simulate(x, cluster, 0.8, cap)
    same(rows_of(log), want)
    assert {r["entry_id"]: r["hit_count"] for r in replay.surviving_entries(log).collect()} == left


def test_replay_of_text_ids(spark):
    x, cluster = unit(120), np.arange(120) % 2
    numbers = log_frame(spark, x, cluster)
    named = numbers.withColumn("query_id", F.concat(F.lit("turn:"), "query_id"))
    want = {f"turn:{r['query_id']}": (r["hit"], r["source_id"], r["evicted_id"]) for r in replay.replay(numbers, 0.9, 3).collect()}
    got = replay.replay(named, 0.9, 3)
    tag = lambda x: None if x is None else f"turn:{x}"
    assert {r["query_id"]: (r["hit"], r["source_id"], r["evicted_id"]) for r in got.collect()} == {
        q: (hit, tag(source), tag(evicted)) for q, (hit, source, evicted) in want.items()
    }
    assert replay.surviving_entries(got.checkpoint()).schema["entry_id"].dataType.simpleString() == "string"


def test_stream_lookup_reads_all_entries(spark, monkeypatch, tmp_path):
    """A bucket beyond any capacity, in one part and in many: each vector finds the first of its equals."""
    from quarrylight.plans import catalogue

    x = np.repeat(unit(620, d=8, groups=620), 2, axis=0)
    rows = [(i, [float(z) for z in v], 0 if i < 1100 else 1) for i, v in enumerate(x)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(str(tmp_path / "t"))
    (tmp_path / "sf").mkdir()
    next((tmp_path / "t").glob("*.parquet")).rename(tmp_path / "sf" / "embeddings.parquet")
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3).write.parquet(str(tmp_path / "sf3" / "embeddings.parquet"))
    for block, folder in ((64 << 20, "sf"), (10_000, "sf3")):  # one file, several files
        monkeypatch.setattr(reuse, "ENTRY_BLOCK_BYTES", block)
        found = {r["query_id"]: (r["hit"], r["matched_id"]) for r in catalogue.stream_lookup(spark, str(tmp_path / folder)).collect()}
        assert found == {i: (True, i // 2 * 2) for i in range(1240)}


def test_seeding_without_a_capacity(spark, monkeypatch):
    """Places are those of the arrivals in each bucket, also where a bucket is sorted by several tasks."""
    cluster = np.where(np.arange(300) % 7 == 0, 1, 0)
    df = entries_frame(spark, unit(300), cluster).drop("position", "hit_count").withColumn("arrival", -F.col("arrival"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = reuse.seed_entries(df, None)
        assert got.columns == reuse.seed_entries(df).columns
        got = {r["entry_id"]: (r["cluster"], r["position"], r["hit_count"]) for r in got.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = {}
    for c in (0, 1):
        mine = [i for i in range(299, -1, -1) if cluster[i] == c]
        want |= {i: (c, place + 1, 0) for place, i in enumerate(mine)}
    assert got == want
