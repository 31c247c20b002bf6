"""Clusters, periodic runs and language-model scores against plain versions."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from quarrylight.llm import periodic_runs, simplex_clusters, suffix_tree_lm
from pyspark.sql import functions as F

# -- periodic runs ------------------------------------------------------------------


def plain_runs(words, least=12):
    """(start, length, period): every stretch with a period, then the smallest one of each."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        t = 0
        while t + q < n:
            if words[t] != words[t + q]:
                t += 1
                continue
            start = t
            while t + q < n and words[t] == words[t + q]:
                t += 1
            if t + q - start >= max(least, 2 * q):
                found.setdefault((start, t + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_report(doc_id, text):
    words = brute.WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, digest(listed), digest(left))


def sequences(rng, count):
    for _ in range(count):
        n, letters = rng.choice([0, 1, 5, 12, 30, 60, 150]), rng.choice([1, 2, 2, 3, 5, 50])
        words = [rng.randrange(letters) for _ in range(n)]
        if n > 4 and rng.random() < 0.7:
            a = rng.randrange(n)
            p = 1 + (n - a) // rng.randint(1, 9)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            if rng.random() < 0.5:
                words += words[: rng.randrange(n)]
        yield words


@pytest.mark.parametrize("least", [12, 13, 20])
def test_runs_of_random_sequences(least):
    rng = random.Random(least)
    for _ in range(60):
        docs = list(sequences(rng, rng.randint(1, 6)))
        ids = np.array([w for d in docs for w in d], np.int64)
        bounds = np.cumsum([0] + [len(d) for d in docs])
        got = list(zip(*[x.tolist() for x in periodic_runs.find_runs(ids, bounds, least)]))
        assert got == [(i, *r) for i, d in enumerate(docs) for r in plain_runs(d, least)]


def test_two_stretches_of_one_short_period():
    """Squares whose halves are periodic themselves, in different phases."""
    words = [int(c) for c in "0101010110101010" + "1001011" + "01010" * 2 + "2" + "0" * 40 + "1" + "0" * 40]
    got = periodic_runs.find_runs(np.array(words), np.array([0, len(words)]), 4)
    assert list(zip(*[x.tolist() for x in got[1:]])) == plain_runs(words, 4)


def test_range_successor():
    rng = np.random.default_rng(4)
    values = rng.integers(0, 100, 200)
    matrix = periodic_runs.WaveletMatrix(values, 100)
    low = rng.integers(0, 200, 500)
    high = np.maximum(low, rng.integers(0, 201, 500))
    least = rng.integers(0, 101, 500)
    want = [min((v for v in values[a:b].tolist() if v >= x), default=-1) for a, b, x in zip(low, high, least)]
    assert matrix.successor(low, high, least).tolist() == want


def test_run_report(spark, documents, odd_texts):
    rng = random.Random(5)
    pairs = odd_texts[:7] + [(i, t) for i, t in odd_texts[8:]]
    pairs = [(i, t) for i, t in pairs if t is None or len(t) < 10_000]
    pairs += [(100 + i, " ".join(f"w{x}" for x in words)) for i, words in enumerate(sequences(rng, 120))]
    docs = documents(pairs).repartition(3)
    got = periodic_runs.report(periodic_runs.echo(docs)).collect()
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted((plain_report(*p) for p in pairs), key=key)
    assert sum(r["n_runs"] > 0 for r in got) > 20


def test_runs_keep_columns_and_long_texts(spark, documents, odd_texts):
    pairs = [(i, t) for i, t in odd_texts] + [(50, "a b c\td " * 20), (51, "x " * 50_000)]
    docs = documents(pairs)
    got = periodic_runs.with_runs(docs)
    assert got.select("row.*").schema == docs.schema
    by_id = {r["row"]["doc_id"]: r for r in got.collect()}
    assert [tuple(r) for r in by_id[50]["runs"]] == [(0, 60, 3)] and by_id[50]["collapsed"] == "a b c d"
    assert [tuple(r) for r in by_id[51]["runs"]] == [(0, 50_000, 1)] and by_id[51]["collapsed"] == "x"
    assert by_id[2]["collapsed"] == "" and by_id[None]["runs"] == []
    assert periodic_runs.report(docs.limit(0)).count() == 0


# -- clusters -----------------------------------------------------------------------


def plain_clusters(rows, k=8, rounds=10):
    """(id, cluster, distance, cluster inertia, inertia, digest) with whole numbers of any size."""
    kept = [
        (i, [math.floor(1024 * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centers = [list(v) for _, v in order[:k]]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v: min((square(v, c), n) for n, c in enumerate(centers))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        for n, members in groups.items():
            centers[n] = [sum(column) // len(members) for column in zip(*members)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = Counter()
    for _, d, n in found:
        inertia[n] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return [(i, n, d, inertia[n], sum(inertia.values()), digest[n]) for i, d, n in found]


SCHEMA = "vec_id long, embedding array<float>, vector string, id string, cluster long, apex string"


def clustered(spark, rows):
    df = spark.createDataFrame([(i, v, "x", "y", 7, "z") for i, v in rows], SCHEMA).repartition(3)
    fitted = simplex_clusters.fit(simplex_clusters.scaled(df))
    return sorted(map(tuple, simplex_clusters.report(fitted).collect()), key=str), fitted


def vectors(rng, n, spread=0.3):
    means = rng.normal(size=(5, 64))
    return [(i, [float(np.float32(x)) for x in means[i % 5] + spread * rng.normal(size=64)]) for i in range(n)]


def test_clusters_against_whole_numbers(spark):
    rng = np.random.default_rng(1)
    rows = vectors(rng, 300)
    rows += [(i + 1000, rows[0][1]) for i in range(80)]  # one frequent vector
    rows += [(3, rows[4][1]), (None, rows[5][1]), (2000, None), (2001, []), (2002, [1.0] * 63), (2003, [1.0] * 65)]
    rows += [(2004, [float("nan")] + [0.0] * 63), (2005, [None] + [0.0] * 63), (2006, [math.inf] * 64), (2007, [0.0] * 64)]
    got, fitted = clustered(spark, rows)
    assert got == sorted(plain_clusters(rows), key=str)
    assert min(fitted.compared) < 0.2  # the bounds decide most assignments


def test_few_and_equal_vectors(spark):
    same = [(i, [0.5] * 64) for i in range(20)]
    got, _ = clustered(spark, same)
    assert got == sorted(plain_clusters(same), key=str)
    few = vectors(np.random.default_rng(2), 3)
    assert clustered(spark, few)[0] == sorted(plain_clusters(few), key=str)
    assert clustered(spark, [(1, None)])[0] == []


def test_bounds_hold():
    rng = np.random.default_rng(3)
    points = rng.integers(-2000, 2000, (200, 16))
    centers = np.concatenate([points[:3], rng.integers(-2000, 2000, (5, 16))])
    for pivots in (points[:1], points[:6], np.concatenate([points[:4], points[:4], points[:2] + 1])):
        simplex = simplex_clusters.Simplex.build(pivots)
        low, high = simplex_clusters._bounds(
            simplex.apices(simplex.distances(points)), simplex.apices(simplex.distances(centers))
        )
        true = ((points[:, None] - centers[None]) ** 2).sum(axis=2)
        assert (low <= true).all() and (true <= high).all()


# -- suffix tree ----------------------------------------------------------------------


def plain_scores(docs, depth, least, divergence, prior):
    """(n_tokens, n_known, train_tokens, base, score) of (text, held) rows, from the definition."""
    texts = [[*brute.WORD.findall(brute.lower(t)), None] for t, _ in docs]
    train = [t for t, (_, held) in zip(texts, docs) if not held]
    grams = Counter(tuple(t[i - k : i + 1]) for t in train for i in range(len(t)) for k in range(min(i, depth) + 1))
    words = {g[0]: c for g, c in grams.items() if len(g) == 1}
    n, v = sum(words.values()), len(words)
    following = defaultdict(list)
    for g in grams:
        following[g[:-1]].append(g[-1])
    occurred = {s: sum(grams[s + (w,)] for w in ws) for s, ws in following.items()}
    states: set = set()

    def chance(state, word):
        while state and state not in states:
            state = state[1:]
        if not state:
            return (words.get(word, 0) + 0.5) / (n + 0.5 * (v + 1))
        return (grams[state + (word,)] + prior * chance(state[1:], word)) / (occurred[state] + prior)

    for length in range(1, depth + 1):
        kept = set()
        for s in (s for s in following if len(s) == length and occurred[s] >= least):
            gain = 0
            for w in following[s]:
                c, shorter = grams[s + (w,)], chance(s[1:], w)
                gain += c * math.log((c - 1 + prior * shorter) / ((occurred[s] - 1 + prior) * shorter))
            if gain >= divergence * occurred[s]:
                kept.add(s)
        states |= kept
    out = []
    for t in texts:
        base = sum(math.log10((words.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        score = sum(math.log10(chance(tuple(t[max(0, i - depth) : i]), w)) for i, w in enumerate(t))
        out.append((len(t), sum(w in words for w in t), n, base, score))
    return out, states


def check_scores(spark, rows, settings, partitions=3):
    schema = "doc_id long, text string, held boolean, slice long, tokens string, answers string"
    df = spark.createDataFrame([(i, t, h, 1, "x", "y") for i, (t, h) in enumerate(rows)], schema)
    got = suffix_tree_lm.score(df.repartition(partitions), settings).orderBy("doc_id").collect()
    want, states = plain_scores(rows, settings.depth, settings.least, settings.divergence, settings.prior)
    assert [r["doc_id"] for r in got] == list(range(len(rows)))
    for r, w, (_, held) in zip(got, want, rows):
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, *w[:3])
        assert r["base_score"] == pytest.approx(w[3], abs=1e-6) and r["score"] == pytest.approx(w[4], abs=1e-6)
    return got, states


def prose(rng, count):
    """Texts in which some words choose the next one, with copies."""
    texts = []
    for _ in range(count):
        words = ["a"]
        for _ in range(rng.randint(0, 60)):
            words.append({"a": "b", "b": rng.choice("cd")}.get(words[-1], rng.choice("abcdefghij")))
        texts.append(" ".join(words).upper() if rng.random() < 0.2 else " \n".join(words))
    return texts + [texts[0]] * 15


@pytest.mark.parametrize("depth", [0, 1, 3])
def test_scores_from_the_definition(spark, depth):
    rng = random.Random(depth)
    rows = [(t, rng.random() < 0.25) for t in prose(rng, 80)]
    rows += [(None, False), ("", True), ("\t ", False), ("unseen Ä words", True)]
    got, states = check_scores(spark, rows, suffix_tree_lm.Settings(depth, 5, 0.05, 8.0))
    assert {len(s) for s in states} == set(range(1, depth + 1))
    if depth:
        held = [r for r in got if r["held_out"] and r["n_tokens"] > 20]
        assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_slices_do_not_matter(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(t, i % 4 == 0) for i, t in enumerate(prose(rng, 60))]
    settings = suffix_tree_lm.Settings(2, 4, 0.02, 8.0)
    one, _ = check_scores(spark, rows, settings, 1)
    many, _ = check_scores(spark, rows, settings, 7)
    assert one == many


def test_nothing_to_learn_from(spark):
    rows = [("x y", True), (None, True)]
    check_scores(spark, rows, suffix_tree_lm.Settings())
    empty = spark.createDataFrame([], "doc_id string, text string, held boolean")
    assert suffix_tree_lm.score(empty).count() == 0


def test_held_out_documents_gain(spark, tmp_path):
    """On the supplied documents the tree beats the single words where it has not learned."""
    found = suffix_tree_lm.query(spark, "/root/testdata/sf0.01")
    row = found.filter("held_out").agg(F.sum("base_score").alias("base"), F.sum("score").alias("score"), F.sum("n_tokens").alias("n")).first()
    assert row["score"] > row["base"] + 0.05 * row["n"]
    checksums = found.select((F.crc32(F.col("doc_id").cast("string")) % 5 == 1).alias("c"), "held_out").distinct().collect()
    assert sorted(map(tuple, checksums)) == [(False, False), (True, True)]


def test_packing_tokenizes_small_slices():
    """A task tokenizes a few MB at a time, whatever the size of its batches."""
    import pyarrow as pa

    from quarrylight.llm import packing

    texts = ["some words of a text " * 50_000] * 9  # 1 MB each
    batch = pa.RecordBatch.from_arrays([pa.array(range(9), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    found = list(packing._pieces(packing.vocabulary_path(), 4096)(iter([batch])))
    assert len(found) >= 3 and max(len(set(b.column("doc_id").to_pylist())) for b in found) <= 3
    assert sorted({x for b in found for x in b.column("doc_id").to_pylist()}) == list(range(9))
