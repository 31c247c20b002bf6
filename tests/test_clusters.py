import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrylight.operators import diagnostics, fuzzy, kmeans
from quarrylight.plans import sweeps


def blobs(n=120, k=4, d=5, seed=0):
    rng = np.random.default_rng(seed)
    middle = rng.standard_normal((k, d)) * 6
    label = np.arange(n) % k
    return middle[label] + rng.standard_normal((n, d)), label


@pytest.fixture(scope="module")
def data(spark):
    x, label = blobs()
    rows = [(i, [float(z) for z in v], f"cat.{label[i]}") for i, v in enumerate(x)]
    return x, spark.createDataFrame(rows, "id long, vector array<double>, label string").repartition(5).persist()


def u_of(x, v, m, query=False):
    d = np.maximum(np.sqrt(((x[:, None] - v[None]) ** 2).sum(-1)), 1e-12)
    p = d ** (2 / (m - 1))
    s = (1 / p).sum(1, keepdims=True)
    return 1 / (p * s + 1e-10) if query else (1 / p) / (s + 1e-10)


def matrix(df, column="membership"):
    return np.array([r[column] for r in df.orderBy("id").collect()])


@pytest.mark.parametrize("m, query", [(2.0, False), (2.0, True), (1.5, False), (3.0, True)])
def test_memberships(data, m, query):
    x, df = data
    got = matrix(fuzzy.memberships(df, x[:4], m, query_epsilon=query))
    np.testing.assert_allclose(got, u_of(x, x[:4], m, query), rtol=1e-9, atol=1e-12)


def test_memberships_near_one(data):
    x, df = data
    got = matrix(fuzzy.memberships(df, x[:4], 1.02))
    assert np.isfinite(got).all()
    # Close to a centre a row is its own; far from all of them the epsilon takes over.
    np.testing.assert_allclose(got[:4], np.eye(4), atol=1e-9)
    assert (got.sum(axis=1) <= 1.0 + 1e-9).all() and got.sum(axis=1).min() < 1e-6


def test_point_on_centre(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0])], "id long, vector array<double>")
    got = matrix(fuzzy.memberships(df, np.array([[1.0, 0.0], [5.0, 5.0]])))
    np.testing.assert_allclose(got, [[1.0, 0.0]], atol=1e-9)
    with pytest.raises(ValueError):
        fuzzy.membership_rows(np.ones((1, 2)), 1.0)


def reference_fit(x, v, m, steps):
    objectives, deltas, u = [], [], u_of(x, v, m)
    for _ in range(steps):
        um = u**m
        v = um.T @ x / (um.sum(0)[:, None] + 1e-10)
        nxt = u_of(x, v, m)
        objectives.append((nxt**m * ((x[:, None] - v[None]) ** 2).sum(-1)).sum())
        deltas.append(np.abs(nxt - u).max())
        u = nxt
    return v, objectives, deltas


def test_fit_follows_the_update_rules(data):
    x, df = data
    model = fuzzy.fit(df, x[:4], 4, 2.0, max_iter=4, tol=0.0)
    v, objectives, deltas = reference_fit(x, x[:4], 2.0, 4)
    np.testing.assert_allclose(model.centers, v, rtol=1e-9)
    np.testing.assert_allclose(model.objective_trace, objectives, rtol=1e-9)
    np.testing.assert_allclose(model.delta_trace, deltas, rtol=1e-7)
    assert model.n_iter == 4


def test_fit_converges_and_objective_falls(data):
    x, df = data
    model = fuzzy.fit(df, None, 4, 2.0, max_iter=100, tol=1e-4)
    trace = np.array(model.objective_trace)
    assert model.n_iter < 100 and model.delta_trace[-1] < 1e-4
    assert (np.diff(trace) <= 1e-6 * trace[:-1]).all()
    with pytest.raises(ValueError):
        fuzzy.fit(df, x[:3], 4)


def test_stopped_fit_goes_on(data, tmp_path, monkeypatch):
    x, df = data
    starts, log = [(x[:4], 2.0), (x[:3], 1.5)], str(tmp_path / "fit")
    whole = fuzzy.fit_many(df, starts, 30, 1e-2)
    fuzzy.fit_many(df, starts, 2, 1e-2, log)
    # The third iteration is lost half-way through.
    (tmp_path / "fit" / "000003").mkdir()
    scans = []
    counted = fuzzy.steps
    monkeypatch.setattr(fuzzy, "steps", lambda *a: scans.append(1) or counted(*a))
    resumed = fuzzy.fit_many(df, starts, 30, 1e-2, log)
    assert len(scans) == max(m.n_iter for m in whole) - 2
    for a, b in zip(whole, resumed):
        assert a.n_iter == b.n_iter
        np.testing.assert_allclose(a.centers, b.centers, rtol=1e-9)
        np.testing.assert_allclose(a.objective_trace, b.objective_trace, rtol=1e-9)
        np.testing.assert_allclose(a.delta_trace, b.delta_trace, rtol=1e-6)
    scans.clear()
    again = fuzzy.fit_many(df, starts, 30, 1e-2, log)
    cut = fuzzy.fit_many(df, starts, 1, 1e-2, log)
    assert not scans
    assert [m.objective_trace for m in again] == [m.objective_trace for m in resumed]
    assert [m.objective_trace for m in cut] == [m.objective_trace[:1] for m in resumed]
    for other in ([(x[4:8], 2.0), (x[:3], 1.5)], starts[:1], [(x[:4], 2.0), (x[:3], 1.6)]):
        with pytest.raises(ValueError, match="log"):
            fuzzy.fit_many(df, other, 30, 1e-2, log)


def test_side_by_side_fits_equal_single_ones(data):
    x, df = data
    together = fuzzy.fit_many(df, [(x[:4], 2.0), (x[:3], 1.5)], 30, 1e-2)
    alone = [fuzzy.fit_many(df, [s], 30, 1e-2)[0] for s in ((x[:4], 2.0), (x[:3], 1.5))]
    for a, b in zip(together, alone):
        assert a.n_iter == b.n_iter
        np.testing.assert_allclose(a.centers, b.centers, rtol=1e-9)


def test_seeding_does_not_depend_on_partitions(data):
    _, df = data
    a = fuzzy.distance_seeding(df, 5)
    b = fuzzy.distance_seeding(df.repartition(2), 5)
    np.testing.assert_array_equal(a, b)
    assert len(np.unique(a, axis=0)) == 5


def test_seeding_needs_distinct_rows(spark):
    df = spark.createDataFrame([(i, [1.0]) for i in range(5)], "id long, vector array<double>")
    with pytest.raises(ValueError, match="distinct"):
        fuzzy.distance_seeding(df, 2)


def test_kmeans_restarts_are_sorted(data):
    _, df = data
    fits = kmeans.kmeans_restarts(df, 4, restarts=2, max_iter=10)
    assert [f.inertia for f in fits] == sorted(f.inertia for f in fits) and fits[0].centers.shape == (4, 5)


def plain_lloyd(x, centers, most, tol):
    for n in range(1, most + 1):
        own = ((x[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        moved = np.array([x[own == c].mean(axis=0) if (own == c).any() else centers[c] for c in range(len(centers))])
        shift = np.sqrt(((moved - centers) ** 2).sum(axis=1)).max()
        centers = moved
        if shift <= tol:
            break
    return centers, ((x[:, None] - centers[None]) ** 2).sum(axis=2).min(axis=1).sum(), n


def test_lloyd_side_by_side_equals_one_by_one(data):
    x, df = data
    far = np.full((1, x.shape[1]), 1e3)  # a centre that never gets a row
    starts = [x[:4], x[10:13], np.concatenate([x[:2], far])]
    for most in (1, 3, 100):
        for (centers, inertia, n), start in zip(kmeans.lloyd(df, starts, most, 1e-4), starts):
            want = plain_lloyd(x, start, most, 1e-4)
            np.testing.assert_allclose(centers, want[0], atol=1e-9)
            assert n == want[2] and abs(inertia - want[1]) < 1e-6 * want[1]


def test_lloyd_scans_are_shared(data, monkeypatch):
    _, df = data
    asked = []
    sums = kmeans.lloyd_sums
    monkeypatch.setattr(kmeans, "lloyd_sums", lambda d, c: asked.append(len(c)) or sums(d, c))
    fits = kmeans.kmeans_restarts(df, 4, restarts=3, max_iter=50)
    assert len(asked) == max(f.n_iter for f in fits) + 1 and asked[0] == 3
    again = kmeans.kmeans_restarts(df.repartition(3), 4, restarts=3, max_iter=50)
    assert [f.seed for f in fits] == [f.seed for f in again]
    np.testing.assert_allclose(fits[0].centers, again[0].centers, atol=1e-9)


def test_seeds_are_distinct_rows(spark, data):
    x, df = data
    for centers in kmeans.seed_many(df, 5, [1, 2]):
        assert len(np.unique(centers, axis=0)) == 5
        assert all((np.abs(x - c).max(axis=1) < 1e-12).any() for c in centers)
    few = spark.createDataFrame([(i, [float(i % 2)]) for i in range(6)], "id long, vector array<double>")
    assert [len(c) for c in kmeans.seed_many(few, 4, [1, 2])] == [2, 2]
    with pytest.raises(ValueError, match="no vectors"):
        kmeans.kmeans_restarts(few.filter("false"), 2)


def test_row_sample_cut_equals_plain_sort(spark):
    df = spark.range(20_000)
    plain = df.orderBy(F.md5(F.concat(F.lit("42:"), F.col("id").cast("string"))), "id").limit(50)
    assert sorted(diagnostics.row_sample(df, 50).collect()) == sorted(plain.collect())
    assert diagnostics.row_sample(spark.range(7), 50).count() == 7


def brute_silhouette(x, c):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    out = []
    for i in range(len(x)):
        own = c == c[i]
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, c == o].mean() for o in set(c) - {c[i]})
        out.append((b - a) / max(a, b))
    return np.mean(out)


def test_silhouette(spark, data):
    x, df = data
    c = np.arange(len(x)) % 3
    c[0] = 9  # a cluster of one
    labelled = df.join(spark.createDataFrame([(i, int(v)) for i, v in enumerate(c)], "id long, cluster int"), "id")
    got = diagnostics.silhouette(labelled).first()
    assert got["n"] == len(x) and got["silhouette"] == pytest.approx(brute_silhouette(x, c))
    blocks = diagnostics.silhouette(labelled, block_bytes=500).first()
    assert blocks["n"] == len(x) and blocks["silhouette"] == pytest.approx(got["silhouette"])
    one = diagnostics.silhouette(labelled.withColumn("cluster", F.lit(1))).first()
    assert one["silhouette"] == 0.0


def test_certainty_with_one_cluster(spark):
    df = spark.createDataFrame([(0, [1.0])], "id long, membership array<double>")
    row = diagnostics.certainty_metrics(df).first()
    assert row["mean_certainty"] == 1.0 and row["frac_dual_membership"] == 0.0


def test_profiles(spark):
    rows = [(0, "b.x", [0.9, 0.1, 0.0]), (1, "a.y", [0.8, 0.2, 0.0]), (2, "a.y", [0.3, 0.7, 0.0]), (3, "b.x", [0.4, 0.6, 0.0]),
            (4, "c.z", [0.5, 0.5, 0.0])]
    df = diagnostics.hard_assignment(spark.createDataFrame(rows, "id long, label string, membership array<double>"))
    assert {r["id"]: r["cluster"] for r in df.collect()}[4] == 0  # lowest on ties
    summary = {r["cluster"]: tuple(r)[1:] for r in diagnostics.hard_summary(df, 3).collect()}
    assert summary == {0: (3, "b.x", 0.333), 1: (2, "a.y", 0.5), 2: (0, "unknown", 0.0)}
    soft = [(r["cluster"], r["category"], r["weight"]) for r in diagnostics.soft_profile(df, 3, 1).orderBy("cluster").collect()]
    assert soft == [(0, "b.x", 1.3), (1, "a.y", 0.9), (2, "b.x", 0.0)]
    report = diagnostics.cluster_report(df, 3).orderBy("place").collect()
    assert [r["cluster"] for r in report] == [0, 1, 2] and report[0]["dominant"] == "x"
    labels = {r["cluster"]: r for r in diagnostics.cluster_labels(df, 3).collect()}
    assert labels[0]["hard_cat_dist"] == {"b.x": 1, "a.y": 1, "c.z": 1} and labels[2]["hard_cat_dist"] is None
    edge = diagnostics.boundary_documents(df, 2).collect()
    assert [(r["id"], r["certainty"]) for r in edge] == [(4, 0.5), (3, 0.6)]
    assert [t["cluster"] for t in edge[0]["top3"]] == [0, 1, 2]


def test_sweep_keeps_a_row_for_each_k(spark):
    rows = [(i, [float(i % 3), float(i % 3) ** 2]) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, vector array<double>")
    got = sweeps.k_sweep(df, (2, 5), restarts=1, max_iter=3).orderBy("k").collect()
    assert [r["k"] for r in got] == [2, 5] and got[0]["note"] is None
    assert got[1]["objective"] is None and got[1]["silhouette"] is None and "distinct" in got[1]["note"]


def test_memberships_of_low_fuzziness_keep_the_epsilon():
    gaps = np.array([[1.5, 2.0, 9.0], [1e-13, 1.0, 2.0], [300.0, 400.0, 500.0]])
    for m in (1.05, 1.19, 1.2, 2.0):
        power = 2.0 / (m - 1.0)
        d = np.maximum(gaps, fuzzy.MIN_DISTANCE).astype(np.longdouble)
        w = d**-power
        fitted = w / (w.sum(axis=1, keepdims=True) + np.longdouble(fuzzy.EPSILON))
        asked = 1 / (d**power * w.sum(axis=1, keepdims=True) + np.longdouble(fuzzy.EPSILON))
        np.testing.assert_allclose(fuzzy.membership_rows(gaps, m), fitted.astype(float), rtol=1e-9, atol=1e-300)
        np.testing.assert_allclose(fuzzy.membership_rows(gaps, m, query_epsilon=True), asked.astype(float), rtol=1e-9, atol=1e-300)


def test_sweeps(data):
    x, df = data
    k = sweeps.k_sweep(df, (2, 4), restarts=1, max_iter=20).orderBy("k").collect()
    assert k[0]["improvement_pct"] is None
    assert k[1]["improvement_pct"] == pytest.approx((k[0]["objective"] - k[1]["objective"]) / k[0]["objective"] * 100, abs=0.01)
    assert k[1]["silhouette"] > k[0]["silhouette"]
    m = sweeps.fuzziness_sweep(df, x[:4], max_iter=10).orderBy("m").collect()
    assert [r["m"] for r in m] == [1.2, 1.5, 2.0, 2.5, 3.0]
    assert [r["mean_certainty"] for r in m] == sorted((r["mean_certainty"] for r in m), reverse=True)
    assert m[2]["interpretation"].startswith("STANDARD")


def test_tile_memory_is_bounded():
    """Many short rows under many clusters: beside points and sums, a tile holds a few MB."""
    import tracemalloc

    import pyarrow as pa

    n, ks = 12_000, (8, 10, 12, 15, 18, 20)
    rng = np.random.default_rng(2)
    points, labels = rng.standard_normal((2 * n, 2)), np.stack([np.arange(2 * n) % k for k in ks], axis=1).astype(np.int32)
    lists = lambda x: pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))
    pairs = pa.table({
        "row": np.arange(2 * n), "low": np.zeros(2 * n, np.int32), "high": np.ones(2 * n, np.int32),
        "block": (np.arange(2 * n) >= n).astype(np.int32), "vector": lists(points), "labels": lists(labels),
    })
    known = diagnostics._Labellings(tuple(np.arange(k) for k in ks), tuple(np.full(k, 2.0 * n / k) for k in ks))
    tracemalloc.start()
    out = diagnostics._tile(known, pairs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 75e6
    first = np.array(out.column("sums")[0].as_py())
    gaps = np.sqrt(((points[0] - points[n:]) ** 2).sum(axis=1))
    want = np.concatenate([np.bincount(labels[n:, j], gaps, minlength=k) for j, k in enumerate(ks)])
    np.testing.assert_allclose(first, want)
