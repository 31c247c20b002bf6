import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrylight.operators import cells, search

from test_search import brute, found, frame, unit


def clustered(n, d=12, groups=8, spread=0.06, seed=0):
    rng = np.random.default_rng(seed)
    centers = unit(groups, d, seed=seed + 1)
    x = centers[rng.integers(0, groups, n)] + spread * rng.standard_normal((n, d))
    return x / np.linalg.norm(x, axis=1, keepdims=True), centers


@pytest.mark.parametrize("block_bytes, parts", [(1 << 25, 1), (600, 5)])
def test_equal_to_brute_force_and_skips(spark, tmp_path, block_bytes, parts):
    x, centers = clustered(600)
    x[50:250] = x[0]  # a third of the rows are copies of one
    x[300] = 0.0
    q = np.vstack([x[[0, 300, 410, 599]], clustered(16, seed=7)[0]])
    table = cells.build_cells(frame(spark, x).repartition(parts), centers, str(tmp_path / "cells"))
    assert table.rows.sum() == 600
    hits, visits = cells.cell_topk(frame(spark, q, "query_id"), table, 7, block_bytes=block_bytes)
    got = found(hits)
    assert sorted(got) == list(range(len(q)))
    for i in range(len(q)):
        want = brute(q[i], x, list(range(600)), 7)
        assert [a for a, _ in got[i]] == [a for a, _ in want]
        assert [s for _, s in got[i]] == pytest.approx([s for _, s in want])
    read = visits.agg(F.sum("n_queries"), F.sum("pairs"), F.sum("compared"), F.count("*")).first()
    assert read[0] == len(q) and read[1] == 600 * len(q)
    assert read[2] < 0.5 * read[1]
    assert (read[3] > 1) == (block_bytes < 1000)


def test_bounds_hold(spark, tmp_path):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((200, 6)) * rng.random((200, 1))  # of any length
    centers = np.vstack([x[:5], np.zeros((1, 6)), 50.0 + np.zeros((1, 6))])  # one at zero, one without rows
    table = cells.build_cells(frame(spark, x), centers, str(tmp_path / "cells"))
    q = np.vstack([rng.standard_normal((20, 6)), np.zeros((1, 6))])
    bounds = table.bounds(q)
    of = {r["id"]: r["cell"] for r in table.read(spark).select("id", "cell").collect()}
    assert len(of) == 200
    for i, row in enumerate(x):
        assert (q @ row <= bounds[:, of[i]]).all()
    assert np.isneginf(bounds[:, 6]).all()


def test_k_beyond_table_empty_sides_and_payload(spark, tmp_path):
    x, centers = clustered(9)
    q = frame(spark, x[:2], "query_id", ids=["a", "b"])
    rows = frame(spark, x, ids=[f"doc_{i}" for i in range(9)]).withColumn("label", F.concat(F.lit("l"), "id"))
    table = cells.build_cells(rows, centers, str(tmp_path / "cells"))
    hits, _ = cells.cell_topk(q, table, 50, payload=["label"])
    assert hits.columns == ["query_id", "rank", "id", "similarity", "label"]
    assert hits.count() == 18 and hits.filter("label = concat('l', id)").count() == 18
    assert cells.cell_topk(q.filter("false"), table, 3)[0].count() == 0
    empty = cells.build_cells(rows.filter("false"), centers, str(tmp_path / "none"))
    assert cells.cell_topk(q, empty, 3)[0].count() == 0
    with pytest.raises(ValueError, match="cell"):
        cells.build_cells(rows.withColumn("cell", F.lit(1)), centers, str(tmp_path / "clash"))


def test_pruned_folders(spark, tmp_path):
    x, centers = clustered(300, spread=0.02)
    table = cells.build_cells(frame(spark, x), centers, str(tmp_path / "cells"))
    hits, visits = cells.cell_topk(frame(spark, x[:1], "query_id"), table, 3)
    plain = search.cosine_topk(frame(spark, x[:1], "query_id"), frame(spark, x), 3)
    assert found(hits) == found(plain)
    row = visits.first()
    assert row["cells_first"] == 1 and row["cells_second"] == 0
