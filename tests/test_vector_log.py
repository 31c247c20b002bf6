import pytest
from pyspark.sql import functions as F

from quarrylight.session import is_complete
from quarrylight.sources import vector_log


def rows(spark, *pairs):
    """(id, number) as rows whose vector and tag name the number."""
    return spark.createDataFrame([(i, [float(n)], f"t{n}") for i, n in pairs], "id string, vector array<float>, tag string").coalesce(1)


def state(df):
    return {r["id"]: (r["vector"], r["tag"]) for r in df.collect()}


def test_last_batch_wins_and_repeats_change_nothing(spark, tmp_path):
    path = str(tmp_path / "log")
    assert vector_log.append(path, rows(spark, ("a", 1), ("b", 2), ("a", 3)), 0)
    assert vector_log.append(path, rows(spark, ("c", 9)), 7)
    assert vector_log.append(path, rows(spark, ("b", 4), ("c", 5)), 2)  # out of order
    assert not vector_log.append(path, rows(spark, ("a", 99)), 2)
    want = {"a": ([3.0], "t3"), "b": ([4.0], "t4"), "c": ([9.0], "t9")}
    assert state(vector_log.latest(spark, path)) == want
    got = vector_log.summary(spark, path).first()
    assert tuple(got) == (3, 6, 3, 3)

    wanted = spark.createDataFrame([(0, "b"), (1, "zz"), (2, "a"), (3, "b")], "position int, id string")
    found = {r["position"]: r["tag"] for r in vector_log.get(spark, path, wanted).collect()}
    assert found == {0: "t4", 2: "t3", 3: "t4"}


def test_compaction_keeps_the_table(spark, tmp_path):
    path = str(tmp_path / "log")
    for batch in range(4):
        vector_log.append(path, rows(spark, ("a", batch), (f"only{batch}", 10 + batch)), batch)
    before = state(vector_log.latest(spark, path))
    assert vector_log.compact(spark, path) and not vector_log.compact(spark, path)
    assert state(vector_log.latest(spark, path)) == before
    assert tuple(vector_log.summary(spark, path).first()) == (0, 5, 5, 0)
    assert not vector_log.append(path, rows(spark, ("a", 77)), 1)  # behind the base
    assert vector_log.append(path, rows(spark, ("a", 50)), 4)
    assert vector_log.vacuum(spark, path) == 4
    assert state(vector_log.latest(spark, path)) == before | {"a": ([50.0], "t50")}
    assert vector_log.compact(spark, path) and vector_log.vacuum(spark, path) == 2
    assert state(vector_log.latest(spark, path)) == before | {"a": ([50.0], "t50")}


def test_unfinished_folders_do_not_count(spark, tmp_path):
    path = str(tmp_path / "log")
    vector_log.append(path, rows(spark, ("a", 1)), 0)
    half = tmp_path / "log" / "batches" / ("0" * 17 + "1")
    rows(spark, ("a", 2)).write.parquet(str(half))
    (half / "_SUCCESS").unlink()
    assert not is_complete(spark, str(half))
    assert state(vector_log.latest(spark, path)) == {"a": ([1.0], "t1")}
    assert vector_log.append(path, rows(spark, ("a", 3)), 1)
    assert state(vector_log.latest(spark, path)) == {"a": ([3.0], "t3")}


def test_columns_empty_batches_and_refusals(spark, tmp_path):
    path = str(tmp_path / "log")
    with pytest.raises(FileNotFoundError):
        vector_log.read(spark, path)
    assert not vector_log.compact(spark, path) and vector_log.vacuum(spark, path) == 0
    assert vector_log.append(path, rows(spark).select("id", "vector"), 0)
    assert vector_log.latest(spark, path).count() == 0
    assert vector_log.append(path, rows(spark, ("a", 1)).drop("tag"), 1)
    assert vector_log.append(path, rows(spark, ("b", 2)).withColumn("more", F.lit(5)), 2)
    got = {r["id"]: (r["tag"], r["more"]) for r in vector_log.latest(spark, path).collect()}
    assert got == {"a": (None, None), "b": ("t2", 5)}
    for bad in (rows(spark).drop("vector"), rows(spark).withColumn("batch", F.lit(1))):
        with pytest.raises(ValueError):
            vector_log.append(path, bad, 3)
    with pytest.raises(ValueError):
        vector_log.append(path, rows(spark), -1)
    with pytest.raises(Exception, match="null"):
        vector_log.append(path, rows(spark, ("a", 1)).withColumn("id", F.lit(None).cast("string")), 3)
    assert vector_log.latest(spark, path).count() == 2
