import pytest
from pyspark.sql import functions as F

from quarrylight.functions import text
from quarrylight.operators import tfidf
from quarrylight.sources import corpus

CASES = [
    ("From: a@b.co\r\nhello\r\n> quoted\r\nworld", "hello world"),
    ("x > not a line start in python\nfoo", "x not a line start in python foo"),
    ("subject: lower\n From: indented kept\nok", "from indented kept ok"),
    ("mail me@x.org now", "mail now"),
    ("see www.a.b/c,d and HTTP://UP.case http://x.y", "see and http up case"),
    ("a b　c", "a b c"),
    ("\n>a\n>b\nc", "c"),
    ("line\x1cfs@x.y z", "line z"),
    ("a@b c@d.e f", "a b f"),
    ("@x.y keeps", "x y keeps"),
    ("ab@@c.d.e@ z", "z"),
    (">", ""),
    ("", ""),
    (None, ""),
]


def test_clean_document(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, t string")
    got = {r["i"]: r["c"] for r in df.select("i", text.clean_document(F.col("t")).alias("c")).collect()}
    assert got == {i: c for i, (_, c) in enumerate(CASES)}


def test_clean_query_keeps_headers_and_links(spark):
    df = spark.createDataFrame([("From: Me@x.org\n> see www.a.b 42",), (None,)], "query string")
    got = [r["cleaned"] for r in corpus.clean_queries(df).collect()]
    assert got == ["from me x org see www a b", ""]
    assert corpus.clean_queries(df, full=True).first()["cleaned"] == ""


@pytest.mark.parametrize("length, kept", [(30, False), (31, True)])
def test_placeholder(spark, length, kept):
    df = spark.createDataFrame([(1, "a" * length)], "doc_id long, text string")
    got = corpus.clean_corpus(df).first()["cleaned"]
    assert got == ("a" * length if kept else "unknown topic")


def test_very_long_token(spark):
    df = spark.createDataFrame([("x" * 400_000 + " tail",)], "t string")
    assert df.select(F.length(text.clean_document(F.col("t"))).alias("n")).first()["n"] == 400_005


def test_terms_bridge_removed_words(spark):
    df = spark.createDataFrame([(1, "rocket of the moon rocket moon ab"), (2, ""), (3, "solo")], "doc_id long, cleaned string")
    rows = tfidf.postings(tfidf.count_terms(df)).collect()
    got = {(r["doc_id"], r["term"]): r["tf"] for r in rows}
    assert got == {
        (1, "rocket"): 2, (1, "moon"): 2, (1, "rocket moon"): 2, (1, "moon rocket"): 1, (3, "solo"): 1,
    }


def test_own_stop_words(spark):
    df = spark.createDataFrame([(1, "the rocket")], "doc_id long, cleaned string")
    terms = lambda words: sorted(t["term"] for t in tfidf.count_terms(df, stop_words=words).first()["terms"])
    assert terms([]) == ["rocket", "the", "the rocket"]
    assert terms(["rocket"]) == ["the"]


def test_parallel_arrays_and_json_lines(spark, tmp_path):
    whole = tmp_path / "corpus.json"
    whole.write_text('{"documents": ["one", "two"],\n "labels": ["a", "b"], "category_indices": [0, 1],'
                     ' "category_names": ["a", "b"], "n_docs": 2, "description": "d"}')
    rows = corpus.read_parallel_arrays(spark, str(whole)).orderBy("doc_id").collect()
    assert [tuple(r) for r in rows] == [(0, "one", "a"), (1, "two", "b")]
    (tmp_path / "corpus2.json").write_text('{"documents": ["three"], "labels": ["c"]}')
    (tmp_path / "corpus3.json").write_text('{"documents": [], "labels": []}')
    (tmp_path / "corpus4.json").write_text('{"documents": ["four", "five"], "labels": ["d", "e"]}')
    rows = corpus.read_parallel_arrays(spark, str(tmp_path / "corpus*.json")).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(5))
    by_id = {r["doc_id"]: r["text"] for r in rows}
    order = [by_id[i] for i in range(5)]
    assert order.index("two") == order.index("one") + 1 and order.index("five") == order.index("four") + 1
    lines = tmp_path / "lines.json"
    lines.write_text('{"doc_id": 7, "text": "x", "label": "l"}\n')
    assert [tuple(r) for r in corpus.read_json_lines(spark, str(lines)).collect()] == [(7, "x", "l")]
