import os
import random
from collections import Counter

import brute
import pytest
from quarrylight.llm import catalogue, packing, quality
from quarrylight.llm.common import staged
from test_texts import check_packing

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def plain_stages(rows, bench):
    """(rows after each of the first four stages); ``rows`` are (doc_id, text, lang, source) in order."""
    kept = brute.kept_by_quality([r[1:] for r in rows], quality.UNITS, quality.MIN_DOCS)
    good = [rows[i][:2] for i in kept]
    several = Counter(good)  # rows with equal id and text are one document, which stays as often
    gone = brute.removed_lines([t for _, t in several])
    lines = []
    for i, (doc_id, text) in enumerate(several):
        before, copies = text or "", several[doc_id, text]
        if i in gone:
            text = "\n".join(x for k, x in enumerate(before.split("\n")) if k not in set(gone[i]))
        if i not in gone or (brute.WORD.search(text) and len(text) >= corpus_pipeline.LEAST_LEFT * len(before)):
            lines += [(doc_id, text)] * copies
    label = brute.components([t or "" for _, t in lines], corpus_pipeline.PERCENT, corpus_pipeline.SHINGLE)
    one = [x for i, x in enumerate(lines) if label[i] == i]
    found = brute.windows(bench)
    clean = [x for x in one if not brute.contamination(x[1] or "", found)[1]]
    return good, lines, one, clean


@pytest.mark.skipif(not os.path.exists(SF), reason="needs the supplied tables")
def test_pipeline_against_plain_stages(spark):
    from tokenizers import Tokenizer

    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").select("doc_id", "text", "lang", "source").collect()]
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    good, _, _, left = plain_stages(rows, bench)
    got = corpus_pipeline.run(spark, SF).collect()
    assert 0 < len(left) < len(good) < len(rows)
    check_packing(got, left, Tokenizer.from_file(packing.vocabulary_path()), packing.LENGTH)


def test_stages_on_odd_rows(spark, documents, odd_texts, tmp_path):
    """Nulls, empty and long texts, ties, repeated rows, copies near and exact, more columns: every stage, then none."""
    rng = random.Random(3)
    words = lambda n: [f"{rng.choice('abcdefgh')}{rng.randrange(400)}" for _ in range(n)]
    pairs = list(odd_texts)
    for i in range(40):
        text = "\n".join(" ".join(words(15)) for _ in range(6))
        pairs.append((100 + i, text))
        if i % 4 == 0:  # one word in another place: not the same lines, the same document
            changed = text.replace("\n", " ", 3).split(" ")
            pairs += [(200 + i, " ".join(changed[:40] + ["new"] + changed[40:])), (None, text), (100 + i, text)]
    lines = [words(15) for _ in range(8)]
    pairs += [(300 + i, "\n".join(" ".join(x) for x in lines[:7] + [words(15)])) for i in range(3)]
    bench = [(1, " ".join(words(30)))]
    pairs.append((400, " ".join(words(60)) + " " + bench[0][1]))
    docs = documents(pairs)
    docs.write.parquet(f"{tmp_path}/a/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/a/benchmark.parquet")
    order = sorted(pairs, key=lambda r: (r[0] is None, r[0] or 0))
    want = plain_stages([(*r, "en", "s") for r in order], bench)
    frame = docs
    for (name, stage), rows in zip(corpus_pipeline.STAGES[:4], want):
        frame = staged(stage(spark, frame, f"{tmp_path}/a"), "stage")
        assert frame.columns == docs.columns
        got = Counter((r["doc_id"], r["text"]) for r in frame.collect())
        assert got == Counter(rows), name
    assert len(want[2]) < len(want[1]) < len(want[0])
    pieces = corpus_pipeline.STAGES[4][1](spark, frame, f"{tmp_path}/a")
    assert {r["doc_id"] for r in pieces.collect()} == {i for i, _ in want[3]}
    docs.limit(0).write.parquet(f"{tmp_path}/b/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/b/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/b").count() == 0


def test_every_operator_has_a_query():
    assert sorted(int(q.split("_")[0][2:]) for q in catalogue.QUERIES) == list(range(1, 14))
    assert set(catalogue.SQL) <= set(catalogue.QUERIES)
    assert len(corpus_pipeline.STAGES) == 5
