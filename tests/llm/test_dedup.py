import random
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from quarrylight.llm import graph, jaccard_join, line_dedup, repeated_bytes


def _places(pairs):
    """Indices in the order of documents: by id, null last; equal rows are one document."""
    return sorted(range(len(pairs)), key=lambda i: (pairs[i][0] is None, pairs[i][0] or 0))


def _edited(rng, words):
    words = list(words)
    kind = rng.randrange(4)
    at = rng.randrange(len(words))
    if kind == 0:
        words[at] = f"n{rng.randrange(1000)}"
    elif kind == 1:
        del words[at]
    elif kind == 2:
        words.insert(at, words[at])
    return words


def test_lines_against_all_pairs(documents, odd_texts):
    rng = random.Random(5)
    base = [[f"w{rng.randrange(50)}" for _ in range(rng.randrange(8, 30))] for _ in range(12)]
    pairs = [p for p in odd_texts if p[0] not in (None, 4)]
    for i in range(80):
        lines = [" ".join(_edited(rng, rng.choice(base))) if rng.random() < 0.8 else "" for _ in range(4)]
        pairs.append((100 + i, "\n".join(lines)))
    docs = documents(pairs)
    order = _places(pairs)
    gone = brute.removed_lines([pairs[i][1] for i in order])
    want = {pairs[order[i]][0]: ",".join(map(str, k)) for i, k in gone.items()}
    got = line_dedup.report(docs).collect()
    assert {r["doc_id"]: r["removed_lines"] for r in got if r["removed_lines"]} == want
    assert len(got) == len(pairs)

    left = line_dedup.remove_lines(docs)
    assert left.columns == docs.columns
    texts = {}
    for i, text in pairs:
        out = {int(x) for x in want[i].split(",")} if i in want else set()
        kept = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in out) if out else text
        if not out or brute.WORD.search(kept):
            texts[i] = kept
    assert {r["doc_id"]: r["text"] for r in left.collect()} == texts
    assert all(r["n_chars"] == len(r["text"]) for r in left.collect() if r["text"] is not None)


def test_repeated_rows_keep_their_lines(documents):
    line = "one two three four five six seven eight nine ten"
    docs = documents([(1, line), (1, line), (None, line), (2, line + "\n \nother")])
    got = Counter((r["doc_id"], r["removed_lines"]) for r in line_dedup.report(docs).collect())
    assert got == Counter({(1, ""): 2, (None, "0"): 1, (2, "0"): 1})


@pytest.fixture(scope="module")
def near(odd_texts):
    rng = random.Random(6)
    pairs = list(odd_texts)
    base = [[f"w{rng.randrange(40)}" for _ in range(rng.randrange(4, 90))] for _ in range(15)]
    passage = [f"p{i}" for i in range(20)]
    for i in range(150):
        words = rng.choice(base)
        for _ in range(rng.randrange(3)):
            words = _edited(rng, words)
        if rng.random() < 0.3:
            words = words + passage + [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(80))]
        pairs.append((200 + i, " ".join(w.upper() if rng.random() < 0.1 else w for w in words)))
    return pairs


def _expected(pairs):
    order = _places(pairs)
    label = brute.components([pairs[i][1] for i in order])
    return Counter(
        (pairs[i][0], len(brute.shingles(pairs[i][1])), pairs[order[label[at]]][0]) for at, i in enumerate(order)
    )


def test_jaccard_against_all_pairs(documents, near):
    got = jaccard_join.join(documents(near)).drop("hash").collect()
    assert Counter(tuple(r) for r in got) == _expected(near)


def test_jaccard_in_blocks_and_with_frequent_shingles(documents, near, monkeypatch):
    monkeypatch.setattr(jaccard_join, "ROWS", 6)
    monkeypatch.setattr(jaccard_join, "SHINGLES", 150)
    monkeypatch.setattr(jaccard_join, "FREQUENT", 30)
    got = jaccard_join.join(documents(near)).drop("hash").collect()
    assert Counter(tuple(r) for r in got) == _expected(near)


def _survivors(pairs, size, percent):
    """doc_id of the documents that stay: all without words, and the first of each component."""
    order = sorted(range(len(pairs)), key=lambda i: (pairs[i][0] is None, pairs[i][0] or 0))
    label = _components([pairs[i] for i in order], size, percent)
    return Counter(pairs[i][0] for at, i in enumerate(order) if not brute.shingles(pairs[i][1], size) or label[at] == at)


@pytest.mark.parametrize("size, percent", [(4, 85), (5, 80)])
def test_one_of_each_group(documents, near, size, percent):
    docs = documents(near)
    kept = jaccard_join.keep_one(docs, size, percent)
    assert kept.schema == docs.schema
    got = Counter(r["doc_id"] for r in kept.collect())
    assert got == _survivors(near, size, percent) and sum(got.values()) < len(near)


def test_one_of_equal_rows(spark, documents):
    """Copies with one id, without ids, equal in all columns or in id and text alone."""
    text = " ".join(f"w{i}" for i in range(30))
    for doc_id in (None, 7):
        kept = jaccard_join.keep_one(documents([(doc_id, text)] * 5 + [(9, "another text of some words")]), 5, 80)
        assert sorted((r["doc_id"] or 0) for r in kept.collect()) == sorted([doc_id or 0, 9])
    rows = [(1, text, "b", {"k": 2}), (1, text, "a", {"k": 1}), (1, text, "a", {"k": 1}), (2, None, "c", None), (2, None, "c", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `__ql_hash` string, hash map<string,int>")
    kept = jaccard_join.keep_one(docs, 5, 80)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 2]
    assert jaccard_join.keep_one(docs.limit(0)).count() == 0


def test_strongly_cut_documents_go(documents):
    line = lambda k, n: " ".join(f"{k}{i}" for i in range(n))
    pairs = [
        (1, "\n".join([line("a", 12), line("b", 12), line("c", 12)])),
        (2, "\n".join([line("a", 12), line("b", 12), line("d", 12)])),
        (3, "\n".join([line("a", 12), line("e", 12), line("f", 12)])),
        (4, None),
    ]
    docs = documents(pairs)
    assert line_dedup.remove_lines(docs).count() == 4
    kept = {r["doc_id"]: r["text"] for r in line_dedup.remove_lines(docs, 0.5).collect()}
    assert kept == {1: pairs[0][1], 3: "\n".join([line("e", 12), line("f", 12)]), 4: None}
    clash = docs.withColumn("__ql_hash", F.lit("mine"))
    assert {r["__ql_hash"] for r in line_dedup.remove_lines(clash, 0.5).collect()} == {"mine"}


def _components(pairs, size, percent):
    sets = [brute.shingles(t, size) for _, t in pairs]
    label = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                low, high = sorted((label[a], label[b]))
                label = [low if x == high else x for x in label]
    return label


def test_jaccard_of_five_words_and_eighty_percent(documents, near):
    head = [f"h{i}" for i in range(900)]
    ends = [[f"{k}{i}" for i in range(100)] for k in "xy"]
    pairs = [(i, t) for i, t in near if i is not None and i != 4] + [(1000 + k, " ".join(head + e)) for k, e in enumerate(ends)]
    label = _components(pairs, 5, 80)
    ids = {}
    for (i, t), x in zip(pairs, label):
        if brute.shingles(t, 5):
            ids[x] = min(i, ids.get(x, i))
    want = {i for (i, t), x in zip(pairs, label) if not brute.shingles(t, 5) or ids[x] == i}
    docs = documents(pairs)
    assert {r["doc_id"] for r in jaccard_join.keep_one(docs, 5, 80).collect()} == want
    assert 1000 in want and 1001 not in want


def test_one_stays_of_equal_and_null_ids(documents):
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words[:k]) for k in (60, 59, 58)]
    for i in (None, 7):
        assert jaccard_join.keep_one(documents([(i, t) for t in texts])).count() == 1
    assert jaccard_join.keep_one(documents([(None, texts[0]), (7, texts[1]), (7, texts[2])])).collect()[0]["doc_id"] == 7


def test_region_join_connects_what_links_connect():
    rng = np.random.default_rng(7)
    for _ in range(30):
        sets = []
        for _ in range(25):
            own = rng.random(60) < 0.93 if rng.random() < 0.7 else rng.random(60) < 0.5
            sets.append(np.flatnonzero(own).astype(np.uint64))
        label = list(range(25))
        for a in range(25):
            for b in range(a):
                common = len(np.intersect1d(sets[a], sets[b]))
                if 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                    low, high = sorted((label[a], label[b]))
                    label = [low if x == high else x for x in label]
        got = list(range(25))
        for a, b in jaccard_join.region_join(sets):
            low, high = sorted((got[a], got[b]))
            got = [low if x == high else x for x in got]
        assert got == label


def test_prefixes_of_linked_sets_meet():
    for n in range(1, 400):
        assert n - jaccard_join.prefix_length(n) + 1 == -(-85 * n // 100)


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 105), (7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["label"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 101: 100, 105: 100, 200: 200, 201: 200}


@pytest.fixture(scope="module")
def byte_texts(odd_texts):
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdé ") for _ in range(700))
    pairs = [*odd_texts, (300, "a" * 450), (301, "ab" * 150), (302, "x" * 199), (303, "x" * 200), (304, passage[100:299])]
    for i in range(40):
        own = lambda k: "".join(rng.choice("efghi\n") for _ in range(rng.randrange(k)))
        a = rng.randrange(400)
        pairs.append((400 + i, own(300) + passage[a : a + rng.randrange(150, 300)] + own(300) + (passage if i % 7 == 0 else "")))
    return pairs


@pytest.mark.parametrize("hot", [repeated_bytes.HOT, 3])
def test_repeated_bytes_against_all_windows(documents, byte_texts, hot):
    got = repeated_bytes.cut(documents(byte_texts), hot)
    want = Counter(zip([i for i, _ in byte_texts], brute.cut_bytes([t for _, t in byte_texts])))
    rows = got.collect()
    assert Counter((r["doc_id"], (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])) for r in rows) == want


def test_segments_cover_each_window_once_over_chunks():
    rng = np.random.default_rng(9)
    data = rng.integers(97, 123, (1 << 20) + 5000).astype(np.uint8)
    offsets = np.array([0, 100, 100, 900, len(data)])
    doc, anchor, first, last, _ = repeated_bytes.segments(data, offsets)
    windows = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last)])
    want = np.concatenate([np.arange(a, b - 199) for a, b in zip(offsets[:-1], offsets[1:]) if b - a >= 200])
    assert (windows == want).all()
    assert ((anchor >= last) & (anchor + 64 <= first + 200)).all()
    assert (offsets[doc] <= first).all() and (last + 200 <= offsets[doc + 1]).all()


def test_empty_tables(documents):
    none = documents([])
    for result in (
        line_dedup.report(none), line_dedup.remove_lines(none), jaccard_join.join(none), jaccard_join.keep_one(none),
        repeated_bytes.cut(none),
    ):
        assert result.count() == 0
