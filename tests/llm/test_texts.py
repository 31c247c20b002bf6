import base64
import gzip
import hashlib
import random
import zlib
from collections import Counter, defaultdict
from datetime import date, timedelta

import numpy as np
import pyarrow as pa
import pytest
from quarrylight.llm import packing, pseudonyms, warc_store
from quarrylight.session import scratch_path


# -- WARC -------------------------------------------------------------------------


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string, copies int")


@pytest.mark.parametrize("min_bytes", [0, 4])
def test_warc(spark, min_bytes):
    rows = [
        (5, "u5", "<p>é\r\n\r\nWARC-Type: revisit\r\n</p>"), (3, "u3\r\nX: y", "<p>é\r\n\r\nWARC-Type: revisit\r\n</p>"), (4, None, None),
        (2, "u2", ""), (9, "z", "same"), (9, "a", "same"), (10, "a", "same"), (None, "n", "same"), (None, None, "alone"),
        (12, "t", "twice"), (12, "t", "twice"), (13, "l", "x" * 3_000_000),
    ]
    pages = _pages(spark, [(*r, "x", 1) for r in rows])
    path = scratch_path(spark, "warc-test")
    warc_store.write_archive(pages, path, min_bytes)
    to = scratch_path(spark, "warc-files")
    warc_store.write_warc_files(spark, path, to, records_per_file=3)
    read = warc_store.read_warc_files(spark, to)
    got = warc_store.report(read, pages.schema["page_id"].dataType).collect()
    assert Counter(bytes(r["header"].encode() + r["body"]) for r in read.collect()) == Counter(
        bytes(r["record"]) for r in warc_store.records(spark, path).collect()
    )
    assert len(got) == len(rows) and all(r["verified"] for r in got)
    groups = defaultdict(list)
    for page, _, html in rows:
        groups[html or ""].append(page)
    want = Counter()
    for html, ids in groups.items():
        data = html.encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        ids = sorted(ids, key=lambda x: (x is None, x or 0))
        for k, page in enumerate(ids):
            first = k == 0 or len(data) < min_bytes
            want[(page, len(data), digest, "response" if first else "revisit", None if first else ids[0])] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    stored = spark.read.parquet(f"{path}/payloads")
    assert stored.count() == len(groups)

    lengths = Counter()
    for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(to).select("content").collect():
        rest = gzip.decompress(r["content"])
        while rest:
            head, rest = rest.split(b"\r\n\r\n", 1)
            fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
            n = int(fields[b"Content-Length"])
            lengths[n] += 1
            assert head.startswith(b"WARC/1.1") and rest[n : n + 4] == b"\r\n\r\n"
            if fields[b"WARC-Type"] == b"response":
                named = base64.b32encode(hashlib.sha1(rest[:n]).digest())
                assert fields[b"WARC-Payload-Digest"] == b"sha1:" + named
            rest = rest[n + 4 :]
    assert sum(lengths.values()) == len(rows)


def test_damaged_payload_fails(spark):
    path = scratch_path(spark, "warc-damaged")
    spark.createDataFrame([("h", "0" * 64)], "header string, digest string").write.parquet(f"{path}/headers")
    spark.createDataFrame([("0" * 64, b"x")], "digest string, payload binary").write.parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="damaged payload"):
        warc_store.read_payloads(spark, path).collect()


def test_empty_archive(spark):
    path = scratch_path(spark, "warc-empty")
    pages = _pages(spark, [])
    warc_store.write_archive(pages, path)
    warc_store.write_warc_files(spark, path, f"{path}/warc")
    assert warc_store.report(warc_store.read_warc_files(spark, f"{path}/warc"), pages.schema["page_id"].dataType).count() == 0


def test_parse_of_foreign_and_damaged_records():
    one = b"WARC/1.0\r\ncontent-length: 6\r\nX: y\r\n\r\na\r\n\r\nb\r\n\r\n"
    two = b"WARC/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    want = [(one[: one.index(b"a\r")], b"a\r\n\r\nb"), (two[:-4], b"")]
    assert list(warc_store.parse(one + two)) == want
    assert list(warc_store.parse(gzip.compress(one) + gzip.compress(two))) == want
    for broken in (one[:-6], one[:-4] + two, b"x\r\n", b"WARC/1.1\r\n\r\n\r\n\r\n", one[:-1]):
        with pytest.raises(ValueError, match="damaged record"):
            list(warc_store.parse(broken))


# -- pseudonyms -------------------------------------------------------------------


def _mix(kind, round_, value, key=pseudonyms.TEST_KEY):
    return int(hashlib.sha256(f"{key}|{kind}|{round_}|{value}".encode()).hexdigest()[:15], 16)


def _feistel(left, right, n_left, n_right, kind, back=False):
    for i in (reversed if back else iter)(range(pseudonyms.ROUNDS)):
        if i % 2 == 0:
            left = (left + (-1 if back else 1) * _mix(kind, i, right)) % n_left
        else:
            right = (right + (-1 if back else 1) * _mix(kind, i, left)) % n_right
    return left, right


def _digits(digits, kind, back=False):
    u = len(digits) // 2
    v = len(digits) - u
    left, right = _feistel(int(digits[:u] or 0), int(digits[u:]), 10**u, 10**v, kind, back)
    return (str(left).zfill(u) if u else "") + str(right).zfill(v)


def _luhn_remainder(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10


def _only(text):
    return "".join(c for c in text if c.isdigit())


def test_pseudonyms(spark):
    rng = random.Random(10)
    cards = ["".join(rng.choices("0123456789", k=rng.randrange(13, 20))) for _ in range(60)] + ["4111111111111111"]
    days = [date(1700, 1, 1) + timedelta(days=rng.randrange(146097)) for _ in range(40)]
    ips = [".".join(str(rng.randrange(256)) for _ in range(4)) for _ in range(20)]
    mails = [f"{a}@mail.example.com" for a in ("bob.smith42", "x", "Ab", "né.q", "a-b_c")]
    values = cards + [d.isoformat() for d in days] + ips + mails
    docs = spark.createDataFrame([(i, f"é <{v}>, {v}.", v) for i, v in enumerate(values)], "doc_id long, text string, n_ip string")
    rows = pseudonyms.pseudonymise(docs, pseudonyms.TEST_KEY).select("row.doc_id", "row.n_ip", "text").collect()
    new = {}
    for r in rows:
        first = r["text"][3 : r["text"].index(">")]
        assert r["text"] == f"é <{first}>, {first}."
        new[r["n_ip"]] = first
    assert len(set(new.values())) == len(set(values))
    for card in cards:
        assert len(new[card]) == len(card) and _luhn_remainder(new[card]) == _luhn_remainder(card)
        assert new[card][:-1] == _digits(card[:-1], "number") and _digits(new[card][:-1], "number", back=True) == card[:-1]
    for d in days:
        there = (date.fromisoformat(new[d.isoformat()]) - date(1700, 1, 1)).days
        left, right = _feistel(there // 773, there % 773, 189, 773, "date", back=True)
        assert date(1700, 1, 1) + timedelta(days=left * 773 + right) == d
    for ip in ips:
        a, b, c, d = map(int, new[ip].split("."))
        left, right = _feistel(a * 256 + b, c * 256 + d, 65536, 65536, "ip", back=True)
        assert ip == f"{left // 256}.{left % 256}.{right // 256}.{right % 256}"
    for mail in mails:
        shape = lambda s: [(c.islower(), c.isdigit(), c if not c.isalnum() else "") for c in s.split("@")[0] if c.isascii()]
        assert new[mail].endswith("@mail.example.com") and new[mail] != mail and shape(new[mail]) == shape(mail)


def test_pseudonyms_keep_formats_and_leave_the_rest(documents, odd_texts):
    texts = [
        "call +1 (476) 555-6291 or 555-123-4567", "id 123-45-6789, 4111 1111-1111 1111", "on 31/12/1999, 12/31/1999, 31.04.2001, 99.99.9999",
        "v1.2.3.4.5 999.1.1.1 12345 0123456789abcdef0123456789abcdef a@b user@host", "x" * 100_000 + " 10.0.0.1",
    ]
    pairs = odd_texts + [(60 + i, t) for i, t in enumerate(texts)]
    docs = documents(pairs)
    out = pseudonyms.replace_text(docs, pseudonyms.TEST_KEY)
    assert out.columns == docs.columns
    got = out.collect()
    assert Counter((r["doc_id"], r["text"]) for r in got if (r["doc_id"] or 0) < 60) == Counter(odd_texts)
    new = {r["doc_id"]: r["text"] for r in got}
    mask = lambda t: "".join("9" if c.isdigit() else c for c in t)
    for i in (60, 61, 62):
        assert mask(new[i]) == mask(texts[i - 60]) and new[i] != texts[i - 60]
    assert new[60].startswith("call +1 (") and "31.04.2001" in new[62] and "99.99.9999" in new[62]
    assert _luhn_remainder(_only(new[61].split(", ")[1])) == 0
    assert new[63] == texts[3] and new[64][:100_001] == texts[4][:100_001]
    assert pseudonyms.pseudonymise(documents([]), pseudonyms.TEST_KEY).count() == 0
    with pytest.raises(ValueError, match="key"):
        pseudonyms.replace_text(documents([]), "")


def test_one_card_in_different_surroundings(documents):
    card, spaced = "4111111111111111", "4111 1111 1111 1111"
    texts = [card, spaced, f"{spaced} 12/27", f"{card} 123", f"order 12 {card}", f"order 12 {spaced} 10.0.0.1", f"{card} {card}", f"({spaced} 2024-05-01)"]
    rows = pseudonyms.pseudonymise(documents(list(enumerate(texts))), pseudonyms.TEST_KEY).select("row.doc_id", "text", "n_number", "n_date", "n_ip").collect()
    new = {r["doc_id"]: r for r in rows}
    card_, spaced_ = new[0]["text"], new[1]["text"]
    assert card_ != card and spaced_.replace(" ", "") == card_ and spaced_.count(" ") == 3
    assert new[2]["text"] == f"{spaced_} 12/27" and new[3]["text"] == f"{card_} 123" and new[4]["text"] == f"order 12 {card_}"
    assert new[5]["text"].startswith(f"order 12 {spaced_} ") and new[5]["n_ip"] == 1 and new[6]["text"] == f"{card_} {card_}"
    assert new[7]["text"].startswith(f"({spaced_} ") and new[7]["n_date"] == 1
    assert [new[i]["n_number"] for i in range(8)] == [1, 1, 1, 1, 1, 1, 2, 1]


def test_groups_that_are_no_card_and_long_rows_of_groups(documents):
    texts = ["12 345 678 901 234 56", "1234 5678 9012 3457", " ".join(["12 345"] * 8_000), "12345678901234567890", "1 2 3"]
    got = {r["doc_id"]: r["text"] for r in pseudonyms.replace_text(documents(list(enumerate(texts))), pseudonyms.TEST_KEY).collect()}
    for i, text in enumerate(texts):
        assert [len(x) for x in got[i].split(" ")] == [len(x) for x in text.split(" ")]
        assert (got[i] == text) == (i > 2)


def test_dates_with_times_and_single_digits(documents):
    texts = ["2024-05-01", "2024-05-01T10:00:00Z", "2024/05/01", "1/5/2024", "01/05/2024", "5/13/2024", "13.5.2024", "2024/13/45", "2024-05-01Tx"]
    got = {r["doc_id"]: r["text"] for r in pseudonyms.replace_text(documents(list(enumerate(texts))), pseudonyms.TEST_KEY).collect()}
    y, m, d = got[0].split("-")
    assert got[0] != texts[0] and got[1] == f"{got[0]}T10:00:00Z" and got[2] == f"{y}/{m}/{d}"
    assert got[3] == f"{int(d)}/{int(m)}/{y}" and got[4] == f"{d}/{m}/{y}"
    assert got[5].split("/")[::-1] == [got[6].split(".")[2], got[6].split(".")[0], got[6].split(".")[1]]
    assert got[7] == texts[7] and got[8] == texts[8]


# -- packing ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.vocabulary_path())


ODD = [
    "it's they're 'sfoo x's. .'s a'.b don't", "Å é ﬁ ﬀ Σ ΣΑΣ İ K", "<|endoftext|> x <|ENDOFTEXT|>y", "", "   ",
    "日本語 テスト a日 1a2b3", "a​b  c　d", "₂ ² ½ Ⅷ ʰ ⓐ ᾳ é .́", "x\x00y \x1c z\x85w", "(a)b.c,d;e-f_g/h\\i'j\"k `l~m", None,
]


def test_tokens_are_the_tokenizers_own(tokenizer):
    encoder = packing._Encoder(packing.vocabulary_path())
    ids, offsets = packing.tokenize(pa.array(ODD), encoder)
    for text, a, b in zip(ODD, offsets[:-1], offsets[1:]):
        assert ids[a:b].tolist() == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
    plain = [t for t in ODD if "endof" not in (t or "")]  # words are split at marks as well
    ids, offsets = packing.tokenize(pa.array(plain), encoder)
    for text, a, b in zip(plain, offsets[:-1], offsets[1:]):
        assert ids[a:b].tolist() == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def test_words_are_tokenized_once_for_several_slices(tokenizer, monkeypatch):
    """Ids of earlier slices are used again, and are the same after a full memory was given up."""
    encoder = packing._Encoder(packing.vocabulary_path())
    asked = []
    tokenized = packing._Encoder._tokenized
    monkeypatch.setattr(packing._Encoder, "_tokenized", lambda self, words: (asked.append(len(words)), tokenized(self, words))[1])
    words = [["one", "two's", "é"], ["two's", "one"], ["three", "é", "12"], []]

    def check():
        for some in words:
            ids, starts, sizes = encoder(pa.array([w.encode() for w in some], pa.large_binary()))
            got = [ids[a : a + n].tolist() for a, n in zip(starts, sizes)]
            assert got == [tokenizer.encode(w, add_special_tokens=False).ids for w in some]

    check()
    assert asked == [3, 2]
    monkeypatch.setattr(packing, "REMEMBERED", 0)
    check()
    assert asked == [3, 2, 3, 2, 3]


def check_packing(rows, texts, tokenizer, length):
    """Rows are gapless sequences of at most ``length`` tokens and hold every text."""
    by_sequence, by_doc = defaultdict(list), Counter()
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])] += 1
    for placed in by_sequence.values():
        at = 0
        for offset, n in sorted(placed):
            assert offset == at and n > 0
            at += n
        assert at <= length
    want = Counter()
    for doc_id, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for k, a in enumerate(range(0, len(ids), length)):
            want[(doc_id, k, a, len(ids[a : a + length]), zlib.crc32(ids[a : a + length].tobytes()))] += 1
    assert by_doc == want
    return len(by_sequence)


def test_packing(documents, odd_texts, tokenizer):
    rng = random.Random(11)
    texts = odd_texts + [(100 + i, " ".join(rng.choices(["the", "of", "thing"], k=rng.randrange(1, 200)))) for i in range(200)]
    rows = packing.pack_documents(documents(texts), length=128).collect()
    n = check_packing(rows, texts, tokenizer, 128)
    total = sum(r["length"] for r in rows)
    assert n <= -(-total // 128) + 1
    assert packing.pack_documents(documents([])).count() == 0


def test_exchanges_empty_a_bin():
    # best fit makes three bins of 6+3, 5+4 (of 10) and 1+1; two suffice for 20
    sizes = np.array([6, 5, 4, 3, 1, 1])
    bins = [[0, 3], [1, 2], [4, 5]]
    assert sorted(int(sizes[b].sum()) for b in packing.improve(bins, sizes, 10)) == [10, 10]
    # 4+4+4 | 3+3+3+3 of 14: a two-for-one exchange is needed
    sizes = np.array([7, 6, 4, 4, 4, 3])
    bins = [[0, 2], [1, 3], [4, 5]]
    packed = packing.improve(bins, sizes, 14)
    assert sorted(x for b in packed for x in b) == list(range(6))
    assert len(packed) == 2


def _helps(bins, sizes, length):
    """A move or exchange, by trying all, that takes tokens from a bin to a fuller one."""
    fill = [int(sizes[b].sum()) for b in bins]
    for s, source in enumerate(bins):
        outs = [[x] for x in source] + [[x, y] for k, x in enumerate(source) for y in source[k + 1 :]]
        for t, target in enumerate(bins):
            if s == t or not fill[s] <= fill[t] < length:
                continue
            for out in outs:
                for back in [0, *map(int, sizes[target])]:
                    flow = int(sizes[out].sum()) - back
                    if flow > 0 and fill[t] + flow <= length and (back or len(out) == 1):
                        return True
    return False


def test_improvement_stops_only_when_nothing_helps():
    rng = np.random.default_rng(13)
    for k in range(12):
        sizes = rng.integers(35, 60, 60) if k % 2 else rng.choice([25, 26, 27, 3, 5], 60)
        packed = packing.improve(packing.best_fit(sizes, 100), sizes, 100)
        assert sorted(x for b in packed for x in b) == list(range(60)) and not _helps(packed, sizes, 100)


def test_improvement_of_many_underfull_bins_and_small_pieces():
    # 5,100 bins that no step helps lie before the one that can give a piece
    sizes = np.array([51] * 5_100 + [80, 5] + [80, 6])
    bins = [[i] for i in range(5_100)] + [[5_100, 5_101], [5_102, 5_103]]
    assert max(int(sizes[b].sum()) for b in packing.improve(bins, sizes, 100)) == 91
    # the source's first 64 pieces are equal; only a pair of later ones can go
    sizes = np.array([10] * 65 + [7, 6] + [12, 979])
    packed = packing.improve([list(range(67)), [67, 68]], sizes, 992)
    assert sorted(int(sizes[b].sum()) for b in packed) == [662, 992]


def test_improvement_keeps_items_and_limits():
    rng = np.random.default_rng(12)
    for _ in range(20):
        sizes = rng.integers(1, 60, 80)
        first = [[i] for i in range(80)] if rng.random() < 0.3 else packing.best_fit(sizes, 100)
        packed = packing.improve([list(b) for b in first], sizes, 100)
        assert sorted(x for b in packed for x in b) == list(range(80))
        assert all(sizes[b].sum() <= 100 for b in packed) and len(packed) <= len(first)
