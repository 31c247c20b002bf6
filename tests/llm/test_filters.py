import hashlib
import random
from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F
from quarrylight.llm import decontaminate, licences, quality, secret_scan


def _junk(rng, n):
    words = [f"{a}{b}" for a in "bcdfg" for b in "aeiou"] + ["||", "###", "$x", "the", "of"]
    return " ".join(rng.choice(words) + rng.choice(["", "", "\n"]) for _ in range(n))


def test_quality_counts(documents, odd_texts):
    rng = random.Random(1)
    pairs = odd_texts + [(100 + i, _junk(rng, rng.randrange(1, 400))) for i in range(60)]
    got = quality.judge(documents(pairs)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
    want = Counter((i, *brute.counts(t), brute.base_failed(brute.counts(t))) for i, t in pairs)
    assert Counter((r["doc_id"], *[r[n] for n in names], r["base_failed"]) for r in got) == want


def test_quality_verdicts_per_group(documents):
    rng = random.Random(2)
    docs, rows = None, []
    for k, (lang, source) in enumerate([("en", "a"), ("en", "b"), (None, "a"), ("de", None)]):
        pairs = [(1000 * k + i, _junk(rng, rng.randrange(40, 200))) for i in range(30 if k else 6)]
        part = documents(pairs, lang, source)
        docs = part if docs is None else docs.unionByName(part)
        rows += [(i, t, lang, source) for i, t in pairs]
    kept = {rows[i][0] for i in brute.kept_by_quality([r[1:] for r in rows], quality.UNITS, 20)}
    got = quality.judge(docs, min_docs=20).filter("kept").collect()
    assert {r["doc_id"] for r in got} == kept and 0 < len(kept) < len(rows)
    stage = quality.keep_good(docs, min_docs=20)
    assert stage.columns == docs.columns
    assert {r["doc_id"] for r in stage.collect()} == kept


def test_secrets_against_plain_regexes(documents, odd_texts):
    key = "AKIA" + "Q7" * 8
    texts = [
        f'é\U0001f600 token = "{"a1" * 20}" and PASSWORD:short, ApiKey=LongEnough1', f"{key} AKIAshort {key}",
        "secret:token:abcdefghij passwd='x.y_z-1234'", "0" * 31 + " " + "f" * 32, "tokentoken==abcdefgh=",
        "aBc123" * 5 + " plain", ("token=abcdefgh " * 3000),
    ]
    pairs = odd_texts + [(50 + i, t) for i, t in enumerate(texts)]
    got = secret_scan.scan(documents(pairs)).collect()
    assert len(got) == len(pairs)
    want = Counter((i, hashlib.sha256(",".join(brute.secrets(t)).encode()).hexdigest()) for i, t in pairs)
    assert Counter((r["doc_id"], r["base_sha256"]) for r in got) == want
    spans = {r["doc_id"]: r["spans"].split(",") for r in got}
    assert "opaque:0:30" in spans[55]
    assert {r["doc_id"]: r["n_assign"] for r in got}[56] == 3000


def test_copied_examples_and_live_secrets(documents):
    example, live = "Ab1" * 8, "Zy9" * 8
    docs = None
    for k in range(3):
        part = documents([(k, f"see {example}"), (10 + k, f"own {live} {example}" if k == 0 else "none")], source=f"s{k}")
        docs = part if docs is None else docs.unionByName(part)
    got = {r["doc_id"]: r for r in secret_scan.scan(docs).collect()}
    assert got[0]["spans"] == "" and got[0]["n_examples"] == 1
    assert got[10]["spans"] == "opaque:4:28" and (got[10]["n_live"], got[10]["n_examples"]) == (1, 1)


@pytest.fixture(scope="module")
def bench(spark):
    rng = random.Random(3)
    words = [f"v{i}" for i in range(30)]
    items = [(i, " ".join(rng.choices(words, k=k))) for i, k in enumerate([25, 14, 10, 4, 1, 12])]
    items += [(2, items[1][1] + " extra"), (None, items[0][1]), (77, None), (78, "")]
    return items


def test_contamination(documents, odd_texts, bench, spark):
    rng = random.Random(4)
    words = [f"v{i}" for i in range(30)] + ["V3", "é", "x-y"]
    pairs = list(odd_texts)
    for i in range(60):
        text = rng.choices(words, k=rng.randrange(5, 60))
        if i % 3 == 0:
            text[3:3] = [w.upper() + "," for w in bench[i % 6][1].split()]
        pairs.append((100 + i, rng.choice([" ", "; ", "\n"]).join(text)))
    table = spark.createDataFrame([(a, b, 1) for a, b in bench], "item_id long, text string, hash int")
    docs = documents(pairs)
    found = brute.windows(bench)
    want = Counter()
    for i, t in pairs:
        n, hit, items = brute.contamination(t, found)
        want[(i, n, len(hit), len(items), hashlib.sha256(",".join(items).encode()).hexdigest(), bool(hit))] += 1
    assert Counter(tuple(r) for r in decontaminate.report(docs, table).collect()) == want

    clean = decontaminate.remove_documents(docs, table)
    assert clean.columns == docs.columns
    kept = Counter((i, t) for i, t in pairs if not brute.contamination(t, found)[1])
    assert Counter((r["doc_id"], r["text"]) for r in clean.select("doc_id", "text").collect()) == kept

    cut = decontaminate.remove_spans(docs, table)
    assert cut.columns == docs.columns and cut.count() == len(pairs)
    left = {r["doc_id"]: r["text"] for r in cut.collect()}
    for i, t in pairs[len(odd_texts):]:
        hit = brute.contamination(t, found)[1]
        words_left = [w for k, w in enumerate(brute.ITEM_WORD.findall(brute.lower(t))) if k not in hit]
        assert brute.ITEM_WORD.findall(brute.lower(left[i])) == words_left

    named = docs.withColumns({"__ql_hash": F.lit("mine"), "hash": F.lit(5), "row": F.lit("r"), "spans": F.lit(None).cast("string")})
    for kept, plain in ((decontaminate.remove_documents(named, table), clean), (decontaminate.remove_spans(named, table), cut)):
        assert kept.columns == named.columns
        assert kept.filter("`__ql_hash` = 'mine' AND hash = 5 AND row = 'r' AND spans IS NULL").count() == plain.count()
        texts_of = lambda df: Counter((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())
        assert texts_of(kept) == texts_of(plain)


def test_licences(documents, odd_texts):
    mit = "The MIT Licence text\n"
    texts = {
        60: "Copyright (c) 2020 Someone\n\n" + licences.TEXTS["MIT"].upper().replace('"', "''"),
        61: "words\n  * Released under the M.I.T? no\n# Licenced under the Apache Licence, version 2.0!!\nmore",
        62: "Licensed under CC BY-NC 4.0.\nSPDX-License-Identifier: GPL-3.0",
        63: mit + "This work is licensed under the MIT License with changes",
        64: licences.TEXTS["BSD-3-Clause"].replace("\n\n", "\n \n"),
    }
    docs = documents(odd_texts + list(texts.items()))
    got = {r["doc_id"]: (r["text_licence"], r["line_licences"], r["n_lines"]) for r in licences.scan(docs).collect()}
    assert got[60] == ("MIT", "", 0)
    assert got[61] == (None, "Apache-2.0", 1)
    assert got[62] == (None, "CC-BY-NC-4.0,GPL-3.0", 2)
    assert got[63] == (None, "", 0)
    assert got[64][0] == "BSD-3-Clause"
    assert licences.scan(docs).count() == len(odd_texts) + len(texts)


def test_altered_and_rewrapped_licence_files(documents):
    """No clause can be changed unnoticed, and line ends do not matter."""
    long = {p.stem: p.read_text("utf-8") for p in licences.LONG.glob("*.txt")}
    cases = [(name, licences.unwrapped(text)) for name, text in long.items()]
    for name, text in (long | licences.TEXTS).items():
        lines = text.split("\n")
        clauses = [i for i, x in enumerate(lines) if x.strip().startswith(("(c)", "c)"))]
        middle = [len(lines) // 2 + k for k in range(len(lines)) if lines[(len(lines) // 2 + k) % len(lines)].strip()][:1]
        for i in clauses + middle:
            i %= len(lines)
            changed = lines[:i] + [lines[i] + " except that you may remove all notices"] + lines[i + 1 :]
            cases += [(None, "\n".join(changed)), (None, licences.unwrapped("\n".join(changed)))]
            if i in clauses:
                cases.append((None, "\n".join(lines[:i] + ["(c) You may remove, at will, all notices, except in some works"] + lines[i + 1 :])))
    for owner in ("Copyright The Foo Authors", "Copyright Jane Doe 2020", "Copyright: 2020 Jane", "Copyright (c) 2020, Jane", "© Jane", "(c) 2021 Jane"):
        cases += [("MIT", f"{owner}\n\n" + licences.TEXTS["MIT"]), ("MIT", f"MIT License\n\n{owner}\n\n" + licences.TEXTS["MIT"])]
    assert sum(name is None for name, _ in cases) > 2 * len(long)
    got = {r["doc_id"]: r["text_licence"] for r in licences.scan(documents([(i, t) for i, (_, t) in enumerate(cases)])).collect()}
    assert [got[i] for i in range(len(cases))] == [name for name, _ in cases]


def test_standard_licence_files(documents):
    owner = "Copyright (c) 2020, Some One <one@example.com>\n"
    long = {p.stem: p.read_text("utf-8") for p in licences.LONG.glob("*.txt")}
    files = [
        ("MIT", f"MIT License\n\n{owner}\n" + licences.TEXTS["MIT"]),
        ("MIT", f"The MIT License (MIT)\n\n{owner}\n" + licences.TEXTS["MIT"]),
        ("ISC", f"ISC License\n\n{owner}\n" + licences.TEXTS["ISC"]),
        ("BSD-3-Clause", f"BSD 3-Clause License\n\n{owner}All rights reserved.\n\n" + licences.TEXTS["BSD-3-Clause"]),
        ("BSD-2-Clause", f"{owner}All rights reserved.\n\n" + licences.TEXTS["BSD-2-Clause"].replace("1. ", "* ").replace("2. ", "* ")),
        ("Apache-2.0", long["Apache-2.0"].replace("[yyyy] [name of copyright owner]", "2020 Some One")),
        ("Apache-2.0", long["Apache-2.0"].partition("   APPENDIX")[0]),
        ("GPL-2.0", long["GPL-2.0"].replace("51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA", "59 Temple Place, Suite 330, Boston, MA  02111-1307  USA")),
        *long.items(),
    ]
    docs = documents(list(enumerate(text for _, text in files)) + [(99, long["GPL-3.0"] + "\nand more")])
    got = {r["doc_id"]: r["text_licence"] for r in licences.scan(docs).collect()}
    assert [got[i] for i in range(len(files))] == [name for name, _ in files] and got[99] is None
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "Unlicense"} <= set(long)


def test_empty_tables(documents, spark):
    none = documents([])
    bench = spark.createDataFrame([], "item_id long, text string")
    for result in (
        quality.judge(none), quality.keep_good(none), secret_scan.scan(none), licences.scan(none),
        decontaminate.report(none, bench), decontaminate.remove_documents(none, bench), decontaminate.remove_spans(none, bench),
    ):
        assert result.count() == 0
    some = documents([(1, "a b c")])
    assert [tuple(r)[1:4] for r in decontaminate.report(some, bench).collect()] == [(3, 0, 0)]
