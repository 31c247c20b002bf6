"""Plain versions of the operators over a few rows, from their definitions."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
        len(lines),
    )


def base_failed(c):
    return c[0] < 50 or 100 * c[4] > 50 * c[0]


def fence(values, unit):
    def bucket(v):
        shift = max(0, v.bit_length() - 5)
        return v >> shift << shift

    values = sorted(map(bucket, values))
    n = len(values)
    q1, q3 = values[-(-n // 4) - 1], values[-(-3 * n // 4) - 1]
    return q3 + 3 * max(q3 - q1, unit)


def kept_by_quality(docs, units, min_docs):
    """Indices of (text, lang, source) rows that stay."""
    measured = [counts(text) for text, _, _ in docs]
    ratios = [
        {
            "symbols": 10000 * c[2] // max(c[1], 1),
            "dup_lines": 10000 * c[3] // max(c[5], 1),
            "repeats": 10000 * c[4] // max(c[0], 1),
        }
        for c in measured
    ]
    kept = []
    for i, (_, lang, source) in enumerate(docs):
        levels = [
            [j for j, d in enumerate(docs) if d[1:] == (lang, source)],
            [j for j, d in enumerate(docs) if d[1] == lang],
        ]
        group = next((g for g in levels if len(g) >= min_docs), range(len(docs)))
        fits = all(ratios[i][m] <= fence([ratios[j][m] for j in group], u) for m, u in units.items())
        if fits and not base_failed(measured[i]):
            kept.append(i)
    return kept


def within_one(a, b):
    """Word edit distance of at most one, by the usual table."""
    if abs(len(a) - len(b)) > 1:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1] <= 1


def removed_lines(docs, min_words=10):
    """Line numbers that go, by index; ``docs`` are texts in the order of their places."""
    gone = defaultdict(list)
    earlier: list[tuple[str, list[str]]] = []
    seen = set()
    near = {}
    for i, text in enumerate(docs):
        for k, line in enumerate((text or "").split("\n")):
            words = WORD.findall(line)
            if not words:
                continue
            if line not in near:
                near[line] = len(words) >= min_words and any(
                    len(w) >= min_words and within_one(words, w) for _, w in earlier
                )
                earlier.append((line, words))
            if line in seen or near[line]:
                gone[i].append(k)
            seen.add(line)
    return dict(gone)


def shingles(text, size=4):
    words = WORD.findall(lower(text))
    if len(words) < size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def components(texts, percent=85, size=4):
    """The smallest index of each text's component."""
    sets = [shingles(t, size) for t in texts]
    label = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b) and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


def windows(bench, size=10):
    """window -> item names; ``bench`` holds (item_id, text)."""
    found = defaultdict(set)
    for item, text in bench:
        words = ITEM_WORD.findall(lower(text))
        n = min(size, len(words))
        for i in range(len(words) - n + 1 if words else 0):
            found[tuple(words[i : i + n])].add("" if item is None else str(item))
    return found


def contamination(text, found):
    """n_words, hit word numbers and the items."""
    words = ITEM_WORD.findall(lower(text))
    hit, items = set(), set()
    for n in {len(w) for w in found}:
        for i in range(len(words) - n + 1):
            names = found.get(tuple(words[i : i + n]))
            if names:
                hit.update(range(i, i + n))
                items |= names
    return len(words), hit, sorted(items)


def cut_bytes(texts, length=200):
    """(n_bytes, n_removed, n_spans, digest of what is left) of each text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + length] for t in data for i in range(len(t) - length + 1))
    out = []
    for t in data:
        covered = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                covered[i : i + length] = b"\1" * length
        left = bytes(c for c, gone in zip(t, covered) if not gone)
        runs = sum(1 for i, gone in enumerate(covered) if gone and (i == 0 or not covered[i - 1]))
        out.append((len(t), len(t) - len(left), runs, hashlib.sha256(left).hexdigest()))
    return out


SECRETS = {
    "assign": (re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), 2, 8),
    "access": (re.compile("AKIA[A-Z0-9]+"), 0, 16),
    "hex": (re.compile("[0-9a-f]+"), 0, 32),
}


def secrets(text):
    """Base spans by start and kind."""
    found = []
    for number, (kind, (pattern, group, least)) in enumerate(SECRETS.items()):
        for m in pattern.finditer(text or ""):
            if len(m[group]) >= least:
                found.append((m.start(), number, f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(found)]
