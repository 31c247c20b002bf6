"""Format-preserving pseudonyms of personal data, in DataFrame functions only.

E-mail addresses, IPv4 addresses, dates, phone numbers, social security numbers and long
numbers such as those of cards are found in whole texts, checked (octets, real dates,
digit counts) and replaced by keyed permutations of their own format: Feistel networks
whose rounds add a keyed SHA-256 of one half to the other, modulo the size of that half.
Equal values get equal pseudonyms in every document, different values different ones, and
who has the key can invert them.

- Numbers keep their length, separators and Luhn remainder, so valid cards stay valid. In a
  row of digit groups whole groups make a number: one run of 13 to 19 digits or a card's
  grouping that is valid comes first, then such ones that are not valid, then other groups
  that are valid together, then others; short groups beside them stay as they are.
- Dates move within 1700-01-01 to 2099-12-31, whose 146,097 days are 189 x 773.
- Phone numbers keep their country code and punctuation; addresses stay addresses.
- E-mail addresses keep their domain; letters and digits of the name move in their class.

All of it is a map over rows: nothing is shuffled. Null text stays null, empty text stays
empty, an empty table stays empty, repeated rows are replaced alike, and all other columns
pass through unchanged. A task holds one text with its matches, however long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylight.llm.common import rows, table

#: The key of the registered query, whose pseudonyms are for comparison only.
TEST_KEY = "quarrylight"
ROUNDS = 8
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Fixed formats, in order of precedence.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*\.[A-Za-z]{2,}",
    "ip": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9])(?!\.[0-9])",
    "date": r"(?<![0-9A-Za-z])(?:[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}(?=[Tt][0-9]{2}:?[0-9]{2})|(?:[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?![0-9A-Za-z]))",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}|\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4})(?![0-9A-Za-z])",
}
#: Digit groups with at least 13 digits in all, up to what another kind takes.
_OTHERS = "|".join(f"(?:{p})" for p in PATTERNS.values())
PATTERNS["number"] = rf"(?<![0-9A-Za-z+])(?=(?:[0-9][ -]?){{12}}[0-9])[0-9]++(?![A-Za-z])(?:[ -](?!{_OTHERS})[0-9]++(?![A-Za-z]))*+"
#: Lengths of the groups of cards as they are written, and of one run.
CARDS = ("4-4-4-4", "4-4-4-4-3", "4-6-5", "4-6-4", "4-5-6", "4-4-5", "8-8", "6-13", *map(str, range(13, 20)))
_ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
_FIRST_DAY, _ROWS, _SLOTS = "1700-01-01", 189, 773


def _mix(key: str, kind: str, round_: Column, value: Column) -> Column:
    """A keyed number below 2 ** 60."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), round_.cast("string"), value.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _feistel(left: Column, right: Column, n_left: Column, n_right: Column, key: str, kind: str) -> Column:
    """struct(l, r): both halves after all rounds; a permutation of n_left x n_right pairs."""
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)),
        F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")),
        lambda a, i: F.struct(
            F.when(i % 2 == 0, (a["l"] + _mix(key, kind, i, a["r"])) % n_left).otherwise(a["l"]).alias("l"),
            F.when(i % 2 == 1, (a["r"] + _mix(key, kind, i, a["l"])) % n_right).otherwise(a["r"]).alias("r"),
        ),
    )


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _permute_digits(digits: Column, key: str, kind: str) -> Column:
    """Another string of as many digits (at most 19)."""
    n = F.length(digits)
    u = F.floor(n / 2).cast("int")
    v = n - u
    power = lambda k: F.pow(F.lit(10.0), k).cast("long")
    number = lambda s: F.when(s == "", F.lit(0)).otherwise(s.cast("long"))
    left, right = number(F.substring(digits, F.lit(1), u)), number(F.substring(digits, u + 1, v))
    halves = _feistel(left, right, power(u), power(v), key, kind)
    pad = lambda x, k: F.lpad(x.cast("string"), k, "0")
    return _let(halves, lambda h: F.concat(F.when(u == 0, F.lit("")).otherwise(pad(h["l"], u)), pad(h["r"], v)))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _refill(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced, one after the other."""
    chars = F.filter(F.split(form, ""), lambda c: c != "")
    return F.aggregate(
        chars,
        F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda a, c: F.when(
            c.rlike("[0-9]"),
            F.struct(F.concat(a["out"], F.substring(digits, a["at"], F.lit(1))).alias("out"), (a["at"] + 1).alias("at")),
        ).otherwise(F.struct(F.concat(a["out"], c).alias("out"), a["at"].alias("at"))),
        lambda a: a["out"],
    )


def _luhn(body: Column) -> Column:
    """The check digit that makes ``body`` and it a valid number."""
    chars = F.filter(F.split(F.reverse(body), ""), lambda c: c != "")
    doubled = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    values = F.transform(chars, lambda c, i: F.when(i % 2 == 0, doubled(c.cast("int"))).otherwise(c.cast("int")))
    return (10 - F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10) % 10


def _renewed(digits: Column, key: str) -> Column:
    n = F.length(digits)
    body, last = F.substring(digits, F.lit(1), n - 1), F.substring(digits, n, F.lit(1)).cast("int")
    kept = (last - _luhn(body) + 10) % 10
    return _let(
        _permute_digits(body, key, "number"),
        lambda new: F.concat(new, ((_luhn(new) + kept) % 10).cast("string")),
    )


def _choices(groups: Column, i: Column) -> Column:
    """Numbers that start at group i, best first: (rank, order, count of groups)."""

    def choice(part: Column) -> Column:
        digits, n = F.array_join(part, ""), F.size(part)
        card = F.array_join(F.transform(part, lambda g: F.length(g).cast("string")), "-").isin(*CARDS)
        valid = _luhn(F.substring(digits, F.lit(1), F.length(digits) - 1)).cast("string") == F.substring(digits, -1, 1)
        rank = F.when(card & valid, 1).when(card, 2).when(valid, 3).otherwise(4)
        return _let(rank, lambda r: F.struct(r.alias("rank"), F.when(r % 2 == 1, n).otherwise(-n).alias("order"), n.alias("n")))

    after = F.slice(groups, i + 1, 19)
    parts = F.transform(F.sequence(F.lit(1), F.size(after)), lambda k: F.slice(after, F.lit(1), k))
    fits = F.filter(parts, lambda p: F.length(F.array_join(p, "")).between(13, 19))
    return F.array_sort(F.transform(fits, choice))


def _apart(choices: Column, others: Column) -> Column:
    """``choices`` per group without those that reach over the start of a better one of ``others``."""
    better = lambda c, i: F.exists(F.slice(others, i + 2, c["n"] - 1), lambda o: F.get(o, F.lit(0))["rank"] < c["rank"])
    return F.transform(choices, lambda cs, i: F.filter(cs, lambda c: ~F.coalesce(better(c, i), F.lit(False))))


def _numbers(hit: Column) -> Column:
    """The numbers in a row of digit groups, as (start, length) of text, in order."""
    size = lambda groups, i, n: F.aggregate(F.slice(groups, i + 1, n), F.lit(-1), lambda a, g: a + F.length(g) + 1)

    def chosen(groups: Column) -> Column:
        every = F.transform(F.sequence(F.lit(0), F.size(groups) - 1), lambda i: _choices(groups, i))
        left = _let(every, lambda all_: _let(_apart(all_, all_), lambda some: _apart(all_, some)))
        none = F.array().cast("array<struct<at:int,n:int>>")

        def step(cs: Column, a: Column, i: Column) -> Column:
            here = F.element_at(cs, i + 1)
            past = (a["at"] + F.length(F.element_at(groups, i + 1)) + 1).alias("at")
            n = F.get(here, F.lit(0))["n"]
            number = F.struct(a["at"].alias("at"), size(groups, i, n).alias("n"))
            return F.when(
                (i < a["next"]) | (F.size(here) == 0), F.struct(a["next"].alias("next"), past, a["out"].alias("out"))
            ).otherwise(F.struct((i + n).alias("next"), past, F.concat(a["out"], F.array(number)).alias("out")))

        return _let(left, lambda cs: F.aggregate(
            F.sequence(F.lit(0), F.size(groups) - 1),
            F.struct(F.lit(0).alias("next"), F.lit(1).alias("at"), none.alias("out")),
            lambda a, i: step(cs, a, i),
            lambda a: a["out"],
        ))

    return _let(F.split(hit, "[ -]"), chosen)


def _number(hit: Column, numbers: Column, key: str) -> Column:
    """``hit`` with its numbers replaced."""
    end = F.length(hit) + 1
    new = F.aggregate(
        numbers,
        F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda a, x: F.struct(
            F.concat(
                a["out"], F.substring(hit, a["at"], x["at"] - a["at"]),
                _let(F.substring(hit, x["at"], x["n"]), lambda s: _refill(s, _let(_digits(s), lambda d: _renewed(d, key)))),
            ).alias("out"),
            (x["at"] + x["n"]).alias("at"),
        ),
    )
    return _let(new, lambda a: F.concat(a["out"], F.substring(hit, a["at"], end - a["at"])))


def _phone(hit: Column, key: str) -> Column:
    code = F.regexp_extract(hit, r"^\+[0-9]{1,3}(?=[^0-9])|^", 0)
    rest = F.substring(hit, F.length(code) + 1, F.length(hit))
    return F.concat(code, _refill(rest, _let(_digits(rest), lambda d: _permute_digits(d, key, "phone"))))


def _ssn(hit: Column, key: str) -> Column:
    return _refill(hit, _let(_digits(hit), lambda d: _permute_digits(d, key, "ssn")))


def _ip(hit: Column, key: str) -> Column:
    part = lambda i: F.split(hit, r"\.")[i].cast("long")
    side = F.lit(65536)
    halves = _feistel(part(0) * 256 + part(1), part(2) * 256 + part(3), side, side, key, "ip")
    return _let(
        halves,
        lambda h: F.concat_ws(
            ".", *[x.cast("string") for x in (F.floor(h["l"] / 256), h["l"] % 256, F.floor(h["r"] / 256), h["r"] % 256)]
        ),
    )


def _date(hit: Column, key: str) -> Column:
    """Year first, or day first with / or ., or month first with / if no day-first date fits; others stay.

    A date without leading zeros gets one without; numbers are the same date with or without.
    """
    mark = F.regexp_extract(hit, "[^0-9]", 0)
    parts = F.split(hit, "[-/.]")
    year_first = F.length(parts[0]) == 4
    month_first = ~year_first & (mark == "/") & (parts[1].cast("int") > 12)
    short = F.exists(parts, lambda x: F.length(x) == 1)

    def moved(day: Column) -> Column:
        halves = _feistel(F.floor(day / _SLOTS), day % _SLOTS, F.lit(_ROWS), F.lit(_SLOTS), key, "date")
        new = _let(halves, lambda h: F.date_add(F.lit(_FIRST_DAY).cast("date"), (h["l"] * _SLOTS + h["r"]).cast("int")))
        return F.when(day.between(0, _ROWS * _SLOTS - 1), F.date_format(new, "yyyy-MM-dd")).otherwise(F.lit(None).cast("string"))

    two = lambda x: F.lpad(x, 2, "0")
    iso = (
        F.when(year_first, F.concat_ws("-", parts[0], two(parts[1]), two(parts[2])))
        .when(month_first, F.concat_ws("-", parts[2], two(parts[0]), two(parts[1])))
        .otherwise(F.concat_ws("-", parts[2], two(parts[1]), two(parts[0])))
    )

    def written(new: Column) -> Column:
        plain = lambda x: F.when(short, F.regexp_replace(x, "^0", "")).otherwise(x)
        y, m, d = F.substring(new, 1, 4), plain(F.substring(new, 6, 2)), plain(F.substring(new, 9, 2))
        joined = lambda *xs: F.concat(xs[0], mark, xs[1], mark, xs[2])
        text = F.when(year_first, joined(y, m, d)).when(month_first, joined(m, d, y)).otherwise(joined(d, m, y))
        return F.when(new.isNull(), hit).otherwise(text)

    new = _let(F.datediff(F.try_to_date(iso, "yyyy-MM-dd"), F.lit(_FIRST_DAY).cast("date")), moved)
    return _let(new, written)


def _shift(chars: Column, stream: Column) -> Column:
    """Letters and digits moved within their class by the bytes of a hexadecimal stream."""

    def moved(c: Column, i: Column) -> Column:
        by = F.conv(F.substring(stream, (i * 2) % 64 + 1, F.lit(2)), 16, 10).cast("int")
        turn = lambda first, n: F.chr((F.ascii(c) - first + by) % n + first)
        return (
            F.when(c.rlike("[a-z]"), turn(97, 26)).when(c.rlike("[A-Z]"), turn(65, 26)).when(c.rlike("[0-9]"), turn(48, 10)).otherwise(c)
        )

    return F.array_join(F.transform(F.filter(F.split(chars, ""), lambda c: c != ""), moved), "")


def _email(hit: Column, key: str) -> Column:
    name, domain = F.substring_index(hit, "@", 1), F.substring_index(hit, "@", -1)
    u = F.floor(F.length(name) / 2).cast("int")
    stream = lambda i, other: F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), i.cast("string"), F.lower(domain), other), 256)
    halves = F.aggregate(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)),
        F.struct(F.substring(name, F.lit(1), u).alias("l"), F.substring(name, u + 1, F.length(name)).alias("r")),
        lambda a, i: F.struct(
            F.when(i % 2 == 0, _shift(a["l"], stream(i, a["r"]))).otherwise(a["l"]).alias("l"),
            F.when(i % 2 == 1, _shift(a["r"], stream(i, a["l"]))).otherwise(a["r"]).alias("r"),
        ),
    )
    return _let(halves, lambda h: F.concat(h["l"], h["r"], F.lit("@"), domain))


_MAKERS = {"email": _email, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone}


def _kind(hit: Column) -> Column:
    found = F.lit(None).cast("string")
    for kind in reversed(PATTERNS):
        found = F.when(hit.rlike(f"^(?:{PATTERNS[kind]})$"), F.lit(kind)).otherwise(found)
    return found


def _replaced(kind: Column, hit: Column, numbers: Column, key: str) -> Column:
    new = F.when(kind == "number", _number(hit, numbers, key)).otherwise(hit)
    for name, maker in _MAKERS.items():
        new = F.when(kind == name, maker(hit, key)).otherwise(new)
    return new


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """struct column ``row`` of the input and, beside it, the new text and a count per kind.

    Whoever has the key can compute the pseudonyms back; keep it out of the code.
    """
    if not key:
        raise ValueError("a key is needed")
    text = F.col("text")
    base = rows(docs, docs["text"].cast("string").alias("text"))
    hits = F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(_ANY), F.lit(0)))
    found = base.withColumn("hits", F.coalesce(hits, F.array().cast("array<string>")))
    found = found.withColumn("kinds", F.transform("hits", _kind))
    none = F.array().cast("array<struct<at:int,n:int>>")
    found = found.withColumn("numbers", F.zip_with("kinds", "hits", lambda k, h: F.when(k == "number", _numbers(h)).otherwise(none)))
    steps = F.arrays_zip("kinds", "hits", "numbers")
    new = F.transform(steps, lambda x: _replaced(x["kinds"], x["hits"], x["numbers"], key))
    joined = F.array_join(
        F.zip_with(F.split(text, _ANY, -1), new, lambda gap, x: F.concat(gap, F.coalesce(x, F.lit("")))), ""
    )
    count = lambda kind: F.size(F.filter("kinds", lambda k: k == kind)).cast("long")
    total = F.aggregate("numbers", F.lit(0), lambda a, x: a + F.size(x)).cast("long")
    counts = [(total if kind == "number" else count(kind)).alias(f"n_{kind}") for kind in PATTERNS]
    return found.select("row", F.when(F.size("hits") > 0, joined).otherwise(text).alias("text"), *counts)


def replace_text(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with the text replaced and all other columns as they were."""
    new = pseudonymise(docs, key)
    return new.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs, TEST_KEY).select("row.doc_id", "text", *[f"n_{kind}" for kind in PATTERNS])
