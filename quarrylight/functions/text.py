"""Text cleaning, all as JVM-side column expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

# Names of the header lines that are dropped from a document.
HEADER_NAMES = (
    "From", "Subject", "Message-ID", "Date", "Organization", "Lines",
    "NNTP", "Path", "Xref", "References", "In-Reply-To",
)
# Documents that clean to this many characters or fewer carry the
# placeholder text instead.
SHORT_TEXT_CHARS = 30
SHORT_TEXT = "unknown topic"
# Fixed value: shortest token.
MIN_TOKEN_CHARS = 3

# (?d): only \n ends a line. (?U): Unicode white space. The separators U+001C to
# U+001F count as white space too, which Java's \s leaves out.
_NON_SPACE = r"[^\s\x1c-\x1f]"
_HEADER_LINE = r"(?dimU)^(?:" + "|".join(HEADER_NAMES) + r"):.*$"
_QUOTED_LINE = r"(?dm)^>.*$"
# A match always begins where a token begins, so other offsets are not tried; this
# keeps the backtracking linear on very long tokens.
_EMAIL = rf"(?U)(?<!{_NON_SPACE}){_NON_SPACE}+@{_NON_SPACE}+\.{_NON_SPACE}+"
_URL = rf"(?U)https?://{_NON_SPACE}+|www\.{_NON_SPACE}+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value``, which is computed once per row.

    A plain expression that is used several times, above all inside a lambda, may be
    recomputed for each use when projections are merged; a lambda variable is not.
    """
    return F.get(F.transform(F.array(value), body), 0)


def _letters_only(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "[^a-zA-Z]+", " "))


def _replace_where(text: Column, needles: Sequence[str], pattern: str, by: str) -> Column:
    """Replace the pattern in texts that hold one of the fixed strings it needs."""

    def replace(t: Column) -> Column:
        present = F.lit(False)
        for needle in needles:
            present = present | F.contains(t, F.lit(needle))
        return F.when(present, F.regexp_replace(t, pattern, by)).otherwise(t)

    return let(text, replace)


def strip_document(text: Column) -> Column:
    """Drop headers, quoted lines, e-mails and URLs."""
    text = F.coalesce(text, F.lit(""))
    text = _replace_where(text, [":"], _HEADER_LINE, "")
    text = _replace_where(text, [">"], _QUOTED_LINE, "")
    text = _replace_where(text, ["@"], _EMAIL, " ")
    return _replace_where(text, ["://", "www."], _URL, " ")


def clean_document(text: Column) -> Column:
    """Drop headers, quoted lines, e-mails and URLs; keep lower-case letters."""
    return F.lower(_letters_only(strip_document(text)))


def clean_query(text: Column) -> Column:
    """The served cleaning: lower case, letters only."""
    return _letters_only(F.lower(F.coalesce(text, F.lit(""))))


def or_placeholder(cleaned: Column) -> Column:
    """Replace a text that is too short to describe anything."""
    return let(cleaned, lambda c: F.when(F.length(c) > SHORT_TEXT_CHARS, c).otherwise(F.lit(SHORT_TEXT)))
