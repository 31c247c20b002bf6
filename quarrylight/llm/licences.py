"""Licence scan by canonical digests, in DataFrame functions only.

Whole texts, and every line of them, are brought to one form: lower case, copyright lines
gone, punctuation as one space, equivalent spellings replaced. The SHA-256 of the form is
joined with the digests of known licences: full texts and notices ("Licensed under the
...") made from a rule, in the same form. So a match is the entire text or line. A full text
is known with and without its title and "All rights reserved", and the long ones, files in
``licence_texts``, also without their appendix and with earlier addresses of their publisher.

The known table has a fixed size and is broadcast; documents are never shuffled with their
text, only the few matches are. Null text is empty and matches nothing. Rows with equal
doc_id and text get equal results each. An empty table gives no rows. Extra columns are
not read.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylight.llm.common import same, staged, table, text_hash, whole

#: Fixed texts of short public licences, without their copyright lines.
_PERMISSION = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\n"
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the Software.\n\n"
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
    "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE "
    "SOFTWARE."
)
_ISC_END = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
    "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE."
)
_ISC_START = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_BSD_START = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer.\n\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution.\n\n"
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.\n\n"
)
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_APACHE_HEADER = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
    "the License. You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\n"
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
    "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
    "specific language governing permissions and limitations under the License."
)
TEXTS = {
    "MIT": _PERMISSION,
    "ISC": f"{_ISC_START}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_END}",
    "0BSD": f"{_ISC_START}.\n\n{_ISC_END}",
    "BSD-2-Clause": _BSD_START + _BSD_END,
    "BSD-3-Clause": _BSD_START + _BSD_NAMES + _BSD_END,
    "Apache-2.0": _APACHE_HEADER,
}
#: Titles that stand above the short texts; each text is known without one, too.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "0BSD License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "BSD License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "BSD License", "New BSD License"),
}
RESERVED = "All rights reserved."
#: Whole long texts by identifier, one file each, as their publishers give them.
LONG = Path(__file__).with_name("licence_texts")
_ADDRESS = r"51 Franklin St(?:reet)?, Fifth Floor,\s+Boston,\s+MA\s+02110-1301,?\s+USA"
ADDRESSES = (
    "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA", "51 Franklin St, Fifth Floor, Boston, MA 02110-1301 USA",
    "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA", "675 Mass Ave, Cambridge, MA 02139, USA",
)
#: Titles added above long texts that have none.
_HEADS = {"Unlicense": ("The Unlicense", "Unlicense")}
#: Where a long text ends if what tells how to apply it is left out.
_TERMS_END = re.compile(r"^\s*END OF TERMS AND CONDITIONS\s*$", re.MULTILINE)
_MORE = "For more information, please refer to <https://unlicense.org/>"
_FIELDS = re.compile(r"^[ \t]*Copyright (?:\[yyyy\]|\{yyyy\}).*$", re.MULTILINE)
#: Fixed names of licences in notices, by identifier.
NAMES = {
    "MIT": ("MIT License", "MIT"),
    "ISC": ("ISC License", "ISC"),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"),
    "MPL-2.0": ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0"),
    "GPL-2.0": ("GNU General Public License, Version 2", "GNU General Public License v2.0", "GPL v2"),
    "GPL-3.0": ("GNU General Public License, Version 3", "GNU General Public License v3.0", "GPL v3"),
    "LGPL-3.0": ("GNU Lesser General Public License, Version 3", "LGPL v3"),
    "AGPL-3.0": ("GNU Affero General Public License, Version 3", "AGPL v3"),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
}
PHRASES = ("licensed under", "released under", "distributed under", "available under", "published under", "provided under")
SUBJECTS = ("", "this work is", "this software is", "this file is", "this document is", "this text is", "this project is")
#: Fixed pairs of equivalent spellings, applied in this order to the spaced form.
SPELLINGS = (
    (r"\blicence", "license"),
    (r"\bsub license", "sublicense"),
    (r"\bnon (infringement|commercial)", "non$1"),
    (r"\bcopyright (owner|holder)s?\b", "copyright holder"),
    (r"\b(favour|behaviour|honour)", "favor"),
    (r"\b(organisation|authorisation|utilisation)", "organization"),
    (r"\bpercent\b", "per cent"),
    (r"\bhttps\b", "http"),
)


#: Copyright lines of lower-case text, which are no part of a licence: lines with a sign or a year behind the
#: word, or a sign of their own, and short paragraphs that begin with the word. Clauses marked (c) stay.
COPYRIGHT = (
    (r"(?m)^[^\p{L}\p{N}\n(©]*(?:copyright[ \t]+(?:©|\(c\)|[0-9])|©|\(c\)[ \t]*(?:copyright|©|[12][0-9]{3}))[^\n]{0,120}$", ""),
    (r"(\A|\n[ \t\r]*\n)[ \t]*copyright\b[^\n]{0,120}((?:\n[ \t]*all rights reserved[^\n]{0,20})?(?:\n[ \t\r]*\n|\z))", "$1$2"),
)


def canonical(text: Column) -> Column:
    """The text's form, with its line ends."""
    form = F.lower(text)
    for pattern, left in COPYRIGHT:
        form = F.regexp_replace(form, pattern, left)
    form = F.regexp_replace(form, r"[^\p{L}\p{N}\n]+", " ")
    for pattern, spelling in SPELLINGS:
        form = F.regexp_replace(form, pattern, spelling)
    return form


def _digest(form: Column) -> Column:
    return F.sha2(F.trim(F.regexp_replace(form, r"[ \n]+", " ")), 256)


def unwrapped(text: str) -> str:
    """The text with each paragraph on one line."""
    return "\n\n".join(" ".join(p.split()) for p in re.split(r"\n\s*\n", text))


def full_texts() -> list[tuple[str, str]]:
    """(licence, text) of all known whole texts, in each of their standard forms."""
    pairs = []
    for licence, text in TEXTS.items():
        bodies = {text, re.sub(r"(?m)^[0-9]\. ", "", text)}  # numbered, or with other marks
        heads = [f"{t}\n{r}\n" for t in ("", *TITLES.get(licence, ())) for r in ("", RESERVED)]
        pairs += [(licence, head + x) for x in sorted(bodies) for head in heads]
    for path in sorted(LONG.glob("*.txt")):
        text = path.read_text("utf-8")
        end = _TERMS_END.search(text)
        forms = {text, _FIELDS.sub("", text)}
        forms |= {text[: end.end()], text[: end.start()]} if end else set()
        forms |= {text.partition(_MORE)[0]}
        forms |= {re.sub(_ADDRESS, a, x) for x in forms for a in ADDRESSES}
        forms |= {f"{t}\n{x}" for x in forms for t in _HEADS.get(path.stem, ())}
        forms |= {unwrapped(x) for x in forms}
        pairs += [(path.stem, x) for x in sorted(forms)]
    return pairs


def known(spark: SparkSession) -> DataFrame:
    """digest and licence of all known texts and notices; a fixed number of rows."""
    pairs = full_texts()
    for licence, names in NAMES.items():
        for name in names:
            pairs += [(licence, f"{s} {p} {the}{name}") for s in SUBJECTS for p in PHRASES for the in ("", "the ")]
        pairs.append((licence, f"SPDX-License-Identifier: {licence}"))
    digests = spark.createDataFrame(pairs, "licence string, text string").select(_digest(canonical(F.col("text"))).alias("digest"), "licence")
    return digests.groupBy("digest").agg(F.min("licence").alias("licence"))


def matches(docs: DataFrame, licences: DataFrame) -> DataFrame:
    """doc_id, hash, line (-1 for the whole text) and licence of every match."""
    form = docs.select("doc_id", text_hash().alias("hash"), canonical(whole()).alias("form"))
    lines = F.transform(F.split("form", "\n"), lambda x, i: F.struct(i.alias("line"), F.trim(x).alias("form")))
    units = F.concat(F.array(F.struct(F.lit(-1).alias("line"), F.col("form").alias("form"))), lines)
    units = form.select("doc_id", "hash", F.explode(F.filter(units, lambda u: u["form"] != "")).alias("unit"))
    hashed = units.select("doc_id", "hash", "unit.line", _digest(F.col("unit.form")).alias("digest"))
    return hashed.join(F.broadcast(licences), "digest").select("doc_id", "hash", "line", "licence")


def scan(docs: DataFrame, licences: DataFrame | None = None) -> DataFrame:
    """Per row: the licence that its whole text is, and those named by its lines."""
    licences = known(docs.sparkSession) if licences is None else licences
    found = (
        matches(docs, licences)
        .groupBy("doc_id", "hash")
        .agg(
            F.max(F.when(F.col("line") < 0, F.col("licence"))).alias("text_licence"),
            F.array_join(F.array_sort(F.collect_set(F.when(F.col("line") >= 0, F.col("licence")))), ",").alias("line_licences"),
            F.size(F.collect_set(F.when(F.col("line") >= 0, F.col("line")))).cast("long").alias("n_lines"),
        )
    )
    found = staged(found, "licences")
    base = docs.select("doc_id", text_hash().alias("hash"))
    return base.join(found, same(base, found, "doc_id", "hash"), "left").select(
        base["doc_id"], "text_licence",
        F.coalesce("line_licences", F.lit("")).alias("line_licences"),
        F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    def form(text: str) -> str:
        out = f"lower({text})"
        for pattern, to in [*COPYRIGHT, (r"[^\p{L}\p{N}\n]+", " "), *SPELLINGS]:
            out = f"regexp_replace({out}, '{pattern}', '{to.replace('$', chr(92))}', 'g')"
        return out

    digest = lambda x: f"sha256(trim(regexp_replace({x}, '[ \\n]+', ' ', 'g')))"
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    texts = ", ".join(f"({quote(k)}, {quote(v)})" for k, v in TEXTS.items())
    names = ", ".join(f"({quote(k)}, {quote(v)})" for k, vs in NAMES.items() for v in vs)
    many = lambda xs: "(SELECT unnest([" + ", ".join(map(quote, xs)) + "]) AS v)"
    return f"""
WITH l(licence, text) AS (SELECT * FROM (VALUES {texts})
  UNION ALL SELECT n.k, s.v || ' ' || p.v || ' ' || t.v || n.name FROM (VALUES {names}) n(k, name), {many(SUBJECTS)} s, {many(PHRASES)} p, {many(['', 'the '])} t
  UNION ALL SELECT DISTINCT k, 'SPDX-License-Identifier: ' || k FROM (VALUES {names}) n(k, name)),
k AS (SELECT {digest(form('text'))} AS digest, min(licence) AS licence FROM l GROUP BY 1),
d AS (SELECT doc_id, {form("coalesce(text, '')")} AS form FROM documents),
u AS (SELECT doc_id, -1 AS line, form FROM d
  UNION ALL SELECT doc_id, generate_subscripts(ls, 1) AS line, unnest(ls) AS form FROM (SELECT doc_id, string_split(form, chr(10)) AS ls FROM d)),
m AS (SELECT doc_id, line, licence FROM u JOIN k ON k.digest = {digest('u.form')} WHERE trim(form) <> ''),
g AS (SELECT doc_id, max(licence) FILTER (line < 0) AS w, string_agg(DISTINCT licence, ',' ORDER BY licence) FILTER (line >= 0) AS ls,
  count(DISTINCT line) FILTER (line >= 0) AS n FROM m GROUP BY doc_id)
SELECT documents.doc_id, w AS text_licence, coalesce(ls, '') AS line_licences, coalesce(n, 0)::BIGINT AS n_lines
FROM documents LEFT JOIN g USING (doc_id)
"""


SQL = _sql()
