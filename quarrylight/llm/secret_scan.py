"""Secret scan with ownership frequencies, in DataFrame functions only.

Three base kinds are found in every whole text. The method adds a fourth: ``opaque``,
unbroken runs of 20 or more token characters with lower case, upper case and a digit. All
candidates are hashed and counted over the corpus by distinct owners (``source``) and
repositories (a document of an owner). A value that many owners or repositories hold is a
copied example; the others look live. An opaque run is reported unless it is an example;
base spans always are.

Frequencies are summed in three steps with partial sums in the tasks (distinct holders,
holders per owner, owners), so a value in a third of all rows meets no single task; the
verdicts return by a join that Spark may split. Null text is empty. A null doc_id or source
counts as one value. Rows with equal doc_id and text are one repository and get equal
results each. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylight.llm.common import same, staged, table, text_hash, whole

#: Fixed patterns of the base kinds, in their listed order, then the added one: (kind, pattern, group).
_WORD = "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
KINDS = (
    ("assign", _WORD + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2),
    ("access", "AKIA[A-Z0-9]+", 0),
    ("hex", "[0-9a-f]{32,}", 0),
    ("opaque", "[A-Za-z0-9+/_-]{20,}", 0),
)
#: A value with as many owners, or as many repositories, is a copied example.
EXAMPLE_OWNERS, EXAMPLE_REPOS = 3, 10
_BLOCK = 256


def _spans(text: Column, number: int, pattern: str, group: int) -> Column:
    """All matches as (start, kind number, end, value); code points, end exclusive.

    Spark has no positions of matches, so they are summed from the pieces between matches,
    in blocks: the work grows with the matches, not with their square.
    """
    p = F.lit(pattern)
    steps = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, p, F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, p, F.lit(group)).alias("value"),
    )
    steps = F.filter(steps, lambda x: x["hit"].isNotNull())
    size = lambda x: F.length(x["gap"]) + F.length(x["hit"])
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / _BLOCK).cast("int")),
        lambda b: F.slice(steps, b * _BLOCK + 1, _BLOCK),
    )
    totals = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda a, x: a + size(x)))
    before = F.aggregate(
        totals,
        F.array(F.lit(0)),
        lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)),
    )
    empty = F.from_json(F.lit("[]"), "array<struct<start:int,kind:int,end:int,value:string>>")

    def place(block: Column, at: Column) -> Column:
        return F.aggregate(
            block,
            F.struct(at.alias("at"), empty.alias("out")),
            lambda a, x: F.struct(
                (a["at"] + size(x)).alias("at"),
                F.concat(
                    a["out"],
                    F.array(
                        F.struct(
                            (a["at"] + F.length(x["gap"])).alias("start"),
                            F.lit(number).alias("kind"),
                            (a["at"] + size(x)).alias("end"),
                            x["value"].alias("value"),
                        )
                    ),
                ).alias("out"),
            ),
            lambda a: a["out"],
        )

    found = F.flatten(F.zip_with(blocks, F.slice(before, 1, F.size(blocks)), place))
    return F.when(text.rlike(pattern), found).otherwise(empty)


def _passes(x: Column) -> Column:
    mixed = x["value"].rlike("[a-z]") & x["value"].rlike("[A-Z]") & x["value"].rlike("[0-9]")
    return (
        ((x["kind"] == 0) & (F.length(x["value"]) >= 8))
        | ((x["kind"] == 1) & (F.length(x["value"]) >= 16))
        | (x["kind"] == 2)
        | ((x["kind"] == 3) & mixed)
    )


def candidates(docs: DataFrame, owner: str = "source") -> DataFrame:
    """doc_id, owner, hash of the text, and its spans with hashed values, by place."""
    text = F.col("text")
    found = docs.select("doc_id", F.col(owner).alias("owner"), text_hash().alias("hash"), whole().alias("text"))
    found = found.select(
        "doc_id", "owner", "hash",
        *[_spans(text, i, p, g).alias(kind) for i, (kind, p, g) in enumerate(KINDS)],
    )
    spans = F.array_sort(F.filter(F.concat(*[F.col(kind) for kind, _, _ in KINDS]), _passes))
    hashed = F.transform(
        spans,
        lambda x: F.struct(
            x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"),
            F.sha2(x["value"], 256).alias("digest"),
        ),
    )
    return found.select("doc_id", "owner", "hash", hashed.alias("spans"))


def ownership(found: DataFrame, owners: int = EXAMPLE_OWNERS, repos: int = EXAMPLE_REPOS) -> DataFrame:
    """digest, n_owners, n_repos and whether the value is a copied example."""
    return (
        found.select("owner", "doc_id", F.explode("spans.digest").alias("digest"))
        .distinct()
        .groupBy("digest", "owner").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("digest").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_repos"))
        .withColumn("example", (F.col("n_owners") >= owners) | (F.col("n_repos") >= repos))
    )


def _joined(spans: Column) -> Column:
    kinds = F.array(*[F.lit(kind) for kind, _, _ in KINDS])
    part = lambda x: F.concat_ws(":", F.element_at(kinds, x["kind"] + 1), x["start"], x["end"])
    return F.array_join(F.transform(spans, part), ",")


def scan(docs: DataFrame, owner: str = "source") -> DataFrame:
    """Base counts and digest, all spans, and how many distinct values look live, per row."""
    found = staged(candidates(docs, owner), "secrets")
    held = found.select("doc_id", "hash", F.explode("spans.digest").alias("digest")).distinct()
    verdicts = (
        held.join(ownership(found), "digest")
        .groupBy("doc_id", "hash")
        .agg(
            F.collect_set(F.when(F.col("example"), F.col("digest"))).alias("examples"),
            F.count_if(~F.col("example")).alias("n_live"),
        )
    )
    has, none = found.filter(F.size("spans") > 0), found.filter(F.size("spans") == 0)
    has = has.join(verdicts, same(has, verdicts, "doc_id", "hash"), "left").select(
        has["doc_id"], "spans", "examples", "n_live"
    )
    none = none.select("doc_id", "spans", F.array().cast("array<string>").alias("examples"), F.lit(0).cast("long").alias("n_live"))
    base = F.filter("spans", lambda x: x["kind"] < 3)
    kept = F.filter("spans", lambda x: (x["kind"] < 3) | ~F.array_contains("examples", x["digest"]))
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    return has.unionByName(none).select(
        "doc_id",
        count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(kept).alias("spans"),
        "n_live",
        F.size("examples").cast("long").alias("n_examples"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    parts = []
    for i, (kind, pattern, group) in enumerate(KINDS):
        quoted = pattern.replace("'", "''")
        parts.append(
            f"SELECT doc_id, source, {i} AS kind, regexp_split_to_array(text, '{quoted}') AS gaps, "
            f"regexp_extract_all(text, '{quoted}', 0) AS hits, regexp_extract_all(text, '{quoted}', {group}) AS vals "
            f"FROM t WHERE regexp_matches(text, '{quoted}')"
        )
    union = " UNION ALL ".join(parts)
    return rf"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
r AS ({union}),
x AS (SELECT doc_id, source, kind, generate_subscripts(hits, 1) AS i, unnest(hits) AS hit, unnest(vals) AS val,
        unnest(gaps[1:len(hits)]) AS gap FROM r),
p AS (SELECT doc_id, source, kind, val, length(hit) AS n,
        sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop FROM x),
s AS (SELECT doc_id, source, kind, (stop - n)::BIGINT AS start, stop::BIGINT AS stop, sha256(val) AS digest FROM p
      WHERE kind = 2 OR (kind = 0 AND length(val) >= 8) OR (kind = 1 AND length(val) >= 16)
        OR (kind = 3 AND regexp_matches(val, '[a-z]') AND regexp_matches(val, '[A-Z]') AND regexp_matches(val, '[0-9]'))),
o AS (SELECT digest, count(DISTINCT source) AS owners, count(DISTINCT doc_id) AS repos FROM s GROUP BY digest),
c AS (SELECT s.*, (owners >= {EXAMPLE_OWNERS} OR repos >= {EXAMPLE_REPOS}) AS example,
        ['assign', 'access', 'hex', 'opaque'][kind + 1] || ':' || start || ':' || stop AS part FROM s JOIN o USING (digest)),
g AS (SELECT doc_id, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS k, count(*) FILTER (kind = 2) AS h,
        string_agg(part, ',' ORDER BY start, kind) FILTER (kind < 3) AS base,
        string_agg(part, ',' ORDER BY start, kind) FILTER (kind < 3 OR NOT example) AS alls,
        count(DISTINCT digest) FILTER (NOT example) AS live, count(DISTINCT digest) FILTER (example) AS ex
      FROM c GROUP BY doc_id)
SELECT t.doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(alls, '') AS spans,
  coalesce(live, 0) AS n_live, coalesce(ex, 0) AS n_examples
FROM t LEFT JOIN g USING (doc_id)
"""


SQL = _sql()
