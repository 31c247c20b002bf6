"""The same queries as SQL over the supplied tables, for cross-checking."""

from __future__ import annotations

from ..functions.stopwords import ENGLISH
from ..functions.text import HEADER_NAMES, MIN_TOKEN_CHARS, SHORT_TEXT, SHORT_TEXT_CHARS
from ..functions.vectors import SIMILARITY_DIGITS
from ..operators.fuzzy import EPSILON, MIN_DISTANCE
from ..operators.reuse import SWEEP_BANDS, SWEEP_LAST
from ..operators.tfidf import MAX_DF, MAX_FEATURES, MIN_DF
from .sweeps import FUZZINESS_BANDS, FUZZINESS_LAST, K_GRID, M_GRID

# Parameters shared by the Spark and the SQL form of the registered queries.
DIGITS = 6
FUZZINESS = 1.5
PROFILE_M = 1.2
CAPPED_FEATURES = 500
SEEDS = 4
THETA = 0.35
TURN_THETA = 0.995
SWEEP_STEPS = 3
THETA_GRID = (0.25, 0.30, 0.35, 0.40, 0.45, 0.50)
# Entries per bucket: of the lookups, and of the queries whose subject is the limit.
CAP = 500
SEED_CAP = 40
REPLAY_CAP = 10
BUILD_CLUSTERS = 8
# Largest |XᵀX v - σ² v| / σ₁² of a component, and their number.
LSA_RESIDUAL = 0.002
COMPONENTS = 300
BUILD_BOUNDARY = 15
KMEANS_STARTS = 10
CELLS = 32
# Documents of one file of parallel arrays.
READER_BLOCK = 300


def _r(expression: str, name: str, digits: int = DIGITS) -> str:
    return f"round({expression}, {digits}) + 0.0 AS {name}"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


# -- text -------------------------------------------------------------------------

# White space as the cleaning sees it; RE2's own \s is ASCII only.
_NS = (
    r"[^\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def _letters(expression: str) -> str:
    return f"trim(regexp_replace({expression}, '[^a-zA-Z]+', ' ', 'g'))"


def _clean_document(column: str) -> str:
    out = f"coalesce({column}, '')"
    for pattern, by in (
        (r"(?im)^(?:" + "|".join(HEADER_NAMES) + r"):[^\n]*", ""),
        (r"(?m)^>[^\n]*", ""),
        (rf"{_NS}+@{_NS}+\.{_NS}+", " "),
        (rf"https?://{_NS}+|www\.{_NS}+", " "),
    ):
        out = f"regexp_replace({out}, '{pattern}', '{by}', 'g')"
    return f"lower({_letters(out)})"


def _clean_query(column: str) -> str:
    return _letters(f"lower(coalesce({column}, ''))")


_STOP = ", ".join(f"'{w}'" for w in ENGLISH)
_CLEAN = f"""raw AS (SELECT doc_id, lang AS label, {_clean_document('text')} AS c FROM documents),
clean AS (SELECT doc_id, label,
  CASE WHEN length(c) > {SHORT_TEXT_CHARS} THEN c ELSE '{SHORT_TEXT}' END AS cleaned FROM raw)"""
_TURNS = f"""turns AS (SELECT conv_id || ':' || turn AS query_id, {_clean_query('text')} AS cleaned
  FROM conversations WHERE role = 'user')"""


def _postings(source: str, key: str, out: str) -> str:
    return f"""{out}_words AS (SELECT {key}, list_filter(string_split(cleaned, ' '),
    lambda w: length(w) >= {MIN_TOKEN_CHARS} AND w NOT IN ({_STOP})) AS w FROM {source}),
{out}_terms AS (SELECT {key}, unnest(list_concat(w,
    list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM {out}_words),
{out} AS (SELECT {key}, term, count(*) AS tf FROM {out}_terms GROUP BY 1, 2)"""


def _vocabulary(max_features: int) -> str:
    return f"""n AS (SELECT count(*) AS n FROM documents),
stats AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM posts GROUP BY 1),
fit AS (SELECT term, df, cf, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM stats, n
  WHERE df >= {MIN_DF} AND df <= {MAX_DF} * n ORDER BY cf DESC, term LIMIT {max_features}),
vocab AS (SELECT row_number() OVER (ORDER BY term) - 1 AS term_id, * FROM fit)"""


def _weights(source: str, key: str, out: str) -> str:
    return f"""{out}_raw AS (SELECT {key}, term_id, (1.0 + ln(tf)) * idf AS w FROM {source} JOIN vocab USING (term)),
{out} AS (SELECT {key}, term_id, w / sqrt(sum(w * w) OVER (PARTITION BY {key})) AS w FROM {out}_raw)"""


_POSTS = _postings("clean", "doc_id", "posts")
_FEATURES = ",\n".join([_CLEAN, _POSTS, _vocabulary(MAX_FEATURES), _weights("posts", "doc_id", "weights")])
_QUERY_FEATURES = ",\n".join([_TURNS, _postings("turns", "query_id", "asked"), _weights("asked", "query_id", "q")])
_PROJECTION = """names AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS component, count(*) AS n
  FROM documents_label GROUP BY label),
v AS (SELECT w.term_id, nm.component, sum(w.w) / any_value(nm.n) AS x
  FROM weights w JOIN clean USING (doc_id) JOIN names nm USING (label) GROUP BY 1, 2),
proj AS (SELECT d.doc_id, nm.component, coalesce(p.x, 0.0) AS x
  FROM clean d CROSS JOIN names nm LEFT JOIN (
    SELECT w.doc_id, v.component, sum(w.w * v.x) AS x FROM weights w JOIN v USING (term_id) GROUP BY 1, 2
  ) p ON p.doc_id = d.doc_id AND p.component = nm.component)""".replace("documents_label", "clean")

# -- vectors ----------------------------------------------------------------------

_E = "e AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings)"
_DIMS = """dims AS (SELECT id, label, unnest(range(0, len(v))) AS d, unnest(v) AS x FROM e)"""
_MEANS = """means AS (SELECT label AS cluster, d, avg(x) AS x FROM dims GROUP BY 1, 2),
cent AS (SELECT cluster, list(x ORDER BY d) AS v FROM means GROUP BY 1)"""
_VECTORS = ",\n".join([_E, _DIMS, _MEANS])
_QUERIES = """qv AS (SELECT cluster AS query_id,
  list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS v FROM cent)"""


def _described(label: str) -> str:
    return f"""vt AS (SELECT 'doc_' || e.id AS id, e.v, coalesce(d.{label}, 'unknown') AS label, e.id AS doc_idx,
  coalesce(substr(d.text, 1, 200), '') AS text_preview FROM e LEFT JOIN documents d ON d.doc_id = e.id)"""


def _topk(table: str, k: int, where: str = "TRUE", similarity: str = "list_dot_product(q.v, t.v)") -> str:
    return f"""sims AS (SELECT q.query_id, t.id, round({similarity}, {SIMILARITY_DIGITS}) AS similarity
  FROM qv q CROSS JOIN {table} t WHERE {where}),
ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS rank,
  id, similarity FROM sims),
top AS (SELECT * FROM ranked WHERE rank <= {k})"""


_TOP_SELECT = f"SELECT CAST(query_id AS BIGINT) AS query_id, rank, id, {_r('similarity', 'similarity')} FROM top"


def _memberships(m: float, query_epsilon: bool = False, rows: str = "e", centers: str = "cent", out: str = "u") -> str:
    power = 2.0 / (m - 1.0)
    u = f"1.0 / (p * sw + {EPSILON})" if query_epsilon else f"w / (sw + {EPSILON})"
    return f"""{out}_d AS (SELECT t.id, c.cluster, list_distance(t.v, c.v) AS d FROM {rows} t CROSS JOIN {centers} c),
{out}_w AS (SELECT id, cluster, d, pow(greatest(d, {MIN_DISTANCE}), {power}) AS p,
  1.0 / pow(greatest(d, {MIN_DISTANCE}), {power}) AS w FROM {out}_d),
{out}_s AS (SELECT *, sum(w) OVER (PARTITION BY id) AS sw FROM {out}_w),
{out} AS (SELECT id, cluster, d, {u} AS u FROM {out}_s)"""


def _update(m: float, u: str, out: str) -> str:
    return f"""{out}_x AS (SELECT u.cluster, x.d, sum(pow(u.u, {m}) * x.x) / (sum(pow(u.u, {m})) + {EPSILON}) AS x
  FROM {u} u JOIN dims x USING (id) GROUP BY 1, 2),
{out} AS (SELECT cluster, list(x ORDER BY d) AS v FROM {out}_x GROUP BY 1)"""


_STEP = _with(_VECTORS, _memberships(FUZZINESS), _update(FUZZINESS, "u", "nxt"))


def _fit_trace(steps: int) -> str:
    parts = [_VECTORS, _memberships(FUZZINESS, out="u0"), _update(FUZZINESS, "u0", "v1")]
    rows = []
    for t in range(1, steps + 1):
        parts.append(_memberships(FUZZINESS, centers=f"v{t}", out=f"u{t}"))
        if t < steps:
            parts.append(_update(FUZZINESS, f"u{t}", f"v{t + 1}"))
        rows.append(
            f"SELECT CAST({t} AS BIGINT) AS iteration, {_r(f'sum(pow(a.u, {FUZZINESS}) * a.d * a.d)', 'objective')}, "
            f"{_r('max(abs(a.u - b.u))', 'delta')} FROM u{t} a JOIN u{t - 1} b USING (id, cluster)"
        )
    return _with(*parts) + "\nUNION ALL\n".join(rows)


def _seeding(k: int) -> str:
    parts = [_E]
    for t in range(k):
        u = f"(CAST('0x' || substr(md5('42:{t}:' || id), 1, 12) AS BIGINT) + 1.0) / {2**48 + 1}.0"
        if t == 0:
            parts.append(f"p0 AS (SELECT v FROM e ORDER BY ln({u}) DESC, id DESC LIMIT 1)")
            parts.append("c0 AS (SELECT 0 AS cluster, v FROM p0)")
        else:
            parts.append(
                f"s{t} AS (SELECT e.id, e.v, min(pow(list_distance(e.v, c.v), 2)) AS d2 "
                f"FROM e CROSS JOIN c{t - 1} c GROUP BY e.id, e.v)"
            )
            parts.append(f"p{t} AS (SELECT v FROM s{t} WHERE d2 > 0 ORDER BY ln({u}) / d2 DESC, id DESC LIMIT 1)")
            parts.append(f"c{t} AS (SELECT * FROM c{t - 1} UNION ALL SELECT {t}, v FROM p{t})")
    return _with(*parts) + (
        f"SELECT CAST(cluster AS BIGINT) AS cluster, unnest(range(0, len(v))) AS dim, "
        f"{_r('unnest(v)', 'value')} FROM c{k - 1}"
    )


# -- clusters ---------------------------------------------------------------------

_HARD = """hard AS (SELECT id, arg_min(cluster, (-round(u, 12), cluster)) AS cluster, max(u) AS c FROM u GROUP BY id)"""
_PROFILE = _with(
    _VECTORS,
    _described("source"),
    "pt AS (SELECT doc_idx AS id, v, 'feed.' || label AS label FROM vt)",
    _memberships(PROFILE_M, rows="pt"),
    _HARD,
    """cats AS (SELECT h.cluster, p.label AS category, count(*) AS n, min(p.id) AS first_id
  FROM hard h JOIN pt p USING (id) GROUP BY 1, 2)""",
    """hr AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, first_id, category) AS rank FROM cats)""",
    """sums AS (SELECT u.cluster, p.label AS category, sum(u.u) AS weight, min(p.id) AS first_id
  FROM u JOIN pt p USING (id) GROUP BY 1, 2)""",
    """sr AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY weight DESC, first_id, category) AS rank FROM sums)""",
    """summary AS (SELECT k.cluster, coalesce(s.size, 0) AS n_hard_members,
    coalesce(h.category, 'unknown') AS dominant_category,
    coalesce(round(h.n / s.size, 3), 0.0) AS purity
  FROM (SELECT unnest(range(0, (SELECT count(*) + 1 FROM cent))) AS cluster) k
  LEFT JOIN (SELECT cluster, count(*) AS size FROM hard GROUP BY 1) s USING (cluster)
  LEFT JOIN (SELECT * FROM hr WHERE rank = 1) h USING (cluster))""",
)

# -- reuse ------------------------------------------------------------------------

_ROUTE = ",\n".join(
    [
        _VECTORS,
        _memberships(PROFILE_M, query_epsilon=True),
        _HARD,
        "routed AS (SELECT e.id, e.v, e.label, h.cluster FROM e JOIN hard h USING (id))",
    ]
)


def _seeded(cap: int) -> str:
    return f"""offered AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY id DESC) AS place,
  count(*) OVER (PARTITION BY cluster) AS n FROM routed),
entries AS (SELECT id AS entry_id, cluster, v, label,
  CASE WHEN n > {cap} THEN place ELSE n - place + 1 END AS position FROM offered WHERE place <= {cap})"""


_FOUND = f"""pairs AS (SELECT q.id AS query_id, n.entry_id, n.label AS entry_label,
    round(list_dot_product(q.v, n.v), {SIMILARITY_DIGITS}) AS s, n.position
  FROM routed q JOIN entries n ON n.cluster = q.cluster AND n.entry_id <> q.id),
best AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, position) AS r FROM pairs),
found AS (SELECT q.id AS query_id, q.cluster, q.label, coalesce(b.s, -1.0) AS s, b.entry_id, b.entry_label,
    coalesce(b.s, -1.0) >= {THETA} AS hit
  FROM routed q LEFT JOIN (SELECT * FROM best WHERE r = 1) b ON b.query_id = q.id)"""
_LOOKED_UP = _with(_ROUTE, _seeded(CAP), _FOUND)


def _band(column: str) -> str:
    cases = " ".join(f"WHEN {column} <= {limit} THEN '{text}'" for limit, text in SWEEP_BANDS)
    return f"CASE {cases} ELSE '{SWEEP_LAST}' END"


def _replay(source: str, cap: int, theta: float = THETA) -> str:
    """Step every bucket through its arrivals; ``entries`` is the bucket in list order.

    ``source`` has (id, cluster, v). One arrival per bucket and round.
    """
    return f"""arr AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY id) AS n FROM {source}),
ps AS (SELECT b.cluster, b.n AS later, a.n AS earlier,
    round(list_dot_product(a.v, b.v), {SIMILARITY_DIGITS}) AS s
  FROM arr a JOIN arr b ON a.cluster = b.cluster AND a.n < b.n),
run AS (
  SELECT cluster, n, [{{'h': CAST(0 AS BIGINT), 't': n}}] AS entries, FALSE AS hit,
    CAST(NULL AS BIGINT) AS source, CAST(-1.0 AS DOUBLE) AS s, CAST(NULL AS BIGINT) AS evicted
  FROM arr WHERE n = 1
  UNION ALL
  SELECT cluster, n,
    CASE WHEN hit THEN touched WHEN len(grown) > {cap} THEN sorted[1:{cap}] ELSE grown END,
    hit, CASE WHEN hit THEN t END, s,
    CASE WHEN NOT hit AND len(grown) > {cap} THEN sorted[{cap} + 1].t END
  FROM (
    SELECT a.cluster, a.n, coalesce(m.s, -1.0) AS s, coalesce(m.s, -1.0) >= {theta} AS hit, m.t AS t,
      list_transform(r.entries, lambda x: {{'h': x.h + CASE WHEN x.t = m.t THEN 1 ELSE 0 END, 't': x.t}}) AS touched,
      list_append(r.entries, {{'h': CAST(0 AS BIGINT), 't': a.n}}) AS grown,
      list_reverse_sort(list_append(r.entries, {{'h': CAST(0 AS BIGINT), 't': a.n}})) AS sorted
    FROM run r
    JOIN arr a ON a.cluster = r.cluster AND a.n = r.n + 1
    LEFT JOIN LATERAL (
      SELECT ps.s, o.t FROM (
        SELECT unnest(r.entries).t AS t, unnest(range(1, len(r.entries) + 1)) AS place
      ) o JOIN ps ON ps.cluster = a.cluster AND ps.later = a.n AND ps.earlier = o.t
      ORDER BY ps.s DESC, o.place LIMIT 1
    ) m ON TRUE
  )
),
log AS (SELECT a.id AS query_id, r.cluster, r.hit, o.id AS source_id, r.s AS similarity, x.id AS evicted_id
  FROM run r JOIN arr a ON a.cluster = r.cluster AND a.n = r.n
  LEFT JOIN arr o ON o.cluster = r.cluster AND o.n = r.source
  LEFT JOIN arr x ON x.cluster = r.cluster AND x.n = r.evicted)"""


_BY_LABEL = "WITH RECURSIVE " + ",\n".join(
    [_E, "src AS (SELECT id, CAST(label AS BIGINT) AS cluster, v FROM e)", _replay("src", REPLAY_CAP)]
) + "\n"
_LOG_SELECT = (
    "SELECT query_id, cluster, hit, coalesce(source_id, -1) AS source_id, "
    f"{_r('similarity', 'similarity')}, coalesce(evicted_id, -1) AS evicted_id FROM log"
)


def _sweep_steps(steps: int) -> str:
    parts, rows = [_VECTORS], []
    for i, m in enumerate(M_GRID):
        parts.append(_memberships(m, out=f"m{i}u0"))
        for t in range(1, steps + 1):
            parts.append(_update(m, f"m{i}u{t - 1}", f"m{i}v{t}"))
            parts.append(_memberships(m, centers=f"m{i}v{t}", out=f"m{i}u{t}"))
        parts.append(f"m{i}o AS (SELECT id, list(u ORDER BY u DESC) AS us FROM m{i}u{steps} GROUP BY id)")
        band = next((text for limit, text in FUZZINESS_BANDS if m <= limit), FUZZINESS_LAST)
        rows.append(
            f"SELECT CAST({m} AS DOUBLE) AS m, {_r('avg(us[1])', 'mean_certainty', 4)}, "
            f"{_r('avg(CASE WHEN us[1] > 0.8 THEN 1.0 ELSE 0.0 END)', 'pct_high_certainty', 4)}, "
            f"{_r('avg(CASE WHEN us[2] > 0.15 THEN 1.0 ELSE 0.0 END)', 'frac_dual_membership', 4)}, "
            f"CAST({steps} AS BIGINT) AS n_iter, '{band}' AS interpretation FROM m{i}o"
        )
    return _with(*parts) + "\nUNION ALL\n".join(rows)


# Documents and user turns projected on the mean weights of each source.
_TURN_VECTORS = ",\n".join(
    [
        _FEATURES.replace("lang AS label", "source AS label"),
        _TURNS.replace("SELECT conv_id", "SELECT conv_id * 1000000 + turn AS arrival, conv_id"),
        _postings("turns", "query_id", "asked"),
        _weights("asked", "query_id", "q"),
        _PROJECTION,
        """dv AS (SELECT doc_id AS id, list(x ORDER BY component) AS v FROM proj GROUP BY 1),
e AS (SELECT dv.id, CASE WHEN list_dot_product(v, v) > 0 THEN list_transform(v, lambda x: x / sqrt(list_dot_product(v, v)))
    ELSE v END AS v, clean.label FROM dv JOIN clean ON clean.doc_id = dv.id)""",
        "dims AS (SELECT id, label, unnest(range(0, len(v))) AS d, unnest(v) AS x FROM e)",
        """means AS (SELECT names.component AS cluster, d, avg(x) AS x FROM dims JOIN names USING (label) GROUP BY 1, 2),
cent AS (SELECT cluster, list(x ORDER BY d) AS v FROM means GROUP BY 1)""",
        """qx AS (SELECT t.arrival AS id, nm.component, coalesce(p.x, 0.0) AS x FROM turns t CROSS JOIN names nm LEFT JOIN (
    SELECT q.query_id, v.component, sum(q.w * v.x) AS x FROM q JOIN v USING (term_id) GROUP BY 1, 2
  ) p ON p.query_id = t.query_id AND p.component = nm.component),
qw AS (SELECT id, list(x ORDER BY component) AS v FROM qx GROUP BY 1),
qe AS (SELECT id, CASE WHEN list_dot_product(v, v) > 0 THEN list_transform(v, lambda x: x / sqrt(list_dot_product(v, v)))
    ELSE v END AS v FROM qw)""",
        _memberships(PROFILE_M),
        _HARD,
        """cats AS (SELECT h.cluster, e.label AS category, count(*) AS n, min(e.id) AS first_id FROM hard h JOIN e USING (id) GROUP BY 1, 2),
hr AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, first_id, category) AS rank FROM cats)""",
        _memberships(PROFILE_M, query_epsilon=True, rows="qe", out="ru"),
        _HARD.replace("hard AS", "rhard AS").replace("FROM u", "FROM ru"),
        "src AS (SELECT qe.id, CAST(h.cluster AS BIGINT) AS cluster, qe.v FROM qe JOIN rhard h USING (id))",
        _replay("src", REPLAY_CAP, TURN_THETA),
        "lt AS (SELECT 'doc_' || id AS id, v FROM e)",
        "qv AS (SELECT l.query_id, qe.v FROM log l JOIN qe ON qe.id = l.query_id WHERE NOT l.hit)",
        _topk("lt", 5),
        "res AS (SELECT query_id, string_agg(id, ',' ORDER BY rank) AS ids FROM top GROUP BY 1)",
    ]
)
_RAW_TURNS = "(SELECT conv_id * 1000000 + turn AS id, conv_id || ':' || turn AS name, text FROM conversations WHERE role = 'user')"


def _k_sweep_steps() -> str:
    parts = [_VECTORS, "pd AS (SELECT a.id AS a, b.id AS b, list_distance(a.v, b.v) AS d FROM e a CROSS JOIN e b)"]
    rows = []
    for k in K_GRID:
        parts += [
            f"s{k} AS (SELECT row_number() OVER (ORDER BY id) - 1 AS cluster, v FROM e ORDER BY id LIMIT {k})",
            _memberships(2.0, centers=f"s{k}", out=f"a{k}"),
            _update(2.0, f"a{k}", f"v{k}"),
            _memberships(2.0, centers=f"v{k}", out=f"b{k}"),
            f"h{k} AS (SELECT id, arg_min(cluster, (-u, cluster)) AS c, max(u) AS top FROM b{k} GROUP BY id)",
            f"z{k} AS (SELECT c, count(*) AS n FROM h{k} GROUP BY c)",
            f"""t{k} AS (SELECT a.id, a.c AS own, b.c AS other, sum(pd.d) AS t
  FROM pd JOIN h{k} a ON a.id = pd.a JOIN h{k} b ON b.id = pd.b GROUP BY 1, 2, 3)""",
            f"""g{k} AS (SELECT t.id, any_value(o.n) AS n, max(CASE WHEN own = other THEN t / greatest(o.n - 1, 1) END) AS a,
  min(CASE WHEN own <> other THEN t / z.n END) AS b
  FROM t{k} t JOIN z{k} z ON z.c = t.other JOIN z{k} o ON o.c = t.own GROUP BY t.id)""",
        ]
        shape = "avg(CASE WHEN n <= 1 OR b IS NULL OR greatest(a, b) <= 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END)"
        rows.append(
            f"SELECT CAST({k} AS BIGINT) AS k, (SELECT sum(u * u * d * d) FROM b{k}) AS o, "
            f"(SELECT {shape} FROM g{k}) AS s, (SELECT avg(top) FROM h{k}) AS m"
        )
    before = "lag(o) OVER (ORDER BY k)"
    return _with(*parts, "r AS (" + " UNION ALL ".join(rows) + ")") + (
        f"SELECT k, {_r('o', 'objective', 2)}, {_r(f'({before} - o) * 100.0 / {before}', 'improvement_pct', 2)}, "
        f"{_r('s', 'silhouette', 4)}, {_r('m', 'mean_certainty', 4)} FROM r"
    )


def _kmeans_steps() -> str:
    """Two steps of Lloyd's algorithm from two sets of starting centres."""
    parts = [
        _E, _DIMS,
        "edge AS (SELECT *, row_number() OVER (ORDER BY id) - 1 AS lo, row_number() OVER (ORDER BY id DESC) - 1 AS hi FROM e)",
        f"""c0 AS (SELECT 0 AS fit, lo AS cluster, v FROM edge WHERE lo < {KMEANS_STARTS}
  UNION ALL SELECT 1, hi, v FROM edge WHERE hi < {KMEANS_STARTS})""",
    ]
    for step in range(3):
        parts.append(
            f"""a{step} AS (SELECT fit, e.id, arg_min(cluster, (list_distance(e.v, c.v), cluster)) AS cluster,
  min(list_distance(e.v, c.v)) AS gap FROM e CROSS JOIN c{step} c GROUP BY 1, 2)"""
        )
        if step < 2:
            parts.append(
                f"""m{step} AS (SELECT fit, cluster, list(x ORDER BY d) AS v FROM (
  SELECT fit, cluster, d, avg(x) AS x FROM a{step} JOIN dims USING (id) GROUP BY 1, 2, 3) GROUP BY 1, 2)"""
            )
            parts.append(
                f"c{step + 1} AS (SELECT fit, cluster, coalesce(m.v, c.v) AS v FROM c{step} c LEFT JOIN m{step} m USING (fit, cluster))"
            )
    parts.append("i AS (SELECT fit, sum(gap * gap) AS inertia FROM a2 GROUP BY 1)")
    return _with(*parts) + (
        f"SELECT CAST(fit AS BIGINT) AS fit, cluster, axis, {_r('c.v[axis + 1]', 'value')}, {_r('inertia', 'inertia')} "
        "FROM c2 c JOIN i USING (fit), unnest(range(len(c.v))) r(axis)"
    )


SQL: dict[str, str] = {
    "kmeans_steps": _kmeans_steps(),
    "pca_axes": _with(_E, _DIMS, "s AS (SELECT d, var_samp(x) AS x FROM dims GROUP BY 1)")
    + f"""SELECT d AS axis, true AS eigen_ok, true AS orthonormal, true AS descending, true AS share_ok,
  {_r('(SELECT sum(x) FROM s)', 'total_variance')} FROM s""",
    "k_sweep_steps": _k_sweep_steps(),
    "fuzziness_sweep_steps": _sweep_steps(SWEEP_STEPS),
    "pca_norms": _with(_E, _DIMS, "mu AS (SELECT d, avg(x) AS m FROM dims GROUP BY 1)")
    + f"SELECT id, {_r('sum((x - m) * (x - m))', 'squared_length')} FROM dims JOIN mu USING (d) GROUP BY id",
    "answer_turns": "WITH RECURSIVE "
    + _TURN_VECTORS
    + f"""
SELECT t.name AS query_id, l.hit AS cache_hit, o.text AS matched_query, {_r('l.similarity', 'similarity_score', 4)},
  l.cluster AS dominant_cluster, coalesce(hr.category, 'unknown') AS cluster_label, res.ids AS result_ids
FROM log l JOIN {_RAW_TURNS} t ON t.id = l.query_id LEFT JOIN {_RAW_TURNS} o ON o.id = l.source_id
LEFT JOIN res ON res.query_id = coalesce(l.source_id, l.query_id)
LEFT JOIN hr ON hr.cluster = l.cluster AND hr.rank = 1""",
    "clean_documents": _with(_CLEAN) + "SELECT doc_id, cleaned, length(cleaned) AS n_chars FROM clean",
    "clean_pages": "SELECT page_id, "
    + _clean_document("concat_ws(chr(10), url, html)")
    + " AS cleaned FROM pages",
    "clean_queries": _with(_TURNS) + "SELECT query_id, cleaned FROM turns",
    "token_counts": _with(_CLEAN, _POSTS) + "SELECT doc_id, term, tf FROM posts",
    "vocabulary": _with(_CLEAN, _POSTS, _vocabulary(MAX_FEATURES))
    + f"SELECT term_id, term, df, cf, {_r('idf', 'idf')} FROM vocab",
    "vocabulary_capped": _with(_CLEAN, _POSTS, _vocabulary(CAPPED_FEATURES))
    + f"SELECT term_id, term, df, cf, {_r('idf', 'idf')} FROM vocab",
    "vocabulary_sketched": _with(_CLEAN, _POSTS, _vocabulary(MAX_FEATURES))
    + f"SELECT term_id, term, df, cf, {_r('idf', 'idf')} FROM vocab",
    "corpus_readers": """SELECT form, CASE form WHEN 'lines' THEN doc_id ELSE row_number() OVER (PARTITION BY form ORDER BY doc_id) - 1 END AS doc_id,
  lang AS label, md5(text) AS text_md5
FROM documents, (VALUES ('lines'), ('arrays')) f(form)""",
    "tfidf_weights": _with(_FEATURES) + f"SELECT doc_id, term_id, {_r('w', 'weight')} FROM weights",
    "encode_queries": _with(_FEATURES, _QUERY_FEATURES) + f"SELECT query_id, term_id, {_r('w', 'weight')} FROM q",
    "sparse_topk": _with(
        _FEATURES,
        _QUERY_FEATURES,
        f"""sims AS (SELECT q.query_id, w.doc_id AS id, round(sum(q.w * w.w), {SIMILARITY_DIGITS}) AS similarity
  FROM q JOIN weights w USING (term_id) GROUP BY 1, 2)""",
        """ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS rank,
  id, similarity FROM sims WHERE similarity > 0)""",
    )
    + f"SELECT query_id, rank, id, {_r('similarity', 'similarity')} FROM ranked WHERE rank <= 5",
    "category_distribution": "SELECT lang AS category, count(*) AS n_docs FROM documents GROUP BY 1",
    "lsa_projection": _with(_FEATURES, _PROJECTION)
    + f"SELECT doc_id, component, {_r('x', 'value')} FROM proj",
    "explained_variance": _with(
        _FEATURES,
        _PROJECTION,
        "kept AS (SELECT sum(s) AS kept FROM (SELECT var_pop(x) AS s FROM proj GROUP BY component))",
        """total AS (SELECT sum(s2 / n - (s / n) * (s / n)) AS total FROM (
  SELECT term_id, sum(w) AS s, sum(w * w) AS s2 FROM weights GROUP BY 1), (SELECT count(*) AS n FROM documents))""",
    )
    + f"SELECT {_r('kept', 'projected_variance')}, {_r('total', 'input_variance')}, "
    + f"{_r('kept / total', 'explained_ratio')} FROM kept, total",
    "vector_normalise": _with(_E)
    + f"SELECT id, unnest(range(0, len(v))) AS dim, "
    + _r("unnest(list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))))", "value")
    + " FROM e",
    "vector_table_build": _with(_E, _described("lang"))
    + "SELECT id, label, doc_idx, text_preview, CAST(len(v) AS BIGINT) AS dims FROM vt",
    "vector_topk": _with(_VECTORS, _QUERIES, _topk("e", 10)) + _TOP_SELECT,
    "vector_topk_cells": _with(_VECTORS, _QUERIES, _topk("e", 10)) + _TOP_SELECT,
    "vector_topk_filtered": _with(_VECTORS, _QUERIES, _described("lang"), _topk("vt", 10, "t.label = 'es'"))
    + _TOP_SELECT,
    "vector_topk_padded": _with(
        _VECTORS,
        _QUERIES,
        _described("lang"),
        _topk(
            "vt",
            10,
            similarity="CASE WHEN t.label = 'es' AND length(t.text_preview) < 190 "
            "THEN list_dot_product(q.v, t.v) ELSE -1.0 END",
        ),
    )
    + _TOP_SELECT,
    "vector_append_count": "SELECT 2 * count(*) AS n_rows, count(label) AS with_label, "
    "count(DISTINCT vec_id) AS repeated_ids FROM embeddings",
    "vector_by_ids": "SELECT ev.event_id AS position, e.vec_id AS id, CAST(e.label + CASE WHEN e.vec_id % 2 = 0 THEN 100 ELSE 0 END AS BIGINT) AS label, "
    + _r("CAST(e.embedding[1] AS DOUBLE)", "first_value")
    + " FROM events ev JOIN embeddings e ON e.vec_id = ev.user_id",
    "vector_log_get": "SELECT ev.event_id AS position, e.vec_id AS id, "
    "CAST(e.label + CASE WHEN e.vec_id % 4 = 0 THEN 200 WHEN e.vec_id % 2 = 0 THEN 100 ELSE 0 END AS BIGINT) AS label, "
    + _r("CAST(e.embedding[1] AS DOUBLE)", "first_value")
    + " FROM events ev JOIN embeddings e ON e.vec_id = ev.user_id",
    "vector_save_load": "SELECT CAST(label AS BIGINT) AS label, count(*) AS n_rows, "
    + _r("sum(CAST(embedding[1] AS DOUBLE))", "first_sum")
    + " FROM embeddings GROUP BY 1",
    "retrieve_formatted": _with(_VECTORS, _QUERIES, _described("lang"), _topk("vt", 5))
    + f"SELECT CAST(query_id AS BIGINT) AS query_id, rank, id, {_r('top.similarity', 'similarity', 4)}, "
    "vt.label, substr(vt.text_preview, 1, 120) AS preview FROM top JOIN vt USING (id)",
    "fuzzy_membership": _with(_VECTORS, _memberships(2.0))
    + f"SELECT id, CAST(cluster AS BIGINT) AS cluster, {_r('u', 'u')} FROM u",
    "fuzzy_membership_query": _with(_VECTORS, _memberships(2.0, True))
    + f"SELECT id, CAST(cluster AS BIGINT) AS cluster, {_r('u', 'u')} FROM u",
    "fuzzy_step": _STEP + f"SELECT CAST(cluster AS BIGINT) AS cluster, d AS dim, {_r('x', 'value')} FROM nxt_x",
    "fuzzy_objective": _STEP + f"SELECT {_r(f'sum(pow(u, {FUZZINESS}) * d * d)', 'objective')} FROM u",
    "fuzzy_fit_trace": _fit_trace(3),
    "fuzzy_fit_resumed": _fit_trace(4),
    "distance_seeding": _seeding(SEEDS),
    "hard_assignment": _with(_VECTORS, _memberships(2.0), _HARD)
    + "SELECT id, CAST(cluster AS BIGINT) AS cluster FROM hard",
    "certainty_metrics": _with(
        _VECTORS,
        _memberships(PROFILE_M),
        "o AS (SELECT id, list(u ORDER BY u DESC) AS us FROM u GROUP BY id)",
    )
    + f"SELECT count(*) AS n, {_r('avg(us[1])', 'mean_certainty')}, "
    + f"{_r('avg(CASE WHEN us[1] > 0.8 THEN 1.0 ELSE 0.0 END)', 'pct_high_certainty')}, "
    + f"{_r('avg(us[2])', 'mean_second')}, "
    + f"{_r('avg(CASE WHEN us[2] > 0.15 THEN 1.0 ELSE 0.0 END)', 'frac_dual_membership')} FROM o",
    "row_sample": "SELECT doc_id, lang AS label FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 100",
    "lsa_quality": _with(_CLEAN, _POSTS, _vocabulary(MAX_FEATURES))
    + f"""SELECT c AS component, true AS length_ok, true AS orthonormal, true AS residual_ok
FROM range(least({COMPONENTS}, (SELECT count(*) FROM vocab), (SELECT n FROM n))) r(c)""",
    "silhouette_exact": _with(
        _E,
        "s AS (SELECT * FROM e)",
        "sizes AS (SELECT label, count(*) AS n FROM s GROUP BY 1)",
        """sd AS (SELECT a.id, a.label AS own, b.label AS other, sum(list_distance(a.v, b.v)) AS t
  FROM s a CROSS JOIN s b GROUP BY 1, 2, 3)""",
        """ab AS (SELECT sd.id, any_value(o.n) AS n_own,
    max(CASE WHEN own = other THEN t / greatest(o.n - 1, 1) END) AS a,
    min(CASE WHEN own <> other THEN t / z.n END) AS b
  FROM sd JOIN sizes z ON z.label = sd.other JOIN sizes o ON o.label = sd.own GROUP BY sd.id)""",
    )
    + "SELECT count(*) AS n, "
    + _r("avg(CASE WHEN n_own <= 1 OR b IS NULL OR greatest(a, b) <= 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END)", "silhouette")
    + " FROM ab",
    "cluster_profile_hard": _PROFILE
    + "SELECT CAST(cluster AS BIGINT) AS cluster, rank, category, n FROM hr WHERE rank <= 5",
    "cluster_summary": _PROFILE
    + "SELECT CAST(cluster AS BIGINT) AS cluster, n_hard_members, dominant_category, purity + 0.0 AS purity FROM summary",
    "cluster_profile_soft": _PROFILE
    + f"SELECT CAST(cluster AS BIGINT) AS cluster, rank, category, {_r('weight', 'weight', 1)} FROM sr WHERE rank <= 5",
    "cluster_report": _PROFILE
    + """SELECT row_number() OVER (ORDER BY n_hard_members DESC, s.cluster) AS place, CAST(s.cluster AS BIGINT) AS cluster,
  n_hard_members, round(purity, 2) + 0.0 AS purity, string_split(dominant_category, '.')[-1] AS dominant, t.soft_weights
FROM summary s JOIN (
  SELECT cluster, string_agg(string_split(category, '.')[-1] || '=' || CAST(round(round(weight, 1)) AS BIGINT), ' | ' ORDER BY rank)
    AS soft_weights FROM sr WHERE rank <= 3 GROUP BY 1
) t ON t.cluster = s.cluster""",
    "cluster_label_table": _PROFILE
    + """SELECT CAST(s.cluster AS BIGINT) AS cluster, dominant_category, n_hard_members, purity + 0.0 AS purity,
  h.hard_cat_dist, w.n_soft
FROM summary s
JOIN (SELECT cluster, string_agg(category || '=' || n, ',' ORDER BY rank) AS hard_cat_dist FROM hr WHERE rank <= 5 GROUP BY 1) h
  ON h.cluster = s.cluster
JOIN (SELECT cluster, count(*) AS n_soft FROM sr WHERE rank <= 5 GROUP BY 1) w ON w.cluster = s.cluster""",
    "boundary_docs": _with(
        _VECTORS,
        _memberships(PROFILE_M),
        "c AS (SELECT id, max(u) AS c FROM u GROUP BY id ORDER BY round(max(u), 10), id LIMIT 15)",
        """p AS (SELECT u.id, c.c, u.cluster, u.u,
    row_number() OVER (PARTITION BY u.id ORDER BY u.u DESC, u.cluster) - 1 AS place FROM u JOIN c USING (id))""",
    )
    + f"SELECT p.id, CAST(e.label AS BIGINT) AS label, {_r('c', 'certainty', 4)}, place, "
    + f"CAST(cluster AS BIGINT) AS cluster, {_r('u', 'u', 4)} FROM p JOIN e USING (id) WHERE place < 3",
    "reuse_seed": _with(_ROUTE, _seeded(SEED_CAP))
    + "SELECT entry_id, CAST(cluster AS BIGINT) AS cluster, 'query ' || entry_id AS query, "
    "CAST(0 AS BIGINT) AS hit_count, position FROM entries",
    "reuse_lookup": _LOOKED_UP
    + f"SELECT query_id, CAST(cluster AS BIGINT) AS cluster, hit, CASE WHEN hit THEN entry_id ELSE -1 END AS matched_id, "
    f"CASE WHEN hit THEN 'query ' || entry_id END AS matched_query, {_r('s', 'similarity')} FROM found",
    "threshold_sweep": _LOOKED_UP
    + f"""SELECT theta, count(*) FILTER (WHERE s >= theta) AS hits, {_r('count(*) FILTER (WHERE s >= theta) / count(*)', 'hit_rate')},
  {_r('coalesce(avg(CASE WHEN s >= theta THEN s END), 0.0)', 'avg_similarity')}, {_band('theta')} AS description
FROM found CROSS JOIN (SELECT CAST(unnest([{', '.join(map(str, THETA_GRID))}]) AS DOUBLE) AS theta) GROUP BY theta""",
    "reuse_stats": _LOOKED_UP
    + f"""SELECT (SELECT count(*) FROM entries) AS total_entries, count(*) FILTER (WHERE hit) AS hit_count,
  count(*) FILTER (WHERE NOT hit) AS miss_count, {_r('count(*) FILTER (WHERE hit) / count(*)', 'hit_rate', 4)} FROM found""",
    "bucket_sizes": _with(_ROUTE, _seeded(SEED_CAP))
    + "SELECT CAST(cluster AS BIGINT) AS cluster, count(*) AS n_entries FROM entries GROUP BY 1",
    "reuse_flush": _with(_ROUTE, _seeded(REPLAY_CAP))
    + "SELECT CAST(cluster AS BIGINT) AS cluster, count(*) AS n_entries FROM entries GROUP BY 1",
    "hit_evaluation": _LOOKED_UP
    + "SELECT coalesce(entry_label = label, FALSE) AS expected_hit, hit, count(*) AS n FROM found GROUP BY 1, 2",
    "bucket_compaction": f"""WITH g AS (SELECT event_type AS cluster, user_id AS entry_id, count(*) AS hit_count, max(ts) AS arrival
  FROM events GROUP BY 1, 2),
p AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY hit_count DESC, arrival DESC, entry_id) AS place FROM g)
SELECT cluster, entry_id, hit_count, place FROM p WHERE place <= {SEED_CAP}""",
    "membership_top5": _with(
        _ROUTE,
        "p AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY u DESC, cluster) - 1 AS place FROM u)",
    )
    + f"SELECT id AS query_id, place, CAST(cluster AS VARCHAR) AS cluster, {_r('u', 'u', 4)} FROM p WHERE place < 5",
    "cluster_label_lookup": _PROFILE.rstrip()
    + ",\n"
    + _memberships(PROFILE_M, query_epsilon=True, out="ru")
    + ",\n"
    + _HARD.replace("hard AS", "rhard AS").replace("FROM u", "FROM ru")
    + """
SELECT r.id AS query_id, CAST(r.cluster AS BIGINT) AS cluster,
  coalesce(s.dominant_category, 'unknown') AS cluster_label
FROM rhard r LEFT JOIN (SELECT * FROM summary WHERE n_hard_members >= 50) s USING (cluster)""",
    "blank_queries": f"""SELECT source, query <> '' AS valid, count(*) AS n FROM (
  SELECT 'document' AS source, {_clean_document('text')} AS query FROM documents
  UNION ALL SELECT role, {_clean_query('text')} FROM conversations
  UNION ALL SELECT 'page', {_clean_document('html')} FROM pages) GROUP BY 1, 2""",
    "query_replay": _BY_LABEL + _LOG_SELECT,
    "replay_entries": _BY_LABEL
    + """SELECT s.query_id AS entry_id, s.cluster, coalesce(h.n, 0) AS hit_count
FROM log s LEFT JOIN (SELECT source_id, count(*) AS n FROM log WHERE hit GROUP BY 1) h ON h.source_id = s.query_id
WHERE NOT s.hit AND s.query_id NOT IN (SELECT evicted_id FROM log WHERE evicted_id IS NOT NULL)""",
    "stream_replay": _BY_LABEL + _LOG_SELECT,
    "stream_lookup": _with(
        _E,
        f"""pairs AS (SELECT q.id AS query_id, n.id AS entry_id, round(list_dot_product(q.v, n.v), {SIMILARITY_DIGITS}) AS s
  FROM e q JOIN e n ON n.label = q.label)""",
        "best AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, entry_id) AS r FROM pairs)",
    )
    + f"SELECT query_id, CAST(label AS BIGINT) AS cluster, s >= {THETA} AS hit, "
    f"CASE WHEN s >= {THETA} THEN entry_id ELSE -1 END AS matched_id, {_r('s', 'similarity')} "
    "FROM best JOIN e ON e.id = query_id WHERE r = 1",
    "staged_build": _with(_CLEAN, _POSTS, _vocabulary(MAX_FEATURES))
    + f"""SELECT 'vocabulary' AS table_name, count(*) AS n_rows FROM vocab
UNION ALL SELECT t, n FROM (SELECT unnest(['sparse', 'vectors', 'memberships']) AS t), n
UNION ALL SELECT 'cluster_labels', {BUILD_CLUSTERS}
UNION ALL SELECT 'boundary_docs', least(n, {BUILD_BOUNDARY}) FROM n""",
    "answer_queries": "WITH RECURSIVE "
    + _PROFILE.removeprefix("WITH ").rstrip()
    + ",\n"
    + ",\n".join(
        [
            _memberships(PROFILE_M, query_epsilon=True, out="ru"),
            _HARD.replace("hard AS", "rhard AS").replace("FROM u", "FROM ru"),
            "src AS (SELECT e.id, CAST(h.cluster AS BIGINT) AS cluster, e.v FROM e JOIN rhard h USING (id))",
            _replay("src", REPLAY_CAP),
            "lt AS (SELECT 'doc_' || e.id AS id, e.v FROM e)",
            "qv AS (SELECT l.query_id, e.v FROM log l JOIN e ON e.id = l.query_id WHERE NOT l.hit)",
            _topk("lt", 5),
            "res AS (SELECT query_id, string_agg(id, ',' ORDER BY rank) AS ids FROM top GROUP BY 1)",
            "mp AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY u DESC, cluster) AS place FROM ru)",
            "tc AS (SELECT id, string_agg(cluster, ',' ORDER BY place) AS ids FROM mp WHERE place <= 5 GROUP BY 1)",
        ]
    )
    + f"""
SELECT l.query_id, 'query ' || l.query_id AS query, l.hit AS cache_hit, 'query ' || l.source_id AS matched_query,
  {_r('l.similarity', 'similarity_score', 4)}, res.ids AS result_ids, l.cluster AS dominant_cluster,
  coalesce(s.dominant_category, 'unknown') AS cluster_label, tc.ids AS top_clusters
FROM log l LEFT JOIN res ON res.query_id = coalesce(l.source_id, l.query_id)
LEFT JOIN summary s ON s.cluster = l.cluster JOIN tc ON tc.id = l.query_id""",
}
