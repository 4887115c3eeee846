"""Independent DuckDB SQL for every registered query.

The tables ``documents orders lineitem ...`` are views over the same parquet
files.  The SQL restates each operator's semantics directly (it shares no
code with the Spark side); the k-means oracles unroll every pass as a
materialised CTE with a "stopped" flag, so they follow the exact stop rule.
"""

from __future__ import annotations

from quarry.operators.kmeans import ClusterParams
from quarry.operators.qa import BLOCKS_PER_PART
from quarry.plans import fixtures as fx


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# ----------------------------------------------------------------- keywords

_KW_VALUES = ", ".join(f"({_q(k)})" for k in fx.ARTICLE_KEYWORDS)

_HITS = f"""
kw(keyword) AS (VALUES {_KW_VALUES}),
toks AS (SELECT doc_id, unnest(list_distinct(string_split(text, ' '))) AS tok FROM documents),
hits AS (SELECT t.doc_id, k.keyword FROM toks t JOIN kw k ON t.tok = k.keyword),
articles AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS title, text FROM documents)
"""

KEYWORD_OCCURRENCES = f"""
SELECT {_q(fx.SINGLE_KEYWORD)} AS keyword,
       count(*) FILTER (WHERE list_contains(string_split(text, ' '), {_q(fx.SINGLE_KEYWORD)})) AS n_articles
FROM documents
"""

KEYWORD_RANK_SCAN = f"""
WITH {_HITS}
SELECT k.keyword, count(h.doc_id) AS n_articles
FROM kw k LEFT JOIN hits h ON h.keyword = k.keyword
GROUP BY k.keyword
"""

KEYWORD_INDEX = f"""
WITH {_HITS}
SELECT h.keyword, a.title, a.text FROM hits h JOIN articles a ON a.doc_id = h.doc_id
"""

KEYWORD_INDEX_GROUPED = f"""
WITH {_HITS}
SELECT h.keyword, CAST(h.doc_id // {fx.INDEX_BLOCK_SIZE} AS BIGINT) AS block,
       count(*) AS n_articles, string_agg(a.title, ',' ORDER BY h.doc_id) AS titles
FROM hits h JOIN articles a ON a.doc_id = h.doc_id
GROUP BY h.keyword, block
"""

KEYWORD_RANK_FROM_HITS = f"""
WITH {_HITS}
SELECT keyword, count(*) AS n_articles FROM hits GROUP BY keyword
"""

PROGRAM_KEYWORDS = KEYWORD_RANK_FROM_HITS.replace(
    "string_split(text, ' ')", f"string_split(translate(text, chr(10) || chr(13), '{fx.NEWLINE_MARK * 2}'), ' ')")

KEYWORD_PAIR_COUNTS = f"""
WITH {_HITS},
ordered AS (SELECT keyword, row_number() OVER () AS at FROM kw)
SELECT a.keyword, b.keyword AS other, count(*) AS n_articles
FROM hits a JOIN hits b ON a.doc_id = b.doc_id
JOIN ordered x ON x.keyword = a.keyword JOIN ordered y ON y.keyword = b.keyword AND x.at < y.at
GROUP BY ALL
"""

KEYWORD_CONJUNCTION = "SELECT CAST(doc_id AS VARCHAR) AS title FROM documents WHERE " + " AND ".join(
    f"list_contains(string_split(text, ' '), {_q(k)})" for k in fx.CONJUNCTION_KEYWORDS)

TAGGED_LINE_PARSE = "SELECT CAST(doc_id AS VARCHAR) AS title, text FROM documents"

# ----------------------------------------------------------------- postings

_POSTINGS = """
postings AS (
  SELECT 1 AS postingType, CAST(o_orderkey AS BIGINT) AS id, CAST(NULL AS BIGINT) AS acceptedAnswer,
         CAST(NULL AS BIGINT) AS parentId, 0 AS score, o_orderpriority AS tags
  FROM orders
  UNION ALL
  SELECT 2, CAST(l_orderkey * 10 + l_linenumber AS BIGINT), NULL, CAST(l_orderkey AS BIGINT),
         CAST(floor(l_extendedprice) AS INTEGER) - 30000, NULL
  FROM lineitem
)"""

_SCORED = _POSTINGS + """,
q AS (
  SELECT id, first(tags ORDER BY tags NULLS FIRST, score) AS tags,
         first(score ORDER BY tags NULLS FIRST, score) AS score
  FROM postings WHERE postingType = 1 GROUP BY id
),
best AS (
  SELECT parentId, max(score) AS best FROM postings
  WHERE postingType = 2 AND parentId IS NOT NULL GROUP BY parentId
),
scored AS (
  SELECT q.id, q.tags, q.score, greatest(best.best, 0) AS high_score
  FROM q JOIN best ON q.id = best.parentId
)"""

POSTINGS_PARSE = f"WITH {_POSTINGS} SELECT * FROM postings"

QUESTION_ANSWER_PAIRS = """
SELECT CAST(o_orderkey AS BIGINT) AS question_id, CAST(NULL AS BIGINT) AS question_accepted_answer, 0 AS question_score,
       o_orderpriority AS question_tags, CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS answer_id,
       CAST(floor(l_extendedprice) AS INTEGER) - 30000 AS answer_score
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
"""

QUESTION_ANSWER_BLOCKS = f"""
WITH pairs AS (
  SELECT CAST(o_orderkey AS BIGINT) AS question_id, CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS answer_id,
         CAST(floor(l_extendedprice) AS INTEGER) - 30000 AS answer_score
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
parts AS (SELECT question_id, CAST(ceil(count(*) / ({fx.ANSWER_BLOCK_SIZE} * {BLOCKS_PER_PART})) AS BIGINT) AS parts FROM pairs GROUP BY question_id),
dealt AS (
  SELECT p.*, ('0x' || substr(md5(CAST(answer_id AS VARCHAR)), 1, 8))::BIGINT % parts AS part FROM pairs p JOIN parts USING (question_id)),
placed AS (
  SELECT *, CAST((row_number() OVER (PARTITION BY question_id, part ORDER BY answer_id, answer_score) - 1) // {fx.ANSWER_BLOCK_SIZE} AS INTEGER) AS block FROM dealt)
SELECT question_id, part, block, count(*) AS n_answers, string_agg(CAST(answer_id AS VARCHAR), ',' ORDER BY answer_id) AS answers,
       max(answer_score) AS best
FROM placed GROUP BY question_id, part, block
"""

QUESTION_HIGH_SCORES = f"WITH {_SCORED} SELECT id, tags, score, high_score FROM scored"


def _vectors_cte(spread: int, name: str = "vectors", keywords=tuple(fx.CLUSTER_KEYWORDS)) -> str:
    case = "CASE tags " + " ".join(f"WHEN {_q(k)} THEN {i}" for i, k in enumerate(keywords)) + " END"
    return f"""
{name} AS (
  SELECT id, CAST(({case}) * {spread} AS INTEGER) AS x, high_score AS y
  FROM scored WHERE ({case}) IS NOT NULL
)"""


def _order_key(seed: int) -> str:
    return f"md5('{seed}' || CAST(id AS VARCHAR)), id"


def tag_vectors_sql() -> str:
    return f"WITH {_SCORED}, {_vectors_cte(fx.CLUSTER_SPREAD)} SELECT id, x, y FROM vectors"


def stratified_sample_sql(per: int, seed: int = 42) -> str:
    return f"""
WITH {_SCORED}, {_vectors_cte(fx.CLUSTER_SPREAD)}
SELECT id, x, y, rank FROM (
  SELECT id, x, y, CAST(row_number() OVER (PARTITION BY x ORDER BY {_order_key(seed)}) AS INTEGER) AS rank
  FROM vectors
) WHERE rank <= {per}
"""


def simple_sample_sql(n: int, seed: int = 42) -> str:
    return f"""
WITH {_SCORED}, {_vectors_cte(fx.SIMPLE_SAMPLE_SPREAD)}
SELECT id, x, y, rank FROM (
  SELECT id, x, y, CAST(row_number() OVER (ORDER BY {_order_key(seed)}) AS INTEGER) AS rank FROM vectors
) WHERE rank <= {n}
"""


def _means0(per: int, seed: int) -> str:
    return f"""
sampled AS (
  SELECT x, y, row_number() OVER (PARTITION BY x ORDER BY {_order_key(seed)}) AS rk FROM vectors
),
m0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY x, rk) - 1 AS INTEGER) AS idx,
         CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y, false AS stopped
  FROM sampled WHERE rk <= {per}
)"""


def _sq(a: str, b: str) -> str:
    return f"CAST({a} - {b} AS DOUBLE) * CAST({a} - {b} AS DOUBLE)"


def _assign(means: str, live_only: bool) -> str:
    dist = f"{_sq('v.x', 'm.x')} + {_sq('v.y', 'm.y')}"
    where = "WHERE NOT m.stopped" if live_only else ""
    return f"""SELECT v.id, v.x, v.y, CAST(first(m.idx ORDER BY {dist}, m.idx) AS INTEGER) AS idx
  FROM vectors v, {means} m {where} GROUP BY v.id, v.x, v.y"""


def _passes(n: int, eta: float) -> str:
    parts = []
    for i in range(1, n + 1):
        p = f"m{i - 1}"
        parts.append(f"""
a{i} AS ({_assign(p, live_only=True)}),
s{i} AS (SELECT idx, sum(x) AS sx, sum(y) AS sy, count(*) AS n FROM a{i} GROUP BY idx),
t{i} AS MATERIALIZED (
  SELECT u.*, {_sq('u.new_x', 'u.old_x')} + {_sq('u.new_y', 'u.old_y')} AS move FROM (
    SELECT p.idx, p.x AS old_x, p.y AS old_y, p.stopped AS was_stopped,
           CASE WHEN p.stopped OR s.n IS NULL THEN p.x ELSE CAST(s.sx // s.n AS BIGINT) END AS new_x,
           CASE WHEN p.stopped OR s.n IS NULL THEN p.y ELSE CAST(s.sy // s.n AS BIGINT) END AS new_y
    FROM {p} p LEFT JOIN s{i} s ON p.idx = s.idx
  ) u
),
m{i} AS MATERIALIZED (
  SELECT idx, new_x AS x, new_y AS y, was_stopped OR (sum(move) OVER () < {float(eta)!r}) AS stopped
  FROM t{i}
)""")
    return ",".join(parts)


def _kmeans_ctes(spread: int, kernels: int, eta: float, passes: int, seed: int = 42, scored: str = _SCORED,
                 keywords=tuple(fx.CLUSTER_KEYWORDS)) -> str:
    per = kernels // len(keywords)
    return f"WITH {scored}, {_vectors_cte(spread, keywords=keywords)}, {_means0(per, seed)}, {_passes(passes, eta)}"


def nearest_assignment_sql(kernels: int, seed: int = 42) -> str:
    per = kernels // len(fx.CLUSTER_KEYWORDS)
    return f"""
WITH {_SCORED}, {_vectors_cte(fx.CLUSTER_SPREAD)}, {_means0(per, seed)}
SELECT id, x, y, idx AS cluster FROM ({_assign('m0', live_only=False)})
"""


def kmeans_means_sql(spread: int, kernels: int, eta: float, passes: int) -> str:
    return _kmeans_ctes(spread, kernels, eta, passes) + f"\nSELECT idx, x, y FROM m{passes}"


def kmeans_trace_sql(spread: int, kernels: int, eta: float, passes: int) -> str:
    selects = [
        f"SELECT {i} AS iteration, idx, old_x, old_y, new_x, new_y, move, sum(move) OVER () AS total "
        f"FROM t{i} WHERE NOT was_stopped"
        for i in range(1, passes + 1)
    ]
    body = "\nUNION ALL\n".join(selects)
    return _kmeans_ctes(spread, kernels, eta, passes) + f"\nSELECT * FROM (\n{body}\n)"


def _summary_body(spread: int, passes: int, keywords=tuple(fx.CLUSTER_KEYWORDS)) -> str:
    label = "CASE dom_x // {s} ".format(s=spread) + " ".join(
        f"WHEN {i} THEN {_q(k)}" for i, k in enumerate(keywords)
    ) + " END"
    return f""",
fin AS ({_assign(f'm{passes}', live_only=False)}),
per_kw AS (SELECT idx AS cluster, x, count(*) AS n FROM fin GROUP BY idx, x),
dom AS (
  SELECT cluster, first(x ORDER BY n DESC, x) AS dom_x, max(n) AS dom_n, sum(n) AS size
  FROM per_kw GROUP BY cluster
),
med AS (SELECT idx AS cluster, quantile_cont(y, 0.5) AS median FROM fin GROUP BY idx),
summary AS (
  SELECT {label} AS lang_label,
         CAST(dom_n AS DOUBLE) * 100.0 / CAST(size AS DOUBLE) AS lang_percent,
         CAST(dom_n // size AS DOUBLE) * 100.0 AS lang_percent_int,
         CAST(size AS BIGINT) AS cluster_size,
         CAST(trunc(median) AS INTEGER) AS median_score
  FROM dom JOIN med USING (cluster)
)"""


def cluster_summary_sql(spread: int, kernels: int, passes: int, eta: float = 0.0) -> str:
    return _kmeans_ctes(spread, kernels, eta, passes) + _summary_body(spread, passes) + "\nSELECT * FROM summary"


def default_clusters_sql() -> str:
    """The clustering program with its own keywords, spread, kernels, eta and pass limit."""
    p = ClusterParams()
    tags = [*p.keywords, *fx.UNLISTED_TAGS]
    tag = f"CASE CAST(o_orderkey AS BIGINT) % {len(tags)} " + " ".join(f"WHEN {i} THEN {_q(t)}" for i, t in enumerate(tags)) + " END"
    scored = _SCORED.replace("0 AS score, o_orderpriority AS tags", f"0 AS score, {tag} AS tags")
    ctes = _kmeans_ctes(p.spread, p.kernels, p.eta, p.max_iterations, p.seed, scored, p.keywords)
    return ctes + _summary_body(p.spread, p.max_iterations, p.keywords) + "\nSELECT * FROM summary"


def cluster_report_sql(spread: int, kernels: int, passes: int) -> str:
    return (
        _kmeans_ctes(spread, kernels, 0.0, passes)
        + _summary_body(spread, passes)
        + "\nSELECT printf('%7d  %-17s (%-5.1f%%)      %7d', median_score, lang_label, lang_percent_int, cluster_size)"
        + " AS line, median_score FROM summary"
    )


# ----------------------------------------------------------------- diary

_DIARY = """
li AS (
  SELECT l_orderkey,
    sum(CASE WHEN l_linenumber = 1 THEN l_quantity ELSE 0.0 END) AS t010101,
    sum(CASE WHEN l_linenumber = 2 THEN l_quantity ELSE 0.0 END) AS t030101,
    sum(CASE WHEN l_linenumber = 3 THEN l_quantity ELSE 0.0 END) AS t050101,
    sum(CASE WHEN l_linenumber = 4 THEN l_quantity ELSE 0.0 END) AS t180101,
    sum(CASE WHEN l_linenumber = 5 THEN l_quantity ELSE 0.0 END) AS t180501,
    sum(CASE WHEN l_linenumber = 6 THEN l_quantity ELSE 0.0 END) AS t020101,
    sum(CASE WHEN l_linenumber = 7 THEN l_quantity ELSE 0.0 END) AS t189999,
    count(*) AS n
  FROM lineitem GROUP BY l_orderkey
),
diary AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS tucaseid,
    CAST(1 + o.o_orderkey % 5 AS DOUBLE) AS telfs,
    CAST(1 + o.o_custkey % 2 AS DOUBLE) AS tesex,
    CAST(10 + o.o_orderkey % 70 AS DOUBLE) AS teage,
    CAST(coalesce(li.t010101, 0) AS DOUBLE) AS t010101,
    CAST(coalesce(li.t030101, 0) AS DOUBLE) AS t030101,
    CAST(coalesce(li.t050101, 0) AS DOUBLE) AS t050101,
    CAST(coalesce(li.t180101, 0) AS DOUBLE) AS t180101,
    CAST(coalesce(li.t180501, 0) AS DOUBLE) AS t180501,
    CAST(coalesce(li.t020101, 0) AS DOUBLE) AS t020101,
    CAST(coalesce(li.t189999, 0) AS DOUBLE) AS t189999,
    CAST(coalesce(li.n, 0) AS DOUBLE) AS t500101
  FROM orders o LEFT JOIN li ON o.o_orderkey = li.l_orderkey
)"""

_SUMMARY = _DIARY + """,
summary AS (
  SELECT
    CASE WHEN telfs >= 1 AND telfs < 3 THEN 'working' ELSE 'not working' END AS working,
    CASE WHEN tesex = 1 THEN 'male' ELSE 'female' END AS sex,
    CASE WHEN teage >= 15 AND teage <= 22 THEN 'young'
         WHEN teage >= 23 AND teage <= 55 THEN 'active' ELSE 'elder' END AS age,
    (t010101 + t030101 + t180101) / 60 AS primaryNeeds,
    (t050101 + t180501) / 60 AS work,
    (t020101 + t189999) / 60 AS other
  FROM diary WHERE telfs <= 4
)"""

DIARY_READ = f"WITH {_DIARY} SELECT * FROM diary"

_COLUMN_CLASSES = [
    ("t010101", "primary", 4), ("t030101", "primary", 5), ("t050101", "work", 6), ("t180101", "primary", 7),
    ("t180501", "work", 8), ("t020101", "other", 9), ("t189999", "other", 10),
]

DIARY_COLUMN_HOURS = f"WITH {_DIARY}" + " UNION ALL ".join(
    f" SELECT '{name}' AS name, '{kind}' AS class, {at} AS position, sum({name}) / 60 AS hours FROM diary" for name, kind, at in _COLUMN_CLASSES
)

DIARY_SUMMARY = f"WITH {_SUMMARY} SELECT * FROM summary"

DIARY_GROUPED = f"""
WITH {_SUMMARY}
SELECT working, sex, age,
       round(avg(primaryNeeds), 1) AS primaryNeeds,
       round(avg(work), 1) AS work,
       round(avg(other), 1) AS other
FROM summary GROUP BY working, sex, age
"""


def oracle_sql() -> dict[str, str]:
    k = fx.CLUSTER_KERNELS
    per = k // len(fx.CLUSTER_KEYWORDS)
    conv = fx.cluster_params()
    return {
        "keyword_occurrences": KEYWORD_OCCURRENCES,
        "keyword_rank_scan": KEYWORD_RANK_SCAN,
        "keyword_index": KEYWORD_INDEX,
        "keyword_index_grouped": KEYWORD_INDEX_GROUPED,
        "keyword_rank_index": KEYWORD_RANK_FROM_HITS,
        "keyword_rank_combined": KEYWORD_RANK_FROM_HITS,
        "keyword_rank_bitmaps": KEYWORD_RANK_FROM_HITS,
        "keyword_pair_counts": KEYWORD_PAIR_COUNTS,
        "keyword_conjunction": KEYWORD_CONJUNCTION,
        "tagged_line_parse": TAGGED_LINE_PARSE,
        "postings_parse": POSTINGS_PARSE,
        "postings_file_scan": POSTINGS_PARSE,
        "question_answer_pairs": QUESTION_ANSWER_PAIRS,
        "question_answer_spread": QUESTION_ANSWER_PAIRS,
        "question_answer_blocks": QUESTION_ANSWER_BLOCKS,
        "question_high_scores": QUESTION_HIGH_SCORES,
        "tag_vectors": tag_vectors_sql(),
        "stratified_sample": stratified_sample_sql(per),
        "simple_sample": simple_sample_sql(k),
        "nearest_assignment": nearest_assignment_sql(k),
        "kmeans_fixed": kmeans_means_sql(fx.CLUSTER_SPREAD, k, 0.0, fx.FIXED_PASSES),
        "kmeans_converged": kmeans_means_sql(fx.CLUSTER_SPREAD, k, conv.eta, conv.max_iterations),
        "kmeans_trace": kmeans_trace_sql(fx.CLUSTER_SPREAD, k, conv.eta, conv.max_iterations),
        "cluster_summary": cluster_summary_sql(fx.SUMMARY_SPREAD, k, fx.FIXED_PASSES),
        "cluster_report": cluster_report_sql(fx.SUMMARY_SPREAD, k, fx.FIXED_PASSES),
        "diary_read": DIARY_READ,
        "diary_column_hours": DIARY_COLUMN_HOURS,
        "diary_summary": DIARY_SUMMARY,
        "diary_summary_typed": DIARY_SUMMARY,
        "diary_grouped": DIARY_GROUPED,
        "diary_grouped_sql": DIARY_GROUPED,
        "diary_grouped_typed": DIARY_GROUPED,
        "program_keywords": PROGRAM_KEYWORDS,
        "program_clusters": cluster_summary_sql(fx.SUMMARY_SPREAD, k, conv.max_iterations, conv.eta),
        "program_clusters_default": default_clusters_sql(),
        "program_diary": DIARY_GROUPED,
    }
