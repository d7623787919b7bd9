"""The registered queries of this subpackage and the SQL that states their results."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import alignment, fingerprint, licenses, mixing, pieces, quality, toxicity, vector_codes
from millrace.llm.chat import format_chats
from millrace.llm.decontaminate import contamination
from millrace.llm.exact_dedup import exact_duplicates
from millrace.llm.near_dedup import near_duplicates
from millrace.llm.url_filter import DAMPING, MARGIN, ROUNDS, SHARE, judge_urls

# Fixed rules of the query, longest first.
URL_RULES = {
    "www.example.com/en/": "allow", "example.com/en/": "block", "net/es/": "block", "net/fr/": "block", "com/": "allow"}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, percent=85)


def piece_model() -> str:
    """The piece model's file: SENTENCEPIECE_MODEL, or the public one of this machine."""
    return os.environ.get("SENTENCEPIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(_table(spark, sf_dir, "documents"), pieces.Vocabulary.load(piece_model()), check=True)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def _judged(scored: DataFrame, threshold: float) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


# Documents at or above this probability of being toxic are rejected, by operator 4 and by the pipeline.
TOXIC = 0.3


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return _judged(toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels"))), TOXIC)


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages"), URL_RULES).drop("trust", "distrust")


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(_table(spark, sf_dir, "conversations"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_table(spark, sf_dir, "documents"))


def domain_labels(labels: DataFrame) -> DataFrame:
    """Domains of the labelled rows: 0 poor, 1 good, 2 toxic; a null label is no label."""
    domain = F.when(F.col("toxic") > 0, 2).when(F.col("quality") > 0, 1).when(F.col("quality") <= 0, 0)
    return labels.select("doc_id", domain.alias("domain"))


# Shares of the tokens that poor, good and toxic texts are to have.
DOMAIN_WEIGHTS = [0.05, 0.9, 0.05]


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = mixing.fit_domains(docs, domain_labels(labels), 3)
    rates = mixing.mixing_rates(docs, model, DOMAIN_WEIGHTS)
    p = F.col("p")
    return rates.select("doc_id", "tokens", p[0].alias("p_poor"), p[1].alias("p_good"), p[2].alias("p_toxic"), "rate")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return _judged(quality.score(docs, quality.fit(docs, _table(spark, sf_dir, "labels"))), 0.7)


def op10_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_likeness(_table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(_table(spark, sf_dir, "embeddings"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("n_near_items")


def token_model() -> str:
    """The byte-level tokenizer's file: BYTE_LEVEL_MODEL, or the public one of this machine."""
    return os.environ.get("BYTE_LEVEL_MODEL", "/opt/tokenizers/byte_bpe_50k.json")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizers = alignment.Tokenizers.load(token_model(), piece_model())
    return alignment.align_tokens(_table(spark, sf_dir, "documents"), tokenizers).drop("a", "b")


QUERIES = {f.__name__: f for f in (
    op1_minhash_near_dedup, op2_sentencepiece, op3_license_scan, op4_toxicity, op5_url_filter, op6_chat_format,
    op7_exact_dedup, op8_mixing, op9_quality, op10_fingerprint, op11_vector_codes, op12_decontamination,
    op13_token_alignment)}


def _license_sql() -> str:
    """Sentences are put together from lines, one line at a time, as long as some known sentence begins that way."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    known = ", ".join(f"({quoted(licenses.normalised(s))}, {quoted(name)})" for name, s in licenses.SENTENCES.items())
    rules = ", ".join(f"({quoted(name)}, [{', '.join(map(quoted, rule))}])" for name, rule in licenses.RULES)
    space = r"[\x20\x09-\x0D]"
    return rf"""
WITH RECURSIVE k(s, id) AS (VALUES {known}),
r(license, ids) AS (VALUES {rules}),
t AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text FROM documents),
u AS (
  SELECT n, regexp_replace(regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ|/', 'abcdefghijklmnopqrstuvwxyz--'),
    '[.!?;:]{space}+', '|', 'g'), '\r\n|[\n\r]', '/', 'g') AS s FROM t),
v AS (
  SELECT n, i, m, trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g')) AS s FROM (
    SELECT n, unnest(regexp_extract_all(s, '[|/]?[^|/]*')) AS s, generate_subscripts(regexp_extract_all(s, '[|/]?[^|/]*'), 1) AS i FROM u)
  CROSS JOIN LATERAL (SELECT CASE WHEN i = 1 OR s[1] = '|' THEN '|' ELSE '/' END AS m)),
p AS (
  SELECT n, row_number() OVER w AS i, s, CASE WHEN m = '|' OR i - lag(i, 1, 0) OVER w > 1 THEN '|' ELSE '/' END AS m
  FROM v WHERE s <> '' WINDOW w AS (PARTITION BY n ORDER BY i)),
c(n, i, j, s) AS (
  SELECT n, i, i, s FROM p WHERE EXISTS (SELECT 1 FROM k WHERE starts_with(k.s, p.s))
  UNION
  SELECT c.n, c.i, p.i, c.s || x.x || p.s FROM c JOIN p ON p.n = c.n AND p.i = c.j + 1
  CROSS JOIN (VALUES (' '), ('|')) x(x)
  WHERE (p.m = '/' OR x.x = '|') AND EXISTS (SELECT 1 FROM k WHERE starts_with(k.s, c.s || x.x || p.s))),
f AS (SELECT c.n, c.i, max(c.j) AS j, arg_max(k.id, c.j) AS id FROM c JOIN k ON k.s = c.s GROUP BY c.n, c.i),
g(n, i, j, id) AS (
  SELECT n, min(i), arg_min(j, i), arg_min(id, i) FROM f GROUP BY n
  UNION ALL
  SELECT g.n, e.i, e.j, e.id FROM g CROSS JOIN LATERAL (SELECT i, j, id FROM f WHERE f.n = g.n AND f.i > g.j ORDER BY i LIMIT 1) e),
o AS (SELECT n, list(id ORDER BY i) AS ids FROM g GROUP BY n),
h AS (
  SELECT n, q, arg_max(r.license, len(r.ids)) AS license FROM (SELECT n, ids AS own, unnest(range(1, len(ids) + 1)) AS q FROM o)
  JOIN r ON own[q : q + len(r.ids) - 1] = r.ids GROUP BY n, q),
l AS (SELECT n, list(DISTINCT license ORDER BY license) AS licenses FROM h GROUP BY n)
SELECT t.doc_id, CAST(coalesce(len(o.ids), 0) AS BIGINT) AS n_sentences, coalesce(o.ids, []) AS sentences,
  coalesce(l.licenses, []) AS licenses
FROM t LEFT JOIN o ON o.n = t.n LEFT JOIN l ON l.n = t.n"""


def _url_sql() -> str:
    """The verdicts, with one pair of subqueries per round of propagation."""
    fits = " ".join(
        f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND path LIKE '/{p}%' THEN '{h}/{p}'"
        for h, _, p in (r.partition("/") for r in sorted(URL_RULES, key=len, reverse=True)))
    ruled = " ".join(f"WHEN '{r}' THEN '{v}'" for r, v in URL_RULES.items())
    rounds = "".join(f"""
s{k} AS (
  SELECT host, sum(t) AS t, sum(b) AS b FROM (
    SELECT host, t, b FROM s0 UNION ALL
    SELECT e.dst, s.t * e.w / e.o * {DAMPING}, 0.0 FROM e JOIN s{k - 1} s ON s.host = e.src UNION ALL
    SELECT e.src, 0.0, s.b * e.w / e.i * {DAMPING} FROM e JOIN s{k - 1} s ON s.host = e.dst) GROUP BY host),"""
                     for k in range(1, ROUNDS + 1))
    return rf"""
WITH u AS (
  SELECT page_id, html, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages),
v AS (
  SELECT page_id, html, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
p AS (SELECT page_id, html, host, path, CASE {fits} END AS rule FROM v),
q AS (SELECT page_id, html, host, path, rule, CASE rule {ruled} END AS ruled FROM p),
s0 AS (
  SELECT host, count(*) FILTER (ruled = 'allow') * (1 - {DAMPING}) AS t, count(*) FILTER (ruled = 'block') * (1 - {DAMPING}) AS b
  FROM q WHERE host <> '' AND ruled IS NOT NULL GROUP BY host),
a AS (
  SELECT DISTINCT page_id, host AS src, translate(unnest(regexp_extract_all(html,
      '(?i)\shref\s*=\s*["'']?\s*(?:https?:)?//([^/?#"''\s<>]+)', 1)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz') AS dst FROM q WHERE host <> ''),
h AS (SELECT DISTINCT host FROM q WHERE host <> ''),
c AS (SELECT x.host AS child, y.host FROM h x JOIN h y ON y.host = regexp_extract(x.host, '^[^.]+\.(.+)$', 1)),
l AS (
  SELECT src, dst, 1 AS w FROM a WHERE src <> dst AND dst <> '' UNION ALL SELECT child, host, 1 FROM c
  UNION ALL SELECT host, child, 1 FROM c),
g AS (SELECT src, dst, sum(w) AS w FROM l GROUP BY src, dst),
e AS (SELECT src, dst, w, sum(w) OVER (PARTITION BY src) AS o, sum(w) OVER (PARTITION BY dst) AS i FROM g),{rounds}
z AS (SELECT * FROM s{ROUNDS})
SELECT q.page_id, q.host, q.path, q.rule, coalesce(q.ruled,
  CASE WHEN coalesce(z.b, 0) > (coalesce(z.t, 0) + coalesce(z.b, 0)) * ({SHARE} + {MARGIN}) THEN 'block' ELSE 'allow' END) AS verdict
FROM q LEFT JOIN z ON z.host = q.host"""


def _codes_sql() -> str:
    """Codebooks round by round, as tables of (part, entry, components); every distance is computed in full."""
    assign = lambda k: f"""
n{k} AS MATERIALIZED (
  SELECT p.r, p.part, min(CAST(list_sum([(p.c[i] - b.c[i]) * (p.c[i] - b.c[i]) FOR i IN range(1, len(p.c) + 1)]) AS HUGEINT)
    * {vector_codes.ENTRIES} + b.e) AS m FROM p JOIN b{k} b ON b.part = p.part GROUP BY p.r, p.part)"""  # noqa: E731
    rounds = "".join(f"""{assign(k)},
m{k} AS (
  SELECT part, e, i, sum(x) AS s, count(*) AS n FROM (
    SELECT p.part, CAST(n.m % {vector_codes.ENTRIES} AS BIGINT) AS e, unnest(p.c) AS x, generate_subscripts(p.c, 1) AS i
    FROM p JOIN n{k} n ON n.r = p.r AND n.part = p.part) GROUP BY part, e, i),
b{k + 1} AS MATERIALIZED (
  SELECT b.part, b.e, coalesce(z.c, b.c) AS c FROM b{k} b LEFT JOIN (
    SELECT part, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM m{k} GROUP BY part, e) z
  ON z.part = b.part AND z.e = b.e),""" for k in range(vector_codes.ROUNDS))
    last = vector_codes.ROUNDS
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label,
    [CAST(floor({vector_codes.SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS c, len(embedding) // {vector_codes.PARTS} AS w
  FROM embeddings WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
k AS (SELECT unnest(range({vector_codes.PARTS})) AS part),
p AS MATERIALIZED (SELECT r, part, c[part * w + 1 : (part + 1) * w] AS c FROM v, k),
b0 AS MATERIALIZED (
  SELECT part, e, c[part * w + 1 : (part + 1) * w] AS c FROM k,
    (SELECT c, w, row_number() OVER (ORDER BY vec_id NULLS LAST, c) - 1 AS e FROM v ORDER BY e LIMIT {vector_codes.ENTRIES})),{rounds}{assign(last)},
o AS (
  SELECT r, string_agg(printf('%02x', CAST(m % {vector_codes.ENTRIES} AS INTEGER)), '' ORDER BY part) AS code,
    CAST(sum(m // {vector_codes.ENTRIES}) AS BIGINT) AS error FROM n{last} GROUP BY r)
SELECT v.vec_id, o.code, o.error, CAST(sum(o.error) OVER (PARTITION BY v.label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, e)) FROM b{last}) AS codebooks_sha256
FROM v JOIN o ON o.r = v.r"""


ORACLES = {
    "op1_minhash_near_dedup": r"""
WITH RECURSIVE
w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
sh AS (
  SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
      ELSE list_distinct([ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] FOR i IN range(1, len(ws) - 1)]) END) AS s
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id
  GROUP BY x.doc_id, y.doc_id),
e AS (
  SELECT p.a, p.b FROM p JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b
  WHERE 100 * p.k >= 85 * (na.n + nb.n - p.k)),
l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (
  SELECT doc_id AS d, doc_id AS c FROM documents
  UNION
  SELECT l.b, r.c FROM r JOIN l ON l.a = r.d)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT d, min(c) AS c FROM r GROUP BY d) m ON m.d = d.doc_id""",
    "op3_license_scan": _license_sql(),
    "op5_url_filter": _url_sql(),
    "op6_chat_format": r"""
WITH t AS (
  SELECT DISTINCT conv_id, turn, role, text FROM conversations),
s AS (
  SELECT conv_id, count(*) AS n, list(coalesce(role, chr(1)) || chr(2) || coalesce(text, chr(1)) ORDER BY turn, role, text) AS ts
  FROM t GROUP BY conv_id),
u AS (SELECT ts, n, min(conv_id) AS conv_id, count(*) AS copies FROM s GROUP BY ts, n),
k AS (
  SELECT conv_id, copies FROM u
  WHERE NOT EXISTS (SELECT 1 FROM u b WHERE b.n > u.n AND b.ts[1] = u.ts[1] AND list_slice(b.ts, 1, u.n) = u.ts))
SELECT k.conv_id, row_number() OVER (PARTITION BY k.conv_id ORDER BY t.turn // 256) - 1 AS part, count(*) AS n_turns, k.copies,
  string_agg('<|im_start|>' || coalesce(t.role, 'user') || chr(10) || replace(coalesce(t.text, ''), '<|', '< |')
    || '<|im_end|>' || chr(10), '' ORDER BY t.turn, t.role, t.text) AS text
FROM k JOIN t ON t.conv_id = k.conv_id GROUP BY k.conv_id, k.copies, t.turn // 256""",
    "op7_exact_dedup": r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
  FROM documents),
k AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY body ORDER BY n DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY body) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM k""",
    "op11_vector_codes": _codes_sql(),
    "op12_decontamination": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
w AS (
  SELECT DISTINCT item, least(len(ws), 10) AS n, unnest([ws[i : i + least(len(ws), 10) - 1] FOR i IN range(1, greatest(len(ws) - 9, 1) + 1)]) AS win
  FROM b WHERE len(ws) > 0),
g AS (
  SELECT r, unnest(range(1, greatest(len(ws) - n + 1, 0) + 1)) AS i, n,
    unnest([ws[i : i + n - 1] FOR i IN range(1, greatest(len(ws) - n + 1, 0) + 1)]) AS win
  FROM d, (SELECT DISTINCT n FROM w)),
f AS (SELECT g.r, g.i, g.n, w.item FROM g JOIN w ON w.n = g.n AND w.win = g.win),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM f) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM f WHERE item IS NOT NULL) GROUP BY r)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
  sha256(coalesce(t.items, '')) AS items_sha256, h.n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h ON h.r = d.r LEFT JOIN t ON t.r = d.r""",
}
