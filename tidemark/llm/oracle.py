"""DuckDB SQL for the queries that SQL can express, each by another way than
the Spark query: joins of all shingles instead of sketches, a sort of each
source instead of histograms, one pass over turns instead of written examples.
"""
from __future__ import annotations

from . import chat, mixing

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORDS = r"'[^\x20\x09-\x0D]+'"

_NEAR = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), {_WORDS}) AS w
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM w),
one AS (SELECT doc_id, unnest(s) AS x FROM s),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM one a JOIN one b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
linked AS (
  SELECT c.a, c.b FROM common c JOIN s sa ON sa.doc_id = c.a JOIN s sb ON sb.doc_id = c.b
  WHERE 100 * c.n >= 85 * (len(sa.s) + len(sb.s) - c.n)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM s
  UNION SELECT r.a, l.b FROM reach r JOIN linked l ON l.a = r.b)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, m.component_id, m.component_id = s.doc_id AS kept
FROM s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) m ON m.a = s.doc_id"""

_CONTROL = "|".join("".join("\\" + c if c in "<>|[]/" else c for c in s) for s in sorted(chat.CONTROLS, key=len, reverse=True))
_ODD = "</s>[INST] ok [/INST]"
_FIXED = len(chat.START) + len(chat.END) + 2

_CHAT = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{_ODD}' UNION ALL SELECT -7, 1, 'assistant', '{_ODD}'),
p AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i,
    count(*) OVER (PARTITION BY conv_id) AS n,
    {_FIXED} + length(role) + length(text) + length(text) - length(replace(text, '\\', ''))
      + len(regexp_extract_all(text, '{_CONTROL}')) AS size
  FROM t),
c AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM p)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (role = 'assistant' OR i = n) AS BIGINT) AS formatted_chars,
  count(*) FILTER (role = 'assistant') AS n_examples
FROM c GROUP BY conv_id"""

# The excess is shared in rounds; a round beyond the last changes nothing.
_ROUNDS = 60
_MIX = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_WORDS})) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents),
g AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    list_extract({list(mixing.WEIGHTS)}, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} AS INTEGER) + 1) AS w
  FROM d GROUP BY source),
share(round, source, source_size, w, target) AS (
  SELECT 0, source, source_size, w, CAST(0 AS DOUBLE) FROM g
  UNION ALL
  SELECT round + 1, source, source_size, w, least({mixing.CAP} * source_size, target + CASE
      WHEN target < {mixing.CAP} * source_size THEN w * ({mixing.BUDGET} * sum(source_size) OVER () - sum(target) OVER ())
        / sum(CASE WHEN target < {mixing.CAP} * source_size THEN w END) OVER () ELSE 0 END)
  FROM share WHERE round < {_ROUNDS}),
goal AS (
  SELECT source, source_size, target,
    CASE WHEN source_size > 0 THEN CAST(floor(target / source_size + 1e-12) AS BIGINT) ELSE 0 END AS passes
  FROM share WHERE round = {_ROUNDS}),
ordered AS (
  SELECT d.*, g.source_size, g.target, g.passes, greatest(g.target - g.passes * g.source_size, 0) AS rest,
    CAST(sum(size) OVER (PARTITION BY d.source ORDER BY h) AS BIGINT) AS upto,
    CAST(sum(size) OVER (PARTITION BY d.source, h) AS BIGINT) AS tied
  FROM d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(size * (passes + CASE WHEN upto <= rest OR (upto - tied <= rest AND upto - rest < rest - (upto - tied))
    THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM ordered"""


_PARTS, _ENTRIES = 16, 64


def _assigned(books: str) -> str:
    """Each part's nearest entry: distance and index as one number, so that the
    smallest has the lower index of equal distances."""
    return f"""
  SELECT p.r, p.j, any_value(p.x) AS x, min(list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))
    * {_ENTRIES} + c.k) AS best
  FROM p JOIN {books} c ON c.j = p.j GROUP BY p.r, p.j"""


def _moved(books: str, assigned: str) -> str:
    """Floors of means; the modulus of a negative sum is negative."""
    return f"""
  SELECT c.j, c.k, coalesce(m.x, c.x) AS x FROM {books} c LEFT JOIN (
    SELECT j, k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM (
      SELECT j, best % {_ENTRIES} AS k, i, CAST(sum(v) AS BIGINT) AS s, count(*) AS n
      FROM (SELECT j, best, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM {assigned}) GROUP BY ALL)
    GROUP BY j, k) m ON m.j = c.j AND m.k = c.k"""


_CODES = f"""
WITH v AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS r,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (
  SELECT r, j, list_slice(e, j * len(e) // {_PARTS} + 1, (j + 1) * len(e) // {_PARTS}) AS x
  FROM v, range({_PARTS}) AS t(j)),
c0 AS MATERIALIZED (SELECT j, r - 1 AS k, x FROM p WHERE r <= {_ENTRIES}),
a0 AS MATERIALIZED ({_assigned('c0')}),
c1 AS MATERIALIZED ({_moved('c0', 'a0')}),
a1 AS MATERIALIZED ({_assigned('c1')}),
c2 AS MATERIALIZED ({_moved('c1', 'a1')}),
a2 AS ({_assigned('c2')}),
coded AS (
  SELECT r, string_agg(printf('%02x', best % {_ENTRIES}), '' ORDER BY j) AS code, CAST(sum(best // {_ENTRIES}) AS BIGINT) AS error
  FROM a2 GROUP BY r)
SELECT v.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY v.label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY j, k)) FROM c2) AS codebooks_sha256
FROM v JOIN coded c USING (r)"""

# The query's rules, stated again.
_URLS = f"""
WITH rules(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
cut AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS name FROM rest),
u AS (
  SELECT row_number() OVER () AS r, page_id, translate(name, '{_UPPER}', '{_UPPER.lower()}') AS host,
    regexp_extract(substr(rest, length(name) + 1), '^[^?#]*') AS path
  FROM cut),
fit AS (
  SELECT u.r, rules.host || rules.path AS rule, rules.verdict
  FROM u JOIN rules ON (u.host = rules.host OR ends_with(u.host, '.' || rules.host)) AND starts_with(u.path, rules.path)
  QUALIFY row_number() OVER (PARTITION BY u.r ORDER BY length(rule) DESC) = 1)
SELECT u.page_id, u.host, u.path, fit.rule, coalesce(fit.verdict, 'allow') AS verdict
FROM u LEFT JOIN fit USING (r)"""

_FIM = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || CAST(doc_id AS VARCHAR)) AS x FROM documents),
h AS (
  SELECT *, length(t) AS n, CAST('0x' || substr(x, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(x, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(x, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(x, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
o AS (
  SELECT *, substring(t, 1, a) AS p, substring(t, a + 1, b - a) AS m, substring(t, b + 1, n - b) AS s FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN t ELSE p || m || s END) AS restored_sha256
FROM o"""

ORACLE_SQL: dict[str, str] = {
    "op3_hyperminhash": _NEAR,
    "op7_chat": _CHAT,
    "op9_mixing": _MIX,
    "op11_vector_codes": _CODES,
    "op12_url_rules": _URLS,
    "op13_fill_middle": _FIM,
}
