"""DuckDB SQL, written separately, for the queries that SQL can express."""

from stratalake.llm.licenses import long_templates, templates
from stratalake.llm.queries import HOST_RULES
from stratalake.llm.url_filters import BINARIES, UNSAFE_WORDS

ORACLES: dict[str, str] = {}

ORACLES["op1_decontaminate"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bs AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + 9], ' ') AS t FROM bs),
lens AS (SELECT DISTINCT n FROM bw),
ds AS (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS s FROM d, lens WHERE len(w) >= n),
dw AS (SELECT r, n, s, array_to_string(w[s:s + n - 1], ' ') AS t FROM ds),
hits AS (SELECT dw.r, dw.s, dw.n, bw.item_id FROM dw JOIN bw ON dw.t = bw.t AND dw.n = bw.n),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hits) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
        FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN its USING (r)
"""

_TEMPLATES = ", ".join(
    "({}, '{}', '{}')".format(k, name, text.replace("'", "''"))
    for k, (name, text) in enumerate(templates() + long_templates())
)

# Files whose terms carry less than 0.64 of every template's squared norm cannot reach 0.8. In the others every
# run of up to 32 lines with words is weighed whole against every template, and licence files as a whole too.
ORACLES["op6_licenses"] = rf"""
WITH f AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         coalesce(source, 'none') || '/' || (doc_id // 64) || CASE
           WHEN doc_id % 64 = 0 THEN '/LICENSE'
           WHEN doc_id % 8 = 0 THEN '/' || (doc_id // 8 % 8) || '/LICENSE.txt'
           ELSE '/' || (doc_id // 8 % 8) || '/' || doc_id || '.txt' END AS path
  FROM documents),
t(k, lic, txt) AS (VALUES {_TEMPLATES}),
tt AS (
  SELECT k, lic, term, count(*) AS tf
  FROM (SELECT k, lic, unnest(regexp_extract_all(lower(txt), '[a-z0-9]+')) AS term FROM t) GROUP BY ALL),
n AS (SELECT count(*) AS n FROM f),
seen AS (SELECT DISTINCT r, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM f),
df AS (SELECT term, count(*) AS df FROM seen GROUP BY term),
tw AS (SELECT k, lic, term, tf * (ln((1.0 + n) / (1.0 + coalesce(df, 0))) + 1.0) AS w FROM tt LEFT JOIN df USING (term), n),
unit AS (SELECT k, lic, term, w / sqrt(sum(w * w) OVER (PARTITION BY k)) AS u FROM tw),
near AS (
  SELECT DISTINCT r FROM (
    SELECT r, k FROM seen JOIN unit USING (term) GROUP BY r, k HAVING sum(u * u) >= 0.64 - 1e-9)),
cut AS (SELECT r, string_split(lower(text), chr(10)) AS l FROM f WHERE r IN (SELECT r FROM near)),
placed AS (SELECT r, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS pos FROM cut),
lines AS (
  SELECT r, row_number() OVER (PARTITION BY r ORDER BY pos) AS pos, terms
  FROM (SELECT r, pos, regexp_extract_all(line, '[a-z0-9]+') AS terms FROM placed) WHERE len(terms) > 0),
final AS (SELECT r, max(pos) AS e FROM lines GROUP BY r),
spans AS (
  SELECT r, s, e FROM (SELECT r, pos AS s, unnest(range(pos, least(pos + 31, e) + 1)) AS e FROM lines JOIN final USING (r))
  UNION SELECT r, 1, e FROM final JOIN f USING (r) WHERE doc_id % 8 = 0),
ct AS (
  SELECT r, s, e, term, count(*) AS tf
  FROM spans JOIN (SELECT r, pos, unnest(terms) AS term FROM lines) USING (r) WHERE pos BETWEEN s AND e GROUP BY ALL),
cw AS (SELECT r, s, e, term, tf * (ln((1.0 + n) / (1.0 + df)) + 1.0) AS w FROM ct JOIN df USING (term), n),
cn AS (SELECT r, s, e, sqrt(sum(w * w)) AS norm FROM cw GROUP BY ALL),
dots AS (SELECT r, s, e, k, lic, sum(w * u) AS dot FROM cw JOIN unit USING (term) GROUP BY ALL),
scored AS (SELECT path, lic, round(dot / norm, 6) AS score FROM dots JOIN cn USING (r, s, e) JOIN f USING (r)),
own AS (
  SELECT path, lic, score FROM (
    SELECT *, row_number() OVER (PARTITION BY path ORDER BY score DESC, lic) AS place FROM scored WHERE score >= 0.8)
  WHERE place = 1),
granted AS (
  SELECT above, lic FROM (
    SELECT *, row_number() OVER (PARTITION BY above ORDER BY score DESC, lic) AS place FROM (
      SELECT regexp_replace(path, '/[^/]*$', '') AS above, lic, score FROM own WHERE path LIKE '%/LICENSE%'))
  WHERE place = 1)
SELECT f.doc_id, f.path, coalesce(own.lic, a.lic, b.lic) AS license, own.score AS score,
       CASE WHEN own.lic IS NULL THEN coalesce(a.above, b.above) END AS inherited_from
FROM f LEFT JOIN own USING (path)
LEFT JOIN granted a ON a.above = regexp_replace(f.path, '/[^/]*$', '')
LEFT JOIN granted b ON b.above = regexp_replace(regexp_replace(f.path, '/[^/]*$', ''), '/[^/]*$', '')
"""

_HOST_RULES = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in HOST_RULES)

ORACLES["op11_url_filters"] = rf"""
WITH rest AS (
  SELECT row_number() OVER () AS r, page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT r, page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest),
rules(rule_host, rule_path, rule_verdict) AS (VALUES {_HOST_RULES}),
fitting AS (
  SELECT r, rule_host || rule_path AS rule, rule_verdict,
         row_number() OVER (PARTITION BY r ORDER BY length(rule_host || rule_path) DESC) AS place
  FROM parts JOIN rules ON suffix('.' || host, '.' || rule_host) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule,
       CASE WHEN rule IS NOT NULL THEN rule_verdict
            WHEN regexp_matches('.' || host, '[.-]({"|".join(UNSAFE_WORDS)})[.-]')
              OR regexp_matches(path, '[.]({"|".join(BINARIES)})$') THEN 'block' ELSE 'allow' END AS verdict
FROM parts LEFT JOIN (SELECT * FROM fitting WHERE place = 1) USING (r)
"""
