"""DuckDB SQL for the operators that SQL can express: independent statements over the whole tables."""

from __future__ import annotations

from .common import UPPER
from .url_filters import END, ORDER, RULES, SMOOTH, START, STEPS

#: Links over shared shingles, then the transitive closure.
NGRAM_JOIN = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 4 THEN list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (
  SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
reach(doc, other) AS (
  SELECT x, y FROM link UNION SELECT y, x FROM link
  UNION SELECT r.doc, l.y FROM reach r JOIN (SELECT x, y FROM link UNION ALL SELECT y, x FROM link) l ON l.x = r.other)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles,
  least(w.doc_id, coalesce((SELECT min(other) FROM reach WHERE reach.doc = w.doc_id), w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id)
"""

#: Every 100-byte window by its MD5; runs of windows that have an earlier equal are cut out of the bytes' hex digits.
SUFFIX_DEDUP = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
win AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS m FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS i FROM d WHERE n >= 100) x),
gone AS (
  SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY m ORDER BY doc_id, i) AS k FROM win) y WHERE k > 1),
run AS (
  SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS r
  FROM (SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS fresh FROM gone) z),
span AS (SELECT doc_id, r, min(i) AS a, max(i) + 100 AS b FROM run GROUP BY doc_id, r),
piece AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM span
  UNION ALL SELECT doc_id, max(b), NULL FROM span GROUP BY doc_id),
kept AS (
  SELECT p.doc_id, string_agg(substr(d.h, 2 * p.a + 1, 2 * (coalesce(p.b, d.n) - p.a)), '' ORDER BY p.a) AS h FROM piece p JOIN d USING (doc_id) GROUP BY p.doc_id)
SELECT d.doc_id, d.n::BIGINT AS n_bytes, coalesce(t.removed, 0)::BIGINT AS n_removed, coalesce(t.spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(k.h, d.h))) AS kept_sha256
FROM d LEFT JOIN kept k USING (doc_id) LEFT JOIN (SELECT doc_id, sum(b - a) AS removed, count(*) AS spans FROM span GROUP BY doc_id) t USING (doc_id)
"""


def _url_filters() -> str:
    rules = ", ".join(f"('{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}', '{r}', '{v}')" for r, v in RULES)
    c = lambda x: f"chr({ord(x)})"
    orders = []
    for k in range(1, ORDER + 1):
        shorter = "1 / 256.0, 1 / 256.0 FROM t" if k == 1 else f"s.pa, s.pr FROM t JOIN m{k - 1} s ON s.g = substr(t.g, 2)"
        orders.append(f"""m{k} AS (
  SELECT g, (a + {SMOOTH} * pa0) / (na + {SMOOTH}) AS pa, (r + {SMOOTH} * pr0) / (nr + {SMOOTH}) AS pr
  FROM (WITH t AS (
      SELECT g, a, r, sum(a) OVER (PARTITION BY left(g, {k - 1})) AS na, sum(r) OVER (PARTITION BY left(g, {k - 1})) AS nr
      FROM (SELECT right(g, {k}) AS g, sum(a) AS a, sum(r) AS r FROM seen GROUP BY 1) o)
    SELECT t.*, {shorter.replace(', ', ' AS pa0, ', 1).replace(' FROM', ' AS pr0 FROM', 1)}) u)""")
    found = " UNION ALL ".join(f"SELECT g, ln(pa) - ln(pr) AS delta FROM m{k}" for k in range(1, ORDER + 1))
    best = ", ".join(f"(SELECT delta FROM model WHERE model.g = right(spot.g, {k}))" for k in range(ORDER, 0, -1))
    return rf"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS u, instr(coalesce(url, ''), '://') AS colon, substr(coalesce(url, ''), instr(coalesce(url, ''), '://') + 3) AS rest FROM pages),
q AS (
  SELECT page_id, u, CASE WHEN colon > 0 THEN translate(regexp_extract(rest, '^[^/?#]*', 0), '{UPPER}', '{UPPER.lower()}') ELSE '' END AS host,
    CASE WHEN colon > 0 THEN regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*', 0)) + 1), '^[^?#]*', 0) ELSE '' END AS path FROM p),
rules(rh, rp, rule, says) AS (VALUES {rules}),
j AS (
  SELECT q.*, (SELECT arg_max(rule, length(rule)) FROM rules WHERE (host = rh OR suffix(host, '.' || rh)) AND starts_with(path, rp)) AS rule FROM q),
v AS (SELECT j.*, says, ('0x' || substr(md5(u), 1, 8))::BIGINT % 5 = 0 AS held FROM j LEFT JOIN rules USING (rule)),
seen AS (
  SELECT g, count(*) FILTER (says = 'allow')::DOUBLE AS a, count(*) FILTER (says = 'block')::DOUBLE AS r
  FROM (SELECT says, unnest(list_transform(range(1, length(u) + 2), lambda i: substr(repeat({c(START)}, {ORDER - 1}) || u || {c(END)}, i, {ORDER}))) AS g FROM v WHERE says IS NOT NULL AND NOT held) x
  GROUP BY g),
{", ".join(orders)},
model AS ({found}),
spot AS (
  SELECT u, g, count(*) AS n FROM (
    SELECT u, unnest(list_transform(range(1, length(u) + 2), lambda i: substr(repeat({c(START)}, {ORDER - 1}) || u || {c(END)}, i, {ORDER}))) AS g FROM (SELECT DISTINCT u FROM v)) y
  GROUP BY u, g),
score AS (SELECT u, sum(n * coalesce({best}, 0.0)) / sum(n) AS score FROM spot GROUP BY u),
bin AS (
  SELECT floor(score * {STEPS}) AS b, count(*) FILTER (says = 'allow') AS a, count(*) FILTER (says = 'block') AS r
  FROM v JOIN score USING (u) WHERE says IS NOT NULL AND held GROUP BY 1),
gain AS (
  SELECT b, (coalesce(sum(r) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / sum(r) OVER ()
    + sum(a) OVER (ORDER BY b ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) / sum(a) OVER ()) AS gain FROM bin QUALIFY sum(a) OVER () > 0 AND sum(r) OVER () > 0),
cut AS (SELECT b / {STEPS}.0 AS cut FROM gain WHERE gain IS NOT NULL ORDER BY round(gain, 9) DESC, abs(b), b DESC LIMIT 1)
SELECT page_id, host, path, v.rule, coalesce(says, CASE WHEN score < (SELECT cut FROM cut) THEN 'block' ELSE 'allow' END) AS verdict
FROM v JOIN score USING (u)
"""


URL_FILTERS = _url_filters()
