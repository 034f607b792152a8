"""DuckDB SQL of the queries of this package that SQL expresses."""

from __future__ import annotations

from kiln.llm.url_filter import Rule

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
items AS (SELECT item_id, words, least(10, len(words)) AS n FROM (
  SELECT item_id, regexp_extract_all({_LOW}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark) WHERE len(words) > 0),
iw AS (SELECT DISTINCT item_id, n, array_to_string(words[k:k + n - 1], ' ') AS s FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS k FROM items)),
dw AS (SELECT doc_id, n, k, array_to_string(words[k:k + n - 1], ' ') AS s
       FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM items) WHERE len(words) >= n)),
hit AS MATERIALIZED (SELECT doc_id, item_id, n, k FROM dw JOIN iw USING (n, s)),
cov AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(k, k + n)) AS j FROM hit) GROUP BY 1),
got AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hit) GROUP BY 1)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN got USING (doc_id)
"""

OP5 = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
sh AS MATERIALIZED (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, array_to_string(words[k:k + 2], ' ') AS s FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS k FROM d WHERE len(words) >= 3)
    UNION ALL SELECT doc_id, array_to_string(words, ' ') FROM d WHERE len(words) IN (1, 2))),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
c AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (SELECT u, v FROM c JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * c >= 90 * (a.n + b.n - c)),
both_ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (SELECT u, v FROM both_ways UNION SELECT r.u, b.v FROM reach r JOIN both_ways b ON r.v = b.u)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(least_v, doc_id))::BIGINT AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT u AS doc_id, min(v) AS least_v FROM reach GROUP BY 1) r USING (doc_id)
"""

OP6 = """
WITH RECURSIVE e AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
links AS MATERIALIZED (
  SELECT a.vec_id AS u, b.vec_id AS v FROM e a JOIN e b ON a.label = b.label AND a.vec_id < b.vec_id AND len(a.x) = len(b.x)
  WHERE list_dot_product(a.x, b.x) / sqrt(list_dot_product(a.x, a.x) * list_dot_product(b.x, b.x)) >= 0.98),
both_ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (SELECT u, v FROM both_ways UNION SELECT r.u, b.v FROM reach r JOIN both_ways b ON r.v = b.u),
r AS (SELECT u AS vec_id, min(v) AS least_v FROM reach GROUP BY 1),
n AS (SELECT u AS vec_id, count(*) AS n FROM both_ways GROUP BY 1)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(least_v, vec_id))::BIGINT AS component_id, coalesce(least_v, vec_id) >= vec_id AS kept
FROM embeddings LEFT JOIN r USING (vec_id) LEFT JOIN n USING (vec_id)
"""

OP8 = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
win AS (SELECT doc_id, k, array_to_string(words[k:k + 19], ' ') AS s FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS k FROM d WHERE len(words) >= 20)),
dup AS (SELECT doc_id, k FROM win QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, k) > 1),
cov AS (SELECT DISTINCT doc_id, unnest(range(k, k + 20)) AS j FROM dup),
word AS (SELECT doc_id, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS j FROM d),
kept AS (SELECT word.doc_id, count(cov.j) AS n_removed, string_agg(w, ' ' ORDER BY word.j) FILTER (WHERE cov.j IS NULL) AS text
         FROM word LEFT JOIN cov ON word.doc_id = cov.doc_id AND word.j = cov.j GROUP BY 1)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

# Two rounds of assignment and floored means, by rounds of common table expressions. Vectors are cut into 16 parts of four.
_ASSIGN = """
a{r} AS MATERIALIZED (
  SELECT vec_id, p, x, min({{'far': far, 'entry': entry}}) AS best FROM (
    SELECT t.vec_id, t.p, t.x, b.entry, list_sum(list_transform(list_zip(t.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS far
    FROM parts t JOIN b{r} b USING (p)) GROUP BY ALL),
"""
_MOVE = """
s{r} AS (
  SELECT p, best.entry AS entry, k, floor(sum(x[k])::DOUBLE / count(*))::BIGINT AS v FROM a{r}, (SELECT unnest([1, 2, 3, 4]) AS k) GROUP BY 1, 2, 3),
b{n} AS MATERIALIZED (
  SELECT b.p, b.entry, coalesce(s.x, b.x) AS x
  FROM b{r} b LEFT JOIN (SELECT p, entry, list(v ORDER BY k) AS x FROM s{r} GROUP BY 1, 2) s USING (p, entry)),
"""

OP12 = (
    """
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
parts AS MATERIALIZED (SELECT vec_id, p, list_slice(x, 4 * p + 1, 4 * p + 4) AS x FROM kept, (SELECT unnest(range(16)) AS p)),
heads AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < 64),
b0 AS MATERIALIZED (SELECT p, entry, x FROM heads JOIN parts USING (vec_id)),
"""
    + _ASSIGN.format(r=0) + _MOVE.format(r=0, n=1) + _ASSIGN.format(r=1) + _MOVE.format(r=1, n=2) + _ASSIGN.format(r=2)
    + """
coded AS (
  SELECT vec_id, string_agg(printf('%02x', best.entry), '' ORDER BY p) AS code, sum(best.far)::BIGINT AS error FROM a2 GROUP BY 1),
book AS (
  SELECT sha256(string_agg(x[k]::VARCHAR, ',' ORDER BY p, entry, k)) AS codebooks_sha256 FROM b2, (SELECT unnest([1, 2, 3, 4]) AS k))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), book
"""
)


def _plain(path: str) -> str:
    """A path without dot segments."""
    return f"""CASE WHEN NOT regexp_matches({path}, '/\\.{{1,2}}(/|$)') THEN {path} ELSE list_reduce(list_prepend('', list_slice(string_split({path}, '/'), 2, -1)),
      lambda acc, s: CASE WHEN s = '..' THEN regexp_replace(acc, '/[^/]*$', '') WHEN s = '.' THEN acc ELSE acc || '/' || s END)
      || CASE WHEN regexp_matches({path}, '/\\.{{1,2}}$') THEN '/' ELSE '' END END"""


def _resource(url: str) -> str:
    rest = f"regexp_extract({url}, '^(?s:.*?)://[^/?#]*([^#]*)', 1)"
    lowered = f"translate(regexp_extract({url}, '^(?s:.*?)://[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"CASE WHEN contains({url}, '://') THEN {lowered} || CASE WHEN {rest} LIKE '/%' THEN '' ELSE '/' END || {rest} END"


def _attribute(tag: str, name: str) -> str:
    pattern = f"""(?i)[\\s"'']{name}\\s*=\\s*(?:"([^"]*)"|''([^'']*)''|([^\\s"''>]+))"""
    return f"(regexp_extract({tag}, '{pattern}', 1) || regexp_extract({tag}, '{pattern}', 2) || regexp_extract({tag}, '{pattern}', 3))"


def _rule(host: str, path: str, rules: list[Rule]) -> str:
    cases = [
        f"WHEN ({host} = '{r.host}' OR {host} LIKE '%.{r.host}') AND starts_with({path}, '{r.path}') THEN '{r.name}'"
        for r in sorted(rules, key=lambda r: -len(r.name))
    ]
    return f"CASE {' '.join(cases)} END"


def op13(rules: list[Rule]) -> str:
    host = lambda u: f"coalesce(translate(regexp_extract({u}, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '')"
    path = lambda u: f"coalesce(regexp_extract({u}, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '')"
    verdict = "CASE rule " + " ".join(f"WHEN '{r.name}' THEN '{r.verdict}'" for r in rules) + " END"
    return f"""
WITH RECURSIVE tags AS (
  SELECT {_resource("url")} AS u,
         unnest(regexp_extract_all(regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script\\s*>', '', 'g'), '(?is)<(?:link|meta)\\s[^>]*>')) AS tag
  FROM pages WHERE regexp_matches(html, '(?i)canonical|refresh') AND contains(url, '://')),
named AS (
  SELECT u, trim(replace(CASE
    WHEN regexp_matches(tag, '(?i)^<link') THEN CASE WHEN regexp_matches({_attribute("tag", "rel")}, '(?i)(^|\\s)canonical(\\s|$)') THEN {_attribute("tag", "href")} END
    WHEN lower(trim({_attribute("tag", "http-equiv")})) = 'refresh'
      THEN regexp_extract({_attribute("tag", "content")}, '(?i)^\\s*[0-9.]*\\s*[;,]\\s*url\\s*=\\s*["'']?([^"'']*)', 1) END, '&amp;', '&')) AS link,
    regexp_extract(u, '^[^:]*') AS scheme, regexp_extract(u, '^[^:]*://[^/?#]*') AS root,
    regexp_extract(u, '^[^:]*://[^/?#]*([^?#]*/)', 1) AS folder, regexp_extract(u, '^[^?#]*') AS bare FROM tags),
cut AS (SELECT *, regexp_extract(link, '^[^?#]*') AS lp, regexp_extract(link, '^[^?#]*([^#]*)', 1) AS lq FROM named WHERE link <> ''),
links AS (
  SELECT DISTINCT u, v FROM (
    SELECT u, CASE
      WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN {_resource("link")}
      WHEN link LIKE '//%' THEN {_resource("(scheme || ':' || link)")}
      WHEN link LIKE '/%' THEN root || {_plain("lp")} || lq
      WHEN regexp_matches(link, '^(#|[A-Za-z][A-Za-z0-9+.-]*:)') THEN NULL
      WHEN link LIKE '?%' THEN bare || lq
      ELSE root || {_plain("(folder || lp)")} || lq END AS v FROM cut) WHERE v IS NOT NULL AND u <> v),
both_ways AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
reach AS (SELECT DISTINCT u AS node, u AS other FROM both_ways UNION SELECT r.node, b.v FROM reach r JOIN both_ways b ON r.other = b.u),
ruled AS (SELECT node, other, {_rule(host("other"), path("other"), rules)} AS rule FROM reach),
class AS (SELECT node, bool_or(verdict = 'block') AND NOT bool_or(verdict = 'allow') AS blocked FROM (SELECT node, {verdict} AS verdict FROM ruled) GROUP BY node),
p AS (SELECT page_id, {host("url")} AS host, {path("url")} AS path, {_resource("url")} AS u FROM pages),
r AS (SELECT *, {_rule("host", "path", rules)} AS rule FROM p)
SELECT page_id, host, path, rule, coalesce({verdict}, CASE WHEN blocked THEN 'block' END, 'allow') AS verdict FROM r LEFT JOIN class ON r.u = class.node
"""
