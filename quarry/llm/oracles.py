"""DuckDB statements whose rows equal those of the queries that SQL can express."""

from __future__ import annotations

#: The jump hash in unsigned 128-bit arithmetic; CRC-32 over bytes by its table, made by rule.
SHARDING = """
WITH RECURSIVE crc_bits AS (
  SELECT n, n AS c, 0 AS k FROM (SELECT unnest(range(256))::BIGINT AS n)
  UNION ALL
  SELECT n, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1 FROM crc_bits WHERE k < 8
), crc_table AS (SELECT list(c ORDER BY n) AS t FROM crc_bits WHERE k = 8),
walk AS (
  SELECT DISTINCT doc_id, 0::BIGINT AS b24, 0::BIGINT AS b25, 0::BIGINT AS j, 0 AS step, 0::BIGINT AS block,
    (CASE WHEN coalesce(doc_id, 0) < 0 THEN doc_id::HUGEINT + 18446744073709551616 ELSE coalesce(doc_id, 0) END)::UHUGEINT AS key
  FROM documents
  UNION ALL
  SELECT doc_id, CASE WHEN j < 24 THEN j ELSE b24 END, j,
    floor((j + 1)::DOUBLE * (2147483648.0::DOUBLE / ((next_key >> 33) + 1)::DOUBLE))::BIGINT, step + 1,
    CASE WHEN step = 0 THEN ((next_key >> 32) % 256)::BIGINT ELSE block END, next_key
  FROM (SELECT *, (key * 2862933555777941757::UHUGEINT + 1) % 18446744073709551616::UHUGEINT AS next_key FROM walk WHERE j < 25)
), placed AS (SELECT doc_id, b24::INTEGER AS shard, b25::INTEGER AS grown_shard, block::INTEGER AS block FROM walk WHERE j >= 25),
rows_ AS (
  SELECT d.doc_id, (coalesce(strlen(d.text), 0) + 8)::BIGINT AS size,
    CASE WHEN d.text IS NOT NULL THEN xor(4294967295, list_reduce(
      list_prepend(4294967295, list_transform(range(strlen(d.text)), lambda i: ('0x' || substr(hex(encode(d.text)), 2 * i + 1, 2))::BIGINT)),
      lambda c, b: xor(c >> 8, crc_table.t[(xor(c, b) & 255) + 1]))) END AS text_crc32,
    p.shard, p.grown_shard, p.block
  FROM documents d JOIN placed p ON d.doc_id IS NOT DISTINCT FROM p.doc_id CROSS JOIN crc_table
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY block, doc_id NULLS FIRST, text_crc32 NULLS FIRST, size) - 1 AS slot,
  grown_shard, block
FROM rows_
"""

MIXING = r"""
WITH rows_ AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ' ' || coalesce(md5(text), '')), 1, 15))::BIGINT AS hash
  FROM documents
), sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows_ GROUP BY source),
weighted AS (
  SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1] AS weight,
    row_number() OVER (ORDER BY encode(source) NULLS LAST) AS rank, 2 * source_size AS cap, sum(source_size) OVER () AS total
  FROM sizes
), levels AS (
  SELECT *, (total * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / (sum(weight) OVER (ORDER BY cap::DOUBLE / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM weighted
), targets AS (
  SELECT source, source_size, least(cap::DOUBLE, weight * max(level) OVER ()) AS target FROM levels
), split AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM targets
), summed AS (
  SELECT r.*, s.source_size, s.target, s.whole, s.target - s.whole * s.source_size AS rest,
    sum(r.size) OVER (PARTITION BY r.source ORDER BY r.hash) AS upto,
    sum(r.size) OVER (PARTITION BY r.source, r.hash) AS own
  FROM rows_ r JOIN split s ON r.source IS NOT DISTINCT FROM s.source
)
SELECT doc_id, size, source_size, target, size * least(2, whole + CASE
    WHEN upto <= rest THEN 1
    WHEN upto - own <= rest AND upto - rest < rest - (upto - own) THEN 1 ELSE 0 END)::BIGINT AS taken
FROM summed
"""

#: Every 400-byte string of every text, counted; runs of those that repeat; the rest put together again.
SUFFIX_DEDUP = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
n AS (SELECT *, length(h) // 2 AS n FROM d),
w AS (SELECT rid, unnest(range(n - 399)) AS i, h FROM n WHERE n >= 400),
r AS (SELECT rid, i, count(*) OVER (PARTITION BY m) AS c FROM (SELECT rid, i, md5(substr(h, 2 * i + 1, 800)) AS m FROM w)),
p AS (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS before FROM r WHERE c > 1),
g AS (SELECT rid, i, sum(CASE WHEN i <= before + 400 THEN 0 ELSE 1 END) OVER (PARTITION BY rid ORDER BY i) AS k FROM p),
s AS (SELECT rid, k, min(i) AS a, max(i) + 400 AS b FROM g GROUP BY ALL),
removed AS (SELECT rid, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans FROM s GROUP BY 1),
ends AS (SELECT rid, b AS from_, a AS upto FROM s UNION ALL SELECT rid, 0, -1 FROM n),
gaps AS (SELECT e.rid, from_, coalesce(lead(upto) OVER (PARTITION BY e.rid ORDER BY upto), n) AS to_, h FROM ends e JOIN n USING (rid)),
kept AS (SELECT rid, sha256(unhex(string_agg(substr(h, 2 * from_ + 1, 2 * (to_ - from_)), '' ORDER BY from_))) AS kept_sha256 FROM gaps GROUP BY 1)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, kept_sha256
FROM n JOIN kept USING (rid) LEFT JOIN removed USING (rid)
"""

#: Every group and every kept term of its language side by side, in 128-bit whole numbers.
DIVERGENCE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), t AS (SELECT rid, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY 1, 2 HAVING count(DISTINCT rid) >= 10),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS c FROM t GROUP BY 1, 2, 3),
groups_ AS (SELECT DISTINCT lang, source FROM d),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0)::HUGEINT AS c
  FROM groups_ g JOIN kept k USING (lang) LEFT JOIN counts c ON (c.lang, c.source, c.term) = (g.lang, g.source, k.term)
), p AS (
  SELECT *, 1 + (1000000000 * (c + 2)) // ((sum(c) OVER w + 2 * count(*) OVER w)::HUGEINT) AS p
  FROM dense WINDOW w AS (PARTITION BY lang, source)
), whole AS (SELECT lang, term, sum(c)::HUGEINT AS c FROM dense GROUP BY 1, 2),
q AS (
  SELECT lang, term, 1 + (1000000000 * (c + 2)) // ((sum(c) OVER w + 2 * count(*) OVER w)::HUGEINT) AS q
  FROM whole WINDOW w AS (PARTITION BY lang)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups_ a JOIN groups_ b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs x ON (x.lang, x.source, x.item) = (a.lang, a.source, b.source)
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, ((p - q) * (p - q)) // (p + q) FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE c > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value,
  row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank
FROM found QUALIFY part = 'pair' OR rank <= 10
"""

_HOST = r"translate(coalesce(regexp_extract({0}, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = r"coalesce(regexp_extract({0}, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '')"
_QUERY = r"regexp_replace(regexp_replace(regexp_extract({0}, '(?s)^[^?#]*\?([^#]*)', 1), '(?i)(^|&)(utm_[^=&]*|gclid|fbclid)=[^&]*', '', 'g'), '^&+', '')"
_BARE = f"regexp_replace({_HOST}, ':(80|443)?$', '')"
_ADDRESS = f"""CASE WHEN {_BARE} <> '' THEN {_BARE} || regexp_replace({_PATH}, '/+$', '')
  || CASE WHEN {_QUERY} = '' THEN '' ELSE '?' || {_QUERY} END END"""
_RULES = """rules(host, path, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block'))"""

#: Rules joined to every url, links by the same patterns, and components by walking pairs until no new one is found.
URL_FILTERS = rf"""
WITH RECURSIVE {_RULES},
p AS (SELECT row_number() OVER () AS rid, page_id, {_HOST.format("url")} AS host, {_PATH.format("url")} AS path, {_ADDRESS.format("url")} AS adr, html FROM pages),
tags AS (
  SELECT rid, host, path, adr, generate_subscripts(t, 1) AS k, unnest(t) AS tag FROM (
    SELECT *, regexp_extract_all(regexp_replace(html, '(?is)<!--.*?-->|<script.*?</script[^>]*>|<style.*?</style[^>]*>', ' ', 'g'),
      '(?is)<(?:link|meta)[	-
 ][^>]*>') AS t FROM p)
), href AS (
  SELECT *, replace(trim(CASE
      WHEN regexp_matches(tag, '(?is)[	-
 ]rel[	-
 ]*=[	-
 ]*["'']?canonical(?:["''>/	-
 ]|$)')
      THEN regexp_extract(tag, '(?is)[	-
 ]href[	-
 ]*=[	-
 ]*(?:"([^"]*)"|''([^'']*)''|([^"''>	-
 ]+))', 1)
        || regexp_extract(tag, '(?is)[	-
 ]href[	-
 ]*=[	-
 ]*(?:"([^"]*)"|''([^'']*)''|([^"''>	-
 ]+))', 2)
        || regexp_extract(tag, '(?is)[	-
 ]href[	-
 ]*=[	-
 ]*(?:"([^"]*)"|''([^'']*)''|([^"''>	-
 ]+))', 3)
      WHEN regexp_matches(tag, '(?is)http-equiv[	-
 ]*=[	-
 ]*["'']?refresh')
      THEN regexp_extract(tag, '(?is)[	-
 ]content[	-
 ]*=[	-
 ]*["''][	-
 ]*[0-9.]*[	-
 ]*[;,][	-
 ]*url[	-
 ]*=[	-
 ]*["'']?([^"''>]+)', 1)
    END), '&amp;', '&') AS h FROM tags
), links AS (
  SELECT rid, adr, k, CASE
    WHEN regexp_matches(h, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN h
    WHEN h LIKE '//%' THEN 'http:' || h
    WHEN h = '' OR h LIKE '#%' OR regexp_matches(h, '^[A-Za-z][A-Za-z0-9+.-]*:') OR host = '' THEN NULL
    WHEN h LIKE '/%' THEN 'http://' || host || h
    WHEN h LIKE '?%' THEN 'http://' || host || path || h
    ELSE 'http://' || host || CASE WHEN regexp_replace(path, '[^/]*$', '') = '' THEN '/' ELSE regexp_replace(path, '[^/]*$', '') END || h END AS link
  FROM href WHERE h IS NOT NULL
), first_link AS (SELECT rid, arg_min(link, k) AS link FROM links WHERE link IS NOT NULL GROUP BY 1),
nodes AS (SELECT p.*, coalesce(adr, {_ADDRESS.format("f.link")}) AS node FROM p LEFT JOIN first_link f USING (rid)),
ends AS (SELECT node AS a, {_ADDRESS.format("link")} AS b, link FROM links JOIN nodes USING (rid) WHERE link IS NOT NULL AND node IS NOT NULL AND {_ADDRESS.format("link")} IS NOT NULL),
urls AS (SELECT adr AS node, host, path FROM p WHERE adr IS NOT NULL UNION SELECT b, {_HOST.format("link")}, {_PATH.format("link")} FROM ends),
judged AS (
  SELECT DISTINCT u.node, u.host, u.path, r.host || r.path AS rule, r.verdict FROM urls u
  JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
  QUALIFY row_number() OVER (PARTITION BY u.node, u.host, u.path ORDER BY length(r.host || r.path) DESC) = 1
), near(a, b) AS (
  SELECT a, b FROM ends UNION SELECT b, a FROM ends UNION SELECT n.a, e.b FROM near n JOIN (SELECT a, b FROM ends UNION SELECT b, a FROM ends) e ON n.b = e.a
), blocked AS (
  SELECT node FROM (SELECT node FROM judged WHERE verdict = 'block' UNION SELECT n.b FROM near n JOIN judged j ON j.node = n.a WHERE j.verdict = 'block')
  WHERE node NOT IN (SELECT node FROM judged WHERE verdict = 'allow')
)
SELECT page_id, n.host, n.path, r.host || r.path AS rule,
  coalesce(r.verdict, CASE WHEN n.node IN (SELECT node FROM blocked) THEN 'block' ELSE 'allow' END) AS verdict
FROM nodes n LEFT JOIN rules r ON (n.host = r.host OR ends_with(n.host, '.' || r.host)) AND starts_with(n.path, r.path)
QUALIFY row_number() OVER (PARTITION BY n.rid ORDER BY length(r.host || r.path) DESC NULLS LAST) = 1
"""
