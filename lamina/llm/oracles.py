"""DuckDB SQL for the corpus queries that SQL can express, over whole tables."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(column: str, pattern: str) -> str:
    return f"regexp_extract_all({_LOWER.format(f'coalesce({column}, {chr(39) * 2})')}, '{pattern}')"


_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

DECONTAMINATION = f"""
WITH item AS (SELECT item_id, {_words('text', _WORD)} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM item WHERE len(w) > 0)
),
doc AS (SELECT doc_id, {_words('text', _WORD)} AS w FROM documents),
gram AS (
  SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM doc CROSS JOIN (SELECT DISTINCT n FROM win) WHERE len(w) >= n)
),
hit AS (SELECT doc_id, i, n, item_id FROM gram JOIN win USING (n, g)),
place AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(p.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(f.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(f.items, '')) AS items_sha256,
       coalesce(p.n_hit, 0) > 0 AND 20 * coalesce(p.n_hit, 0) >= len(d.w) AS contaminated
FROM doc d LEFT JOIN place p USING (doc_id) LEFT JOIN found f USING (doc_id)"""

TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""

_RULES = """rules(verdict, host, path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
)"""


def _host(url: str) -> str:
    return _LOWER.format(rf"regexp_extract(coalesce({url}, ''), '(?s)^.*?://([^/?#]*)', 1)")


def _path(url: str) -> str:
    return rf"regexp_extract(coalesce({url}, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1)"


def _node(url: str) -> str:
    plain = f"regexp_replace({url}, '(?s)#.*$', '')"
    site = f"regexp_extract({plain}, '(?s)^(.*?://[^/?#]*)', 1)"
    rest = f"substr({plain}, length({site}) + 1)"
    return (f"CASE WHEN {site} = '' THEN {plain} ELSE {_LOWER.format(site)} || "
            f"CASE WHEN starts_with({rest}, '/') THEN {rest} ELSE '/' || {rest} END END")


def _verdict(source: str, key: str) -> str:
    """The longest fitting rule of each row."""
    return f"""(
  SELECT {key}, arg_max(r.host || r.path, length(r.host || r.path) * 2 + (r.verdict = 'allow')::INT) AS rule,
         arg_max(r.verdict, length(r.host || r.path) * 2 + (r.verdict = 'allow')::INT) AS verdict
  FROM {source} s JOIN rules r
    ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path)
  GROUP BY {key})"""


#: Links are resolved as far as the tables have them: absolute and root-relative ones.
URL_FILTER = f"""
WITH RECURSIVE {_RULES},
tag AS (
  SELECT {_node('url')} AS a, unnest(list_concat(
    list_transform(list_filter(regexp_extract_all(html, '(?i)<link\\b([^<>]*)>', 1),
                               lambda t: regexp_matches(t, '(?i)\\brel\\s*=\\s*["'']?canonical\\b')),
                   lambda t: regexp_extract(t, '(?i)\\bhref\\s*=\\s*["'']?([^"''\\s>]*)', 1)),
    list_transform(list_filter(regexp_extract_all(html, '(?i)<meta\\b([^<>]*)>', 1),
                               lambda t: regexp_matches(t, '(?i)\\bhttp-equiv\\s*=\\s*["'']?refresh\\b')),
                   lambda t: regexp_extract(t, '(?i)\\burl\\s*=\\s*["'']?([^"''\\s>]*)', 1)))) AS link
  FROM pages WHERE url IS NOT NULL
),
edge AS (
  SELECT a, {_node("CASE WHEN starts_with(link, '/') THEN regexp_extract(a, '(?s)^(.*?://[^/?#]*)', 1) || link ELSE link END")} AS b
  FROM tag WHERE coalesce(link, '') <> ''
),
both_ways AS (SELECT a, b FROM edge WHERE a <> b UNION SELECT b, a FROM edge WHERE a <> b),
reach(a, b) AS (SELECT a, a FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
node AS (SELECT DISTINCT b AS url, {_host('b')} AS host, {_path('b')} AS path FROM reach),
said AS {_verdict('node', 'url')},
by_class AS (
  SELECT r.a AS url, bool_or(s.verdict = 'allow') AS allowed, bool_or(s.verdict = 'block') AS blocked
  FROM reach r JOIN said s ON s.url = r.b GROUP BY r.a
),
page AS (
  SELECT row_number() OVER () AS k, page_id, {_node('url')} AS url,
         {_host('url')} AS host, {_path('url')} AS path FROM pages
),
own AS {_verdict('page', 'k')}
SELECT p.page_id, p.host, p.path, o.rule,
       coalesce(o.verdict, CASE WHEN c.blocked AND NOT c.allowed THEN 'block' ELSE 'allow' END) AS verdict
FROM page p LEFT JOIN own o USING (k) LEFT JOIN by_class c ON c.url = p.url"""

_TOKEN = r"[^\x20\x09-\x0D]+"

JACCARD_JOIN = f"""
WITH RECURSIVE doc AS (SELECT doc_id, {_words('text', _TOKEN)} AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 0) + 2)) AS i FROM doc WHERE len(w) > 0)
),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
both_have AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingle a JOIN shingle b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
link AS (
  SELECT x.a, x.b FROM both_have x JOIN size s ON s.doc_id = x.a JOIN size t ON t.doc_id = x.b
  WHERE 100 * x.n >= 85 * (s.n + t.n - x.n)
),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
least_id AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, l.component_id
FROM documents d LEFT JOIN size s USING (doc_id) JOIN least_id l USING (doc_id)"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

RANKED_SEARCH = f"""
WITH item AS (SELECT row_number() OVER () AS q, item_id, list_distinct({_words('text', _TERM)}) AS w FROM benchmark),
asked AS (SELECT q, item_id, unnest(w) AS t FROM item),
doc AS (SELECT row_number() OVER () AS d, doc_id, {_words('text', _TERM)} AS w FROM documents),
whole AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_words FROM doc WHERE len(w) > 0),
tf AS (
  SELECT d, t, count(*) AS tf FROM (SELECT d, unnest(w) AS t FROM doc) WHERE t IN (SELECT t FROM asked) GROUP BY d, t
),
weight AS (
  SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS idf
  FROM (SELECT t, count(*) AS df FROM tf GROUP BY t) CROSS JOIN whole
),
part AS (
  SELECT d, t, idf * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * len(doc.w) * n_docs) // n_words))) AS s
  FROM tf JOIN weight USING (t) JOIN doc USING (d) CROSS JOIN whole
),
score AS (SELECT q, item_id, d, CAST(sum(s) AS BIGINT) AS score FROM asked JOIN part USING (t) GROUP BY ALL HAVING sum(s) > 0),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank,
         doc_id, score
  FROM score JOIN doc USING (d)
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50"""

#: The crc32 takes its 256 steps from the polynomial; the walk is the published algorithm in 128-bit integers.
SHARDING = """
WITH RECURSIVE seed AS (SELECT DISTINCT coalesce(CAST(doc_id AS VARCHAR), '') AS k FROM documents),
walk(k, n, key, place, dest) AS (
  SELECT k, n, CAST(CAST('0x' || substr(md5(k), 1, 16) AS UBIGINT) AS HUGEINT), CAST(-1 AS BIGINT), CAST(0 AS BIGINT)
  FROM seed CROSS JOIN (VALUES (24), (25)) s(n)
  UNION ALL
  SELECT k, n, moved, dest,
         CAST(floor((dest + 1) * (2147483648::DOUBLE / CAST(moved // 8589934592 + 1 AS DOUBLE))) AS BIGINT)
  FROM (SELECT *, (key * 2862933555777941757 + 1) % 18446744073709551616::HUGEINT AS moved FROM walk WHERE dest < n)
),
home AS (
  SELECT k, CAST(max(place) FILTER (n = 24) AS INTEGER) AS shard, CAST(max(place) FILTER (n = 25) AS INTEGER) AS grown_shard
  FROM walk GROUP BY k
),
bits(b, v, i) AS (
  SELECT r, CAST(r AS BIGINT), 0 FROM range(256) t(r)
  UNION ALL
  SELECT b, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, i + 1 FROM bits WHERE i < 8
),
step AS (SELECT list(v ORDER BY b) AS t FROM bits WHERE i = 8),
doc AS (
  SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS k,
         CAST(octet_length(encode(coalesce(text, ''))) + 8 AS BIGINT) AS size,
         xor(list_reduce([4294967295] || list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                                                        lambda h: CAST('0x' || h AS BIGINT)),
                         lambda x, y: xor(x // 256, t[1 + xor(x % 256, y)])), 4294967295) AS text_crc32
  FROM documents CROSS JOIN step
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32) - 1 AS slot, grown_shard
FROM doc JOIN home USING (k)"""

ORACLE = {
    "op1_decontamination": DECONTAMINATION,
    "op2_topk": TOPK,
    "op8_url_filter": URL_FILTER,
    "op9_jaccard_join": JACCARD_JOIN,
    "op11_ranked_search": RANKED_SEARCH,
    "op13_sharding": SHARDING,
}
