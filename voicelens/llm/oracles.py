"""DuckDB SQL for the training-data queries that SQL can express, stated relationally and on whole tables."""

from __future__ import annotations

from .line_rules import ORACLE_SQL as LINE_RULES
from .prefix_trie import ORACLE_SQL as PREFIX_TRIE

EXACT_DEDUP = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

JACCARD_JOIN = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS p FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(p[i:i + 4], ' ') AS g
      FROM (SELECT doc_id, p, unnest(range(1, greatest(len(p) - 3, 2))) AS i FROM w WHERE len(p) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
ends AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT x AS a, y AS b FROM ends UNION SELECT reach.a, ends.y FROM reach JOIN ends ON ends.x = reach.b)
SELECT d.doc_id, any_value(coalesce(n.n, 0)) AS n_shingles, least(d.doc_id, coalesce(min(b), d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN reach ON reach.a = d.doc_id GROUP BY d.doc_id
"""

#: The pages of the test tables hold one article each; this reads it by patterns.
HTML = """
WITH b AS (SELECT page_id, url, unnest(l) AS x, unnest(range(0, len(l))) AS i
           FROM (SELECT page_id, url, regexp_split_to_array(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '</?(?:h1|p)[^>]*>|<br>') AS l FROM pages)),
t AS (SELECT page_id, url, i, regexp_replace(x, '<[^>]*>', '', 'g') AS x FROM b),
u AS (SELECT page_id, url, i, regexp_replace(replace(replace(replace(regexp_replace(x, '&quot;?', '"', 'g'), '&lt;', '<'), '&gt;', '>'), '&#39;', chr(39)), '&amp;?', '&', 'g') AS x FROM t),
v AS (SELECT page_id, url, i, trim(regexp_replace(x, '\\s+', ' ', 'g')) AS x FROM u),
j AS (SELECT page_id, url, coalesce(string_agg(x, ' ' ORDER BY i) FILTER (x <> ''), '') AS text FROM v GROUP BY page_id, url)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM j
"""

ORACLES = {
    "op1_exact_dedup": EXACT_DEDUP,
    "op5_html_wrappers": HTML,
    "op6_line_rules": LINE_RULES,
    "op10_ngram_jaccard_join": JACCARD_JOIN,
    "op13_zfast_trie": PREFIX_TRIE,
}
