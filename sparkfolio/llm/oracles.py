"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_LOW = "translate(%s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINES = f"""
WITH a AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, i, l[i] AS line, {_LOW % f"trim(l[i], {_BLANKS})"} AS key FROM a, unnest(range(1, len(l) + 1)) AS t(i)),
shared AS (SELECT key, min(doc_id) AS first FROM lines WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
marked AS (SELECT n.*, s.key IS NOT NULL AND s.first <> n.doc_id AS gone FROM lines n LEFT JOIN shared s ON n.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_WORDS = rf"regexp_extract_all({_LOW % 'text'}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

WINDOWS = rf"""
WITH b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win FROM b, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
own AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM d, (SELECT DISTINCT n FROM windows) AS s, unnest(range(1, len(w) - n + 2)) AS t(i)),
hits AS (SELECT own.doc_id, own.i, own.n, windows.item_id FROM own JOIN windows ON own.n = windows.n AND own.win = windows.win),
marks AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM hits, unnest(range(i, i + n)) AS t(j) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated FROM d LEFT JOIN marks USING (doc_id) LEFT JOIN items USING (doc_id)
"""
