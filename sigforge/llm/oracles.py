"""DuckDB SQL of the operators that SQL can express, by other means than the operators use."""

from __future__ import annotations

from .common import LETTER_WORD, LOWER, SPACED_WORD, UPPER


def _words(pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{pattern}')"


DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_words(LETTER_WORD)} AS w FROM documents),
b AS (SELECT item_id, {_words(LETTER_WORD)} AS w FROM benchmark),
item AS (SELECT item_id, w, least(13, len(w)) AS n FROM b WHERE len(w) > 0),
win AS (SELECT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS k FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM item)),
place AS (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS k FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
found AS (SELECT doc_id, place.n, i, item_id FROM place JOIN win ON place.n = win.n AND place.k = win.k),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM found) GROUP BY 1),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM found GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_words(SPACED_WORD)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) >= 2 THEN list_slice(w, i, i + 1) ELSE w END AS k FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM d WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pair AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.k = y.k AND x.doc_id < y.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
sym AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, sym.b FROM reach r JOIN sym ON r.b = sym.a),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM d LEFT JOIN size USING (doc_id) JOIN comp USING (doc_id)"""
