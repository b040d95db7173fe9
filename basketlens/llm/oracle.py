"""DuckDB counterparts of the queries that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from basketlens.llm import line_chunks, pivot_permutation, url_vocabulary
from basketlens.llm.queries import URL_RULES

_LINE_DEDUP = f"""
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS i, len(parts) AS n FROM split),
hashed AS (SELECT *, CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) & 2147483647 AS h FROM lines),
rolled AS (SELECT *, (h % {line_chunks.MODULUS} + coalesce(lag(h) OVER w, 0) % {line_chunks.MODULUS}
  * {line_chunks.BASE} % {line_chunks.MODULUS}) % {line_chunks.MODULUS} AS r
  FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
ended AS (SELECT *, i = n OR coalesce(r < lag(r) OVER w AND r <= lead(r) OVER w, false) AS last
  FROM rolled WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (SELECT *, coalesce(sum(CAST(last AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM ended),
chunks AS (SELECT doc_id, pos, count(*) AS size, string_agg(line, chr(10) ORDER BY i) AS chunk
  FROM numbered GROUP BY doc_id, pos),
judged AS (SELECT *, size > 1 AND row_number() OVER (PARTITION BY size > 1, chunk ORDER BY doc_id, pos) > 1 AS gone
  FROM chunks),
joined AS (SELECT doc_id, coalesce(string_agg(chunk, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text,
  CAST(sum(size) AS BIGINT) AS n_lines, count(*) AS n_chunks, count(*) FILTER (WHERE gone) AS n_removed
  FROM judged GROUP BY doc_id)
SELECT d.doc_id, j.text, coalesce(n_lines, 0) AS n_lines, coalesce(n_chunks, 0) AS n_chunks,
  coalesce(n_removed, 0) AS n_removed FROM documents d LEFT JOIN joined j USING (doc_id)
"""

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_WARC = f"""
WITH payloads AS (SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
latest AS (SELECT payload, max(page_id) AS latest FROM payloads GROUP BY payload)
SELECT page_id, CAST(octet_length(p.payload) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k: substr('{_BASE32}',
    CAST((CAST('0x' || substr(hex, CAST(k // 4 * 5 + 1 AS INTEGER), 5) AS BIGINT) >> CAST(15 - k % 4 * 5 AS INTEGER)) & 31
    AS INTEGER) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = latest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> latest THEN latest END AS refers_to, CAST(NULL AS VARCHAR) AS error
FROM payloads p JOIN latest l ON p.payload = l.payload
"""

_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_DECONTAMINATE = f"""
WITH docs AS (SELECT doc_id, coalesce({_WORDS.format("text")}, []) AS words FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS.format("text")} AS words FROM benchmark),
cut AS (SELECT item, words, least(10, len(words)) AS k FROM items WHERE len(words) > 0),
windows AS (SELECT DISTINCT item, k, unnest(list_transform(range(1, CAST(len(words) - k + 2 AS BIGINT)),
  lambda i: array_to_string(list_slice(words, i, i + k - 1), ' '))) AS part FROM cut),
sizes AS (SELECT DISTINCT k FROM windows),
places AS (SELECT doc_id, k, unnest(range(1, CAST(len(words) - k + 2 AS BIGINT))) AS i, unnest(list_transform(
  range(1, CAST(len(words) - k + 2 AS BIGINT)), lambda i: array_to_string(list_slice(words, i, i + k - 1), ' '))) AS part
  FROM docs, sizes WHERE len(words) >= k),
hits AS (SELECT doc_id, i, p.k, item FROM places p JOIN windows w ON p.part = w.part AND p.k = w.k),
hit_words AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS place
  FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


def _url_sql() -> str:
    rules = ", ".join(f"('{verdict}', '{rule}')" for verdict, rule in URL_RULES)
    folded = "translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def found(term: str) -> str:
        return rf"regexp_extract_all(u, '(?:^|[^\p{{L}}\p{{N}}]){term}(?:$|[^\p{{L}}\p{{N}}])')"

    strict = " + ".join(f"len({found(t)})" for t in url_vocabulary.STRICT)
    soft = ", ".join(f"CASE WHEN len({found(t)}) > 0 THEN '{t}' END" for t in sorted(url_vocabulary.SOFT))
    return f"""
WITH rules(verdict, rule) AS (VALUES {rules}),
cut AS (SELECT page_id, coalesce({folded}, '') AS u, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3)
  ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, u, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
fits AS (SELECT p.page_id, rule, verdict FROM parts p JOIN rules r
  ON ends_with('.' || host, '.' || split_part(rule, '/', 1)) AND starts_with(path, substr(rule, strpos(rule, '/')))),
best AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM fits GROUP BY page_id),
counted AS (SELECT page_id, host, path, CAST({strict} AS BIGINT) AS strict_hits,
  list_filter([{soft}], lambda t: t IS NOT NULL) AS soft_terms FROM parts)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN strict_hits > 0
  OR len(soft_terms) >= {url_vocabulary.SOFT_LIMIT} THEN 'block' ELSE 'allow' END) AS verdict, strict_hits, soft_terms
FROM counted LEFT JOIN best USING (page_id)
"""


_EMBEDDINGS = f"""
WITH RECURSIVE vectors AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
usable AS (SELECT vec_id, v FROM vectors WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id
  AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= {pivot_permutation.THRESHOLD}),
reach AS (SELECT vec_id AS a, vec_id AS b FROM vectors UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
degrees AS (SELECT a, count(*) AS n_links FROM links GROUP BY a),
groups AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM groups LEFT JOIN degrees ON vec_id = degrees.a
"""


def llm_oracles() -> dict[str, str]:
    own = {
        "op2_line_chunks": _LINE_DEDUP,
        "op4_warc_zstd": _WARC,
        "op5_decontaminate": _DECONTAMINATE,
        "op8_url_vocabulary": _url_sql(),
        "op9_pivot_permutation": _EMBEDDINGS,
    }
    return own | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
