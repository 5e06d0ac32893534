"""The same results as SQL over the given tables, by plain counting and comparing."""

from lakeseries.llm.licenses import TEMPLATES


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_NOTICES = ", ".join(f"({i}, {_text(name)}, {_text(text)})" for i, (name, text) in enumerate(TEMPLATES))

_PLAIN = r"'[\p{L}\p{N}]+'"
_WORD = r"'[^\x20\x09-\x0D]+'"

NEAR_DUPLICATES = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), {_WORD}) AS w FROM documents),
shingles AS (
  SELECT doc_id, s, count(*) AS c
  FROM (SELECT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 2)),
               lambda i: array_to_string(w[i:i + 4], ' '))) AS s
        FROM words WHERE len(w) > 0)
  GROUP BY doc_id, s),
sizes AS (SELECT doc_id, sum(c) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, sum(least(x.c, y.c)) AS c
  FROM shingles AS x JOIN shingles AS y ON x.s = y.s AND x.doc_id <> y.doc_id
  GROUP BY a, b),
links AS (
  SELECT a, b FROM common JOIN sizes AS p ON p.doc_id = a JOIN sizes AS q ON q.doc_id = b
  WHERE c >= 0.8 * (p.n + q.n - c)),
reach AS (
  SELECT a, b FROM links
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
classes AS (
  SELECT doc_id, least(doc_id, min(b)) AS class_id
  FROM documents LEFT JOIN reach ON a = doc_id GROUP BY doc_id)
SELECT doc_id, class_id, count(*) OVER (PARTITION BY class_id) AS class_size FROM classes
"""

OVERLAPS = f"""
WITH items AS (
  SELECT item_id, regexp_extract_all(lower(text), {_PLAIN}) AS w FROM benchmark),
item_words AS (
  SELECT item_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM items),
doc_words AS (
  SELECT doc_id, len(w) AS m, unnest(w) AS word, generate_subscripts(w, 1) AS p
  FROM (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), {_PLAIN}) AS w FROM documents)),
same AS (
  SELECT doc_id, item_id, m, n, p - i AS shift, i FROM doc_words JOIN item_words USING (word)),
short AS (
  SELECT doc_id, item_id, n AS matched FROM same WHERE n < 13 AND (n >= 5 OR n = m)
  GROUP BY doc_id, item_id, n, shift HAVING count(*) = n),
ahead AS (
  SELECT doc_id, item_id, count(*) OVER (
           PARTITION BY doc_id, item_id, shift ORDER BY i
           RANGE BETWEEN CURRENT ROW AND 12 FOLLOWING) AS matched
  FROM same WHERE n >= 13)
SELECT doc_id, item_id, CAST(max(matched) AS INTEGER) AS matched
FROM (SELECT doc_id, item_id, matched FROM ahead WHERE matched >= 10 UNION ALL SELECT * FROM short)
GROUP BY doc_id, item_id
"""

NOTICES = f"""
WITH notices AS (
  SELECT template, license, regexp_extract_all(lower(text), {_PLAIN}) AS w
  FROM (VALUES {_NOTICES}) AS t(template, license, text)),
parts AS (
  SELECT DISTINCT template, license, s
  FROM (SELECT template, license, unnest(list_transform(range(1, len(w) - 3),
               lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM notices)),
have AS (
  SELECT DISTINCT doc_id, s
  FROM (SELECT doc_id, unnest(list_transform(range(1, len(w) - 3),
               lambda i: array_to_string(w[i:i + 4], ' '))) AS s
        FROM (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), {_PLAIN}) AS w
              FROM documents))),
sizes AS (SELECT template, count(*) AS n FROM parts GROUP BY template),
shares AS (
  SELECT doc_id, license, count(*) / CAST(max(n) AS DOUBLE) AS containment
  FROM have JOIN parts USING (s) JOIN sizes USING (template)
  GROUP BY doc_id, template, license)
SELECT doc_id, license, max(containment) AS containment
FROM shares WHERE containment >= 0.8 GROUP BY doc_id, license
"""

REPEATED_WINDOWS = f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words)),
repeated AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, i + d AS p
  FROM windows SEMI JOIN repeated USING (s), (SELECT unnest(range(35)) AS d)),
kept AS (
  SELECT x.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY x.p) AS text
  FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM words) AS x
  ANTI JOIN gone ON x.doc_id = gone.doc_id AND x.p = gone.p
  GROUP BY x.doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

REVISITS = """
WITH heads AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
named AS (
  SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
         array_to_string(list_transform(range(32), lambda k:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (
             (CAST('0x' || substr(hex, CAST(5 * (k // 4) + 1 AS BIGINT), 5) AS BIGINT)
              >> CAST(15 - 5 * (k % 4) AS BIGINT)) & 31) AS BIGINT), 1)), '') AS payload_digest,
         max(page_id) OVER (PARTITION BY html) AS last
  FROM heads)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM named
"""

TOP_PRODUCTS = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda c: floor(64 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
products AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM vectors AS q JOIN vectors AS c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place
      FROM products)
WHERE place <= 20
"""

ORACLES = {
    "op12_norm_sorted_topk": TOP_PRODUCTS,
    "op3_dart_minhash": NEAR_DUPLICATES,
    "op4_spaced_seeds": OVERLAPS,
    "op5_license_notices": NOTICES,
    "op7_superkmer_windows": REPEATED_WINDOWS,
    "op10_warc_revisits": REVISITS,
}
