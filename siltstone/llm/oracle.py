"""The queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from siltstone.llm import sharding

OP7 = r"""
WITH sized AS (
  SELECT doc_id, source,
         COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(COALESCE(doc_id::VARCHAR, md5(text), '')) AS k
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r FROM sources),
weighted AS (
  SELECT *, [5.0::DOUBLE, 2.0, 1.0][(r % 3) + 1] AS w, source_size * 2 AS cap,
         source_size * 2 / [5.0::DOUBLE, 2.0, 1.0][(r % 3) + 1] AS full_at
  FROM ranked),
levels AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5
             - COALESCE(sum(cap) OVER (ORDER BY full_at, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
            / sum(w) OVER (ORDER BY full_at, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted),
reached AS (
  SELECT *, max(level) OVER () AS reached FROM levels),
plan AS (
  SELECT source, source_size,
         CASE WHEN full_at < reached THEN cap::DOUBLE ELSE reached * w END AS target
  FROM reached),
placed AS (
  SELECT s.*, p.source_size, p.target, round(p.target)::BIGINT AS words,
         COALESCE(sum(size) OVER (PARTITION BY s.source ORDER BY k, size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begins
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(size, words - begins)) + greatest(0, least(size, words - source_size - begins)))::BIGINT AS taken
FROM placed
"""


OP6 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
         vec_id, score
  FROM scored)
SELECT * FROM ranked WHERE rank <= 20
"""


OP11 = """
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(
           list_concat([i], range(8)), lambda c, _: xor(c >> 1, CASE WHEN (c & 1) = 1 THEN 3988292384 ELSE 0 END))) AS t),
fields AS (
  SELECT doc_id, lang,
         COALESCE(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') AS f1,
         COALESCE(strlen(source) || ':' || source, '-') AS f2,
         COALESCE(strlen(lang) || ':' || lang, '-') AS f3,
         COALESCE(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS f4,
         COALESCE(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') AS f4_more,
         COALESCE(strlen(text) || ':' || text, '-') AS f5,
         xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
               lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 7 = 0 AS hit
  FROM documents, crc_table),
leaves AS (
  SELECT doc_id, lang, sha256(f1 || f2 || f3 || f4 || f5) AS leaf,
         CASE WHEN hit THEN sha256(f1 || f2 || f3 || f4_more || f5) ELSE sha256(f1 || f2 || f3 || f4 || f5) END AS start,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, sha256(f1 || f2 || f3 || f4 || f5)) - 1 AS pos
  FROM fields),
tree AS (
  SELECT 0 AS level, lang, pos, leaf AS h, count(*) OVER (PARTITION BY lang) AS n FROM leaves
  UNION ALL
  SELECT level + 1, lang, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2
  FROM tree WHERE n > 1 GROUP BY level, lang, pos // 2, n),
subroots AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM tree WHERE n = 1),
top AS (
  SELECT 0 AS level, pos, subroot AS h, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2
  FROM top WHERE n > 1 GROUP BY level, pos // 2, n),
steps AS (
  SELECT l.doc_id, l.leaf, l.start, l.pos, l.lang, t.level, (l.pos >> t.level) AS place, s.h AS sibling
  FROM leaves l JOIN tree t ON t.lang IS NOT DISTINCT FROM l.lang AND t.pos = (l.pos >> t.level) AND t.n > 1
  LEFT JOIN tree s ON s.lang IS NOT DISTINCT FROM l.lang AND s.level = t.level AND s.pos = xor(t.pos, 1)
  UNION ALL
  SELECT l.doc_id, l.leaf, l.start, l.pos, l.lang, 1000 + t.level, (r.pos >> t.level), s.h
  FROM leaves l JOIN subroots r ON r.lang IS NOT DISTINCT FROM l.lang
  JOIN top t ON t.pos = (r.pos >> t.level) AND t.n > 1
  LEFT JOIN top s ON s.level = t.level AND s.pos = xor(t.pos, 1)),
paths AS (
  SELECT lang, pos,
         string_agg(COALESCE(sibling, ''), '' ORDER BY level) AS proof,
         list(CASE WHEN (place & 1) = 1 THEN 'L' ELSE 'R' END || COALESCE(sibling, '') ORDER BY level) AS path
  FROM steps GROUP BY lang, pos),
folds AS (
  SELECT l.doc_id, l.leaf, r.subroot, (SELECT h FROM top WHERE n = 1) AS root,
         sha256(COALESCE(p.proof, '')) AS proof_sha256,
         list_reduce(list_concat([l.start], COALESCE(p.path, [])),
           lambda node, s: CASE WHEN s[1] = 'L' THEN sha256(s[2:] || node) ELSE sha256(node || s[2:]) END) AS folded_root
  FROM leaves l JOIN subroots r ON r.lang IS NOT DISTINCT FROM l.lang
  LEFT JOIN paths p ON p.lang IS NOT DISTINCT FROM l.lang AND p.pos = l.pos)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folds
"""


OP12 = """
WITH bytes AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(COALESCE(text, ''))) AS h, strlen(COALESCE(text, ''))::BIGINT AS n
  FROM documents),
slices AS (
  SELECT r, doc_id, n, c, substr(h, 2 * c + 1, 2 * (1024 + 49)) AS s
  FROM (SELECT *, unnest(range(0, n, 1024)) AS c FROM bytes WHERE doc_id IS NOT NULL)),
strings AS (
  SELECT r, doc_id, c + i AS p, substr(s, 2 * i + 1, 100) AS s
  FROM (SELECT *, unnest(range(0, 1024)) AS i FROM slices)
  WHERE c + i + 50 <= n),
firsts AS (
  SELECT s, min(doc_id) AS first_id FROM strings GROUP BY s),
hits AS (
  SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS before
  FROM strings JOIN firsts USING (s) WHERE first_id < doc_id),
runs AS (
  SELECT r, p, sum(CASE WHEN before >= p - 50 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY p) AS run FROM hits),
spans AS (
  SELECT r, min(p) AS b, max(p) + 50 AS e FROM runs GROUP BY r, run),
pieces AS (
  SELECT *, COALESCE(lag(e) OVER (PARTITION BY r ORDER BY b), 0) AS since FROM spans),
cut AS (
  SELECT r, sum(e - b) AS n_removed, count(*) AS n_spans, max(e) AS last,
         string_agg(substr(h, 2 * since + 1, 2 * (b - since)), '' ORDER BY b) AS front
  FROM pieces JOIN bytes USING (r) GROUP BY r)
SELECT doc_id, n AS n_bytes, COALESCE(n_removed, 0)::BIGINT AS n_removed, COALESCE(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(COALESCE(front, '') || substr(h, 2 * COALESCE(last, 0) + 1))) AS kept_sha256
FROM bytes LEFT JOIN cut USING (r)
"""


def op3() -> str:
    table = ",".join(map(str, sharding.fill_table(sharding.shard_names(64))))
    return f"""
SELECT doc_id, slot, [{table}][slot + 1]::INTEGER AS shard
FROM (SELECT doc_id,
             ('0x' || substr(md5(COALESCE(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {sharding.TABLE_SIZE} AS slot
      FROM documents)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_sharding": op3(),
        "op6_exact_topk": OP6,
        "op7_mixing": OP7,
        "op11_manifest": OP11,
        "op12_suffix_dedup": OP12,
    }
