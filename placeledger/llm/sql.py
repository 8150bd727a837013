"""DuckDB SQL for the queries of this folder that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {
    "op2_preference_format": """
WITH marked AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    last_value(CASE WHEN role = 'assistant' THEN coalesce(text, '') END IGNORE NULLS) OVER (
      PARTITION BY conv_id ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier,
    count(CASE WHEN role = 'assistant' THEN 1 END) OVER (
      PARTITION BY conv_id ORDER BY turn, role, text ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS after
  FROM conversations
), sides AS (
  SELECT conv_id, turn, role, text AS chosen,
    CASE WHEN role = 'assistant' AND after = 0 THEN coalesce(earlier, '') ELSE text END AS rejected
  FROM marked
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, chosen) AS place,
    '<|' || role || '|>' || chr(10) AS head, chosen || '<|end|>' || chr(10) AS chosen_body,
    rejected || '<|end|>' || chr(10) AS rejected_body,
    CASE WHEN role = 'assistant' THEN ':1' ELSE ':0' END AS flag
  FROM sides
), cut AS (
  SELECT *, coalesce(min(CASE WHEN chosen <> rejected THEN place END) OVER (PARTITION BY conv_id) - 1,
    count(*) OVER (PARTITION BY conv_id)) AS n
  FROM placed
)
SELECT conv_id, CAST(max(n) AS INTEGER) AS n_prompt_turns,
  coalesce(string_agg(CASE WHEN place <= n THEN head || chosen_body END, '' ORDER BY place), '') AS prompt,
  coalesce(string_agg(CASE WHEN place > n THEN head || chosen_body END, '' ORDER BY place), '') AS chosen,
  coalesce(string_agg(CASE WHEN place > n THEN head || rejected_body END, '' ORDER BY place), '') AS rejected,
  coalesce(string_agg(CASE WHEN place > n THEN length(head) || ':0,' || length(chosen_body) || flag END, ',' ORDER BY place), '') AS chosen_mask,
  coalesce(string_agg(CASE WHEN place > n THEN length(head) || ':0,' || length(rejected_body) || flag END, ',' ORDER BY place), '') AS rejected_mask
FROM cut GROUP BY conv_id
""",
    "op4_decontamination": """
WITH docs AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w
  FROM (SELECT DISTINCT doc_id, text FROM documents)
), items AS (
  SELECT row_number() OVER () AS i, item_id, w, least(len(w), 5) AS m
  FROM (SELECT DISTINCT item_id, text, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM benchmark) WHERE len(w) > 0
), item_shingles AS (
  SELECT DISTINCT i, m, unnest(list_transform(range(1, len(w) - m + 2), lambda k: array_to_string(w[k:k + m - 1], ' '))) AS s
  FROM items
), doc_shingles AS (
  SELECT DISTINCT d, m, unnest(list_transform(range(1, len(w) - m + 2), lambda k: array_to_string(w[k:k + m - 1], ' '))) AS s
  FROM docs, (SELECT DISTINCT m FROM items) WHERE len(w) >= m
), sizes AS (SELECT i, count(*) AS n_shingles FROM item_shingles GROUP BY i),
found AS (
  SELECT d, i, count(*) AS n_found FROM doc_shingles JOIN item_shingles USING (m, s) GROUP BY d, i
)
SELECT doc_id, item_id, n_shingles, n_found, n_found / n_shingles AS containment
FROM found JOIN sizes USING (i) JOIN docs USING (d) JOIN items USING (i)
WHERE n_found >= ceil(n_shingles * 0.8 - 1e-9)
""",
    "op7_vector_range_join": """
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), usable AS (
  SELECT vec_id, v FROM vectors
  WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95
), reached(vec_id, other) AS (
  SELECT vec_id, vec_id FROM vectors
  UNION
  SELECT r.vec_id, l.b FROM reached r JOIN links l ON r.other = l.a
), components AS (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id),
counted AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT c.vec_id, coalesce(n_links, 0) AS n_links, component_id, c.vec_id = component_id AS kept
FROM components c LEFT JOIN counted USING (vec_id)
""",
    "op13_merkle_manifest": """
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i:
    list_reduce(list_concat([i], range(8)), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) AS t
), fields AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, text,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-')
      || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
      || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS head,
    xor(4294967295, list_reduce(list_concat([4294967295], list_transform(
      string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda x, b: xor(x >> 8, t[(xor(x, b) & 255) + 1]))) AS sum,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered
  FROM documents, crc
), leaves AS (
  SELECT rid, doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN coalesce(sum, 0) % 3 = 0 THEN sha256(head || coalesce(strlen(lowered) || ':' || lowered, '-')) END AS other
  FROM fields
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves
), levels(lang, level, nodes) AS (
  SELECT lang, 0, list(leaf ORDER BY pos) FROM placed GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, list_transform(range(0, len(nodes), 8), lambda i: sha256(array_to_string(nodes[i + 1:i + 8], '')))
  FROM levels WHERE len(nodes) > 1
), subroots AS (
  SELECT lang, level AS height, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos
  FROM levels WHERE len(nodes) = 1
), tops(level, nodes) AS (
  SELECT 0, list(subroot ORDER BY pos) FROM subroots
  UNION ALL
  SELECT level + 1, list_transform(range(0, len(nodes), 8), lambda i: sha256(array_to_string(nodes[i + 1:i + 8], '')))
  FROM tops WHERE len(nodes) > 1
), ways AS (
  SELECT rid, l.level AS step, nodes, pos >> (3 * l.level) AS place
  FROM placed p JOIN levels l ON p.lang IS NOT DISTINCT FROM l.lang WHERE len(nodes) > 1
  UNION ALL
  SELECT rid, s.height + t.level, nodes, s.pos >> (3 * t.level)
  FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang, tops t WHERE len(nodes) > 1
), steps AS (
  SELECT rid, step, array_to_string(list_filter(nodes, lambda n, i: i > place // 8 * 8 AND i <= place), '') AS before,
    array_to_string(list_filter(nodes, lambda n, i: i > place + 1 AND i <= place // 8 * 8 + 8), '') AS after
  FROM ways
), proofs AS (
  SELECT rid, string_agg(before || after, '' ORDER BY step) AS proof FROM steps GROUP BY rid
), folded(rid, step, node) AS (
  SELECT rid, 0, coalesce(other, leaf) FROM leaves
  UNION ALL
  SELECT f.rid, f.step + 1, sha256(before || node || after) FROM folded f JOIN steps s ON f.rid = s.rid AND f.step = s.step
)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang
JOIN (SELECT rid, max_by(node, step) AS folded_root FROM folded GROUP BY rid) USING (rid)
LEFT JOIN proofs USING (rid), (SELECT nodes[1] AS root FROM tops WHERE len(nodes) = 1)
""",
}
