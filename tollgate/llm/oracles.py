"""DuckDB SQL of the queries that SQL can express on whole tables."""

LINKS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
), ok AS (
  SELECT vec_id, label, e FROM v
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(e) > 0
    AND len([c FOR c IN e IF c IS NULL OR NOT isfinite(c)]) = 0 AND len([c FOR c IN e IF c <> 0]) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e) * list_inner_product(b.e, b.e)) >= 0.93
), reach(id, other) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a
)
SELECT v.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component AS component_id, v.vec_id = c.component AS kept
FROM v LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON v.vec_id = n.a
JOIN (SELECT id, min(other) AS component FROM reach GROUP BY id) c ON v.vec_id = c.id
"""

ARCHIVES = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h FROM pages
), d AS (
  SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS first FROM p
)
SELECT page_id, payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (((('0x' || substr(x, 1 + 5 * (i // 4)::INTEGER, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31))::INTEGER, 1)
    FOR i IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE len(words) WHEN 0 THEN [] WHEN 1 THEN words
    ELSE [words[i::INTEGER] || ' ' || words[(i + 1)::INTEGER] FOR i IN range(1, len(words))] END) AS shingle
  FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
    GROUP BY ALL
  ) JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id
  WHERE 100 * shared >= 80 * (na.n + nb.n - shared)
), reach(id, other) AS (
  SELECT doc_id, doc_id FROM w UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a
)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component AS component_id, w.doc_id = c.component AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT id, min(other) AS component FROM reach GROUP BY id) c ON w.doc_id = c.id
"""

FILL_MIDDLE = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS k,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), u AS (
  SELECT *, len(k)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
    ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
  FROM d
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
         WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), p AS (
  SELECT *, array_to_string(k[1:a], '') AS prefix, array_to_string(k[a + 1:b], '') AS middle, array_to_string(k[b + 1:], '') AS suffix
  FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""

CHAT = r"""
WITH r AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), t AS (
  SELECT conv_id, turn, role AS o1, text AS o2, coalesce(role, '') AS role, coalesce(text, '') AS text FROM r
), g AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '<\\*/?s>|\[\\*(/?INST|/?ROLE|TEXT)\]')) AS guarded,
    length(role) + len(regexp_extract_all(role, '<\\*/?s>|\[\\*(/?INST|/?ROLE|TEXT)\]')) AS guarded_role
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, o1 NULLS FIRST, o2 NULLS FIRST)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, o1 NULLS FIRST, o2 NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (3 + sum(CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 5 ELSE 19 + guarded_role END + guarded))::BIGINT AS formatted_chars
FROM g GROUP BY conv_id
"""

ORACLE_SQL = {
    "op2_subspace_join": LINKS,
    "op4_warc_chunks": ARCHIVES,
    "op10_similarity_sketch": NEAR_DUPLICATES,
    "op12_fill_middle": FILL_MIDDLE,
    "op13_chat_template": CHAT,
}
