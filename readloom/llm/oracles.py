"""SQL of the text operators that SQL can express on whole tables."""

ORACLES = {
    "op9_vp_nearest": """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding) AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
 p AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e) AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 20
""",
    "op1_minhash_near_dedup": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
 s AS (SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS shingle FROM (SELECT *, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
 c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_have FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY 1, 2),
 l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * both_have >= 85 * (x.n + y.n - both_have)),
 e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
 r AS (SELECT a AS node, b AS reached FROM e UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.reached),
 m AS (SELECT node, min(reached) AS least FROM r GROUP BY 1)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(w.doc_id, m.least) AS component_id, w.doc_id <= coalesce(m.least, w.doc_id) AS kept FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN m ON m.node = w.doc_id
""",
    "op10_substring_dedup": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
 x AS (SELECT doc_id, i, array_to_string(ws[i : i + 12], ' ') AS win FROM (SELECT *, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)),
 g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM (SELECT *, min(doc_id) OVER (PARTITION BY win) AS least FROM x) WHERE least < doc_id),
 e AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
 k AS (SELECT e.doc_id, count(*) FILTER (g.p IS NOT NULL) AS n_removed, string_agg(word, ' ' ORDER BY e.p) FILTER (g.p IS NULL) AS kept FROM e LEFT JOIN g ON g.doc_id = e.doc_id AND g.p = e.p GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN k ON k.doc_id = w.doc_id
""",
    "op11_filter_audit": r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
 m AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY 1),
 v AS (
  SELECT d.doc_id, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
   MAP {'A': len(ws) < 100, 'B': 100 * len(list_distinct(ws)) < 80 * len(ws), 'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text),
        'D': regexp_matches(text, '[#$%&*|]'), 'E': coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY text), false)} AS fails
  FROM d LEFT JOIN m ON m.doc_id = d.doc_id),
 f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
 o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM f a, f b, f c, f d, f e WHERE length(regexp_replace(a.f || b.f || c.f || d.f || e.f, '[^A]', '', 'g')) = 1 AND len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
 s AS (SELECT filter_order, i AS step, filter_order[i] AS filter, filter_order[1 : i - 1] AS before FROM o, (SELECT unnest(range(1, 6)) AS i)),
 x AS (
  SELECT part, filter_order, step, filter, fails[filter] AS failing, good, toxic,
   len(list_filter(string_split(before, ''), lambda g: g <> '' AND fails[g])) > 0 AS gone, len(list_filter(['A', 'B', 'C', 'D', 'E'], lambda g: fails[g])) AS n_fails
  FROM s, v),
 r AS (
  SELECT part, filter_order, step, filter, count(*) FILTER (NOT gone AND NOT failing) AS kept, count(*) FILTER (NOT gone AND failing) AS removed, count(*) FILTER (gone AND failing) AS redundant,
   count(*) FILTER (failing AND n_fails = 1) AS unique_fails, count(*) FILTER (NOT gone AND failing AND good = 1) AS good_lost, count(*) FILTER (NOT gone AND failing AND toxic = 1) AS toxic_lost
  FROM x GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley FROM r
""",
    "op12_chat_format": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')) AS planted(conv_id, turn, role, text)),
 e AS (
  SELECT *, length(regexp_replace(text, '([<\[])(\\*/?(?:s>|INST\]|ROLE\]))', '\1\\\2', 'g')) AS n_text, length(regexp_replace(role, '([<\[])(\\*/?(?:s>|INST\]|ROLE\]))', '\1\\\2', 'g')) AS n_role FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
 CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
 CAST(sum(CASE role WHEN 'user' THEN length('[INST]  [/INST]') + n_text WHEN 'assistant' THEN length('<s>  </s>') + n_text ELSE length('<s>[ROLE]  [/ROLE]  </s>') + n_role + n_text END) AS BIGINT) AS formatted_chars,
 CAST(0 AS BIGINT) AS rewritten
FROM e GROUP BY 1
""",
    "op13_prefix_trie": r"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS said FROM conversations WHERE conv_id IS NOT NULL),
 k AS (
  SELECT conv_id, list(said ORDER BY pos) AS own,
   xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) % 6 AS h
  FROM t GROUP BY 1),
 b AS (SELECT k.conv_id AS c, list_concat(coalesce(o.own[1 : k.h], []), coalesce(k.own[k.h + 1 :], [])) AS says FROM k LEFT JOIN k o ON o.conv_id = k.conv_id - k.conv_id % 100),
 p AS (SELECT c, says, d, says[1 : d] AS path FROM (SELECT *, unnest(range(0, len(says) + 1)) AS d FROM b)),
 n AS (
  SELECT path, d, min(c) AS conv_id, count(*) AS n_convs, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(says) = d), '') AS ended, (count(*) - 1) * coalesce(length(any_value(path)[-1].text), 0) AS saved
  FROM p GROUP BY 1, 2),
 u AS (SELECT n.path, n.d, count(*) FILTER (NOT EXISTS (SELECT 1 FROM n z WHERE z.d = x.d + 1 AND z.path[1 : x.d] = x.path)) AS n_leaves, sum(x.saved) AS saved_tokens, count(*) FILTER (x.d = n.d + 1) AS n_children FROM n JOIN n x ON x.d >= n.d AND x.path[1 : n.d] = n.path GROUP BY 1, 2)
SELECT n.conv_id, n.d AS depth, a.conv_id AS parent_conv_id, n.n_convs, u.n_children, u.n_leaves, CAST(u.saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ended) AS ends_sha256
FROM n JOIN u ON u.path = n.path AND u.d = n.d LEFT JOIN n a ON a.d = n.d - 1 AND a.path = n.path[1 : n.d - 1]
""",
}
