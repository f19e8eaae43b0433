"""DuckDB SQL for the queries that SQL can express."""

HOST = r"translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = rf"""
WITH parts AS (
  SELECT page_id, {HOST} AS host, coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages
), rules(rule, r_host, r_path, verdict) AS (
  VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
         ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')
), best AS (
  SELECT host, path, arg_max(struct_pack(rule := rule, verdict := verdict), length(r_host) * 10000 + length(r_path)) AS m
  FROM (SELECT DISTINCT host, path FROM parts) p JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
  GROUP BY host, path
)
SELECT page_id, p.host, p.path, m.rule AS rule, coalesce(m.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN best b ON p.host = b.host AND p.path = b.path
"""

CONTROL = r"(<\\*s>|<\\*<SYS>>|<\\*</SYS>>|\[\\*INST\]|\[\\*/INST\]|\[\\*ANS\]|<\\*/s>|\[\\*TURN\]|\[\\*/TURN\])"

OP9 = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r, text AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]', 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]', 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)) AS loss_sha256,
  CAST(3 + sum(length(text) + len(regexp_extract_all(text, '{CONTROL}'))
    + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 9 ELSE 14 + length(role) END) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

OP10 = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 10
"""

KEY = r"translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4 = rf"""
WITH cut AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lined AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM cut
), keyed AS (
  SELECT doc_id, line, pos, {KEY} AS key FROM lined
), repeated AS (
  SELECT key, max(doc_id) AS last FROM (SELECT DISTINCT doc_id, key FROM keyed WHERE length(key) >= 20)
  GROUP BY key HAVING count(*) >= 3
), judged AS (
  SELECT k.doc_id, line, pos, r.key IS NOT NULL AND k.doc_id <> r.last AS gone FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

OP8 = r"""
WITH worded AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), windows AS (
  SELECT doc_id, i, sha256(array_to_string(words[i:i + 49], ' ')) AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM worded WHERE len(words) >= 50)
), firsts AS (
  SELECT w, min(doc_id) AS first FROM windows GROUP BY w HAVING count(*) > 1
), gone AS (
  SELECT DISTINCT doc_id, p FROM (
    SELECT s.doc_id, unnest(range(i, i + 50)) AS p FROM windows s JOIN firsts f ON s.w = f.w WHERE f.first < s.doc_id)
), marked AS (
  SELECT w.doc_id, p, word, g.p IS NOT NULL AS out
  FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM worded) w LEFT JOIN gone g USING (doc_id, p)
), kept AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (out) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (NOT out) AS text
  FROM marked GROUP BY doc_id
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM worded LEFT JOIN kept USING (doc_id)
"""

INERT = "(list_inner_product(v, v) - 2 * list_inner_product(v, m) + list_inner_product(m, m))"
NEAREST = "SELECT id, vec_id, v, c, {d} AS d FROM kept, {c} QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, c) = 1"
MOVED = """SELECT c0.c, coalesce(x.m, c0.m) AS m FROM {c} c0 LEFT JOIN (
    SELECT c, list(floor_ ORDER BY pos) AS m FROM (
      SELECT c, pos, CAST((s - ((s % n) + n) % n) // n AS DOUBLE) AS floor_ FROM (
        SELECT c, pos, CAST(sum(x) AS HUGEINT) AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM {a}) GROUP BY c, pos))
    GROUP BY c) x ON x.c = c0.c"""
OP11 = f"""
WITH kept AS (
  SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c1 AS (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS m FROM (SELECT sha256('1:' || vec_id) AS h, v FROM kept ORDER BY h, v LIMIT 16)
), a1 AS ({NEAREST.format(d=INERT, c="c1")}), c2 AS ({MOVED.format(c="c1", a="a1")}
), a2 AS ({NEAREST.format(d=INERT, c="c2")}), c3 AS ({MOVED.format(c="c2", a="a2")}
), a3 AS ({NEAREST.format(d=INERT, c="c3")}), c4 AS ({MOVED.format(c="c3", a="a3")}
), a4 AS ({NEAREST.format(d=INERT, c="c4")})
SELECT vec_id, CAST(a4.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY a4.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(list_transform(c4.m, lambda x: CAST(x AS BIGINT)), ',')) AS centroid_sha256
FROM a4 JOIN c4 ON a4.c = c4.c
"""

ORACLE_SQL = {"op1_url_filter": OP1, "op4_line_dedup": OP4, "op8_substring_dedup": OP8, "op9_chat_formatting": OP9, "op10_exact_top_k": OP10, "op11_centroid_clustering": OP11}
