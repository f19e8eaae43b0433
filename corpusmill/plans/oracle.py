"""DuckDB SQL that gives the same rows as the queries, written independently of their expressions."""

from __future__ import annotations

from corpusmill.functions.text import STOPWORDS

WORD = "[A-Za-z][A-Za-z0-9''+-]*"
STOP = ", ".join(f"'{w}'" for w in STOPWORDS)


def words(x: str) -> str:
    return f"list_transform(regexp_extract_all({x}, '{WORD}'), lambda z: lower(z))"


def terms(x: str) -> str:
    return f"list_filter({words(x)}, lambda z: length(z) >= 2 AND z NOT IN ({STOP}))"


def tokens(x: str) -> str:
    return (
        f"CAST(CASE WHEN length({x}) = 0 THEN 0 ELSE greatest(1, round_even(length({x}) / 4.0::DOUBLE, 0), "
        f"round_even(len(regexp_extract_all({x}, '{WORD}')) * 1.3::DOUBLE, 0)) END AS BIGINT)"
    )


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def slug(x: str) -> str:
    return f"regexp_replace(regexp_replace(lower(regexp_replace(strip_accents({x}), '[^\\x00-\\x7f]', '', 'g')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"


def summary(x: str) -> str:
    return f"left(split_part(regexp_replace({strip(x)}, '([.!?])\\s', '\\1' || chr(1)), chr(1), 1), 240)"


MARKED = "regexp_replace({x}, '([.!?])\\s+([A-Z0-9\"''(])', '\\1' || chr(1) || '\\2', 'g')"


def sentences(x: str) -> str:
    return f"string_split({MARKED.format(x=x)}, chr(1))"


FIRST = "replace(split_part(text, '.', 1), 'ß', '')"  # unlike the accents, it has no ASCII letter
DOCS = "docs AS (SELECT 'doc-' || doc_id AS slug, text FROM documents)"
CONVERSATIONS = r"""docs AS (
  SELECT 'conversation-' || conv_id AS slug, '# Conversation ' || conv_id || chr(10) || chr(10) || string_agg('## ' || role || ' ' || turn || chr(10) || chr(10)
    || replace(text, chr(10), chr(10) || chr(10)), chr(10) || chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id)"""
SECTIONS = rf"""
lined AS (SELECT slug, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM docs),
headed AS (SELECT *, regexp_matches(line, '^#{{1,6}}\s+.*\S\s*$') AS head FROM lined),
numbered AS (SELECT *, sum(head::INT) OVER (PARTITION BY slug ORDER BY pos) AS sec FROM headed),
bodies AS (
  SELECT slug, sec, coalesce(max(CASE WHEN head THEN regexp_extract(line, '^#{{1,6}}\s+(.*\S)\s*$', 1) END), '') AS heading,
    {strip("coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT head), '')")} AS body FROM numbered GROUP BY slug, sec),
kept AS (SELECT * FROM bodies WHERE body <> ''
  UNION ALL SELECT slug, 0, '', {strip("text")} FROM docs WHERE slug NOT IN (SELECT slug FROM bodies WHERE body <> '')),
sections AS (SELECT slug, row_number() OVER (PARTITION BY slug ORDER BY sec) - 1 AS section, heading, body FROM kept)"""
PARAGRAPHS = rf"""
split AS (SELECT slug, section, heading, unnest(regexp_split_to_array(body, '\n\s*\n')) AS p, generate_subscripts(regexp_split_to_array(body, '\n\s*\n'), 1) AS pos FROM sections),
paras AS (SELECT slug, section, heading, {strip("p")} AS text, row_number() OVER (PARTITION BY slug, section ORDER BY pos) - 1 AS paragraph FROM split WHERE {strip("p")} <> '')"""
PIECES = f"""
sized AS (SELECT *, {tokens("text")} AS tok FROM paras),
said AS (SELECT slug, section, paragraph, unnest({sentences("text")}) AS s, generate_subscripts({sentences("text")}, 1) AS n FROM sized WHERE tok > 480),
costs AS (SELECT *, {tokens("s")} AS t FROM said),
filled AS (
  SELECT slug, section, paragraph, s, n, t AS held, 0 AS piece FROM costs WHERE n = 1
  UNION ALL
  SELECT c.slug, c.section, c.paragraph, c.s, c.n, CASE WHEN f.held + c.t > 480 THEN c.t ELSE f.held + c.t END, CASE WHEN f.held + c.t > 480 THEN f.piece + 1 ELSE f.piece END
  FROM filled f JOIN costs c ON c.slug = f.slug AND c.section = f.section AND c.paragraph = f.paragraph AND c.n = f.n + 1),
pieces AS (SELECT slug, section, paragraph, piece, string_agg(s, ' ' ORDER BY n) AS text FROM filled GROUP BY ALL)"""
PACKED = f"""
items AS (
  SELECT slug, section, heading, text, tok, false AS atomic, paragraph, 0 AS piece FROM sized WHERE tok <= 480
  UNION ALL SELECT p.slug, p.section, s.heading, p.text, {tokens("p.text")}, true, p.paragraph, p.piece FROM pieces p JOIN sections s ON s.slug = p.slug AND s.section = p.section),
ranked AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY section, paragraph, piece) AS n FROM items),
walk AS (
  SELECT slug, section, heading, text, n, atomic, tok AS held, 0 AS chunk FROM ranked WHERE n = 1
  UNION ALL
  SELECT r.slug, r.section, r.heading, r.text, r.n, r.atomic,
    CASE WHEN r.atomic OR w.atomic OR r.section <> w.section OR w.held + r.tok > 320 THEN r.tok ELSE w.held + r.tok END,
    CASE WHEN r.atomic OR w.atomic OR r.section <> w.section OR w.held + r.tok > 320 THEN w.chunk + 1 ELSE w.chunk END
  FROM walk w JOIN ranked r ON r.slug = w.slug AND r.n = w.n + 1),
packed AS (SELECT slug, chunk, first(heading ORDER BY n) AS heading, string_agg(text, chr(10) || chr(10) ORDER BY n) AS body FROM walk GROUP BY slug, chunk)"""
MERGED = f"""
weighed AS (SELECT *, {tokens("body")} AS tok FROM packed),
join_up AS (
  SELECT slug, chunk, heading, body, tok, 0 AS idx FROM weighed WHERE chunk = 0
  UNION ALL
  SELECT w.slug, w.chunk, CASE WHEN w.tok < 40 AND j.tok + w.tok <= 480 THEN j.heading ELSE w.heading END,
    CASE WHEN w.tok < 40 AND j.tok + w.tok <= 480 THEN j.body || chr(10) || chr(10) || w.body ELSE w.body END,
    CASE WHEN w.tok < 40 AND j.tok + w.tok <= 480 THEN {tokens("(j.body || chr(10) || chr(10) || w.body)")} ELSE w.tok END,
    CASE WHEN w.tok < 40 AND j.tok + w.tok <= 480 THEN j.idx ELSE j.idx + 1 END
  FROM join_up j JOIN weighed w ON w.slug = j.slug AND w.chunk = j.chunk + 1),
chunked AS (SELECT slug, idx, arg_max(heading, chunk) AS heading, arg_max(body, chunk) AS body, arg_max(tok, chunk) AS tokens FROM join_up GROUP BY slug, idx),
chunks AS (
  SELECT slug || '_' || lpad(idx::VARCHAR, greatest(3, length(idx::VARCHAR))::INTEGER, '0') AS chunk_id, slug AS document_slug, idx::BIGINT AS idx, count(*) OVER (PARTITION BY slug) AS total, heading, body, tokens,
    lead(slug || '_' || lpad(idx::VARCHAR, greatest(3, length(idx::VARCHAR))::INTEGER, '0')) OVER (PARTITION BY slug ORDER BY idx) AS next_id,
    lag(slug || '_' || lpad(idx::VARCHAR, greatest(3, length(idx::VARCHAR))::INTEGER, '0')) OVER (PARTITION BY slug ORDER BY idx) AS previous_id FROM chunked)"""
CHUNKS = f"{SECTIONS}, {PARAGRAPHS}, {PIECES}, {PACKED}, {MERGED}"
CHUNK_ROWS = "SELECT chunk_id, document_slug, idx, total, heading, md5(body) AS body_md5, tokens, next_id, previous_id FROM chunks"

UNITS = f"units AS (SELECT 'doc-' || doc_id AS chunk_id, source AS document_slug, doc_id AS idx, text AS body, {tokens('text')} AS tokens FROM documents)"
COUNTS = f"""{UNITS},
occurring AS (SELECT chunk_id, unnest({terms("body")}) AS term, generate_subscripts({terms("body")}, 1) AS pos FROM units),
counts AS (SELECT chunk_id, term, count(*) AS n, min(pos) AS first FROM occurring GROUP BY ALL)"""
IDF = f"""{COUNTS},
size AS (SELECT greatest(count(*), 1) AS size FROM units),
idf AS (SELECT term, df, ln((1 + size)::DOUBLE / (1 + df)) + 1 AS idf FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), size)"""
WEIGHTS = f"""{IDF},
plain AS (SELECT chunk_id, term, n * idf AS r FROM counts JOIN idf USING (term)),
weights AS (SELECT chunk_id, term, r / sqrt(sum(r * r) OVER (PARTITION BY chunk_id)) AS w FROM plain)"""
CENTROID = f"""{WEIGHTS},
mean AS (SELECT term, sum(w) / (SELECT size FROM size) AS m FROM weights GROUP BY term),
centroid AS (SELECT term, m / (SELECT sqrt(sum(m * m)) FROM mean) AS c FROM mean)"""
ROOTS = f"""{IDF},
summed AS (SELECT document_slug, term, sum(n) AS n FROM counts JOIN units USING (chunk_id) GROUP BY ALL HAVING sum(n) >= 3),
roots AS (
  SELECT document_slug, row_number() OVER (PARTITION BY document_slug ORDER BY n * idf DESC, term) AS rank, term, n * idf AS score FROM summed JOIN idf USING (term)
  QUALIFY rank <= 8),
entries AS (SELECT document_slug, string_agg(term, ' ' ORDER BY rank) AS root_terms FROM roots GROUP BY document_slug HAVING count(*) >= 2)"""
TOPICS = f"""{COUNTS},
common AS (SELECT chunk_id, term, row_number() OVER (PARTITION BY chunk_id ORDER BY n DESC, first) AS r FROM counts QUALIFY r <= 8),
slugged AS (SELECT chunk_id, {slug("term")} AS topic, min(r) AS r FROM common GROUP BY ALL HAVING {slug("term")} <> ''),
found AS (SELECT chunk_id, topic, row_number() OVER (PARTITION BY chunk_id ORDER BY r) - 1 AS place FROM slugged QUALIFY place < 3),
topics AS (
  SELECT chunk_id, place, topic, CASE WHEN place = 0 THEN 0 ELSE 1 END AS depth FROM found
  UNION ALL SELECT chunk_id, 0, {slug("document_slug")}, 0 FROM units WHERE chunk_id NOT IN (SELECT chunk_id FROM found))"""
JOINED = f"{TOPICS}, paths AS (SELECT chunk_id, string_agg(topic, '.' ORDER BY depth, place) AS topic_path, string_agg(topic, ' ' ORDER BY place) AS names, round_even(count(*) FILTER (depth = 0)::DOUBLE / count(*), 3) AS specificity, string_agg('{{\"topic\":\"' || topic || '\",\"depth\":' || depth || '}}', ',' ORDER BY place) AS js FROM topics GROUP BY chunk_id)"
ALTERED = f"""{JOINED},
altered AS (SELECT u.*, p.*, quality, toxic, CASE WHEN quality = 0 THEN 'draft' ELSE 'active' END AS status, CASE WHEN toxic = 1 THEN 1.5 ELSE 0.8 END AS confidence,
  CASE WHEN quality = 0 THEN 'rubbish' ELSE 'section' END AS chunk_type, 'Document ' || u.idx AS title, CASE WHEN {summary("body")} <> '' THEN {summary("body")} ELSE 'Document ' || u.idx END AS summary
  FROM units u JOIN paths p USING (chunk_id) LEFT JOIN (SELECT 'doc-' || doc_id AS chunk_id, quality, toxic FROM labels) l USING (chunk_id))"""
EVENTS = """answers AS (SELECT *, event_id % 11 <> 0 AS object, CASE WHEN event_id % 5 = 0 THEN 0.25 ELSE least(1.0, (event_id % 150) / 100.0) END AS share FROM events)"""

TITLED = "array_to_string(list_transform(string_split({x}, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"

ORACLE: dict[str, str] = {
    "tokenize_counts": f"SELECT doc_id, len({words('text')}) AS n_words, len(list_distinct({words('text')})) AS n_distinct FROM documents",
    "content_term_counts": f"SELECT doc_id, len({terms('text')}) AS n_terms, array_to_string({terms('text')}[1:5], ' ') AS first_terms FROM documents",
    "estimate_tokens": f"SELECT doc_id, {tokens('text')} AS tokens FROM documents",
    "slugify_titles": f"SELECT doc_id, {slug(FIRST)} AS slug FROM documents",
    "title_case_sources": f"SELECT name, {TITLED.format(x='name')} AS title FROM (SELECT DISTINCT source || ' ' || lang AS name FROM documents)",
    "first_sentence_summary": f"SELECT doc_id, CASE WHEN {summary('text')} <> '' THEN {summary('text')} ELSE 'untitled' END AS summary FROM documents",
    "whitespace_word_counts": "SELECT conv_id, turn, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS n_words FROM conversations",
    "extract_title": f"""WITH {CONVERSATIONS}, whole AS (SELECT * FROM docs UNION ALL SELECT 'doc-' || doc_id, text FROM documents),
      heads AS (SELECT slug, list_filter(string_split_regex(text, '\\r\\n|[\\n\\r]'), lambda l: regexp_matches(l, '^#{{1,6}}\\s+.*\\S\\s*$')) AS heads FROM whole)
      SELECT slug, CASE WHEN len(heads) > 0 THEN regexp_extract(heads[1], '^#+\\s+(.*\\S)\\s*$', 1) ELSE {TITLED.format(x="trim(regexp_replace(slug, '[-_]+', ' ', 'g'))")} END AS title FROM heads""",
    "section_split": f"WITH {CONVERSATIONS}, {SECTIONS} SELECT slug, section, heading, body FROM sections",
    "paragraph_split": f"WITH {CONVERSATIONS}, {SECTIONS}, {PARAGRAPHS} SELECT slug, section, paragraph, text FROM paras",
    "sentence_split_counts": f"SELECT doc_id, len({sentences(strip('text'))}) AS n_sentences FROM documents",
    "oversized_pieces": f"""WITH RECURSIVE costs AS (SELECT doc_id, s, n, {tokens("s")} AS t FROM (
        SELECT doc_id, unnest({sentences(strip("text"))}) AS s, generate_subscripts({sentences(strip("text"))}, 1) AS n FROM documents)),
      filled AS (SELECT doc_id, s, n, t AS held, 0 AS piece FROM costs WHERE n = 1 UNION ALL
        SELECT c.doc_id, c.s, c.n, CASE WHEN f.held + c.t > 480 THEN c.t ELSE f.held + c.t END, CASE WHEN f.held + c.t > 480 THEN f.piece + 1 ELSE f.piece END
        FROM filled f JOIN costs c ON c.doc_id = f.doc_id AND c.n = f.n + 1),
      pieces AS (SELECT doc_id, piece, string_agg(s, ' ' ORDER BY n) AS text FROM filled GROUP BY doc_id, piece)
      SELECT doc_id, piece::BIGINT AS piece, {tokens("text")} AS tokens, md5(text) AS text_md5 FROM pieces""",
    "greedy_chunks": f"WITH RECURSIVE {CONVERSATIONS}, {SECTIONS}, {PARAGRAPHS}, {PIECES}, {PACKED} SELECT slug, chunk::BIGINT AS chunk, heading, body FROM packed",
    "conversation_chunks": f"WITH RECURSIVE {CONVERSATIONS}, {CHUNKS} {CHUNK_ROWS}",
    "document_chunks": f"WITH RECURSIVE {DOCS}, {CHUNKS} {CHUNK_ROWS}",
    "limit_chunks": f"WITH RECURSIVE {CONVERSATIONS}, {CHUNKS} SELECT chunk_id, next_id FROM chunks ORDER BY document_slug || '.md', document_slug, idx LIMIT 100",
    "information_density": f"SELECT 'doc-' || doc_id AS chunk_id, CASE WHEN {tokens('text')} > 0 THEN round_even(least(1.0, len(list_distinct({terms('text')}))::DOUBLE / {tokens('text')}), 3) ELSE 0 END AS information_density FROM documents",
    "term_frequency": f"WITH {COUNTS} SELECT chunk_id, term, n FROM counts",
    "document_frequency": f"WITH {COUNTS} SELECT term, count(*) AS df FROM counts GROUP BY term",
    "inverse_document_frequency": f"WITH {IDF} SELECT term, df, round_even(idf, 6) AS idf FROM idf",
    "tfidf_weights": f"WITH {WEIGHTS} SELECT chunk_id, term, round_even(w, 6) AS w FROM weights",
    "centroid_terms": f"WITH {CENTROID} SELECT term, round_even(c, 6) AS c FROM centroid",
    "lexical_distinctiveness": f"""WITH {CENTROID},
      far AS (SELECT u.chunk_id, 1 - coalesce(s, 0) AS d FROM units u LEFT JOIN (SELECT chunk_id, sum(w * c) AS s FROM weights JOIN centroid USING (term) GROUP BY chunk_id) USING (chunk_id)),
      span AS (SELECT min(d) AS low, max(d) AS high FROM far)
      SELECT chunk_id, CASE WHEN high - low > 1e-9 THEN round_even((d - low) / (high - low), 3) ELSE 0 END AS lexical_distinctiveness FROM far, span""",
    "corpus_stats": "SELECT count(DISTINCT source) AS total_documents, count(*) AS total_chunks FROM documents",
    "document_roots": f"WITH {ROOTS} SELECT document_slug, rank, term, round_even(score, 6) AS score FROM roots",
    "index_entries": f"""WITH {ROOTS} SELECT document_slug, root_terms, n_children, children_md5 FROM entries JOIN (
      SELECT document_slug, count(*) AS n_children, md5(string_agg(chunk_id, ' ' ORDER BY idx, chunk_id)) AS children_md5 FROM units GROUP BY document_slug) USING (document_slug)""",
    "entry_siblings": f"""WITH {ROOTS}, plain AS (SELECT chunk_id, term, n * idf AS r FROM counts JOIN idf USING (term)),
      weights AS (SELECT chunk_id, term, r / sqrt(sum(r * r) OVER (PARTITION BY chunk_id)) AS w FROM plain),
      sums AS (SELECT document_slug, term, sum(w) AS s FROM weights JOIN units USING (chunk_id) JOIN entries USING (document_slug) GROUP BY ALL),
      unit AS (SELECT document_slug, term, s / sqrt(sum(s * s) OVER (PARTITION BY document_slug)) AS w FROM sums)
      SELECT x.document_slug AS a, y.document_slug AS b, round_even(sum(x.w * y.w), 3) AS score FROM unit x JOIN unit y ON x.term = y.term AND x.document_slug <> y.document_slug
      GROUP BY ALL HAVING sum(x.w * y.w) >= 0.3""",
    "index_lines": "SELECT document_slug, 7 + 6 * (row_number() OVER (ORDER BY document_slug) - 1) AS line FROM (SELECT DISTINCT source AS document_slug FROM documents)",
    "index_refs": f"WITH {ROOTS}, l AS (SELECT document_slug AS s, 7 + 6 * (row_number() OVER (ORDER BY document_slug) - 1) AS line FROM entries) SELECT 'doc-' || doc_id AS chunk_id, s AS entry, line FROM documents LEFT JOIN l ON s = source",
    "fallback_topics": f"WITH {TOPICS} SELECT chunk_id, place, topic, depth::BIGINT AS depth FROM topics",
    "topic_path": f"WITH {JOINED} SELECT chunk_id, topic_path, specificity FROM paths",
    "related_chunks": f"""WITH {TOPICS}, t AS (SELECT chunk_id, document_slug, topic FROM topics JOIN units USING (chunk_id)), sizes AS (SELECT chunk_id, count(*) AS k FROM t GROUP BY chunk_id),
      pairs AS (SELECT x.chunk_id AS a, y.chunk_id AS b, count(*) AS common FROM t x JOIN t y ON x.topic = y.topic AND x.document_slug <> y.document_slug GROUP BY ALL),
      scored AS (SELECT a, b, common::DOUBLE / (s.k + z.k - common) AS overlap FROM pairs JOIN sizes s ON s.chunk_id = a JOIN sizes z ON z.chunk_id = b)
      SELECT a AS chunk_id, row_number() OVER (PARTITION BY a ORDER BY overlap DESC, b) AS rank, b AS related_id, round_even(overlap, 6) AS overlap FROM scored WHERE overlap >= 0.2 QUALIFY rank <= 2""",
    "extract_json": f"WITH {EVENTS} SELECT 'e-' || event_id AS chunk_id, object AS is_object, CASE WHEN object THEN 'Contextual' END AS utility FROM answers",
    "coerce_classification": f"""WITH {EVENTS} SELECT 'e-' || event_id AS chunk_id, CASE WHEN object AND event_id % 2 = 0 THEN 'fact' ELSE 'section' END AS chunk_type,
      CASE WHEN object THEN 'Event ' || event_type || '.' ELSE 'Seen.' END AS summary,
      CASE WHEN object THEN event_type || ':' || least(4, event_id % 9) || ' user-' || user_id || ':0' ELSE CASE WHEN event_type < 'seen' THEN 'seen:0 ' || event_type || ':1' ELSE 'seen:0 ' || event_type || ':1' END END AS topics,
      CASE WHEN object THEN 'kind=' || event_type ELSE '' END AS aliases, CASE WHEN object THEN 'shop-floor' ELSE 'general' END AS goals,
      CASE WHEN object THEN least(1.0, round((event_id % 40) / 20.0, 2)) ELSE 0.5 END::DOUBLE AS weight, CASE WHEN object THEN 'contextual' ELSE 'declarative' END AS utility, 'canonical' AS authority,
      CASE WHEN object THEN share ELSE 0.3 END::DOUBLE AS confidence, NOT (object AND event_id % 7 = 0) AS standalone, NOT object AS fallback FROM answers""",
    "classify_report": "SELECT count(*) FILTER (event_id % 11 <> 0) AS ok, count(*) FILTER (event_id % 11 = 0) AS fallback FROM events",
    "compile_records": f"""WITH RECURSIVE {CONVERSATIONS}, {CHUNKS},
      occurring AS (SELECT chunk_id, unnest({terms("body")}) AS term, generate_subscripts({terms("body")}, 1) AS pos FROM chunks),
      counted AS (SELECT chunk_id, term, count(*) AS n, min(pos) AS first FROM occurring GROUP BY ALL),
      common AS (SELECT chunk_id, term, row_number() OVER (PARTITION BY chunk_id ORDER BY n DESC, first) AS r FROM counted QUALIFY r <= 8),
      named AS (SELECT chunk_id, topic, min(r) AS r FROM (SELECT chunk_id, {slug("term")} AS topic, r FROM common UNION ALL SELECT chunk_id, {slug("heading")}, 0 FROM chunks) WHERE topic <> '' GROUP BY ALL),
      placed AS (SELECT chunk_id, topic, row_number() OVER (PARTITION BY chunk_id ORDER BY r) AS place FROM named QUALIFY place <= 3),
      paths AS (SELECT chunk_id, string_agg(topic, '.' ORDER BY place) AS topic_path, round_even(1.0::DOUBLE / count(*), 3) AS specificity FROM placed GROUP BY chunk_id)
      SELECT chunk_id, 'Conversation ' || split_part(document_slug, '-', 2) AS document_title, CASE WHEN {summary("body")} <> '' THEN {summary("body")} ELSE heading END AS summary, topic_path, specificity,
      idx AS current, next_id AS next, 'active' AS status, '2026-01-01T00:00:00Z' AS created_at, tokens FROM chunks JOIN paths USING (chunk_id)""",
    "frontmatter_validate": f"""WITH {ALTERED} SELECT chunk_id, chunk_id || ': bad chunk_type ''rubbish''' AS problem FROM altered WHERE chunk_type = 'rubbish'
      UNION ALL SELECT chunk_id, chunk_id || ': confidence out of range' FROM altered WHERE confidence > 1""",
    "pack_chunks_active": f"""WITH {ALTERED} SELECT chunk_id AS id, title, md5(body) AS text_md5, summary, names AS topics, CASE WHEN quality = 1 THEN document_slug || '|origin' ELSE '' END AS aliases,
      document_slug AS doc, idx AS position, tokens FROM altered WHERE status = 'active'""",
    "pack_validate": """WITH p AS (SELECT 'doc-' || (doc_id - doc_id % 7 % 2) AS id, CASE WHEN doc_id % 50 = 0 THEN '' ELSE source END AS title, text FROM documents),
      m AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY title, text) AS nth FROM p)
      SELECT id AS chunk_id, id || ': duplicate chunk id' AS problem FROM m WHERE nth > 1 UNION ALL SELECT id, id || ': empty title' FROM m WHERE title = ''
      UNION ALL SELECT id, id || ': text length ' || length(text) || ' outside 1..8000' FROM m WHERE length(text) NOT BETWEEN 1 AND 8000""",
    "alias_flatten": "SELECT doc_id, source || '|' || lang || '|x' AS aliases FROM documents",
    "embedding_text": """SELECT 'doc-' || doc_id AS chunk_id, md5(text || CASE WHEN quality = 1 THEN line ELSE '' END) AS append, md5(CASE WHEN quality = 1 THEN substr(line, 3) || chr(10) || chr(10) || text ELSE text END) AS prepend, md5(text) AS "none"
      FROM (SELECT doc_id, text, quality, chr(10) || chr(10) || 'Also known as: ' || source || ' =  origin ' AS line FROM documents LEFT JOIN labels USING (doc_id))""",
    "flatten_metadata": f"""WITH {ALTERED} SELECT chunk_id, document_slug, chunk_type, topic_path, '[' || js || ']' AS topics, CASE WHEN quality = 1 THEN '{{"' || document_slug || '":" origin "}}' ELSE '{{}}' END AS aliases,
      '[{{"domain":"general","weight":0.5}}]' AS goal_affinity, idx AS nav_current, '' AS nav_next, specificity, true AS standalone, 'canonical' AS authority, confidence::DOUBLE AS confidence, status,
      'evergreen' AS decay_class, '2026-01-01T00:00:00Z' AS created_at, tokens FROM altered""",
    "upsert_chunks": """SELECT 'doc-' || doc_id AS chunk_id, source, doc_id AS version FROM documents WHERE doc_id NOT IN (SELECT 2 * page_id FROM pages)
      UNION ALL SELECT 'doc-' || 2 * page_id, 'page', page_id FROM pages""",
    "page_paths_kept": "SELECT page_id, '/x/pages/' || page_id || '.html' AS path FROM pages WHERE page_id % 5 <> 0",
    "vector_topk": """WITH q AS (SELECT vec_id AS query_id, embedding AS v FROM embeddings WHERE vec_id % 100 = 0),
      scored AS (SELECT query_id, vec_id, list_cosine_similarity(embedding::DOUBLE[], v::DOUBLE[]) AS s FROM embeddings, q)
      SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS rank, vec_id, round_even(s, 6) AS score FROM scored QUALIFY rank <= 10""",
    "lexical_topk": f"""WITH {WEIGHTS}, asked AS (SELECT t AS term, 1 AS n FROM (SELECT unnest(['worthless', 'erhe', 'tion', 'auxtion', 'keit']) AS t)),
      q AS (SELECT term, idf / sqrt(sum(idf * idf) OVER ()) AS q FROM asked JOIN idf USING (term))
      SELECT chunk_id, round_even(sum(w * q), 6) AS score FROM weights JOIN q USING (term) GROUP BY chunk_id ORDER BY round_even(sum(w * q), 9) DESC, chunk_id LIMIT 10""",
    "postings_topk": f"""WITH {WEIGHTS}, q AS (
        SELECT chunk_id AS query_id, term, w AS q FROM weights JOIN units USING (chunk_id) WHERE idx % 100 = 0
        QUALIFY row_number() OVER (PARTITION BY chunk_id ORDER BY round_even(w, 9) DESC, term) <= 8),
      scored AS (SELECT query_id, chunk_id, sum(w * q) AS s FROM weights JOIN q USING (term) GROUP BY ALL)
      SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY round_even(s, 9) DESC, chunk_id) AS rank, chunk_id, round_even(s, 6) AS score FROM scored QUALIFY rank <= 10""",
}
ORACLE["vector_index_topk"] = ORACLE["vector_topk"]
ORACLE["upsert_merged"] = ORACLE["upsert_chunks"]
ORACLE["fan_out_context"] = f"""WITH RECURSIVE sib AS ({ORACLE["entry_siblings"]}), {UNITS},
  placed AS (SELECT *, row_number() OVER (PARTITION BY document_slug ORDER BY idx) AS rank FROM units),
  own AS (SELECT chunk_id AS query_id, document_slug, rank AS mid FROM placed WHERE idx % 100 = 0),
  nearest AS (SELECT a, b, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS nth FROM sib QUALIFY nth <= 3),
  offers AS (
    SELECT query_id, CASE WHEN rank = mid THEN 0 ELSE 1 END AS hop, abs(rank - mid) AS far, rank, chunk_id, tokens FROM own JOIN placed USING (document_slug) WHERE abs(rank - mid) <= 4
    UNION ALL SELECT query_id, 2, nth, rank, chunk_id, tokens FROM own JOIN nearest ON own.document_slug = a JOIN placed p ON p.document_slug = b WHERE rank <= 2),
  ordered AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY hop, far, rank, chunk_id) AS n FROM offers),
  walk AS (
    SELECT query_id, n, chunk_id, hop, tokens <= 3000 AS took, CASE WHEN tokens <= 3000 THEN tokens ELSE 0 END AS total FROM ordered WHERE n = 1
    UNION ALL
    SELECT o.query_id, o.n, o.chunk_id, o.hop, w.total + o.tokens <= 3000, CASE WHEN w.total + o.tokens <= 3000 THEN w.total + o.tokens ELSE w.total END
    FROM walk w JOIN ordered o ON o.query_id = w.query_id AND o.n = w.n + 1)
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY n) AS place, chunk_id, hop::BIGINT AS hop, total::BIGINT AS total FROM walk WHERE took"""
