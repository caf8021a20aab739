"""Shared WITH parts of the comparison SQL."""

from __future__ import annotations

from pageloom.functions.text import ENTITY_TYPES, RELATIONSHIP_TYPES

_TYPES = "[" + ", ".join(f"'{t}'" for t in ENTITY_TYPES) + "]"
_CLASSES = "[" + ", ".join(f"'{t}'" for t in [*RELATIONSHIP_TYPES, "UNHEARD_OF"]) + "]"
_KNOWN = ", ".join(f"'{t}'" for t in RELATIONSHIP_TYPES)

#: name -> (names it needs, SQL)
PARTS: dict[str, tuple[list[str], str]] = {
    "doc": ([], r"""
SELECT doc_id, text, lang, (doc_id % 15 + 1)::INT AS chapter_number, (doc_id // 15)::INT AS article_number,
  'ch' || (doc_id % 15 + 1) || '-art' || (doc_id // 15) AS article_id,
  'chapter-' || (doc_id % 15 + 1) AS chapter_slug, CASE WHEN doc_id // 15 = 0 THEN '' ELSE 'article-' || (doc_id // 15) END AS article_slug,
  'https://www.example.org/guide/chapter-' || (doc_id % 15 + 1) || '/' || CASE WHEN doc_id // 15 = 0 THEN '' ELSE 'article-' || (doc_id // 15) || '/' END AS url,
  coalesce(nullif(trim(regexp_extract(text, '^[^.\n]*')), ''), 'Untitled') AS title,
  len(regexp_extract_all(text, '\S+')) AS word_count, length(text) AS char_count
FROM documents"""),
    "sec": (["doc"], r"""
SELECT *, trim(regexp_replace(raw, '\s+', ' ', 'g')) AS norm, len(regexp_extract_all(raw, '\S+')) AS n FROM (
  SELECT doc_id, article_id, chapter_number, article_number, title, text, i AS section_index, ps[i + 1] AS raw FROM (
    SELECT *, unnest(range(len(ps))) AS i FROM (SELECT *, string_split(text, chr(10)) AS ps FROM doc)))"""),
    "kept": (["sec"], """
SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY section_index) AS k FROM sec WHERE norm <> '' AND n >= 50"""),
    "span": (["kept"], """
SELECT article_id, k, section_index,
  greatest(instr(text, left(raw, 100)) - 1, 0) AS char_start, greatest(instr(text, left(raw, 100)) - 1, 0) + length(raw) AS char_end
FROM kept WHERE k = 1
UNION ALL
SELECT t.article_id, t.k, t.section_index,
  s.char_end + greatest(instr(substr(t.text, s.char_end + 1), left(t.raw, 100)) - 1, 0),
  s.char_end + greatest(instr(substr(t.text, s.char_end + 1), left(t.raw, 100)) - 1, 0) + length(t.raw)
FROM span s JOIN kept t ON t.article_id = s.article_id AND t.k = s.k + 1"""),
    "win": (["kept"], r"""
SELECT article_id, section_index, j AS window_index, array_to_string(tk[j * 56 + 1:j * 56 + 64], '') AS text,
  length(coalesce(array_to_string(tk[1:j * 56], ''), '')) AS rel_start, len(tk[j * 56 + 1:j * 56 + 64]) AS n FROM (
  SELECT *, unnest(range(ceil((n - 64) / 56.0)::BIGINT + 1)) AS j FROM (
    SELECT article_id, section_index, n, regexp_extract_all(norm, '\s*\S+') AS tk FROM kept WHERE n > 200))"""),
    "chunk": (["doc", "kept", "span", "win"], r"""
SELECT *, length(text) AS char_count, len(regexp_extract_all(text, '\S+')) AS word_count FROM (
  SELECT article_id || '-summary' AS chunk_id, 'article_summary' AS chunk_type, article_id AS source_article_id,
    NULL::BIGINT AS source_section_index, NULL::BIGINT AS window_index, s AS text, 0 AS char_start, length(s) AS char_end,
    title AS heading, chapter_number, title AS article_title, len(regexp_extract_all(s, '\S+')) AS token_count
  FROM (SELECT *, array_to_string(regexp_extract_all(text, '\S+')[1:300], ' ') AS s FROM doc) WHERE s <> ''
  UNION ALL
  SELECT k.article_id || '-sec' || k.section_index, 'section', k.article_id, k.section_index, NULL, k.norm, p.char_start, p.char_end,
    'p' || k.section_index, k.chapter_number, k.title, k.n
  FROM kept k JOIN span p USING (article_id, section_index) WHERE k.n <= 200
  UNION ALL
  SELECT k.article_id || '-sec' || k.section_index || '-sw' || w.window_index, 'sliding_window', k.article_id, k.section_index, w.window_index,
    w.text, p.char_start + w.rel_start, p.char_start + w.rel_start + length(w.text),
    'p' || k.section_index || ' (part ' || (w.window_index + 1) || ')', k.chapter_number, k.title, w.n
  FROM kept k JOIN span p USING (article_id, section_index) JOIN win w USING (article_id, section_index) WHERE k.n > 200)"""),
    "gaz": ([], rf"""
SELECT name, ({_TYPES})[length(name) % 10 + 1] AS entity_type FROM (
  SELECT DISTINCT lower(regexp_extract(line, '^\P{{L}}*(\p{{L}}+)', 1)) AS name FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents))
WHERE length(name) >= 6"""),
    "mention": (["doc", "gaz"], r"""
SELECT article_id, chapter_number, article_number, start_pos AS position, entity_type, name, p AS source_text, start_pos,
  start_pos + length(p) AS end_pos, entity_type || '-' || substr(md5(name), 1, 8) AS entity_id,
  CASE WHEN p = name THEN 1.0 ELSE 0.8 END::DOUBLE AS confidence, CASE WHEN p = name THEN 'match_exact' ELSE 'match_fuzzy' END AS alignment_status
FROM (
  SELECT *, coalesce(sum(length(p)) OVER (PARTITION BY article_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start_pos
  FROM (SELECT article_id, chapter_number, article_number, unnest(ps) AS p, generate_subscripts(ps, 1) AS i FROM (
    SELECT *, regexp_extract_all(text, '\p{L}+|[^\p{L}]+') AS ps FROM doc)))
JOIN gaz ON lower(p) = name"""),
    "whole_gaz": ([], rf"""
SELECT name, ({_TYPES})[length(name) % 10 + 1] AS entity_type FROM (
  SELECT unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS name FROM documents
  UNION SELECT lower(regexp_extract(line, '^\P{{L}}*(\p{{L}}+ \p{{L}}+)', 1)) FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents))
WHERE name <> ''"""),
    "whole_mention": (["doc", "whole_gaz"], r"""
SELECT article_id, entity_type || '-' || substr(md5(name), 1, 8) AS entity_id, entity_type, name, p AS source_text, start_pos,
  start_pos + length(p) AS end_pos, CASE WHEN p = name THEN 1.0 ELSE 0.8 END::DOUBLE AS confidence,
  CASE WHEN p = name THEN 'match_exact' ELSE 'match_fuzzy' END AS alignment_status
FROM (
  SELECT article_id, start_pos, unnest([w, w || gap || next]) AS p FROM (
    SELECT article_id, p AS w, lead(p) OVER o AS gap, lead(p, 2) OVER o AS next,
      coalesce(sum(length(p)) OVER (PARTITION BY article_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start_pos
    FROM (SELECT article_id, unnest(ps) AS p, generate_subscripts(ps, 1) AS i FROM (
      SELECT *, regexp_extract_all(text, '\p{L}+|[^\p{L}]+') AS ps FROM doc)) WINDOW o AS (PARTITION BY article_id ORDER BY i)))
JOIN whole_gaz ON lower(p) = name"""),
    "link": (["chunk", "mention"], """
SELECT c.chunk_id, c.source_article_id, m.entity_id, m.position, m.end_pos FROM chunk c JOIN mention m ON m.article_id = c.source_article_id
WHERE c.chunk_type = 'article_summary' OR (m.start_pos < c.char_end AND m.end_pos > c.char_start)"""),
    "entity": (["mention"], """
SELECT entity_id, entity_type, name, source_text, start_pos, end_pos, article_id AS source_article_id, alignment_status,
  chapter_number, article_number, position, top_confidence AS confidence, last_text AS matched FROM (
  SELECT *, row_number() OVER w AS r, max(confidence) OVER (PARTITION BY entity_id) AS top_confidence,
    last_value(source_text) OVER (PARTITION BY entity_id ORDER BY chapter_number, article_number, position ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_text
  FROM mention WINDOW w AS (PARTITION BY entity_id ORDER BY chapter_number, article_number, position)) WHERE r = 1"""),
    "rawrel": (["mention"], f"""
SELECT article_id, chapter_number, article_number, position, ({_CLASSES})[length(source_text) % 13 + 1] AS relationship_type,
  source_text AS source, CASE WHEN position % 17 = 0 THEN '' WHEN position % 11 = 0 THEN next_text || ' x' ELSE next_text END AS target,
  source_text || ' ' || next_text AS evidence
FROM (SELECT *, lead(start_pos) OVER w AS next_start, lead(source_text) OVER w AS next_text FROM mention
  WINDOW w AS (PARTITION BY article_id ORDER BY position)) WHERE next_start - end_pos <= 40"""),
    "rel": (["rawrel", "mention"], f"""
SELECT 'rel-' || substr(md5(source_entity_id || '-' || relationship_type || '-' || target_entity_id), 1, 12) AS relationship_id, * FROM (
  SELECT r.relationship_type, coalesce(a.id, 'concept-' || substr(md5(trim(lower(r.source))), 1, 8)) AS source_entity_id,
    coalesce(b.id, 'concept-' || substr(md5(trim(lower(r.target))), 1, 8)) AS target_entity_id, r.evidence AS source_text,
    r.article_id AS source_article_id, r.chapter_number, r.article_number, r.position, 1.0::DOUBLE AS confidence
  FROM rawrel r
  LEFT JOIN (SELECT article_id, lower(name) AS name, arg_max(entity_id, position) AS id FROM mention GROUP BY ALL) a
    ON a.article_id = r.article_id AND a.name = lower(r.source)
  LEFT JOIN (SELECT article_id, lower(name) AS name, arg_max(entity_id, position) AS id FROM mention GROUP BY ALL) b
    ON b.article_id = r.article_id AND b.name = lower(r.target)
  WHERE r.relationship_type IN ({_KNOWN}) AND r.target <> '')"""),
    "relation": (["rel"], """
SELECT * EXCLUDE r FROM (SELECT *, row_number() OVER (PARTITION BY relationship_id ORDER BY chapter_number, article_number, position, source_text) AS r FROM rel) WHERE r = 1"""),
    "term": ([], r"SELECT item_id AS seq, regexp_extract(text, '\p{L}+') AS term, text AS definition FROM benchmark"),
    "chap": (["doc"], "SELECT chapter_number, title, url AS overview_url FROM doc WHERE article_number = 0"),
}


def sql(body: str, *names: str) -> str:
    """``body`` with the named parts, and what they need, in front."""
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for needed in PARTS[name][0]:
                add(needed)
            order.append(name)

    for name in names:
        add(name)
    if not order:
        return body
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({PARTS[n][1]})" for n in order) + "\n" + body
