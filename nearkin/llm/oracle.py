"""The same results in DuckDB SQL, for the operators that SQL can express."""

from __future__ import annotations

from nearkin.llm import lines, quality

WORD = r"[^\x20\x09-\x0D]+"

OP3_CHAT = """
WITH turns AS (
  SELECT conv_id, coalesce(turn, -1) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
), wholes AS (
  SELECT conv_id, count(*) AS n_turns,
         list({'turn': turn, 'role': role, 'text': text} ORDER BY turn, role, text) AS turns
  FROM turns GROUP BY conv_id
), kept AS (
  SELECT min(conv_id) AS conv_id, n_turns, turns FROM wholes GROUP BY n_turns, turns
)
SELECT conv_id, n_turns,
       array_to_string(list_transform(turns,
         lambda t: '<|' || t.role || '|>' || chr(10) || t.text || chr(10)), '') AS rendered
FROM kept
WHERE NOT EXISTS (
  SELECT 1 FROM wholes WHERE wholes.n_turns > kept.n_turns AND wholes.turns[1:kept.n_turns] = kept.turns
)
"""

OP5_QUALITY = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS place, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS words
  FROM documents
), windows AS (
  SELECT place, pos, words[pos] || ' ' || words[pos + 1] || ' ' || words[pos + 2] AS win
  FROM (SELECT place, words, unnest(range(1, len(words) - 1)) AS pos FROM texts)
), repeated AS (
  SELECT place, pos FROM windows QUALIFY count(*) OVER (PARTITION BY place, win) > 1
), covered AS (
  SELECT place, count(DISTINCT word) AS n
  FROM (SELECT place, unnest([pos, pos + 1, pos + 2]) AS word FROM repeated) GROUP BY place
), lines AS (
  SELECT place, count(*) AS n, count(DISTINCT line) AS n_distinct
  FROM (SELECT place, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '{WORD}') GROUP BY place
), features AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals,
         coalesce(lines.n, 0) AS n_lines, coalesce(lines.n - lines.n_distinct, 0) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words
  FROM texts LEFT JOIN covered USING (place) LEFT JOIN lines USING (place)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       {" OR ".join(f"({r.rejects})" for r in quality.RULES if r.name in quality.BASE)} AS base_failed,
       NOT ({" OR ".join(f"({r.rejects})" for r in quality.RULES)}) AS kept
FROM features
"""

OP8_JACCARD = rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[pos : pos + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS pos FROM texts WHERE len(words) >= 5)
  UNION ALL
  SELECT doc_id, array_to_string(words, ' ') FROM texts WHERE len(words) BETWEEN 1 AND 4
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT one.doc_id AS a, two.doc_id AS b, count(*) AS n
  FROM shingles AS one JOIN shingles AS two USING (shingle) WHERE one.doc_id <> two.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared JOIN sizes AS one ON one.doc_id = a JOIN sizes AS two ON two.doc_id = b
  WHERE 100 * shared.n >= 80 * (one.n + two.n - shared.n)
), reach AS (
  SELECT doc_id, doc_id AS root FROM texts
  UNION
  SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.doc_id
)
SELECT texts.doc_id, coalesce(sizes.n, 0) AS n_shingles, (
  SELECT min(root) FROM reach WHERE reach.doc_id = texts.doc_id
) AS component_id
FROM texts LEFT JOIN sizes USING (doc_id)
"""

_SPACE = r" \t\x0B\f\r"

OP10_LINES = rf"""
WITH every_line AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line_text,
         unnest(string_split(regexp_replace(text, '[^{_SPACE}\n]*[0-9][^{_SPACE}\n]*', '<*>', 'g'), chr(10))) AS masked,
         unnest(range(len(string_split(text, chr(10))))) AS line
  FROM documents WHERE text IS NOT NULL
), lines AS (
  SELECT doc_id, line, line_text, regexp_extract_all(masked, '[^{_SPACE}]+') AS whole FROM every_line
), keyed AS (
  SELECT doc_id, line, whole, len(whole) AS n_tokens, {{'n': len(whole), 'leading': whole[1:{lines.LEADING}]}} AS leaf
  FROM lines WHERE len(whole) >= {lines.MIN_TOKENS}
), wholes AS (
  SELECT whole, any_value(n_tokens) AS n_tokens, any_value(leaf) AS leaf, min(doc_id) AS low, max(doc_id) AS high
  FROM keyed GROUP BY whole
), mixed AS (
  SELECT leaf, count(*) AS n_lines FROM wholes WHERE n_tokens >= {lines.MIN_TEMPLATE_TOKENS} GROUP BY leaf HAVING count(*) > 1
), tokens AS (
  SELECT leaf, n_lines, n_tokens, whole, unnest(whole) AS token, unnest(range(len(whole))) AS place
  FROM wholes JOIN mixed USING (leaf)
), constants AS (
  SELECT leaf, place, token FROM tokens GROUP BY leaf, place, token HAVING 2 * count(*) > any_value(n_lines)
), general AS (
  SELECT leaf, whole FROM tokens SEMI JOIN constants USING (leaf, place, token)
  GROUP BY leaf, whole HAVING 100 * count(*) >= {lines.MIN_CONSTANT_PERCENT} * any_value(n_tokens)
), templates AS (
  SELECT wholes.whole, CASE WHEN general.whole IS NULL THEN {{'leaf': NULL, 'whole': wholes.whole}}
         ELSE {{'leaf': wholes.leaf, 'whole': NULL}} END AS template, low, high
  FROM wholes LEFT JOIN general ON general.whole = wholes.whole
), ends AS (
  SELECT template, min(low) AS low, max(high) AS high FROM templates GROUP BY template
), dropped AS (
  SELECT doc_id, line FROM keyed JOIN templates USING (whole)
  JOIN ends ON ends.template IS NOT DISTINCT FROM templates.template
  WHERE ends.low <> ends.high AND doc_id <> ends.low
), kept AS (
  SELECT doc_id, string_agg(line_text, chr(10) ORDER BY line) AS text
  FROM lines ANTI JOIN dropped USING (doc_id, line) GROUP BY doc_id
), counted AS (
  SELECT doc_id, count(*) AS n_dropped FROM dropped GROUP BY doc_id
)
SELECT documents.doc_id,
       CASE WHEN documents.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text,
       coalesce(len(string_split(documents.text, chr(10))), 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped
FROM documents LEFT JOIN kept USING (doc_id) LEFT JOIN counted USING (doc_id)
"""

OP11_SEARCH = r"""
WITH texts AS (
  SELECT row_number() OVER () AS place, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), corpus AS (
  SELECT count(*)::BIGINT AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM texts WHERE len(terms) > 0
), postings AS (
  SELECT place, term, count(*) AS tf FROM (SELECT place, unnest(terms) AS term FROM texts)
  WHERE term IN (SELECT term FROM asked) GROUP BY place, term
), weights AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w
  FROM postings, corpus GROUP BY term, n_docs
), lengths AS (
  SELECT place, doc_id, 10 + (90 * len(terms)::BIGINT * n_docs) // n_terms AS m FROM texts, corpus
), scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN lengths USING (place)
  GROUP BY item_id, place, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 10
"""

OP12_EXACT = r"""
WITH texts AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
FROM texts
WINDOW same AS (PARTITION BY text_sha256)
"""

SQL: dict[str, str] = {
    "op3_chat": OP3_CHAT,
    "op5_quality": OP5_QUALITY,
    "op8_jaccard": OP8_JACCARD,
    "op10_lines": OP10_LINES,
    "op11_search": OP11_SEARCH,
    "op12_exact": OP12_EXACT,
}
