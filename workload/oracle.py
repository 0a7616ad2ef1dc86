"""The same results in DuckDB SQL, written from the definitions on whole tables."""

from __future__ import annotations

from nearkin.functions import text
from nearkin.functions.hashing import PRIME, hash_family
from nearkin.functions.stopwords import ENGLISH_STOP_WORDS
from nearkin.params import CLUSTER, DEV
from nearkin.plans import evaluate
from workload import queries as q

JAVA_SPACE = r"[ \t\n\x0B\f\r]"
NAMED = "SELECT 'pg' || doc_id AS book_id, text AS content FROM documents"
FILES = """files AS (
  SELECT doc_id, 'file:///corpus/' || doc_id || '/' ||
    CASE WHEN doc_id % 5 = 0 THEN 'notes' ELSE 'pg' || doc_id END || '.txt' AS path FROM documents)"""
DOCUMENTS = "SELECT doc_id AS book_id, text AS content FROM documents"
BENCHMARK = "SELECT item_id AS book_id, text AS content FROM benchmark"


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def mod_prime(md5_hex: str) -> str:
    """Four 32-bit words: 2^32 = 2 (mod p)."""
    words = [f"('0x' || substr({md5_hex}, {1 + 8 * i}, 8))::BIGINT" for i in range(4)]
    return f"(({words[0]} * 8 + {words[1]} * 4 + {words[2]} * 2 + {words[3]}) % {PRIME})"


def script(result: str, *ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + result


# Building blocks: each is one named table.


def books(source: str = DOCUMENTS) -> str:
    return f"books AS MATERIALIZED ({source})"


STOP_LIST = ", ".join(quoted(w) for w in ENGLISH_STOP_WORDS)
ALPHABET = r"regexp_replace(lower(content), '[^a-z \t\n\x0B\f\r]', '', 'g')"
TOKENS = f"""toks AS MATERIALIZED (
  SELECT book_id, list_filter(
    string_split_regex({ALPHABET}, '{JAVA_SPACE}+'),
    lambda t: len(t) > 1 AND t NOT IN ({STOP_LIST})) AS tokens
  FROM books)"""
RAW_WORDS = f"""toks AS MATERIALIZED (
  SELECT book_id, list_filter(
    string_split_regex(lower(content), '[{text.SPACE_CHARS}]+'), lambda t: t <> '') AS tokens
  FROM books)"""
SHINGLES = f"""sh AS MATERIALIZED (
  SELECT book_id, unnest(list_distinct(list_transform(
    range(1, len(tokens) - {DEV.shingle_k - 2}),
    lambda i: array_to_string(tokens[i:i + {DEV.shingle_k - 1}], ' ')))) AS shingle
  FROM toks WHERE len(tokens) >= {DEV.shingle_k})"""
HASHES = f"""hs AS MATERIALIZED (
  SELECT book_id, shingle, {mod_prime('m')} AS hash
  FROM (SELECT book_id, shingle, md5(shingle) AS m FROM sh))"""
SHINGLED = (books(), TOKENS, SHINGLES)


def signature_table(num_hashes: int) -> str:
    family = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(hash_family(num_hashes)))
    return f"""sig AS MATERIALIZED (
  SELECT book_id, position, min((a * hash + b) % {PRIME})::INTEGER AS value
  FROM hs, (VALUES {family}) AS family(position, a, b) GROUP BY book_id, position)"""


def index_table(bands: int, rows: int, name: str = "idx", source: str = "sig") -> str:
    return f"""{name} AS MATERIALIZED (
  SELECT book_id, band_id, {mod_prime('m')}::INTEGER AS bucket_hash FROM (
    SELECT book_id, (position // {rows})::INTEGER AS band_id,
      md5(unhex(string_agg(printf('%08x', value), '' ORDER BY position))) AS m
    FROM {source} WHERE position < {bands * rows} GROUP BY ALL))"""


def pair_table(name: str = "pairs", index: str = "idx") -> str:
    return f"""{name} AS MATERIALIZED (
  SELECT DISTINCT a.book_id AS book_id_1, b.book_id AS book_id_2
  FROM {index} a JOIN {index} b USING (band_id, bucket_hash) WHERE a.book_id < b.book_id)"""


def estimates(pairs: str = "pairs", name: str = "est") -> str:
    return f"""{name} AS MATERIALIZED (
  SELECT book_id_1, book_id_2, sum((x.value = y.value)::INT)::DOUBLE / count(*) AS similarity
  FROM {pairs} JOIN sig x ON x.book_id = book_id_1
  JOIN sig y ON y.book_id = book_id_2 AND y.position = x.position GROUP BY ALL)"""


EXACT = """sizes AS MATERIALIZED (SELECT book_id, count(*) AS n FROM sh GROUP BY book_id),
exact AS MATERIALIZED (
  SELECT book_id_1, book_id_2, shared / (a.n + b.n - shared)::DOUBLE AS jaccard FROM (
    SELECT x.book_id AS book_id_1, y.book_id AS book_id_2, count(*) AS shared
    FROM sh x JOIN sh y USING (shingle) WHERE x.book_id < y.book_id GROUP BY ALL)
  JOIN sizes a ON a.book_id = book_id_1 JOIN sizes b ON b.book_id = book_id_2)"""
TRUTH = f"truth AS MATERIALIZED (SELECT * FROM exact WHERE jaccard >= {evaluate.TRUTH_JACCARD})"
TOTAL = """total AS MATERIALIZED (
  SELECT count(*) AS n, count(*)::DOUBLE * (count(*) - 1) / 2 AS pairs
  FROM (SELECT DISTINCT book_id FROM sh))"""


def signed(num_hashes: int) -> tuple[str, ...]:
    return (*SHINGLED, HASHES, signature_table(num_hashes))


def indexed(params) -> tuple[str, ...]:
    return (*signed(params.num_hashes), index_table(params.bands, params.rows))


def counts_of(pairs: str) -> str:
    """One row n_candidates, tp, fp, fn, tn for a table of pairs."""
    return f"""(SELECT found::DOUBLE AS n_candidates, tp::DOUBLE AS tp, (found - tp)::DOUBLE AS fp,
    (wanted - tp)::DOUBLE AS fn, pairs - found - wanted + tp AS tn
  FROM (SELECT (SELECT count(*) FROM {pairs}) AS found, (SELECT count(*) FROM truth) AS wanted,
    (SELECT count(*) FROM {pairs} JOIN truth USING (book_id_1, book_id_2)) AS tp), total)"""


RATIOS = """SELECT *, CASE WHEN recall + precision > 0
    THEN 2 * recall * precision / (recall + precision) ELSE 0.0 END AS f1
  FROM (SELECT *, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
    CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
    CASE WHEN fp + tn > 0 THEN fp / (fp + tn) ELSE 0.0 END AS fpr FROM {counts})"""


def ratios_of(pairs: str) -> str:
    return f"({RATIOS.format(counts=counts_of(pairs))})"


def rounded(columns: str, digits: int) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns.split())


MEASURES = "recall precision f1 fpr"


def sweep_parts(configs) -> tuple[list[str], str]:
    ctes, selects = [], []
    for n, b, r in configs:
        tag = f"{n}_{b}_{r}"
        ctes += [index_table(b, r, f"idx_{tag}"), pair_table(f"pairs_{tag}", f"idx_{tag}")]
        selects.append(
            f"SELECT 'b={b},r={r}' AS config, {n}::INTEGER AS n, {b}::INTEGER AS b, {r}::INTEGER AS r, "
            f"round(pow(1.0::DOUBLE / {b}, 1.0::DOUBLE / {r}), 4) AS theoretical_threshold, "
            f"n_candidates, {rounded(MEASURES, 4)} FROM {ratios_of(f'pairs_{tag}')}"
        )
    return ctes, "\nUNION ALL ".join(selects)


BAND_CONFIGS = [(evaluate.BAND_GRID_HASHES, b, r) for b, r in evaluate.BAND_GRID]
HASH_CONFIGS = [
    (n, n // evaluate.HASH_GRID_ROWS, evaluate.HASH_GRID_ROWS) for n in evaluate.HASH_GRID
]


def swept(configs, result: str) -> str:
    ctes, select = sweep_parts(configs)
    hashes = max(n for n, _, _ in configs)
    return script(
        result, *signed(hashes), EXACT, TRUTH, TOTAL, *ctes, f"swept AS MATERIALIZED ({select})"
    )


LSH_VS_EXACT = f"""SELECT 'LSH' AS method, {rounded(MEASURES, 4)},
    round(n_candidates / (tp + fp + fn + tn), 4) AS selectivity, n_candidates
  FROM {ratios_of('pairs')}
UNION ALL SELECT 'BruteForce', 1.0, 1.0, 1.0, 0.0, 1.0, pairs FROM total"""

FULL_CHAIN = (*indexed(CLUSTER), pair_table())

# Book-shaped texts and their cleaning

WRAPPED = books(
    r"""SELECT doc_id AS book_id, CASE WHEN doc_id % 3 = 0 THEN text ELSE
    repeat('preface' || chr(10), (doc_id % 5)::INT) || '  *** Start of this text ***' || chr(10)
    || repeat('front matter' || chr(10), (doc_id % 7 + 98)::INT) || text
    || chr(13) || chr(10) || 'End of the Project text' || chr(10) || 'licence — “terms”' || chr(10)
  END AS content FROM documents"""
)


def _marker_at(lines: str, markers) -> str:
    alternatives = "|".join(m.replace("*", r"\*") for m in markers)
    pattern = f"^[{text.SPACE_CHARS}]*(?:{alternatives})"
    return (
        f"coalesce(list_position(list_transform({lines}, "
        f"lambda l: regexp_matches(upper(l), {quoted(pattern)})), true), 0)"
    )


STRIPPED = f"""lined AS (
  SELECT book_id, CASE WHEN parts[-1] = '' THEN parts[:-2] ELSE parts END AS lines FROM (
    SELECT book_id, string_split_regex(content, {quoted(text.LINE_END)}) AS parts FROM books)),
opened AS (
  SELECT book_id, lines, {_marker_at(f'lines[1:{text.START_WITHIN_LINES}]', text.START_MARKERS)} AS start
  FROM lined),
closed AS (
  SELECT *, greatest(start, {text.END_FROM_LINE}) AS looked,
    {_marker_at(f'lines[greatest(start, {text.END_FROM_LINE}) + 1:]', text.END_MARKERS)} AS hit
  FROM opened),
stripped AS MATERIALIZED (
  SELECT book_id, coalesce(array_to_string(
    lines[start + 1:CASE WHEN hit > 0 THEN looked + hit - 1 ELSE len(lines) END], chr(10)), '') AS body
  FROM closed)"""
CLEANED = f"""cleaned AS MATERIALIZED (
  SELECT book_id, trim(regexp_replace(
    translate(replace(replace(replace(body, '“', ' '), '”', ' '), '—', ' '), '‘’', ''''''),
    '[{text.SPACE_CHARS}]+', ' ', 'g'), ' ') AS cleaned FROM stripped)"""


def words_in(column: str) -> str:
    return f"len(regexp_extract_all({column}, '[^{text.SPACE_CHARS}]+'))::INTEGER"


EFFECT = f"""effect AS MATERIALIZED (
  SELECT book_id, len(content)::INTEGER AS raw_chars, len(cleaned)::INTEGER AS cleaned_chars,
    {words_in('content')} AS raw_words, {words_in('cleaned')} AS cleaned_words
  FROM books JOIN cleaned USING (book_id))"""
TEXT_STATS = f"""stats AS MATERIALIZED (
  SELECT book_id, len(string_split(content, chr(10)))::INTEGER AS num_lines,
    {words_in('content')} AS num_words, len(content)::INTEGER AS num_chars FROM books)"""

# Search

HITS_OF_ASKED = f"""hits AS (
  SELECT CASE WHEN book_id_1 = {q.ASKED_ID} THEN book_id_2 ELSE book_id_1 END AS book_id,
    round(similarity, 6) AS similarity
  FROM est WHERE {q.ASKED_ID} IN (book_id_1, book_id_2)
  ORDER BY similarity DESC, book_id LIMIT {DEV.top_k})"""
WIDE_ESTIMATES = (*indexed(q.WIDE), pair_table(), estimates())
GROUPS = """groups AS MATERIALIZED (
  SELECT book_id, md5('[' || string_agg(value::VARCHAR, ',' ORDER BY position) || ']') AS digest
  FROM sig GROUP BY book_id)"""
OTHERS = f"""others AS (
  SELECT {q.ASKED_ID}::BIGINT AS book_id_1, book_id AS book_id_2
  FROM (SELECT DISTINCT book_id FROM sig)
  WHERE book_id <> {q.ASKED_ID} AND {q.ASKED_ID} IN (SELECT book_id FROM sig))"""

CATALOG = """cat AS (
  SELECT doc_id::VARCHAR AS number, CASE WHEN n_chars % 4 = 0 THEN 'Sound' ELSE 'Text' END AS "Type",
    '' AS "Issued", 'A "title", no. ' || doc_id AS "Title", upper(lang) AS "Language",
    '' AS "Authors", '' AS "Subjects", '' AS "LoCC", source || '; all' AS "Bookshelves"
  FROM documents)"""

# Query signatures from another table, under names of their own.
ASKED_TEXTS = (
    f"asked_books AS ({BENCHMARK})",
    TOKENS.replace("toks AS", "asked_toks AS").replace("FROM books", "FROM asked_books"),
    SHINGLES.replace("sh AS", "asked_sh AS").replace("FROM toks", "FROM asked_toks"),
    HASHES.replace("hs AS", "asked_hs AS").replace("FROM sh)", "FROM asked_sh)"),
    signature_table(q.WIDE.num_hashes).replace("sig AS", "asked_sig AS").replace("FROM hs", "FROM asked_hs"),
    index_table(q.WIDE.bands, q.WIDE.rows, "asked_idx", "asked_sig"),
)
FROM_TEXTS = """found AS (
  SELECT DISTINCT a.book_id AS query_id, i.book_id FROM asked_idx a JOIN idx i USING (band_id, bucket_hash)),
scored AS (
  SELECT query_id, found.book_id, sum((x.value = y.value)::INT)::DOUBLE / count(*) AS similarity
  FROM found JOIN asked_sig x ON x.book_id = query_id
  JOIN sig y ON y.book_id = found.book_id AND y.position = x.position GROUP BY ALL)"""


def top_per_query(source: str, top_k: int) -> str:
    return f"""SELECT query_id, rank::INTEGER AS rank, book_id, round(similarity, 6) AS similarity FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, book_id) AS rank
  FROM {source}) WHERE rank <= {top_k}"""


BOTH_WAYS = """(SELECT book_id_1 AS query_id, book_id_2 AS book_id, similarity FROM est
  UNION ALL SELECT book_id_2, book_id_1, similarity FROM est)"""

_BY_NUMBER = "number::BIGINT, number"

SQL: dict[str, str] = {
    "strip_boilerplate": script("SELECT book_id, body FROM stripped", WRAPPED, STRIPPED),
    "clean_text": script("SELECT book_id, cleaned FROM cleaned", WRAPPED, STRIPPED, CLEANED),
    "tokens": script(
        "SELECT book_id, (position - 1)::INTEGER AS position, token FROM (SELECT book_id, "
        "unnest(tokens) AS token, generate_subscripts(tokens, 1) AS position FROM toks)",
        books(), TOKENS,
    ),
    "token_table": script(
        "SELECT book_id, len(tokens)::INTEGER AS num_tokens FROM toks WHERE len(tokens) > 0",
        books(), TOKENS,
    ),
    "token_stats": script(
        "SELECT book_id, raw_tokens, unique_tokens, kept_tokens, round(CASE WHEN raw_tokens > 0 "
        "THEN (raw_tokens - kept_tokens) / raw_tokens::DOUBLE * 100 ELSE 0.0 END, 6) AS removed_pct "
        "FROM (SELECT book_id, len(words)::INTEGER AS raw_tokens, "
        "len(list_distinct(words))::INTEGER AS unique_tokens, "
        "len(tokens)::INTEGER AS kept_tokens FROM toks JOIN (SELECT book_id, list_filter("
        f"string_split_regex({ALPHABET}, '{JAVA_SPACE}+'), lambda t: t <> '') AS words FROM books) "
        "USING (book_id))",
        books(), TOKENS,
    ),
    "top_token_docs": script(
        "SELECT book_id, len(tokens)::INTEGER AS num_tokens FROM toks WHERE len(tokens) > 0 "
        "ORDER BY num_tokens DESC, book_id LIMIT 10",
        books(), TOKENS,
    ),
    "shingles": script("SELECT book_id, shingle FROM sh", *SHINGLED),
    "raw_shingles": script("SELECT book_id, shingle FROM sh", books(), RAW_WORDS, SHINGLES),
    "shingle_hashes": script("SELECT book_id, shingle, hash FROM hs", *SHINGLED, HASHES),
    "signatures": script(
        "SELECT book_id, position, value FROM sig", *signed(DEV.num_hashes)
    ),
    "signatures_by_grouping": script(
        "SELECT book_id, position, value FROM sig", *signed(DEV.num_hashes)
    ),
    "query_text_signatures": script(
        "SELECT book_id, position, value FROM sig",
        books(BENCHMARK), RAW_WORDS, SHINGLES, HASHES, signature_table(CLUSTER.num_hashes),
    ),
    "lsh_index": script("SELECT book_id, band_id, bucket_hash FROM idx", *indexed(DEV)),
    "search_tables": script("SELECT book_id, band_id, bucket_hash FROM idx", *indexed(CLUSTER)),
    "search_signatures": script("SELECT book_id, position, value FROM sig", *signed(CLUSTER.num_hashes)),
    "group_pairs": script(
        f"SELECT g.digest AS group_1, h.digest AS group_2, round(max(similarity), 6) AS similarity "
        "FROM est JOIN groups g ON g.book_id = book_id_1 JOIN groups h ON h.book_id = book_id_2 "
        "WHERE g.digest < h.digest GROUP BY ALL UNION SELECT h.digest, g.digest, round(max(similarity), 6) "
        "FROM est JOIN groups g ON g.book_id = book_id_1 JOIN groups h ON h.book_id = book_id_2 "
        "WHERE h.digest < g.digest GROUP BY ALL",
        *indexed(DEV), pair_table(), estimates(), GROUPS,
    ),
    "group_members": script('SELECT digest AS "group", book_id FROM groups', *signed(DEV.num_hashes), GROUPS),
    "shared_buckets": script(
        "SELECT band_id, bucket_hash, n_members, book_id FROM idx JOIN (SELECT band_id, "
        "bucket_hash, count(*) AS n_members FROM idx GROUP BY ALL HAVING count(*) > 1) "
        "USING (band_id, bucket_hash)",
        *indexed(DEV),
    ),
    "candidate_pairs": script("SELECT * FROM pairs", *indexed(DEV), pair_table()),
    "index_pairs": script("SELECT * FROM pairs", *FULL_CHAIN),
    "scored_pairs": script("SELECT * FROM est", *indexed(DEV), pair_table(), estimates()),
    "estimate_error": script(
        "SELECT book_id_1, book_id_2, coalesce(jaccard, 0.0) AS jaccard, similarity, "
        "round(abs(coalesce(jaccard, 0.0) - similarity), 9) AS error "
        "FROM est LEFT JOIN exact USING (book_id_1, book_id_2)",
        *FULL_CHAIN, estimates(), EXACT,
    ),
    "exact_jaccard_pairs": script(
        f"SELECT *, {q.EXACT_MIN_JACCARD}::DOUBLE AS min_jaccard FROM exact WHERE jaccard >= {q.EXACT_MIN_JACCARD}", *SHINGLED, EXACT
    ),
    "truth_pairs": script("SELECT * FROM truth", *SHINGLED, EXACT, TRUTH),
    "match_probability": script(
        f"SELECT *, {q.EXACT_MIN_JACCARD}::DOUBLE AS min_jaccard, "
        f"round(1 - pow(1 - pow(jaccard, {DEV.rows}), {DEV.bands}), 9) AS probability "
        f"FROM exact WHERE jaccard >= {q.EXACT_MIN_JACCARD}",
        *SHINGLED, EXACT,
    ),
    "similar_to_doc": script("SELECT * FROM hits", *WIDE_ESTIMATES, HITS_OF_ASKED),
    "similar_enriched": script(
        'SELECT book_id, similarity, lang AS "Title", source AS "Author" FROM hits '
        "LEFT JOIN documents ON 'pg' || doc_id = book_id",
        books(NAMED), *WIDE_ESTIMATES[1:], HITS_OF_ASKED.replace(f"= {q.ASKED_ID}", f"= 'pg{q.ASKED_ID}'")
        .replace(f"WHERE {q.ASKED_ID}", f"WHERE 'pg{q.ASKED_ID}'"),
    ),
    "named_pairs": script(
        "SELECT least(a.name, b.name) AS book_id_1, greatest(a.name, b.name) AS book_id_2, "
        "round(max(similarity), 6) AS similarity FROM est JOIN names a ON a.book_id = book_id_1 "
        "JOIN names b ON b.book_id = book_id_2 WHERE a.name <> b.name GROUP BY 1, 2",
        *indexed(DEV), pair_table(), estimates(),
        "names AS (SELECT book_id, CASE WHEN book_id % 50 = 0 THEN '' ELSE 'pg' || book_id END AS name FROM books)",
    ),
    "file_ids": script(
        "SELECT path, CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'pg' || doc_id END AS book_id, "
        "split_part(path, '/', -1) AS filename, CASE WHEN doc_id % 5 = 0 THEN 'notes' "
        "ELSE doc_id::VARCHAR END AS number FROM files", FILES,
    ),
    "preprocessed_files": script(
        "SELECT CASE WHEN book_id % 5 = 0 THEN '' ELSE 'pg' || book_id END AS book_id, "
        "array_to_string(tokens, ' ') AS tokens FROM toks WHERE len(tokens) > 0",
        WRAPPED, STRIPPED,
        TOKENS.replace("lower(content)", "lower(body)").replace("FROM books", "FROM stripped"),
    ),
    "similar_to_text": script(
        f"SELECT book_id, round(similarity, 6) AS similarity FROM (SELECT {q.ASKED_ID}::BIGINT AS "
        f"book_id, 1.0::DOUBLE AS similarity WHERE {q.ASKED_ID} IN (SELECT book_id FROM sig) "
        f"UNION ALL SELECT * FROM hits) ORDER BY similarity DESC, book_id LIMIT {q.WIDE.top_k}",
        *WIDE_ESTIMATES, HITS_OF_ASKED,
    ),
    "similar_batch": script(top_per_query(BOTH_WAYS, 5), *FULL_CHAIN, estimates()),
    "similar_to_texts": script(
        top_per_query("scored", q.WIDE.top_k), *indexed(q.WIDE), *ASKED_TEXTS, FROM_TEXTS
    ),
    "brute_force_rank": script(
        "SELECT book_id_2 AS book_id, round(similarity, 6) AS similarity FROM est",
        *signed(DEV.num_hashes), OTHERS, estimates("others"),
    ),
    "comparisons_saved": script(
        "SELECT n_others, n_candidates, n_others - n_candidates AS n_saved, "
        "round(CASE WHEN n_others > 0 THEN (n_others - n_candidates) / n_others::DOUBLE * 100 ELSE 0.0 END, 6) AS saved_pct "
        f"FROM (SELECT (SELECT count(*) FROM others) AS n_others, (SELECT count(*) FROM pairs "
        f"WHERE {q.ASKED_ID} IN (book_id_1, book_id_2)) AS n_candidates)",
        *indexed(q.WIDE), pair_table(), OTHERS,
    ),
    "ranked_compare": script(
        "SELECT o.book_id_2 AS book_id, coalesce(jaccard, 0.0) AS jaccard, similarity, "
        "p.book_id_1 IS NOT NULL AS is_candidate FROM est o "
        "LEFT JOIN exact e ON e.book_id_1 = least(o.book_id_1, o.book_id_2) "
        "AND e.book_id_2 = greatest(o.book_id_1, o.book_id_2) "
        "LEFT JOIN pairs p ON p.book_id_1 = least(o.book_id_1, o.book_id_2) "
        "AND p.book_id_2 = greatest(o.book_id_1, o.book_id_2)",
        *indexed(q.WIDE), pair_table(), OTHERS, estimates("others"), EXACT,
    ),
    "candidate_stats": script(
        "SELECT count(*) AS n_docs, max(found) AS max_candidates, "
        "count(*) FILTER (WHERE found = 0) AS n_without, round(avg(found), 9) AS avg_candidates, "
        "round(count(*) FILTER (WHERE found = 0) / count(*)::DOUBLE, 9) AS share_without, "
        "round(1 - avg(found) / (count(*) - 1), 9) AS reduction "
        "FROM (SELECT book_id, count(other) AS found FROM (SELECT DISTINCT book_id FROM sh) "
        "LEFT JOIN (SELECT book_id_1 AS book_id, book_id_2 AS other FROM pairs UNION ALL "
        "SELECT book_id_2, book_id_1 FROM pairs) USING (book_id) GROUP BY book_id)",
        *FULL_CHAIN,
    ),
    "lsh_metrics": script(
        f"SELECT n_candidates, tp, fp, fn, tn, {rounded(MEASURES, 9)} FROM {ratios_of('pairs')}",
        *indexed(DEV), pair_table(), EXACT, TRUTH, TOTAL,
    ),
    "sweep_bands": swept(BAND_CONFIGS, "SELECT * FROM swept"),
    "sweep_hashes": swept(HASH_CONFIGS, "SELECT * FROM swept"),
    "lsh_vs_exact": script(LSH_VS_EXACT, *FULL_CHAIN, EXACT, TRUTH, TOTAL),
    "replicate": script(
        "SELECT book_id || '_' || copy AS book_id, len(content)::INTEGER AS num_chars FROM "
        "(SELECT *, row_number() OVER (ORDER BY book_id) - 1 AS rank FROM books), range(3) AS r(copy) "
        "WHERE copy * (SELECT count(*) FROM books) + rank < (SELECT count(*) FROM books) * 5 // 2",
        books(),
    ),
    "sample_ids": script(
        "SELECT book_id FROM books ORDER BY md5('42:' || book_id), book_id LIMIT 10", books()
    ),
    "doc_stats": script("SELECT * FROM stats", books(), TEXT_STATS),
    "corpus_stats": script(
        "SELECT measure, count(value) AS n_docs, sum(value)::BIGINT AS total, "
        "round(avg(value), 3) AS mean, min(value) AS least, max(value) AS most FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS measure, {c}::BIGINT AS value FROM effect"
            for c in ("raw_words", "cleaned_words", "raw_chars", "cleaned_chars")
        )
        + ") GROUP BY measure",
        WRAPPED, STRIPPED, CLEANED, EFFECT,
    ),
    "word_histogram": script(
        "SELECT bin::INTEGER AS bin, round(low + bin * span / 30::DOUBLE, 6) AS bin_start, "
        "round(low + (bin + 1) * span / 30::DOUBLE, 6) AS bin_end, count(num_words) AS n_docs "
        "FROM reach, range(30) AS b(bin) "
        "LEFT JOIN stats ON least((num_words - low) * 30 // span, 29) = bin GROUP BY ALL",
        books(), TEXT_STATS,
        "reach AS (SELECT min(num_words) AS low, max(num_words) - min(num_words) AS span FROM stats)",
    ),
    "cleaning_effect": script(
        "SELECT *, round(CASE WHEN raw_chars > 0 THEN (1 - cleaned_chars / raw_chars::DOUBLE) * 100 "
        "ELSE 0.0 END, 6) AS reduction_pct FROM effect",
        WRAPPED, STRIPPED, CLEANED, EFFECT,
    ),
    "longest_cleaned": script(
        "SELECT book_id, cleaned_words, text AS content FROM effect JOIN documents ON doc_id = book_id "
        "ORDER BY cleaned_words DESC, book_id LIMIT 10",
        WRAPPED, STRIPPED, CLEANED, EFFECT,
    ),
    "stage_counts": script(
        "SELECT 'documents' AS stage, count(*) AS n_rows FROM books "
        "UNION ALL SELECT 'tokens', count(*) FROM toks WHERE len(tokens) > 0 "
        "UNION ALL SELECT 'shingles', count(DISTINCT book_id) FROM sh "
        "UNION ALL SELECT 'signatures', count(DISTINCT book_id) FROM sig "
        "UNION ALL SELECT 'lsh_index', count(*) FROM idx",
        *indexed(DEV),
    ),
    "catalog_csv": script("SELECT * FROM cat", CATALOG),
    "catalog_select": script(
        'SELECT number, "Title", "Language", "Bookshelves" FROM cat WHERE "Type" = \'Text\' '
        "AND contains(lower(\"Language\"), 'en') AND contains(lower(\"Bookshelves\"), 'src1') "
        f"ORDER BY {_BY_NUMBER} LIMIT 30",
        CATALOG,
    ),
    "catalog_shelves": script(
        'SELECT shelf, number, "Language", "Bookshelves" FROM (SELECT *, row_number() OVER '
        f"(PARTITION BY shelf ORDER BY {_BY_NUMBER}) AS rank FROM cat JOIN (VALUES "
        + ", ".join(f"({quoted(s)})" for s in q.SHELVES)
        + ") AS s(shelf) ON contains(lower(\"Bookshelves\"), lower(shelf)) WHERE \"Type\" = 'Text' "
        "AND contains(lower(\"Language\"), 'e')) WHERE rank <= 7",
        CATALOG,
    ),
    "catalog_shelf_table": script(
        'SELECT shelf, number, "Language", "Bookshelves" FROM (SELECT *, row_number() OVER '
        f"(PARTITION BY shelf ORDER BY {_BY_NUMBER}) AS rank FROM cat JOIN (SELECT DISTINCT "
        "CASE WHEN doc_id % 4 = 0 THEN upper(source) WHEN doc_id % 4 = 1 THEN right(source, 1) || '; A' "
        "WHEN doc_id % 4 = 2 THEN doc_id::VARCHAR ELSE source || '; all ' || doc_id END AS shelf FROM documents) s "
        "ON contains(lower(\"Bookshelves\"), lower(shelf)) WHERE \"Type\" = 'Text' "
        "AND contains(lower(\"Language\"), 'e')) WHERE rank <= 7",
        CATALOG,
    ),
    "metadata_csv": "SELECT 'pg' || doc_id AS book_id, 'A \"title\", no. ' || doc_id AS \"Title\", "
    'lang AS "Author" FROM documents',
}


def _scaling() -> str:
    """Copies of all documents: c^2 pairs for each pair of documents, and those of one document."""
    selects = [
        f"SELECT (n * {c})::BIGINT AS size_target, (n * {c})::BIGINT AS size_actual, "
        f"((SELECT count(*) FROM pairs) * {c * c} + n * {c * (c - 1) // 2})::DOUBLE AS n_candidates "
        "FROM total"
        for c in q.SCALING_FACTORS
    ]
    return script("\nUNION ALL ".join(selects), *FULL_CHAIN, TOTAL)


def scalability_parts() -> tuple[list[str], str]:
    """Tables of the corpus grown by replicas that differ, and one row for each size.

    All sizes are parts of the largest: replica c is there from the size c + 1 on.
    """
    largest = max(q.SCALING_FACTORS)
    grown = f"""grown AS MATERIALIZED (
  SELECT book_id || '_' || c AS book_id, c,
    CASE WHEN c > 0 AND substr(md5(shingle || ':' || c), 1, 1) = '0' THEN shingle || '#' || c ELSE shingle END AS shingle
  FROM sh, range({largest}) AS r(c))"""
    ctes = [
        grown,
        HASHES.replace("hs AS", "grown_hs AS").replace("FROM sh)", "FROM grown)"),
        signature_table(100).replace("sig AS", "grown_sig AS").replace("FROM hs", "FROM grown_hs"),
        index_table(20, 5, "grown_idx", "grown_sig"),
        pair_table("grown_pairs", "grown_idx"),
        "copy_of AS MATERIALIZED (SELECT book_id, any_value(c) AS c, count(*) AS n FROM grown GROUP BY book_id)",
        f"""probes AS MATERIALIZED (
  SELECT book_id || '_0' AS probe FROM (SELECT DISTINCT book_id FROM sh)
  ORDER BY md5('{evaluate.PROBE_SEED}:' || book_id), book_id LIMIT {evaluate.PROBES})""",
        """named AS MATERIALIZED (
  SELECT probe, CASE WHEN book_id_1 = probe THEN book_id_2 ELSE book_id_1 END AS book_id
  FROM grown_pairs JOIN probes ON probe = book_id_1 OR probe = book_id_2)""",
        f"""alike AS MATERIALIZED (
  SELECT probe, s.book_id FROM (
    SELECT probe, y.book_id, count(*) AS shared FROM grown x JOIN probes ON probe = x.book_id
    JOIN grown y USING (shingle) WHERE y.book_id <> probe GROUP BY ALL) s
  JOIN copy_of a ON a.book_id = probe JOIN copy_of b ON b.book_id = s.book_id
  WHERE shared / (a.n + b.n - shared)::DOUBLE >= {evaluate.TRUTH_JACCARD})""",
    ]
    selects = [
        f"""SELECT n_docs, n_candidates, probe_candidates, probe_similar, probe_found,
  n_probes * (n_docs - 1) - probe_candidates AS probe_saved
FROM (SELECT (SELECT count(*) FROM copy_of WHERE c < {f}) AS n_docs,
  (SELECT count(*) FROM grown_pairs JOIN copy_of a ON a.book_id = book_id_1 JOIN copy_of b ON b.book_id = book_id_2
    WHERE greatest(a.c, b.c) < {f})::DOUBLE AS n_candidates,
  (SELECT count(*) FROM named JOIN copy_of USING (book_id) WHERE c < {f}) AS probe_candidates,
  (SELECT count(*) FROM alike JOIN copy_of USING (book_id) WHERE c < {f}) AS probe_similar,
  (SELECT count(*) FROM alike JOIN named USING (probe, book_id) JOIN copy_of USING (book_id) WHERE c < {f}) AS probe_found,
  (SELECT count(*) FROM probes) AS n_probes)"""
        for f in q.SCALING_FACTORS
    ]
    return ctes, "\nUNION ALL ".join(selects)


def _scalability() -> str:
    ctes, select = scalability_parts()
    return script(select, *SHINGLED, *ctes)


def _best_config() -> str:
    band_ctes, band_select = sweep_parts(BAND_CONFIGS)
    hash_ctes, hash_select = sweep_parts(HASH_CONFIGS)
    tables = [c for i, c in enumerate([*band_ctes, *hash_ctes]) if c not in [*band_ctes, *hash_ctes][:i]]
    return script(
        "SELECT * FROM (SELECT 'TN1' AS experiment, * FROM tn1 UNION ALL SELECT 'TN2', * FROM tn2) "
        "ORDER BY f1 DESC, n, b, experiment LIMIT 1",
        *signed(max(evaluate.HASH_GRID)), EXACT, TRUTH, TOTAL, *tables,
        f"tn1 AS MATERIALIZED ({band_select})", f"tn2 AS MATERIALIZED ({hash_select})",
    )


def _experiments() -> str:
    band_ctes, band_select = sweep_parts(BAND_CONFIGS)
    hash_ctes, hash_select = sweep_parts([c for c in HASH_CONFIGS if c not in BAND_CONFIGS])
    shared = [c for c in HASH_CONFIGS if c in BAND_CONFIGS]
    repeated = " ".join(
        f"UNION ALL SELECT * FROM tn1 WHERE n = {n} AND b = {b} AND r = {r}" for n, b, r in shared
    )
    named = "config, n::DOUBLE AS n, b::DOUBLE AS b, r::DOUBLE AS r, theoretical_threshold"
    measures = "n_candidates, recall, precision, f1, fpr"
    nothing = "NULL AS method, NULL AS selectivity"
    probed = ("n_docs", "probe_candidates", "probe_similar", "probe_found", "probe_saved")
    unprobed = ", ".join(f"NULL::BIGINT AS {c}" for c in probed)
    grown_ctes, grown_select = scalability_parts()
    result = (
        f"SELECT 'TN1' AS experiment, {named}, {measures}, {nothing}, {unprobed} FROM tn1 "
        f"UNION ALL SELECT 'TN2', {named}, {measures}, {nothing}, {unprobed} FROM tn2 "
        "UNION ALL SELECT 'TN3', NULL, NULL, NULL, NULL, NULL, n_candidates, NULL, NULL, NULL, NULL, "
        f"{nothing}, {', '.join(probed)} FROM tn3 "
        f"UNION ALL SELECT 'TN4', NULL, NULL, NULL, NULL, NULL, {measures}, method, selectivity, {unprobed} FROM tn4"
    )
    compared = LSH_VS_EXACT.replace(ratios_of("pairs"), ratios_of("pairs_100_20_5"))
    return script(
        result,
        *signed(max(evaluate.HASH_GRID)), EXACT, TRUTH, TOTAL, *band_ctes, *hash_ctes,
        f"tn1 AS MATERIALIZED ({band_select})",
        f"tn2 AS MATERIALIZED ({hash_select} {repeated})",
        f"tn4 AS MATERIALIZED ({compared})",
        *grown_ctes,
        f"tn3 AS MATERIALIZED ({grown_select})",
    )


SQL["scaling_counts"] = _scaling()
SQL["scalability"] = _scalability()
SQL["best_config"] = _best_config()
SQL["experiment_results"] = _experiments()
