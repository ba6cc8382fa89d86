"""SQL giving the same rows as each registered query, for another engine."""

from __future__ import annotations

from quire import fixed_values as fixed

LF, TAB, CR, SOH = "chr(10)", "chr(9)", "chr(13)", "chr(1)"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(t: str) -> str:
    return rf"regexp_replace(regexp_replace({t}, '^\s+', ''), '\s+$', '')"


def clean(t: str) -> str:
    blanks = rf"regexp_replace({t}, '[ \t]+', ' ', 'g')"
    return f"coalesce({strip(rf"regexp_replace({blanks}, '\n{{3,}}', {LF} || {LF}, 'g')")}, '')"


def words(t: str) -> str:
    return rf"list_filter(regexp_split_to_array({t}, '\s+'), lambda w: w <> '')"


def tokens(t: str) -> str:
    return words(f"lower({t})")


def sentences(t: str) -> str:
    marked = rf"regexp_replace({strip(t)}, '([.!?])\s+', concat('\1', {SOH}), 'g')"
    return f"list_filter(string_split({marked}, {SOH}), lambda s: s <> '')"


def contains_word(t: str, needle: str) -> str:
    return f"contains({t}, {quoted(needle)})"


DOC_NAME = "'doc_' || CAST(doc_id AS VARCHAR) || '.txt'"

SILVER = f"""
silver AS (
  SELECT *, CAST(len({words('clean_text')}) AS INTEGER) AS word_count, clean_text <> '' AS is_valid
  FROM (SELECT doc_id, {DOC_NAME} AS file_name, CAST(doc_id AS VARCHAR) AS document_id, 'txt' AS file_type,
               lang AS category, source AS uploaded_by, '2024-01-01T00:00:00Z' AS upload_timestamp,
               {clean('text')} AS clean_text
        FROM documents)
)"""

SIZE, STRIDE = fixed.SENTENCES_PER_CHUNK, fixed.SENTENCES_PER_CHUNK - fixed.OVERLAP_SENTENCES
CHUNKS = f"""{SILVER},
split AS (SELECT *, {sentences('clean_text')} AS s FROM silver WHERE is_valid),
starts AS (
  SELECT *, unnest(range(0, CAST(CASE WHEN len(s) <= {SIZE} THEN 1
                    ELSE {STRIDE} * ceil((len(s) - {SIZE}) / {STRIDE}.0) + 1 END AS BIGINT), {STRIDE})) AS start
  FROM split WHERE len(s) > 0
),
chunks AS MATERIALIZED (
  SELECT file_name || '_chunk_' || CASE WHEN start < 1000 THEN lpad(CAST(start AS VARCHAR), 3, '0')
                                        ELSE CAST(start AS VARCHAR) END AS chunk_id,
         array_to_string(s[start + 1 : start + {SIZE}], ' ') AS text, file_name, category, document_id
  FROM starts
)"""

TERMS = f"""{CHUNKS},
docs AS MATERIALIZED (SELECT chunk_id, {tokens('text')} AS t FROM chunks),
totals AS (SELECT count(*) AS n, sum(len(t)) / count(*) AS avgdl FROM docs),
tf AS MATERIALIZED (SELECT chunk_id, any_value(dl) AS dl, term, count(*) AS tf
       FROM (SELECT chunk_id, len(t) AS dl, unnest(t) AS term FROM docs) GROUP BY chunk_id, term),
raw_idf AS MATERIALIZED (SELECT term, count(*) AS df, ln(any_value(n) - count(*) + 0.5) - ln(count(*) + 0.5) AS raw
            FROM tf, totals GROUP BY term),
dictionary AS (SELECT term, df, CASE WHEN raw < 0 THEN {fixed.BM25_EPSILON} * (SELECT avg(raw) FROM raw_idf) ELSE raw END AS idf
               FROM raw_idf)"""

ITEMS = "queries AS (SELECT item_id AS query_id, text FROM benchmark)"
USER_TURNS = "queries AS (SELECT conv_id * 1000 + turn AS query_id, text FROM conversations WHERE role = 'user')"
REGIONS = "queries AS (SELECT r_regionkey AS query_id, r_name AS text FROM region)"
K1, B = fixed.BM25_K1, fixed.BM25_B


def bm25(queries: str, k: int) -> str:
    return f"""{TERMS}, {queries},
query_terms AS (SELECT query_id, term, count(*) AS times
                FROM (SELECT query_id, unnest({tokens('text')}) AS term FROM queries) GROUP BY query_id, term),
scores AS (
  SELECT query_id, chunk_id, sum(times * idf * tf * ({K1} + 1) / (tf + {K1} * (1 - {B} + {B} * dl / avgdl))) AS raw_score
  FROM query_terms JOIN tf USING (term) JOIN dictionary USING (term), totals GROUP BY query_id, chunk_id
),
bm25_hits AS (
  SELECT * FROM (SELECT query_id, chunk_id, round(raw_score, 6) AS score,
    CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(raw_score, 9) DESC, chunk_id) AS INTEGER) AS rank
    FROM scores) WHERE rank <= {k}
)"""


def embedding_of(table: str, key: str) -> str:
    slot = "CAST('0x' || substr(md5(term), 1, 8) AS BIGINT) % 64"
    return f"""
SELECT {key}, slot, CAST(CAST(n / sqrt(sum(n * n) OVER (PARTITION BY {key})) AS FLOAT) AS DOUBLE) AS weight
FROM (SELECT {key}, {slot} AS slot, CAST(count(*) AS DOUBLE) AS n
      FROM (SELECT {key}, unnest({tokens('text')}) AS term FROM {table}) GROUP BY 1, 2)"""


# Both sides have unit length or are zero, so only shared slots matter.
HYBRID = f"""{bm25(ITEMS, 6)},
chunk_slots AS ({embedding_of('chunks', 'chunk_id')}),
query_slots AS ({embedding_of('queries', 'query_id')}),
chunk_norm AS (SELECT chunk_id, sum(weight * weight) AS n2 FROM chunk_slots GROUP BY chunk_id),
query_norm AS (SELECT query_id, sum(weight * weight) AS n2 FROM query_slots GROUP BY query_id),
dots AS (SELECT query_id, chunk_id, sum(c.weight * q.weight) AS dot
         FROM chunk_slots c JOIN query_slots q USING (slot) GROUP BY 1, 2),
distances AS (
  SELECT q.query_id, c.chunk_id, greatest(0, q.n2 + c.n2 - 2 * coalesce(dot, 0)) AS d
  FROM query_norm q CROSS JOIN chunk_norm c LEFT JOIN dots USING (query_id, chunk_id)
),
vector_hits AS (
  SELECT * FROM (SELECT query_id, chunk_id,
    CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(d, 9), chunk_id) AS INTEGER) AS rank
    FROM distances) WHERE rank <= 6
),
fused AS (
  SELECT query_id, chunk_id, max(v) AS vector_rank, max(b) AS bm25_rank,
         coalesce(1.0 / ({fixed.RRF_K} + max(v)), 0) + coalesce(1.0 / ({fixed.RRF_K} + max(b)), 0) AS rrf
  FROM (SELECT query_id, chunk_id, rank AS v, NULL AS b FROM vector_hits
        UNION ALL SELECT query_id, chunk_id, NULL, rank FROM bm25_hits) GROUP BY 1, 2
),
hits AS (
  SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id
      ORDER BY round(rrf, 12) DESC, vector_rank ASC NULLS LAST, chunk_id) AS INTEGER) AS rank FROM fused)
  WHERE rank <= {fixed.HYBRID_TOP_K}
)"""

RERANKED = f"""{HYBRID},
pairs AS (
  SELECT h.query_id, h.chunk_id, h.rank AS candidate_rank, q.text AS query, c.text, c.file_name,
         round(len(list_intersect(list_distinct({tokens('q.text')}), list_distinct({tokens('c.text')})))
               / len(list_distinct({tokens('q.text')})), 6) AS rerank_score
  FROM hits h JOIN queries q USING (query_id) JOIN chunks c USING (chunk_id)
),
reranked AS (
  SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id
      ORDER BY rerank_score DESC, candidate_rank, chunk_id) AS INTEGER) AS rank FROM pairs)
  WHERE rank <= {fixed.RERANK_TOP_K}
)"""

CITATIONS = """(SELECT query_id, string_agg(file_name, '|' ORDER BY first_rank) AS citations
  FROM (SELECT query_id, file_name, min(rank) AS first_rank FROM reranked GROUP BY 1, 2) GROUP BY 1)"""

# --- contract --------------------------------------------------------------------

EVENTS = """
ev AS (
  SELECT doc_id, lang, source, (n_chars - 500) * 5000 AS size, md5(CAST(doc_id AS VARCHAR)) AS h,
         '/in/' || doc_id AS path,
         CASE WHEN source = 'src14' THEN '../' ELSE '' END || 'doc_' || doc_id ||
           CASE lang WHEN 'fr' THEN '.docx' WHEN 'de' THEN '.pdf' WHEN 'es' THEN '.md' ELSE '.TXT' END AS name,
         CASE WHEN lang = 'fr' THEN 'docx' ELSE 'txt' END AS kind,
         doc_id IN (SELECT doc_id FROM labels) AS known
  FROM documents
)"""


def _rules() -> list[tuple[str, str, str]]:
    text = lambda template, *args: "printf(" + ", ".join([quoted(template), *args]) + ")"
    categories = " or ".join([", ".join(f"'{c}'" for c in fixed.CATEGORIES[:-1]), f"'{fixed.CATEGORIES[-1]}'"])
    return [
        ("source = 'src9'", "uuid_parsing", quoted(fixed.MSG_UUID_CHARACTER % ("n", 0))),
        ("source = 'src14'", "not_bare", text(fixed.MSG_NOT_BARE, "'file_name'", "name")),
        ("size <= 0", "empty_upload", text(fixed.MSG_EMPTY_UPLOAD, "CAST(size AS VARCHAR)")),
        (f"size > {fixed.MAX_FILE_SIZE_BYTES}", "oversized", text(fixed.MSG_OVERSIZED, "CAST(size AS VARCHAR)", str(fixed.MAX_FILE_SIZE_BYTES))),
        ("source = 'src3'", "literal_error", quoted(f"Input should be {categories}")),
        ("source = 'src7'", "missing", quoted(fixed.MSG_MISSING)),
        ("source = 'src8'", "blank", quoted(fixed.MSG_BLANK % "uploaded_by")),
        ("source = 'src13'", "datetime_parsing", quoted(fixed.MSG_DATETIME_SHORT)),
        ("source = 'src5'", "extra_forbidden", quoted(fixed.MSG_EXTRA)),
        ("lang = 'es'", "suffix_unsupported", text(fixed.MSG_SUFFIX_UNSUPPORTED, "name", "'.md'", quoted("['.docx', '.pdf', '.txt']"))),
        ("lang = 'de'", "suffix_mismatch", text(fixed.MSG_SUFFIX_MISMATCH, "'txt'", "'.pdf'", "'pdf'")),
        ("NOT known", "file_missing", text(fixed.MSG_FILE_MISSING, "path")),
    ]


def _case(column: int) -> str:
    parts = [f"WHEN {rule[0]} THEN {quoted(rule[1]) if column == 1 else rule[2]}" for rule in _rules()]
    return "CASE " + " ".join(parts) + " END"


VALIDATED = f"{EVENTS}, validated AS (SELECT *, {_case(1)} AS reason_code, {_case(2)} AS reason FROM ev)"

MERGE = """
target AS (SELECT s_suppkey AS id, s_acctbal AS amount FROM supplier),
source AS (SELECT l_partkey AS id, sum(l_quantity) AS amount FROM lineitem GROUP BY 1)"""

UNTIDY = f"""
untidy AS (SELECT doc_id, {LF} || {TAB} || ' ' || replace(replace(text, ' ', ' ' || {TAB} || ' '), {LF}, {LF} || {LF} || {LF} || {LF})
                          || ' ' || {CR} || {LF} AS text FROM documents)"""


def _expectation(kind: str, column: str, table: str, unexpected: str) -> str:
    return f"""SELECT {quoted(kind)} AS expectation, {quoted(column)} AS "column",
  count(*) FILTER (WHERE {unexpected}) = 0 AS success, count(*) FILTER (WHERE {unexpected}) AS unexpected_count,
  count(*) AS row_count FROM {table}"""


def _unique(column: str, table: str) -> str:
    counted = f"(SELECT {column}, count(*) OVER (PARTITION BY {column}) AS n FROM {table})"
    return _expectation("expect_column_values_to_be_unique", column, counted, f"n > 1 AND {column} IS NOT NULL")


def _suite(*parts: str) -> str:
    return " UNION ALL ".join(parts)


NOT_NULL, REGEX = "expect_column_values_to_not_be_null", "expect_column_values_to_match_regex"
BETWEEN, IN_SET = "expect_column_values_to_be_between", "expect_column_values_to_be_in_set"

SILVER_SUITE = _suite(
    _expectation(NOT_NULL, "document_id", "silver", "document_id IS NULL"),
    _expectation(NOT_NULL, "file_name", "silver", "file_name IS NULL"),
    _expectation(REGEX, "file_type", "silver", "NOT regexp_matches(file_type, '^(pdf|docx|txt)$')"),
    _expectation(BETWEEN, "word_count", "silver", "word_count < 1"),
    _unique("file_name", "silver"),
    _expectation(IN_SET, "is_valid", "silver", "NOT is_valid"),
)

EXTRACTED = rf"""extracted AS (
  SELECT doc_id, CASE WHEN lang IN ('de', 'es') THEN 'docx' WHEN lang = 'fr' THEN 'xls' ELSE 'txt' END AS file_type,
    CASE lang WHEN 'es' THEN 'BadZipFile' WHEN 'fr' THEN 'no loader for xls' END AS problem,
    CASE WHEN lang = 'de' THEN array_to_string(list_concat(
           list_filter(string_split(text, {LF}), lambda l: regexp_matches(l, '\S')),
           [lang || ' | ' || lang || ' | ' || source, 'a | b | ' || source]), {LF})
         WHEN lang NOT IN ('es', 'fr') THEN text END AS raw_text
  FROM documents)"""

COERCED = [
    ("source = 'src2'", "malformed_json", "Input should be valid JSON"),
    ("source = 'src1'", "not_an_object", "Input should be a valid dictionary"),
    ("f = 2", "blank", fixed.MSG_BLANK % "file_name"),
    ("f > 2", "string_type", fixed.MSG_STRING),
    ("t > 2", "literal_error", "Input should be 'pdf', 'docx' or 'txt'"),
    ("s = 4", "int_from_float", fixed.MSG_INT_FRACTION),
    ("s = 5", "int_parsing", fixed.MSG_INT_TEXT),
    ("s IN (6, 9)", "int_type", fixed.MSG_INT),
]

CENTRES = """
parts AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS pos, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
centres AS (SELECT label AS query_id, pos, avg(x) AS c FROM parts GROUP BY 1, 2)"""

VECTOR_QUERIES = """WITH x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
d AS (SELECT q.vec_id AS query_id, v.vec_id AS chunk_id, sum((q.x - v.x) * (q.x - v.x)) AS d
  FROM x q JOIN x v USING (pos) WHERE q.vec_id % 50 = 0 GROUP BY 1, 2)
SELECT query_id, chunk_id, round(d, 6) AS distance, CAST(r AS INTEGER) AS rank FROM (SELECT *,
  row_number() OVER (PARTITION BY query_id ORDER BY round(d, 9), chunk_id) AS r FROM d) WHERE r <= 6"""
RECALL = "SELECT 6 * count(*) AS expected, true AS nine_tenths_found FROM embeddings WHERE vec_id % 50 = 0"
STEM = r"regexp_replace({n}, '(.)[.][^.]+$', '\1')"

ORACLES: dict[str, str] = {
    "a1_gold_rollup": f"""WITH {SILVER}
SELECT category, count(*) AS document_count, CAST(sum(word_count) AS BIGINT) AS total_word_count,
  round(avg(word_count), 1) AS avg_word_count, count(DISTINCT uploaded_by) AS distinct_uploaders
FROM silver WHERE is_valid GROUP BY category""",
    "a1_rollup_lineitem": """SELECT l_returnflag, count(*) AS line_count, sum(l_quantity) AS total_quantity,
  round(avg(l_quantity), 1) AS avg_quantity, count(DISTINCT l_suppkey) AS suppliers,
  strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') AS last_shipped FROM lineitem GROUP BY l_returnflag""",
    "a2_ingestion_counts": f"""WITH {VALIDATED} SELECT count(*) AS total, count(*) FILTER (WHERE reason IS NULL) AS accepted,
  count(*) FILTER (WHERE reason IS NOT NULL) AS rejected FROM validated""",
    "a3_rejection_breakdown": f"""WITH {VALIDATED}
SELECT split_part(split_part(reason, ' (', 1), ' —', 1) AS reason_key, count(*) AS n
FROM validated WHERE reason IS NOT NULL GROUP BY 1""",
    "a4_extraction_coverage": f"WITH {EXTRACTED} SELECT count(raw_text) AS with_text, count(*) AS documents FROM extracted",
    "a5_layer_counts": f"""WITH {SILVER} SELECT 'bronze' AS layer, count(*) AS row_count FROM documents
UNION ALL SELECT 'silver', count(*) FROM silver
UNION ALL SELECT 'gold', count(DISTINCT category) FROM silver WHERE is_valid""",
    "a6_corpus_statistics": f"""WITH {TERMS} SELECT (SELECT n FROM totals) AS n_docs,
  round((SELECT avgdl FROM totals), 6) AS mean_length, count(*) AS n_terms, round(avg(raw), 6) AS mean_idf FROM raw_idf""",
    "a6_term_dictionary": f"WITH {TERMS} SELECT term, df, round(idf, 6) AS idf FROM dictionary",
    "s13_extract_text": f"WITH {EXTRACTED} SELECT doc_id, file_type, md5(raw_text) AS text_md5, problem FROM extracted",
    "s3_encode_events": """SELECT CAST(s_suppkey AS VARCHAR) AS key, '{"s_suppkey":' || s_suppkey || ',"s_name":"' || s_name
  || '","s_nationkey":' || s_nationkey || '}' AS value FROM supplier""",
    "s6_manifest_round_trip": f"""SELECT CAST(doc_id AS VARCHAR) AS document_id, {DOC_NAME} AS file_name,
  n_chars AS file_size_bytes, lang AS category, CAST(NULL AS VARCHAR) AS course_code, source AS uploaded_by FROM documents""",
    "s9_guarded_append": "SELECT * FROM customer",
    "s10_compaction": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders",
    "s11_delete_where": """SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id)
WHERE NOT coalesce(quality = 0, FALSE)""",
    "s11_stored_delete": """SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderpriority <> '1-URGENT'""",
    "s12_vector_upsert": """SELECT 'vec_' || vec_id AS chunk_id, 'file_' || label AS file_name,
  CAST(pos - 1 AS INTEGER) AS pos, round(CAST(embedding[pos] AS DOUBLE) * CASE WHEN label IN (1, 2, 3) THEN -1 ELSE 1 END, 6) AS x
FROM (SELECT *, generate_subscripts(embedding, 1) AS pos FROM embeddings)""",
    "p1_first_keyword": """SELECT p_partkey, CASE WHEN contains(lower(p_name), 'ring') THEN 'round'
  WHEN contains(lower(p_name), 'red') THEN 'coloured' WHEN contains(lower(p_name), 'plate') THEN 'flat'
  WHEN contains(lower(p_name), 'gear') THEN 'round' WHEN contains(lower(p_name), 'blue') THEN 'coloured'
  ELSE 'other' END AS category FROM part""",
    "p1_infer_category": f"""SELECT {DOC_NAME} AS file_name, CASE doc_id % 6 WHEN 3 THEN 'scholarship' WHEN 4 THEN 'course_catalog'
  WHEN 5 THEN 'general' ELSE 'policy' END AS category FROM documents""",
    "p2_lookup_with_default": "SELECT r_name, CASE r_name WHEN 'ASIA' THEN 'as' WHEN 'EUROPE' THEN 'eu' ELSE 'xx' END AS code FROM region",
    "p3_suffix_and_stem": f"""SELECT page_id, lower(regexp_extract(n, '^.+([.][^.]+)$', 1)) AS suffix,
  {STEM.format(n='n')} AS stem FROM (SELECT page_id, regexp_extract(url, '[^/]*$') AS n FROM pages)""",
    "p4_projection": f"""SELECT CAST(doc_id AS VARCHAR) AS document_id, {DOC_NAME} AS file_name, 'txt' AS file_type,
  lang AS category, n_chars AS file_size_bytes FROM documents""",
    "p5_valid_rows": "SELECT doc_id, toxic FROM labels WHERE quality = 1",
    "p6_retrievable_rows": f"WITH {SILVER} SELECT file_name, CAST(length(clean_text) AS INTEGER) AS n FROM silver WHERE is_valid AND clean_text <> ''",
    "p7_marker_present": f"WITH {SILVER} SELECT file_name, contains(clean_text, 'on the') AS marked FROM silver",
    "p8_silver_projection": f"""WITH {SILVER} SELECT file_name, document_id, file_type, category, uploaded_by, upload_timestamp,
  md5(clean_text) AS text_md5, word_count, is_valid FROM silver""",
    "p9_chunk_metadata": f"WITH {CHUNKS} SELECT chunk_id, file_name, category, document_id FROM chunks",
    "v_contract_outcomes": f"WITH {VALIDATED} SELECT doc_id, reason_code, reason FROM validated",
    "v17_normalized_events": f"""WITH {VALIDATED} SELECT
  h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] AS document_id,
  name AS file_name, path AS file_path, kind AS file_type, size AS file_size_bytes,
  CASE WHEN source = 'src4' THEN 'general' ELSE 'policy' END AS category, CAST(NULL AS VARCHAR) AS course_code,
  source AS uploaded_by, CASE source WHEN 'src11' THEN '2023-11-14T22:13:20Z' WHEN 'src12' THEN '2024-01-01T00:00:00'
  ELSE '2024-01-01T00:00:00.500000Z' END AS upload_timestamp
FROM validated WHERE reason IS NULL""",
    "v18_rejected_events": f"""WITH {VALIDATED} SELECT path AS file_path, reason AS rejection_reason, reason_code
FROM validated WHERE reason IS NOT NULL""",
    "s5_dead_letters": f"""WITH {VALIDATED} SELECT path AS file_path, reason AS rejection_reason,
  '2024-06-01T00:00:00.000000+00:00' AS rejected_at FROM validated WHERE reason IS NOT NULL""",
    "v_coercions": "WITH coerced AS (SELECT *, n_chars % 5 AS f, (n_chars + doc_id) % 7 AS t, doc_id % 10 AS s FROM documents), "
    + "judged AS (SELECT *, CASE " + " ".join(f"WHEN {when} THEN {quoted(code)}" for when, code, _ in COERCED) + " END AS reason_code, "
    + "CASE " + " ".join(f"WHEN {when} THEN {quoted(reason)}" for when, _, reason in COERCED) + """ END AS reason FROM coerced)
SELECT doc_id, reason_code, reason, CASE WHEN reason IS NULL THEN CASE f WHEN 0 THEN 'Doc.TXT' ELSE 'Doc.txt' END END AS file_name,
  CASE WHEN reason IS NULL THEN CAST(CASE s WHEN 0 THEN 25 WHEN 1 THEN 1000 WHEN 2 THEN 1 WHEN 3 THEN 12 WHEN 7 THEN 7 WHEN 8 THEN 3 END AS BIGINT)
    END AS file_size_bytes,
  CASE WHEN reason IS NULL THEN 'Bot' END AS uploaded_by, CASE WHEN reason IS NULL THEN 'general' END AS category,
  CASE WHEN reason IS NULL THEN '2024-06-01T00:00:00.000000Z' END AS upload_timestamp FROM judged""",
    "t4_run_summary": f"""WITH {VALIDATED}
SELECT split_part(split_part(reason, ' (', 1), ' —', 1) AS reason_key, count(*) AS n, (SELECT count(*) FROM validated) AS total,
  (SELECT count(*) FROM validated WHERE reason IS NULL) AS accepted, (SELECT count(reason) FROM validated) AS rejected
FROM validated WHERE reason IS NOT NULL GROUP BY 1""",
    "t5_runs_go_on": f"""WITH {VALIDATED} SELECT CAST(CASE doc_id % 2 WHEN 0 THEN 1 ELSE 3 END AS INTEGER) AS run, count(*) AS total,
  count(*) FILTER (WHERE reason IS NULL) AS accepted, count(reason) AS rejected FROM validated GROUP BY 1""",
    "h3_gated_pipeline": f"""WITH {VALIDATED}
SELECT 'consume' AS job, 'COMPLETE' AS state, CAST(0 AS BIGINT) AS failures, CAST(1 AS BIGINT) AS completions, count(*) AS row_count
FROM validated WHERE reason IS NULL
UNION ALL SELECT 'check', 'FAIL', 1, 0, count(*) FROM validated WHERE reason IS NOT NULL""",
    "g1_refused_writes": """SELECT attempt, problem, times * n AS rows_after FROM (SELECT count(*) AS n FROM customer),
  (VALUES ('extra column', 'undeclared column note string', 1), ('missing column', 'missing column c_name string', 1),
    ('other type', 'column c_acctbal is string, declared double', 1), ('null', 'NULL in not-null column c_name', 1),
    ('nullable', NULL, 2)) AS tried(attempt, problem, times)""",
    "d3_approx_given_cells": f"""WITH {CENTRES},
d AS (SELECT vec_id, query_id, sum((x - c) * (x - c)) AS d FROM parts JOIN centres USING (pos) GROUP BY 1, 2),
cells AS (SELECT vec_id, arg_min(query_id, d) AS cell FROM d GROUP BY 1),
near AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, cell) AS r FROM (
  SELECT a.query_id, b.query_id AS cell, sum((a.c - b.c) * (a.c - b.c)) AS d FROM centres a JOIN centres b USING (pos) GROUP BY 1, 2))
SELECT query_id, vec_id AS chunk_id, round(d, 6) AS distance, CAST(rank AS INTEGER) AS rank FROM (
  SELECT d.query_id, vec_id, d.d, row_number() OVER (PARTITION BY d.query_id ORDER BY round(d.d, 9), vec_id) AS rank
  FROM d JOIN cells USING (vec_id) JOIN near ON near.query_id = d.query_id AND near.cell = cells.cell AND near.r <= 2) WHERE rank <= 20""",
    "v_event_properties": """SELECT event_id, CASE WHEN k > 50 THEN 'k ' || k || ' exceeds 50' END AS reason,
  CASE WHEN k <= 50 THEN k END AS k FROM (SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)""",
    "t3_stream_ingest": f"""WITH {VALIDATED} SELECT coalesce(reason_code, 'accepted') AS outcome, count(*) AS n FROM validated GROUP BY 1""",
    "h1_ingestion_gate": f"""WITH {VALIDATED} SELECT count(*) FILTER (WHERE reason IS NULL) AS accepted,
  count(*) FILTER (WHERE reason IS NOT NULL) AS rejected, count(*) FILTER (WHERE reason IS NULL) >= 1 AS passed FROM validated""",
    "m1_merge_insert_only": f"""WITH {MERGE} SELECT * FROM target UNION ALL
SELECT * FROM source WHERE id NOT IN (SELECT id FROM target)""",
    "m2_merge_upsert": f"""WITH {MERGE} SELECT * FROM target WHERE id NOT IN (SELECT id FROM source) UNION ALL SELECT * FROM source""",
    "m2_stored_merge": f"""WITH {MERGE} SELECT * FROM target WHERE id NOT IN (SELECT id FROM source) UNION ALL SELECT * FROM source""",
    "s12_emptied_files": """SELECT 'vec_' || vec_id AS chunk_id, 'file_' || label AS file_name FROM embeddings
WHERE label <> 2 AND (label <> 1 OR embedding[1] > 0)""",
    "m4_unchanged_rows": """SELECT count(*) FILTER (o_orderpriority <> '5-LOW') AS rows_before, count(*) AS rows_incoming,
  count(*) FILTER (o_orderpriority = '5-LOW') AS rows_inserted, count(*) FILTER (o_orderpriority = '1-URGENT') AS rows_updated,
  count(*) FILTER (o_orderpriority NOT IN ('5-LOW', '1-URGENT')) AS rows_unchanged, count(*) AS rows_after FROM orders""",
    "u1_stored_revision": """SELECT file_name, document_id, upload_timestamp, text_md5 FROM (SELECT *, row_number() OVER
  (PARTITION BY file_name ORDER BY upload_timestamp DESC, document_id DESC) AS r FROM (SELECT
    source || '_' || lang || '.txt' AS file_name, lpad(CAST(doc_id AS VARCHAR), 8, '0') AS document_id, md5(text) AS text_md5,
    strftime(DATE '2024-01-01' + CAST(n_chars AS INTEGER), '%Y-%m-%dT00:00:00Z') AS upload_timestamp FROM documents)) WHERE r = 1""",
    "m4_merge_metrics": f"""WITH {MERGE}, n AS (SELECT (SELECT count(*) FROM target) AS b, (SELECT count(*) FROM source) AS i,
  (SELECT count(*) FROM source WHERE id IN (SELECT id FROM target)) AS m)
SELECT b AS rows_before, i AS rows_incoming, i - m AS rows_inserted, m AS rows_updated, b + i - m AS rows_after FROM n""",
    "w2_latest_per_key": """SELECT l_partkey, l_orderkey, l_linenumber, l_quantity FROM (SELECT *, row_number() OVER
  (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS r FROM lineitem) WHERE r = 1""",
    "u1_latest_revision": """SELECT file_name, document_id, upload_timestamp FROM (SELECT *, row_number() OVER
  (PARTITION BY file_name ORDER BY upload_timestamp DESC, document_id DESC) AS r FROM (SELECT
    source || '_' || lang || '.txt' AS file_name, lpad(CAST(doc_id AS VARCHAR), 8, '0') AS document_id,
    strftime(DATE '2024-01-01' + CAST(n_chars AS INTEGER), '%Y-%m-%dT00:00:00Z') AS upload_timestamp FROM documents)) WHERE r = 1""",
    "u3_revise_once": f"""WITH {SILVER}, revised AS (
  SELECT file_name, 'rev-' || doc_id AS document_id, clean_text || {LF} || {LF} || 'ADDENDUM: toxic ' || toxic AS t
  FROM silver JOIN labels USING (doc_id) WHERE NOT contains(clean_text, 'on the'))
SELECT file_name, document_id, md5(t) AS text_md5, CAST(len({words('t')}) AS INTEGER) AS word_count FROM revised""",
    "u2_all_addenda": f"""WITH {SILVER}, revised AS (
  SELECT file_name, clean_text || {LF} || {LF} || 'ADDENDUM 1: quality ' || quality || {LF} || {LF} || 'ADDENDUM 2: quality ' || quality AS t
  FROM silver JOIN labels USING (doc_id))
SELECT file_name, 'rev-2' AS document_id, md5(t) AS text_md5, CAST(len({words('t')}) AS INTEGER) AS word_count FROM revised""",
    "j1_existing_files": f"SELECT {DOC_NAME} AS file_name, '/in/' || doc_id AS file_path FROM documents SEMI JOIN labels USING (doc_id)",
    "e1_union_events": """SELECT c_custkey, c_name, c_mktsegment FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""",
    "o1_ordered_documents": f"SELECT lang AS category, {DOC_NAME} AS file_name FROM documents ORDER BY 1, 2",
    "o3_topk_per_group": """SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice, CAST(r AS INTEGER) AS rank FROM (SELECT *,
  row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS r FROM lineitem) WHERE r <= 6""",
    "x1_nfkc": "SELECT doc_id, regexp_matches(text, 'fi|[mnu .2]') AS changed, md5(text) AS text_md5 FROM documents",
    "x2_clean_text": f"WITH {UNTIDY} SELECT doc_id, md5({clean('text')}) AS text_md5 FROM untidy",
    "x6_word_count": f"WITH {UNTIDY} SELECT doc_id, CAST(len({words('text')}) AS INTEGER) AS word_count FROM untidy",
    "x8_sentences": f"""WITH {UNTIDY} SELECT doc_id, CAST(len(s) AS INTEGER) AS n, md5(array_to_string(s, '|')) AS sentences_md5
FROM (SELECT doc_id, {sentences('text')} AS s FROM untidy)""",
    "x9_chunks": f"WITH {CHUNKS} SELECT chunk_id, md5(text) AS text_md5, category FROM chunks",
    "x11_tokens": f"""SELECT conv_id, turn, CAST(len(t) AS INTEGER) AS n, md5(array_to_string(t, ' ')) AS tokens_md5
FROM (SELECT conv_id, turn, {tokens('text')} AS t FROM conversations)""",
    "x12_reason_key": """SELECT c_custkey, CASE WHEN c_custkey % 3 = 2 THEN c_name || '-' || c_mktsegment || '(low)' ELSE c_name END AS reason_key
FROM customer""",
    "x13_record_name": """SELECT doc_id, replace(CASE WHEN lang <> 'fr' THEN CAST(doc_id AS VARCHAR) ELSE 'no-id' END || '_' ||
  CASE WHEN lang <> 'de' THEN source || ' of ' || lang || '.v1' ELSE 'unknown' END || '.json', ' ', '_') AS record_name FROM documents""",
    "x14_iso_time": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS iso FROM events",
    "x16_json_properties": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "x17_refusal_wording": "SELECT conv_id, turn, contains(text, 'me') AS refused FROM conversations",
    "q_silver_suite": f"WITH {SILVER} {SILVER_SUITE}",
    "q_lineitem_suite": _suite(
        _expectation(NOT_NULL, "l_orderkey", "lineitem", "l_orderkey IS NULL"),
        _expectation(REGEX, "l_returnflag", "lineitem", "NOT regexp_matches(l_returnflag, '^[AN]$')"),
        _expectation(BETWEEN, "l_discount", "lineitem", "l_discount < 0 OR l_discount > 0.08::DOUBLE"),
        _expectation(BETWEEN, "l_quantity", "lineitem", "l_quantity < 1"),
        _expectation(IN_SET, "l_linestatus", "lineitem", "l_linestatus <> 'O'"),
        _unique("l_orderkey", "lineitem"),
        _unique("l_shipdate", "lineitem"),
    ),
    "q_nullable_columns": "WITH labelled AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id)) " + _suite(
        _expectation(NOT_NULL, "quality", "labelled", "quality IS NULL"),
        _expectation(BETWEEN, "quality", "labelled", "quality < 1"),
        _expectation(IN_SET, "toxic", "labelled", "toxic <> 0"),
        _unique("doc_id", "labelled"),
    ),
    "h2_quality_verdict": f"""WITH {SILVER} SELECT bool_and(success) AS success, max(row_count) AS row_count,
  count(*) FILTER (WHERE NOT success) AS failed_expectations FROM ({SILVER_SUITE})""",
    "g2_null_violations": f"""WITH {EXTRACTED}, b AS (SELECT * FROM extracted LEFT JOIN labels USING (doc_id))
SELECT 'doc_id' AS "column", count(*) FILTER (WHERE doc_id IS NULL) AS null_count FROM b
UNION ALL SELECT 'raw_text', count(*) FILTER (WHERE raw_text IS NULL) FROM b
UNION ALL SELECT 'quality', count(*) FILTER (WHERE quality IS NULL) FROM b""",
    "l2_lineage_summary": """SELECT user_id, CASE WHEN f > 0 THEN 'error' WHEN c > 0 THEN 'purchase' ELSE 'RUNNING' END AS state,
  f AS failures, c AS completions, round((epoch_us(e) - epoch_us(s)) / 1000000.0, 6) AS duration_seconds
FROM (SELECT user_id, min(ts) FILTER (WHERE event_type = 'signup') AS s,
  max(ts) FILTER (WHERE event_type IN ('purchase', 'error')) AS e, count(*) FILTER (WHERE event_type = 'error') AS f,
  count(*) FILTER (WHERE event_type = 'purchase') AS c FROM events GROUP BY user_id)""",
    "d1_embeddings": f"""WITH {ITEMS} SELECT query_id, CAST(slot AS INTEGER) AS slot, round(weight, 5) AS weight
FROM ({embedding_of('queries', 'query_id')})""",
    "d2_dense_topk": f"""WITH {CENTRES}, d AS (SELECT query_id, vec_id AS chunk_id, sum((x - c) * (x - c)) AS d
  FROM parts JOIN centres USING (pos) GROUP BY 1, 2)
SELECT query_id, chunk_id, round(d, 6) AS distance, CAST(r AS INTEGER) AS rank FROM (SELECT *,
  row_number() OVER (PARTITION BY query_id ORDER BY round(d, 9), chunk_id) AS r FROM d) WHERE r <= 6""",
    "d2_vector_queries": VECTOR_QUERIES,
    "d3_compressed_all_cells": VECTOR_QUERIES,
    "d3_approx_recall": RECALL,
    "d3_compressed_recall": RECALL,
    "d4_bm25_topk": f"WITH {bm25(ITEMS, 6)} SELECT * FROM bm25_hits",
    "d4_bm25_user_turns": f"WITH {bm25(USER_TURNS, 10)} SELECT * FROM bm25_hits",
    "d4a_bm25_padded": f"""WITH {bm25(REGIONS, 6)} SELECT query_id, chunk_id, score, CAST(r AS INTEGER) AS rank FROM (
  SELECT query_id, chunk_id, round(coalesce(raw_score, 0), 6) AS score,
    row_number() OVER (PARTITION BY query_id ORDER BY round(coalesce(raw_score, 0), 9) DESC, chunk_id) AS r
  FROM queries CROSS JOIN chunks LEFT JOIN scores USING (query_id, chunk_id)) WHERE r <= 6""",
    "d4_bm25_postings": f"WITH {bm25(REGIONS, 6)} SELECT * FROM bm25_hits",
    "d5_rank_fusion": """WITH l AS (SELECT l_partkey AS query_id, l_suppkey AS chunk_id, sum(l_quantity) AS q, min(l_quantity) AS m
  FROM lineitem GROUP BY 1, 2),
v AS (SELECT * FROM (SELECT query_id, chunk_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY q DESC, chunk_id) AS INTEGER) AS v FROM l) WHERE v <= 6),
b AS (SELECT * FROM (SELECT query_id, chunk_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY m, chunk_id) AS INTEGER) AS b FROM l) WHERE b <= 6),
f AS (SELECT query_id, chunk_id, v AS vector_rank, b AS bm25_rank,
  coalesce(1.0::DOUBLE / (60 + v), 0) + coalesce(1.0::DOUBLE / (60 + b), 0) AS s FROM v FULL JOIN b USING (query_id, chunk_id))
SELECT query_id, chunk_id, vector_rank, bm25_rank, round(s, 9) AS rrf_score, CAST(r AS INTEGER) AS rank FROM (SELECT *,
  row_number() OVER (PARTITION BY query_id ORDER BY round(s, 12) DESC, vector_rank ASC NULLS LAST, chunk_id) AS r FROM f) WHERE r <= 6""",
    "d6_hybrid_search": f"""WITH {HYBRID} SELECT query_id, chunk_id, CAST(vector_rank AS INTEGER) AS vector_rank,
  CAST(bm25_rank AS INTEGER) AS bm25_rank, round(rrf, 9) AS rrf_score, rank FROM hits""",
    "d6_hybrid_all_cells": f"""WITH {HYBRID} SELECT query_id, chunk_id, CAST(vector_rank AS INTEGER) AS vector_rank,
  CAST(bm25_rank AS INTEGER) AS bm25_rank, round(rrf, 9) AS rrf_score, rank FROM hits""",
    "d6_refreshed_index": f"""WITH current_documents AS (
  SELECT * REPLACE (CASE WHEN lang = 'fr' THEN '' ELSE text END AS text) FROM documents),
{HYBRID.replace("FROM documents", "FROM current_documents")}
SELECT query_id, chunk_id, CAST(vector_rank AS INTEGER) AS vector_rank,
  CAST(bm25_rank AS INTEGER) AS bm25_rank, round(rrf, 9) AS rrf_score, rank FROM hits""",
    "d7_rerank": f"WITH {RERANKED} SELECT query_id, chunk_id, rank, candidate_rank, rerank_score FROM reranked",
    "d8_context": f"""WITH {RERANKED} SELECT query_id, md5(context) AS context_md5, citations FROM
  (SELECT query_id, string_agg('[Source ' || rank || ': ' || file_name || ']' || {LF} || text, {LF} || {LF} ORDER BY rank) AS context
   FROM reranked GROUP BY 1) JOIN {CITATIONS} USING (query_id)""",
    "d8_messages": f"""WITH {ITEMS} SELECT query_id, 'system' AS role, md5({quoted(fixed.SYSTEM_PROMPT)}) AS content_md5 FROM queries
UNION ALL SELECT query_id, 'user', md5('CONTEXT:' || {LF} || text || {LF} || {LF} || 'QUESTION: ' || text) FROM queries""",
    "d9_generated_answers": f"""SELECT item_id AS query_id, 'Re: ' || text AS answer, 'f.txt' AS citations FROM benchmark
UNION ALL SELECT -1 - r_regionkey, {quoted(fixed.REFUSAL_TEXT)}, '' FROM region""",
    "d10_answers": f"""WITH {RERANKED},
best AS (
  SELECT query_id, arg_max(sentence, met * 100000 - i) AS sentence, max(met) AS met FROM (
    SELECT query_id, s[i] AS sentence, i,
           len(list_intersect(list_distinct({tokens('query')}), list_distinct({tokens('s[i]')}))) AS met
    FROM (SELECT query_id, query, s, unnest(range(1, len(s) + 1)) AS i
          FROM (SELECT query_id, query, {sentences('text')} AS s FROM reranked WHERE rank = 1)))
  GROUP BY query_id
),
used AS (SELECT query_id, CAST(count(*) AS INTEGER) AS chunks_used FROM reranked GROUP BY 1),
found AS (SELECT query_id, count(*) AS n FROM hits GROUP BY 1)
SELECT q.query_id, q.text AS query,
  CASE WHEN met > 0 THEN sentence || ' [Source 1]' ELSE {quoted(fixed.REFUSAL_TEXT)} END AS answer,
  CASE WHEN met > 0 THEN citations ELSE '' END AS citations, chunks_used, n AS hybrid_candidate_count
FROM queries q JOIN best USING (query_id) JOIN used USING (query_id) JOIN found USING (query_id)
JOIN {CITATIONS} USING (query_id)""",
}
