"""DuckDB SQL that must give the rows of the queries in ``quire.llm.queries``."""

ORACLES: dict[str, str] = {}

_BLANK = r"[\x20\x09-\x0D]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES["op1_line_dedup"] = f"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
),
keyed AS (
  SELECT doc_id, pos, line, translate(regexp_replace(line, '^{_BLANK}+|{_BLANK}+$', '', 'g'), '{_UPPER}', '{_LOWER}') AS key
  FROM lines
),
shared AS (
  SELECT key, max(doc_id) AS home FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
),
marked AS (
  SELECT doc_id, pos, line, home IS NOT NULL AND home <> doc_id AS dropped FROM keyed LEFT JOIN shared USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

ORACLES["op4_exact_dedup_bloom"] = f"""
WITH digests AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{_BLANK}+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM digests WINDOW same AS (PARTITION BY text_sha256)
"""

# Level by level: sources whose share exceeds three times their size stop there, the rest share again.
ORACLES["op5_mixing_systematic"] = r"""
WITH sizes AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM sizes GROUP BY source
),
weighed AS (
  SELECT source, source_size, 3.0::DOUBLE * source_size AS lim,
    CASE (rank - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM sources
),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(lim) OVER (ORDER BY lim / weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY lim / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
),
targets AS (SELECT source, source_size, least(lim, weight * max(level) OVER ()) AS target FROM levels),
placed AS (
  SELECT s.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    row_number() OVER (PARTITION BY s.source ORDER BY size, doc_id) - 1 AS position,
    CAST(('0x' || substr(md5('0:' || coalesce(s.source, chr(0))), 1, 12)) AS BIGINT) / 281474976710656.0::DOUBLE AS shift
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
),
drawn AS (
  SELECT *, CAST(floor((position + 1) * rate + shift) - floor(position * rate + shift) AS BIGINT) AS copies FROM placed
)
SELECT doc_id, size, source_size, target, copies * size AS taken, source, copies FROM drawn
"""

# CRC-32 by its table, a byte at a time; the curve one level a step, from the highest bit.
ORACLES["op6_hilbert_shards"] = r"""
WITH RECURSIVE crc_steps(byte, step, value) AS (
  SELECT CAST(i AS UBIGINT), 0, CAST(i AS UBIGINT) FROM range(256) t(i)
  UNION ALL
  SELECT byte, step + 1, CASE WHEN value & 1 = 1 THEN xor(value >> 1, 3988292384::UBIGINT) ELSE value >> 1 END
  FROM crc_steps WHERE step < 8
),
crc_table AS (SELECT list(value ORDER BY byte) AS entries FROM crc_steps WHERE step = 8),
measured AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size,
    CAST(xor(list_reduce(
      list_transform(regexp_extract_all(hex(coalesce(text, '')), '..'), lambda b: CAST('0x' || b AS UBIGINT)),
      lambda a, b: xor(a >> 8, entries[CAST(xor(a, b) & 255 AS BIGINT) + 1]), 4294967295::UBIGINT), 4294967295::UBIGINT)
      AS BIGINT) AS text_crc32,
    CAST('0x' || substr(md5(coalesce(lang, '')), 1, 2) AS INTEGER) AS x,
    CAST('0x' || substr(md5(coalesce(source, '')), 1, 2) AS INTEGER) AS y,
    bin(strlen(coalesce(text, '')) + 1) AS digits
  FROM documents, crc_table
),
points AS (
  SELECT row_number() OVER () AS row, *, CAST(least(255, (length(digits) - 1) * 4
    + CASE rpad(substr(digits, 2, 2), 2, '0') WHEN '00' THEN 0 WHEN '01' THEN 1 WHEN '10' THEN 2 ELSE 3 END) AS INTEGER) AS z
  FROM measured
),
walk(row, x, y, z, i, place, enter, axis) AS (
  SELECT row, x, y, z, 7, 0::BIGINT, 0, 0 FROM points
  UNION ALL
  SELECT row, x, y, z, i - 1, place * 8 + w,
    xor(enter, ((e << (axis + 1)) | (e >> (2 - axis))) & 7),
    (axis + [0, 1, 1, 2, 2, 1, 1, 0][w + 1] + 1) % 3
  FROM (
    SELECT *, [0, 0, 0, 3, 3, 6, 6, 5][w + 1] AS e
    FROM (
      SELECT *, [0, 1, 3, 2, 7, 6, 4, 5][(((v >> (axis + 1)) | (v << (2 - axis))) & 7) + 1] AS w
      FROM (SELECT *, xor(((x >> i) & 1) * 4 + ((y >> i) & 1) * 2 + ((z >> i) & 1), enter) AS v FROM walk WHERE i >= 0)
    )
  )
),
placed AS (
  SELECT doc_id, size, text_crc32, place AS curve, count(*) OVER () AS n,
    row_number() OVER (ORDER BY place, size, text_crc32, doc_id NULLS LAST) - 1 AS position
  FROM points JOIN (SELECT row, place FROM walk WHERE i = -1) USING (row)
)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(position * 16 // n AS INTEGER) AS shard,
  position - (position * 16 // n * n + 15) // 16 AS slot, CAST(NULL AS INTEGER) AS grown_shard, curve
FROM placed
"""

_LOWER_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Exact: every window of a document as text.  Near: from each place of a window's rarest word, all words within two places.
ORACLES["op11_phrase_index"] = f"""
WITH doc_words AS (
  SELECT row_number() OVER () AS d, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_LOWER_WORD}') AS words
  FROM documents
),
item_words AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_LOWER_WORD}') AS words
  FROM benchmark
),
windows AS (
  SELECT DISTINCT item, width, begin, array_to_string(words[begin + 1 : begin + width], ' ') AS phrase, words
  FROM (
    SELECT item, words, least(len(words), 10) AS width, unnest(range(greatest(len(words) - 9, 1))) AS begin
    FROM item_words WHERE len(words) > 0
  )
),
occurrences AS (
  SELECT p.d, p.begin, p.width, w.item
  FROM (
    SELECT d, width, begin, array_to_string(words[begin + 1 : begin + width], ' ') AS phrase
    FROM (
      SELECT d, words, width, unnest(range(greatest(len(words) - width + 1, 0))) AS begin
      FROM doc_words, (SELECT DISTINCT width FROM windows)
    )
  ) p JOIN (SELECT DISTINCT item, width, phrase FROM windows) w USING (width, phrase)
),
hits AS (
  SELECT d, count(DISTINCT place) AS n_hit
  FROM (SELECT d, unnest(range(begin, begin + width)) AS place FROM occurrences) GROUP BY d
),
items AS (
  SELECT d, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT d, item FROM occurrences) GROUP BY d
),
places AS (
  SELECT d, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS pos FROM doc_words
),
window_words AS (
  SELECT item, begin, width, place, words[begin + place + 1] AS word
  FROM (SELECT *, unnest(range(width)) AS place FROM windows)
),
anchors AS (
  SELECT item, begin, width, place, word
  FROM window_words LEFT JOIN (SELECT word, count(*) AS n FROM places GROUP BY word) USING (word)
  QUALIFY row_number() OVER (PARTITION BY item, begin ORDER BY n NULLS FIRST, place) = 1
),
candidates AS (
  SELECT a.item, a.begin, a.width, p.d, p.pos - a.place AS start FROM anchors a JOIN places p USING (word)
),
near AS (
  SELECT c.item, c.begin, c.d, c.start
  FROM candidates c JOIN window_words w USING (item, begin) JOIN places p ON p.d = c.d AND p.word = w.word
    AND p.pos BETWEEN c.start + w.place - 2 AND c.start + w.place + 2
  GROUP BY c.item, c.begin, c.d, c.start, c.width HAVING count(DISTINCT w.place) = c.width
),
nearly AS (SELECT d, count(DISTINCT item) AS n_near FROM near GROUP BY d)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near
FROM doc_words LEFT JOIN hits USING (d) LEFT JOIN items USING (d) LEFT JOIN nearly USING (d)
"""

# All scores of all documents that share a word with an item, then the best.
ORACLES["op12_ranked_search"] = f"""
WITH doc_words AS (
  SELECT row_number() OVER () AS d, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_LOWER_WORD}') AS words
  FROM documents
),
totals AS (SELECT count(*) FILTER (len(words) > 0) AS n_docs, CAST(sum(len(words)) AS BIGINT) AS n_words FROM doc_words),
tf AS (SELECT d, word, count(*) AS tf FROM (SELECT d, unnest(words) AS word FROM doc_words) GROUP BY d, word),
weights AS (
  SELECT word, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, totals GROUP BY word, n_docs
),
asked AS (
  SELECT q, item_id, word, count(*) AS times
  FROM (
    SELECT row_number() OVER () AS q, item_id,
      unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_LOWER_WORD}')) AS word
    FROM benchmark
  ) GROUP BY q, item_id, word
),
lengths AS (SELECT d, doc_id, 100 - 25 + ((25 * len(words) * n_docs) // n_words) AS m FROM doc_words, totals WHERE len(words) > 0),
scores AS (
  SELECT q, item_id, doc_id, d, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM asked JOIN tf USING (word) JOIN weights USING (word) JOIN lengths USING (d)
  GROUP BY q, item_id, doc_id, d
)
SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0
WINDOW best AS (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)
QUALIFY row_number() OVER best <= 20
"""
