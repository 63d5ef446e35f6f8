"""DuckDB SQL of the training-data queries, where SQL can express them on whole tables."""

SQL = {}

SQL["op5_chat_prefix"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, 17 + length(regexp_replace(role, '([<\[])(\\*/?(?:s>|INST\]))', '\1\\\2', 'g'))
            + length(regexp_replace(text, '([<\[])(\\*/?(?:s>|INST\]))', '\1\\\2', 'g')) AS len,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
         count(*) OVER (PARTITION BY conv_id) AS n
  FROM turns
), prefixed AS (
  SELECT *, sum(len) OVER (PARTITION BY conv_id ORDER BY k) AS prefix FROM sized
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (sum(3 + prefix) FILTER (role = 'assistant' OR k = n))::BIGINT AS formatted_chars
FROM prefixed GROUP BY conv_id
"""

# Word windows are compared as joined text; words cannot hold the separator.
SQL["op6_winnowing"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT coalesce(item_id::VARCHAR, 'null') AS item, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS gram
  FROM b, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS t(i) WHERE len(w) > 0
), lengths AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM d, lengths, unnest(range(1, len(w) - n + 2)) AS t(i) WHERE len(w) >= n
), hits AS (SELECT DISTINCT doc_id, n, i, item FROM dw JOIN bw USING (n, gram)),
counts AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
          FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN counts USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# Five hexadecimal digits are four base-32 digits.
SQL["op1_warc_zip"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
named AS (
  SELECT *, array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER, 1)), '') AS digest
  FROM p
), best AS (SELECT html, max(page_id) AS response FROM p GROUP BY html)
SELECT page_id, octet_length(encode(html)) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> response THEN response END AS refers_to
FROM named JOIN best USING (html)
"""

# Terms of all documents that no item asks for only count in the lengths.
SQL["op13_ball_tree"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), s AS (SELECT count(*) FILTER (len(w) > 0) AS nd, sum(len(w))::BIGINT AS total FROM d),
q AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT DISTINCT item_id, text FROM benchmark))
  GROUP BY item_id, term
), p AS (
  SELECT doc_id, term, count(*) AS tf, any_value(n) AS n FROM (SELECT doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM p, s GROUP BY term, nd
), scores AS (
  SELECT item_id, doc_id,
         sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nd) // total))))::BIGINT AS score
  FROM p JOIN weights USING (term) JOIN q USING (term), s GROUP BY item_id, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""
