"""DuckDB forms of the training-data queries that SQL can express.

None for the others: tokenizers, sequence packing, shingle joins, unwrapped layers, approximate neighbours and
template windows are tested against brute force or the tokenizer libraries.
"""

_CHAT = r"""
WITH given AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
sized AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
           length(regexp_replace(text, '([<\[])(\\*)(/?(?:s>|INST\]|SYS\]|ROLE\]|TEXT\]))', '\1\2\\\3', 'g'))
           + CASE role WHEN 'user' THEN 13 WHEN 'system' THEN 11 WHEN 'assistant' THEN 7
             ELSE 19 + length(regexp_replace(role, '([<\[])(\\*)(/?(?:s>|INST\]|SYS\]|ROLE\]|TEXT\]))', '\1\2\\\3', 'g')) END AS chars
    FROM given
),
placed AS (
    SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY n) AS upto,
           n = max(n) OVER (PARTITION BY conv_id) AS last
    FROM sized
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (role = 'assistant' OR last) AS BIGINT) AS formatted_chars,
       count(*) FILTER (role = 'assistant' OR last) AS n_examples
FROM placed GROUP BY conv_id"""

_WARC = """
WITH sized AS (
    SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
),
grouped AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS first FROM sized)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           (((CAST('0x' || substr(h, CAST(5 * (i // 4) + 1 AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) + 1), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM grouped"""

_QUALITY = r"""
WITH split AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           string_split(coalesce(text, ''), chr(10)) AS lines
    FROM documents
),
windows AS (
    SELECT doc_id, i, array_to_string(list_slice(words, i, i + 7), ' ') AS g
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM split)
),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id),
base AS (
    SELECT doc_id, text, len(lines) AS n_lines, CAST(len(words) AS BIGINT) AS n_words,
           CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(list_filter(lines, lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')))
                - len(list_distinct(list_filter(lines, lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')))) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
    FROM split LEFT JOIN covered USING (doc_id)
),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR n_symbols * 10 > n_words OR (n_dup_lines >= 5 AND n_dup_lines * 2 > n_lines)
            OR word_chars < n_words * 2 OR word_chars > n_words * 20
            OR length(regexp_replace(text, '[^!]', '', 'g')) * 10 > n_words * 3
            OR length(regexp_replace(text, '\P{Lu}', '', 'g')) * 2 > length(text)) AS kept
FROM judged"""

_SEARCH = r"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
    FROM documents WHERE text IS NOT NULL
),
items AS (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)
),
asked AS (SELECT item_id, term, count(*) AS q FROM items GROUP BY ALL),
corpus AS (SELECT count(*) AS n_docs, sum(len(t)) AS total FROM docs WHERE len(t) > 0),
counts AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM docs)
           WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counts, corpus GROUP BY term, n_docs),
scores AS (
    SELECT item_id, doc_id,
           CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + CAST((75 * n * n_docs) // total AS BIGINT))))) AS BIGINT) AS score
    FROM counts JOIN weights USING (term) JOIN asked USING (term), corpus GROUP BY item_id, doc_id
),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""

_AUDIT = r"""
WITH told AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
marked AS (
    SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
           CAST(len(w) < 200 AS INTEGER) + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INTEGER)
           + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS INTEGER)
           + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INTEGER)
           + 16 * CAST(doc_id > min(doc_id) OVER (PARTITION BY t) AS INTEGER) AS mask
    FROM texts LEFT JOIN told USING (doc_id)
),
counted AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM marked GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
    SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
    WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
),
steps AS (SELECT filter_order, CAST(unnest(range(1, 6)) AS INTEGER) AS step FROM orders),
placed AS (
    SELECT filter_order, step, bit, (SELECT sum(l.bit) FROM letters l WHERE strpos(filter_order, l.f) < step) AS before
    FROM steps JOIN letters ON f = substr(filter_order, step, 1)
),
figures AS (
    SELECT part, filter_order, step, bit,
           coalesce(sum(n) FILTER (mask & (coalesce(before, 0) | bit) = 0), 0) AS kept,
           coalesce(sum(n) FILTER (mask & bit > 0 AND mask & coalesce(before, 0) = 0), 0) AS removed,
           coalesce(sum(n) FILTER (mask & bit > 0 AND mask & coalesce(before, 0) > 0), 0) AS redundant,
           coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
           coalesce(sum(g) FILTER (mask & bit > 0 AND mask & coalesce(before, 0) = 0), 0) AS good_lost,
           coalesce(sum(x) FILTER (mask & bit > 0 AND mask & coalesce(before, 0) = 0), 0) AS toxic_lost
    FROM counted, placed GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM figures"""

_NEAR = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + least(5, len(w)) - 1), ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS in_both FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * in_both >= 85 * (p.n + q.n - in_both)),
reached(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT doc_id, y FROM reached JOIN links ON x = other),
classes AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN sizes USING (doc_id) JOIN classes USING (doc_id)"""

ORACLES: dict[str, str] = {"op1_chat_format": _CHAT, "op6_warc": _WARC, "op7_quality_rules": _QUALITY, "op11_lexical_search": _SEARCH,
                           "op12_filter_audit": _AUDIT, "op13_near_dedup": _NEAR}
