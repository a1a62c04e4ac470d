"""SQL of the queries of this subpackage that SQL can express."""

ORACLES = {
    "op5_line_dedup": r"""
WITH lines AS (
    SELECT source, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents
), bare AS (
    SELECT source, md5(coalesce(text, '')) AS page,
           trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS line
    FROM lines
), totals AS (
    SELECT source, count(DISTINCT md5(coalesce(text, ''))) AS pages FROM documents GROUP BY source
), often AS (
    SELECT bare.source, line
    FROM bare JOIN totals ON bare.source IS NOT DISTINCT FROM totals.source
    WHERE line <> ''
    GROUP BY bare.source, line, pages
    HAVING count(DISTINCT page) >= 5 AND 100 * count(DISTINCT page) > 10 * pages
), listed AS (
    SELECT source, list(line) AS lines FROM often GROUP BY source
), cleaned AS (
    SELECT doc_id, string_split(text, chr(10)) AS before,
           list_filter(string_split(text, chr(10)), lambda x: NOT list_contains(
               coalesce(lines, []),
               trim(x, ' ' || chr(9) || chr(13) || chr(11) || chr(12)))) AS after
    FROM documents LEFT JOIN listed ON documents.source IS NOT DISTINCT FROM listed.source
)
SELECT doc_id, len(before) AS n_lines, len(before) - len(after) AS n_dropped,
       sha256(array_to_string(after, chr(10))) AS kept_sha256
FROM cleaned
""",
    "op6_url_filters": r"""
WITH captures AS (
    SELECT page_id, DATE '2024-01-01' + CAST(page_id % 365 AS INTEGER) AS fetched_on,
           nullif(regexp_replace(lower(regexp_extract(
               url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '\.$', ''), '')
               AS host
    FROM pages
), keyed AS (
    SELECT host, k, host || '#' || k AS key
    FROM (SELECT DISTINCT host FROM captures WHERE host IS NOT NULL), range(4) AS t(k)
), entries AS (
    SELECT CASE WHEN k < 2 THEN host
                ELSE regexp_replace(host, '^[^.]+\.([^.]+\.)', '\1') END AS pattern,
           DATE '2024-01-01'
               + CAST(CAST('0x' || substr(md5(key), 1, 4) AS INTEGER) % 365 AS INTEGER)
               AS listed_on,
           ['block', 'allow', 'remove'][
               CAST('0x' || substr(md5(key || '!'), 1, 4) AS INTEGER) % 3 + 1] AS action
    FROM keyed
), daily AS (
    SELECT pattern, listed_on, min(action) AS action FROM entries GROUP BY pattern, listed_on
), held AS (
    SELECT pattern, action, listed_on,
           lead(listed_on) OVER (PARTITION BY pattern ORDER BY listed_on) AS next_day
    FROM daily
), deciding AS (
    SELECT page_id, arg_max(pattern, length(pattern)) AS pattern,
           arg_max(action, length(pattern)) AS action
    FROM captures JOIN held
      ON (host = pattern OR ends_with(host, '.' || pattern))
     AND fetched_on >= listed_on AND (next_day IS NULL OR fetched_on < next_day)
    WHERE action <> 'remove'
    GROUP BY page_id
)
SELECT page_id, fetched_on, host, pattern, action,
       coalesce(action = 'block', false) AS blocked
FROM captures LEFT JOIN deciding USING (page_id)
""",
    "op11_filter_audit": r"""
WITH split AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), first AS (
    SELECT text, min(doc_id) AS least FROM split GROUP BY text
), marks AS (
    SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good,
           max(CAST(toxic = 1 AS INTEGER)) AS toxic
    FROM labels GROUP BY doc_id
), judged AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
           (len(words) < 200)::INTEGER
           + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INTEGER
           + 4 * (100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * len(text))::INTEGER
           + 8 * regexp_matches(text, '[#$%&*|]')::INTEGER
           + 16 * (least IS NOT NULL AND (split.doc_id IS NULL OR split.doc_id > least))::INTEGER
               AS bits
    FROM split JOIN first USING (text) LEFT JOIN marks ON split.doc_id = marks.doc_id
), cells AS (
    SELECT part, bits, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
    FROM judged GROUP BY part, bits
), letters(letter, bit) AS (
    VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), orders AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
           [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
    SELECT filter_order, CAST(step AS INTEGER) AS step, bits[step] AS own,
           coalesce(list_sum(bits[1:step - 1]), 0) AS before
    FROM orders, range(1, 6) AS t(step)
), counted AS (
    SELECT part, filter_order, step, own,
           CAST(sum(n) FILTER (cells.bits & CAST(before + own AS INTEGER) = 0) AS BIGINT) AS kept,
           CAST(sum(n) FILTER (cells.bits & own > 0 AND cells.bits & CAST(before AS INTEGER) = 0)
               AS BIGINT) AS removed,
           CAST(sum(n) FILTER (cells.bits & own > 0 AND cells.bits & CAST(before AS INTEGER) > 0)
               AS BIGINT) AS redundant,
           CAST(sum(n) FILTER (cells.bits = own) AS BIGINT) AS unique_fails,
           CAST(sum(good) FILTER (cells.bits & own > 0
               AND cells.bits & CAST(before AS INTEGER) = 0) AS BIGINT) AS good_lost,
           CAST(sum(toxic) FILTER (cells.bits & own > 0
               AND cells.bits & CAST(before AS INTEGER) = 0) AS BIGINT) AS toxic_lost
    FROM cells, steps GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, coalesce(kept, 0) AS kept, coalesce(removed, 0) AS removed,
       coalesce(redundant, 0) AS redundant, coalesce(unique_fails, 0) AS unique_fails,
       coalesce(good_lost, 0) AS good_lost, coalesce(toxic_lost, 0) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, own), 0) AS BIGINT) AS shapley
FROM counted
""",
    "op13_spelling_variants": r"""
WITH RECURSIVE bytes(b, state) AS (
    SELECT b, list_reduce(
               list_prepend(b, range(8)),
               lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)
    FROM range(256) AS t(b)
), steps AS (
    SELECT list(state ORDER BY b) AS states FROM bytes
), runs AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
           unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
    FROM documents
), lowered AS (
    SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run,
           count(*) AS n
    FROM runs GROUP BY ALL
), hexed AS (
    SELECT *, hex(encode(id || ':' || run)) AS code FROM lowered
), checked AS (
    SELECT run, n, xor(4294967295, list_reduce(
               list_prepend(4294967295, list_transform(
                   range(length(code) // 2),
                   lambda k: CAST('0x' || substr(code, 2 * k + 1, 2) AS BIGINT))),
               lambda c, b: xor(states[(xor(c, b) & 255) + 1], c >> 8))) AS h
    FROM hexed, steps
), written AS (
    SELECT CASE WHEN h % 97 = 0
                THEN left(run, h % length(run)) || substr(run, h % length(run) + 2)
                ELSE run END AS word, n
    FROM checked
), words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM written
    WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cut AS (
    SELECT word, n, k, left(word, k) || substr(word, k + 2) AS part
    FROM words, range(length(word)) AS t(k)
), replaced AS (
    SELECT a.word, a.n, b.word AS other, b.n AS other_n
    FROM cut a JOIN cut b ON a.part = b.part AND a.k = b.k AND a.word <> b.word
), deleted AS (
    SELECT cut.word, cut.n, words.word AS other, words.n AS other_n
    FROM cut JOIN words ON cut.part = words.word
), near AS (
    FROM replaced UNION FROM deleted UNION
    SELECT other, other_n, word, n FROM deleted
), best AS (
    SELECT word, count(*) AS n_near, arg_max(other, (other_n, -place)) AS other,
           max(other_n) AS other_n
    FROM (SELECT *, row_number() OVER (ORDER BY other) AS place FROM near)
    GROUP BY word
), formed AS (
    SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
           CASE WHEN other_n >= 2 * words.n THEN other END AS form,
           CASE WHEN other_n >= 2 * words.n THEN other_n END AS form_n
    FROM words LEFT JOIN best USING (word)
), chain AS (
    SELECT word, word AS step, 0 AS hops FROM formed
    UNION ALL
    SELECT chain.word, formed.form, hops + 1
    FROM chain JOIN formed ON chain.step = formed.word WHERE formed.form IS NOT NULL
), roots AS (
    SELECT word, arg_max(step, hops) AS root FROM chain GROUP BY word
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)
""",
}
