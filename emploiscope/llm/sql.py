"""DuckDB SQL for the queries that SQL can express. Limits are written out, not imported."""

WHITE = r"[\x20\x09-\x0D]"

LINE_RULES = r"""
WITH words AS (
    SELECT doc_id, coalesce('=' || source, '') AS host, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), numbered AS (
    SELECT row_number() OVER () AS id, * FROM words
), windows AS (
    SELECT id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS window_text,
           unnest(range(1, len(w) - 3)) AS first_word
    FROM numbered
), repeated AS (
    SELECT id, first_word FROM windows QUALIFY count(*) OVER (PARTITION BY id, window_text) > 1
), covered AS (
    SELECT id, count(DISTINCT place) AS n FROM (SELECT id, unnest(range(first_word, first_word + 5)) AS place FROM repeated) GROUP BY id
), lines AS (
    SELECT id, host, text, unnest(list_transform(lines, lambda x: lower(array_to_string(regexp_extract_all(x, '[^\x20\x09-\x0D]+'), ' ')))) AS line,
           unnest(list_transform(lines, lambda x: len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')))) AS n
    FROM numbered
), hosts AS (
    SELECT host, count(DISTINCT text) AS documents FROM numbered GROUP BY host
), over_limits AS (
    SELECT host, line FROM (SELECT host, line, count(DISTINCT text) AS n FROM lines GROUP BY host, line) JOIN hosts USING (host)
    WHERE n > 5 AND n * 100 > documents * 5
), removed AS (
    SELECT id, sum(n) AS n FROM lines JOIN over_limits USING (host, line) GROUP BY id
), measured AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
           CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
           CAST(len(w) - coalesce(removed.n, 0) AS BIGINT) AS n_kept_words
    FROM numbered LEFT JOIN covered USING (id) LEFT JOIN removed USING (id)
), failed AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_kept_words >= 10 AND n_kept_words * 100 >= n_words * 50 AS kept, n_kept_words
FROM failed
"""

DECONTAMINATION = r"""
WITH docs AS (
    SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), items AS (
    SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), item_windows AS (
    SELECT DISTINCT item_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS text
    FROM (SELECT *, least(13, len(w)) AS n FROM items) WHERE n > 0
), sizes AS (
    SELECT DISTINCT n FROM item_windows
), doc_windows AS (
    SELECT id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS text,
           unnest(range(1, len(w) - n + 2)) AS first_word
    FROM docs, sizes WHERE len(w) >= n
), places AS (
    SELECT id, first_word, n, item_id FROM doc_windows JOIN item_windows USING (n, text)
), hit AS (
    SELECT id, count(DISTINCT place) AS n_hit FROM (SELECT id, unnest(range(first_word, first_word + n)) AS place FROM places) GROUP BY id
), listed AS (
    SELECT id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT id, item_id FROM places) GROUP BY id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit USING (id) LEFT JOIN listed USING (id)
"""

JACCARD = r"""
WITH RECURSIVE docs AS (
    SELECT doc_id, string_split_regex(trim(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), E' \t\n\x0b\x0c\r'), '[\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN w = [''] THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
    FROM docs
), shingles AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reached AS (
    SELECT doc_id, doc_id AS other FROM sets UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id
FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) USING (doc_id)
"""

TEMPERATURE_MIX = r"""
WITH RECURSIVE docs AS (
    SELECT doc_id, coalesce('=' || source, '') AS key, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens,
           concat(coalesce(CAST(doc_id AS VARCHAR), ''), '/', md5(coalesce(text, ''))) AS doc_key
    FROM documents
), sources AS (
    SELECT key, CAST(sum(n_tokens) AS BIGINT) AS tokens, count(*) AS documents FROM docs GROUP BY key
), whole AS (
    SELECT list(CAST(tokens AS DOUBLE) ORDER BY key) AS each, CAST(sum(tokens) AS DOUBLE) AS total, CAST(max(tokens) AS DOUBLE) AS largest,
           CAST(min(tokens) AS DOUBLE) AS smallest, count(*) AS n, ln(CAST(sum(tokens) AS DOUBLE)) - sum(tokens * ln(tokens)) / CAST(sum(tokens) AS DOUBLE) AS natural_entropy
    FROM sources WHERE tokens > 0
), by_entropy AS (
    SELECT 0 AS low, 1000000 AS high
    UNION ALL
    SELECT CASE WHEN reached THEN middle ELSE low END, CASE WHEN reached THEN high ELSE middle END
    FROM (
        SELECT low, high, middle,
               ln(list_sum(list_transform(each, lambda x: pow(x / total, middle / 1000000.0))))
               - list_sum(list_transform(each, lambda x: pow(x / total, middle / 1000000.0) * ln(pow(x / total, middle / 1000000.0))))
               / list_sum(list_transform(each, lambda x: pow(x / total, middle / 1000000.0))) >= 0.999 * ln(n) AS reached
        FROM (SELECT low, high, (low + high) // 2 AS middle FROM by_entropy WHERE high - low > 1), whole
    )
), by_repeats AS (
    SELECT 0 AS low, 1000000 AS high
    UNION ALL
    SELECT CASE WHEN too_many THEN middle ELSE low END, CASE WHEN too_many THEN high ELSE middle END
    FROM (
        SELECT low, high, middle, pow(largest / smallest, 1 - middle / 1000000.0) > 1.5 AS too_many
        FROM (SELECT low, high, (low + high) // 2 AS middle FROM by_repeats WHERE high - low > 1), whole
    )
), chosen AS (
    SELECT CASE WHEN n = 1 OR natural_entropy >= 0.999 * ln(n) THEN 1.0
        ELSE greatest((SELECT max(low) FROM by_entropy), CASE WHEN largest / smallest <= 1.5 THEN 0 ELSE (SELECT max(low) FROM by_repeats) + 1 END) / 1000000.0 END AS exponent, largest
    FROM whole
), budgets AS (
    SELECT key, tokens, documents, exponent,
           greatest(tokens, CASE WHEN tokens > 0 THEN CAST(floor(tokens * pow(largest / tokens, 1 - exponent) + 1e-6) AS BIGINT) ELSE 0 END) AS budget
    FROM sources, (SELECT CAST(exponent AS DOUBLE) AS exponent, largest FROM chosen)
), plan AS (
    SELECT *, greatest(1, CAST(ceil(greatest(tokens, documents) / 50000) AS BIGINT)) AS blocks,
           CASE WHEN tokens > 0 THEN CAST(ceil(budget / tokens) AS INTEGER) ELSE 1 END AS passes
    FROM budgets
), housed AS (
    SELECT docs.*, ('0x' || substr(md5(concat('mix/', doc_key)), 1, 8))::BIGINT % blocks AS home FROM docs JOIN plan USING (key)
), filled AS (
    SELECT key, home, sum(n_tokens) AS held FROM housed GROUP BY key, home
), ordered AS (
    SELECT key, home, epoch, exponent, budget - epoch * tokens AS left_over, held,
           ('0x' || substr(md5(concat('mix/block/', key, '/', epoch, '/', home)), 1, 8))::BIGINT AS draw
    FROM (SELECT *, unnest(range(passes)) AS epoch FROM filled JOIN plan USING (key))
), placed AS (
    SELECT key, home, epoch, exponent, row_number() OVER w - 1 AS block,
           left_over - coalesce(sum(held) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
    FROM ordered WINDOW w AS (PARTITION BY key, epoch ORDER BY draw, home)
), used AS (
    SELECT doc_id, key, n_tokens, epoch, block, room, exponent, row_number() OVER w - 1 AS slot,
           coalesce(sum(n_tokens) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS so_far
    FROM housed JOIN placed USING (key, home)
    WINDOW w AS (PARTITION BY key, home, epoch ORDER BY ('0x' || substr(md5(concat('mix/', epoch, '/', doc_key)), 1, 8))::BIGINT, doc_key)
)
SELECT doc_id, CASE WHEN key <> '' THEN substr(key, 2) END AS source, n_tokens, CAST(epoch AS INTEGER) AS epoch, CAST(block AS INTEGER) AS block,
       CAST(slot AS INTEGER) AS slot, exponent
FROM used WHERE epoch = 0 OR (room > 0 AND so_far < room)
"""

SOURCE_DIVERGENCE = r"""
WITH docs AS (
    SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
), terms AS (
    SELECT id, lang, source, unnest(w) AS term FROM docs
), kept AS (
    SELECT lang, term, CAST(count(*) AS HUGEINT) AS total FROM terms GROUP BY lang, term HAVING count(DISTINCT id) >= 3
), langs AS (
    SELECT lang, sum(total) AS n, count(*) AS v FROM kept GROUP BY lang
), sums AS (
    SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM terms JOIN kept USING (lang, term) GROUP BY lang, source, term
), groups AS (
    SELECT lang, source, coalesce(sum(s.n), 0) AS n FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN sums s USING (lang, source) GROUP BY lang, source
), shares AS (
    SELECT g.lang, g.source, k.term, coalesce(s.n, 0) AS n,
           1 + 1000000000 * (coalesce(s.n, 0) + 1) // (g.n + langs.v) AS p,
           1 + 1000000000 * (k.total + 1) // (langs.n + langs.v) AS q
    FROM groups g JOIN langs USING (lang) JOIN kept k USING (lang) LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source AND s.term = k.term
), pairs AS (
    SELECT a.lang, a.source, b.source AS item FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
), compared AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
    SELECT lang, source, 'pair' AS part, item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM pairs LEFT JOIN compared USING (lang, source, item)
    UNION ALL
    SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM found QUALIFY part = 'pair' OR rank <= 200
"""

PREFIX_TRIE = r"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), lists AS (
    SELECT conv_id, list({'role': role, 'text': text} ORDER BY place) AS t FROM turns GROUP BY conv_id
), bits AS (
    SELECT conv_id, list_transform(range(0, 8 * length(CAST(conv_id AS VARCHAR))),
                                   lambda i: (ascii(substr(CAST(conv_id AS VARCHAR), CAST(i // 8 + 1 AS INTEGER), 1)) >> CAST(i % 8 AS INTEGER)) & 1) AS b
    FROM lists
), checked AS (
    SELECT conv_id, xor(list_reduce(list_transform(b, lambda x: CAST(x AS BIGINT)),
                                    lambda c, x: xor(c >> 1, CASE WHEN xor(c, x) & 1 = 1 THEN 3988292384 ELSE 0 END), 4294967295), 4294967295) % 4 AS h
    FROM bits
), rebuilt AS (
    SELECT l.conv_id, list_concat(coalesce(head.t, [])[1:h], l.t[h + 1:]) AS t
    FROM lists l JOIN checked USING (conv_id) LEFT JOIN lists head ON head.conv_id = l.conv_id - l.conv_id % 20
), prefixes AS (
    SELECT conv_id, CAST(d AS BIGINT) AS depth, md5(CAST(t[1:d] AS VARCHAR)) AS key, CASE WHEN d > 0 THEN md5(CAST(t[1:d - 1] AS VARCHAR)) END AS parent_key,
           CASE WHEN d > 0 THEN len(regexp_extract_all(t[d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words, d = len(t) AS is_end
    FROM (SELECT *, unnest(range(0, len(t) + 1)) AS d FROM rebuilt)
), nodes AS (
    SELECT depth, key, parent_key, words, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE is_end), '')) AS ends_sha256
    FROM prefixes GROUP BY depth, key, parent_key, words
), children AS (
    SELECT depth - 1 AS depth, parent_key AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY depth, parent_key
), above AS (
    SELECT n.depth AS low, n.key AS low_key, p.depth AS depth, p.key AS key
    FROM nodes n JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth <= n.depth
), totals AS (
    SELECT a.depth, a.key, CAST(count(*) FILTER (WHERE c.n IS NULL) AS BIGINT) AS n_leaves, CAST(sum((n.n_convs - 1) * n.words) AS BIGINT) AS saved_tokens
    FROM above a JOIN nodes n ON n.depth = a.low AND n.key = a.low_key LEFT JOIN children c ON c.depth = a.low AND c.key = a.low_key
    GROUP BY a.depth, a.key
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
FROM nodes n JOIN totals USING (depth, key) LEFT JOIN children c USING (depth, key) LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.key = n.parent_key
"""
