"""DuckDB statements for the registered queries that SQL can express."""

MIXING = r"""
WITH docs AS (
    SELECT doc_id, source, text,
           CASE WHEN text IS NULL THEN 0
                ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size
    FROM documents
),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
           row_number() OVER (ORDER BY source NULLS LAST) AS k
    FROM docs GROUP BY source
),
-- The level at which a source's share reaches three times its size, and what is left above it.
ordered AS (
    SELECT *, 3 * source_size AS room,
           sum(source_size) OVER ()
             - coalesce(sum(3 * source_size) OVER before, 0) AS rest,
           sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weights,
    FROM sources
    WINDOW before AS (ORDER BY 3 * source_size / weight, k
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
level AS (
    SELECT rest::DOUBLE / weights::DOUBLE AS value, rest, weights FROM ordered
    WHERE rest * weight < room * weights
    ORDER BY 3 * source_size / weight, k LIMIT 1
),
targets AS (
    SELECT source, source_size,
           CASE WHEN (SELECT value FROM level) IS NULL
                  OR (SELECT value FROM level) >= room / weight THEN room::DOUBLE
                ELSE ((SELECT rest FROM level) * weight)::DOUBLE
                     / (SELECT weights FROM level)::DOUBLE END AS target,
           ('0x' || substr(md5('offset:' || coalesce(source, 'null')), 1, 8))::BIGINT::DOUBLE
             / 4294967296.0 AS offset_
    FROM ordered
),
laid AS (
    SELECT d.doc_id, d.size, t.source_size, t.target, t.offset_,
           CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS each,
           row_number() OVER (
               PARTITION BY d.source
               ORDER BY CASE WHEN size = 0 THEN 0
                             ELSE (length(bin(size)) - 1) * 4
                                  + ((size * 4) >> (length(bin(size)) - 1)::INTEGER) END,
                        doc_id, size) AS number
    FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       least((floor(number * each + offset_) - floor((number - 1) * each + offset_))::BIGINT, 3)
         * size AS taken
FROM laid
"""

NEAR_DEDUP = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, coalesce(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+'), []) AS w
    FROM documents
),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN []
        ELSE list_distinct([w[i:i + 4] FOR i IN range(1, greatest(len(w) - 3, 2))]) END AS s
    FROM words
),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
    SELECT a.doc_id AS u, b.doc_id AS v
    FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
),
reach AS (
    SELECT doc_id AS id, doc_id AS other FROM documents
    UNION
    SELECT r.id, l.v FROM reach r JOIN links l ON l.u = r.other
),
least AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, component_id, s.doc_id = component_id AS kept
FROM sets s JOIN least ON s.doc_id = least.id
"""

LINE_DEDUP = r"""
WITH lines AS (
    SELECT doc_id, text, unnest(string_split(text, chr(10))) AS x,
           generate_subscripts(string_split(text, chr(10)), 1) AS line
    FROM documents WHERE text IS NOT NULL
),
counted AS (
    SELECT doc_id, line, x, regexp_matches(x, '[^\x20\x09-\x0D]') AS worded,
           len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) >= 10 AS long
    FROM lines
),
sequences AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS seq FROM counted WHERE worded
),
windows AS (
    SELECT doc_id, seq, 1 AS h, [x] AS w, long AS counts FROM sequences
    UNION ALL
    SELECT doc_id, seq, 2, [x, lead(x) OVER d], long OR lead(long) OVER d FROM sequences
    WINDOW d AS (PARTITION BY doc_id ORDER BY seq)
    UNION ALL
    SELECT doc_id, seq, 3, [x, lead(x) OVER d, lead(x, 2) OVER d], true FROM sequences
    WINDOW d AS (PARTITION BY doc_id ORDER BY seq)
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY w ORDER BY doc_id, seq) > 1 AS later
    FROM windows WHERE w[h] IS NOT NULL
),
covered AS (
    SELECT DISTINCT doc_id, unnest(range(seq, seq + h)) AS seq FROM placed WHERE later AND counts
),
gone AS (SELECT doc_id, line FROM sequences JOIN covered USING (doc_id, seq)),
kept AS (
    SELECT c.doc_id, count(g.line) AS removed,
           string_agg(c.x, chr(10) ORDER BY c.line) FILTER (g.line IS NULL) AS text
    FROM counted c LEFT JOIN gone g ON c.doc_id = g.doc_id AND c.line = g.line
    GROUP BY c.doc_id
)
SELECT d.doc_id, coalesce(removed, 0)::INTEGER AS removed,
       CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(k.text, '')) END AS kept_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

SUBSTRING_DEDUP = r"""
WITH words AS (
    SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35),
windows AS (
    SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS x FROM starts
),
repeated AS (SELECT doc_id, i, count(*) OVER (PARTITION BY x) > 1 AS again FROM windows),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM repeated WHERE again
),
each AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words),
kept AS (
    SELECT e.doc_id, count(g.i) AS n_removed,
           string_agg(e.word, ' ' ORDER BY e.i) FILTER (g.i IS NULL) AS text
    FROM each e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.i = g.i
    GROUP BY e.doc_id
)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON w.doc_id = k.doc_id
"""

RESAMPLING = r"""
WITH steps(k) AS (SELECT unnest(range(256))::UBIGINT),
-- The CRC-32 table: eight shifts of each byte.
shifted AS (
    SELECT k, list_reduce([k, 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], lambda v, zero:
        CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END) AS value
    FROM steps
),
crc AS (SELECT list(value ORDER BY k) AS tab FROM shifted),
texts AS (
    SELECT 's' AS side, doc_id AS id, text FROM documents
    UNION ALL SELECT 't', item_id, text FROM benchmark
),
words AS (
    SELECT side, id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
    FROM texts
),
features AS (SELECT side, id, word, count(*) AS n FROM words GROUP BY ALL),
hexed AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM features)),
placed AS (
    SELECT word, xor(list_reduce(
        list_prepend(4294967295::UBIGINT, list_transform(range(len(h) // 2),
            lambda i: ('0x' || substr(h, 2 * i::INTEGER + 1, 2))::UBIGINT)),
        lambda c, b: xor(tab[(xor(c, b) & 255)::INTEGER + 1], c >> 8)), 4294967295::UBIGINT) % 10000
        AS bucket
    FROM hexed, crc
),
counts AS (
    SELECT bucket, coalesce(sum(n) FILTER (side = 's'), 0)::DOUBLE AS s,
           coalesce(sum(n) FILTER (side = 't'), 0)::DOUBLE AS t
    FROM features JOIN placed USING (word) GROUP BY bucket
),
totals AS (SELECT sum(s) AS s, sum(t) AS t FROM counts),
gains AS (
    SELECT bucket, floor(1000.0::DOUBLE * ln(((c.t + 1) * (a.s + 10000)) / ((c.s + 1) * (a.t + 10000))))::BIGINT AS gain
    FROM counts c, totals a
),
weights AS (
    SELECT id AS doc_id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS total
    FROM features JOIN placed USING (word) JOIN gains USING (bucket)
    WHERE side = 's' GROUP BY id
),
weighed AS (
    SELECT doc_id, coalesce(n_features, 0) AS n_features,
           CASE WHEN n_features IS NULL THEN 0
                ELSE (total - ((total % n_features) + n_features) % n_features) // n_features
           END AS weight,
           ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT AS h
    FROM documents LEFT JOIN weights USING (doc_id)
),
scored AS (
    SELECT doc_id, n_features, weight::BIGINT AS weight,
           weight::BIGINT + floor(-1000.0::DOUBLE * ln(-ln((h::DOUBLE + 0.5) / 4294967296.0::DOUBLE)))::BIGINT AS score
    FROM weighed
),
able AS (
    SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
    FROM scored WHERE n_features >= 20
)
SELECT s.doc_id, s.n_features, s.weight, s.score,
       CASE WHEN place <= n * 10 // 100 THEN place END AS rank
FROM scored s LEFT JOIN able USING (doc_id)
"""
