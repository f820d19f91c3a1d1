"""DuckDB SQL for the rows of the named queries, where SQL can state them."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op9_url_filters"] = r"""
WITH rules(rule_host, rule_path, rule_verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
           ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), parts AS (
    SELECT page_id, row_number() OVER () AS row_id,
           CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), cut AS (
    SELECT page_id, row_id,
           translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM parts
), fits AS (
    SELECT c.*, r.*, row_number() OVER (
               PARTITION BY c.row_id ORDER BY length(rule_host) + length(rule_path) DESC NULLS LAST,
               length(rule_host) DESC) AS place
    FROM cut AS c LEFT JOIN rules AS r
      ON (c.host = r.rule_host OR ends_with(c.host, '.' || r.rule_host))
     AND starts_with(c.path, r.rule_path)
)
SELECT page_id, host, path, rule_host || rule_path AS rule,
       coalesce(rule_verdict, 'allow') AS verdict
FROM fits WHERE place = 1
"""

ORACLE["op3_warc"] = """
WITH coded AS (
    SELECT page_id, sha1(coalesce(html, '')) AS payload_digest,
           octet_length(encode(coalesce(html, ''))) AS payload_bytes
    FROM pages
), groups AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS keeper
    FROM coded
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM keeper THEN 'revisit'
            ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM keeper THEN keeper
       END AS refers_to
FROM groups
"""

# Seed 7, blocks of 65,536 words, shards of 16 blocks, six passes that fill a
# source's last block.
_FILL = """
), room{this} AS (
    SELECT *, "left" - sum(CASE WHEN fits THEN size ELSE 0 END) OVER (PARTITION BY place) AS room
    FROM fit{last}
), sum{this} AS (
    SELECT *, NOT fits AND size <= room AS small,
           sum(CASE WHEN NOT fits AND size <= room THEN size ELSE 0 END) OVER (
               PARTITION BY place ORDER BY size DESC, key) AS total
    FROM room{this}
), fit{this} AS (
    SELECT place, key, size, "left", fits OR (small AND total <= room) AS fits FROM sum{this}"""

ORACLE["op1_source_mixing"] = (
    r"""
WITH units AS (
    SELECT doc_id, source,
           md5('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(md5(text), 'null')) AS key,
           CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
    FROM documents
), sizes AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM units GROUP BY source
), weighed AS (
    SELECT *, place % 3 + 1 AS weight
    FROM (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sizes)
), levels AS (
    SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
                  ORDER BY source_size / weight, place
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / CAST(sum(weight) OVER (ORDER BY source_size / weight, place
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
    FROM weighed
), targets AS (
    SELECT source, source_size, place,
           coalesce(least(3.0 * source_size, weight * CAST((
               SELECT level FROM levels WHERE 3 * source_size >= weight * level
               ORDER BY source_size / weight, place LIMIT 1) AS DOUBLE)), 3.0 * source_size) AS target
    FROM weighed
), goals AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS full_passes,
           greatest(1, CAST(ceil(source_size / 65536) AS BIGINT)) AS blocks
    FROM targets
), placed AS (
    SELECT u.doc_id, u.key, u.size, g.place, g.source_size, g.target, g.full_passes,
           CAST(round(g.target) AS BIGINT) - full_passes * g.source_size AS rest,
           CAST('0x' || substr(u.key, 25, 8) AS BIGINT) % g.blocks AS block
    FROM units AS u JOIN goals AS g ON u.source IS NOT DISTINCT FROM g.source
), blocks AS (
    SELECT place, block, full_passes, rest, sum(size) AS words,
           md5('7:' || place || ':' || block) AS block_key
    FROM placed GROUP BY place, block, full_passes, rest
), room AS (
    SELECT *, rest - coalesce(sum(words) OVER (PARTITION BY place ORDER BY block_key
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS "left"
    FROM blocks
), drawn AS (
    SELECT *, rest > 0 AND words <= "left" AS whole,
           NOT (rest > 0 AND words <= "left") AND "left" > 0 AS last_block
    FROM room
), tickets AS (
    SELECT place, block, copy, md5('7:' || place || ':' || block || ':' || copy) AS ticket,
           md5('7:' || place || ':' || block || ':' || copy || ':draw') AS draw
    FROM (SELECT place, block, unnest(range(1, full_passes + (whole OR last_block)::INT + 1)) AS copy
          FROM drawn)
), noded AS (
    SELECT place, (row_number() OVER (ORDER BY ticket) - 1)
           * CAST(power(2, ceil(log2(greatest(1, ceil(count(*) OVER () / 16))))) AS BIGINT)
           // count(*) OVER () AS node
    FROM tickets
), slots AS (
    SELECT place, node, row_number() OVER (PARTITION BY place ORDER BY node) AS slot FROM noded
), dealt AS (
    SELECT t.place, block, list(node ORDER BY copy) AS shards
    FROM (SELECT *, row_number() OVER (PARTITION BY place ORDER BY draw) AS slot FROM tickets) AS t
    JOIN slots AS s ON s.place = t.place AND s.slot = t.slot
    GROUP BY t.place, block
), fit0 AS (
    SELECT p.place, p.key, p.size, d."left",
           sum(p.size) OVER (PARTITION BY p.place ORDER BY p.key) <= d."left" AS fits
    FROM placed AS p JOIN drawn AS d ON p.place = d.place AND p.block = d.block
    WHERE d.last_block AND p.size > 0"""
    + "".join(_FILL.format(last=k, this=k + 1) for k in range(6))
    + """
), settled AS (
    SELECT DISTINCT place, key FROM fit6 WHERE fits
), counted AS (
    SELECT p.*, d.full_passes + (d.whole OR s.key IS NOT NULL)::INT AS copies, t.shards
    FROM placed AS p
    JOIN drawn AS d ON p.place = d.place AND p.block = d.block
    LEFT JOIN dealt AS t ON p.place = t.place AND p.block = t.block
    LEFT JOIN settled AS s ON p.place = s.place AND p.key = s.key
)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken,
       CAST(copies AS INT) AS copies,
       coalesce(array_to_string(list_slice(shards, 1, copies), ','), '') AS shards
FROM counted
"""
)

_WORDS = r"""
words AS (
    SELECT row_number() OVER () AS row_id, doc_id,
           regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
)"""
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Fixed value: windows of 35 words.
ORACLE["op8_substring_dedup"] = f"""
WITH {_WORDS.format(text="text")}, windows AS (
    SELECT row_id, unnest(range(1, len(words) - 33)) AS start,
           unnest([array_to_string(words[i : i + 34], ' ') FOR i IN range(1, len(words) - 33)]) AS content
    FROM words WHERE len(words) >= 35
), repeated AS (
    SELECT row_id, start FROM windows QUALIFY count(*) OVER (PARTITION BY content) > 1
), places AS (
    SELECT row_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM words
), judged AS (
    SELECT p.row_id, word, place, start IS NOT NULL AND place < start + 35 AS goes
    FROM places AS p ASOF LEFT JOIN repeated AS r ON p.row_id = r.row_id AND p.place >= r.start
), left_over AS (
    SELECT row_id, count(*) FILTER (WHERE goes) AS n_removed,
           string_agg(word, ' ' ORDER BY place) FILTER (WHERE NOT goes) AS kept
    FROM judged GROUP BY row_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN left_over USING (row_id)
"""

# Shingles of four words, a similarity of 85 percent.
ORACLE["op12_ngram_jaccard"] = f"""
WITH RECURSIVE {_WORDS.format(text=_LOWER)}, sets AS (
    SELECT row_id, doc_id, CASE
        WHEN len(words) = 0 THEN []
        WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
        ELSE list_distinct([array_to_string(words[i : i + 3], ' ') FOR i IN range(1, len(words) - 2)])
    END AS shingles
    FROM words
), each AS (
    SELECT row_id, len(shingles) AS size, unnest(shingles) AS shingle FROM sets
), met AS (
    SELECT a.row_id AS a, b.row_id AS b, a.size AS size_a, b.size AS size_b, count(*) AS shared
    FROM each AS a JOIN each AS b ON a.shingle = b.shingle AND a.row_id < b.row_id
    GROUP BY ALL
), links AS (
    SELECT a, b FROM met WHERE 100 * shared >= 85 * (size_a + size_b - shared)
    UNION ALL
    SELECT b, a FROM met WHERE 100 * shared >= 85 * (size_a + size_b - shared)
), reached AS (
    SELECT row_id AS a, row_id AS b FROM sets
    UNION
    SELECT r.a, l.b FROM reached AS r JOIN links AS l ON l.a = r.b
), least AS (
    SELECT r.a AS row_id, min(s.doc_id) AS component_id
    FROM reached AS r JOIN sets AS s ON s.row_id = r.b GROUP BY r.a
)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id
FROM sets JOIN least USING (row_id)
"""

# The polynomial of CRC-32; runs of letters; one damaged run in 199; words of six
# letters that occur five times; forms five times as frequent. A letter from U+00C0 to U+00FF
# has two bytes in UTF-8, the first of which is 195.
_CRC = """
crc_table AS (
    SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
        lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))) AS steps
)"""
ORACLE["op11_spelling_variants"] = f"""
WITH RECURSIVE {_CRC}, found AS (
    SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents
), counted AS (
    SELECT doc_id, run, count(*) AS times FROM found GROUP BY ALL
), coded AS (
    SELECT run, times, xor(list_reduce(
        list_prepend(4294967295, flatten([CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [195, unicode(c) - 64] END
                                          FOR c IN string_split(doc_id || ':' || run, '')])),
        lambda crc, b: xor(crc >> 8, steps[(xor(crc, b) & 255) + 1])), 4294967295) AS h
    FROM counted, crc_table
), spelt AS (
    SELECT times, CASE WHEN h % 199 = 0
        THEN left(run, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2)
        ELSE run END AS word
    FROM coded
), vocabulary AS (
    SELECT word, CAST(sum(times) AS BIGINT) AS n FROM spelt GROUP BY word HAVING length(word) >= 6 AND sum(times) >= 5
), gaps AS (
    SELECT word, n, unnest([left(word, i) || '*' || substr(word, i + 2) FOR i IN range(0, length(word))]) AS with_gap
    FROM vocabulary
), pairs AS (
    SELECT a.word, b.word AS near FROM gaps AS a JOIN gaps AS b USING (with_gap) WHERE a.word <> b.word
    UNION
    SELECT g.word, v.word FROM gaps AS g JOIN vocabulary AS v ON replace(g.with_gap, '*', '') = v.word
    UNION
    SELECT v.word, g.word FROM gaps AS g JOIN vocabulary AS v ON replace(g.with_gap, '*', '') = v.word
), best AS (
    SELECT p.word, count(*) AS n_near, first(near ORDER BY v.n DESC, near COLLATE C) AS near, max(v.n) AS near_n
    FROM pairs AS p JOIN vocabulary AS v ON v.word = p.near GROUP BY p.word
), forms AS (
    SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
           CASE WHEN near_n >= 5 * v.n THEN near END AS form, CASE WHEN near_n >= 5 * v.n THEN near_n END AS form_n
    FROM vocabulary AS v LEFT JOIN best AS b USING (word)
), chains AS (
    SELECT word, word AS root, form AS onward FROM forms
    UNION ALL
    SELECT c.word, c.onward, f.form FROM chains AS c JOIN forms AS f ON f.word = c.onward
)
SELECT f.word, form, root, n, n_near, form_n
FROM forms AS f JOIN chains AS c ON c.word = f.word AND c.onward IS NULL
"""

# One text in ten is planted; runs of six words and four periods.
ORACLE["op13_periodic_runs"] = f"""
WITH {_CRC}, {_WORDS.format(text="text")}, coded AS (
    SELECT row_id, doc_id, words, len(words) AS n, xor(list_reduce(
        list_prepend(4294967295, [unicode(c) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
        lambda crc, b: xor(crc >> 8, steps[(xor(crc, b) & 255) + 1])), 4294967295) AS h
    FROM words, crc_table
), chosen AS (
    SELECT *, h % 10 = 0 AND n > 0 AS planted, CASE WHEN n > 0 THEN (h // 10) % n END AS a FROM coded
), sized AS (
    SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM chosen
), texts AS (
    SELECT row_id, doc_id, n, CASE WHEN planted
        THEN [words[CAST(CASE WHEN i < a THEN i ELSE a + (i - a) % p END AS INT) + 1] FOR i IN range(0, n)]
        ELSE words END AS words
    FROM sized
), places AS (
    SELECT row_id, n, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS place FROM texts
), three AS (
    SELECT row_id, n, place, word || ' ' || lead(word) OVER w || ' ' || lead(word, 2) OVER w AS content
    FROM places WINDOW w AS (PARTITION BY row_id ORDER BY place)
), equal AS (
    SELECT a.row_id, a.place, b.place - a.place AS period
    FROM three AS a JOIN three AS b ON a.row_id = b.row_id AND a.content = b.content
        AND b.place > a.place AND 4 * (b.place - a.place) <= a.n
), stretches AS (
    SELECT *, place - row_number() OVER (PARTITION BY row_id, period ORDER BY place) AS stretch FROM equal
), periodic AS (
    SELECT row_id, period, min(place) AS start, count(*) + 2 + period AS length
    FROM stretches GROUP BY row_id, period, stretch
    HAVING count(*) + 2 + period >= greatest(6, 4 * period)
), runs AS (
    SELECT * FROM periodic AS r WHERE NOT EXISTS (
        SELECT 1 FROM periodic AS s WHERE s.row_id = r.row_id AND s.period < r.period
            AND s.start <= r.start AND s.start + s.length >= r.start + r.length)
), told AS (
    SELECT row_id, count(*) AS n_runs,
           string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed,
           first(struct_pack(s := start, l := length, p := period)
                 ORDER BY length / CAST(period AS DOUBLE) DESC, start, period) AS best
    FROM runs GROUP BY row_id
), gone AS (
    SELECT DISTINCT row_id, unnest(range(start + period, start + length)) AS place FROM runs
), left_over AS (
    SELECT row_id, string_agg(word, ' ' ORDER BY place) AS kept
    FROM places ANTI JOIN gone USING (row_id, place) GROUP BY row_id
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.p AS period,
       1000 * best.l // best.p AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM texts LEFT JOIN told USING (row_id) LEFT JOIN left_over USING (row_id)
"""

# At least 50 words, half of them at most in repeated windows of three; runs of
# ten words or more cover 40 percent at most, and the longest is 20 percent at most.
ORACLE["op7_quality_rules"] = rf"""
WITH {_WORDS.format(text="text")}, places AS (
    SELECT row_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM words
), grams AS (
    SELECT row_id, place, word, word || ' ' || lead(word) OVER w AS two,
           word || ' ' || lead(word) OVER w || ' ' || lead(word, 2) OVER w AS three
    FROM places WINDOW w AS (PARTITION BY row_id ORDER BY place)
), twice AS (
    SELECT row_id, count(*) - count(DISTINCT word) > 0 AS of_one,
           count(two) - count(DISTINCT two) > 0 AS of_two
    FROM grams GROUP BY row_id
), tens AS (
    SELECT row_id, unnest(range(1, len(words) - 8)) AS start,
           unnest([array_to_string(words[i : i + 9], ' ') FOR i IN range(1, len(words) - 8)]) AS content
    FROM words WHERE len(words) >= 10
), repeated AS (
    SELECT row_id, start, 10 AS size FROM tens QUALIFY count(*) OVER (PARTITION BY row_id, content) > 1
    UNION ALL
    SELECT row_id, place, 3 FROM grams WHERE three IS NOT NULL
    QUALIFY count(*) OVER (PARTITION BY row_id, three) > 1
), covered AS (
    SELECT row_id, count(DISTINCT place) FILTER (WHERE size = 3) AS n_repeat_words,
           count(DISTINCT place) FILTER (WHERE size = 10) AS n_covered
    FROM (SELECT row_id, size, unnest(range(start, start + size)) AS place FROM repeated) GROUP BY row_id
), equal AS (
    SELECT a.row_id, a.place, b.place - a.place AS apart
    FROM grams AS a JOIN grams AS b ON a.row_id = b.row_id AND a.three = b.three AND b.place > a.place
), longest AS (
    SELECT row_id, max(size) AS size FROM (
        SELECT row_id, count(*) + 2 AS size FROM (
            SELECT *, place - row_number() OVER (PARTITION BY row_id, apart ORDER BY place) AS stretch FROM equal
        ) GROUP BY row_id, apart, stretch
    ) GROUP BY row_id
), lines AS (
    SELECT row_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM (
        SELECT row_number() OVER () AS row_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents
    ) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row_id
), symbols AS (
    SELECT row_number() OVER () AS row_id, length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols
    FROM documents
), figures AS (
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
           CAST(n_symbols AS BIGINT) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_covered, 0) AS n_covered,
           CAST(coalesce(size, CASE WHEN of_two THEN 2 WHEN of_one THEN 1 ELSE 0 END, 0) AS BIGINT) AS longest_repeat
    FROM words LEFT JOIN twice USING (row_id) LEFT JOIN covered USING (row_id) LEFT JOIN longest USING (row_id)
        LEFT JOIN lines USING (row_id) LEFT JOIN symbols USING (row_id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND NOT n_covered > CAST(0.4 AS DOUBLE) * n_words
       AND NOT (longest_repeat >= 10 AND longest_repeat > CAST(0.2 AS DOUBLE) * n_words) AS kept
FROM figures
"""

# Fixed value: lines of five words or more go for one word's difference, shorter ones if equal.
ORACLE["op5_line_dedup"] = r"""
WITH split AS (
    SELECT row_number() OVER () AS row_id, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
    SELECT row_id, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) - 1 AS number FROM split
), filled AS (
    SELECT row_id, number, words, array_to_string(words, ' ') AS content,
           row_number() OVER (ORDER BY doc_id NULLS LAST, number) AS place
    FROM (SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS words FROM lines) WHERE len(words) > 0
), firsts AS (
    SELECT content, any_value(words) AS words, min(place) AS first FROM filled GROUP BY content
), shortened AS (
    SELECT content, first, unnest(range(1, len(words) + 1)) AS place_cut,
           unnest([array_to_string(list_concat(words[1 : k - 1], words[k + 1 : len(words)]), ' ')
                   FOR k IN range(1, len(words) + 1)]) AS rest
    FROM firsts WHERE len(words) >= 5
), near AS (
    SELECT content FROM shortened QUALIFY first > min(first) OVER (PARTITION BY rest, place_cut)
    UNION
    SELECT s.content FROM shortened AS s JOIN firsts AS f ON f.content = s.rest AND len(f.words) >= 5 AND f.first < s.first
    UNION
    SELECT f.content FROM shortened AS s JOIN firsts AS f ON f.content = s.rest AND len(f.words) >= 5 AND s.first < f.first
), gone AS (
    SELECT row_id, number FROM filled AS l JOIN firsts AS f USING (content)
    WHERE l.place > f.first OR content IN (SELECT content FROM near)
), told AS (
    SELECT row_id, count(*) AS n_removed, string_agg(CAST(number AS VARCHAR), ',' ORDER BY number) AS removed_lines
    FROM gone GROUP BY row_id
), sizes AS (
    SELECT row_id, count(*) AS n_lines FROM filled GROUP BY row_id
)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       coalesce(removed_lines, '') AS removed_lines
FROM split LEFT JOIN sizes USING (row_id) LEFT JOIN told USING (row_id)
"""
