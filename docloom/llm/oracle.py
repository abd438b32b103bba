"""The queries that SQL can state, over the whole tables.

Patterns, constants and the hash are restated here, so that a slip in an operator shows.
"""

from __future__ import annotations

#: CRC-32 by its table of 256 entries, which SQL computes first; a window of five words is compared as a string.
QUALITY = r"""    WITH crc_bytes AS (
      SELECT list(c ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(i, range(8)),
                 lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) r(i))),
    doc AS (
      SELECT doc_id, coalesce(text, '') AS text,
             list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
             list_filter(string_split(coalesce(text, ''), chr(10)),
                         lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
      FROM documents),
    word AS (
      SELECT doc_id, unnest(words) AS w, unnest(range(len(words))) AS i FROM doc),
    hashed AS (
      SELECT w, xor(list_reduce(
                  list_prepend(4294967295, list_transform(range(1, strlen(w) + 1),
                                                          lambda k: ('0x' || substr(hex(w), 2 * k - 1, 2))::BIGINT)),
                  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
      FROM (SELECT DISTINCT w FROM word), crc_bytes),
    place AS (
      SELECT doc_id, i, h, lead(h) OVER o AS next_h,
             w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o || ' ' || lead(w, 4) OVER o
             AS window_words
      FROM word JOIN hashed USING (w) WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    repeated AS (
      SELECT doc_id, count(DISTINCT i + d) AS n_repeat_words
      FROM (SELECT doc_id, i FROM place WHERE window_words IS NOT NULL
            QUALIFY count(*) OVER (PARTITION BY doc_id, window_words) > 1), range(5) r(d)
      GROUP BY doc_id),
    gram AS (
      SELECT doc_id, h % 10007 AS bucket FROM place
      UNION ALL
      SELECT doc_id, (h * 1000003 + next_h) % 10007 FROM place WHERE next_h IS NOT NULL),
    trusted AS (SELECT DISTINCT doc_id, true AS good FROM labels WHERE quality = 1),
    counts AS (
      SELECT bucket, count(*) AS raw, count(good) AS good FROM gram LEFT JOIN trusted USING (doc_id) GROUP BY bucket),
    sums AS (SELECT sum(raw) + 10007 AS raw, sum(good) + 10007 AS good FROM counts),
    weights AS (
      SELECT bucket, round(1000 * ln((counts.good + 1) * sums.raw / ((counts.raw + 1) * sums.good)))::BIGINT AS weight
      FROM counts, sums),
    scores AS (SELECT doc_id, count(*) AS n_grams, sum(weight)::BIGINT AS score FROM gram JOIN weights USING (bucket) GROUP BY doc_id),
    base AS (
      SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
             length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words,
             coalesce(n_grams, 0) AS n_grams, coalesce(score, 0) AS score
      FROM doc LEFT JOIN repeated USING (doc_id) LEFT JOIN scores USING (doc_id))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, n_grams, score,
           NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND score >= -80 * n_grams AS kept
    FROM base"""

#: Base 32 takes five bits at a time, five hex digits give four characters.
WARC = r"""
    WITH page AS (
      SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex,
             max(page_id) OVER (PARTITION BY coalesce(html, '')) AS keep
      FROM pages)
    SELECT page_id, payload_bytes,
           list_aggregate(list_transform(range(32), lambda i:
             substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                    1 + ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31), 1)),
             'string_agg', '') AS payload_digest,
           CASE WHEN keep = page_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN keep <> page_id THEN keep END AS refers_to
    FROM page"""

#: All pairs that share a window of five words, which links at 0.8 always do.
JACCARD = r"""
    WITH RECURSIVE doc AS (
      SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
      FROM documents),
    gram AS (
      SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) BETWEEN 1 AND 4 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS g
      FROM doc),
    own AS (SELECT doc_id, count(*) AS n, md5(string_agg(g, chr(10) ORDER BY g)) AS text_set FROM gram GROUP BY doc_id),
    pair AS (
      SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
      FROM gram x JOIN gram y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
    link AS (
      SELECT a, b, y.text_set <> x.text_set AS other_text, y.text_set
      FROM pair JOIN own x ON x.doc_id = a JOIN own y ON y.doc_id = b
      WHERE 5 * common >= 4 * (x.n + y.n - common)),
    reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
    class AS (SELECT a, least(a, min(b)) AS class_id FROM reach GROUP BY a),
    total AS (SELECT a, count(*) AS n_links, count(DISTINCT CASE WHEN other_text THEN text_set END) AS n_linked_texts
              FROM link GROUP BY a)
    SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(n_links, 0) AS n_links,
           coalesce(n_linked_texts, 0) AS n_linked_texts, coalesce(class_id, doc_id) = doc_id AS kept
    FROM documents LEFT JOIN class ON class.a = doc_id LEFT JOIN total ON total.a = doc_id"""

#: The digest of the text without white space stands for the text.
EXACT = r"""
    WITH d AS (
      SELECT doc_id, length(coalesce(text, '')) AS points,
             sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
      FROM documents)
    SELECT doc_id,
           first_value(doc_id) OVER w AS keep_id,
           count(*) OVER (PARTITION BY text_sha256) AS group_size,
           doc_id = first_value(doc_id) OVER w AS kept,
           text_sha256
    FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)"""

#: Every window by its words; no anchors.
REPEATS = r"""
    WITH doc AS (
      SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
      FROM documents),
    place AS (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM doc WHERE len(words) >= 50),
    win AS (SELECT doc_id, i, array_to_string(words[i:i + 49], ' ') AS w FROM place),
    least AS (SELECT w, min(doc_id) AS least FROM win GROUP BY w HAVING count(DISTINCT doc_id) > 1),
    gone AS (
      SELECT DISTINCT doc_id, i + k AS i FROM win JOIN least USING (w), range(50) r(k) WHERE doc_id > least),
    word AS (SELECT doc_id, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS i FROM doc),
    left_over AS (
      SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS kept, count(*) AS n
      FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
    SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM doc LEFT JOIN left_over USING (doc_id)"""

#: All phrases are counted at once; no shards.
COLLOCATIONS = r"""
    WITH piece AS (
      SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[.,;:!?\x0A-\x0D]')) AS p
      FROM documents),
    words AS (
      SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda w: w <> '') AS w FROM piece),
    f AS MATERIALIZED (
      SELECT lang, k, phrase, count(*) AS f FROM (
        SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
        FROM words, range(1, 5) r(k) WHERE len(w) >= k)
      GROUP BY ALL),
    total AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
    part AS MATERIALIZED (SELECT lang || chr(31) || phrase AS name, f FROM f WHERE f >= 30),
    candidate AS MATERIALIZED (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS s FROM f WHERE f >= 30 AND k > 1),
    cut AS (
      SELECT c.lang, c.phrase, c.k, c.a, j, h.f AS l, t.f AS r, ((2000000::HUGEINT * c.a) // (h.f + t.f))::BIGINT AS score
      FROM candidate c JOIN range(1, 4) x(j) ON j < c.k
      JOIN part h ON h.name = c.lang || chr(31) || array_to_string(s[1:j], ' ')
      JOIN part t ON t.name = c.lang || chr(31) || array_to_string(s[j + 1:], ' ')
      QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, j) = 1),
    inside AS (
      SELECT lang, array_to_string(s[i:i + m - 1], ' ') AS phrase, max(a) AS longer
      FROM candidate, range(2, 4) y(m), range(1, 4) z(i) WHERE m < k AND i + m - 1 <= k GROUP BY ALL)
    SELECT lang, rank, phrase, a, l, r, n, score FROM (
      SELECT cut.lang, row_number() OVER (PARTITION BY cut.lang ORDER BY score DESC, a DESC, cut.phrase) AS rank,
             cut.phrase, a, l, r, score
      FROM cut LEFT JOIN inside ON inside.lang = cut.lang AND inside.phrase = cut.phrase
      WHERE longer IS NULL OR 100 * longer < 80 * a)
    JOIN total USING (lang) WHERE rank <= 2000"""

#: Products of whole numbers this small are exact as doubles.
NEGATIVES = r"""
    WITH v AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    product AS (
      SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.e, r.e)::BIGINT AS score
      FROM v a JOIN v r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
    positive AS (
      SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM product WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id,
           row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM positive JOIN product USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10"""

ORACLE = {
    "op2_quality_rules": QUALITY,
    "op4_warc_salvage": WARC,
    "op7_ngram_jaccard": JACCARD,
    "op10_exact_dedup": EXACT,
    "op11_substring_dedup": REPEATS,
    "op12_collocations": COLLOCATIONS,
    "op13_hard_negatives": NEGATIVES,
}
