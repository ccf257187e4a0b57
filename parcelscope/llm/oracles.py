"""The results that DuckDB can state, written apart from the operators."""

# Every word, pair and triple of words of a piece; all counts, then scores in 128-bit integers.
OP13 = """
WITH texts AS (
    SELECT coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
), pieces AS (
    SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts
), sentences AS (
    SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces
), ones AS (
    SELECT lang, g AS phrase, count(*) AS a FROM (SELECT lang, unnest(w) AS g FROM sentences) GROUP BY ALL
), twos AS (
    SELECT lang, g AS phrase, count(*) AS a
    FROM (SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM sentences)
    GROUP BY ALL HAVING count(*) >= 10
), threes AS (
    SELECT lang, g AS phrase, count(*) AS a
    FROM (SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM sentences)
    GROUP BY ALL HAVING count(*) >= 10
), split2 AS (
    SELECT *, split_part(phrase, ' ', 1) AS w1, split_part(phrase, ' ', 2) AS w2 FROM twos
), split3 AS (
    SELECT *, split_part(phrase, ' ', 1) AS w1, split_part(phrase, ' ', 2) AS w2, split_part(phrase, ' ', 3) AS w3 FROM threes
), scored2 AS (
    SELECT s.lang, s.phrase, s.a, x.a AS l, y.a AS r,
           (1000000::HUGEINT * s.a * s.a) // (x.a::HUGEINT * y.a) AS score
    FROM split2 s JOIN ones x ON x.lang = s.lang AND x.phrase = w1 JOIN ones y ON y.lang = s.lang AND y.phrase = w2
), cuts AS (
    SELECT s.lang, s.phrase, s.a, x1.a AS l1, y1.a AS r1, x2.a AS l2, y2.a AS r2,
           (1000000::HUGEINT * s.a * s.a) // (x1.a::HUGEINT * y1.a) AS s1,
           (1000000::HUGEINT * s.a * s.a) // (x2.a::HUGEINT * y2.a) AS s2
    FROM split3 s
    JOIN ones x1 ON x1.lang = s.lang AND x1.phrase = w1
    JOIN twos y1 ON y1.lang = s.lang AND y1.phrase = w2 || ' ' || w3
    JOIN twos x2 ON x2.lang = s.lang AND x2.phrase = w1 || ' ' || w2
    JOIN ones y2 ON y2.lang = s.lang AND y2.phrase = w3
), longer AS (
    SELECT lang, part, max(a) AS a FROM (
        SELECT lang, w1 || ' ' || w2 AS part, a FROM split3 UNION ALL SELECT lang, w2 || ' ' || w3, a FROM split3
    ) GROUP BY ALL
), kept AS (
    SELECT s.* FROM scored2 s LEFT JOIN longer g ON g.lang = s.lang AND g.part = s.phrase
    WHERE g.a IS NULL OR 100 * g.a < 50 * s.a
    UNION ALL
    SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2) FROM cuts
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT k.lang, k.rank::BIGINT AS rank, k.phrase, k.a::BIGINT AS a, k.l::BIGINT AS l, k.r::BIGINT AS r,
       n.n::BIGINT AS n, k.score::BIGINT AS score
FROM ranked k JOIN (SELECT lang, sum(a) AS n FROM ones GROUP BY lang) n ON n.lang = k.lang
WHERE k.rank <= 2000
"""

# Every window of 35 words as text; words have no space, so that equal texts are equal sequences.
OP4 = """
WITH texts AS (
    SELECT doc_id, row_number() OVER () AS row, coalesce(text, '') AS t FROM documents
), split AS (
    SELECT doc_id, row, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM texts
), starts AS (
    SELECT row, w, unnest(range(1, len(w) - 33)) AS i FROM split
), windows AS (
    SELECT row, i, array_to_string(w[i : i + 34], ' ') AS g FROM starts
), again AS (
    SELECT row, i FROM windows WHERE g IN (SELECT g FROM windows GROUP BY g HAVING count(*) > 1)
), gone AS (
    SELECT DISTINCT row, i + o.k AS i FROM again, (SELECT unnest(range(0, 35)) AS k) o
), words AS (
    SELECT row, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM split
), kept AS (
    SELECT w.row, count(g.i) AS n_removed, coalesce(string_agg(w.word, ' ' ORDER BY w.i) FILTER (WHERE g.i IS NULL), '') AS t
    FROM words w LEFT JOIN gone g ON g.row = w.row AND g.i = w.i GROUP BY w.row
)
SELECT s.doc_id, len(s.w)::BIGINT AS n_words, coalesce(k.n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM split s LEFT JOIN kept k ON k.row = s.row
"""

OP7 = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages
), said AS (
    SELECT *, max(page_id) OVER (PARTITION BY html) AS latest FROM payloads
)
SELECT page_id, n::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> latest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> latest THEN latest END AS refers_to
FROM said
"""

ORACLES: dict[str, str] = {"op4_substring_dedup": OP4, "op7_warc": OP7, "op13_collocations": OP13}
