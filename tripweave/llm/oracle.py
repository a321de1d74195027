"""The named queries in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

ORACLE = {
    "op5_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op8_near_dedup": r"""
        WITH RECURSIVE split AS (
          SELECT doc_id, list_filter(
                   string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
          FROM documents
        ),
        sets AS (
          SELECT doc_id, list_distinct(
                   CASE WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
                        ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) END
                 ) AS shingles
          FROM split WHERE len(words) > 0
        ),
        shingled AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS s FROM sets),
        links AS (
          SELECT a.doc_id AS a, b.doc_id AS b
          FROM shingled a JOIN shingled b ON a.s = b.s AND a.doc_id <> b.doc_id
          GROUP BY a.doc_id, b.doc_id, a.n, b.n
          HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
        ),
        reach AS (
          SELECT DISTINCT a AS doc_id, a AS other FROM links
          UNION
          SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
        ),
        least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
        SELECT d.doc_id, coalesce(len(s.shingles), 0) AS n_shingles,
               coalesce(l.component_id, d.doc_id) AS component_id,
               coalesce(l.component_id, d.doc_id) = d.doc_id AS kept
        FROM documents d LEFT JOIN sets s USING (doc_id) LEFT JOIN least l USING (doc_id)
    """,
    "op12_phrases": r"""
        WITH pieces AS (
          SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[.,;:!?\x0A-\x0D]')) AS piece
          FROM documents
        ),
        worded AS (
          SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS words
          FROM pieces
        ),
        totals AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM worded GROUP BY lang),
        grams AS (
          SELECT lang, size, unnest(list_transform(
                   range(1, len(words) - size + 2), lambda i: array_to_string(words[i:i + size - 1], ' '))) AS phrase
          FROM worded, (SELECT unnest([1, 2, 3, 4, 5]) AS size) WHERE len(words) >= size
        ),
        counts AS (
          SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100
        ),
        often AS (SELECT *, string_split(phrase, ' ') AS words FROM counts WHERE size > 1),
        cuts AS (
          SELECT lang, phrase, f AS a, k, array_to_string(words[1:k], ' ') AS first_part,
                 array_to_string(words[k + 1:], ' ') AS rest
          FROM (SELECT *, unnest(range(1, size)) AS k FROM often)
        ),
        scored AS (
          SELECT c.*, x.f AS l, y.f AS r, n,
                 CAST(CAST(1000 AS HUGEINT) * a * n // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
          FROM cuts c JOIN counts x ON c.lang = x.lang AND c.first_part = x.phrase
          JOIN counts y ON c.lang = y.lang AND c.rest = y.phrase JOIN totals t ON c.lang = t.lang
        ),
        lowest AS (
          SELECT * FROM scored
          QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ),
        inner_phrases AS (
          SELECT lang, array_to_string(words[i:i + m - 1], ' ') AS phrase, max(f) AS f
          FROM (SELECT *, unnest(range(1, size - m + 2)) AS i
                FROM (SELECT *, unnest(range(2, size)) AS m FROM often WHERE size > 2))
          GROUP BY ALL
        ),
        ranked AS (
          SELECT c.lang, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, a DESC, c.phrase) AS rank,
                 c.phrase, a, l, r, n, score
          FROM lowest c LEFT JOIN inner_phrases i ON c.lang = i.lang AND c.phrase = i.phrase
          WHERE i.f IS NULL OR 100 * i.f < 100 * a
        )
        SELECT * FROM ranked WHERE rank <= 2000
    """,
}
