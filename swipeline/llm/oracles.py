"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

LOWERED = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

WORDS = r"regexp_extract_all(" + LOWERED + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = {
    "op1_wu_manber": f"""
        WITH item_words AS (SELECT item_id::varchar AS item, {WORDS} AS w FROM benchmark),
        sized AS (SELECT item, w, least(10, len(w)) AS n FROM item_words WHERE len(w) > 0),
        windows AS (
            SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS t
            FROM sized, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i)),
        texts AS (SELECT doc_id, {WORDS} AS w FROM documents),
        places AS (
            SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS t
            FROM (SELECT DISTINCT n FROM windows), texts,
                 LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i)),
        found AS (SELECT doc_id, i, n, item FROM places JOIN windows USING (n, t)),
        hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit
                FROM found, LATERAL (SELECT unnest(range(i, i + n)) AS k) GROUP BY doc_id),
        items AS (SELECT doc_id, count(DISTINCT item) AS n_items,
                         string_agg(DISTINCT item, ',' ORDER BY item) AS ids
                  FROM found GROUP BY doc_id)
        SELECT doc_id, len(w)::bigint AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM texts LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op7_log_templates": r"""
        WITH texts AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
        lines AS (
            SELECT doc_id, text, i - 1 AS number, string_split(line, ' ') AS w, line
            FROM (SELECT doc_id, text, unnest(range(1, len(ls) + 1)) AS i,
                         trim(ls[i], ' ') AS line FROM texts)
            WHERE line <> ''),
        leaves AS (
            SELECT *, len(w) || ' ' || array_to_string(list_transform(
                w[1:3], lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END), ' ') AS leaf
            FROM lines),
        candidates AS (
            SELECT * FROM leaves
            WHERE leaf IN (SELECT leaf FROM leaves GROUP BY leaf HAVING count(DISTINCT text) >= 5)),
        tokens AS (
            SELECT leaf, line, n, place,
                   CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END AS token
            FROM (SELECT leaf, line, count(*) AS n, unnest(range(1, len(string_split(line, ' ')) + 1)) AS place,
                         string_split(line, ' ')[place] AS t
                  FROM candidates GROUP BY leaf, line)),
        constant AS (
            SELECT leaf, place, token FROM tokens GROUP BY ALL HAVING sum(n) >= 5 AND token <> '<*>'),
        fields AS (
            SELECT leaf, line, avg((c.token IS NOT NULL)::int) < 0.5 AS verbatim,
                   CASE WHEN verbatim THEN line
                   ELSE string_agg(coalesce(c.token, '<*>'), ' ' ORDER BY place) END AS template
            FROM tokens LEFT JOIN constant c USING (leaf, place, token)
            GROUP BY leaf, line HAVING NOT verbatim OR any_value(n) >= 5),
        placed AS (SELECT doc_id, text, number, leaf, template, verbatim FROM candidates JOIN fields USING (leaf, line)),
        boilerplate AS (
            SELECT doc_id, text, number FROM placed
            WHERE (leaf, template, verbatim) IN (
                SELECT (leaf, template, verbatim) FROM placed
                GROUP BY leaf, template, verbatim HAVING count(DISTINCT text) >= 5)),
        dropped AS (
            SELECT doc_id, count(*) AS n, string_agg(number, ',' ORDER BY number) AS numbers
            FROM boilerplate GROUP BY doc_id),
        kept AS (
            SELECT doc_id, string_agg(line, chr(10) ORDER BY number) AS kept
            FROM (SELECT doc_id, unnest(range(1, len(ls) + 1)) - 1 AS number, ls[number + 1] AS line FROM texts)
            WHERE (doc_id, number) NOT IN (SELECT (doc_id, number) FROM boilerplate) GROUP BY doc_id)
        SELECT doc_id, len(ls)::bigint AS n_lines, coalesce(n, 0) AS n_dropped,
               coalesce(numbers, '') AS dropped_lines, sha256(coalesce(kept, '')) AS kept_sha256
        FROM texts LEFT JOIN dropped USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op10_heavy_hitter_split": f"""
        WITH texts AS (SELECT doc_id, {LOWERED} AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
               count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
               sha256(t) AS text_sha256
        FROM texts""",
    "op12_four_russians": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::double)) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        pairs AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                   list_dot_product(a.v, b.v)::bigint AS score
            FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id,
               row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::int AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN pairs USING (anchor_id)
        WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        QUALIFY rank <= 3""",
}
