"""SQL counterparts, for DuckDB on the same tables, of the queries that SQL can express."""

ORACLE_SQL = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op6_url_filters": r"""
        WITH rules(host, path, verdict) AS (
            VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                   ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
        ), parts AS (
            SELECT row_number() OVER () AS nr, page_id,
                   translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
            FROM pages
        ), hits AS (
            SELECT p.nr, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
                   arg_max(r.verdict, length(r.host || r.path)) AS verdict
            FROM parts p JOIN rules r
              ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
            GROUP BY p.nr
        )
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
        FROM parts LEFT JOIN hits USING (nr)
    """,
    "op7_source_mixing": r"""
        WITH sizes AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                   md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place
            FROM documents
        ), sources AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   row_number() OVER (ORDER BY source NULLS LAST) AS nr
            FROM sizes GROUP BY source
        ), weighted AS (
            SELECT *, CASE (nr - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 3 * source_size AS most
            FROM sources
        ), ordered AS (
            SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(most) OVER before, 0) AS BIGINT) AS words_left,
                   CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS BIGINT) AS weight_left,
                   row_number() OVER (ORDER BY most / weight, nr) AS turn
            FROM weighted
            WINDOW before AS (ORDER BY most / weight, nr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), first_free AS (
            SELECT arg_min(turn, turn) AS turn, arg_min(words_left, turn) AS words_left,
                   arg_min(weight_left, turn) AS weight_left
            FROM ordered WHERE most * weight_left > weight * words_left
        ), targets AS (
            SELECT o.source, o.nr, o.source_size,
                   CASE WHEN f.turn IS NULL OR o.turn < f.turn THEN CAST(o.most AS DOUBLE)
                        ELSE o.weight * (CAST(f.words_left AS DOUBLE) / f.weight_left) END AS target
            FROM ordered o CROSS JOIN first_free f
        ), seats AS (
            SELECT nr, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, nr) AS seat
            FROM (SELECT nr, target, unnest(range(CAST(ceil(target / 8) AS BIGINT) + 3)) AS k FROM targets)
        ), won AS (
            SELECT nr, count(*) AS blocks FROM seats
            WHERE seat <= (SELECT CAST(sum(source_size) AS BIGINT) // 8 FROM targets) GROUP BY nr
        ), plan AS (
            SELECT t.source, t.source_size, t.target, least(3 * t.source_size, 8 * coalesce(blocks, 0)) AS words
            FROM targets t LEFT JOIN won USING (nr)
        ), placed AS (
            SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, doc_id, size
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
            FROM sizes
        )
        SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
               CAST(CASE WHEN source_size = 0 THEN 0 ELSE words // source_size * size
                    + least(size, greatest(0, words % source_size - start)) END AS BIGINT) AS taken
        FROM placed JOIN plan ON placed.source IS NOT DISTINCT FROM plan.source
    """,
    "op8_chat_formatting": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL
            SELECT -7, turn, role, '\### Assistant: </turn> ok'
            FROM (VALUES (0, 'user'), (1, 'assistant')) AS t(turn, role)
        ), pieces AS (
            SELECT *, replace(replace(replace(text, '\', '\\'), '<turn ', '<\turn '), '</turn>', '<\/turn>') AS body
            FROM turns
        ), whole AS (
            SELECT conv_id, count(*) AS n_turns,
                   string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS lines,
                   coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS learned,
                   string_agg(role || ',', '' ORDER BY turn, role, text) AS roles,
                   CAST(sum(length('<turn ') + length(role) + 2 + length(body) + length('</turn>') + 1) AS BIGINT)
                       AS formatted_chars
            FROM pieces GROUP BY conv_id
        )
        SELECT conv_id, n_turns, sha256(lines) AS turns_sha256, CAST(length(learned) AS BIGINT) AS loss_chars,
               sha256(learned) AS loss_sha256, formatted_chars,
               CASE WHEN regexp_full_match(roles, '(system,)?(user,assistant,(tool,assistant,)*)+') THEN 'ok'
                    WHEN regexp_full_match(roles,
                         '(system,)?(user,assistant,(tool,assistant,)*)*(user,|user,assistant,(tool,assistant,)*tool,)?')
                    THEN 'open' ELSE 'broken' END AS turn_order
        FROM whole
    """,
    "op13_hard_negatives": """
        WITH sound AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS code
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                   CAST(list_dot_product(a.code, b.code) AS BIGINT) AS score
            FROM sound a JOIN sound b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
        ), positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT p.anchor_id, p.positive_id,
               CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INT) AS rank,
               n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
        FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
             AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
        QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) <= 5
    """,
}
