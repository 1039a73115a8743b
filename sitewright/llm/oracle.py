"""SQL for the queries of this subpackage that SQL can express."""

SQL = {
    "op3_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
        ), scored AS (
            SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id
            WHERE a.vec_id % 50 = 0
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
        WHERE rank <= 5
    """,
    "op6_source_mixing": """
        WITH d AS (
            SELECT doc_id, coalesce(doc_id::VARCHAR, 'text:' || md5(coalesce(text, ''))) AS name, 'domain' || (ascii(coalesce(right(source, 1), '')) % 4) AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS n
            FROM documents
        ), leaf AS (
            SELECT domain, lang, source, sum(n)::HUGEINT AS tokens,
                   CASE domain WHEN 'domain0' THEN 4 WHEN 'domain1' THEN 3 WHEN 'domain2' THEN 2 ELSE 1 END::HUGEINT AS dw,
                   CASE lang WHEN 'en' THEN 6 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END::HUGEINT AS lw
            FROM d GROUP BY ALL
        ), l1 AS (
            SELECT domain, any_value(dw) AS w, 2 * sum(tokens) AS cap, (SELECT sum(tokens) FROM leaf) AS b FROM leaf GROUP BY 1
        ), l1a AS (
            SELECT *, sum(w) OVER (ORDER BY cap / w, domain ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wr,
                   coalesce(sum(cap) OVER (ORDER BY cap / w, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cb FROM l1
        ), l1b AS (
            SELECT *, cap * wr + w * cb <= w * b AS f FROM l1a
        ), l1c AS (
            SELECT *, b - coalesce(sum(CASE WHEN f THEN cap END) OVER (), 0) AS rest, sum(CASE WHEN NOT f THEN w END) OVER () AS wo FROM l1b
        ), l1d AS (
            SELECT *, CASE WHEN f THEN cap ELSE (w * rest)::HUGEINT // wo::HUGEINT END AS base, CASE WHEN f THEN -1 ELSE (w * rest)::HUGEINT % wo::HUGEINT END AS rem FROM l1c
        ), g1 AS (
            SELECT domain, base + CASE WHEN NOT f AND row_number() OVER (ORDER BY rem DESC, domain) <= b - sum(base) OVER () THEN 1 ELSE 0 END AS b FROM l1d
        ), l2 AS (
            SELECT domain, lang, any_value(lw) AS w, 2 * sum(tokens) AS cap, any_value(b) AS b FROM leaf JOIN g1 USING (domain) GROUP BY 1, 2
        ), l2a AS (
            SELECT *, sum(w) OVER (PARTITION BY domain ORDER BY cap / w, lang ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wr,
                   coalesce(sum(cap) OVER (PARTITION BY domain ORDER BY cap / w, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cb FROM l2
        ), l2b AS (
            SELECT *, cap * wr + w * cb <= w * b AS f FROM l2a
        ), l2c AS (
            SELECT *, b - coalesce(sum(CASE WHEN f THEN cap END) OVER (PARTITION BY domain), 0) AS rest, sum(CASE WHEN NOT f THEN w END) OVER (PARTITION BY domain) AS wo FROM l2b
        ), l2d AS (
            SELECT *, CASE WHEN f THEN cap ELSE (w * rest)::HUGEINT // wo::HUGEINT END AS base, CASE WHEN f THEN -1 ELSE (w * rest)::HUGEINT % wo::HUGEINT END AS rem FROM l2c
        ), g2 AS (
            SELECT domain, lang, base + CASE WHEN NOT f AND row_number() OVER (PARTITION BY domain ORDER BY rem DESC, lang) <= b - sum(base) OVER (PARTITION BY domain) THEN 1 ELSE 0 END AS b FROM l2d
        ), l3 AS (
            SELECT domain, lang, source, 1::HUGEINT AS w, 2 * tokens AS cap, tokens, b FROM leaf JOIN g2 USING (domain, lang)
        ), l3a AS (
            SELECT *, sum(w) OVER (PARTITION BY domain, lang ORDER BY cap / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wr,
                   coalesce(sum(cap) OVER (PARTITION BY domain, lang ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cb FROM l3
        ), l3b AS (
            SELECT *, cap * wr + w * cb <= w * b AS f FROM l3a
        ), l3c AS (
            SELECT *, b - coalesce(sum(CASE WHEN f THEN cap END) OVER (PARTITION BY domain, lang), 0) AS rest, sum(CASE WHEN NOT f THEN w END) OVER (PARTITION BY domain, lang) AS wo FROM l3b
        ), l3d AS (
            SELECT *, CASE WHEN f THEN cap ELSE (w * rest)::HUGEINT // wo::HUGEINT END AS base, CASE WHEN f THEN -1 ELSE (w * rest)::HUGEINT % wo::HUGEINT END AS rem FROM l3c
        ), g3 AS (
            SELECT domain, lang, source, tokens, base + CASE WHEN NOT f AND row_number() OVER (PARTITION BY domain, lang ORDER BY rem DESC, source) <= b - sum(base) OVER (PARTITION BY domain, lang) THEN 1 ELSE 0 END AS given FROM l3d
        ), epoch AS (
            SELECT d.*, tokens, given, UNNEST(range(0, (given // tokens)::BIGINT + 1)) AS epoch FROM d JOIN g3 USING (domain, lang, source) WHERE tokens > 0
        ), placed AS (
            SELECT *, coalesce(sum(n) OVER (PARTITION BY domain, lang, source, epoch ORDER BY md5('7:' || epoch || ':' || name), doc_id NULLS FIRST, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
                   given - epoch * tokens AS open FROM epoch
        )
        SELECT doc_id, domain, lang, source, epoch::INTEGER AS epoch, n AS n_tokens, CASE WHEN open >= tokens THEN n ELSE least(n, open - before)::BIGINT END AS take_tokens, tokens::BIGINT AS tokens, given::BIGINT AS given
        FROM placed WHERE open >= tokens OR before < open
    """,
    "op8_chat_formatting": """
        WITH c AS (
            SELECT conv_id, turn, 'c' || conv_id || '-' || turn AS call_id, text, length(text) >= 80 AS long, conv_id % 10 = 3 AS bad FROM conversations WHERE role = 'user'
        ), r AS (
            SELECT conv_id, turn, 'c' || conv_id || '-' || (turn - 1) AS call_id, text FROM conversations WHERE role = 'assistant'
        ), l AS (
            SELECT call_id, turn - 2 * row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS run, conv_id, turn, turn % 2 AS odd FROM c
        ), lv AS (
            SELECT call_id, row_number() OVER (PARTITION BY conv_id, odd, run ORDER BY turn) - 1 AS level FROM l
        ), j AS (
            SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id, coalesce(c.turn, r.turn) AS turn, r.text AS content, c.text, c.long, c.bad, c.turn AS asked,
                   CASE WHEN c.call_id IS NULL THEN 'orphan' WHEN r.call_id IS NULL THEN 'unanswered' ELSE 'linked' END AS status, lv.level
            FROM c FULL JOIN r ON c.call_id = r.call_id LEFT JOIN lv ON lv.call_id = c.call_id
        ), o AS (
            SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE role IS NULL OR role NOT IN ('user', 'assistant')
        )
        SELECT conv_id, call_id, turn, status, level::INTEGER AS level, CASE WHEN asked IS NULL THEN NULL ELSE NOT bad END AS valid,
               CASE WHEN asked IS NOT NULL AND bad THEN 'type:limit' ELSE '' END AS faults,
               CASE WHEN asked >= 2 AND level = 0 THEN 1 ELSE 0 END AS n_missing_after,
               '{' || CASE WHEN asked IS NULL THEN '' ELSE '"arguments":{' || CASE WHEN long THEN '"limit":' || CASE WHEN bad THEN '"' || asked || '"' ELSE asked::VARCHAR END || ',"query":' || to_json(text)
                                 ELSE '"key":' || to_json(text) || ',"limit":' || CASE WHEN bad THEN '"' || asked || '"' ELSE asked::VARCHAR END END || '},' END
               || '"call_id":' || to_json(call_id) || CASE WHEN content IS NULL THEN '' ELSE ',"content":' || to_json(content) END
               || CASE WHEN level IS NULL THEN '' ELSE ',"level":' || level END || CASE WHEN asked IS NULL THEN '' ELSE ',"name":' || CASE WHEN long THEN '"search"' ELSE '"lookup"' END END
               || ',"status":"' || status || '","turn":' || turn || '}' AS json
        FROM j
        UNION ALL
        SELECT conv_id, NULL, turn, 'message', NULL, NULL, '', 0,
               '{' || coalesce('"content":' || to_json(text) || ',', '') || coalesce('"role":' || to_json(role) || ',', '') || '"status":"message"' || coalesce(',"turn":' || turn, '') || '}'
        FROM o
    """,
    "op13_lexical_search": r"""
        WITH d AS (
            SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents
        ), s AS (
            SELECT k, doc_id, len(words) AS n, words FROM d WHERE len(words) > 0
        ), g AS (
            SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM s
        ), p AS (
            SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(words) AS term FROM s) GROUP BY k, term
        ), q AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
        ), df AS (
            SELECT term, count(*) AS df FROM p WHERE term IN (SELECT term FROM q) GROUP BY term
        ), w AS (
            SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, g
        ), m AS (
            SELECT k, doc_id, 10 + (90 * n * docs) // total AS m FROM s, g
        ), r AS (
            SELECT item_id, k, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
            FROM q JOIN w USING (term) JOIN p USING (term) JOIN m USING (k) GROUP BY item_id, k, doc_id
        ), o AS (
            SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score FROM r WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 10
    """,
}
