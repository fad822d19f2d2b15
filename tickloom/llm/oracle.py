"""The queries of this folder in DuckDB SQL, where SQL can express them."""

ORACLE = {
    "op1_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
            WHERE q.vec_id % 100 = 0
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op3_source_mix": r"""
        WITH sized AS (
            SELECT doc_id, source,
                   coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
            FROM documents
        ), sources AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
            FROM sized GROUP BY source
        ), steps AS (
            -- with the sources before this one held at their limits, the others get unit * weight; the
            -- unit grows while the next source is above its limit and falls from there on
            SELECT *, sum(source_size) OVER () AS total,
                   sum(3 * source_size) OVER up - 3 * source_size AS held,
                   sum(weight) OVER () - (sum(weight) OVER up - weight) AS free
            FROM sources
            WINDOW up AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)
        ), level AS (
            SELECT max((total - held)::DOUBLE / free::DOUBLE) AS unit
            FROM steps
        ), targets AS (
            SELECT source, source_size,
                   CASE WHEN weight * unit > 3 * source_size THEN (3 * source_size)::DOUBLE ELSE weight * unit END AS target
            FROM sources, level
        ), rates AS (
            SELECT doc_id, size, source_size, target,
                   CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
                   ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
            FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
        )
        SELECT doc_id, size, source_size, target,
               (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT * size AS taken
        FROM rates
    """,
    "op8_exact_dedup": """
        WITH d AS (
            SELECT doc_id,
                   sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents
        ), g AS (
            SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256
        )
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
        FROM d JOIN g USING (text_sha256)
    """,
    "op11_ranked_search": r"""
        WITH terms AS (
            SELECT row, doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents)
        ), tf AS (
            SELECT row, doc_id, term, count(*) AS tf FROM terms GROUP BY row, doc_id, term
        ), sizes AS (
            SELECT row, sum(tf)::BIGINT AS n FROM tf GROUP BY row
        ), totals AS (
            SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes
        ), norms AS (
            SELECT row, 75 + (25 * n * n_docs) // n_terms AS m FROM sizes, totals
        ), weights AS (
            SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
            FROM tf, totals GROUP BY term
        ), asked AS (
            SELECT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM (SELECT DISTINCT item_id, text FROM benchmark)
        ), scored AS (
            SELECT item_id, doc_id, row, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
            FROM asked JOIN tf USING (term) JOIN weights USING (term) JOIN norms USING (row)
            GROUP BY item_id, doc_id, row
        ), placed AS (
            SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
            FROM scored WHERE score > 0
        )
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM placed WHERE rank <= 20
    """,
    "op12_merkle_manifest": """
        WITH RECURSIVE fields AS (
            SELECT row_number() OVER () AS row, doc_id, lang, text,
                   coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
                   -- crc32, bit by bit, of the id's digits
                   xor(4294967295, list_reduce(
                       list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
                       lambda c, b: list_reduce(range(8), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)),
                       4294967295::BIGINT)) AS crc
            FROM documents
        ), leaves AS (
            SELECT *, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   sha256(head || coalesce(strlen(text) || ':' ||
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) AS lowered
            FROM fields
        ), ranked AS (
            SELECT row, doc_id, lang, leaf, CASE WHEN crc % 3 = 0 THEN lowered ELSE leaf END AS shown,
                   row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
                   count(*) OVER (PARTITION BY lang) AS n
            FROM leaves
        ), nodes AS (
            SELECT lang, 0 AS height, rank AS idx, leaf AS digest, n FROM ranked
            UNION ALL
            SELECT lang, height + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), any_value((n + 7) // 8)
            FROM nodes WHERE n > 1 GROUP BY lang, height, idx // 8
        ), beside AS (
            SELECT lang, height, idx,
                   coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                   coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
            FROM nodes WHERE n > 1 WINDOW run AS (PARTITION BY lang, height, idx // 8 ORDER BY idx)
        ), walk AS (
            SELECT row, lang, 0 AS height, rank AS idx, shown AS now, '' AS proof FROM ranked
            UNION ALL
            SELECT row, walk.lang, walk.height + 1, walk.idx // 8, sha256(l || now || r), proof || l || r
            FROM walk JOIN beside ON walk.lang IS NOT DISTINCT FROM beside.lang
                 AND walk.height = beside.height AND walk.idx = beside.idx
        ), subroots AS (
            SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
            FROM nodes WHERE n = 1
        ), tops AS (
            SELECT 0 AS height, idx, subroot AS digest, n FROM subroots
            UNION ALL
            SELECT height + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), any_value((n + 7) // 8)
            FROM tops WHERE n > 1 GROUP BY height, idx // 8
        ), top_beside AS (
            SELECT height, idx,
                   coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                   coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
            FROM tops WHERE n > 1 WINDOW run AS (PARTITION BY height, idx // 8 ORDER BY idx)
        ), climb AS (
            SELECT row, 0 AS height, s.idx, now, proof
            FROM (SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY row ORDER BY height DESC) = 1) w
            JOIN subroots s ON w.lang IS NOT DISTINCT FROM s.lang
            UNION ALL
            SELECT row, climb.height + 1, climb.idx // 8, sha256(l || now || r), proof || l || r
            FROM climb JOIN top_beside b ON climb.height = b.height AND climb.idx = b.idx
        ), folded AS (
            SELECT * FROM climb QUALIFY row_number() OVER (PARTITION BY row ORDER BY height DESC) = 1
        ), root AS (
            SELECT digest AS root FROM tops WHERE n = 1
        )
        SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, now AS folded_root, now = root AS verified
        FROM ranked JOIN folded USING (row) JOIN subroots ON ranked.lang IS NOT DISTINCT FROM subroots.lang, root
    """,
    "op13_quality_rules": r"""
        WITH texts AS (
            SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
        ), worded AS (
            SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM texts
        ), windows AS (
            SELECT row, i, array_to_string(words[i:i + 7], ' ') AS words
            FROM (SELECT row, words, unnest(range(1, len(words) - 6)) AS i FROM worded)
        ), repeated AS (
            SELECT row, count(DISTINCT place) AS n_repeat_words
            FROM (SELECT row, unnest(range(i, i + 8)) AS place
                  FROM (SELECT row, i FROM windows QUALIFY count(*) OVER (PARTITION BY row, words) > 1))
            GROUP BY row
        ), lines AS (
            SELECT row, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS words,
                   row_number() OVER (PARTITION BY row, line ORDER BY p) > 1 AS seen
            FROM (SELECT row, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS p FROM texts)
        ), measured AS (
            SELECT *, len(words) AS n,
                   len(regexp_extract_all(line, '[|\x{00BB}\x{203A}\x{2022}\x{00B7}\x{2192}]')) AS links,
                   len(regexp_extract_all(line, '[!?]{2,}|[#*$%&<>]+')) AS noise,
                   len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) AS same
            FROM lines
        ), judged AS (
            SELECT *, CASE
                WHEN n = 0 THEN NULL
                WHEN (links >= 2 AND links * 4 >= n) OR regexp_matches(line, '(?i)^[^a-z0-9]*(home|menu|log ?in|log ?out|sign (in|up)|register|search|next|previous|back to top|read more|share|contact( us)?|about( us)?|skip to (main )?content|site ?map)[^a-z0-9]*\z') THEN 'navigation'
                WHEN seen OR (n >= 4 AND 2 * same > n) OR regexp_matches(line, '(?i)(cookie (policy|settings|consent)|(uses?|accept( all)?) cookies|privacy policy|terms of (use|service)|all rights reserved|\x{00A9}|\(c\) [0-9]{4}|enable javascript|lorem ipsum|subscribe to our|click here|powered by)') THEN 'boilerplate'
                WHEN noise * 5 > n OR NOT regexp_matches(line, '[.!?:;\x{2026}\x{3002}\x{FF01}\x{FF1F}\x{0964}\x{061F}\x{06D4}][\x22\x27\x{201D}\x{2019}\x{00BB})\]]*[\x20\x09-\x0D]*\z') THEN 'punctuation'
                END AS failed
            FROM measured
        ), by_text AS (
            SELECT row, count(*) FILTER (WHERE n > 0 AND seen) AS n_dup_lines,
                   count(*) FILTER (WHERE failed = 'navigation') AS n_navigation,
                   count(*) FILTER (WHERE failed = 'boilerplate') AS n_boilerplate,
                   count(*) FILTER (WHERE failed = 'punctuation') AS n_punctuation,
                   coalesce(sum(length(array_to_string(words, ''))) FILTER (WHERE failed IS NOT NULL), 0)::BIGINT AS lost_chars
            FROM judged GROUP BY row
        ), figures AS (
            SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
                   len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, n_dup_lines,
                   coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, n_navigation, n_boilerplate, n_punctuation, lost_chars
            FROM worded JOIN by_text USING (row) LEFT JOIN repeated USING (row)
        ), based AS (
            SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM figures
        )
        SELECT *, NOT base_failed AND 100 * lost_chars <= 50 * word_chars AS kept FROM based
    """,
}
