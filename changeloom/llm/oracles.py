"""The same results in SQL, where SQL can express them."""

#: Words as the operators split them.
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

#: Terms of the lexical search: of letters, only A to Z are lower-cased.
TERMS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

#: How many first turns a conversation takes over: CRC-32 of its id, bit by bit, modulo 4.
HEAD = """xor(list_reduce(
    list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x : CAST(ascii(x) AS BIGINT)),
    lambda crc, byte : list_reduce(
        range(8), lambda k, i : xor(k >> 1, CASE WHEN k & 1 = 1 THEN 3988292384 ELSE 0 END), xor(crc, byte)),
    4294967295), 4294967295) % 4"""

ORACLES = {
    "op2_ngram_jaccard_join": f"""
        WITH RECURSIVE d AS (SELECT doc_id, {WORDS} AS w FROM documents),
        s AS (
            SELECT DISTINCT doc_id, w[p : p + 4] AS run
            FROM d, LATERAL (SELECT unnest(generate_series(1, greatest(len(w) - 4, 1))) AS p)
            WHERE len(w) > 0
        ),
        sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        shared AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
            FROM s AS a JOIN s AS b ON a.run = b.run AND a.doc_id <> b.doc_id GROUP BY ALL
        ),
        links AS (
            SELECT x, y FROM shared JOIN sizes AS a ON a.doc_id = x JOIN sizes AS b ON b.doc_id = y
            WHERE 10 * shared.n >= 8 * (a.n + b.n - shared.n)
        ),
        reach(doc_id, class_id) AS (
            SELECT doc_id, doc_id FROM d
            UNION SELECT y, class_id FROM reach JOIN links ON x = doc_id
        )
        SELECT doc_id, min(class_id) AS class_id,
               (SELECT count(*) FROM links WHERE x = reach.doc_id) AS n_links
        FROM reach GROUP BY doc_id
    """,
    "op4_embedding_near_dedup": """
        WITH RECURSIVE e AS (
            SELECT vec_id, label, list_transform(embedding, lambda x : x::DOUBLE) AS v FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x : x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x : x <> 0)) > 0
        ),
        links AS (
            SELECT a.vec_id AS x, b.vec_id AS y FROM e AS a JOIN e AS b
            ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
            WHERE list_cosine_similarity(a.v, b.v) >= 0.98
        ),
        reach(vec_id, component_id) AS (
            SELECT vec_id, vec_id FROM embeddings
            UNION SELECT y, component_id FROM reach JOIN links ON x = vec_id
        )
        SELECT vec_id, (SELECT count(*) FROM links WHERE x = reach.vec_id) AS n_links,
               min(component_id) AS component_id, vec_id = min(component_id) AS kept
        FROM reach GROUP BY vec_id
    """,
    "op7_substring_dedup": f"""
        WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
        s AS (
            SELECT doc_id, p, w[p : p + 34] AS words
            FROM d, LATERAL (SELECT unnest(generate_series(1, len(w) - 34)) AS p)
        ),
        twice AS (SELECT words FROM s GROUP BY words HAVING count(*) > 1),
        covered AS (
            SELECT doc_id, list_distinct(flatten(list(generate_series(p, p + 34)))) AS gone
            FROM s SEMI JOIN twice USING (words) GROUP BY doc_id
        )
        SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
               sha256(CASE WHEN gone IS NULL THEN array_to_string(w, ' ') ELSE array_to_string(
                   list_filter(w, lambda x, i : NOT list_contains(gone, i)), ' ') END) AS kept_sha256
        FROM d LEFT JOIN covered USING (doc_id)
    """,
    "op12_lexical_search": f"""
        WITH t AS (SELECT doc_id, row_number() OVER () AS line, unnest({TERMS}) AS term FROM documents),
        docs AS (SELECT line, any_value(doc_id) AS doc_id, count(*) AS n FROM t GROUP BY line),
        whole AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS total FROM docs),
        tf AS (SELECT line, term, count(*) AS tf FROM t GROUP BY line, term),
        weight AS (
            SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM tf, whole GROUP BY term
        ),
        items AS (
            SELECT item_id, item, unnest(list_distinct(terms)) AS term
            FROM (SELECT item_id, row_number() OVER () AS item, {TERMS} AS terms
                  FROM (SELECT DISTINCT item_id, text FROM benchmark) AS b) AS i
        ),
        scores AS (
            SELECT item_id, item, line, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (
                       50 + (50 * n * n_docs) // total)))) AS BIGINT) AS score
            FROM items JOIN tf USING (term) JOIN weight USING (term) JOIN docs USING (line), whole
            GROUP BY item_id, item, line
        ),
        ranked AS (
            SELECT item_id, doc_id, score, row_number() OVER (
                PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank
            FROM scores JOIN docs USING (line) WHERE score > 0
        )
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
    """,
    "op13_conversation_trie": f"""
        WITH turns AS (
            SELECT conv_id, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS x,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                                      left(coalesce(text, ''), 64), sha256(coalesce(text, ''))) AS p
            FROM conversations WHERE conv_id IS NOT NULL
        ),
        own AS (SELECT conv_id, list(x ORDER BY p) AS l, {HEAD} AS h FROM turns GROUP BY conv_id),
        convs AS (
            SELECT a.conv_id, list_concat(coalesce(b.l[1 : a.h], []), a.l[a.h + 1 :]) AS l
            FROM own AS a LEFT JOIN own AS b ON b.conv_id = a.conv_id - a.conv_id % 20
        ),
        members AS (
            SELECT conv_id, d, l[1 : d] AS node, d = len(l) AS at_end
            FROM convs, LATERAL (SELECT unnest(generate_series(0, len(l))) AS d)
        ),
        nodes AS (
            SELECT node, any_value(d) AS depth, min(conv_id) AS least, count(*) AS n,
                   string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (at_end) AS ends,
                   (count(*) - 1) * len(regexp_extract_all(
                       coalesce(node[len(node)]['t'], ''), '[^\\x20\\x09-\\x0D]+')) AS saved
            FROM members GROUP BY node
        ),
        kids AS (SELECT node[1 : depth - 1] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
        below AS (
            SELECT a.node[1 : d] AS node, sum(CASE WHEN k.n IS NULL THEN 1 ELSE 0 END) AS leaves,
                   sum(a.saved) AS saved
            FROM nodes AS a LEFT JOIN kids AS k ON k.node = a.node,
                 LATERAL (SELECT unnest(generate_series(0, a.depth)) AS d)
            GROUP BY ALL
        )
        SELECT a.least AS conv_id, a.depth, p.least AS parent_conv_id, a.n AS n_convs,
               coalesce(k.n, 0) AS n_children, CAST(b.leaves AS BIGINT) AS n_leaves,
               CAST(b.saved AS BIGINT) AS saved_tokens, sha256(coalesce(a.ends, '')) AS ends_sha256
        FROM nodes AS a JOIN below AS b ON b.node = a.node
        LEFT JOIN kids AS k ON k.node = a.node
        LEFT JOIN nodes AS p ON a.depth > 0 AND p.node = a.node[1 : a.depth - 1]
    """,
}
