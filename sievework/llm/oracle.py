"""The operators' results in SQL, where SQL can express them."""

from __future__ import annotations

# Words per document, shares by weight with caps (rounds of clamping), one more repetition in the order of the draws.
MIX_SQL = r"""
WITH RECURSIVE sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), base AS (
    SELECT *, ('0x' || substr(md5('20:' || coalesce(doc_id::VARCHAR, '') || ':' || size::VARCHAR), 1, 15))::BIGINT AS draw FROM sized
), sizes AS (
    SELECT source, sum(size)::DOUBLE AS source_size, row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1 AS place
    FROM base GROUP BY source
), sources AS (
    SELECT source, source_size, 2.0::DOUBLE * source_size AS cap, CASE place % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS weight FROM sizes
), levels AS (
    SELECT 0 AS round, -1::BIGINT AS clamped, 0.0::DOUBLE AS level
    UNION ALL
    SELECT round + 1, n, (1.5::DOUBLE * total - filled) / open
    FROM (
        SELECT round, clamped,
            (SELECT count(*) FROM sources WHERE clamped >= 0 AND cap < level * weight) AS n,
            (SELECT coalesce(sum(cap), 0.0) FROM sources WHERE clamped >= 0 AND cap < level * weight) AS filled,
            (SELECT sum(weight) FROM sources WHERE NOT (clamped >= 0 AND cap < level * weight)) AS open,
            (SELECT sum(source_size) FROM sources) AS total
        FROM levels
    ) WHERE n <> clamped AND open > 0
), targets AS (
    SELECT source, source_size, least(cap, (SELECT level FROM levels ORDER BY round DESC LIMIT 1) * weight) AS target FROM sources
), parts AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets
), placed AS (
    SELECT b.doc_id, b.source, b.size, b.draw, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS rest,
        sum(b.size) OVER (PARTITION BY b.source ORDER BY b.draw RANGE UNBOUNDED PRECEDING)::DOUBLE AS reached,
        sum(b.size) OVER (PARTITION BY b.source, b.draw)::DOUBLE AS words
    FROM base b JOIN parts p ON b.source IS NOT DISTINCT FROM p.source
), counted AS (
    SELECT *, CASE WHEN words = 0 THEN 0 ELSE (rest - (reached - words)) / words END AS part FROM placed
)
SELECT doc_id, source, size, source_size::BIGINT AS source_size, target,
    (whole + CASE WHEN size > 0 AND (reached <= rest OR part >= 0.5) THEN 1 ELSE 0 END)::BIGINT AS copies,
    (whole * size + CASE WHEN reached <= rest THEN size WHEN part > 0 THEN floor(part * size + 0.5) ELSE 0 END)::BIGINT AS taken
FROM counted
"""

CHAT_SQL = r"""
WITH turns AS (
    SELECT DISTINCT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), listed AS (
    SELECT conv_id, count(*) AS n_turns, list(role || chr(31) || text ORDER BY turn NULLS FIRST, md5(role || chr(31) || text)) AS said
    FROM turns GROUP BY conv_id
), longest AS (
    SELECT min(conv_id) AS conv_id, n_turns, count(*) AS copies, said FROM listed GROUP BY n_turns, said
), prefixes AS (
    SELECT DISTINCT list_slice(said, 1, k) AS said FROM longest, range(1, n_turns) AS r(k)
), kept AS (
    SELECT * FROM longest WHERE NOT EXISTS (SELECT 1 FROM prefixes p WHERE p.said = longest.said)
)
SELECT t.conv_id, any_value(k.n_turns) AS n_turns, any_value(k.copies) AS copies,
    dense_rank() OVER (PARTITION BY t.conv_id ORDER BY coalesce(floor(t.turn / 256), -4611686018427387904)) - 1 AS part,
    string_agg('<|im_start|>' || t.role || chr(10)
        || replace(replace(t.text, '<|im_start|>', '< |im_start|>'), '<|im_end|>', '< |im_end|>') || '<|im_end|>' || chr(10), ''
        ORDER BY t.turn NULLS FIRST, md5(t.role || chr(31) || t.text)) AS rendered
FROM turns t JOIN kept k ON t.conv_id = k.conv_id
GROUP BY t.conv_id, coalesce(floor(t.turn / 256), -4611686018427387904)
"""

# All pairs that share a shingle, and all that links lead to.
NEAR_TEXTS_SQL = r"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS shingles
    FROM worded
), items AS (
    SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
), pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared, any_value(a.n) AS na, any_value(b.n) AS nb
    FROM items a JOIN items b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT a, b FROM pairs WHERE 100 * shared >= 85 * (na + nb - shared)
), reached AS (
    SELECT doc_id, doc_id AS other FROM sets
    UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT s.doc_id, any_value(len(s.shingles))::BIGINT AS n_shingles, min(r.other) AS component_id, s.doc_id = min(r.other) AS kept
FROM sets s JOIN reached r ON r.doc_id = s.doc_id GROUP BY s.doc_id
"""

NEAR_VECTORS_SQL = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95
), reached AS (
    SELECT vec_id, vec_id AS other FROM embeddings
    UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON l.a = r.other
), counted AS (
    SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
)
SELECT r.vec_id, coalesce(any_value(c.n), 0) AS n_links, min(r.other) AS component_id, r.vec_id = min(r.other) AS kept
FROM reached r LEFT JOIN counted c ON c.vec_id = r.vec_id GROUP BY r.vec_id
"""

# All windows of 20 words, and the words that a later one covers.
SUBSTRINGS_SQL = r"""
WITH worded AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 19), ' ')) AS body FROM worded, range(1, len(w) - 18) AS r(i)
), placed AS (
    SELECT doc_id, i, row_number() OVER (PARTITION BY body ORDER BY doc_id, i) AS place FROM windows
), covered AS (
    SELECT DISTINCT doc_id, i + step AS i FROM placed, range(20) AS s(step) WHERE place > 1
), words AS (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM worded
), kept AS (
    SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.i) FILTER (c.i IS NULL) AS body, count(c.i) AS n_removed
    FROM words w LEFT JOIN covered c ON c.doc_id = w.doc_id AND c.i = w.i GROUP BY w.doc_id
)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(k.n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(k.body, '')) AS kept_sha256
FROM worded w LEFT JOIN kept k ON k.doc_id = w.doc_id
"""

# Prefixes of the rebuilt conversations as texts of their turns' hashes; a node adds to all prefixes of its own.
TRIE_SQL = r"""
WITH turns AS (
    SELECT conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS said,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), listed AS (
    SELECT conv_id, list(said ORDER BY place) AS said, list(words ORDER BY place) AS words FROM turns GROUP BY conv_id
), bits AS (
    SELECT b, list_reduce([b::UBIGINT, 0, 1, 2, 3, 4, 5, 6, 7], lambda c, step: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END) AS entry
    FROM range(256) AS r(b)
), crc_table AS (
    SELECT list(entry ORDER BY b) AS entries FROM bits
), taken AS (
    SELECT conv_id, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::UBIGINT)),
        lambda c, x: xor(c // 256, entries[(xor(c, x) % 256 + 1)::BIGINT])), 4294967295::UBIGINT) % 4 AS h
    FROM listed, crc_table
), rebuilt AS (
    SELECT l.conv_id, list_concat(coalesce(list_slice(b.said, 1, t.h::BIGINT), []), list_slice(l.said, (t.h + 1)::BIGINT, len(l.said))) AS said,
        list_concat(coalesce(list_slice(b.words, 1, t.h::BIGINT), []), list_slice(l.words, (t.h + 1)::BIGINT, len(l.words))) AS words
    FROM listed l JOIN taken t USING (conv_id) LEFT JOIN listed b ON b.conv_id = l.conv_id - l.conv_id % 20
), members AS (
    SELECT conv_id, depth, array_to_string(list_slice(said, 1, depth), ',') AS prefix, array_to_string(list_slice(said, 1, depth - 1), ',') AS parent,
        CASE WHEN depth > 0 THEN words[depth] ELSE 0 END AS words, depth = len(said) AS ended
    FROM rebuilt, range(0, len(said) + 1) AS r(depth)
), nodes AS (
    SELECT prefix, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
        coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ended), '') AS ends
    FROM members GROUP BY prefix, depth
), children AS (
    SELECT parent, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY parent, depth
), full_nodes AS (
    SELECT nodes.*, coalesce(c.n, 0) AS n_children FROM nodes LEFT JOIN children c ON c.parent = nodes.prefix AND c.depth = nodes.depth
), sums AS (
    SELECT up.prefix, up.depth, count(*) FILTER (f.n_children = 0) AS n_leaves, sum((f.n_convs - 1) * f.words) AS saved
    FROM (SELECT *, left(prefix, greatest(0, 33 * up - 1)::BIGINT) AS above, up FROM full_nodes, range(0, depth + 1) AS r(up)) f
    JOIN full_nodes up ON up.prefix = f.above AND up.depth = f.up GROUP BY up.prefix, up.depth
)
SELECT f.conv_id, f.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved::BIGINT AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM full_nodes f JOIN sums s ON s.prefix = f.prefix AND s.depth = f.depth
LEFT JOIN full_nodes p ON p.prefix = f.parent AND p.depth = f.depth - 1
"""

ORACLE_SQL = {
    "op2_mix_sources": MIX_SQL,
    "op8_near_texts": NEAR_TEXTS_SQL,
    "op9_near_vectors": NEAR_VECTORS_SQL,
    "op10_chat": CHAT_SQL,
    "op12_prefix_trie": TRIE_SQL,
    "op13_substrings": SUBSTRINGS_SQL,
}
