"""SQL for the queries that SQL can express."""

CHAT = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -1, n, CASE WHEN n = 0 THEN 'user' ELSE 'assistant' END, '<|im_end|><|im_start|>assistant ok'
    FROM range(2) AS two(n)
), marked AS (
    SELECT *,
        length('<|im_start|>') + length('<|im_end|>') + 2
        + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\\\1|', 'g'))
        + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) AS chars,
        CASE WHEN role = 'assistant' THEN text ELSE '' END AS said
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(sum(length(said)) AS BIGINT) AS loss_chars,
    sha256(string_agg(said, '' ORDER BY turn, role, text)) AS loss_sha256,
    CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""

TOPK = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS ints
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        CAST(list_sum(list_transform(list_zip(q.ints, c.ints), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
WHERE place <= 10
"""

NGRAMS = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, list_slice(w, i, i + 3) AS shingle
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1)) + 1)) AS i FROM words)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT x, y FROM shared JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y
    WHERE 100 * shared.n >= 85 * (s.n + t.n - shared.n)
), reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT r.doc_id, l.y FROM reached r JOIN links l ON l.x = r.other
)
SELECT r.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.other) AS component_id
FROM reached r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id
"""

NEGATIVES = """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS ints
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, c.label = a.label AS same,
        CAST(list_sum(list_transform(list_zip(a.ints, c.ints), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM usable a JOIN usable c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id
), positives AS (
    SELECT * FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
    n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5
"""

#: The checksum of doc_id as text, bit by bit; -1 stands for one shift.
CRC = """list_reduce(
        list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
            lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)"""

MANIFEST = f"""
WITH RECURSIVE fields AS (
    SELECT doc_id, lang,
        coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
        || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
        n_chars, coalesce(strlen(text) || ':' || text, '-') AS tail,
        xor({CRC}, 4294967295) AS crc
    FROM documents
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS LAST, leaf) - 1 AS pos
    FROM (
        SELECT doc_id, lang,
            sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
            sha256(head || coalesce(strlen(CAST(claimed AS VARCHAR)) || ':' || claimed, '-') || tail) AS claim
        FROM (SELECT *, CASE WHEN crc % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS claimed FROM fields)
    )
), tree(level, lang, pos, digest) AS (
    SELECT 0, lang, pos, leaf FROM leaves
    UNION ALL
    SELECT level + 1, lang, pos // 2, sha256(string_agg(digest, '' ORDER BY pos))
    FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS n FROM tree) WHERE n > 1
    GROUP BY level, lang, pos // 2
), subroots AS (
    SELECT lang, level AS height, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos
    FROM (SELECT *, max(level) OVER (PARTITION BY lang) AS top FROM tree) WHERE level = top
), crown(level, pos, digest) AS (
    SELECT 0, pos, digest FROM subroots
    UNION ALL
    SELECT level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos))
    FROM (SELECT *, count(*) OVER () AS n FROM crown) WHERE n > 1
    GROUP BY level, pos // 2
), apex AS (
    SELECT level AS height, digest FROM crown ORDER BY level DESC LIMIT 1
), steps AS (
    SELECT l.doc_id, l.lang, l.pos AS leaf_pos, CAST(i.level AS BIGINT) AS step,
        (l.pos >> i.level) % 2 AS side, t.digest AS sibling
    FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
    JOIN range(64) i(level) ON i.level < s.height
    LEFT JOIN tree t ON t.lang IS NOT DISTINCT FROM l.lang AND t.level = i.level AND t.pos = xor(l.pos >> i.level, 1)
    UNION ALL
    SELECT l.doc_id, l.lang, l.pos, s.height + i.level, (s.pos >> i.level) % 2, c.digest
    FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
    JOIN range(64) i(level) ON i.level < (SELECT height FROM apex)
    LEFT JOIN crown c ON c.level = i.level AND c.pos = xor(s.pos >> i.level, 1)
), folds(lang, pos, step, digest) AS (
    SELECT lang, pos, CAST(0 AS BIGINT), claim FROM leaves
    UNION ALL
    SELECT f.lang, f.pos, f.step + 1, sha256(CASE
        WHEN s.sibling IS NULL THEN f.digest WHEN s.side = 1 THEN s.sibling || f.digest ELSE f.digest || s.sibling END)
    FROM folds f JOIN steps s ON s.lang IS NOT DISTINCT FROM f.lang AND s.leaf_pos = f.pos AND s.step = f.step
), ends AS (
    SELECT lang, pos, max_by(digest, step) AS folded_root FROM folds GROUP BY lang, pos
), proofs AS (
    SELECT lang, leaf_pos, sha256(coalesce(string_agg(sibling, '' ORDER BY step), '')) AS proof_sha256
    FROM steps GROUP BY lang, leaf_pos
)
SELECT l.doc_id, l.leaf, s.digest AS subroot, a.digest AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
    e.folded_root, e.folded_root = a.digest AS verified
FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
JOIN ends e ON e.lang IS NOT DISTINCT FROM l.lang AND e.pos = l.pos
LEFT JOIN proofs p ON p.lang IS NOT DISTINCT FROM l.lang AND p.leaf_pos = l.pos
CROSS JOIN apex a
"""

STATEMENTS: dict[str, str] = {
    "op6_chat_turns": CHAT,
    "op8_exact_topk": TOPK,
    "op11_ngram_product": NGRAMS,
    "op12_subset_sums": NEGATIVES,
    "op13_merkle_witnesses": MANIFEST,
}
