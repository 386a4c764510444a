"""SQL of the operators that DuckDB can run."""

from __future__ import annotations

from repotide.llm.multiset_hash import _LANE_BITS, _MASK, _MODULUS

_LOW = (1 << _LANE_BITS) - 1

_JOIN = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [w]
        ELSE list_transform(range(1, len(w) - 3), lambda i: w[i : i + 4]) END) AS s
    FROM words
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS hits
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * hits >= 75 * (x.n + y.n - hits)
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM documents d
LEFT JOIN sizes ON sizes.doc_id = d.doc_id
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = d.doc_id
"""

_HASH = f"""
WITH paired AS (
    SELECT doc_id, coalesce(text, '') AS text, coalesce(
        lead(coalesce(text, '')) OVER (ORDER BY doc_id),
        first_value(coalesce(text, '')) OVER (ORDER BY doc_id)) AS following
    FROM documents
), edits AS (
    SELECT doc_id, text, following, length(text) AS n,
        substr(text, 1, length(text) - length(text) // 2)
            || substr(following, 1, length(text) // 2) AS edited
    FROM paired
), texts AS (
    SELECT doc_id, kind, string_split(
        replace(replace(replace(replace(t, '. ', '.' || chr(10)), '! ', '!' || chr(10)),
            '? ', '?' || chr(10)), '| ', '|' || chr(10)), chr(10)) AS pieces
    FROM (SELECT doc_id, 'own' AS kind, text AS t FROM edits
        UNION ALL SELECT doc_id, 'edit', edited FROM edits
        UNION ALL SELECT doc_id, 'next', following FROM edits)
), hashes AS (
    SELECT doc_id, kind, len(pieces) AS n,
        list_transform(pieces, lambda p: CAST('0x' || substr(md5(p), 1, 15) AS BIGINT)) AS h1,
        list_transform(pieces, lambda p: CAST('0x' || substr(md5(p), 16, 15) AS BIGINT)) AS h2
    FROM texts
), sums AS (
    SELECT doc_id, kind, n, list_concat(
        list_transform(range(0, {_LANE_BITS}), lambda j: CAST(list_sum(
            list_transform(h1, lambda x: (x >> j) & {_MASK})) AS BIGINT) & {_MODULUS}),
        list_transform(range(0, {_LANE_BITS}), lambda j: CAST(list_sum(
            list_transform(h2, lambda x: (x >> j) & {_MASK})) AS BIGINT) & {_MODULUS})) AS s
    FROM hashes
), signed AS (
    SELECT doc_id, kind, array_to_string(list_transform(list_append(s, n), lambda x: hex(x)), '.') AS shown,
        CAST(list_transform(flatten(list_transform(s, lambda x:             [x & {_LOW}, (x >> {_LANE_BITS}) & {_LOW}, (x >> {2 * _LANE_BITS}) & {_LOW}])),
            lambda c: c * 2 - n) AS DOUBLE[]) AS v
    FROM sums
), near AS (
    SELECT a.doc_id, b.kind, b.shown, round(greatest(0.0, least(1.0, CASE
        WHEN list_inner_product(a.v, a.v) * list_inner_product(b.v, b.v) > 0
        THEN list_inner_product(a.v, b.v)
            / (sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v)))
        ELSE 0.0 END)), 6) AS near
    FROM signed a JOIN signed b ON a.doc_id = b.doc_id AND a.kind = 'own'
)
SELECT e.doc_id, CAST(e.n AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256,
    o.shown AS fingerprint, x.shown AS edited_fingerprint,
    x.near AS near_edited, f.near AS near_next
FROM edits e
JOIN near o ON o.doc_id = e.doc_id AND o.kind = 'own'
JOIN near x ON x.doc_id = e.doc_id AND x.kind = 'edit'
JOIN near f ON f.doc_id = e.doc_id AND f.kind = 'next'
"""

_COPIES = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

_NEGATIVES = """
WITH rows AS (
    SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda c: floor(256 * c::double)) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), scored AS (
    SELECT a.id AS anchor_id, b.id, a.label = b.label AS alike,
        CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
    FROM rows a JOIN rows b ON a.id <> b.id WHERE a.id % 100 = 0
), positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank,
    id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT alike
    AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW best AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER best <= 10
"""

ORACLE_SQL: dict[str, str] = {
    "op8_ngram_join": _JOIN,
    "op9_multiset_hash": _HASH,
    "op11_digest_runs": _COPIES,
    "op12_hard_negatives": _NEGATIVES,
}
