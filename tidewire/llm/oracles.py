"""SQL (DuckDB) of the queries of this package that SQL can express, over whole tables."""

from __future__ import annotations

from tidewire.llm.secrets import RULES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Stands before and after each match while a text is cut into gaps and matches; a private-use character that texts lack.
MARK = "chr(63743)"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


DECONTAMINATE = rf"""
WITH doc AS (
    SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words FROM documents
), item AS (
    SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), item_start AS (
    SELECT item_id, words, least(13, len(words)) AS size, unnest(range(1, len(words) - least(13, len(words)) + 2)) AS start FROM item WHERE len(words) > 0
), item_window AS (
    SELECT DISTINCT item_id, size, array_to_string(words[start:start + size - 1], ' ') AS window_words FROM item_start
), doc_start AS (
    SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS start FROM doc, (SELECT DISTINCT size FROM item_window)
), doc_window AS (
    SELECT doc_id, size, start, array_to_string(words[start:start + size - 1], ' ') AS window_words FROM doc_start
), hit AS (
    SELECT doc_id, size, start, item_id FROM doc_window JOIN item_window USING (size, window_words)
), hit_words AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(start, start + size)) AS place FROM hit) GROUP BY doc_id
), hit_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM doc LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

NEAR_DUP = rf"""
WITH RECURSIVE doc AS (
    SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+'), []) AS words FROM documents
), starts AS (
    SELECT doc_id, words, least(4, len(words)) AS size, unnest(range(1, len(words) - least(4, len(words)) + 2)) AS start FROM doc WHERE len(words) > 0
), shingle AS (
    SELECT DISTINCT doc_id, array_to_string(words[start:start + size - 1], ' ') AS s FROM starts
), sets AS (
    SELECT doc_id, count(*) AS n, md5(string_agg(s, chr(10) ORDER BY s)) AS digest FROM shingle GROUP BY doc_id
), rep AS (
    SELECT digest, min(doc_id) AS id, any_value(n) AS n FROM sets GROUP BY digest
), member AS (
    SELECT id, n, s FROM rep JOIN shingle ON doc_id = id
), link AS (
    SELECT a.id AS a, b.id AS b FROM member a JOIN member b ON a.s = b.s AND a.id < b.id
    GROUP BY a.id, b.id HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
), edge AS (
    SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach AS (
    SELECT id AS a, id AS b FROM rep
    UNION
    SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a
), class AS (
    SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, coalesce(sets.n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id, doc_id = coalesce(component_id, doc_id) AS kept
FROM doc LEFT JOIN sets USING (doc_id) LEFT JOIN rep USING (digest) LEFT JOIN class ON class.id = rep.id
"""

MATCHES = "\n    UNION ALL\n".join(
    f"    SELECT doc_id, {rank} AS rank, '{rule.kind}' AS kind,"
    f" string_split(regexp_replace(text, {quoted(rule.pattern)}, {MARK} || '\\0' || {MARK}, 'g'), {MARK}) AS pieces FROM texts"
    for rank, rule in enumerate(RULES)
)
MEASURES = " ".join(
    f"WHEN {rank} THEN length({f'regexp_extract(piece, {quoted(rule.pattern)}, {rule.group})' if rule.group else 'piece'}) >= {rule.least}" for rank, rule in enumerate(RULES)
)

SECRETS = f"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS text FROM documents
), cut AS (
{MATCHES}
), piece AS (
    SELECT doc_id, rank, kind, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS n FROM cut WHERE len(pieces) > 1
), placed AS (
    SELECT *, sum(length(piece)) OVER (PARTITION BY doc_id, rank ORDER BY n) AS upto FROM piece
), span AS (
    SELECT doc_id, rank, kind, upto - length(piece) AS start, upto AS finish FROM placed WHERE n % 2 = 0 AND CASE rank {MEASURES} END
), listed AS (
    SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
           string_agg(kind || ':' || start || ':' || finish, ',' ORDER BY start, rank) FILTER (kind IN ('assign', 'access', 'hex')) AS base,
           string_agg(kind || ':' || start || ':' || finish, ',' ORDER BY start, rank) AS spans
    FROM span GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN listed USING (doc_id)
"""

RELATIVE_DEDUP = r"""
WITH doc AS (
    SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents
), starts AS (
    SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS start FROM doc WHERE len(words) >= 20
), windows AS (
    SELECT doc_id, start, md5(array_to_string(words[start:start + 19], ' ')) AS digest FROM starts
), again AS (
    SELECT doc_id, start FROM windows QUALIFY row_number() OVER (PARTITION BY digest ORDER BY doc_id, start) > 1
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(start, start + 20)) AS place FROM again
), place AS (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM doc
), kept AS (
    SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY place) AS words FROM place ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, CAST(len(doc.words) AS BIGINT) AS n_words, CAST(len(doc.words) - coalesce(n_kept, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.words, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)
"""

#: crc32 of distinct words, byte by byte over a table made by its rule; gains of buckets; the drawn tenth by one sort.
IMPORTANCE = rf"""
WITH doc AS (
    SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words FROM documents
), source AS (
    SELECT doc_id, unnest(words) AS word FROM doc
), target AS (
    SELECT unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark
), crc AS (
    SELECT list(list_reduce([CAST(i AS UBIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS steps
    FROM range(256) r(i)
), word AS (
    SELECT word, hex(encode(word)) AS code FROM (SELECT word FROM source UNION SELECT word FROM target)
), hashed AS (
    SELECT word, xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), list_transform(range(1, length(code), 2), lambda i: CAST('0x' || code[i:i + 1] AS UBIGINT))),
                                 lambda c, b: xor(steps[CAST(xor(c, b) & 255 AS BIGINT) + 1], c >> 8)), CAST(4294967295 AS UBIGINT)) % 10000 AS bucket
    FROM word, crc
), held AS (
    SELECT bucket, count(*) AS n FROM source JOIN hashed USING (word) GROUP BY bucket
), wanted AS (
    SELECT bucket, count(*) AS n FROM target JOIN hashed USING (word) GROUP BY bucket
), gain AS (
    SELECT bucket, CAST(floor(1000 * ln((coalesce(wanted.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM held) + 10000)::DOUBLE
        / ((held.n + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM wanted) + 10000)::DOUBLE))) AS BIGINT) AS gain
    FROM held LEFT JOIN wanted USING (bucket)
), weighed AS (
    SELECT doc_id, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight FROM source JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY doc_id
), scored AS (
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
        + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('2024:' || doc_id)[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
    FROM doc LEFT JOIN weighed USING (doc_id)
), drawn AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank FROM scored LEFT JOIN drawn USING (doc_id)
"""

ORACLES: dict[str, str] = {
    "op2_decontaminate": DECONTAMINATE,
    "op3_near_dup": NEAR_DUP,
    "op8_secrets": SECRETS,
    "op10_relative_dedup": RELATIVE_DEDUP,
    "op12_importance": IMPORTANCE,
}
