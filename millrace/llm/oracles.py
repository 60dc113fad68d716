"""The same results as SQL for another engine, where SQL can say them."""

from millrace.llm import licenses


def _license_sql() -> str:
    line = "trim(regexp_replace(l, '[^0-9a-z\\x{80}-\\x{10FFFF}]+', ' ', 'g'))"
    for raw, same in licenses.SPELLINGS:
        line = f"regexp_replace({line}, '(^| ){raw}', '\\1{same}', 'g')"
    known = ", ".join(f"('{d}', '{n}')" for d, n in licenses.known_digests())
    return f"""
        WITH known(digest, license) AS (VALUES {known}
        ), lined AS (
            SELECT row_number() OVER () AS r, doc_id, [x FOR x IN [{line} FOR l IN string_split(translate(coalesce(text, ''),
                '{licenses.UPPER}', '{licenses.LOWER}'), chr(10)) IF NOT regexp_matches(l, '^ *(copyright|\\(c\\)|\\x{{A9}})')] IF x <> ''] AS lines
            FROM documents
        ), whole AS (SELECT r, doc_id, lines, sha256(coalesce(array_to_string(lines, ' '), '')) AS digest FROM lined
        ), found AS (
            SELECT DISTINCT r, license FROM (SELECT r, sha256(unnest(lines)) AS digest FROM lined) JOIN known USING (digest)
        ), named AS (SELECT r, count(*) AS n, string_agg(license, ',' ORDER BY license) AS names FROM found GROUP BY r)
        SELECT doc_id, digest, license, coalesce(n, 0) AS n_notices, coalesce(names, '') AS notices
        FROM whole LEFT JOIN known USING (digest) LEFT JOIN named USING (r)"""


ORACLES = {
    "op4_license_scan": _license_sql(),
    "op2_chat_examples": r"""
        WITH given AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ), sized AS (
            SELECT *, 5 + length(role) + length(text) + length(regexp_replace(role, '[^\\#<:]', '', 'g'))
                + length(regexp_replace(text, '[^\\#<]', '', 'g')) + 1 + 8 AS chars
            FROM given
        ), whole AS (
            SELECT conv_id, count(*) AS n_turns,
                string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
                coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS trained,
                sum(chars) AS formatted_chars, count(*) FILTER (role = 'assistant') AS n_examples
            FROM sized GROUP BY conv_id
        )
        SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(trained) AS loss_chars, sha256(trained) AS loss_sha256,
            CAST(formatted_chars AS BIGINT) AS formatted_chars, n_examples
        FROM whole""",
    "op5_decontamination": r"""
        WITH item AS (
            SELECT CAST(item_id AS VARCHAR) AS item_id,
                regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark
        ), sized AS (SELECT item_id, w, least(len(w), 10) AS size FROM item WHERE len(w) > 0
        ), grams AS (
            SELECT DISTINCT item_id, size, list_slice(w, i, i + size - 1) AS gram
            FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM sized)
        ), doc AS (
            SELECT row_number() OVER () AS r, doc_id,
                coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
            FROM documents
        ), windows AS (
            SELECT r, size, i, list_slice(w, i, i + size - 1) AS gram
            FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i
                FROM doc, (SELECT DISTINCT size FROM grams) WHERE len(w) >= size)
        ), hits AS (SELECT r, i, windows.size, item_id FROM windows JOIN grams USING (size, gram)
        ), covered AS (
            SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS p FROM hits) GROUP BY r
        ), named AS (
            SELECT r, count(item_id) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
            FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc LEFT JOIN covered USING (r) LEFT JOIN named USING (r)""",
    "op12_importance_resampling": r"""
        WITH crc_table AS (  -- eight halvings of each byte
            SELECT list(c ORDER BY b) AS t FROM (SELECT b, list_reduce(range(8), lambda c, k:
                CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) AS c FROM range(256) AS r(b))
        ), source AS (
            SELECT row_number() OVER () AS r, doc_id,
                coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
            FROM documents
        ), source_words AS (SELECT r, unnest(w) AS word FROM source
        ), target_words AS (
            SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
            FROM benchmark
        ), source_counts AS (SELECT word, count(*) AS n FROM source_words GROUP BY word
        ), target_counts AS (SELECT word, count(*) AS n FROM target_words GROUP BY word
        ), coded AS (
            SELECT word, hex(encode(word)) AS code FROM (SELECT word FROM source_counts UNION SELECT word FROM target_counts)
        ), hashed AS (
            SELECT word, xor(list_reduce([CAST('0x' || substr(code, 2 * i + 1, 2) AS BIGINT) FOR i IN range(length(code) // 2)],
                lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]), 4294967295), 4294967295) % 10000 AS bucket
            FROM coded, crc_table
        ), totals AS (
            SELECT bucket, sum(coalesce(s.n, 0)) AS s, sum(coalesce(t.n, 0)) AS t
            FROM hashed LEFT JOIN source_counts AS s USING (word) LEFT JOIN target_counts AS t USING (word) GROUP BY bucket
        ), gains AS (
            SELECT bucket, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * ((SELECT sum(s) FROM totals) + 10000)
                / ((CAST(s AS DOUBLE) + 1) * ((SELECT sum(t) FROM totals) + 10000)))) AS BIGINT) AS gain
            FROM totals
        ), weights AS (
            SELECT r, sum(gain) AS weight FROM source_words JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY r
        ), scored AS (
            SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
                CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
                    / 4294967296::DOUBLE))) AS BIGINT) AS score
            FROM source LEFT JOIN weights USING (r)
        ), ranked AS (
            SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS place,
                (SELECT 10 * count(*) // 100 FROM scored WHERE n_features >= 20) AS share
            FROM scored
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN place <= share THEN place END AS rank FROM ranked""",
    "op13_near_vectors": r"""
        WITH RECURSIVE given AS (
            SELECT row_number() OVER () AS r, vec_id, label, [CAST(x AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
        ), fit AS (
            SELECT r, vec_id, label, [x / sqrt(list_sum([y * y FOR y IN e])) FOR x IN e] AS u
            FROM given
            WHERE label IS NOT NULL AND len(e) > 0 AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0
                AND len([x FOR x IN e IF x <> 0]) > 0
        ), links AS (
            SELECT a.r AS a, b.r AS b, b.vec_id
            FROM fit AS a JOIN fit AS b ON a.label = b.label AND len(a.u) = len(b.u) AND a.r <> b.r
            WHERE list_dot_product(a.u, b.u) >= 0.93
        ), reached AS (
            SELECT r AS a, r AS b FROM given
            UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
        ), component AS (
            SELECT a AS r, min(vec_id) AS component_id FROM reached JOIN given ON reached.b = given.r GROUP BY a
        ), counts AS (SELECT a AS r, count(*) AS n_links FROM links GROUP BY a)
        SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
        FROM given JOIN component USING (r) LEFT JOIN counts USING (r)""",
}
