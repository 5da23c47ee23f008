"""DuckDB SQL of the queries that SQL can express.

``op8``: DuckDB has no crc32 function, so its checksum is computed from the
text's bytes by a table of the 256 remainders, built in SQL."""

from __future__ import annotations

from tablewright.llm.quality_rules import RULES, STOP_WORDS

_STOP = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
_BROKEN = ", ".join(
    "CASE WHEN " + " OR ".join([f"{n} < {lo}"] * (lo is not None) + [f"{n} > {hi}"] * (hi is not None)) + f" THEN '{n}' END"
    for n, lo, hi in RULES)

OP4 = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
tri AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
        FROM (SELECT r, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM w WHERE len(ws) >= 3)),
rep AS (SELECT r, count(DISTINCT j) AS n FROM
          (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM
             (SELECT *, count(*) OVER (PARTITION BY r, g) AS c FROM tri) WHERE c > 1) GROUP BY r),
c AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words,
        length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
        coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(ls) AS n_lines,
        length(regexp_replace(t, '[^\\p{{L}}]+', '', 'g')) AS n_letters,
        length(regexp_replace(t, '[^\\p{{Lu}}]+', '', 'g')) AS n_upper,
        len(list_filter(ws, lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') IN ({_STOP}))) AS n_stop,
        len(list_filter(ls, lambda x: regexp_matches(ltrim(x, ' '), '^[-*•]'))) AS n_bullet,
        len(list_filter(ls, lambda x: regexp_matches(x, '(\\.\\.\\.|…)\\s*$'))) AS n_ellipsis
      FROM w LEFT JOIN rep USING (r)),
m AS (SELECT *,
        CASE WHEN n_words = 0 THEN 0 ELSE word_chars::DOUBLE / n_words END AS mean_word_chars,
        CASE WHEN n_words = 0 THEN 0 ELSE n_repeat_words::DOUBLE / n_words END AS repeat_word_ratio,
        CASE WHEN n_words = 0 THEN 0 ELSE n_symbols::DOUBLE / n_words END AS symbol_word_ratio,
        CASE WHEN n_letters = 0 THEN 0 ELSE n_upper::DOUBLE / n_letters END AS upper_letter_ratio,
        CASE WHEN word_chars = 0 THEN 0 ELSE n_letters::DOUBLE / word_chars END AS letter_ratio,
        CASE WHEN n_words = 0 THEN 0 ELSE n_stop::DOUBLE / n_words END AS stop_word_ratio,
        CASE WHEN n_lines = 0 THEN 0 ELSE n_dup_lines::DOUBLE / n_lines END AS dup_line_ratio,
        CASE WHEN n_lines = 0 THEN 0 ELSE n_bullet::DOUBLE / n_lines END AS bullet_line_ratio,
        CASE WHEN n_lines = 0 THEN 0 ELSE n_ellipsis::DOUBLE / n_lines END AS ellipsis_line_ratio FROM c),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        array_to_string(list_filter([{_BROKEN}], lambda x: x IS NOT NULL), ',') AS failed_rules FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed_rules = '' AS kept, failed_rules FROM f
"""

OP8 = """
WITH RECURSIVE tab(i, v, k) AS (SELECT i, i::BIGINT, 0 FROM range(256) t(i)
             UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM tab WHERE k < 8),
tabs AS (SELECT list(v ORDER BY i) AS vs FROM tab WHERE k = 8),
crcs AS (SELECT text AS crc_text, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, bytes),
             lambda a, b: xor(a >> 8, vs[(xor(a, b) & 255) + 1]))) AS text_crc32
         FROM (SELECT DISTINCT text, list_transform(range(1, octet_length(encode(text)) + 1),
             lambda i: ('0x' || substr(hex(encode(text)), 2 * i - 1, 2))::BIGINT) AS bytes FROM documents), tabs),
d AS (SELECT doc_id, text, coalesce(octet_length(encode(text)), 0)::BIGINT + 1 AS size,
             ('0x' || substr(md5(coalesce(text, '')), 1, 15))::BIGINT AS h,
             ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS g FROM documents),
c AS (SELECT *, h >> 48 AS cell, coalesce(sum(size) OVER (ORDER BY h, g, doc_id NULLS FIRST
             RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS upto,
             sum(size) OVER () AS total, sum(size) OVER (PARTITION BY h, g, doc_id) AS own FROM d),
s AS (SELECT *, (SELECT count(*) FROM range(1, 8) k(k) WHERE upto - own >= total * k / 8.0::DOUBLE)::INT AS shard,
             greatest(1, ceil(count(*) OVER () / 1024.0))::BIGINT AS per FROM c),
p AS (SELECT *, g * ceil(count(*) OVER (PARTITION BY shard, cell) / per::DOUBLE)::BIGINT // 4294967296 AS part FROM s)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       (row_number() OVER (PARTITION BY shard ORDER BY cell, part, h, g, doc_id NULLS FIRST) - 1)::BIGINT AS slot,
       NULL::INT AS grown_shard
FROM p LEFT JOIN crcs ON text IS NOT DISTINCT FROM crc_text
"""

OP13 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         coalesce(list_sum(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2])), 0)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (SELECT p.anchor_id, positive_id, s.other_id AS negative_id, positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other_id)::INT AS rank
      FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
       AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

OP11 = """
WITH RECURSIVE tab(i, v, k) AS (SELECT i, i::BIGINT, 0 FROM range(256) t(i)
             UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM tab WHERE k < 8),
tabs AS (SELECT list(v ORDER BY i) AS vs FROM tab WHERE k = 8),
t AS (SELECT conv_id, sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS turn_key,
             length(coalesce(text, ''))::BIGINT AS size,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, n, conv_id - conv_id % 100 AS base,
             xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                 lambda a, b: xor(a >> 8, vs[(xor(a, b) & 255) + 1]))) % 6 AS h
      FROM (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id), tabs),
r AS (SELECT c.conv_id, least(c.h, coalesce(b.n, 0)) AS taken, c.h, c.base, least(c.h, coalesce(b.n, 0)) + greatest(c.n - c.h, 0) AS length
      FROM c LEFT JOIN c b ON b.conv_id = c.base),
turns AS (SELECT r.conv_id, t.i - r.h + r.taken AS place, r.length, turn_key, size FROM r JOIN t ON t.conv_id = r.conv_id AND t.i > r.h
          UNION ALL SELECT r.conv_id, t.i, r.length, turn_key, size FROM r JOIN t ON t.conv_id = r.base AND t.i <= r.taken),
walked AS (SELECT conv_id, place, length, size,
                  md5(array_to_string(list(turn_key) OVER (PARTITION BY conv_id ORDER BY place), ',')) AS node FROM turns
           UNION ALL SELECT conv_id, 0, length, 0, 'root' FROM r),
linked AS (SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY place) AS parent FROM walked),
nodes AS (SELECT node, min(conv_id) AS conv_id, min(place) AS depth, any_value(parent) AS parent, count(*) AS n_convs,
                 (count(*) - 1) * min(size) AS weight,
                 sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (place = length), '')) AS ends_sha256
          FROM linked GROUP BY node),
kids AS (SELECT parent, count(*) AS n FROM nodes GROUP BY parent),
under AS (SELECT w.node, sum(n.weight) AS saved, count(*) FILTER (k.n IS NULL) AS leaves
          FROM nodes n LEFT JOIN kids k ON k.parent = n.node
          JOIN walked w ON w.conv_id = n.conv_id AND w.place <= n.depth GROUP BY w.node)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children,
       u.leaves AS n_leaves, u.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN under u USING (node) LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN kids k ON k.parent = n.node
"""
