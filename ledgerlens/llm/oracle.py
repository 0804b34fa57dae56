"""DuckDB SQL of the registered queries, where SQL can express them."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op2_exact_dedup"] = r"""
WITH t AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), g AS (
    SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm
)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(norm) AS text_sha256
FROM t JOIN g USING (norm)
"""

# Sizes, targets by repeated filling, quotas by ranking every quotient, then the documents' stretches.
ORACLE["op9_mixing"] = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           ('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(md5(text), '')), 1, 15))::BIGINT AS ord
    FROM documents
), s AS (
    SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS i FROM (SELECT source, sum(size)::BIGINT AS words FROM d GROUP BY source)
), w AS (
    SELECT *, (CASE (i - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END)::DOUBLE AS weight FROM s
), fill AS (
    SELECT i, weight, 2.0::DOUBLE * words AS cap, false AS is_full, false AS was_full, 0 AS step, 1.5::DOUBLE * (SELECT sum(words) FROM w) AS total FROM w
    UNION ALL
    SELECT i, weight, cap, is_full OR weight * level >= cap, is_full, step + 1, total
    FROM (
        SELECT *, (total - coalesce(sum(cap) FILTER (is_full) OVER (), 0)) / sum(weight) FILTER (NOT is_full) OVER () AS level
        FROM fill
    )
    WHERE step = 0 OR step < 30
), done AS (
    SELECT i, weight, cap, is_full,
           (total - coalesce(sum(cap) FILTER (is_full) OVER (), 0)) / sum(weight) FILTER (NOT is_full) OVER () AS level
    FROM fill WHERE step = 30
), t AS (
    SELECT w.i, w.source, w.words, CASE WHEN is_full THEN cap ELSE level * w.weight END AS target,
           greatest(1, ceil(w.words / 2000000.0))::BIGINT AS shards
    FROM w JOIN done USING (i)
), seats AS (
    SELECT i, row_number() OVER (ORDER BY target / (2 * k - 1) DESC, i) AS r, target / (2 * k - 1) AS q
    FROM t, unnest(generate_series(1, 2 * (words // 64) + 200)) AS u(k)
), quota AS (
    SELECT i, count(*) AS seats FROM seats WHERE r <= (SELECT round(sum(target) / 64) FROM t) AND q > 0 GROUP BY i
), dealt AS (
    SELECT d.*, t.i, t.words, t.target, coalesce(seats, 0) AS seats, ord % shards AS shard
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN quota ON quota.i = t.i
), parts AS (
    SELECT i, shard, any_value(source) AS source, any_value(seats) AS seats, sum(size)::BIGINT AS part FROM dealt GROUP BY i, shard
), part_seats AS (
    SELECT i, shard, seats, row_number() OVER (PARTITION BY i ORDER BY part::DOUBLE / (2 * k - 1) DESC, shard) AS r
    FROM parts, unnest(generate_series(1, 2 * (part // 64) + 200)) AS u(k) WHERE part > 0
), part_quota AS (
    SELECT i, shard, count(*) AS seats FROM part_seats WHERE r <= seats GROUP BY i, shard
), plan AS (
    SELECT parts.i, parts.shard, greatest(1, ceil(part / 64.0))::BIGINT AS blocks,
           least(coalesce(part_quota.seats, 0), 2 * greatest(1, ceil(part / 64.0)))::BIGINT AS quota,
           ('0x' || substr(md5('42:' || coalesce(parts.source, '') || ':' || parts.shard), 1, 15))::BIGINT AS seeded
    FROM parts LEFT JOIN part_quota ON part_quota.i = parts.i AND part_quota.shard = parts.shard
), placed AS (
    SELECT dealt.*, sum(size) OVER (PARTITION BY i, shard ORDER BY ord, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS stop FROM dealt
), cut AS (
    SELECT placed.*, quota // blocks AS passes, seeded % blocks * 64 AS b, seeded % blocks * 64 + quota % blocks * 64 AS e, blocks * 64 AS around
    FROM placed JOIN plan ON placed.i = plan.i AND placed.shard = plan.shard
)
SELECT doc_id, size, words AS source_size, target,
       (passes * size + greatest(0, least(stop, e, around) - greatest(stop - size, b)) + greatest(0, least(stop, e - around) - (stop - size)))::BIGINT AS taken
FROM cut
"""

# One row per line, chunk numbers by a running count of the boundaries before.
ORACLE["op8_line_chunks"] = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text, md5(coalesce(text, '')) AS seal FROM documents
), l AS (
    SELECT doc_id, seal, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
    FROM (SELECT DISTINCT * FROM d)
), h AS (
    SELECT *, ('0x' || substr(md5(line), 1, 7))::BIGINT AS h FROM l
), b AS (
    SELECT *, CASE WHEN (h + 31 * coalesce(lag(h) OVER w, 0)) % 2 = 0 THEN 1 ELSE 0 END AS stop FROM h WINDOW w AS (PARTITION BY doc_id, seal ORDER BY i)
), n AS (
    SELECT *, coalesce(sum(stop) OVER (PARTITION BY doc_id, seal ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM b
), c AS (
    SELECT doc_id, seal, chunk, min(i) AS start, count(*) AS lines, string_agg(line, chr(10) ORDER BY i) AS body FROM n GROUP BY doc_id, seal, chunk
), r AS (
    SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id NULLS LAST, seal, start) > 1 AND lines >= 2 AS gone FROM c
), t AS (
    SELECT doc_id, seal, string_agg(body, chr(10) ORDER BY start) FILTER (NOT gone) AS body, sum(lines) AS n_lines,
           coalesce(sum(lines) FILTER (gone), 0) AS removed_lines, count(*) FILTER (gone) AS removed_chunks
    FROM r GROUP BY doc_id, seal
)
SELECT d.doc_id, n_lines::BIGINT AS n_lines, removed_lines::BIGINT AS removed_lines, removed_chunks, sha256(coalesce(body, '')) AS text_sha256
FROM d JOIN t ON d.doc_id IS NOT DISTINCT FROM t.doc_id AND d.seal = t.seal
"""

# CRC-32 of each distinct word byte by byte, with the table of remainders made by eight halvings of each byte.
ORACLE["op11_importance"] = r"""
WITH t0 AS (
    SELECT list_transform(range(256), lambda b: list_reduce(
        list_concat([b], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS remainders
), d AS (
    SELECT 'documents' AS side, doc_id, text, row_number() OVER () AS r FROM documents
    UNION ALL SELECT 'benchmark', NULL, text, -row_number() OVER () FROM benchmark
), w AS (
    SELECT side, r, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
    FROM d
), n AS (
    SELECT side, r, word, count(*) AS n FROM w GROUP BY ALL
), c AS (
    SELECT word, xor(4294967295, list_reduce(
        list_concat([4294967295], list_transform(range(1, length(bits), 2), lambda i: ('0x' || substr(bits, i, 2))::BIGINT)),
        lambda c, b: xor(c >> 8, remainders[1 + (xor(c, b) & 255)]))) % 10000 AS bucket
    FROM (SELECT word, hex(encode(word)) AS bits FROM (SELECT DISTINCT word FROM n)), t0
), counts AS (
    SELECT bucket, sum(n) FILTER (side = 'documents') AS s, sum(n) FILTER (side = 'benchmark') AS t FROM n JOIN c USING (word) GROUP BY bucket
), gains AS (
    SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (total_s + 10000)::DOUBLE / ((coalesce(s, 0) + 1)::DOUBLE * (total_t + 10000)::DOUBLE)))::BIGINT AS gain
    FROM counts, (SELECT coalesce(sum(s), 0) AS total_s, coalesce(sum(t), 0) AS total_t FROM counts)
), weights AS (
    SELECT r, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS gained FROM n JOIN c USING (word) JOIN gains USING (bucket) GROUP BY r
), scores AS (
    SELECT doc_id, r, coalesce(n_features, 0) AS n_features,
           CASE WHEN n_features > 0 THEN (gained - ((gained % n_features) + n_features) % n_features) // n_features ELSE 0 END AS weight,
           floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS noise
    FROM d LEFT JOIN weights USING (r) WHERE side = 'documents'
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY weight + noise DESC, doc_id NULLS LAST) AS place,
           10 * count(*) OVER (PARTITION BY n_features >= 20) // 100 AS drawn
    FROM scores
)
SELECT doc_id, n_features, weight, weight + noise AS score, CASE WHEN n_features >= 20 AND place <= drawn THEN place END AS rank FROM ranked
"""
