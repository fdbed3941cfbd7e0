"""SQL for the queries of this package that SQL can express."""

from __future__ import annotations

OP2 = r"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, 2.0::DOUBLE * sum(size) AS cap,
    row_number() OVER (ORDER BY source IS NULL, source) AS place
  FROM sizes GROUP BY source
), weighed AS (
  SELECT *, [3, 1, 2][(place - 1) % 3 + 1]::DOUBLE AS weight FROM sources
), levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (
      ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
), targets AS (
  SELECT source, source_size, place, least(cap, max(level) OVER () * weight) AS target,
    greatest(1, ceil(sqrt(source_size / 1024)))::BIGINT AS shards FROM levels
), seats AS (
  SELECT place, target, unnest(range(1, ceil(target / 8)::BIGINT + 3)) AS k FROM targets WHERE target > 0
), quotas AS (
  SELECT place, count(*) AS quota FROM (
    SELECT place, row_number() OVER (ORDER BY target / (2 * k - 1) DESC, place) AS r FROM seats)
  WHERE r <= (SELECT round(sum(target) / 8) FROM targets) GROUP BY place
), dealt AS (
  SELECT s.*, t.*, coalesce(q.quota, 0) AS quota,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':42'), 1, 12))::BIGINT AS ord
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source LEFT JOIN quotas q USING (place)
), lined AS (
  SELECT *, ord % shards AS shard,
    sum(size) OVER (PARTITION BY place, ord % shards ORDER BY ord, doc_id, size ROWS UNBOUNDED PRECEDING) AS e
  FROM dealt
), shard_words AS (
  SELECT place, shard, sum(size) AS words, any_value(quota) AS seats FROM lined GROUP BY place, shard
), shard_seats AS (
  SELECT place, shard, words, seats, row_number() OVER (PARTITION BY place ORDER BY words / (2 * k - 1) DESC, shard) AS r
  FROM (SELECT *, unnest(range(1, ceil(seats * words / sum(words) OVER (PARTITION BY place))::BIGINT + 3)) AS k
        FROM shard_words WHERE words > 0)
), shard_quotas AS (
  SELECT place, shard, any_value(words) AS words, ceil(any_value(words) / 8)::BIGINT AS n,
    least(count(*) FILTER (r <= seats), 2 * ceil(any_value(words) / 8))::BIGINT AS given
  FROM shard_seats GROUP BY place, shard
), runs AS (
  SELECT *, given // n AS copies, given % n AS rest,
    ('0x' || substr(md5(place || ':' || shard || ':42'), 1, 12))::BIGINT % n AS first
  FROM shard_quotas
)
SELECT doc_id, size, source_size, target, (coalesce(copies * size
    + greatest(0, least(e, least((first + rest) * 8, words)) - greatest(e - size, first * 8))
    + greatest(0, least(e, greatest(0, first + rest - n) * 8) - (e - size)), 0))::BIGINT AS taken
FROM lined LEFT JOIN runs USING (place, shard)
"""

# Per turn 33 characters of the template, and one for each escape.
OP7 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, 33 + length(role) + length(text) + list_sum([
    (length(x) - length(replace(x, c, ''))) // length(c)
    FOR c IN ['\', '<|', '<s>', '</s>', '[INST]', '[/INST]', '<<SYS>>', '<</SYS>>']]) AS chars
  FROM (SELECT *, role || chr(10) || text AS x FROM turns)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""



def _op12(k: int = 8, rounds: int = 10, size: int = 64, seed: int = 3, scale: int = 1024) -> str:
    """k-means unrolled: c0 the first centroids, aN every vector with its nearest of cN, cN+1 the moved ones."""
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c, v
  FROM kept ORDER BY sha256('{seed}:' || vec_id) LIMIT {k}
)"""
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (
  SELECT r, min(d) AS d, arg_min(c, d * {k} + c) AS c FROM (
    SELECT r, c, list_sum(list_transform(list_zip(kept.v, c{i}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
    FROM kept CROSS JOIN c{i}) GROUP BY r
)"""
        )
        if i < rounds:
            steps.append(
                f"""c{i + 1} AS MATERIALIZED (
  SELECT c{i}.c, coalesce(m.v, c{i}.v) AS v FROM c{i} LEFT JOIN (
    SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS v FROM (
      SELECT c, j, sum(x) AS s, count(*) AS n FROM (
        SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM kept JOIN a{i} USING (r)) GROUP BY c, j) GROUP BY c
  ) m USING (c)
)"""
            )
    return f"""WITH {", ".join(steps)}
SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
FROM kept JOIN a{rounds} USING (r) JOIN c{rounds} USING (c)
"""


# CRC-32 bit by bit over the bytes of each distinct word.
OP13 = r"""
WITH steps AS (
  SELECT list(v ORDER BY b) AS steps FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, i: xor(c >> 1, (c & 1) * 3988292384)) AS v FROM range(256) t(b))
), texts AS (
  SELECT 0 AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark
), cut AS (
  SELECT kind, id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words FROM texts
), words AS (
  SELECT kind, id, unnest(words) AS word FROM cut
), hashed AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(octet_length(encode(word))),
      lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, steps[xor(c & 255, b) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM words), steps
), counts AS (
  SELECT bucket, count(*) FILTER (kind = 0) AS s, count(*) FILTER (kind = 1) AS t FROM words JOIN hashed USING (word) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * ((SELECT sum(s) FROM counts) + 10000)::DOUBLE)
    / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counts) + 10000)::DOUBLE)))::BIGINT AS gain FROM counts
), weighed AS (
  SELECT id, count(*) AS n, floor(sum(gain) / count(*))::BIGINT AS weight
  FROM words JOIN hashed USING (word) JOIN gains USING (bucket) WHERE kind = 0 GROUP BY id
), scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM documents LEFT JOIN weighed ON doc_id = id
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""

SQL: dict[str, str] = {"op2_mixing": OP2, "op7_chat": OP7, "op12_centroids": _op12(), "op13_resampling": OP13}
