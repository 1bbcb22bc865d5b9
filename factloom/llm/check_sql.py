"""Checking SQL that is long or made from a rule."""

from __future__ import annotations

#: A-Z in lower case, letters U+00C0 to U+00FF as they are.
_LOWER = "translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: CRC-32 of UTF-8 text (letters up to U+00FF) byte by byte; near words by patterns with one letter left out.
VARIANTS_SQL = f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce([b] || range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps),
found AS (
  SELECT doc_id, {_LOWER} AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(list_reduce([4294967295] || flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
      lambda ch: CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT] ELSE [192 + (unicode(ch) >> 6), 128 + (unicode(ch) & 63)] END)),
    lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM found, crc),
words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
without AS MATERIALIZED (
  SELECT word, n, i, left(word, i - 1) AS head, substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM without a JOIN without b ON a.i = b.i AND a.head = b.head AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM without a JOIN words b ON a.head || a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM without a JOIN words b ON a.head || a.rest = b.word),
best AS (
  SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS r FROM pairs),
forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form,
    CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word AND r = 1),
walk AS (
  SELECT word, word AS spot, 0 AS steps FROM forms
  UNION ALL SELECT k.word, f.form, k.steps + 1 FROM walk k JOIN forms f ON k.spot = f.word WHERE f.form IS NOT NULL),
ends AS (SELECT word, max_by(spot, steps) AS root FROM walk GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)"""


def centroids_sql(components: int = 64, k: int = 8, rounds: int = 10, scale: int = 1024, seed: int = 3) -> str:
    """Every round as two steps: the nearest centroid of each vector, and the floors of the means."""
    steps = [
        f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = {components} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {components})""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), x) - 1 AS c, x FROM v WHERE vec_id IS NOT NULL ORDER BY c LIMIT {k})""",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (
  SELECT r, vec_id, v.x, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT r, vec_id, v.x, c, list_sum(list_transform(list_zip(v.x, c{i}.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM v, c{i}) v
  GROUP BY r, vec_id, v.x)"""
        )
        if i < rounds:
            steps.append(
                f"""c{i + 1} AS MATERIALIZED (
  SELECT old.c, coalesce(new.x, old.x) AS x FROM c{i} old LEFT JOIN (
    SELECT c, list(m ORDER BY j) AS x FROM (
      SELECT c, j, ((sum(e) - ((sum(e) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS m
      FROM (SELECT c, unnest(x) AS e, generate_subscripts(x, 1) AS j FROM a{i}) GROUP BY c, j) GROUP BY c) new ON old.c = new.c)"""
            )
    return f"""WITH {', '.join(steps)}
SELECT vec_id, a.c::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(z.x, ',')) AS centroid_sha256 FROM a{rounds} a JOIN c{rounds} z ON a.c = z.c"""


CENTROIDS_SQL = centroids_sql()
