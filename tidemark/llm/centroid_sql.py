"""DuckDB SQL for the rows of ``op12_centroids``: one pair of CTEs per round."""

DIMS, K, ROUNDS = 64, 40, 5

_HEAD = """
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS i, vec_id, embedding AS e FROM embeddings
  WHERE len(embedding) = %d AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
points AS MATERIALIZED (
  SELECT i, d, CAST(floor(256 * CAST(e[d] AS DOUBLE)) AS HUGEINT) AS x
  FROM kept, (SELECT unnest(range(1, %d)) AS d)),
start AS (
  SELECT i, CAST(row_number() OVER (ORDER BY sha256('2:' || vec_id), e) - 1 AS INTEGER) AS c
  FROM kept WHERE vec_id IS NOT NULL QUALIFY c < %d),
c0 AS MATERIALIZED (SELECT s.c, p.d, p.x FROM start s JOIN points p ON p.i = s.i)""" % (DIMS, DIMS + 1, K)

_NEAREST = """
a{r} AS MATERIALIZED (
  SELECT i, c, dist FROM (
    SELECT p.i, k.c, sum((p.x - k.x) * (p.x - k.x)) AS dist
    FROM points p JOIN c{r} k ON p.d = k.d GROUP BY p.i, k.c)
  QUALIFY row_number() OVER (PARTITION BY i ORDER BY dist, c) = 1)"""

_MEANS = """
c{n} AS MATERIALIZED (
  SELECT k.c, k.d, coalesce(m.x, k.x) AS x FROM c{r} k LEFT JOIN (
    SELECT a.c, p.d, CAST((sum(p.x) - (((sum(p.x) % count(*)) + count(*)) % count(*))) // count(*) AS HUGEINT) AS x
    FROM a{r} a JOIN points p ON p.i = a.i GROUP BY a.c, p.d) m ON m.c = k.c AND m.d = k.d)"""

_TAIL = """,
digest AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS h FROM c{r} GROUP BY c),
inner_sum AS (SELECT c, sum(dist) AS s FROM a{r} GROUP BY c)
SELECT v.vec_id, a.c AS cluster, CAST(a.dist AS BIGINT) AS distance, CAST(s.s AS BIGINT) AS cluster_inertia,
       CAST((SELECT sum(dist) FROM a{r}) AS BIGINT) AS inertia, g.h AS centroid_sha256
FROM a{r} a JOIN kept v ON v.i = a.i JOIN inner_sum s ON s.c = a.c JOIN digest g ON g.c = a.c
""".format(r=ROUNDS)

SQL = ",".join([_HEAD] + [part.format(r=r, n=r + 1) for r in range(ROUNDS) for part in (_NEAREST, _MEANS)]
               + [_NEAREST.format(r=ROUNDS)]) + _TAIL
