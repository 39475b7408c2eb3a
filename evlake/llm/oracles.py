"""SQL of the larger training-data queries."""

TRIE_SQL = r"""
WITH own AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL),
-- CRC-32, bit by bit.
h AS (
  SELECT c, c - c % 20 AS base,
         xor(list_reduce(list_prepend(4294967295, [ascii(x)::BIGINT FOR x IN string_split(c::VARCHAR, '')]),
           LAMBDA crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
             LAMBDA v, k: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT c FROM own)),
built AS (
  SELECT h.c, own.i - 4 AS place, own.role, own.text FROM h JOIN own ON own.c = h.base AND own.i < h.h
  UNION ALL
  SELECT h.c, own.i, own.role, own.text FROM h JOIN own ON own.c = h.c AND own.i >= h.h),
named AS (
  SELECT c, text, md5(length(role) || ':' || role || text) AS m,
         row_number() OVER (PARTITION BY c ORDER BY place) AS d FROM built),
path AS (
  SELECT c, d, text, md5(array_to_string(list(m) OVER (PARTITION BY c ORDER BY d), '')) AS p FROM named
  UNION ALL SELECT c, 0, '', '' FROM h),
top AS (SELECT c, max(d) AS d FROM path GROUP BY c),
node AS (
  SELECT p, path.d AS d, min(c) AS c, count(*) AS n,
         (count(*) - 1) * any_value(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))) AS saved,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (top.d = path.d), '')) AS ends
  FROM path JOIN top USING (c) GROUP BY p, path.d),
up AS (
  SELECT n.p, a.p AS parent, b.c AS parent_conv FROM node n
  LEFT JOIN path a ON a.c = n.c AND a.d = n.d - 1 LEFT JOIN node b ON b.p = a.p AND b.d = a.d),
kids AS (SELECT parent AS p, count(*) AS k FROM up WHERE parent IS NOT NULL GROUP BY ALL),
below AS (
  SELECT a.p, sum(CASE WHEN kids.k IS NULL THEN 1 ELSE 0 END) AS leaves, sum(n.saved) AS saved
  FROM node n JOIN path a ON a.c = n.c AND a.d <= n.d LEFT JOIN kids ON kids.p = n.p GROUP BY a.p)
SELECT node.c AS conv_id, node.d AS depth, up.parent_conv AS parent_conv_id, node.n AS n_convs,
       coalesce(kids.k, 0) AS n_children, below.leaves::BIGINT AS n_leaves, below.saved::BIGINT AS saved_tokens,
       node.ends AS ends_sha256
FROM node JOIN up USING (p) LEFT JOIN kids USING (p) JOIN below USING (p)
"""


def cluster_sql(width: int = 64, k: int = 8, rounds: int = 10, seed: int = 3, scale: int = 1024) -> str:
    """The clustering round by round. All sums and products of the integers are exact
    in doubles."""
    steps = []
    for n in range(rounds + 1):
        steps.append(f"""
a{n} AS MATERIALIZED (
  SELECT row, vec_id, v, arg_min(no, d * {k} + no) AS no, min(d) AS d
  FROM (SELECT row, vec_id, v, c.no, list_inner_product(v, v) - 2 * list_inner_product(v, c.c) + list_inner_product(c.c, c.c) AS d
        FROM v CROSS JOIN c{n} c) GROUP BY row, vec_id, v)""")
        if n < rounds:
            steps.append(f"""
m{n} AS (
  SELECT no, list(f ORDER BY i) AS c FROM (
    SELECT no, i, floor(sum(v[i]) / count(*)) AS f FROM a{n}, range(1, {width + 1}) t(i) GROUP BY no, i) GROUP BY no),
c{n + 1} AS MATERIALIZED (SELECT c{n}.no, coalesce(m{n}.c, c{n}.c) AS c FROM c{n} LEFT JOIN m{n} USING (no))""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, [floor({scale} * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) = {width} AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {width}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, v) - 1 AS no, v AS c FROM v
  QUALIFY no < {k}),{",".join(steps)}
SELECT vec_id, no::INTEGER AS cluster, d::BIGINT AS distance, sum(d::BIGINT) OVER (PARTITION BY no)::BIGINT AS cluster_inertia,
       sum(d::BIGINT) OVER ()::BIGINT AS inertia,
       sha256(array_to_string([x::BIGINT FOR x IN c{rounds}.c], ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (no)
"""


NEIGHBOUR_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)
    AND list_sum([x::DOUBLE * x FOR x IN embedding]) > 0),
e AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
r AS (SELECT a AS node, a AS reach FROM e UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.reach),
c AS (SELECT node, min(reach) AS root FROM r GROUP BY node),
n AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, coalesce(c.root, vec_id) AS component_id,
       vec_id = coalesce(c.root, vec_id) AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.node = vec_id
"""
