"""DuckDB SQL of the training-data operators that SQL can express."""

from __future__ import annotations


def _clustering(k: int = 16, rounds: int = 3) -> str:
    """Every vector against every centroid, round by round."""
    ctes = [
        """kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE len(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))))""",
        f"""c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c, q FROM kept QUALIFY c < {k})"""]
    for i in range(rounds + 1):
        ctes.append(f"""a{i} AS (
  SELECT vec_id, any_value(k.q) AS q,
         min({{'d': list_sum(list_transform(list_zip(k.q, c.q), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 'c': c}}) AS m
  FROM kept k CROSS JOIN c{i} c GROUP BY vec_id)""")
        if i < rounds:
            ctes.append(f"""s{i} AS (
  SELECT m.c AS c, i, sum(q[i]) AS s, count(*) AS n FROM a{i}, (SELECT unnest(range(1, 65)) AS i) GROUP BY 1, 2)""")
            ctes.append(f"""c{i + 1} AS (
  SELECT c.c, coalesce(m.q, c.q) AS q FROM c{i} c
  LEFT JOIN (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS q FROM s{i} GROUP BY c) m USING (c))""")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT vec_id, CAST(c.c AS INTEGER) AS cluster, CAST(m.d AS BIGINT) AS distance,
       CAST(sum(m.d) OVER (PARTITION BY c.c) AS BIGINT) AS cluster_inertia, CAST(sum(m.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.m.c = c.c"""


CLUSTERING = _clustering()

#: crc32 bit by bit; nodes are named by the 32 hexadecimal digits of each of their turns.
PREFIX_TRIE = """
WITH ids AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, k) AS d, k, n FROM (
    SELECT conv_id AS c, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))[1:32] AS k, length(coalesce(text, '')) AS n
    FROM conversations WHERE conv_id IS NOT NULL)),
heads AS (
  SELECT c, c - c % 100 AS base, xor(4294967295, list_reduce(
    list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
    lambda a, b: list_reduce(list_concat([xor(a, b)], CAST(range(8) AS BIGINT[])), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 6 AS h FROM ids),
whole AS (
  SELECT h.c, o.d, o.k, o.n FROM heads h JOIN own o ON o.c = h.base AND o.d <= h.h
  UNION ALL SELECT h.c, o.d, o.k, o.n FROM heads h JOIN own o ON o.c = h.c AND o.d > h.h),
turns AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY d) AS d, k, n FROM whole),
prefixes AS (
  SELECT c, d, n, string_agg(k, '') OVER (PARTITION BY c ORDER BY d) AS p FROM turns
  UNION ALL SELECT c, 0, 0, '' FROM ids),
nodes AS (SELECT p, d, min(c) AS conv_id, count(*) AS n_convs, any_value(n) AS n FROM prefixes GROUP BY p, d),
children AS (SELECT left(p, 32 * (d - 1)) AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
ends AS (
  SELECT p, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS s
  FROM (SELECT c, arg_max(p, d) AS p FROM prefixes GROUP BY c) GROUP BY p),
below AS (
  SELECT left(p, 32 * a) AS p, sum(CASE WHEN n_children IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * n) AS saved
  FROM (SELECT n.*, c.n_children, unnest(range(0, n.d + 1)) AS a FROM nodes n LEFT JOIN children c USING (p)) GROUP BY 1)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children,
       CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, coalesce(e.s, sha256('')) AS ends_sha256
FROM nodes n JOIN below b USING (p) LEFT JOIN children c USING (p) LEFT JOIN ends e USING (p)
LEFT JOIN nodes up ON n.d > 0 AND up.p = left(n.p, 32 * (n.d - 1))
"""

#: All pairs of usable vectors; rows are numbered, since ids may repeat.
NEAR_DEDUP = """
WITH RECURSIVE rows AS (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings),
usable AS (
  SELECT r, CAST(embedding AS DOUBLE[]) AS v FROM rows
  WHERE list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
links AS (
  SELECT a.r AS a, b.r AS b FROM usable a JOIN usable b ON a.r <> b.r AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reach(a, b) AS (SELECT r, r FROM rows UNION SELECT x.a, l.b FROM reach x JOIN links l ON x.b = l.a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a),
named AS (SELECT a, min(vec_id) AS component_id FROM reach JOIN rows ON rows.r = reach.b GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM rows JOIN named ON named.a = rows.r LEFT JOIN degree ON degree.a = rows.r
"""
