"""DuckDB SQL of the queries that SQL can express over whole tables."""

from __future__ import annotations

# A level of three children each; a source with more leaves than 3 ** LEVELS needs more.
LEVELS = 14

# CRC-32 of a short ASCII string, bit by bit (the polynomial is a fixed value).
_CRC = """list_reduce([4294967295]::BIGINT[] || list_transform(range(1, length(s) + 1), lambda i: ord(substr(s, i, 1))::BIGINT),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
                          lambda x, z: xor(x >> 1, 3988292384 * (x & 1))))"""


def _field(c: str) -> str:
    v = f"CAST({c} AS VARCHAR)"
    return f"coalesce(CAST(octet_length(encode({v})) AS VARCHAR) || ':' || {v}, '-')"


def _climb(name: str, level0: str, levels: int) -> str:
    """CTEs ``{name}0`` .. of ``(tree, pos, n, h)`` and the siblings ``{name}s`` of
    ``(tree, level, pos, before, after)``."""
    out, sib = [f"{name}0 AS ({level0})"], []
    for k in range(levels):
        out.append(f"""{name}{k + 1} AS (SELECT tree, pos // 3 AS pos, (n + 2) // 3 AS n,
  sha256(string_agg(h, '' ORDER BY pos)) AS h FROM {name}{k} WHERE n > 1 GROUP BY tree, pos // 3, n)""")
        sib.append(f"""SELECT tree, {k} AS level, pos,
  coalesce(string_agg(h, '' ORDER BY pos) OVER (PARTITION BY tree, pos // 3 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
  coalesce(string_agg(h, '' ORDER BY pos) OVER (PARTITION BY tree, pos // 3 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {name}{k} WHERE n > 1""")
    out.append(f"{name}s AS (" + " UNION ALL ".join(sib) + ")")
    tops = " UNION ALL ".join(f"SELECT tree, pos, h FROM {name}{k} WHERE n = 1" for k in range(levels + 1))
    out.append(f"{name}t AS ({tops})")
    return ",\n".join(out)


_HEAD = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))

OP11 = f"""
WITH RECURSIVE d AS (SELECT *, CAST(doc_id AS VARCHAR) AS s FROM documents),
leaf AS (
  SELECT doc_id, source, sha256({_HEAD} || {_field('text')}) AS h,
    CASE WHEN xor({_CRC}, 4294967295) % 2 = 0
         THEN sha256({_HEAD} || {_field("replace(text, chr(10), '')")}) ELSE sha256({_HEAD} || {_field('text')}) END AS bad
  FROM d),
rows_ AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n FROM leaf),
{_climb('low', 'SELECT tree, pos, n, h FROM rows_', LEVELS)},
{_climb('top', 'SELECT 0 AS tree, tree AS pos, (SELECT count(*) FROM lowt) AS n, h FROM lowt', LEVELS)},
path AS (
  SELECT tree, level, pos, before, after FROM lows
  UNION ALL SELECT -1, level, pos, before, after FROM tops),
up AS (
  SELECT r.tree, r.pos, 0 AS step, r.tree AS t, 0 AS l, r.pos AS p, '' AS others, r.bad AS folded FROM rows_ r
  UNION ALL
  SELECT tree, pos, step + 1,
    CASE WHEN before IS NULL THEN -1 ELSE t END,
    CASE WHEN before IS NULL THEN 0 ELSE l + 1 END,
    CASE WHEN before IS NULL THEN tree ELSE p // 3 END,
    others || coalesce(before || after, ''),
    CASE WHEN before IS NULL THEN folded ELSE sha256(before || folded || after) END
  FROM (SELECT u.*, s.before, s.after FROM up u LEFT JOIN path s ON s.tree = u.t AND s.level = u.l AND s.pos = u.p) x
  WHERE before IS NOT NULL OR t <> -1),
done AS (SELECT tree, pos, arg_max(others, step) AS others, arg_max(folded, step) AS folded FROM up GROUP BY tree, pos)
SELECT r.doc_id, r.h AS leaf, a.h AS subroot, root.h AS root, sha256(done.others) AS proof_sha256,
  done.folded AS folded_root, done.folded = root.h AS verified
FROM rows_ r JOIN done USING (tree, pos) JOIN lowt a ON a.tree = r.tree, topt root
"""

OP13 = """
WITH e AS (
  SELECT vec_id, min(row(label, q)) AS r FROM (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
      list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0) x GROUP BY vec_id),
v AS (SELECT vec_id, r[1] AS label, r[2] AS q FROM e),
s AS (
  SELECT a.vec_id AS anchor, b.vec_id, a.label = b.label AS same,
    CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT * FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.anchor AS anchor_id, p.vec_id AS positive_id,
    row_number() OVER (PARTITION BY p.anchor, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank,
    s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
  FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same
    AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 3
"""
