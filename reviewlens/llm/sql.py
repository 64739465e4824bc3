"""DuckDB SQL of the longer oracles, built from small parts."""

from __future__ import annotations

import string


def crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII string, bit by bit."""
    step = "lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))"
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i, 1))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), {step}), 4294967295)"


CONVERSATION_TRIE = f"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos,
         sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k, strlen(coalesce(text, '')) AS b
  FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT c, CAST(c AS VARCHAR) AS dec FROM t GROUP BY c),
h AS (SELECT c, c - ((c % 5) + 5) % 5 AS base, {crc32('dec')} % 9 AS h FROM s),
r AS (
  SELECT h.c, 0 AS part, t.pos, t.k, t.b FROM h JOIN t ON t.c = h.base AND t.pos < h.h
  UNION ALL SELECT h.c, 1, t.pos, t.k, t.b FROM h JOIN t ON t.c = h.c AND t.pos >= h.h),
d AS (
  SELECT c, row_number() OVER w AS depth, b, md5(string_agg(k, '') OVER w) AS node FROM r WINDOW w AS (PARTITION BY c ORDER BY part, pos)),
p AS (SELECT c, 0 AS depth, 0 AS b, '' AS node FROM h UNION ALL SELECT c, depth, b, node FROM d),
u AS (SELECT c, max(depth) AS total FROM p GROUP BY c),
n AS (
  SELECT node, depth, min(p.c) AS c, count(*) AS n_convs, max(b) AS b,
         coalesce(string_agg(CAST(p.c AS VARCHAR), ',' ORDER BY p.c) FILTER (WHERE total = depth), '') AS ends
  FROM p JOIN u ON u.c = p.c GROUP BY node, depth),
m AS (
  SELECT n.*, q.node AS parent, a.c AS parent_c FROM n
  LEFT JOIN p q ON q.c = n.c AND q.depth = n.depth - 1 LEFT JOIN n a ON a.node = q.node AND a.depth = n.depth - 1),
ch AS (SELECT parent, depth - 1 AS depth, count(*) AS k FROM m WHERE depth > 0 GROUP BY ALL),
f AS (SELECT m.*, coalesce(ch.k, 0) AS n_children FROM m LEFT JOIN ch ON ch.parent = m.node AND ch.depth = m.depth),
sub AS (
  SELECT a.node, a.depth, count(*) FILTER (WHERE f.n_children = 0) AS n_leaves, sum((f.n_convs - 1) * f.b) AS saved
  FROM f JOIN p a ON a.c = f.c AND a.depth <= f.depth GROUP BY a.node, a.depth)
SELECT f.c AS conv_id, f.depth, f.parent_c AS parent_conv_id, f.n_convs, f.n_children, sub.n_leaves, CAST(sub.saved AS BIGINT) AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM f JOIN sub ON sub.node = f.node AND sub.depth = f.depth"""


def _tree(name: str, leaves: str, levels: int) -> str:
    """Relations {name}0 .. {name}{levels} of (g, i, d, c) and {name}s0 .. with left and right siblings."""
    out = [f"{name}0 AS (SELECT g, i, d, count(*) OVER (PARTITION BY g) AS c FROM {leaves})"]
    for k in range(levels):
        out.append(f"{name}s{k} AS (SELECT g, i, c, coalesce(string_agg(d, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
                   f"coalesce(string_agg(d, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k} WINDOW w AS (PARTITION BY g, i // 8 ORDER BY i))")
        out.append(f"{name}{k + 1} AS (SELECT g, i, d, count(*) OVER (PARTITION BY g) AS c FROM (SELECT g, i // 8 AS i, CASE WHEN any_value(c) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d FROM {name}{k} GROUP BY g, i // 8))")
    return ",\n".join(out)


def merkle_manifest(levels: int = 6, over: int = 3) -> str:
    """For groups of up to 8 ** levels rows and up to 8 ** over groups."""
    lower = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    part = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
    fields = [part.format(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaf, other = (f"sha256({' || '.join([*fields, part.format(c)])})" for c in ("text", lower))
    joins, proof, value = [], [], "coalesce(x.tampered, x.leaf)"
    for k in range(levels):
        joins.append(f"JOIN ts{k} AS t{k}_ ON t{k}_.g = x.g AND t{k}_.i = x.i // {8 ** k}")
        proof.append(f"t{k}_.l || t{k}_.r")
        value = f"CASE WHEN t{k}_.c = 1 THEN {value} ELSE sha256(t{k}_.l || {value} || t{k}_.r) END"
    for k in range(over):
        joins.append(f"JOIN os{k} AS o{k}_ ON o{k}_.i = q.i // {8 ** k}")
        proof.append(f"o{k}_.l || o{k}_.r")
        value = f"CASE WHEN o{k}_.c = 1 THEN {value} ELSE sha256(o{k}_.l || {value} || o{k}_.r) END"
    return f"""
WITH a AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS dec, coalesce('1' || lang, '0') AS g, {leaf} AS leaf, {other} AS other FROM documents),
x AS (SELECT doc_id, g, leaf, CASE WHEN {crc32('dec')} % 3 = 0 THEN other END AS tampered, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM a),
y AS (SELECT g, i, leaf AS d FROM x),
{_tree('t', 'y', levels)},
q AS (SELECT g, d, row_number() OVER (ORDER BY g) - 1 AS i FROM t{levels}),
z AS (SELECT '' AS g, i, d FROM q),
{_tree('o', 'z', over)},
f AS (SELECT x.doc_id, x.leaf, q.d AS subroot, (SELECT d FROM o{over}) AS root, sha256({' || '.join(proof)}) AS proof_sha256, {value} AS folded_root
  FROM x JOIN q ON q.g = x.g {' '.join(joins)})
SELECT *, folded_root = root AS verified FROM f"""
