"""The Merkle manifest as SQL, one common table for each level of the trees."""

from __future__ import annotations

#: Levels written out: sources of at most 3 ** 14 rows, 3 ** 9 sources.
LEAF_LEVELS, GROUP_LEVELS = 14, 9

_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split({s}, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)),
    4294967295)"""


def _leaf(text: str) -> str:
    parts = [f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in
             ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)]
    return f"sha256({' || '.join(parts)})"


def _levels(name: str, count: int) -> str:
    """Tables {name}1 ... of nodes (g, i, d, n), and {name}s0 ... of what stands beside them."""
    out = []
    for k in range(count):
        run = "PARTITION BY g, i // 3 ORDER BY i ROWS BETWEEN"
        out.append(f"""{name}s{k} AS MATERIALIZED (SELECT g, i, n,
  coalesce(string_agg(d, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}{k})""")
        out.append(f"""{name}{k + 1} AS MATERIALIZED (SELECT g, i // 3 AS i,
  CASE WHEN any_value(n) > 1 THEN sha256(string_agg(d, '' ORDER BY i)) ELSE any_value(d) END AS d,
  (any_value(n) + 2) // 3 AS n FROM {name}{k} GROUP BY g, i // 3)""")
    return ",\n".join(out)


def _climb(name: str, before: str, count: int, group: str, place: str) -> tuple[str, str]:
    out = []
    for k in range(count):
        out.append(f"""{name}c{k} AS MATERIALIZED (SELECT x.* REPLACE (
  x.proof || s.l || s.r AS proof,
  CASE WHEN s.n > 1 THEN sha256(s.l || x.acc || s.r) ELSE x.acc END AS acc)
  FROM {before} x JOIN {name}s{k} s ON s.g = x.{group} AND s.i = x.{place} // {3 ** k})""")
        before = f"{name}c{k}"
    return ",\n".join(out), before


def sql() -> str:
    low, after_low = _climb("a", "start", LEAF_LEVELS, "g", "i")
    high, after_high = _climb("b", after_low, GROUP_LEVELS, "one", "gi")
    return f"""
WITH leaves AS MATERIALIZED (
  SELECT doc_id, source, {_leaf('text')} AS leaf,
    CASE WHEN {_CRC.format(s="doc_id::VARCHAR")} % 2 = 0
         THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS acc FROM documents),
placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, acc) - 1 AS i,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g,
    count(*) OVER (PARTITION BY source) AS n FROM leaves),
start AS MATERIALIZED (SELECT doc_id, leaf, acc, '' AS proof, g, i, 0 AS one, g AS gi FROM placed),
a0 AS MATERIALIZED (SELECT g, i, leaf AS d, n FROM placed),
{_levels("a", LEAF_LEVELS)},
b0 AS MATERIALIZED (SELECT 0 AS g, g AS i, d, count(*) OVER () AS n FROM a{LEAF_LEVELS}),
{_levels("b", GROUP_LEVELS)},
{low},
{high}
SELECT x.doc_id, x.leaf, s.d AS subroot, t.d AS root, sha256(x.proof) AS proof_sha256,
  x.acc AS folded_root, x.acc = t.d AS verified
FROM {after_high} x JOIN b0 s ON s.i = x.g CROSS JOIN b{GROUP_LEVELS} t
"""
