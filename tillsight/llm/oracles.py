"""DuckDB SQL of the queries on conversations and manifests."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def crc32_sql(text: str) -> str:
    """Unsigned crc32 of an ASCII text: DuckDB has no such function."""
    step = "CASE WHEN r % 2 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END"
    shifted = f"list_reduce(list_concat([xor(c, b)], CAST(range(8) AS BIGINT[])), lambda r, i: {step})"
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {codes}), lambda c, b: {shifted}), 4294967295)"


def _field(c: str) -> str:
    return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"


def _levels(start: str, name: str, key: str, count: int) -> str:
    """CTEs name0..: the nodes of each level (key, pos, digest, m: nodes of the tree) with their siblings; from the level where one is left on, it stays."""
    parts = []
    for i in range(count):
        source = start if i == 0 else f"""
  SELECT {key}, pos // 16 AS pos, CASE WHEN max(m) = 1 THEN min(digest) ELSE sha256(string_agg(digest, '' ORDER BY pos)) END AS digest,
         (max(m) + 15) // 16 AS m
  FROM {name}{i - 1} GROUP BY {key}, pos // 16"""
        parts.append(f"""{name}{i} AS (SELECT *,
    coalesce(string_agg(digest, '') OVER (PARTITION BY {key}, pos // 16 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
    coalesce(string_agg(digest, '') OVER (PARTITION BY {key}, pos // 16 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt
  FROM ({source}))""")
    return ",\n".join(parts)


#: Levels that the SQL follows: 16 ** 6 rows of a source and as many sources.
_DEEP = 6


def _op13() -> str:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    leaf = "sha256(" + " || ".join(_field(f) for f in fields) + ")"
    low = "sha256(" + " || ".join(f"coalesce(strlen(text) || ':' || translate(text, '{_UPPER}', '{_UPPER.lower()}'), '-')" if f == "text" else _field(f) for f in fields) + ")"
    steps = []
    for i in range(_DEEP):
        prior = "shown" if i == 0 else "fold"
        steps.append(f"""p{i} AS (SELECT a.doc_id, a.source, a.pos, a.leaf,
    CASE WHEN n.m > 1 THEN sha256(n.lft || a.{prior} || n.rgt) ELSE a.{prior} END AS fold, {"''" if i == 0 else 'a.sib'} || n.lft || n.rgt AS sib
  FROM {'leaves' if i == 0 else f'p{i - 1}'} a JOIN s{i} n ON n.source IS NOT DISTINCT FROM a.source AND n.pos = a.pos // {16 ** i})""")
    for i in range(_DEEP):
        last = f"p{_DEEP - 1}" if i == 0 else f"q{i - 1}"
        at = "t.pos" if i == 0 else "a.at"
        steps.append(f"""q{i} AS (SELECT a.doc_id, a.leaf, {at} AS at, {'t.digest' if i == 0 else 'a.subroot'} AS subroot,
    CASE WHEN n.m > 1 THEN sha256(n.lft || a.fold || n.rgt) ELSE a.fold END AS fold, a.sib || n.lft || n.rgt AS sib
  FROM {last} a {'JOIN t0 t ON t.source IS NOT DISTINCT FROM a.source' if i == 0 else ''} JOIN t{i} n ON n.pos = {at} // {16 ** i})""")
    subroots = f"SELECT 0 AS one, source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS m FROM s{_DEEP}"
    return f"""
WITH leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS m
  FROM (SELECT doc_id, source, {leaf} AS leaf, CASE WHEN {crc32_sql('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN {low} ELSE {leaf} END AS shown FROM documents)
), {_levels("SELECT source, pos, leaf AS digest, m FROM leaves", "s", "source", _DEEP + 1)},
{_levels(subroots, "t", "one", _DEEP + 1)},
{", ".join(steps)}
SELECT doc_id, leaf, subroot, root, sha256(sib) AS proof_sha256, fold AS folded_root, fold = root AS verified
FROM q{_DEEP - 1}, (SELECT digest AS root FROM t{_DEEP})
"""


OP13_SQL = _op13()

OP11_SQL = f"""
WITH o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, {crc32_sql('CAST(conv_id AS VARCHAR)')} % 4 AS h FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
), r AS (
  SELECT c.conv_id, 0 AS part, o.i, {{'r': o.role, 't': o.text}} AS x FROM c JOIN o ON o.conv_id = c.base AND o.i <= c.h
  UNION ALL SELECT c.conv_id, 1, o.i, {{'r': o.role, 't': o.text}} FROM c JOIN o ON o.conv_id = c.conv_id AND o.i > c.h
), s AS (
  SELECT c.conv_id, coalesce(q.xs, []) AS xs FROM c LEFT JOIN (SELECT conv_id, list(x ORDER BY part, i) AS xs FROM r GROUP BY conv_id) q ON q.conv_id = c.conv_id
), m AS (
  SELECT conv_id, xs, unnest(range(0, len(xs) + 1)) AS d FROM s
), n AS (
  SELECT xs[1:d] AS p, d, min(conv_id) AS conv_id, count(*) AS n,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(xs) = d), '')) AS ends
  FROM m GROUP BY xs[1:d], d
), k AS (
  SELECT p, d, count(*) AS children FROM (SELECT p[1:d - 1] AS p, d - 1 AS d FROM n WHERE d > 0) GROUP BY p, d
), w AS (
  SELECT n.*, coalesce(k.children, 0) AS children,
         (n.n - 1) * CASE WHEN n.d = 0 THEN 0 ELSE len(regexp_extract_all(n.p[n.d].t, '[^\x20\x09-\x0D]+')) END AS own
  FROM n LEFT JOIN k ON k.p = n.p AND k.d = n.d
), b AS (
  SELECT p[1:e] AS p, e AS d, sum(own) AS saved, count(*) FILTER (WHERE children = 0) AS leaves
  FROM (SELECT p, children, own, unnest(range(0, d + 1)) AS e FROM w) GROUP BY p[1:e], e
)
SELECT w.conv_id, w.d AS depth, u.conv_id AS parent_conv_id, w.n AS n_convs, w.children AS n_children, b.leaves AS n_leaves,
       CAST(b.saved AS BIGINT) AS saved_tokens, w.ends AS ends_sha256
FROM w JOIN b ON b.p = w.p AND b.d = w.d LEFT JOIN n u ON u.d = w.d - 1 AND u.p = w.p[1:w.d - 1]
"""
