"""SQL of queries whose text follows from a rule, for DuckDB."""

from __future__ import annotations

from collections.abc import Sequence

#: Unsigned crc32 of the text ``s``, whose characters are ASCII.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
  flatten(list_transform(range(1, len(s) + 1), lambda p: list_transform(range(0, 8), lambda k: (ascii(substr(s, p, 1)) >> k) & 1)))),
  lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))))"""


def _leaf(fields: Sequence[str], text: str) -> str:
    parts = [f"coalesce(octet_length(encode(CAST({v} AS VARCHAR))) || ':' || CAST({v} AS VARCHAR), '-')" for v in (text if f == "text" else f for f in fields)]
    return f"sha256({' || '.join(parts)})"


def merkle_sql(fields: Sequence[str], heights: tuple[int, int] = (6, 3)) -> str:
    """Proofs and folded roots over ``documents``, for trees of at most 16 ** height leaves (first the sources', then the one over them)."""
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [
        f"c AS (SELECT doc_id, source, {_leaf(fields, 'text')} AS d, {_leaf(fields, low)} AS t, {_CRC32} % 5 = 0 AS bad FROM (SELECT *, CAST(doc_id AS VARCHAR) AS s FROM documents))",
        "s0 AS (SELECT source AS tree, doc_id AS id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY source) AS n, d FROM c)",
    ]
    joins, fold, proof = [], "CASE WHEN bad THEN t ELSE d END", []

    def climb(name: str, height: int, here: str) -> None:
        nonlocal fold
        for k in range(1, height + 1):
            below, at, slot = f"{name}{k - 1}", f"{here} // {16 ** k}", f"{here} // {16 ** (k - 1)} % 16"
            parts.append(f"{name}r{k} AS (SELECT tree, i // 16 AS i, n, list(d ORDER BY i) AS ds FROM {below} GROUP BY tree, i // 16, n)")
            parts.append(f"{name}{k} AS (SELECT tree, i, (n + 15) // 16 AS n, CASE WHEN n = 1 THEN ds[1] ELSE sha256(array_to_string(ds, '')) END AS d FROM {name}r{k})")
            run = f"x{name}{k}"
            joins.append(f"JOIN {name}r{k} {run} ON {run}.tree IS NOT DISTINCT FROM {'b.tree' if name == 's' else 'NULL'} AND {run}.i = {at}")
            others = f"array_to_string({run}.ds[1:{slot}], ''), array_to_string({run}.ds[{slot} + 2:], '')"
            before, after = others.split("), ")[0] + ")", others.split("), ")[1]
            fold = f"CASE WHEN {run}.n = 1 THEN {fold} ELSE sha256({before} || {fold} || {after}) END"
            proof.append(f"CASE WHEN {run}.n = 1 THEN '' ELSE {before} || {after} END")

    climb("s", heights[0], "b.i")
    parts.append(f"t0 AS (SELECT NULL AS tree, tree AS name, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS i, count(*) OVER () AS n, d FROM s{heights[0]})")
    climb("t", heights[1], "top.i")
    return f"""
WITH {', '.join(parts)},
p AS (SELECT b.id AS doc_id, b.d AS leaf, top.d AS subroot, (SELECT d FROM t{heights[1]}) AS root, sha256({' || '.join(proof)}) AS proof_sha256, {fold.replace('CASE WHEN bad THEN t ELSE d END', 'CASE WHEN c.bad THEN c.t ELSE c.d END')} AS folded_root
      FROM s0 b JOIN c ON c.doc_id = b.id JOIN t0 top ON top.name IS NOT DISTINCT FROM b.tree {' '.join(joins)})
SELECT *, folded_root = root AS verified FROM p
"""


PHRASES = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS ps FROM documents),
p AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(ps) AS p FROM t)),
g AS (SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM p, (SELECT unnest([1, 2, 3]) AS m) WHERE len(w) >= m)),
f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= 10),
x AS (SELECT lang, phrase, max(a) AS most FROM (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM c WHERE m = 3) GROUP BY ALL),
k AS (SELECT c.*, unnest(range(1, m)) AS k FROM c LEFT JOIN x USING (lang, phrase) WHERE coalesce(100 * most < 50 * a, true)),
s AS (SELECT k.*, l.f AS l, r.f AS r, CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
      FROM k JOIN f l ON l.lang = k.lang AND l.phrase = array_to_string(w[1:k], ' ') JOIN f r ON r.lang = k.lang AND r.phrase = array_to_string(w[k + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score FROM b JOIN n USING (lang)
QUALIFY rank <= 2000
"""
