"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

import re

from tickloom.llm import chat


def _centroids(k: int = 40, rounds: int = 5, size: int = 64) -> str:
    near = "SELECT vec_id, v, d[1] AS distance, d[2]::INTEGER AS cluster FROM (SELECT vec_id, v, min([list_sum(list_transform(list_zip(v, c), lambda x: (x[1] - x[2]) * (x[1] - x[2])))::BIGINT, k]) AS d FROM kept, c{r} GROUP BY vec_id, v)"
    steps = []
    for r in range(rounds):
        means = ", ".join(f"floor_div(sum(v[{j}])::HUGEINT, count(*))" for j in range(1, size + 1))
        steps.append(f"a{r} AS MATERIALIZED ({near.format(r=r)}), m{r} AS MATERIALIZED (SELECT cluster AS k, [{means}] AS c FROM a{r} GROUP BY cluster), c{r + 1} AS MATERIALIZED (SELECT k, coalesce(m.c, o.c) AS c FROM c{r} o LEFT JOIN m{r} m USING (k))")
    sql = f"""WITH kept AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY mark) - 1 AS k, v AS c FROM (SELECT v, sha256('2:' || vec_id) AS mark FROM kept ORDER BY mark LIMIT {k})),
{', '.join(steps)}, last AS MATERIALIZED ({near.format(r=rounds)})
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256 FROM last JOIN c{rounds} ON k = cluster"""
    # // rounds towards zero: take one off where it cut a negative quotient
    return re.sub(r"floor_div\((sum\(v\[\d+\]\)::HUGEINT), count\(\*\)\)", r"((\1 // count(*)) - (CASE WHEN \1 % count(*) < 0 THEN 1 ELSE 0 END))::BIGINT", sql)


def _value(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c} END"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_value, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


def _merkle() -> str:
    parity = "list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))) % 2"
    up = "SELECT {g}, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM {t} WHERE n > 1 GROUP BY {g}, level, pos // 3, n"
    fold = "SELECT f.doc, f.{g}, f.level + 1, f.pos // 3, (f.n + 2) // 3, sha256(string_agg(CASE WHEN t.pos = f.pos THEN f.digest ELSE t.digest END, '' ORDER BY t.pos)), f.proof || coalesce(string_agg(t.digest, '' ORDER BY t.pos) FILTER (t.pos <> f.pos), '') FROM {f} f JOIN {t} t ON t.{g} IS NOT DISTINCT FROM f.{g} AND t.level = f.level AND t.pos // 3 = f.pos // 3 WHERE f.n > 1 GROUP BY f.doc, f.{g}, f.level, f.pos, f.n, f.digest, f.proof"
    # xor with 2^32 - 1 turns the last bit: an even sum stands for an odd remainder
    return f"""WITH RECURSIVE leaves AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n, row_number() OVER () AS doc
  FROM (SELECT doc_id, source, {_leaf('text')} AS leaf, CASE WHEN {parity} = 1 THEN {_leaf("replace(text, chr(10), '')")} END AS changed FROM documents)),
t AS (SELECT source, 0 AS level, pos, n, leaf AS digest FROM leaves UNION ALL {up.format(g='source', t='t')}),
subroots AS MATERIALIZED (SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
s AS (SELECT 0 AS one, 0 AS level, pos, n, digest FROM subroots UNION ALL {up.format(g='one', t='s')}),
f AS (SELECT doc, source, 0 AS level, pos, n, coalesce(changed, leaf) AS digest, '' AS proof FROM leaves UNION ALL {fold.format(g='source', f='f', t='t')}),
g AS (SELECT f.doc, 0 AS one, 0 AS level, r.pos, r.n, f.digest, f.proof FROM f JOIN subroots r ON r.source IS NOT DISTINCT FROM f.source WHERE f.n = 1 UNION ALL {fold.format(g='one', f='g', t='s')})
SELECT l.doc_id, l.leaf, r.digest AS subroot, s.digest AS root, sha256(g.proof) AS proof_sha256, g.digest AS folded_root, g.digest = s.digest AS verified
FROM leaves l JOIN subroots r ON r.source IS NOT DISTINCT FROM l.source JOIN g ON g.doc = l.doc AND g.n = 1 JOIN s ON s.n = 1"""


def _chat() -> str:
    text = r"replace(text, '\', '\\')"
    for m in chat.MARKERS:
        text = f"replace({text}, '{m}', '{m[0]}\\{m[1:]}')"
    role = text.replace("text", "role", 1)
    opening = f"CASE WHEN role = 'assistant' THEN length('{chat.ANSWER}') ELSE length({role}) + length('{chat.ASK}{chat.SAYS}') END"
    closing = f"CASE WHEN role = 'assistant' THEN length('{chat.ANSWERED}') ELSE length('{chat.ASKED}') END"
    return f"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
l AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) IS NOT DISTINCT FROM role AS again FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length({text}) + CASE WHEN again THEN length('{chat.NEXT}') ELSE {opening} + {closing} END)::BIGINT AS formatted_chars FROM l GROUP BY conv_id"""


def oracle_sql() -> dict[str, str]:
    return {"op11_centroid_clustering": _centroids(), "op12_merkle_manifest": _merkle(), "op13_chat_formatting": _chat()}
