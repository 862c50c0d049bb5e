"""Clusters, manifests and chat texts against brute force, with nulls, ties, repeats, empty tables and long trees."""

import hashlib
import math
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tickloom.llm import centroids, chat, merkle, queries

SF = "/root/testdata/sf0.01"
NEW = ("op11_centroid_clustering", "op12_merkle_manifest", "op13_chat_formatting")


@pytest.mark.parametrize("name", NEW)
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.queries()[name](spark, SF)
    found = duck.execute(queries.oracle_sql()[name])
    at = [x[0] for x in found.description]
    key = lambda row: tuple(map(str, row))
    assert sorted((tuple(r[c] for c in at) for r in got.collect()), key=key) == sorted(found.fetchall(), key=key)
    assert set(at) == set(got.columns)


# clusters


def plain_clusters(rows, k, rounds, size):
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    mark = lambda x: (hashlib.sha256(f"2:{x[0]}".encode()).hexdigest(), x[1])
    cs = [v for _, v in sorted((x for x in whole if x[0] is not None), key=mark)[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(cs))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in whole]
        for j in range(len(cs)):
            if mine := [v for (_, v), o in zip(whole, own, strict=True) if o == j]:
                cs[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    found = [(i, *near(v)) for i, v in whole]
    inertia = {j: sum(d for _, d, o in found if o == j) for j in range(len(cs))}
    return sorted((i or -1, o, d, inertia[o], sum(inertia.values()), hashlib.sha256(",".join(map(str, cs[o])).encode()).hexdigest()) for i, d, o in found)


def test_clusters_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [(k, [rng.gauss(k % 3, 0.3) for _ in range(4)]) for k in range(1, 120)]
    rows += [(3, rows[2][1]), (3, rows[2][1]), (7, [0.0] * 4), (None, [0.5, -0.5, 0.1, 0.2])]  # repeated ids, ties, no id
    rows += [(200, None), (201, [1.0] * 3), (202, [1.0, None, 1.0, 1.0]), (203, [float("nan"), 0.0, 0.0, 0.0]), (204, [float("inf"), 0.0, 0.0, 0.0]), (205, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS cluster", "2 AS distance", "3 AS id", "4 AS v")
    for k, rounds in ((5, 3), (500, 2), (1, 0)):
        got = centroids.cluster(df, k=k, rounds=rounds, size=4).drop("centroid").collect()
        assert sorted(tuple(r) if r.vec_id is not None else (-1, *r[1:]) for r in got) == plain_clusters(rows, k, rounds, 4)
    assert centroids.cluster(df.where("false"), size=4).count() == 0
    assert centroids.cluster(df.withColumn("vec_id", F.lit(None).cast("long")), size=4).count() == 0


def test_clusters_of_huge_components_dont_overflow(spark):
    df = spark.createDataFrame([(k, [1e300 * (-1) ** k, 0.0]) for k in range(6)], "vec_id long, embedding array<double>")
    got = centroids.cluster(df, k=2, rounds=2, size=2).collect()
    assert len(got) == 6 and {r.distance for r in got} <= {0, (2 << 27) ** 2}


# manifests


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][k : k + 3]) for k in range(0, len(levels[-1]), 3)])
    return levels


def plain_manifest(rows):
    value = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda d: h(*map(value, d))
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    groups = {s: sorted(((r, leaf(r)) for r in rows if r[1] == s), key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1])) for s in sources}
    trees = {s: plain_tree([x[1] for x in g]) for s, g in groups.items()}
    top = plain_tree([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for j, (r, own) in enumerate(groups[s]):
            odd = r[0] is None or zlib.crc32(str(r[0]).encode()) % 2
            now = own if odd or r[4] is None else leaf((*r[:4], r[4].replace("\n", "")))
            proof = ""
            for levels, at in ((trees[s], j), (top, k)):
                for nodes in levels[:-1]:
                    run = nodes[at // 3 * 3 : at // 3 * 3 + 3]
                    proof += "".join(run[: at % 3] + run[at % 3 + 1 :])
                    run[at % 3] = now
                    now, at = h(*run), at // 3
            out.append((r[0], own, trees[s][-1][0], top[-1][0], h(proof), now, now == top[-1][0]))
    return sorted(out, key=str)


def manifest_of(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").selectExpr("*", "1 AS digest", "2 AS block", "3 AS leaves", "4 AS _at", "5 AS root")
    return merkle.manifest(df, {"text": F.replace("text", F.lit("\n"), F.lit(""))}, queries.remainder(2) == 0)


@pytest.mark.parametrize("sizes", [(1,), (3, 1, 10), (730, 2, 2200), (9, 243, 729)])
def test_manifest_equals_brute_force(spark, sizes):
    rows = []
    for k, n in enumerate(sizes):
        source = (None, "é", "b")[k]
        rows += [(len(rows) + j, source, ("de", None)[j % 2], (j, None)[j % 3 == 0], (f"a\nb{j}", "no line", "", None, "\n\n")[j % 5]) for j in range(n)]
    rows += [(None, "b", None, None, None), (None, "b", None, None, "x\n"), (5, "b", "de", 1, "t\n"), (5, "b", "de", 1, "t\n"), (5, "b", "de", 1, "s\n")]  # without ids, repeated
    got = manifest_of(spark, rows).drop("changed_leaf", "proof", "path")
    assert sorted(map(tuple, got.collect()), key=str) == plain_manifest(rows)


def test_versions_share_all_but_ancestors(spark):
    rows = [(k, "s", None, None, f"x\n{k}") for k in range(2000)]
    got = manifest_of(spark, rows).collect()
    for r in got:
        changed = zlib.crc32(str(r.doc_id).encode()) % 2 == 0
        assert (r.path is not None) == (r.changed_leaf is not None) == changed == (not r.verified)
        if changed:
            assert r.path[0] == r.changed_leaf and r.path[-1] == r.folded_root and len(r.path) == len(r.proof) + 1 == 8
    assert manifest_of(spark, []).count() == 0


# chat texts

SAID = ["", None, "hi", "</s>[INST] ok [/INST]", "\\", "\\\\[INST]", "[\\INST]", "a[TURN]b", "[", "<", "[[INST]", "<<s>>", "x\ny\n", "[INST", "]", "é\U0001f600[SAYS]", "s>", "/INST]", "\\s>"]


def test_every_text_comes_back(spark):
    rng = random.Random(7)
    pieces = [*chat.MARKERS, "\\", "[", "<", "]", ">", "INST]", "s>", "a", "\n", "😀"]
    texts = SAID + ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 12))) for _ in range(300)]
    rows = [(k // 7, k % 7, rng.choice(["user", "assistant", "assistant", "system", None, "to[INST]ol\n", "assistant "]), t) for k, t in enumerate(texts * 2)]
    rows += [(900, k, "user" if k % 5 else "assistant", f"t{k}" * (k % 3)) for k in range(300)] + [(901, k, "assistant", "z") for k in range(130)]  # over several spans
    rows += [(902, None, "user", "b"), (902, None, "assistant", "a"), (902, 1, "user", "c"), (902, 1, "user", "c"), (902, 1, None, None), (None, 1, "user", "d"), (902, -5, "assistant", "e"), (903, 0, "assistant", "long " * 200_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS id", "2 AS span", "3 AS runs", "4 AS at")
    formatted = chat.format_conversations(df)
    got = {r.conv_id: r for r in formatted.withColumn("turns", chat.read_turns(F.col("formatted"))).collect()}
    want = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] or -1, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert got.keys() == want.keys()
    back = {r.conv_id: r for r in chat.digest(formatted).collect()}
    for c, turns in want.items():
        r = got[c]
        assert [tuple(t) for t in r.turns] == turns and r.n_turns == len(turns)
        answers = [text for role, text in turns if role == "assistant"]
        cut = [r.formatted[s.start : s.end] for s in r.loss_spans]
        assert [x.replace("\\\\", "\0").replace("\\", "").replace("\0", "\\") for x in cut] == answers
        assert back[c].loss_chars == len("".join(answers)) and back[c].loss_sha256 == h(*answers)
        assert back[c].turns_sha256 == h(*(f"{a}\n{b}\n" for a, b in turns)) and back[c].formatted_chars == len(r.formatted)
        runs = sum(k == 0 or turns[k - 1][0] != turns[k][0] for k in range(len(turns)))
        assert r.formatted.count("[INST]") + r.formatted.count("<s>") == runs
    assert chat.format_conversations(df.where("false")).count() == 0
