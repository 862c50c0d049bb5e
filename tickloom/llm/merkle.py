"""A Merkle manifest of documents whose tampered leaves are versions of a persistent tree.

Leaves are ordered within their source by one range partitioning, of digests and ids alone; texts are hashed where they are
read. Positions are cut into aligned blocks of 3^6 leaves, whose six levels one row holds. Block roots are the leaves of
the next stage, so a source of any size takes a few stages of bounded rows. A tampered leaf makes a version of the tree
that shares every untouched node: only its ancestors are copied, within its block and then through the upper
stages, whose siblings are kept once for a block and not for a leaf. All of it is DataFrame code.

Defined results: null values hash as `-`; rows without doc_id come first in their source, and rows of one doc_id go by their
leaf; equal rows have equal leaves, so which is which doesn't matter. Null sources form the first group. A tree of
one leaf is that leaf, and its proof hashes the empty string. An empty table has no rows. A text's length matters only to
the task that hashes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import Scratch

ARITY, LEVELS = 3, 6
BLOCK = ARITY**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf(columns: dict[str, Column]) -> Column:
    """sha256 over all values, each `-` if null, else its bytes' count, `:` and itself."""
    one = lambda c: F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
    return F.sha2(F.concat(*map(one, columns.values())), 256)


def ordered(df: DataFrame, group: list[str], by: list[str], scratch: Scratch, name: str, parts: int = 0) -> DataFrame:
    """df with `_at`: 0, 1, 2, ... within each group, in the order of `by`, and `_n`, the group's rows.

    Rows are dealt by ranges of (group, by), so one group spreads over many tasks; each task numbers what it holds, and
    counts by group and task, a small table, shift these numbers. The dealt rows are written, as ranges are drawn anew
    in each run.
    """
    order = [F.asc_nulls_first(c) for c in (*group, *by)]
    dealt = (df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)).sortWithinPartitions(*order)
    dealt = scratch.save(dealt.withColumns({"_part": F.spark_partition_id(), "_k": F.monotonically_increasing_id()}), name)
    counts = dealt.groupBy(*group, "_part").agg(F.count("*").alias("_c"), F.min("_k").alias("_low"))
    w = Window.partitionBy(*group)
    before = F.coalesce(F.sum("_c").over(w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = counts.select(*(F.col(g).alias(f"_{g}") for g in group), F.col("_part").alias("_p"), (before - F.col("_low")).alias("_shift"), F.sum("_c").over(w).alias("_n"))
    same = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group] + [F.col("_part") == F.col("_p")]
    on = same[0]
    for c in same[1:]:
        on &= c
    return dealt.join(shifts, on).withColumn("_at", F.col("_k") + F.col("_shift")).drop("_part", "_p", "_k", "_shift", *(f"_{g}" for g in group))


def _heights(n: Column) -> Column:
    """Levels to compute in a block of a tree with n nodes: all of a block, or as many as leave one node."""
    out = F.lit(LEVELS)
    for k in reversed(range(LEVELS)):
        out = F.when(n <= ARITY**k, k).otherwise(out)
    return out


def _above(nodes: Column) -> Column:
    """The next level: a hash of each run of nodes."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / ARITY).cast("int"))
    return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(nodes, i * ARITY + 1, ARITY), ""), 256))


def _blocks(nodes: DataFrame, tree: str, carried: list[str]) -> DataFrame:
    """(tree, block, n, leaves, levels, digest): aligned blocks of (tree, at, n, digest) with all levels of nodes."""
    rows = nodes.groupBy(tree, F.floor(F.col("_at") / BLOCK).alias("block")).agg(F.first("_n").alias("n"), F.sort_array(F.collect_list(F.struct("_at", "digest", *carried))).alias("leaves"))
    rows = rows.withColumn("level0", F.transform("leaves", lambda x: x["digest"]))
    for k in range(LEVELS):
        rows = rows.withColumn(f"level{k + 1}", F.when(_heights(F.col("n")) > k, _above(F.col(f"level{k}"))).otherwise(F.col(f"level{k}")))
    levels = F.array(*(F.col(f"level{k}") for k in range(LEVELS)))
    return rows.select(tree, "block", "n", "leaves", levels.alias("levels"), F.col(f"level{LEVELS}")[0].alias("digest"))


#: The nodes left and right of one in its run, joined, for each level above it.
SIBLINGS = "array<struct<left: string, right: string>>"


def _siblings(levels: Column, place: Column, height: Column) -> Column:
    """SIBLINGS of the leaf at `place` of a block."""

    def at(k: Column) -> Column:
        here = F.floor(place / F.pow(F.lit(float(ARITY)), k)).cast("int")
        spot, nodes = here % ARITY, F.element_at(levels, k + 1)
        return F.struct(F.array_join(F.slice(nodes, here - spot + 1, spot), "").alias("left"), F.array_join(F.slice(nodes, here + 2, ARITY - 1 - spot), "").alias("right"))

    return F.when(height > 0, F.transform(F.sequence(F.lit(0), height - 1), at)).otherwise(F.array().cast(SIBLINGS))


def _path(digest: Column, siblings: Column) -> Column:
    """The copied ancestors of a node whose digest changed, lowest first; the last is the root of its version."""
    copy = lambda made, s: F.concat(made, F.array(F.sha2(F.concat(s["left"], F.element_at(made, -1), s["right"]), 256)))
    return F.aggregate(siblings, F.array(digest), copy)


def _stages(nodes: DataFrame, tree: str, largest: int, scratch: Scratch, name: str) -> list[DataFrame]:
    """Tables of blocks, the leaves' first; the last has one block a tree, whose digest is the tree's root."""
    stages, at = [], nodes
    while True:
        carried = [c for c in at.columns if c not in (tree, "_at", "_n", "digest")]
        stages.append(scratch.save(_blocks(at, tree, carried), f"{name}{len(stages)}", keep=True))  # the lazy result reads them
        if largest <= BLOCK:
            return stages
        largest = -(-largest // BLOCK)
        at = stages[-1].select(tree, F.col("block").alias("_at"), F.ceil(F.col("n") / BLOCK).alias("_n"), "digest")


def _with_upper(fields: dict[str, str]) -> Column:
    """A block's leaves with their fields and all their siblings."""

    def one(x: Column) -> Column:
        own = _siblings(F.col("levels"), (x["_at"] % BLOCK).cast("int"), _heights(F.col("n")))
        return F.struct(*(x[c].alias(to) for c, to in fields.items()), F.concat(own, F.col("upper")).alias("upper"))

    return F.transform("leaves", one)


def _leaves(stages: list[DataFrame], tree: str, known: DataFrame, fields: dict[str, str]) -> DataFrame:
    """A row for each leaf of the lowest stage: its fields, `upper` and the other columns of `known`, which has a row for each tree.

    `upper` is the list of a node's siblings up to the root of all. It goes down stage by stage with a block's root, so
    that the leaves of a block share what lies above it.
    """
    more = [c for c in known.columns if c not in (tree, "upper")]
    known = known.withColumn("block", F.lit(0).cast("long"))
    for k in reversed(range(len(stages))):
        own = fields if not k else {"_at": "block"}
        above = known.withColumnsRenamed({tree: "_tree", "block": "_block"})
        whole = stages[k].join(above, F.col(tree).eqNullSafe(F.col("_tree")) & (F.col("block") == F.col("_block")))
        known = whole.select(tree, *more, F.explode(_with_upper(own)).alias("_x")).select(tree, *more, "_x.*")
    return known


def _largest(ordered_rows: DataFrame) -> int:
    return ordered_rows.agg(F.max("_n")).first()[0] or 0


def manifest(docs: DataFrame, tampered: dict[str, Column], where: Column) -> DataFrame:
    """A row for each document: its leaf, tree, proof, and the version that tampering with it makes.

    tampered: new values of columns, in effect for rows `where` holds. Columns: doc_id, leaf, changed_leaf (null where no
    byte changed), subroot, root, proof (SIBLINGS from the leaf to the root), path (the copied nodes of the version, the
    leaf first; null where there is none), proof_sha256, folded_root, verified.
    """
    own = {c: F.col(c) for c in FIELDS}
    made = docs.select("doc_id", "source", leaf(own).alias("digest"), F.when(where, leaf(own | tampered)).alias("changed"))
    made = made.withColumn("changed", F.when(F.col("changed") != F.col("digest"), F.col("changed")))
    with Scratch(docs.sparkSession, "merkle") as scratch:
        rows = ordered(made, ["source"], ["doc_id", "digest"], scratch, "leaves")
        stages = _stages(rows, "source", _largest(rows), scratch, "blocks")
        roots = stages[-1].select(F.lit(0).alias("all"), "source", "digest")
        tops = ordered(roots, ["all"], ["source"], scratch, "sources")
        upper = _stages(tops, "all", _largest(tops), scratch, "tops")
    top = upper[-1].select("all", F.col("digest").alias("root"), F.array().cast(SIBLINGS).alias("upper"))
    trees = _leaves(upper, "all", top, {"source": "source", "digest": "subroot"}).drop("all")
    each = _leaves(stages, "source", trees, {"doc_id": "doc_id", "digest": "leaf", "changed": "changed_leaf"}).withColumnRenamed("upper", "proof")
    each = each.withColumn("copied", _path(F.coalesce("changed_leaf", "leaf"), F.col("proof")))
    folded = F.element_at("copied", -1)
    text = F.array_join(F.transform("proof", lambda s: F.concat(s["left"], s["right"])), "")
    return each.select("doc_id", "leaf", "changed_leaf", "subroot", "root", "proof", F.when(F.col("changed_leaf").isNotNull(), F.col("copied")).alias("path"), F.sha2(text, 256).alias("proof_sha256"), folded.alias("folded_root"), (folded == F.col("root")).alias("verified"))
