"""Near-duplicate documents by HyperMinHash.

A document's set of word shingles is cut into 128 buckets by the top bits of the shingles' hashes. Of each bucket's
least hash a 16-bit register keeps the leading-zero count and the 10 bits that follow the first one. Four registers
make a band, in which an empty bucket borrows the register of another one that a fixed random order names, so that few
shingles make no weaker bands; two documents that share a band are candidates. With a similarity of 0.8, 32 bands miss
a pair with a chance below 1e-7. Registers that agree by chance are subtracted from the estimate, candidates whose estimate is far
too low go, and the full shingle sets decide on the rest.

Documents of equal sets are one class, told by a cryptographic digest of the whole sorted set. A band that many classes
share never yields its pairs as rows. First each member meets one pivot of its band, which joins most copies to one
component. Of bands in which several components remain, full sets then meet inside tasks: a band's largest component
meets all who share such a band with it, once for all its bands, and the others meet among themselves. Large groups are
split by set size first, since sizes of a linked pair differ by the threshold at most, and then into blocks of bounded
numbers of members and shingles. A product of incidence matrices counts what sets share; a task returns one link for each two components that it joins. So
no link between components is lost, while links inside one needn't be found.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import Scratch, map_columns, released
from tickloom.llm.shingles import mix, shingle_sets

REGISTERS, BAND, MANTISSA = 128, 4, 10
#: Standard errors that an estimate may lie below the threshold.
SLACK = 5
#: Members of a band that one task compares with as many others, shingles that both hold, and columns counted at once.
BLOCK, SHINGLES, COLUMNS = 1024, 500_000, 1024
#: What a member is in a task: compared with by others, compared with others, or both.
TARGET, OUTSIDE = 1, 2

_TOP = np.uint64(64 - 7)


def registers(shingles: np.ndarray) -> np.ndarray:
    """128 registers of a sorted set of hashes; 0 stands for an empty bucket."""
    out = np.zeros(REGISTERS, np.uint16)
    if len(shingles):
        bucket = (shingles >> _TOP).astype(np.int64)
        least = np.flatnonzero(np.diff(bucket, prepend=-1))
        rest = shingles[least] & np.uint64((1 << 57) - 1)
        part, bits = np.frexp((rest + np.uint64(1)).astype(np.float64))
        zeros = np.clip(57 - bits, 0, 62)
        out[bucket[least]] = (zeros << MANTISSA) + np.minimum(((part - 0.5) * 2 * (1 << MANTISSA)).astype(np.int64), (1 << MANTISSA) - 1) + 1
    return out


def chance_matches(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The share of registers in which unrelated sets of n and m shingles agree."""
    zeros = np.arange(40)[:, None]
    high, low = 0.5**zeros, 0.5 ** (zeros + 1)
    mass = lambda size: np.exp(-size / REGISTERS * low) - np.exp(-size / REGISTERS * high)
    return (mass(np.asarray(n, float)) * mass(np.asarray(m, float))).sum(0) / (1 << MANTISSA)


def estimates(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Similarity by registers, less what chance explains, and the number of registers that it rests on."""
    filled = ((a > 0) | (b > 0)).sum(-1)
    same = ((a == b) & (a > 0)).sum(-1)
    return (same - chance_matches(n, m) * filled) / np.maximum(filled, 1), filled


def plausible(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, threshold: float) -> np.ndarray:
    """Whether a pair may reach the threshold, by its sizes and within SLACK standard errors by its registers."""
    score, filled = estimates(a, b, n, m)
    error = np.sqrt(threshold * (1 - threshold) / np.maximum(filled, 1)) + 1 / np.maximum(filled, 1)
    return (np.minimum(n, m) >= threshold * np.maximum(n, m) - 1e-9) & (score >= threshold - SLACK * error)


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, a digest of the whole set, and registers as bytes."""

    def of(ids: list, texts: list) -> tuple:
        sets = shingle_sets(texts, words)
        return ids, [len(s) for s in sets], [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], [registers(s).tobytes() for s in sets]

    return map_columns(docs.select(F.col("doc_id").cast("long"), "text"), of, "doc_id long, n_shingles long, digest binary, registers binary")


#: For each bucket, the order in which it asks others for a register; itself first.
_LENDERS = np.argsort(np.random.Generator(np.random.PCG64(21)).random((REGISTERS, REGISTERS)) + 1 - np.eye(REGISTERS), axis=1, kind="stable")


def filled(kept: np.ndarray) -> np.ndarray:
    """Rows of registers in which empty ones hold what they borrow."""
    out = kept.copy()
    rows = np.flatnonzero((kept == 0).any(1) & (kept > 0).any(1))
    for low in range(0, len(rows), 128):
        own = rows[low : low + 128]
        lender = (kept[own] > 0)[:, _LENDERS].argmax(2)
        out[own] = np.take_along_axis(kept[own], _LENDERS[np.arange(REGISTERS), lender], axis=1)
    return out


def bands(classes: DataFrame) -> DataFrame:
    """rep and each of its bands' keys; sets without shingles have none."""
    salt = mix(np.arange(1, REGISTERS // BAND + 1, dtype=np.uint64))

    def of(reps: list, kept: list) -> tuple:
        packed = filled(np.frombuffer(b"".join(kept), np.uint16).reshape(len(reps), REGISTERS)).view(np.uint64)
        keys = mix(packed ^ salt).astype(np.int64)
        row, column = np.nonzero(packed)
        return np.asarray(reps, np.int64)[row], keys[row, column]

    return map_columns(classes.select("rep", "registers"), of, "rep long, key long", 4096)


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """node and component, the least node that a chain of edges (a, b) reaches, for every node that has an edge.

    Each round takes the least label among a node and its neighbours and then the label's own label, so labels of long
    chains halve their distance; a round's labels are written to the shared folder.
    """
    both = scratch.save(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-both")
    labels = scratch.save(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")), f"{name}-0")
    for k in range(1, 200):
        near = both.join(labels.withColumnRenamed("node", "b"), "b").select(F.col("a").alias("node"), "component")
        least = near.unionByName(labels).groupBy("node").agg(F.min("component").alias("to"))
        own = labels.select(F.col("node").alias("to"), F.col("component").alias("next"))
        jumped = least.join(own, "to").select("node", F.least("to", "next").alias("component"))
        fresh = scratch.save(jumped, f"{name}-{k}")
        moved = fresh.join(labels.withColumnRenamed("component", "old"), "node").where("component <> old").limit(1).count()
        labels, _ = fresh, scratch.drop(f"{name}-{k - 1}")
        if not moved:
            return labels
    raise RuntimeError("components didn't settle in 200 rounds")


def likely_among(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows whose doc_id is among `wanted` (rep), and few others, without moving any text.

    A bitmap of hashed ids, 64 MB at most, is sent to all tasks. Beyond 2^25 wanted ids more other rows pass, which
    costs time but changes no result.
    """
    bits = 1 << min(29, max(15, (16 * wanted.count()).bit_length()))
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    maps = wanted.select(place("rep").alias("p")).groupBy(F.expr("p div 32768").alias("_part")).agg(F.bitmap_construct_agg(F.expr("p % 32768")).alias("_map"))
    asked = docs.select(F.col("doc_id").cast("long").alias("rep"), "text").withColumn("_p", place("rep")).withColumn("_part", F.expr("_p div 32768"))
    held = F.expr("shiftright(cast(conv(hex(substring(_map, cast(_p % 32768 div 8 as int) + 1, 1)), 16, 10) as int), cast(_p % 8 as int)) & 1 = 1")
    return asked.join(F.broadcast(maps), "_part").where(held).select("rep", "text")


def shingles_of(docs: DataFrame, wanted: DataFrame, words: int, once: bool) -> DataFrame:
    """rep and shingles of the documents that `wanted` names, a small part of all; `once`: no doc_id repeats."""
    texts = likely_among(docs, wanted)
    return map_columns(texts if once else texts.distinct(), lambda reps, kept: (reps, [s.view(np.int64) for s in shingle_sets(kept, words)]), "rep long, shingles array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Those pairs (a, b) of documents whose full shingle sets reach the threshold."""
    own = lambda c: sets.select(F.col("rep").alias(c), F.col("shingles").alias(f"in_{c}"))
    shared = F.size(F.array_intersect("in_a", "in_b"))
    union = F.size("in_a") + F.size("in_b") - shared
    return pairs.join(own("a"), "a").join(own("b"), "b").where((union > 0) & (shared * 100 >= union * round(threshold * 100))).select("a", "b")


def near_duplicates(docs: DataFrame, words: int = 5, threshold: float = 0.8) -> DataFrame:
    """doc_id, n_shingles, component_id (the least doc_id that links reach) and kept (doc_id = component_id).

    Words are runs without ASCII white space, in small ASCII letters. Documents link at a Jaccard similarity of their
    shingle sets of at least `threshold`, a whole number of hundredths. A text of fewer words is one shingle; a null
    or blank text has none and links with nothing. Rows that repeat a doc_id with one text count once each and share a
    component; a doc_id with several texts is one document that links through each of them. A row without doc_id counts
    as a copy of its equals, and is kept if it has none. Other columns are ignored. No rows in, no rows out.
    """
    spark: SparkSession = docs.sparkSession
    with Scratch(spark, "near") as scratch:
        drawn = scratch.save(sketches(docs, words), "sketches")
        least = drawn.where("n_shingles > 0 and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"))
        named = drawn.join(least, "digest", "left")
        first = F.when((F.col("doc_id") == F.col("rep")) & (F.col("n_shingles") > 0), F.col("registers"))
        members = scratch.save(named.select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep"), first.alias("registers")), "members", keep=True)
        scratch.drop("sketches")
        once = not members.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 and doc_id is not null").limit(1).count()
        classes = members.where("registers is not null").select("rep", "n_shingles", "registers")
        classes = classes if once else scratch.save(classes.distinct(), "classes")

        keys = scratch.save(bands(classes), "bands")
        pivots = scratch.save(keys.groupBy("key").agg(F.min("rep").alias("pivot"), F.count("*").alias("n")).where("n > 1"), "pivots")
        shared = scratch.save(keys.join(pivots, "key").select("key", "rep", "pivot", "n"), "shared")
        scratch.drop("bands", "pivots")
        sized = lambda c: classes.select(F.col("rep").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("registers").alias(f"r_{c}"))

        def likely(a: list, b: list, n: list, m: list, x: list, y: list) -> tuple:
            array = lambda kept: np.frombuffer(b"".join(kept), np.uint16).reshape(len(kept), -1)
            keep = plausible(array(x), array(y), np.array(n), np.array(m), threshold) if a else []
            return np.array(a, np.int64)[keep], np.array(b, np.int64)[keep]

        pairs = shared.where("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
        met = pairs.join(sized("a"), "a").join(sized("b"), "b").select("a", "b", "n_a", "n_b", "r_a", "r_b")
        star = scratch.save(map_columns(met, likely, "a long, b long", 4096), "star")
        ends = star.select(F.col("a").alias("rep")).unionByName(star.select(F.col("b").alias("rep"))).distinct()
        sets = scratch.save(shingles_of(docs, ends, words, once), "sets")
        links = scratch.save(confirmed(star, sets, threshold).distinct(), "links")
        scratch.drop("star", "sets")
        joined = components(links, scratch, "first")

        # bands of over two members in which several components remain
        left = scratch.save(_mixed(shared.where("n > 2").select("key", "rep"), joined), "left")
        scratch.drop("shared")
        if left.limit(1).count():
            sets = scratch.save(shingles_of(docs, left.select("rep").distinct(), words, once).withColumn("size", F.size("shingles")), "more-sets")
            meet = scratch.save(_meeting(left).join(sets.select("rep", "size"), "rep"), "meet")
            dealt = scratch.save(_dealt(meet, threshold), "dealt")
            found = dealt.join(sets.select("rep", "shingles"), "rep").groupBy("task").applyInArrow(lambda t: _across(t, threshold), "a long, b long")
            joined = components(links.unionByName(scratch.save(found.distinct(), "found")), scratch, "last")
        least = scratch.save(joined, "components", keep=True).withColumnRenamed("node", "rep")
    out = members.join(least, "rep", "left").select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def _mixed(at: DataFrame, joined: DataFrame) -> DataFrame:
    """key, rep, component and main, the largest component if it has two members, of bands in which several components are."""
    named = at.join(joined.withColumnRenamed("node", "rep"), "rep", "left").select("key", "rep", F.coalesce("component", "rep").alias("component"))
    per = named.groupBy("key", "component").agg(F.count("*").alias("m"))
    mixed = per.groupBy("key").agg(F.when(F.max("m") > 1, F.max_by("component", "m")).alias("main"), F.count("*").alias("parts")).where("parts > 1").select("key", "main")
    return named.join(mixed, "key").select("key", "rep", "component", "main")


def _meeting(left: DataFrame) -> DataFrame:
    """key, rep, component and role of the members that must meet, given the bands in which several components remain.

    A component meets all members that share a band of which it is the largest, once for all such bands. The others of
    a band meet among themselves, or all members where no component has two of them; of bands with the same ones only
    one counts.
    """
    main = F.xxhash64(F.lit("main"), "main").alias("key")
    ring = left.where("main is not null").select(main, "rep", "component", F.when(F.col("component") == F.col("main"), TARGET).otherwise(OUTSIDE).alias("role")).distinct()
    others = left.where("main is null or component <> main")
    several = others.groupBy("key").agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"), *(F.bit_xor(F.xxhash64("rep", F.lit(k))).alias(f"x{k}") for k in (1, 2)))
    several = several.where("low <> high").dropDuplicates(["n", "x1", "x2"]).select("key")
    return ring.unionByName(others.join(several, "key").select("key", "rep", "component", F.lit(TARGET | OUTSIDE).alias("role")))


def _dealt(meet: DataFrame, threshold: float) -> DataFrame:
    """rep, component, role, band (members that meet) and task; a task holds a bounded number of members and shingles.

    Large groups are split by classes of set sizes, so wide that linked sets are of one class or of two next to each
    other. Targets are in their own class, members that are compared with them also go to both classes beside it.
    """
    large = meet.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK).select("key", F.lit(True).alias("large"))
    whole = meet.join(large, "key", "left")
    own = F.when(F.col("large"), F.floor(F.log(F.greatest("size", F.lit(1))) / -math.log(threshold))).otherwise(0).cast("int")
    whole = whole.withColumn("class", own)
    near = F.when(F.col("large"), F.array(F.col("class") - 1, F.col("class"), F.col("class") + 1)).otherwise(F.array("class"))
    is_a = lambda role: F.col("role").bitwiseAND(role) > 0
    target = whole.where(is_a(TARGET)).select("key", "class", "rep", "component", "size", F.lit(TARGET).alias("role"))
    outside = whole.where(is_a(OUTSIDE)).select("key", F.explode(near).alias("class"), "rep", "component", "size", F.lit(OUTSIDE).alias("role"))
    rows = target.unionByName(outside)
    blocks = lambda role: F.greatest(F.lit(1), F.ceil(F.sum(F.when(F.col("role") == role, F.greatest(F.lit(1 / BLOCK), F.col("size") / SHINGLES)).otherwise(0)))).cast("int")
    count = rows.groupBy("key", "class").agg(blocks(TARGET).alias("targets"), blocks(OUTSIDE).alias("outsides"), F.sum("size").alias("held"), F.min("role").alias("x"), F.max("role").alias("y"))
    count = count.where("x <> y").drop("x", "y")  # else nothing is compared here
    small = (F.col("targets") == 1) & (F.col("outsides") == 1)
    # bands of one block share tasks, those of several have one for each two blocks
    tasks = max(1, -(-int(count.where(small).agg(F.coalesce(F.sum("held"), F.lit(0))).first()[0]) // SHINGLES))
    turn = lambda n: F.pmod(F.xxhash64("rep", F.lit(3)), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    is_target = F.col("role") == TARGET
    dealt = rows.join(count, ["key", "class"]).withColumn("i", F.explode(F.when(is_target, F.array(turn("targets"))).otherwise(every("targets"))))
    dealt = dealt.withColumn("j", F.explode(F.when(is_target, every("outsides")).otherwise(F.array(turn("outsides")))))
    band = F.xxhash64("key", "class", "i", "j")
    task = F.when(small, F.pmod(F.xxhash64("key", "class"), F.lit(tasks))).otherwise(band)
    # a member of both roles is sent once
    return dealt.withColumn("band", band).groupBy("band", "rep", "component").agg(F.bit_or("role").alias("role"), F.first(task).alias("task"))


def _across(table: pa.Table, threshold: float) -> pa.Table:
    """Links between components from the bands of one task, one for each two components at most."""
    table = table.sort_by("band")
    reps, part, role, band = (table.column(c).to_numpy() for c in ("rep", "component", "role", "band"))
    shingles = table.column("shingles").combine_chunks()
    ends, flat = shingles.offsets.to_numpy(), shingles.flatten().to_numpy()
    first = np.flatnonzero(np.diff(band, prepend=band[:1] - 1))
    found = [np.empty((4, 0), np.int64)]
    for low, high in zip(first, [*first[1:], len(band)], strict=True):
        x, y = _linked(flat[ends[low] - ends[0] : ends[high] - ends[0]], np.diff(ends[low : high + 1]), part[low:high], role[low:high], threshold)
        found.append(np.stack([np.minimum(part[low + x], part[low + y]), np.maximum(part[low + x], part[low + y]), reps[low + x], reps[low + y]]))
    del flat, shingles, table
    released()
    made = np.concatenate(found, axis=1)
    _, once = np.unique(made[:2], axis=1, return_index=True)
    a, b = made[2:, once]
    return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def _linked(flat: np.ndarray, size: np.ndarray, part: np.ndarray, role: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the linked pairs of different components, first an outsider's, then a target's."""
    outside, target = np.flatnonzero(role & OUTSIDE), np.flatnonzero(role & TARGET)
    both = np.zeros((len(outside), len(target)), np.float32)
    order = np.argsort(flat, kind="stable")
    row = np.repeat(np.arange(len(size), dtype=np.int32), size)[order]
    begins = np.flatnonzero(np.diff(flat[order], prepend=flat[:1] - 1)) if len(flat) else np.empty(0, np.int64)
    del order
    n = np.diff(np.append(begins, len(row)))
    if len(begins):
        # shingles that the same members hold are one column, with a weight
        mark = np.bitwise_xor.reduceat(mix(np.arange(1, len(size) + 1, dtype=np.uint64))[row], begins)
        _, column, weight = np.unique(mark[n > 1], return_index=True, return_counts=True)
        begins, n = begins[n > 1][column], n[n > 1][column]
        place = np.full((2, len(size)), -1, np.int64)
        place[0, outside], place[1, target] = np.arange(len(outside)), np.arange(len(target))
        for low in range(0, len(begins), COLUMNS):
            m = n[low : low + COLUMNS]
            held = row[np.arange(m.sum()) + np.repeat(begins[low : low + COLUMNS] - (np.cumsum(m) - m), m)]
            at = np.repeat(np.arange(len(m)), m)
            left, right = np.zeros((len(outside), len(m)), np.float32), np.zeros((len(target), len(m)), np.float32)
            a, b = place[0, held], place[1, held]
            left[a[a >= 0], at[a >= 0]] = weight[low + at[a >= 0]]
            right[b[b >= 0], at[b >= 0]] = 1
            both += left @ right.T
    percent, found = round(threshold * 100), []
    for low in range(0, len(outside), 256):
        own = outside[low : low + 256]
        same = both[low : low + 256].astype(np.int64)
        good = (same > 0) & (same * (100 + percent) >= (size[own][:, None] + size[target]) * percent) & (part[own][:, None] != part[target])
        x, y = np.nonzero(good)
        found.append((own[x], target[y]))
    return tuple(np.concatenate(z) for z in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 2
