"""Sharding by longest processing time: groups that must stay together go, largest first, to the least-loaded shard.

A heap on one machine cannot hold a corpus of groups. Groups above a small part of a shard's share are units of
their own; there can't be more of them than shards times PARTS. All smaller groups are dealt by their hash into
shards times PARTS bundles, each a unit. So the heap sees at most 2 x shards x PARTS units at any corpus size, and
shards end within about one bundle of each other.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import Scratch, numbered

SHARDS = 24
#: Units in a shard's share, for either kind of unit.
PARTS = 1000
#: Bytes that a row counts besides its text.
ROW_BYTES = 8


def longest_first(sizes: dict[int, int], shards: int) -> dict[int, int]:
    """Unit: shard. Larger units first, ties by unit; the least-loaded shard takes each, ties to the smallest number."""
    heap = [(0, k) for k in range(shards)]
    out = {}
    for unit, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        load, shard = heap[0]
        heapq.heapreplace(heap, (load + size, shard))
        out[unit] = shard
    return out


def shard_documents(docs: DataFrame, shards: int = SHARDS, parts: int = PARTS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot; equal texts share a shard, and slots count from 0 in each shard.

    A null text is grouped with empty ones: it has no bytes. Repeated rows are rows of one group. A group larger than
    a shard's share stays whole, as the law of groups asks, and has a shard almost to itself. No rows in, none out.
    Doc_ids must tell documents apart for the slots to be stable.
    """
    spark: SparkSession = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    with Scratch(spark, "sharding") as scratch:
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("group"))
        rows = scratch.save(rows, "rows", keep=True)
        groups = scratch.save(rows.groupBy("group").agg(F.sum("size").alias("size"), F.count("*").alias("n")), "groups", keep=True)
        total, n = groups.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
        bundles = shards * parts
        large = groups.where(F.col("size") * bundles >= total).select("group", (F.lit(bundles) + F.row_number().over(_by_size())).alias("unit"), "size")
        large = scratch.save(large, "large", keep=True)
        bundle = F.pmod(F.xxhash64("group"), F.lit(bundles)).cast("int")
        small = groups.where(F.col("size") * bundles < total).groupBy(bundle.alias("unit")).agg(F.sum("size").alias("size"))
        sizes = {r["unit"]: r["size"] for r in large.select("unit", "size").unionByName(small).collect()}
        placed = spark.createDataFrame(list(longest_first(sizes, shards).items()), "unit int, shard int")
        # both sides have at most shards x parts rows, of 32 and 8 bytes
        out = rows.join(F.broadcast(large.select("group", "unit")), "group", "left").withColumn("unit", F.coalesce("unit", bundle)).join(F.broadcast(placed), "unit").select("doc_id", "size", "text_crc32", "shard")
        return numbered(scratch.save(out, "placed", keep=True), "shard", ["doc_id", "text_crc32"], "slot", n)


def _by_size():
    from pyspark.sql import Window

    return Window.orderBy(F.desc("size"), "group")  # over at most shards x parts rows
