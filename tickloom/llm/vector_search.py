"""Nearest neighbours by inner product over randomly rotated one-bit codes.

Each vector, scaled to length one, is rotated by one random orthogonal matrix and kept as the signs of its
coordinates, packed to bits, with two scalars: its length and the inner product of the scaled vector with its code.
The rotated query is rounded to QUERY_BITS bits a coordinate, so its inner product with a code is a sum of population
counts of packed bits. That product, over the scalar, estimates the query's with the vector; the code's scalar also
bounds the error, which shrinks with the square root of the dimension. The best estimates are scored on the original
vectors first; then all rows whose upper bound reaches the query's k-th best score.

The index is exhaustive: every row has a code, none is sampled. Queries and rows are dealt into blocks and each task
compares one block of either, so tasks are bounded however many copies of a vector there are.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.common import Scratch, map_columns

#: Vectors and queries that meet in one task.
ROW_BLOCK, QUERY_BLOCK = 32_768, 8_192
#: Standard deviations in the error bound.
BOUND = 1.9
#: Bits of a coordinate of a rotated query.
QUERY_BITS = 4
#: Rows that are estimated at once for STEP queries, best estimates scored first for each of the k wanted, and pairs scored at once.
STEP, FIRST, PAIRS = 64, 4, 1 << 15


def rotation(size: int) -> np.ndarray:
    """A random orthogonal matrix, the same everywhere for one size."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(size)).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, lengths, and inner products of the scaled vectors with their codes."""
    lengths = np.sqrt((vectors * vectors).sum(1))
    turned = vectors / lengths[:, None] @ turn
    return np.packbits(turned > 0, axis=1), lengths, np.abs(turned).sum(1) / math.sqrt(vectors.shape[1])


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def codes(rows: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """The index: id, size, bits, length and fit of every usable vector, and the vector for reranking."""

    def of(ids: list, vectors: list) -> tuple:
        out: list = [None] * len(ids)
        sizes = np.array([len(v) for v in vectors])
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            bits, lengths, fit = encode(np.array([vectors[k] for k in at], np.float64), rotation(int(size)))
            for n, k in enumerate(at):
                out[k] = (bits[n].tobytes(), lengths[n], fit[n])
        return ids, sizes, *zip(*out, strict=True), vectors

    # vectors travel in the precision that they have
    kind = "float" if rows.schema[vector].dataType.elementType.typeName() == "float" else "double"
    kept = rows.where(usable(F.col(vector)) & F.col(key).isNotNull()).select(F.col(key).cast("long"), F.col(vector).cast(f"array<{kind}>"))
    return map_columns(kept, of, f"id long, size int, bits binary, length double, fit double, vector array<{kind}>", 2048)


def words(bits: np.ndarray) -> np.ndarray:
    """Packed bytes of codes as rows of 64-bit words; what is beyond the size is 0."""
    spare = -bits.shape[1] % 8
    return np.pad(bits, ((0, 0), (0, spare))).view(np.uint64)


def products(turned: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inner products of rotated queries with codes of +1 and -1, by population counts, and each query's rounding step."""
    low, high = turned.min(1, keepdims=True), turned.max(1, keepdims=True)
    step = np.maximum(high - low, 1e-30) / ((1 << QUERY_BITS) - 1)
    level = np.rint((turned - low) / step).astype(np.uint8)
    total = np.zeros((len(turned), len(codes)), np.int32)
    for k in range(QUERY_BITS):
        plane = words(np.packbits(level >> k & 1, axis=1))
        for w in range(codes.shape[1]):
            total += np.bitwise_count(plane[:, w, None] & codes[None, :, w]).astype(np.int32) << k
    ones = np.bitwise_count(codes).sum(1)
    sums = turned.sum(1, keepdims=True)
    return (2 * (step * total + low * ones) - sums).astype(np.float32), step


def scores(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, summed for each pair in the same order, so equal vectors tie exactly."""
    return (vectors * query).sum(axis=-1)


def _best(query: np.ndarray, score: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k best pairs, best first, ties to smaller ids."""
    order = np.lexsort((own, -score, query))
    first = np.searchsorted(query[order], query[order])
    return order[np.arange(len(order)) - first < k]


def _search_block(queries: pa.Table, rows: pa.Table, k: int, bound: float) -> pa.Table:
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    if not queries.num_rows or not rows.num_rows:
        return out.empty_table()
    size = rows.column("size")[0].as_py()
    array = lambda t: t.column("vector").combine_chunks().flatten().to_numpy().reshape(t.num_rows, size).astype(np.float64)
    vectors, turn, ids = array(rows), rotation(size), rows.column("id").to_numpy()
    lengths, fit = rows.column("length").to_numpy(), rows.column("fit").to_numpy()
    codes = words(np.frombuffer(b"".join(rows.column("bits").to_pylist()), np.uint8).reshape(len(ids), -1))
    scale = (lengths / fit / math.sqrt(size)).astype(np.float32)
    spread = (bound * np.sqrt(np.maximum(1 - fit**2, 0)) / fit / math.sqrt(max(size - 1, 1)) * lengths).astype(np.float32)
    every, all_ids = array(queries), queries.column("id").to_numpy()
    found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
    for low in range(0, len(every), STEP):
        asked, query_ids = every[low : low + STEP], all_ids[low : low + STEP]
        code, step = products(asked @ turn, codes)
        estimate = code * scale
        # rounding to half a step moves each coordinate evenly; its own deviation is step / sqrt(12)
        error = np.sqrt((asked**2).sum(1))[:, None] * spread + (bound * step / math.sqrt(12) * math.sqrt(size)) * scale
        other = query_ids[:, None] != ids

        def scored(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            return np.concatenate([scores(asked[x[a : a + PAIRS]], vectors[y[a : a + PAIRS]]) for a in range(0, len(x), PAIRS)] or [np.empty(0)])  # noqa: B023

        n = min(len(ids), FIRST * k + 1)
        top = np.argpartition(-np.where(other, estimate, -np.inf), n - 1, axis=1)[:, :n]
        x = np.repeat(np.arange(len(asked)), n)
        first = np.where(np.take_along_axis(other, top, 1), scored(x, top.ravel()).reshape(len(asked), n), -np.inf)
        least = np.sort(first, axis=1)[:, -k] if n >= k else np.full(len(asked), -np.inf)
        near = other & (estimate + error >= least[:, None])
        np.put_along_axis(near, top, np.take_along_axis(other, top, 1), axis=1)
        x, y = np.nonzero(near)
        score = scored(x, y)
        reach = score >= least[x]
        x, y, score = x[reach], y[reach], score[reach]
        best = _best(x, score, ids[y], k)
        found.append((query_ids[x[best]], ids[y[best]], score[best]))
    return pa.table([np.concatenate(c) for c in zip(*found, strict=True)], schema=out)


def nearest(rows: DataFrame, is_query: Column, k: int = 20, vector: str = "embedding", key: str = "vec_id", bound: float = BOUND) -> DataFrame:
    """query_id, rank from 1, vec_id, score: each query's k best other rows by inner product, ties to smaller ids.

    Queries are the usable rows where `is_query` holds. Null or zero vectors, vectors with null or non-finite
    components and rows without id take no part. Vectors of another size than the query's are no candidates of it. A
    query with fewer candidates gets them all; an id that repeats is a candidate each time. No rows in, none out.
    """
    spark: SparkSession = rows.sparkSession
    with Scratch(spark, "search") as scratch:
        index = scratch.save(codes(rows.select(F.col(key), F.col(vector)), vector, key), "codes", keep=True)
        asked = index.where(is_query(F.col("id")) if callable(is_query) else is_query)
        n, m = index.count(), asked.count()
        row_blocks, query_blocks = max(4, math.ceil(n / ROW_BLOCK)), max(2, math.ceil(m / QUERY_BLOCK))
        spread = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
        own = lambda blocks, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(blocks)).cast("int")
        left = asked.select("size", "id", "vector", own(query_blocks, 1).alias("q")).select("*", spread(row_blocks).alias("r"))
        right = index.select("size", "id", "bits", "length", "fit", "vector", own(row_blocks, 2).alias("r")).select("*", spread(query_blocks).alias("q"))
        block = ["size", "q", "r"]
        found = left.groupBy(*block).cogroup(right.groupBy(*block)).applyInArrow(lambda a, b: _search_block(a, b, k, bound), "query_id long, vec_id long, score double")
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
