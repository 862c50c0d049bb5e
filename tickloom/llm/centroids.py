"""k-means over whole numbers in JVM expressions: exact sums and distances, the same clusters on any partitioning.

Distances are zip_with and aggregate over arrays, centroids are literals of the expression, and a round's new centroids
are one aggregate of columns that each task sums before the shuffle. Only sums and counts of the k clusters reach the
driver, whatever the number of vectors. No rows are kept between rounds, so a lost executor costs its tasks alone.

Defined results: vectors that are null, of another length or with a null or non-finite component take no part. Rows
without vec_id are clustered but found no centroid. Rows that share a vec_id are clustered one by one; where they vie for a
first centroid, the lesser vector comes first. Components beyond +-2^27 after scaling count as +-2^27, so that squared
distances fit a long. An inertia that no long holds is null. With fewer than k usable rows there are as many centroids; with none, no rows.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import Scratch

LARGEST = 1 << 27


def whole_vectors(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", size: int = 64, scale: int = 256) -> DataFrame:
    """(id, v): usable vectors with components floor(scale * x)."""
    v = F.col(vector)
    sound = F.forall(v, lambda x: F.coalesce((F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x), F.lit(False)))
    whole = F.transform(v, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))))
    return vectors.where((F.size(v) == size) & sound).select(F.col(id).alias("id"), whole.alias("v"))


def distance(v: Column, c: Column) -> Column:
    """Squared Euclidean distance of two arrays of longs."""
    return F.aggregate(F.zip_with(v, c, lambda a, b: (a - b) * (a - b)), F.lit(0).cast("long"), lambda s, x: s + x)


def nearest(v: Column, centroids: list[list[int]]) -> Column:
    """Struct (distance, cluster) of the nearest centroid; ties go to the smaller number."""
    known = F.from_json(F.lit(json.dumps(centroids)), "array<array<bigint>>")  # the optimizer folds it to one literal
    return F.array_min(F.transform(known, lambda c, k: F.struct(distance(v, c).alias("distance"), k.alias("cluster"))))


def first_centroids(whole: DataFrame, k: int, salt: str) -> list[list[int]]:
    """The k vectors with the least sha256 of salt:id, by that hash."""
    mark = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256)
    return [list(r.v) for r in whole.where("id is not null").select(mark.alias("mark"), "v").orderBy("mark", "v").limit(k).collect()]


def moved(whole: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Each centroid at the floor of its vectors' mean; one without vectors stays."""
    size = len(centroids[0])
    sums = whole.select(nearest(F.col("v"), centroids)["cluster"].alias("cluster"), "v").groupBy("cluster").agg(F.count("*").alias("n"), *(F.sum(F.col("v")[j]).alias(f"s{j}") for j in range(size)))
    out = list(centroids)
    for r in sums.collect():  # one row a cluster
        out[r.cluster] = [r[f"s{j}"] // r.n for j in range(size)]
    return out


def cluster(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", k: int = 40, rounds: int = 5, size: int = 64, scale: int = 256, salt: str = "2") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid, centroid_sha256), a row for each usable vector."""
    whole = whole_vectors(vectors, id, vector, size, scale)
    centroids = first_centroids(whole, k, salt)
    for _ in range(rounds if centroids else 0):
        centroids = moved(whole, centroids)
    spark = vectors.sparkSession
    found = nearest(F.col("v"), centroids) if centroids else F.lit(None).cast("struct<distance: bigint, cluster: int>")
    assigned = whole.select("id", F.explode(F.array(found)).alias("x")).select("id", "x.*")  # explode: computed once, not by each column
    with Scratch(spark, "centroids") as scratch:
        assigned = scratch.save(assigned, "assigned", keep=True)
    inertia = {r.cluster: r.x for r in assigned.groupBy("cluster").agg(F.try_sum("distance").alias("x")).collect()}  # one row a cluster
    total = None if None in inertia.values() or sum(inertia.values()) >= 1 << 63 else sum(inertia.values())
    rows = [(c, inertia.get(c), total, v) for c, v in enumerate(centroids)]
    known = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    digest = F.sha2(F.array_join("centroid", ","), 256)
    return assigned.join(F.broadcast(known), "cluster").select(F.col("id").alias(id), "cluster", "distance", "cluster_inertia", "inertia", "centroid", digest.alias("centroid_sha256"))  # k rows are sent
