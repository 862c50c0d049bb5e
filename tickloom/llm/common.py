"""What the corpus operators share: tables, durable intermediate tables and gapless numbering."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterable
from typing import ClassVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Only a session on one machine may go without: it gets one of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="tickloom-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named


class Scratch:
    """Tables written to the shared folder to cut lineage. They survive the loss of any executor.

    Leaving the context deletes every table but those saved with keep=True, which lazy results still read; `clear`
    deletes these once their results have been used.
    """

    kept: ClassVar[list[str]] = []

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.done = spark, f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}", []

    def __enter__(self) -> Scratch:
        return self

    def save(self, df: DataFrame, name: str, keep: bool = False) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        (self.kept if keep else self.done).append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for path in [p for p in self.done if not names or p.rsplit("/", 1)[1] in names]:
            _delete(self.spark, path)
            self.done.remove(path)

    def __exit__(self, *_) -> None:
        self.drop()


def _delete(spark: SparkSession, path: str) -> None:
    to = spark._jvm.org.apache.hadoop.fs.Path(path)
    to.getFileSystem(spark._jsc.hadoopConfiguration()).delete(to, True)


def clear(spark: SparkSession) -> None:
    """Deletes the tables that results of this process read. Those results can't be used any more."""
    while Scratch.kept:
        _delete(spark, Scratch.kept.pop())


def numbered(df: DataFrame, group: str, ids: list[str], out: str, rows: int, per_bucket: int = 200_000) -> DataFrame:
    """Adds `out`: 0, 1, 2, ... within each value of `group`, without a gap.

    A group is dealt into hash buckets of about per_bucket rows, each numbered by itself; running totals of the
    bucket counts shift the numbers. So a group that holds most rows is still spread over many tasks. `df` is read
    twice and must return the same rows both times; `ids` must tell its rows apart.
    """
    buckets = max(64, -(-rows // per_bucket))
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*ids), F.lit(buckets)).cast("int"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = dealt.groupBy(group, "_bucket").agg(F.count("*").alias("_n")).select(group, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    own = Window.partitionBy(group, "_bucket").orderBy(*ids)
    return dealt.withColumn("_own", F.row_number().over(own) - 1).join(shifts, [group, "_bucket"]).withColumn(out, F.col("_shift") + F.col("_own")).drop("_bucket", "_own", "_shift")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: Bytes of rows that a task holds as Python objects at once, unless one row has more.
PART_BYTES = 4 << 20

_kept: dict = {}


def kept(name, make: Callable):
    """A worker's one large object that outlives its tasks; asking for another, or a task that asks for none, drops it."""
    if name not in _kept:
        _kept.clear()
        _kept[name] = make()
    return _kept[name]


def released() -> None:
    """Gives memory that a Python worker no longer uses back to the system, where the JVM beside it can have it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_columns(df: DataFrame, f: Callable[..., Iterable], schema: str, rows: int = 256, keeps: bool = False) -> DataFrame:
    """df.mapInArrow with plain lists: f gets each column of up to `rows` rows and returns the new columns.

    Lists keep nulls and whole numbers as they are, which pandas would turn into floats. keeps: f uses `kept`.
    """
    kinds = [(x.name, to_arrow_type(x.dataType)) for x in T.StructType.fromDDL(schema)]

    def run(batches):
        if not keeps:
            _kept.clear()
        for batch in batches:
            low = 0
            while low < batch.num_rows:
                part = batch.slice(low, rows)
                while part.num_rows > 1 and part.nbytes > PART_BYTES:
                    part = part.slice(0, part.num_rows // 2)
                low += part.num_rows
                made = f(*(c.to_pylist() for c in part.columns))
                yield pa.RecordBatch.from_arrays([pa.array(c, type=kind) for c, (_, kind) in zip(made, kinds, strict=True)], [n for n, _ in kinds])
        released()

    return df.mapInArrow(run, schema)
