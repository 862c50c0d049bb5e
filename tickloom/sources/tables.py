"""Bounded reads, keyed writes and publishing of Parquet datasets."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.model import Dataset


def after_key(key: tuple[str, ...], values: tuple) -> Column:
    """Rows past a cursor in the order of the key: equal on a prefix and greater on the next column."""
    terms = []
    for k in range(len(key)):
        same = [F.col(c) == F.lit(v) for c, v in zip(key[:k], values[:k], strict=True)]
        terms.append(reduce(lambda a, b: a & b, [*same, F.col(key[k]) > F.lit(values[k])]))
    return reduce(lambda a, b: a | b, terms)


def read_dataset(df: DataFrame, ds: Dataset, columns: list[str], equal: dict | None = None, within: tuple[str, object, object] | None = None, after: tuple | None = None, limit: int | None = None) -> DataFrame:
    """Projection, equality (None: null or a sentinel), a half-open range and a cursor; a page is in key order.

    All predicates are column comparisons, so they reach the Parquet scan.
    """
    for name, value in (equal or {}).items():
        df = df.where(ds.is_null(name) if value is None else F.col(name) == F.lit(value))
    if within:
        name, low, high = within
        df = df.where((F.col(name) >= F.lit(low)) & (F.col(name) < F.lit(high)))
    if after:
        df = df.where(after_key(ds.key, after))
    out = df.select(*dict.fromkeys([*ds.key, *columns]))
    return (out.orderBy(*ds.key).limit(limit) if limit else out).select(*columns)


def read_group(reads: dict[str, tuple]) -> dict[str, DataFrame]:
    """Several bounded reads, each with its own arguments."""
    return {name: read_dataset(*given[:-1], **given[-1]) for name, given in reads.items()}


def broken_keys(df: DataFrame, ds: Dataset) -> DataFrame:
    """Rows that a write must not hold: null key or required values, and keys that occur more than once."""
    required = [c for c in dict.fromkeys([*ds.key, *(f.name for f in ds.fields if f.required)])]
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required])
    n = F.count("*").over(Window.partitionBy(*ds.key))
    return df.withColumn("_n", n).where(missing | (F.col("_n") > 1)).drop("_n")


def write_dataset(df: DataFrame, ds: Dataset, path: str) -> None:
    """Appends rows, partitioned as the contract says, after a check of nulls and keys."""
    bad = broken_keys(df, ds).limit(1).count()
    if bad:
        raise ValueError(f"{ds.name}: null in a required column, or a key that repeats")
    df.select(*(f.name for f in ds.fields)).write.mode("append").partitionBy(*ds.partition).parquet(path)


def newest(df: DataFrame, key: list[str], version: list[str]) -> DataFrame:
    """The row of each key with the greatest version."""
    order = Window.partitionBy(*key).orderBy(*(F.desc(c) for c in version))
    return df.withColumn("_k", F.row_number().over(order)).where("_k = 1").drop("_k")


def upserted(old: DataFrame, new: DataFrame, key: list[str], version: str) -> DataFrame:
    """Last write wins for each key; among equal versions the new rows do."""
    both = old.withColumn("_side", F.lit(0)).unionByName(new.withColumn("_side", F.lit(1)))
    return newest(both, key, [version, "_side"]).drop("_side")


def upsert_dataset(spark: SparkSession, new: DataFrame, ds: Dataset, path: str, version: str) -> None:
    """Rewrites only the partitions that the new rows touch."""
    touched = new.select(*ds.partition).distinct()
    old = spark.read.parquet(path).join(touched, list(ds.partition), "left_semi")
    out = upserted(old.select(*new.columns), new, list(ds.key), version)
    # Spark refuses to overwrite what a plan reads; the rows are written beside the target first
    beside = f"{path.rstrip('/')}.upsert-{uuid.uuid4().hex}"
    out.write.parquet(beside)
    out = spark.read.schema(out.schema).parquet(beside)
    _overwrite(out, ds, path)


def missing_rows(new: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key the target lacks."""
    return new.join(target.select(*key), key, "left_anti").select(*new.columns)


def publish_missing(spark: SparkSession, new: DataFrame, ds: Dataset, path: str) -> None:
    write_dataset(missing_rows(new, spark.read.parquet(path), list(ds.key)), ds, path)


def replace_window(new: DataFrame, ds: Dataset, path: str, time: str, low, high) -> None:
    """Rewrites the partitions of a bounded window; rows outside it are refused."""
    outside = new.where(~F.coalesce((F.col(time) >= F.lit(low)) & (F.col(time) < F.lit(high)), F.lit(False))).limit(1).count()
    if outside:
        raise ValueError(f"{ds.name}: rows outside the window")
    _overwrite(new, ds, path)


def _overwrite(df: DataFrame, ds: Dataset, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*ds.partition).parquet(path)


#: Bytes that a compacted file should have.
FILE_BYTES = 128 << 20


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a path, as its file system counts them."""
    to = spark._jvm.org.apache.hadoop.fs.Path(path)
    return to.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(to).getLength()


def _removed(spark: SparkSession, path: str) -> None:
    to = spark._jvm.org.apache.hadoop.fs.Path(path)
    to.getFileSystem(spark._jsc.hadoopConfiguration()).delete(to, True)


def compact_day(spark: SparkSession, source: str, target: str, files: int | None, order: list[str]) -> None:
    """Merges a finished day's small files into sorted ones of some FILE_BYTES, or `files`, and checks rows and contents."""
    rows = spark.read.parquet(source)
    files = files or max(1, -(-stored_bytes(spark, source) // FILE_BYTES))
    rows.repartitionByRange(files, *order).sortWithinPartitions(*order).write.mode("errorifexists").parquet(target)
    if content(rows).first() != content(spark.read.parquet(target)).first():
        raise RuntimeError("the compacted files differ from their source")


class VersionedDay:
    """A day of rows that readers see whole: each version is a folder of its own, and a manifest names the one that counts.

    Rows are staged beside the version in use and checked before the manifest gets its next entry; a reader takes the last
    entry, so it sees the old rows or the new ones. Writers that fail before that entry leave nothing but a staged folder,
    which they remove. `vacuum` removes the folders that no longer count.
    """

    ENTRY = "version long, folder string, files long, n long, x long, s long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def entries(self) -> DataFrame:
        return self.spark.read.schema(self.ENTRY).parquet(f"{self.path}/manifest/*")

    def entry(self):
        """The last entry of the manifest."""
        return self.entries().orderBy(F.desc("version")).first()

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{self.entry().folder}")

    def publish(self, rows: DataFrame, expected=None) -> None:
        """A new version; `expected` is the content that it must have."""
        folder = f"data-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{folder}")
        written = self.spark.read.parquet(f"{self.path}/{folder}")
        found = content(written).first()
        if expected is not None and tuple(found) != tuple(expected):
            _removed(self.spark, f"{self.path}/{folder}")
            raise RuntimeError("the staged rows differ from what was expected")
        files = written.select(F.input_file_name()).distinct().count()
        fs_has = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest")
        first = not fs_has.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(fs_has)
        version = 1 if first else self.entry().version + 1
        entry = self.spark.createDataFrame([(version, folder, files, *found)], self.ENTRY)
        entry.coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/manifest/{version}")  # of two writers one fails here

    def compact(self, order: list[str], file_bytes: int = FILE_BYTES, prepare=None) -> int:
        """Merges the day's files into sorted ones of about file_bytes and returns their number. `prepare` may reshape rows; they must stay the same."""
        now = self.entry()
        rows = self.rows()
        files = max(1, -(-stored_bytes(self.spark, f"{self.path}/{now.folder}") // file_bytes))
        out = (prepare(rows) if prepare else rows).repartitionByRange(files, *order).sortWithinPartitions(*order)
        self.publish(out, (now.n, now.x, now.s))
        return files

    def vacuum(self) -> int:
        """Removes the folders of all versions but the last; for when no reader uses them any more."""
        last = self.entry().folder
        old = [r.folder for r in self.entries().where(F.col("folder") != last).select("folder").collect()]  # one entry a version
        for folder in old:
            _removed(self.spark, f"{self.path}/{folder}")
        return len(old)


def content(df: DataFrame) -> DataFrame:
    """Rows and an order-free digest of all columns."""
    h = F.xxhash64(*sorted(df.columns))
    return df.agg(F.count("*").alias("n"), F.bit_xor(h).alias("x"), F.sum(F.pmod(h, F.lit(1 << 31))).alias("s"))


def export_table(df: DataFrame, path: str, form: str = "parquet") -> DataFrame:
    """Writes a range of a dataset and returns its one-row manifest."""
    writer = df.write.mode("errorifexists")
    writer.option("header", True).csv(path) if form == "csv" else writer.parquet(path)
    return content(df).withColumn("path", F.lit(path)).withColumn("columns", F.lit(",".join(df.columns)))


def latest_part(rows: DataFrame, manifest: DataFrame, key: list[str], batch: str = "batch_id", ok: str = "daily_feature_ok") -> DataFrame:
    """Rows of the part that the manifest names good and newest for each key."""
    good = newest(manifest.where(F.col(ok)), key, [batch]).select(*key, batch)
    return rows.join(good, [*key, batch], "left_semi")
