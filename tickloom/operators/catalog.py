"""The data catalog: what is described, what is there, and what it holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.model import Dataset


def catalog_list(spark: SparkSession, described: list[Dataset], physical: dict[str, DataFrame]) -> DataFrame:
    """Physical and described objects: presence, class, rows, first and last time, upstream, tags. One aggregate each."""
    known = {d.name: d for d in described}
    rows = None
    for name in sorted({*known, *physical}):
        ds = known.get(name)
        df, time = physical.get(name), ds.event_time if ds else ""
        head = [F.lit(name).alias("name"), F.lit("both" if ds is not None and df is not None else "physical" if df is not None else "described").alias("presence"), F.lit(ds.kind if ds else "TABLE").alias("kind")]
        tail = [F.lit(",".join(ds.depends_on) if ds else "").alias("upstream"), F.lit(",".join(ds.tags) if ds else "").alias("tags")]
        if df is None:
            one = spark.range(1).select(*head, F.lit(None).cast("long").alias("n"), F.lit(None).cast("string").alias("first_time"), F.lit(None).cast("string").alias("last_time"), *tail)
        else:
            when = (F.date_format(F.min(time), "yyyy-MM-dd"), F.date_format(F.max(time), "yyyy-MM-dd")) if time else (F.lit(None).cast("string"),) * 2
            one = df.agg(F.count("*").alias("n"), when[0].alias("first_time"), when[1].alias("last_time")).select(*head, "n", "first_time", "last_time", *tail)
        rows = one if rows is None else rows.unionByName(one)
    return rows


def catalog_filter(catalog: DataFrame, presence: str | None = None, tag: str | None = None, text: str | None = None) -> DataFrame:
    for wanted, check in ((presence, F.col("presence") == presence), (tag, F.array_contains(F.split("tags", ","), F.lit(tag))), (text, F.contains(F.lower("name"), F.lit((text or "").lower())))):
        if wanted is not None:
            catalog = catalog.where(check)
    return catalog


def catalog_page(catalog: DataFrame, page: int, size: int) -> DataFrame:
    return catalog.orderBy("name").offset(page * size).limit(size)


def catalog_tags(catalog: DataFrame) -> DataFrame:
    return catalog.select(F.explode(F.split("tags", ",")).alias("tag")).where("tag <> ''").groupBy("tag").agg(F.count("*").alias("n"))


def catalog_detail(spark: SparkSession, ds: Dataset) -> DataFrame:
    rows = [(ds.name, k, f.name, f.kind, f.required or f.name in ds.key, f.name in ds.key, f.doc) for k, f in enumerate(ds.fields)]
    return spark.createDataFrame(rows, "name string, position int, column string, kind string, required boolean, is_key boolean, doc string")
