"""The corpus pipeline: quality, near-duplicates, decontamination, secrets, packing.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of documents. Between stages the rows are
written as Parquet to the folder that the cluster shares, and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import decontamination, near_duplicates, packing, quality, secrets
from tickloom.llm.common import Scratch, table
from tickloom.llm.queries import tokenizer_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group that links of five-word shingles at 0.8 reach: that of the least doc_id, nulls last.

    A 64-bit hash of all columns stands for the row, so rows without doc_id and rows that repeat one are compared like
    all others. Ties go by that hash; of rows equal in all columns one stays. Blank texts link with nothing and stay.
    """
    taken = {c.lower() for c in docs.columns}
    row = next(name for name in (f"_row{'_' * k}" for k in range(len(taken) + 1)) if name not in taken)
    keyed = docs.withColumn(row, F.xxhash64(*docs.columns, *(F.col(c).isNull() for c in docs.columns)))
    near = near_duplicates.near_duplicates(keyed.select(F.col(row).alias("doc_id"), "text"), words=5, threshold=0.8)
    own = near.groupBy(F.col("doc_id").alias(row)).agg(F.min("component_id").alias("component"), F.max("n_shingles").alias("size"), F.count("*").alias("n"))
    named = own.join(keyed.groupBy(row).agg(F.min("doc_id").alias("id")), row)
    first = named.where("size > 0").groupBy("component").agg(F.min(F.struct(F.col("id").isNull(), "id", row, "n")).alias("x")).select(f"x.{row}", "x.n")
    stay = first.unionByName(own.where("size = 0").select(row, F.lit(1).alias("n")))
    left = keyed.join(stay.where("n = 1").select(row), row, "left_semi")
    again = first.where("n > 1").select(row)
    if again.limit(1).count():
        left = left.unionByName(keyed.join(again, row, "left_semi").dropDuplicates([row]))
    return left.select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked; n_chars counts the new text's characters."""
    found = secrets.secret_spans(docs.select("doc_id", "text", "lang", "source", "n_chars"), out="_spans")
    changed = F.size("_spans") > 0
    masked = found.withColumn("text", secrets.masked(F.col("text"), F.col("_spans")))
    return masked.select("doc_id", "text", "lang", "source", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality", keep_quality),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack_documents),
]

#: SQL can't express classifiers, sketches or tokenizers; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = scratch.save(docs, str(k), keep=k + 2 == len(STAGES))  # the last stage reads its input when its rows are asked for
            scratch.drop(str(k - 1))
    return docs
