"""The queries of the corpus operators. Those whose results SQL expresses have it in sql.py; tests compare the others with brute force."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import centroids, chat, decontamination, language, licenses, merkle, near_duplicates, packing, quality, secrets, sharding, sql, toxicity, vector_search
from tickloom.llm.common import table

#: Where the tokenizer's file is; another place may be set.
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def remainder(parts: int):
    """crc32 of the doc_id as text, modulo `parts`."""
    return F.pmod(F.crc32(F.col("doc_id").cast("long").cast("string")), F.lit(parts))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder(4) == 2, F.lit(False))
    found = language.identify(docs, language.train(docs.where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_documents(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), words=4)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("detections")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder(3) == 1, F.lit(False))
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings")).drop("centroid")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = merkle.manifest(table(spark, sf_dir, "documents"), {"text": F.replace("text", F.lit("\n"), F.lit(""))}, remainder(2) == 0)
    return out.drop("changed_leaf", "proof", "path")


def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    return chat.digest(chat.format_conversations(turns.unionByName(more)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_packing, op2_vector_search, op3_language, op4_sharding, op5_near_duplicates, op6_quality, op7_licenses, op8_secrets, op9_decontamination, op10_toxicity, op11_centroid_clustering, op12_merkle_manifest, op13_chat_formatting)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return sql.oracle_sql()
