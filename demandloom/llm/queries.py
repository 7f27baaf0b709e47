"""The operators of this subpackage as registered queries, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.llm.conversations import repaired_after_damage
from demandloom.llm.crossentropy import cross_entropy_difference
from demandloom.llm.divergence import source_divergence
from demandloom.llm.hyperminhash import near_duplicates
from demandloom.llm.licenses import license_scan
from demandloom.llm.mixing import mix_sources
from demandloom.llm.neighbours import nearest
from demandloom.llm.ngram_join import ngram_join
from demandloom.llm.oracles import ORACLES
from demandloom.llm.passages import repeated_passages
from demandloom.llm.quality import quality_scores
from demandloom.llm.tiling import contamination
from demandloom.llm.toxicity import toxicity_scores
from demandloom.llm.warc import archive_folder, read_archive, write_archive


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder = archive_folder(pages)
    return read_archive(write_archive(pages, folder), folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


def op8_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target set is the documents rated good."""
    return cross_entropy_difference(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where("quality = 1"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).withColumn("weight", F.round("weight", 9))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"), size=3, percent=90)


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired_after_damage(table(spark, sf_dir, "conversations"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_warc": op1_warc, "op2_passages": op2_passages, "op3_quality": op3_quality, "op4_licenses": op4_licenses,
    "op5_toxicity": op5_toxicity, "op6_neighbours": op6_neighbours, "op7_decontamination": op7_decontamination,
    "op8_cross_entropy": op8_cross_entropy, "op9_mixing": op9_mixing, "op10_ngram_join": op10_ngram_join,
    "op11_conversations": op11_conversations, "op12_minhash": op12_minhash, "op13_divergence": op13_divergence,
}
