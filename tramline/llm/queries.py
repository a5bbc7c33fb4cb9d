"""The registered queries of this package: each applies its operator to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm import embeddings, licenses, linededup, mixing, packing, simhash, toxicity, urls, warc, webp
from tramline.llm.shared import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive(warc.responses_of_pages(table(spark, sf_dir, "pages")), keep=("page_id",))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).drop("source", "copy", "epochs")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_webp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return webp.columns(table(spark, sf_dir, "documents")).drop("media")


def op6_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.summary(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages")).drop("component")


QUERIES = {f.__name__: f for f in (op1_warc, op2_licenses, op3_mixing, op4_simhash, op5_webp, op6_linededup, op7_packing, op8_embeddings, op9_toxicity, op10_urls)}
ORACLES = {"op1_warc": warc.oracle(), "op2_licenses": licenses.oracle(), "op10_urls": urls.oracle()}
