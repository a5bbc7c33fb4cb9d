"""From raw documents to packed training sequences, in stages that each write what the next one reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tramline.llm import linededup, mixing, packing, simhash, toxicity
from tramline.llm.queries import tokenizer_path
from tramline.llm.shared import saved, scratch, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine, fitted on the labels of those here, doesn't call toxic."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the long lines that five or more share, but for one place each."""
    return linededup.deduped(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts whose five-word shingles have a similarity of 0.8 or more: candidates by
    fingerprints compared in tiles of population counts, then by least shingles, each pair verified."""
    return simhash.one_of_similar(docs, similarity=0.8, shingle=5)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document once, twice or not at all, as its source's share of the mix asks."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in sequences of 2048 tokens."""
    return packing.packed(docs, tokenizer_path())


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_lines), ("near_dedup", drop_near_copies), ("mixing", mix), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage reads the table that the one before wrote; tables within a stage are freed
    when its own is written. Nulls, empty and long texts, repeats and no documents at all are for each stage to define;
    columns beside those of `documents` don't enter."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for _, stage in STAGES[:-1]:
        kept: list[DataFrame] = []
        with scratch(kept):
            docs = saved(stage(spark, docs, sf_dir))
            kept.append(docs)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Trained scores and connected components can't be told in SQL; the tests hold each stage against plain Python.
ORACLE_SQL = None
