"""The corpus pipeline: five operators one after another over the documents.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. Its result is written as Parquet
in the shared folder of ``spark.checkpoint.dir`` and read again as the next one's docs, so a
lost executor costs a stage at most. All stages but the last return the columns of
documents, for any further columns they may have."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import common, decontaminate, language_id, ngram_join, packing, pii
from staylens.session import ship_package


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language that can be told; ``lang`` is what was found."""
    ship_package(spark)
    return language_id.accept(spark, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    ship_package(spark)
    return ngram_join.keep_one(spark, docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ship_package(spark)
    return decontaminate.remove(spark, docs, common.read_table(spark, sf_dir, "benchmark"))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and terms that disclose it replaced; ``n_chars`` follows."""
    ship_package(spark)
    clean = pii.redact(spark, docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences with their ids (little-endian unsigned 32-bit)."""
    ship_package(spark)
    parts = packing.pieces(docs).withColumn("ids_crc32", F.crc32("ids"))
    return packing.pack(parts.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"))


STAGES = [("language_id", language), ("ngram_jaccard_join", near_duplicates), ("decontamination", decontamination),
          ("pii", private_data), ("packing", packed)]

#: Models, alignments and token ids are beyond SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
