"""The registered query of each operator: production parameters, whole tables, full results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import centroids, certified_packing, chat_format, decontaminate, html_extract, language_id, ngram_join, packing, periodic_runs, pii, quality_rules, token_counts, toxicity
from staylens.llm.common import crc_bucket, read_table
from staylens.llm.oracles import ORACLES  # noqa: F401


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_bucket(F.col("doc_id"), 5) == 0
    found = toxicity.toxicity(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), learn=~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = packing.pieces(read_table(spark, sf_dir, "documents"))
    digests = parts.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return packing.pack(digests)


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages")).withColumn(
        "n_chars", F.length("text").cast("bigint"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.with_limit(token_counts.token_counts(read_table(spark, sf_dir, "documents")))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(read_table(spark, sf_dir, "documents"))


#: A conversation whose texts look like another template's control strings.
MARKS = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = spark.createDataFrame(MARKS, "conv_id long, turn long, role string, text string")
    out = chat_format.chat_format(turns.unionByName(marks))
    read = out.withColumn("turns", chat_format.read_back(F.col("formatted"))).withColumn(
        "loss", chat_format.loss_text(F.col("segments")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_classes(spark, read_table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = crc_bucket(F.col("doc_id"), 3) == 1
    found = language_id.identify(spark, docs, learn=~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, terms = pii.find(spark, read_table(spark, sf_dir, "documents"))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == pii.KINDS.index(kind))).cast("bigint")
    return pii.with_terms(found, terms).select(
        "doc_id", *(n(k).alias(f"n_{k}") for k in pii.KINDS[:4]),
        F.sha2(pii.span_text(F.col("base")), 256).alias("base_sha256"), pii.span_text(F.col("spans")).alias("spans"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(periodic_runs.with_periodic_tail(read_table(spark, sf_dir, "documents")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(
        F.array_join(F.array(r["start"], r["length"], r["period"]), ","), F.lit("\n"))), "")
    best = F.col("best")
    return found.withColumn("best", periodic_runs.longest_run(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(spark, read_table(spark, sf_dir, "embeddings"))
    return centroids.with_inertia(spark, found).select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia",
        F.sha2(F.array_join("centroid", ","), 256).alias("centroid_sha256"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = certified_packing.pieces(read_table(spark, sf_dir, "documents"))
    return certified_packing.pack(spark, parts.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_packing, op3_html_extraction, op4_token_counts, op5_decontamination, op6_quality_rules, op7_chat_formatting, op8_ngram_jaccard_join, op9_language_id, op10_pii, op11_periodic_runs, op12_centroid_clustering, op13_best_fit_packing)}

