"""One registered query for each corpus operator: the whole intended table, with the parameters meant for production."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagmill.llm import leaks, licenses, mixing, negatives, neighbours, pages, pii, quality, ranking, simhash, suffixes, tokens, toxicity
from tagmill.llm.common import table


def op1_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(table(spark, sf_dir, "pages"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.learn(docs))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), F.col("quality_score").alias("score"), F.col("quality_predicted").alias("predicted"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), tokens.default_vocabulary())


def op7_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint(found["fp"]).alias("fingerprint"), "component_id")


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return neighbours.search(rows, rows.where("vec_id % 20 = 0"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.sample(table(spark, sf_dir, "documents"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"), F.col("toxic").alias("predicted"), "n_hits", "n_misspelled", "n_quoted")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_page_text": op1_page_text,
    "op2_decontamination": op2_decontamination,
    "op3_personal_data": op3_personal_data,
    "op4_license_scan": op4_license_scan,
    "op5_quality": op5_quality,
    "op6_token_counts": op6_token_counts,
    "op7_repeated_strings": op7_repeated_strings,
    "op8_simhash": op8_simhash,
    "op9_neighbours": op9_neighbours,
    "op10_mixing": op10_mixing,
    "op11_toxicity": op11_toxicity,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_lexical_search": op13_lexical_search,
}

ORACLE_SQL: dict[str, str] = {
    "op10_mixing": mixing.oracle_sql(),
    "op12_hard_negatives": negatives.oracle_sql(),
    "op13_lexical_search": ranking.oracle_sql(),
}
