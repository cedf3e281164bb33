"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import conversations, decontaminate, html_extract, jaccard_join, langid, license_scan, mixing, packing, pii, secrets, topk, toxicity, whiten
from strata.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.private_data(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.licenses(table(spark, sf_dir, "documents"))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, passes=2)


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(table(spark, sf_dir, "documents"), n=3, percent=90)


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(table(spark, sf_dir, "documents"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_sequences(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whiten(table(spark, sf_dir, "embeddings"), components=8, scale=1024.0)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_report(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_pii": op2_pii,
    "op3_decontaminate": op3_decontaminate,
    "op4_license_scan": op4_license_scan,
    "op5_langid": op5_langid,
    "op6_mixing": op6_mixing,
    "op7_topk": op7_topk,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_html_extract": op9_html_extract,
    "op10_secrets": op10_secrets,
    "op11_packing": op11_packing,
    "op12_whitening": op12_whitening,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE = {
    "op3_decontaminate": decontaminate.OP3_SQL,
    "op7_topk": topk.OP7_SQL,
    "op8_jaccard_join": jaccard_join.OP8_SQL,
}
