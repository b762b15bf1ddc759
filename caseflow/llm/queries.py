"""One registered query per operator, over the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (chat, decontaminate, extract, hardneg, jaccard, language, packing, quality, rules, spelling, substring,
               toxicity, warc)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.join_report(table(spark, sf, "documents"))


def op2_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contamination_report(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op3_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substring.dedup_report(table(spark, sf, "documents"))


def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op5_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_report(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op6_html_extract(spark: SparkSession, sf: str) -> DataFrame:
    return extract.extract_report(table(spark, sf, "pages"))


def op7_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.warc_report(table(spark, sf, "pages"))


def op8_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_report(table(spark, sf, "documents"))


def op9_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return rules.rules_report(table(spark, sf, "documents"))


def op10_language(spark: SparkSession, sf: str) -> DataFrame:
    return language.language_report(table(spark, sf, "documents"))


def op11_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    return hardneg.hard_negatives_report(table(spark, sf, "embeddings"))


def op12_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    return chat.chat_report(table(spark, sf, "conversations"))


def op13_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.spelling_report(table(spark, sf, "documents"))


QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_decontaminate": op2_decontaminate,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_quality": op5_quality,
    "op6_html_extract": op6_html_extract,
    "op7_warc": op7_warc,
    "op8_packing": op8_packing,
    "op9_quality_rules": op9_quality_rules,
    "op10_language": op10_language,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_chat_format": op12_chat_format,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLES = {
    "op2_decontaminate": decontaminate.REPORT_SQL,
    "op3_substring_dedup": substring.REPORT_SQL,
    "op7_warc": warc.REPORT_SQL,
    "op11_hard_negatives": hardneg.REPORT_SQL,
    "op12_chat_format": chat.REPORT_SQL,
}
