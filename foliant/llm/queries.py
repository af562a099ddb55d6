"""Registered queries of the operators: each applies one operator, with its
production parameters, to its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foliant.llm import (decontaminate, license_scan, lm_scoring, near_dedup, periodic_runs, quality_classifier,
                         quality_rules, sentencepiece_codec, suffix_dedup, toxicity, url_filter, warc, whitening)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def piece_model() -> str:
    import public_tokenizers
    return str(public_tokenizers.path("piece_bpe_32k.model"))


def op1_sentencepiece(spark, sf_dir):
    return sentencepiece_codec.digest(table(spark, sf_dir, "documents"), piece_model())


def op2_decontaminate(spark, sf_dir):
    return decontaminate.digest(decontaminate.decontaminate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op3_lm_scoring(spark, sf_dir):
    return lm_scoring.cross_entropy_difference(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_near_dedup(spark, sf_dir):
    return near_dedup.near_dedup(table(spark, sf_dir, "documents"))


def op5_license_scan(spark, sf_dir):
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op6_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op8_quality_rules(spark, sf_dir):
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_suffix_dedup(spark, sf_dir):
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark, sf_dir):
    return quality_classifier.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_periodic_runs(spark, sf_dir):
    return periodic_runs.digest(periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), periodic_runs.planted))


def op12_embedding_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return url_filter.url_filter(pages, url_filter.broken_pages(pages))


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_decontaminate": op2_decontaminate,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_near_dedup": op4_near_dedup,
    "op5_license_scan": op5_license_scan,
    "op6_toxicity": op6_toxicity,
    "op7_warc": op7_warc,
    "op8_quality_rules": op8_quality_rules,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_url_filter": op13_url_filter,
}

SQL: dict[str, str] = {
    "op2_decontaminate": decontaminate.SQL,
    "op4_near_dedup": near_dedup.SQL,
    "op7_warc": warc.SQL,
    "op13_url_filter": url_filter.SQL,
}
