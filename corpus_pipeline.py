"""Corpus pipeline: five stages from raw documents to token ids.

Every stage takes ``(spark, docs, sf_dir)``, works on all documents that the one
before kept, and returns a DataFrame that is written as Parquet and read again as
the next one's ``docs``. All but the last return the columns of ``documents``:

1. quality rules: documents that the rules reject go;
2. MinHash near-dedup: one document of each group stays;
3. suffix-array dedup: repeated passages are cut out of the texts (``n_chars`` follows);
4. benchmark decontamination: documents that hold a benchmark window go;
5. SentencePiece: token ids of every text, with the digests of ids and decoded text.

Null texts pass the rules of none: stage 1 rejects them with all texts that are
too short. Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foliant.llm import decontaminate, near_dedup, quality_rules, sentencepiece_codec, suffix_dedup
from foliant.llm.queries import piece_model, table
from foliant.session import materialize, release


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs)


def distinct_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.cut_repeats(docs)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode(docs, piece_model(), with_text=False)


STAGES = [
    ("quality_rules", good_documents),
    ("near_dedup", distinct_documents),
    ("suffix_dedup", distinct_passages),
    ("decontamination", clean_documents),
    ("sentencepiece", token_ids),
]

#: SQL can't express the trained ratios of stage 1 nor the token ids of stage 5.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        following = materialize(stage(spark, docs, sf_dir))
        if n:
            release(docs)
        docs = following
    return docs
