"""Bounded training samples and one-task training for the classifiers."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of`` (null id: null)."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(of)).cast("int")


def sample(docs: DataFrame, labels: DataFrame, label: str, of: int, held_out: int, rows: int) -> DataFrame:
    """``text, y`` of at most ``rows`` labelled rows outside the held-out remainder.

    The rows are those with the smallest hash of the id, so the sample depends
    on no order of the tables. Rows without id or label are not used. The list
    of ids is bounded by ``rows`` and broadcast; equal rows of an id count once, and
    of rows that repeat an id those with the smallest hash are used, within ``rows``.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).where("doc_id is not null and y is not null")
    chosen = known.where(remainder(F.col("doc_id"), of) != held_out).distinct() \
        .orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(rows)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id") \
        .select("doc_id", F.xxhash64("doc_id", "text").alias("_at"), "text", "y")
    return found.dropDuplicates(["doc_id", "_at", "y"]).orderBy("_at", "y").limit(rows).select("_at", "text", "y")


def train_in_task(rows: DataFrame, fit: Callable[[list[str], list[int]], bytes]) -> bytes:
    """Run ``fit(texts, labels)`` on a bounded sample in one task; give what it returns."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["_at", "y"], kind="stable")
        texts = [t if isinstance(t, str) else "" for t in part["text"]]
        return pd.DataFrame({"model": [fit(texts, part["y"].tolist())]})

    got = rows.withColumn("_one", F.lit(0)).groupBy("_one").applyInPandas(run, "model binary").first()
    return bytes(got["model"]) if got else fit([], [])
