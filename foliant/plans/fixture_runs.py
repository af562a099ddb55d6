"""Fixture-bound inputs shared by the registered queries.

These functions only wire the fixtures of ``foliant.fixtures`` to the
operators; each one reads the given tables, so its work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant import fixtures as fx
from foliant.operators.hierarchy import tree_paths
from foliant.operators.tasks import client_candidates, client_files, task_columns
from foliant.session import materialize


_STORED: dict = {}


def _stored(spark: SparkSession, key: tuple, build, written: bool = False) -> DataFrame:
    """A table the pipeline stores once and later stages read (inventory,
    tasks): built on first use per session and kept in the checkpoint folder."""
    k = (spark.sparkContext.applicationId,) + key
    df = _STORED.get(k)
    if df is None:
        df = build()
        if not written:
            df = materialize(df)
        _STORED[k] = df
    return df


def inventory(spark: SparkSession, sf_dir: str, gen: str = "all") -> DataFrame:
    """Inventory of one generation: nodes with path and indent (H1), stored."""
    return _stored(spark, ("inventory", sf_dir, gen),
                   lambda: tree_paths(fx.fx_node(spark, sf_dir, gen), fx.ROOT_ID), written=True)


def client_folders(inv: DataFrame) -> DataFrame:
    """Planner input: every candidate client folder is one client (list pos 0)."""
    cands = client_candidates(inv, fx.ROOT_NAME, fx.STATUS_FOLDERS)
    return cands.select(F.col("name").alias("client"), F.lit(0).alias("pos"),
                        F.col("id").alias("folder_id"), F.col("name").alias("folder_name"),
                        F.col("path").alias("folder_path"))


def tasks_for(spark: SparkSession, sf_dir: str, gen: str = "all") -> DataFrame:
    def build():
        inv = inventory(spark, sf_dir, gen)
        return task_columns(client_files(inv, client_folders(inv)))
    return _stored(spark, ("tasks", sf_dir, gen), build)
