"""Processor job: all clients' batches -> outputs -> baseline, in one Spark job.

Steps: resolve contents, stop on missing outputs (or skip them when asked),
join batch members to their texts, write the ordered pieces of every ``txt``
batch and a manifest per ``pdf`` batch, then promote the processed plans to the
baseline. A piece is one member's framed text, so no row holds a whole batch.
Outputs are partitioned by client and the processed clients' partitions are
replaced whole: outputs of vanished batches go, also where a client has none left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.operators import assembly as A
from foliant.operators.plandiff import output_names
from foliant.sources import store as ST


def process_all(spark: SparkSession, items: DataFrame, tasks: DataFrame, extracted: DataFrame,
                out_path: str, on_missing: str = "raise", plans_path: str | None = None,
                plan_schema=None, clients: DataFrame | None = None) -> None:
    """``clients`` (``client``): the processed clients; default: those of the tasks and items."""
    if on_missing == "raise":
        A.assert_all_outputs(tasks, extracted)
    elif on_missing != "skip":
        raise ValueError("on_missing must be 'raise' or 'skip'")
    if clients is None:
        clients = tasks.select("client").unionByName(items.select("client"))
    clients = clients.select("client").distinct()
    contents = A.batch_contents(items, extracted, tasks)
    names = output_names(items)
    ST.replace_client_partitions(A.batch_pieces(contents, names), f"{out_path}/txt", clients)
    ST.replace_client_partitions(A.batch_manifest(contents, names), f"{out_path}/manifest", clients)
    if plans_path is not None and plan_schema is not None:
        ST.promote_baseline(spark, plans_path, clients, plan_schema)


def read_outputs(spark: SparkSession, out_path: str) -> DataFrame:
    """Whole text of each output (small cases); large ones are read as ordered pieces."""
    return spark.read.parquet(f"{out_path}/txt").groupBy("client", "output_name").agg(
        F.expr("listagg(piece, '') within group (order by item_pos)").alias("text"))
