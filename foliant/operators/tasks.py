"""Client folders, client files and per-file processing tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions import classify_task, drive_link, size_bytes
from foliant.operators.hierarchy import with_parent_id
from foliant.operators.prefix import prefix_members
from foliant.session import FOLDER_MIME


def client_candidates(inventory: DataFrame, root_label: str, status_folders: tuple[str, ...],
                      folders_only: bool = True) -> DataFrame:
    """Candidate client folders: ``indent = 1`` under one of the status folders.

    ``folders_only=False`` keeps indent-1 files too (parity with a listing that
    does not test the type).
    """
    cond = None
    for s in status_folders:
        c = F.startswith(F.col("path"), F.lit(f"{root_label}/{s}/"))
        cond = c if cond is None else (cond | c)
    out = inventory.where((F.col("indent") == 1) & cond)
    if folders_only:
        out = out.where(F.col("mime_type") == FOLDER_MIME)
    return out


def expand_groups(inventory: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates plus the direct child folders of candidates named ``GRUPO*``.

    Returns the folder rows with ``group_name``: the name of the GRUPO parent
    for added children, null for the candidates themselves.
    """
    groups = candidates.where(F.startswith(F.upper("name"), F.lit("GRUPO"))) \
        .select(F.col("id").alias("parent_id"), F.col("name").alias("group_name"))
    children = with_parent_id(inventory).where(F.col("mime_type") == FOLDER_MIME) \
        .join(groups, "parent_id")
    cols = [c for c in candidates.columns]
    base = candidates.withColumn("group_name", F.lit(None).cast("string"))
    return base.unionByName(children.select(*cols, "group_name"))


def client_files(inventory: DataFrame, client_folders: DataFrame, boundary: str = "raw") -> DataFrame:
    """Items under any folder of a client, once per (client, item)."""
    members = prefix_members(inventory, client_folders, ["client"], boundary=boundary,
                             dedupe_by=["client"])
    return members.drop("folder_path")


def folder_members(inventory: DataFrame, client_folders: DataFrame, boundary: str = "raw") -> DataFrame:
    """Items under each (client, pos) folder separately (tree listings)."""
    return prefix_members(inventory, client_folders, ["client", "pos"], boundary=boundary)


def task_columns(files: DataFrame) -> DataFrame:
    """One processing task per client file (all files, IGNORE included)."""
    kind = classify_task("mime_type")
    return files.select(
        "client", F.col("id").alias("file_id"), F.col("name").alias("file_name"),
        F.col("path").alias("file_path"), drive_link("id").alias("drive_link"),
        F.coalesce("mime_type", F.lit("")).alias("mime_type"), size_bytes("size").alias("size"),
        kind["task_type"].alias("task_type"), kind["output_format"].alias("output_format"))


def active_tasks(tasks: DataFrame) -> DataFrame:
    return tasks.where(F.col("task_type") != "IGNORE")


def tasks_by_format(tasks: DataFrame) -> DataFrame:
    """Files and bytes to prepare per client, task type and output format."""
    return tasks.groupBy("client", "task_type", "output_format").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("total_bytes"))
