"""Planner job: replan the clients whose files changed, for all clients at once.

Inputs are tables: the current and last-run inventories, the client folder
table (from matching), the last-run plan (items and tasks, for sticky
packing) and the last processed plan (the diff baseline). The per-client
loop of a script becomes the ``client`` column of every join and group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from foliant.operators.packing import repack_batches
from foliant.operators.plandiff import plan_diff
from foliant.operators.snapshots import changed_clients, clients_to_replan
from foliant.operators.tasks import client_files, task_columns
from foliant.session import BATCH_LIMIT_BYTES, materialize


@dataclass
class PlanResult:
    clients: DataFrame
    tasks: DataFrame
    items: DataFrame
    diff: DataFrame


def _only(df: DataFrame | None, clients: DataFrame) -> DataFrame | None:
    return None if df is None else df.join(clients, "client", "left_semi")


def plan_clients(inv_now: DataFrame, inv_prev: DataFrame, client_folders: DataFrame,
                 last_items: DataFrame, last_tasks: DataFrame,
                 base_items: DataFrame | None, base_tasks: DataFrame | None,
                 full_run: bool = False, limit: int = BATCH_LIMIT_BYTES,
                 boundary: str = "raw") -> PlanResult:
    """New plans and cumulative diffs for the clients that need one.

    On a full run every client is replanned from an empty history and the
    baseline counts as empty (all ADDED), as after a reset of the plans.
    """
    members_now = materialize(client_files(inv_now, client_folders, boundary))
    if full_run:
        replan = clients_to_replan(client_folders, client_folders.limit(0), True)
    else:
        members_prev = materialize(client_files(inv_prev, client_folders, boundary))
        replan = changed_clients(members_now, members_prev, client_folders)
    replan = materialize(replan)
    tasks = materialize(task_columns(members_now.join(replan, "client", "left_semi")))
    hist_items = last_items.limit(0) if full_run else _only(last_items, replan)
    hist_tasks = last_tasks.limit(0) if full_run else _only(last_tasks, replan)
    items = materialize(repack_batches(tasks, hist_items, hist_tasks, limit=limit))
    b_items = None if full_run else _only(base_items, replan)
    b_tasks = None if full_run else _only(base_tasks, replan)
    diff = plan_diff(b_items, b_tasks, items, tasks)
    return PlanResult(replan, tasks, items, diff)
