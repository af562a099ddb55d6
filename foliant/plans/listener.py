"""Listener job: full scans, the poll decision and the listener state.

``scan_to_store`` records the newest page token, then walks the nodes and writes
inventory, nodes and state (token, scan time) as the next generation of the store that
the change stream keeps, so that changes made during the scan are polled once. Each
poll decides, from that one-row state, whether the report changed and whether a
scheduled full scan is due; otherwise the change stream patches the inventory
(``foliant.streaming.changefeed``). ``full_scan`` writes the sorted JSON-lines inventory
alone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.operators.changes import INVENTORY_COLS, NODE_COLS
from foliant.operators.hierarchy import tree_paths
from foliant.schemas import LISTENER_STATE
from foliant.session import RESCAN_INTERVAL_HOURS, materialize, release
from foliant.sources import catalog as C
from foliant.sources import store as ST
from foliant.sources.files import newest_token
from foliant.streaming.changefeed import InventoryStore


def full_scan(spark: SparkSession, nodes: DataFrame, root_id: str, base: str) -> int | None:
    """Walk, write the sorted inventory as the next generation, return it."""
    inv = tree_paths(nodes, root_id)
    gens = ST.list_generations(spark, base)
    gen = (gens[-1] + 1) if gens else 1
    ST.write_inventory_sorted(ST.inventory_to_json_rows(inv), f"{base.rstrip('/')}/gen={gen}")
    for old in (gens + [gen])[:-2]:
        ST._delete(spark, f"{base.rstrip('/')}/gen={old}")
    return gen


def scan_to_store(spark: SparkSession, read_nodes: Callable[[], DataFrame], pages: str, store: InventoryStore, root_id: str,
                  now: dt.datetime) -> int:
    """Full scan into the change stream's store; returns its generation. ``read_nodes`` lists the
    nodes and is called after the token of the newest page of ``pages`` has been taken."""
    token = newest_token(pages)
    nodes = materialize(read_nodes().select(*NODE_COLS))
    inventory = tree_paths(nodes, root_id)
    state = {"last_epoch": -1, "n_polls": 0, **(store.state() or {}), "start_token": token, "last_full_scan_ts": now}
    gen = store.write(inventory.select(*INVENTORY_COLS), nodes, state)
    release(nodes, inventory)
    return gen


def record_report(store: InventoryStore, mtime: dt.datetime) -> int:
    """Note the time of the report that has been processed, in the same state."""
    return store.write(store.read("inventory"), store.read("nodes"), {**(store.state() or {}), "last_report_mtime": mtime})


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """One-row state; missing state = never scanned, no report seen."""
    st = ST.read_generation(spark, path, LISTENER_STATE)
    if st.isEmpty():
        return spark.createDataFrame([(None, None, None)], LISTENER_STATE)
    return st


def write_state(state: DataFrame, path: str) -> None:
    """A new generation, so a state derived from the stored one can be written."""
    ST.rotate_snapshot(state.coalesce(1), path)


def poll_decision(state: DataFrame, latest_report_mtime, now: dt.datetime, full_run: bool = False,
                  hours: int = RESCAN_INTERVAL_HOURS) -> DataFrame:
    """``report_changed`` and ``rescan_due`` for this poll (one row)."""
    now_col = F.lit(now).cast("timestamp")
    out = C.rescan_due(state, now_col, hours)
    return out.withColumn("report_changed",
                          C.report_changed(F.lit(latest_report_mtime).cast("timestamp"),
                                           F.col("last_report_mtime"), full_run))
