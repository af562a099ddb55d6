"""Catalog lookups over a file catalog table (``id, parent_id, name, mtime, trashed``).

Every lookup is a filter plus an aggregate keyed by the folder, so all
folders are answered in one job; ``min_by``/``max_by`` aggregate partially on
the map side, so a folder holding a large share of the catalog is never
gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def name_matches(name_col, wanted: str):
    """Equality, or containment when the wanted name starts with '.'."""
    if wanted.startswith("."):
        return F.col(name_col).contains(wanted)
    return F.col(name_col) == F.lit(wanted)


def catalog_lookup(catalog: DataFrame, wanted: str, by: str = "parent_id", mime_type: str | None = None,
                   parent_id: str | None = None, order_by: str | None = None, descending: bool = False) -> DataFrame:
    """First non-trashed item per folder whose name matches, in the order of ``order_by``
    (none: of the ids; ties: smallest id), if asked for only of one mime type or in one folder."""
    hits = catalog.where(name_matches("name", wanted) & ~F.coalesce(F.col("trashed"), F.lit(False)))
    if mime_type is not None:
        hits = hits.where(F.col("mime_type") == mime_type)
    if parent_id is not None:
        hits = hits.where(F.col("parent_id") == parent_id)
    if order_by is not None:
        first = (F.max if descending else F.min)(order_by)
        hits = hits.join(hits.groupBy(by).agg(first.alias("_first")), by).where(F.col(order_by).eqNullSafe(F.col("_first")))
    return hits.groupBy(by).agg(
        F.min_by(F.struct("id", "name", "mtime"), F.col("id")).alias("hit")).select(by, "hit.*")


def latest_by_mtime(catalog: DataFrame, wanted: str, by: str = "parent_id") -> DataFrame:
    """Newest non-trashed matching item per folder (ties: smallest id)."""
    hits = catalog.where(name_matches("name", wanted) & ~F.coalesce(F.col("trashed"), F.lit(False)))
    order = F.struct((-F.unix_micros(F.col("mtime").cast("timestamp"))).alias("t"), F.col("id").alias("i"))
    return hits.groupBy(by).agg(
        F.min_by(F.struct("id", "name", "mtime"), order).alias("hit")).select(by, "hit.*")


def select_plans(catalog: DataFrame, limit_clients: int | None = None) -> DataFrame:
    """Current plan files: name contains ``_plan.json`` and neither version marker.

    ``limit_clients`` keeps the first n by name (test-run mode).
    """
    out = catalog.where(F.col("name").contains("_plan.json")
                        & ~F.col("name").contains("_last_run")
                        & ~F.col("name").contains("_last_processed")
                        & ~F.coalesce(F.col("trashed"), F.lit(False)))
    if limit_clients is not None:
        out = out.orderBy("name", "id").limit(limit_clients)
    return out


def list_children(catalog: DataFrame, parent_ids: DataFrame) -> DataFrame:
    """Non-trashed children of the given folders (all pages at once)."""
    live = catalog.where(~F.coalesce(F.col("trashed"), F.lit(False)))
    return live.join(parent_ids.select("parent_id").distinct(), "parent_id", "left_semi")


def lookup_by_id(items: DataFrame, ids: DataFrame, fields: list[str]) -> DataFrame:
    """Selected fields per requested id; nulls when the id is unknown."""
    return ids.select("id").distinct().join(items.select("id", *fields), "id", "left")


def rescan_due(state: DataFrame, now_col, hours: int = 6) -> DataFrame:
    """``rescan_due`` = last full scan missing or older than ``hours``."""
    last = F.coalesce(F.col("last_full_scan_ts"), F.lit("1970-01-01 00:00:00").cast("timestamp"))
    return state.withColumn("rescan_due", last < (now_col - F.expr(f"INTERVAL {hours} HOURS")))


def report_changed(latest_mtime, stored_mtime, full_run: bool = False):
    """Latest report time differs from the stored one (and exists), or full run."""
    changed = latest_mtime.isNotNull() & ~latest_mtime.eqNullSafe(stored_mtime)
    return changed | F.lit(full_run)
