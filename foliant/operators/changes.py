"""Change feed: keep the inventory current from ordered change records.

One micro-batch of changes is applied as a whole:

* ``needs_rescan``: a ``drive``-type change, or a non-removed change without
  file id or parent, makes the whole batch fall back to a full re-walk.
* Otherwise only the last change per file id matters (``latest_changes``):
  removed -> the row goes, else the row is replaced; the path of each
  upserted id is resolved upward through the *live* node table (names and
  parents after the batch), ``indent`` = slashes - 1. Descendants of a
  changed folder keep their paths until the next re-walk (patch semantics;
  with ``cascade=True`` the subtrees of changed folders follow, see ``cascade``).

Records are flat: ``seq, change_type, file_id, removed, parent_id, name,
mime_type, size`` (``flatten_changes`` converts the nested API shape).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions import path_depth
from foliant.operators.hierarchy import resolve_changed_paths, tree_paths
from foliant.operators.snapshots import changed_clients
from foliant.session import FOLDER_MIME, materialize, release
from foliant.sources.buckets import BucketStore

INVENTORY_COLS = ["id", "parent_id", "name", "mime_type", "size", "path", "indent"]
NODE_COLS = ["id", "parent_id", "name", "mime_type", "size"]


def flatten_changes(nested: DataFrame) -> DataFrame:
    """API shape (``file`` struct with ``parents``) -> flat records."""
    return nested.select("seq", "change_type", "file_id", F.coalesce("removed", F.lit(False)).alias("removed"),
                         F.try_element_at("file.parents", F.lit(1)).alias("parent_id"),
                         F.col("file.name").alias("name"), F.col("file.mime_type").alias("mime_type"),
                         F.col("file.size").alias("size"))


def rescan_predicate():
    """Per change: does it force the whole batch to a full re-walk?"""
    removed = F.coalesce(F.col("removed"), F.lit(False))
    return (F.coalesce("change_type", F.lit("")) == "drive") | (
        ~removed & (F.col("file_id").isNull() | F.col("parent_id").isNull()))


def needs_rescan(changes: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``bool_or`` of the rescan predicate over each micro-batch."""
    agg = [F.count(F.lit(1)).alias("n_changes"), F.bool_or(rescan_predicate()).alias("needs_rescan")]
    return changes.groupBy(*(by or [])).agg(*agg)


def latest_changes(changes: DataFrame) -> DataFrame:
    """Last change per file id (feed order = ``seq``); ``max_by`` aggregates on
    the map side, so a hot id never gathers its history in one task."""
    cols = [c for c in changes.columns if c != "file_id"]
    # only changes of the drive itself carry no file; a missing or other type is a file change
    last = changes.where(F.col("file_id").isNotNull() & (F.coalesce("change_type", F.lit("")) != "drive")) \
        .groupBy("file_id").agg(F.max_by(F.struct(*cols), F.col("seq")).alias("c"))
    return last.select("file_id", "c.*")


def apply_to_nodes(nodes: DataFrame, last: DataFrame) -> DataFrame:
    """Live node table: drop touched ids, add the non-removed last versions."""
    kept = nodes.join(last.select(F.col("file_id").alias("id")), "id", "left_anti")
    ups = last.where(~F.coalesce(F.col("removed"), F.lit(False))).select(
        F.col("file_id").alias("id"), "parent_id", "name", "mime_type", F.col("size").cast("long"))
    return kept.select(*NODE_COLS).unionByName(ups)


def patch_inventory(inventory: DataFrame, live_nodes: DataFrame, last: DataFrame,
                    root_id: str, root_label: str, lookup=None) -> DataFrame:
    """Patch path: remove touched rows, add upserted rows with resolved paths."""
    ups = last.where(~F.coalesce(F.col("removed"), F.lit(False)))
    paths = resolve_changed_paths(ups.select(F.col("file_id").alias("id")), live_nodes, root_id, root_label, lookup=lookup)
    new_rows = ups.select(F.col("file_id").alias("id"), "parent_id", "name", "mime_type",
                          F.col("size").cast("long").alias("size")) \
        .join(paths, "id").withColumn("indent", path_depth("path").cast("int"))
    kept = inventory.select(*INVENTORY_COLS).join(last.select(F.col("file_id").alias("id")), "id", "left_anti")
    return kept.unionByName(new_rows.select(*INVENTORY_COLS))


def apply_changes(inventory: DataFrame, nodes: DataFrame, changes: DataFrame, root_id: str,
                  root_label: str, cascade: bool = False) -> tuple[DataFrame, DataFrame, bool]:
    """Apply one micro-batch. Returns (new inventory, new live nodes, rescanned).

    The rescan decision is one aggregated boolean per batch (a single-row
    action); everything else stays distributed.
    """
    flag = needs_rescan(changes).collect()[0]["needs_rescan"]
    last = latest_changes(changes)
    live = apply_to_nodes(nodes, last)
    if flag:
        return tree_paths(live, root_id).select(*INVENTORY_COLS), live, True
    if cascade:
        from foliant.operators.cascade import cascade_changes
        ids = last.select(F.col("file_id").alias("id"))
        folders = nodes.where(F.col("mime_type") == FOLDER_MIME).join(ids, "id", "left_semi").select("id") \
            .unionByName(last.where(F.col("mime_type") == FOLDER_MIME).select(F.col("file_id").alias("id")))
        if not folders.isEmpty():
            return (*cascade_changes(inventory, nodes, changes, root_id), False)
    return patch_inventory(inventory, live, last, root_id, root_label), live, False


def node_store(spark, base: str, inventory: DataFrame, nodes: DataFrame, n_buckets: int = 64) -> BucketStore:
    """A bucketed store of ``inventory`` and ``nodes`` under ``base``, with its first generation."""
    schemas = {"inventory": inventory.select(*INVENTORY_COLS).schema, "nodes": nodes.select(*NODE_COLS).schema}
    store = BucketStore(spark, base, schemas, n_buckets)
    store.commit({"inventory": (inventory, None), "nodes": (nodes, None)})
    return store


def apply_changes_bucketed(store: BucketStore, changes: DataFrame, root_id: str, root_label: str) -> tuple[int, bool]:
    """Apply one micro-batch to a bucketed store. Returns (generation, rescanned).

    A patch reads and rewrites only the buckets of the changed ids, and reads the
    buckets of their ancestors, a level at a time; all other buckets stay as they are.
    A batch that needs a re-walk rewrites the whole inventory, and of the nodes still
    only the changed buckets.
    """
    flag = needs_rescan(changes).collect()[0]["needs_rescan"]
    last = materialize(latest_changes(changes))
    touched = store.buckets_of(last, "file_id")
    live = materialize(apply_to_nodes(store.read("nodes", touched), last))
    rest = [b for b in range(store.n_buckets) if b not in set(touched)]
    if flag:
        every = store.read("nodes", rest).unionByName(live)
        walked = tree_paths(every, root_id)
        gen = store.commit({"inventory": (walked, None), "nodes": (live, touched)})
        release(walked)
    else:
        def lookup(ids):
            wanted = store.buckets_of(ids)
            return store.read("nodes", sorted(set(wanted) - set(touched))).unionByName(live)

        patched = patch_inventory(store.read("inventory", touched), store.read("nodes", rest).unionByName(live), last,
                                  root_id, root_label, lookup)
        gen = store.commit({"inventory": (patched, touched), "nodes": (live, touched)})
    release(last, live)
    return gen, bool(flag)


def replan_from_changes(before_members: DataFrame, after_members: DataFrame,
                        client_folders: DataFrame) -> DataFrame:
    """Clients whose file set changed through the applied changes."""
    return changed_clients(after_members, before_members, client_folders)
