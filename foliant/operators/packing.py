"""Sticky, size-bounded batch packing of processing tasks.

Semantics (per client and output format):

* Retained batches: members of last run's batches that are still active keep
  their batch (in old order, with refreshed sizes); the batch format is the
  prefix of its id before the first ``_``.
* A retained batch whose refreshed total exceeds the limit is dissolved and
  its members are placed again.
* Tasks to place are taken by size descending (ties: file id). Each goes to
  the least-loaded batch of its format that stays within the limit (ties:
  earlier batch in list order); if none fits, a new batch is opened with id
  ``<fmt>_batch_<n>``, ``n`` = first free number at or above list length + 1.

A task fits the least-loaded batch iff it fits any batch, so the placement
is a pop of the heap minimum ``(load, batch_pos)``.

Scale notes
-----------
The placement is a sequential fold inside one (client, format) group: each
decision depends on all earlier ones, so the group cannot be split without
changing the result. It is therefore *streamed*: the rows are hash
partitioned by (client, format), sorted inside each partition by Spark's
external sorter, and ``mapInPandas`` walks them once keeping only the heap
of batch loads of the current group. Memory is bounded by the number of
batches of the largest group (every two batches together hold more than the
limit, so that is below 2 x bytes / limit + 1), never by its number of files;
other groups run in parallel on other partitions. The number of a new batch is
looked for from the last new one on, so a group's numbers are tried once each.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.functions import mb_rounded
from foliant.session import BATCH_LIMIT_BYTES, materialize

PLACED_SCHEMA = T.StructType([
    T.StructField("client", T.StringType()),
    T.StructField("fmt", T.StringType()),
    T.StructField("file_id", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("batch_pos", T.LongType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("item_pos", T.LongType()),
])

ITEM_COLS = ["client", "fmt", "batch_pos", "batch_id", "item_pos", "file_id", "size"]
_DTYPES = {f.name: ("int64" if isinstance(f.dataType, T.LongType) else object) for f in PLACED_SCHEMA.fields}


def _placer(limit: int):
    cols = ["kind", "client", "fmt", "batch_pos", "batch_id", "load", "next_item", "file_id", "size"]

    def run(batches):
        key = object()
        heap: list = []
        info: dict = {}
        used: set = set()
        n_batches = 0
        max_pos = -1
        counter = 0  # number of the group's last new batch
        for pdf in batches:
            out = {c: [] for c in PLACED_SCHEMA.fieldNames()}
            arrays = [pdf[c].tolist() for c in cols]
            for kind, client, fmt, bpos, bid, load, nxt, fid, size in zip(*arrays):
                k = (client, fmt)
                if k != key:
                    key, heap, info, used, n_batches, max_pos, counter = k, [], {}, set(), 0, -1, 0
                if kind == 0:
                    heapq.heappush(heap, (load, bpos))
                    info[bpos] = [bid, nxt]
                    used.add(bid)
                    n_batches += 1
                    max_pos = max(max_pos, bpos)
                    continue
                if heap and heap[0][0] + size <= limit:
                    cur, pos = heap[0]
                    heapq.heapreplace(heap, (cur + size, pos))
                    slot = info[pos]
                    target_id, item = slot[0], slot[1]
                    slot[1] += 1
                else:
                    # the numbers from the list length up to the last new one are taken, so none is tried twice
                    counter = max(n_batches, counter) + 1
                    target_id = f"{fmt}_batch_{counter}"
                    while target_id in used:
                        counter += 1
                        target_id = f"{fmt}_batch_{counter}"
                    used.add(target_id)
                    max_pos += 1
                    pos, item = max_pos, 0
                    info[pos] = [target_id, 1]
                    heapq.heappush(heap, (size, pos))
                    n_batches += 1
                out["client"].append(client)
                out["fmt"].append(fmt)
                out["file_id"].append(fid)
                out["size"].append(size)
                out["batch_pos"].append(pos)
                out["batch_id"].append(target_id)
                out["item_pos"].append(item)
            if out["file_id"]:
                yield pd.DataFrame({c: pd.Series(v, dtype=_DTYPES[c]) for c, v in out.items()})

    return run


def _place(seeds: DataFrame | None, to_place: DataFrame, limit: int) -> DataFrame:
    """Run the streaming placement over seeds (kept batches) and tasks."""
    spark = to_place.sparkSession
    tasks = to_place.select(
        F.lit(1).alias("kind"), "client", F.col("output_format").alias("fmt"),
        F.lit(0).cast("long").alias("batch_pos"), F.lit("").alias("batch_id"),
        F.lit(0).cast("long").alias("load"), F.lit(0).cast("long").alias("next_item"),
        "file_id", F.col("size").cast("long").alias("size"),
        (-F.col("size")).cast("long").alias("_o"))
    rows = tasks
    if seeds is not None:
        rows = seeds.select(
            F.lit(0).alias("kind"), "client", "fmt", F.col("batch_pos").cast("long"), "batch_id",
            F.col("load").cast("long"), F.col("next_item").cast("long"),
            F.lit("").alias("file_id"), F.lit(0).cast("long").alias("size"),
            F.col("batch_pos").cast("long").alias("_o")).unionByName(tasks)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(n, "client", "fmt") \
        .sortWithinPartitions("client", "fmt", "kind", "_o", "file_id").drop("_o")
    return ordered.mapInPandas(_placer(limit), PLACED_SCHEMA)


def active_of(tasks: DataFrame) -> DataFrame:
    return tasks.where(F.col("task_type") != "IGNORE").select(
        "client", "file_id", "size", "output_format")


def retain_batches(old_items: DataFrame, tasks: DataFrame) -> DataFrame:
    """Old batch members that are still active, with current sizes (old order)."""
    act = active_of(tasks)
    return old_items.select("client", "batch_pos", "batch_id", "item_pos", "file_id") \
        .join(act.select("client", "file_id", "size"), ["client", "file_id"]) \
        .withColumn("fmt", F.split_part(F.col("batch_id"), F.lit("_"), F.lit(1)))


def batch_loads(members: DataFrame) -> DataFrame:
    return members.groupBy("client", "fmt", "batch_pos", "batch_id").agg(
        F.sum("size").alias("load"), (F.max("item_pos") + 1).alias("next_item"))


def oversize_batches(old_items: DataFrame, tasks: DataFrame,
                     limit: int = BATCH_LIMIT_BYTES) -> DataFrame:
    """Retained batches whose refreshed total exceeds the limit (dissolved)."""
    return batch_loads(retain_batches(old_items, tasks)).where(F.col("load") > limit) \
        .select("client", "fmt", "batch_id", "load")


def plan_new_ids(old_tasks: DataFrame, tasks: DataFrame) -> DataFrame:
    """Active ids of the current tasks not among the previous plan's tasks."""
    return active_of(tasks).select("client", "file_id") \
        .join(old_tasks.select("client", "file_id"), ["client", "file_id"], "left_anti")


def plan_deleted_ids(old_tasks: DataFrame, tasks: DataFrame) -> DataFrame:
    """Previous plan's task ids that are not active now."""
    return old_tasks.select("client", "file_id") \
        .join(active_of(tasks).select("client", "file_id"), ["client", "file_id"], "left_anti")


def pack_batches(tasks: DataFrame, limit: int = BATCH_LIMIT_BYTES) -> DataFrame:
    """Plan without history: flat batch items ``client, fmt, batch_pos, batch_id,
    item_pos, file_id, size``."""
    return _place(None, active_of(tasks), limit).select(*ITEM_COLS)


def repack_batches(tasks: DataFrame, old_items: DataFrame, old_tasks: DataFrame | None = None,
                   limit: int = BATCH_LIMIT_BYTES, place_reactivated: bool = True) -> DataFrame:
    """Plan with history (sticky). ``old_items`` are last run's batch items.

    ``place_reactivated=True`` places every active task that is in no kept
    batch (a file that was ignored before and is active now gets placed);
    ``False`` keeps the strict rule "new = not among last run's tasks", under
    which such a file is never placed (needs ``old_tasks``).
    """
    act = active_of(tasks)
    members = materialize(retain_batches(old_items, tasks))  # read by the loads, the kept items and the rest
    loads = batch_loads(members)
    kept = loads.where(F.col("load") <= limit)
    kept_members = members.join(kept.select("client", "batch_id"), ["client", "batch_id"], "left_semi")
    to_place = act.join(kept_members.select("client", "file_id"), ["client", "file_id"], "left_anti")
    if not place_reactivated:
        if old_tasks is None:
            raise ValueError("old_tasks is needed when place_reactivated=False")
        dissolved = members.join(kept.select("client", "batch_id"), ["client", "batch_id"], "left_anti")
        new_ids = plan_new_ids(old_tasks, tasks)
        allowed = new_ids.unionByName(dissolved.select("client", "file_id"))
        to_place = to_place.join(allowed, ["client", "file_id"], "left_semi")
    placed = _place(kept, to_place, limit)
    return kept_members.select(*ITEM_COLS).unionByName(placed.select(*ITEM_COLS))


def batch_totals(items: DataFrame) -> DataFrame:
    """Per batch: bytes, files and MB rounded half-even to two decimals."""
    return items.groupBy("client", "fmt", "batch_pos", "batch_id").agg(
        F.sum("size").alias("total_bytes"), F.count(F.lit(1)).alias("n_files")) \
        .withColumn("total_size_mb", mb_rounded("total_bytes"))
