"""Structured Streaming runner for the change feed.

Landed change files (one folder per poll, JSON lines) are read with
``readStream``; the streaming checkpoint plays the role of the page token
(it records which files were consumed and is committed only after the
batch's sink step succeeded: at-least-once). ``foreachBatch`` applies each
poll's changes in feed order to the stored inventory and writes the result
as the next generation together with a one-row state (last applied epoch,
sequence and rescan day). A replayed epoch that is already applied is
skipped, so the sink is idempotent.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.operators.changes import (INVENTORY_COLS, NODE_COLS, apply_to_nodes, latest_changes,
                                       needs_rescan, patch_inventory)
from foliant.operators.hierarchy import tree_paths
from foliant.session import ensure_checkpoint_dir, materialize, release
from foliant.sources import store as ST
from foliant.sources.files import read_pages

CHANGE_FLAT = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("change_type", T.StringType()),
    T.StructField("file_id", T.StringType()),
    T.StructField("removed", T.BooleanType()),
    T.StructField("parent_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("mime_type", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("batch_day", T.DateType()),
])

STATE = T.StructType([
    T.StructField("last_epoch", T.LongType()),
    T.StructField("last_seq", T.LongType()),
    T.StructField("n_polls", T.LongType()),
    T.StructField("last_rescan_day", T.DateType()),
    T.StructField("last_poll_day", T.DateType()),
    # of the listener: the page token recorded before the last full scan, its time, the last report's time
    T.StructField("start_token", T.LongType()),
    T.StructField("last_full_scan_ts", T.TimestampType()),
    T.StructField("last_report_mtime", T.TimestampType()),
])


def land_changes(changes: DataFrame, landing: str, poll_col: str = "batch_day", mode: str = "overwrite") -> int:
    """Write one folder of JSON lines per poll and stamp the files in poll order
    (the file source picks up new files by modification time). ``mode='append'`` lands later polls."""
    spark = changes.sparkSession
    cols = [f.name for f in CHANGE_FLAT.fields if f.name != poll_col]
    changes.select(*cols, poll_col).repartition(poll_col).write.mode(mode) \
        .partitionBy(poll_col).json(landing)
    fs, base = ST._fs(spark, landing)
    dirs = [st.getPath() for st in fs.listStatus(base) if st.isDirectory()]
    stamp = int(time.time() * 1000) - 10_000_000
    for i, d in enumerate(sorted(dirs, key=lambda p: p.getName())):
        for st in fs.listStatus(d):
            fs.setTimes(st.getPath(), stamp + i * 1000, -1)
    return len(dirs)


class InventoryStore:
    """Generations of (inventory, nodes, state) under one base folder."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def _gen_path(self, gen: int, part: str) -> str:
        return f"{self.base}/{part}/gen={gen}"

    def current_gen(self) -> int | None:
        gens = ST.list_generations(self.spark, f"{self.base}/state")
        return gens[-1] if gens else None

    def read(self, part: str, schema: T.StructType | None = None) -> DataFrame:
        gen = self.current_gen()
        return self.spark.read.parquet(self._gen_path(gen, part))

    def state(self) -> dict | None:
        if self.current_gen() is None:
            return None
        rows = self.read("state").collect()
        return rows[0].asDict() if rows else None

    def put(self, part: str, table: DataFrame) -> DataFrame:
        """Write one part of the next generation, and read it; ``commit`` makes the generation count."""
        path = self._gen_path((self.current_gen() or 0) + 1, part)
        table.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(table.schema).parquet(path)

    def write(self, inventory: DataFrame, nodes: DataFrame, state: dict) -> int:
        self.put("inventory", inventory)
        self.put("nodes", nodes)
        return self.commit(state)

    def commit(self, state: dict) -> int:
        gen = (self.current_gen() or 0) + 1
        state = {f.name: state.get(f.name) for f in STATE.fields}
        # The state file is written last: a generation counts once its state exists.
        self.spark.createDataFrame([state], STATE).coalesce(1).write.mode("overwrite") \
            .parquet(self._gen_path(gen, "state"))
        for part in ("inventory", "nodes", "state"):
            for old in ST.list_generations(self.spark, f"{self.base}/{part}")[:-2]:
                ST._delete(self.spark, self._gen_path(old, part))
        return gen


def init_store(store: InventoryStore, inventory: DataFrame, nodes: DataFrame, start_token: int | None = None,
               scan_time=None) -> None:
    """The first generation. ``start_token``: the page token recorded before the nodes were scanned."""
    store.write(inventory.select(*INVENTORY_COLS), nodes.select(*NODE_COLS),
                {"last_epoch": -1, "n_polls": 0, "start_token": start_token, "last_full_scan_ts": scan_time})


def _span_is_mergeable(nodes: DataFrame, changes: DataFrame) -> bool:
    """True when no changed id is referenced as a parent, before or after the
    changes (a semi-join of changed ids against all parent references)."""
    changed = changes.where(F.col("file_id").isNotNull()).select(F.col("file_id").alias("pid")).distinct()
    parents = nodes.select(F.col("parent_id").alias("pid")) \
        .unionByName(changes.select(F.col("parent_id").alias("pid"))).where(F.col("pid").isNotNull())
    return changed.join(parents, "pid", "left_semi").isEmpty()


def make_batch_writer(store: InventoryStore, root_id: str, root_label: str, poll_col: str = "batch_day"):
    """foreachBatch function: apply the polls of one micro-batch in order.

    Exact shortcuts: the node table after several polls is the node table with
    the last change per id applied (last-change-wins composes), and a poll
    that needs a re-walk rebuilds the inventory from nodes alone. So only the
    last re-walk poll of the micro-batch is walked. The polls after it are
    patched together when none of their changed ids is a parent of anything
    (then no ancestor path moves between them), else one by one in order.
    """
    def apply_batch(batch: DataFrame, epoch: int) -> None:
        state = store.state() or {}
        # Rows up to the stored sequence are applied already: a replayed batch, or the
        # feed read again by a new checkpoint (whose epochs start at 0).
        if state.get("last_seq") is not None:
            batch = batch.where(F.col("seq").isNull() | (F.col("seq") > F.lit(state["last_seq"])))
        batch = batch.persist()
        if batch.isEmpty():
            batch.unpersist()
            return
        inv = store.read("inventory")
        nodes = store.read("nodes")
        stages = []

        def stage(df):
            stages.append(materialize(df))
            return stages[-1]

        per_poll = needs_rescan(batch, [poll_col]).orderBy(poll_col).collect()
        polls = [r[poll_col] for r in per_poll]
        rescans = [r[poll_col] for r in per_poll if r["needs_rescan"]]
        last_seq, n_polls = state.get("last_seq"), state.get("n_polls", 0)
        rescan_day = state.get("last_rescan_day")
        todo = polls
        # the last tables of the epoch are written once, where the new generation keeps them
        keep = lambda part, df, last: store.put(part, df) if last else stage(df)
        if rescans:
            rescan_day = rescans[-1]
            upto = batch.where(F.col(poll_col) <= F.lit(rescan_day))
            todo = [d for d in polls if d > rescan_day]
            nodes = keep("nodes", apply_to_nodes(nodes, latest_changes(upto)), not todo)
            inv = tree_paths(nodes, root_id, store=lambda df: keep("inventory", df.select(*INVENTORY_COLS), not todo))
        if todo and _span_is_mergeable(nodes, batch.where(F.col(poll_col).isin(todo))):
            # No id changed in these polls is anyone's parent, so no ancestor
            # changes between them: one patch against the final live nodes
            # equals patching poll by poll.
            last = latest_changes(batch.where(F.col(poll_col).isin(todo)))
            nodes = keep("nodes", apply_to_nodes(nodes, last), True)
            inv = keep("inventory", patch_inventory(inv, nodes, last, root_id, root_label), True)
            todo = []
        for day in todo:
            day_changes = batch.where(F.col(poll_col) == F.lit(day))
            last = latest_changes(day_changes)
            nodes = keep("nodes", apply_to_nodes(nodes, last), day == todo[-1])
            inv = keep("inventory", patch_inventory(inv, nodes, last, root_id, root_label), day == todo[-1])
        n_polls += len(polls)
        m = batch.agg(F.max("seq")).collect()[0][0]
        last_seq = m if last_seq is None or (m is not None and m > last_seq) else last_seq
        store.commit({**state, "last_epoch": epoch, "last_seq": last_seq, "n_polls": n_polls,
                      "last_rescan_day": rescan_day, "last_poll_day": polls[-1] if polls else None})
        release(*stages)
        batch.unpersist()

    return apply_batch


def run_change_stream(spark: SparkSession, landing: str, store: InventoryStore, checkpoint: str,
                      root_id: str, root_label: str, files_per_trigger: int = 1,
                      available_now: bool = True, poll_interval: str = "10 minutes"):
    """Start the stream; with ``available_now`` it consumes what has landed and stops."""
    ensure_checkpoint_dir(spark)
    stream = (spark.readStream.schema(CHANGE_FLAT).option("maxFilesPerTrigger", files_per_trigger)
              .json(landing))
    writer = stream.writeStream.foreachBatch(make_batch_writer(store, root_id, root_label)) \
        .option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=poll_interval)
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q


def run_page_stream(spark: SparkSession, pages: str, store: InventoryStore, checkpoint: str, root_id: str, root_label: str,
                    available_now: bool = True, poll_interval: str = "10 minutes"):
    """The same stream over change pages (``sources.files``), from the token that the store
    recorded before its scan; the page token is the poll."""
    ensure_checkpoint_dir(spark)
    token = (store.state() or {}).get("start_token") or 0
    stream = read_pages(spark, pages, token).withColumn("batch_day", F.date_add(F.lit("1970-01-01").cast("date"), F.col("token").cast("int"))).drop("token")
    writer = stream.writeStream.foreachBatch(make_batch_writer(store, root_id, root_label)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=poll_interval)
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query


def stream_to_table(spark: SparkSession, landing: str, out: str, checkpoint: str) -> None:
    """Plain ingestion of the landed feed into a table (the token-driven poll)."""
    q = (spark.readStream.schema(CHANGE_FLAT).json(landing).writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
