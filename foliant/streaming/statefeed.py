"""Stateful change feed: the live version of every file, held beside the stream's offsets.

A stream of change records (``changefeed.CHANGE_FLAT``) is read in micro-batches; the
state is a table with the last version of every file (or a mark that it is gone). Each
record gives out one row: what it did (``kind``) and the version before and after, by a
window over the records of its file and the version that was held. The state after an
epoch is written under the streaming checkpoint, as a generation of its own; an epoch that
is run again reads the generation before it and replaces what it wrote, so a restart in the
middle goes on with the same rows. A record whose ``seq`` is not above the stored one has
been applied already and gives no row.

``kind``: ``insert`` (no live version before), ``update``, ``delete``, or ``none`` (a removal
of a file that is not there). Records of the drive itself, or without a file id, give
no row. All steps are joins, windows and aggregations of Spark: the work of an epoch is one
pass over the state and the records, and no file's records are gathered in memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.session import ensure_checkpoint_dir, materialize, release
from foliant.sources import store as ST
from foliant.streaming.changefeed import CHANGE_FLAT

_VERSION = ["parent_id", "name", "mime_type", "size"]
STATE = "file_id string, seq bigint, removed boolean, parent_id string, name string, mime_type string, size bigint"
#: Sequence of the rows of a snapshot that is fed before the first change.
SNAPSHOT_SEQ = -1


def change_records(batch: DataFrame) -> DataFrame:
    """The records of files, in the columns of the state; a removal has no version."""
    gone = F.coalesce("removed", F.lit(False))
    version = [F.when(~gone, F.col(c)).alias(c) for c in _VERSION]
    return batch.where(F.col("file_id").isNotNull() & (F.coalesce("change_type", F.lit("")) != "drive") & F.col("seq").isNotNull()) \
        .select("file_id", "seq", gone.alias("removed"), *version)


def unseen(records: DataFrame, state: DataFrame) -> DataFrame:
    """The records above the stored sequence of their file, one for each sequence."""
    last = state.select("file_id", F.col("seq").alias("_last"))
    return records.join(last, "file_id", "left").where("_last is null or seq > _last").drop("_last").dropDuplicates(["file_id", "seq"])


def changed_rows(records: DataFrame, state: DataFrame) -> DataFrame:
    """The changed rows of ``unseen`` records: ``file_id, seq, kind``, and
    ``parent_id, name, mime_type, size`` after and (``old_...``) before."""
    held = state.join(records.select("file_id").distinct(), "file_id", "left_semi")
    rows = held.withColumn("_held", F.lit(True)).unionByName(records.withColumn("_held", F.lit(False)))
    w = Window.partitionBy("file_id").orderBy("seq")
    was = F.coalesce(~F.lag("removed").over(w), F.lit(False))
    kind = F.when(F.col("removed"), F.when(was, "delete").otherwise("none")).otherwise(F.when(was, "update").otherwise("insert"))
    return rows.select("_held", "file_id", "seq", kind.alias("kind"), *_VERSION, *[F.lag(c).over(w).alias(f"old_{c}") for c in _VERSION]) \
        .where(~F.col("_held")).drop("_held")


def next_state(records: DataFrame, state: DataFrame) -> DataFrame:
    """The last version of every file after ``unseen`` records."""
    last = state.unionByName(records).groupBy("file_id").agg(F.max_by(F.struct("seq", "removed", *_VERSION), "seq").alias("v"))
    return last.select("file_id", "v.*")


def make_state_writer(out: str, checkpoint: str):
    """foreachBatch function: rows of an epoch into ``out/epoch=N``, then its state beside the offsets."""
    base = f"{checkpoint.rstrip('/')}/versions"

    def apply_batch(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        done = [g for g in ST.list_generations(spark, base) if g < epoch and ST._exists(spark, f"{base}/gen={g}/_SUCCESS")]
        state = spark.read.schema(STATE).parquet(f"{base}/gen={done[-1]}") if done else spark.createDataFrame([], STATE)
        records = materialize(unseen(change_records(batch), state))
        changed_rows(records, state).write.mode("overwrite").parquet(f"{out}/epoch={epoch}")
        next_state(records, state).write.mode("overwrite").parquet(f"{base}/gen={epoch}")
        for old in done[:-1]:
            ST._delete(spark, f"{base}/gen={old}")
        release(records)

    return apply_batch


def snapshot_records(nodes: DataFrame) -> DataFrame:
    """The live nodes as records that go before every change."""
    cols = [f.name for f in CHANGE_FLAT.fields]
    rows = nodes.select(F.lit(SNAPSHOT_SEQ).cast("long").alias("seq"), F.lit("file").alias("change_type"), F.col("id").alias("file_id"),
                        F.lit(False).alias("removed"), "parent_id", "name", "mime_type", F.col("size").cast("long").alias("size"),
                        F.lit("1970-01-01").cast("date").alias("batch_day"))
    return rows.select(*cols)


def run_state_stream(spark: SparkSession, landing: str, out: str, checkpoint: str, files_per_trigger: int = 10,
                     available_now: bool = True, poll_interval: str = "10 minutes"):
    """Start the stream from ``landing`` into the table ``out``, a partition ``epoch`` for each
    micro-batch; with ``available_now`` it consumes what has landed and stops."""
    ensure_checkpoint_dir(spark)
    stream = spark.readStream.schema(CHANGE_FLAT).option("maxFilesPerTrigger", files_per_trigger).json(landing)
    writer = stream.writeStream.foreachBatch(make_state_writer(out, checkpoint)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=poll_interval)
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query


def live_nodes(changed: DataFrame) -> DataFrame:
    """``id, parent_id, name, mime_type, size`` of the live files after the changed rows of a
    feed that began with a snapshot."""
    last = changed.groupBy("file_id").agg(F.max_by(F.struct("kind", *_VERSION), "seq").alias("v"))
    return last.where(F.col("v.kind").isin("insert", "update")).select(F.col("file_id").alias("id"), *[F.col(f"v.{c}").alias(c) for c in _VERSION])
