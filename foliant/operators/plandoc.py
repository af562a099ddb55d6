"""Plan document: one JSON document per client as ordered fragments.

A fragment is one line of the document; the lines of a client in the order of
``ORDER`` are one JSON object with the header, the source folders, all processing
tasks (``IGNORE`` too) and the batches of each format with their tasks. No row holds a
plan, a list of tasks or a batch. Records are read back from their own lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions import mb_rounded

ORDER = ["client", "section", "fmt", "batch_pos", "item_pos", "key"]
HEAD, FOLDERS, TASKS, BATCHES, END = 0, 1, 2, 3, 4
TASK = ("client_master_name string, source_file_id string, source_file_name string, source_file_path string, drive_link string, "
        "input_mime_type string, estimated_size_bytes bigint, task_type string, output_format string")
FOLDER = "id string, name string, path string"


def _json(value: Column) -> Column:
    """JSON text of a struct, nulls kept."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def task_struct() -> Column:
    names = [c.strip().split(" ")[0] for c in TASK.split(",")]
    columns = ["client", "file_id", "file_name", "file_path", "drive_link", "mime_type", "size", "task_type", "output_format"]
    return F.struct(*[F.col(c).alias(n) for c, n in zip(columns, names)])


def _rows(df: DataFrame, section: int, line: Column, record: Column, fmt=None, batch_pos=None, item_pos=None, key=None) -> DataFrame:
    none = lambda c, kind: F.lit(None).cast(kind) if c is None else c.cast(kind)
    return df.select("client", F.lit(section).alias("section"), F.coalesce(none(fmt, "string"), F.lit("")).alias("fmt"),
                     F.coalesce(none(batch_pos, "long"), F.lit(-1)).alias("batch_pos"), F.coalesce(none(item_pos, "long"), F.lit(-1)).alias("item_pos"),
                     F.coalesce(none(key, "string"), F.lit("")).alias("key"), line.alias("line"), record.alias("record"))


def _text(value: str) -> Column:
    return F.lit(value)


def plan_fragments(folders: DataFrame, tasks: DataFrame, items: DataFrame, generated_at: str) -> DataFrame:
    """``client, section, fmt, batch_pos, item_pos, key, line, record`` of every client with a
    folder, task or batch. ``line``: a line of the document; ``record``: the folder or task
    of that line as JSON by itself (null: a line of the frame).

    ``folders``: ``client, pos, folder_id, folder_name, folder_path``; ``tasks``: the client's
    tasks; ``items``: the packed batch members.
    """
    none = F.lit(None).cast("string")
    clients = folders.select("client").unionByName(tasks.select("client")).unionByName(items.select("client")).distinct()
    quoted = F.regexp_extract(_json(F.struct(F.col("client").alias("c"))), r'^\{"c":(.*)\}$', 1)
    head = F.concat(_text(f'{{"plan_generated_at": "{generated_at}", "client_master_name": '), quoted, _text(', "client_source_folders": ['))
    parts = [_rows(clients, HEAD, head, none),
             _rows(clients, TASKS, _text('], "processing_tasks": ['), none),
             _rows(clients, BATCHES, _text('], "concatenation_plan": {'), none),
             _rows(clients, END, _text("}}"), none)]

    def listed(df: DataFrame, first: Column, record: Column) -> Column:
        return F.concat(F.when(first, F.lit("")).otherwise(F.lit(",")), record)

    # folders in list order
    least = folders.groupBy("client").agg(F.min(F.struct("pos", "folder_id")).alias("_least"))
    rows = folders.join(least, "client")
    record = _json(F.struct(F.col("folder_id").alias("id"), F.col("folder_name").alias("name"), F.col("folder_path").alias("path")))
    parts.append(_rows(rows, FOLDERS, listed(rows, F.struct("pos", "folder_id") == F.col("_least"), record), record, item_pos=F.col("pos"), key=F.col("folder_id")))
    # tasks by path and id; the section's own line sorts first by its empty key
    place = F.concat(F.coalesce("file_path", F.lit("")), F.lit("\u0001"), "file_id")
    least = tasks.groupBy("client").agg(F.min(place).alias("_least"))
    rows = tasks.join(least, "client")
    record = _json(task_struct())
    parts.append(_rows(rows, TASKS, listed(rows, place == F.col("_least"), record), record, item_pos=F.lit(0), key=place))
    # batches: a line before the first of a format, one before each batch and one behind each
    batches = items.groupBy("client", "fmt", "batch_pos", "batch_id").agg(mb_rounded(F.sum("size")).alias("mb"), F.min("item_pos").alias("_first"), F.max("item_pos").alias("_last"))
    edges = batches.groupBy("client", "fmt").agg(F.min("batch_pos").alias("_lo"), F.max("batch_pos").alias("_hi"))
    outer = edges.groupBy("client").agg(F.min("fmt").alias("_fmt"))
    rows = batches.join(edges, ["client", "fmt"]).join(outer, "client")
    first_of_format = F.col("batch_pos") == F.col("_lo")
    opening = F.when(first_of_format, F.concat(F.when(F.col("fmt") == F.col("_fmt"), F.lit('"')).otherwise(F.lit(', "')), "fmt", F.lit('": ['))) \
        .otherwise(F.lit(","))
    shown = _json(F.struct("batch_id", F.col("mb").alias("total_size_mb")))
    before = F.concat(opening, F.expr("substring(_shown, 1, length(_shown) - 1)"), F.lit(', "source_tasks": ['))
    rows = rows.withColumn("_shown", shown)
    parts.append(_rows(rows, BATCHES, before, none, F.col("fmt"), F.col("batch_pos"), F.lit(-1)))
    after = F.concat(F.lit("]}"), F.when(F.col("batch_pos") == F.col("_hi"), F.lit("]")).otherwise(F.lit("")))
    parts.append(_rows(rows, BATCHES, after, none, F.col("fmt"), F.col("batch_pos"), F.col("_last") + 1))
    members = items.select("client", "fmt", "batch_pos", "item_pos", "file_id").join(tasks, ["client", "file_id"], "left") \
        .join(batches.select("client", "fmt", "batch_pos", "_first"), ["client", "fmt", "batch_pos"])
    parts.append(_rows(members, BATCHES, listed(members, F.col("item_pos") == F.col("_first"), record), record, F.col("fmt"), F.col("batch_pos"), F.col("item_pos"), F.col("file_id")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def read_tasks(fragments: DataFrame) -> DataFrame:
    """The processing tasks of the documents, a row each."""
    rows = fragments.where(F.col("record").isNotNull() & (F.col("section") == TASKS))
    return rows.select(F.from_json("record", TASK).alias("t")).select("t.*")


def read_folders(fragments: DataFrame) -> DataFrame:
    rows = fragments.where(F.col("record").isNotNull() & (F.col("section") == FOLDERS))
    return rows.select("client", F.col("item_pos").cast("int").alias("pos"), F.from_json("record", FOLDER).alias("f")).select("client", "pos", "f.*")


def read_batches(fragments: DataFrame) -> DataFrame:
    """The batch members of the documents with their task."""
    rows = fragments.where(F.col("record").isNotNull() & (F.col("section") == BATCHES))
    return rows.select("client", "fmt", "batch_pos", "item_pos", F.from_json("record", TASK).alias("t")).select("client", "fmt", "batch_pos", "item_pos", "t.*")
