"""Subtree cascade: moved, renamed or removed folders change only their subtrees.

``folder_intervals`` numbers the folders in pre-order: the ids of a folder's
ancestors make its place in the order, so a subtree is one range of numbers
``lo..hi``. ``cascade_changes`` selects by these ranges what stands below a changed
folder, keeps all the rest of the inventory as it is, and walks only the selected
part anew, from where it hangs on a kept folder. The result equals a whole re-walk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.operators.changes import INVENTORY_COLS, apply_to_nodes, latest_changes
from foliant.operators.hierarchy import TreeDepthError
from foliant.operators.positional import with_global_index
from foliant.session import FOLDER_MIME, materialize, release, stage_folder

#: Numbers of one block of the range join; a range of ``s`` numbers takes about ``s / BLOCK`` rows.
BLOCK = 1024
#: Sorts below every character that an id can hold, so that a folder stands before its subtree.
_SEPARATOR = "\u0001"


def folder_intervals(inventory: DataFrame, root_id: str) -> DataFrame:
    """``id, parent_id, lo, hi`` of every folder of an inventory, the root included.

    The id paths are made level by level (folders only); the place in their order is
    the pre-order number, and counting each folder for all its ancestors gives the sizes.
    """
    spark = inventory.sparkSession
    is_root = F.col("id") == F.lit(root_id)
    folders = materialize(inventory.where((F.col("mime_type") == FOLDER_MIME) | is_root)
                          .select("id", F.when(~is_root, F.col("parent_id")).alias("parent_id"), "indent"))
    levels = stage_folder(spark, "intervals")
    schema = "id string, parent_id string, trail string"
    depth, seen, total = 0, 0, folders.count()
    step = folders.where(is_root).select("id", "parent_id", F.col("id").alias("trail"))
    while True:
        step.write.mode("overwrite").parquet(f"{levels.path}/level={depth}")
        level = spark.read.schema(schema).parquet(f"{levels.path}/level={depth}")
        here = level.count()
        seen += here
        if not here:
            break
        if seen > total:
            raise TreeDepthError("the folders form a cycle")
        above = level.select(F.col("id").alias("parent_id"), F.col("trail").alias("_above"))
        step = folders.where(~is_root).join(above, "parent_id") \
            .select("id", "parent_id", F.concat("_above", F.lit(_SEPARATOR), "id").alias("trail"))
        depth += 1
    trails = spark.read.schema(schema + ", level int").parquet(levels.path).select("id", "parent_id", "trail")
    sizes = trails.select(F.explode(F.split("trail", _SEPARATOR)).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("_size"))
    placed = with_global_index(trails, ["trail"], "lo").select("id", "parent_id", F.col("lo").cast("long").alias("lo"))
    out = materialize(placed.join(sizes, "id").select("id", "parent_id", "lo", (F.col("lo") + F.col("_size") - 1).alias("hi")))
    release(folders, levels)
    return out


def within(folders: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rows of ``folders`` (``lo``) whose number lies in one of ``ranges`` (``lo, hi``): an
    equi-join on blocks of numbers with the exact test beside it."""
    blocks = ranges.select(F.col("lo").alias("_lo"), F.col("hi").alias("_hi")) \
        .withColumn("_block", F.explode(F.sequence(F.floor(F.col("_lo") / BLOCK), F.floor(F.col("_hi") / BLOCK))))
    rows = folders.withColumn("_block", F.floor(F.col("lo") / BLOCK))
    test = (rows["_block"] == blocks["_block"]) & (rows["lo"] >= blocks["_lo"]) & (rows["lo"] <= blocks["_hi"])
    return rows.join(blocks, test, "left_semi").drop("_block")


def cascade_changes(inventory: DataFrame, nodes: DataFrame, changes: DataFrame, root_id: str,
                    intervals: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Apply changes so that whole subtrees follow. Returns (new inventory, new live nodes).

    ``intervals``: ``folder_intervals`` of the inventory before, computed where not given.
    """
    spark = inventory.sparkSession
    inventory = inventory.select(*INVENTORY_COLS)
    own = intervals is None
    if own:
        intervals = folder_intervals(inventory, root_id)
    last = materialize(latest_changes(changes).where(F.col("file_id") != F.lit(root_id)))
    live = materialize(apply_to_nodes(nodes, last))
    ids = last.select(F.col("file_id").alias("id"))
    moved = intervals.join(ids, "id", "left_semi")
    below = materialize(within(intervals, moved.select("lo", "hi")).select(F.col("id").alias("parent_id")))
    kept = inventory.join(ids, "id", "left_anti").join(below, "parent_id", "left_anti").select(*INVENTORY_COLS)
    kept_folders = kept.where((F.col("mime_type") == FOLDER_MIME) | (F.col("id") == F.lit(root_id)))
    # what can hang below: all live nodes that the kept rows don't hold
    pool = materialize(live.join(kept.select("id"), "id", "left_anti"))
    above = kept_folders.select(F.col("id").alias("parent_id"), F.col("path").alias("_pp"), F.col("indent").alias("_pi"))
    walked = stage_folder(spark, "cascade")
    schema = inventory.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ").replace(",", ", ")
    depth, seen, total = 0, 0, None
    while True:
        step = pool.join(above, "parent_id").withColumn("path", F.concat("_pp", F.lit("/"), "name")).withColumn("indent", (F.col("_pi") + 1).cast("int"))
        step.select(*INVENTORY_COLS).write.mode("overwrite").parquet(f"{walked.path}/level={depth}")
        level = spark.read.schema(schema).parquet(f"{walked.path}/level={depth}")
        here = level.count()
        seen += here
        if not here:
            break
        if total is None:
            total = pool.count()
        if seen > total:
            raise TreeDepthError("the nodes form a cycle")
        above = level.where(F.col("mime_type") == FOLDER_MIME) \
            .select(F.col("id").alias("parent_id"), F.col("path").alias("_pp"), F.col("indent").alias("_pi"))
        depth += 1
    new_rows = spark.read.schema(schema + ", level int").parquet(walked.path).select(*INVENTORY_COLS)
    out = materialize(kept.unionByName(new_rows))
    release(last, pool, below, walked, *([intervals] if own else []))
    return out, live
