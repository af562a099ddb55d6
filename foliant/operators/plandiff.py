"""Plan documents: nesting/flattening, diff against a baseline, output names."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions import mb_rounded, output_file_name


def assemble_batches(items: DataFrame, tasks: DataFrame | None = None) -> DataFrame:
    """One nested row per batch: ``batch_id, total_size_mb`` and its ordered
    ``source_tasks`` (task structs when ``tasks`` is given, else file ids).

    A batch is bounded by the size limit, so this is the unit that is nested;
    a client's plan stays a set of batch rows (never one row per client).
    """
    src = items
    if tasks is not None:
        src = items.join(tasks.drop("size"), ["client", "file_id"], "left")
        task_cols = [c for c in tasks.columns if c not in ("client",)]
        elem = F.struct(F.col("item_pos"), F.struct(*[F.col(c) for c in task_cols]).alias("task"))
    else:
        elem = F.struct(F.col("item_pos"), F.col("file_id").alias("task"))
    return src.groupBy("client", "fmt", "batch_pos", "batch_id").agg(
        mb_rounded(F.sum("size")).alias("total_size_mb"),
        F.count(F.lit(1)).alias("n_tasks"),
        F.transform(F.array_sort(F.collect_list(elem)), lambda e: e["task"]).alias("source_tasks"))


def flatten_plan(batches: DataFrame) -> DataFrame:
    """Nested batch rows back to one row per (batch, task) with positions."""
    return batches.select("client", "fmt", "batch_pos", "batch_id",
                          F.posexplode("source_tasks").alias("item_pos", "task"))


def file_to_batch(items: DataFrame) -> DataFrame:
    return items.select("client", "file_id", "batch_id")


def plan_diff(base_items: DataFrame | None, base_tasks: DataFrame | None,
              new_items: DataFrame, new_tasks: DataFrame) -> DataFrame:
    """MOVED / ADDED / REMOVED per file between a baseline and a new plan.

    Display name: from the new plan's tasks, else the baseline's, else
    ``Unknown File``. A missing baseline counts as empty (all ADDED).
    """
    new = file_to_batch(new_items).withColumnRenamed("batch_id", "new_batch")
    if base_items is None:
        old = new.select("client", "file_id", F.lit(None).cast("string").alias("old_batch")).limit(0)
    else:
        old = file_to_batch(base_items).withColumnRenamed("batch_id", "old_batch")
    both = old.join(new, ["client", "file_id"], "full_outer") \
        .where(~F.col("old_batch").eqNullSafe(F.col("new_batch")))
    names_new = new_tasks.select("client", "file_id", F.col("file_name").alias("_nn"))
    both = both.join(names_new, ["client", "file_id"], "left")
    if base_tasks is not None:
        names_old = base_tasks.select("client", "file_id", F.col("file_name").alias("_on"))
        both = both.join(names_old, ["client", "file_id"], "left")
        name = F.when(F.col("_nn").isNotNull(), F.col("_nn")).otherwise(F.col("_on"))
        found = F.col("_nn").isNotNull() | F.col("_on").isNotNull()
    else:
        name = F.col("_nn")
        found = F.col("_nn").isNotNull()
    op = (F.when(F.col("old_batch").isNotNull() & F.col("new_batch").isNotNull(), "MOVED")
          .when(F.col("new_batch").isNotNull(), "ADDED").otherwise("REMOVED"))
    return both.select("client", "file_id",
                       F.when(found, F.coalesce(name, F.lit("Unknown File")))
                       .otherwise(F.lit("Unknown File")).alias("file_name"),
                       op.alias("op"), "old_batch", "new_batch")


def diff_line(diff: DataFrame) -> DataFrame:
    """Human-readable line per diff row."""
    q = F.concat(F.lit("'"), F.col("file_name"), F.lit("' (ID: "), F.col("file_id"), F.lit(")"))
    line = (F.when(F.col("op") == "MOVED", F.concat(F.lit("MOVED: "), q, F.lit(" moved from "),
                                                     F.col("old_batch"), F.lit(" to "), F.col("new_batch"),
                                                     F.lit(".")))
            .when(F.col("op") == "ADDED", F.concat(F.lit("ADDED: "), q, F.lit(" was added to "),
                                                    F.col("new_batch"), F.lit(".")))
            .otherwise(F.concat(F.lit("REMOVED: "), q, F.lit(" was removed from "),
                                F.col("old_batch"), F.lit("."))))
    return diff.withColumn("line", line)


def plan_diff_lines(diff: DataFrame, generated_at: str) -> DataFrame:
    """Diff report as ordered lines per client (header, blank, one line per
    change ordered by file id); clients without changes get no report.

    Writing these range-partitioned by ``(client, ord, file_id)`` yields each
    report without gathering a client's lines in one row.
    """
    lines = diff_line(diff).select("client", F.lit(1).alias("ord"), "file_id", "line")
    heads = diff.select("client").distinct().select(
        "client", F.lit(0).alias("ord"), F.lit("").alias("file_id"),
        F.concat(F.lit("Cumulative plan changes for client: "), F.col("client"), F.lit(" at "),
                 F.lit(generated_at), F.lit("\n")).alias("line"))
    return heads.unionByName(lines)


def render_diff_text(lines: DataFrame) -> DataFrame:
    """Whole report per client (tests and small clients)."""
    return lines.groupBy("client").agg(F.expr(
        "listagg(line, '\\n') within group (order by ord, file_id)").alias("diff_text"))


def output_names(items: DataFrame) -> DataFrame:
    """Output file per batch: 1-based ordinal of the batch in its format list."""
    batches = items.select("client", "fmt", "batch_pos", "batch_id").distinct()
    w = Window.partitionBy("client", "fmt").orderBy("batch_pos")
    return batches.withColumn("ordinal", F.row_number().over(w).cast("long")) \
        .withColumn("output_name", output_file_name(F.col("client"), F.col("ordinal"), F.col("fmt")))
