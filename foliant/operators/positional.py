"""Positional helpers: a global 0-based index in a sort order without a
single-partition window.

Two passes, like ``zipWithIndex``: range-partition and sort, number rows
inside each partition (``monotonically_increasing_id`` above the sort holds the
partition in its upper bits and the place in it in the lower 33), count rows
per partition, and add each partition's offset. The offset table has one row
per partition, so broadcasting it is bounded by the partition count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.session import materialize


def with_global_index(df: DataFrame, order_cols: list[str], out: str = "idx",
                      partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 0-based position of each row in ``order_cols`` order
    (the order must be total, i.e. the columns a unique key)."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    # stored once: counts and rows must come from one evaluation of the sampled ranges
    numbered = materialize(ordered.withColumn("_id", F.monotonically_increasing_id()))
    numbered = numbered.select(*df.columns, F.shiftright("_id", 33).cast("int").alias("_part"),
                               F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_local"))
    counts = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return numbered.join(F.broadcast(offsets), "_part") \
        .withColumn(out, (F.col("_off") + F.col("_local")).cast("long")).drop("_part", "_local", "_off")

