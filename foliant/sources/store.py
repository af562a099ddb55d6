"""Table storage: inventory files, generations, per-client partitions.

All paths live under a base folder on the shared file system (on a cluster
the folder named by the job; in tests a scratch folder). File-system
listing and deletion go through Hadoop's ``FileSystem`` of the session, so
the same code works on local disk, HDFS or an object store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.functions import size_bytes
from foliant.schemas import INVENTORY_JSON


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def list_generations(spark: SparkSession, base: str) -> list[int]:
    """Generation numbers present under ``base`` (folders ``gen=<n>``)."""
    if not _exists(spark, base):
        return []
    fs, p = _fs(spark, base)
    gens = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("gen="):
            try:
                gens.append(int(name[4:]))
            except ValueError:
                pass
    return sorted(gens)


# --- S1 / S2: inventory as JSON lines ---------------------------------------

def inventory_to_json_rows(inv: DataFrame) -> DataFrame:
    """Typed inventory -> the JSON-lines shape (size as decimal string)."""
    parents = F.when(F.col("parent_id").isNull(), F.lit(None).cast(T.ArrayType(T.StringType()))) \
        .otherwise(F.array("parent_id"))
    size = F.col("size") if "size" in inv.columns else F.lit(None)
    return inv.select("id", "name", F.col("mime_type").alias("mimeType"),
                      size.cast("string").alias("size"), parents.alias("parents"),
                      "path", "indent")


def write_inventory_sorted(inv_json_rows: DataFrame, path: str, fmt: str = "json",
                           partitions: int | None = None) -> None:
    """Write ordered by path: range partitions on path, sorted inside each.

    Concatenating the part files in name order gives the inventory sorted by
    ``(path, id)`` without a single-task global sort.
    """
    n = partitions or int(inv_json_rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = inv_json_rows.repartitionByRange(n, "path", "id").sortWithinPartitions("path", "id")
    out.write.mode("overwrite").format(fmt).save(path)


def scan_inventory(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """Read JSON-lines inventory with an explicit schema (blank lines are skipped)."""
    raw = spark.read.schema(INVENTORY_JSON).option("mode", mode).json(path)
    return raw.select("id", "name", F.col("mimeType").alias("mime_type"),
                      size_bytes("size").alias("size_or_zero"), F.col("size").try_cast("bigint").alias("size"),
                      "parents", F.try_element_at("parents", F.lit(1)).alias("parent_id"), "path", "indent")


# --- S11 / S16: two-generation rotation --------------------------------------

def rotate_snapshot(df: DataFrame, base: str, keep: int = 2) -> int | None:
    """Write ``df`` as the next generation; keep the newest ``keep``.

    Empty content is a no-op (returns None). Returns the generation written.
    """
    spark = df.sparkSession
    gens = list_generations(spark, base)
    new_gen = (gens[-1] + 1) if gens else 1
    path = f"{base.rstrip('/')}/gen={new_gen}"
    df.write.mode("overwrite").parquet(path)
    if spark.read.schema(df.schema).parquet(path).isEmpty():
        _delete(spark, path)
        return None
    for g in (gens + [new_gen])[:-keep]:
        _delete(spark, f"{base.rstrip('/')}/gen={g}")
    return new_gen


def read_generation(spark: SparkSession, base: str, schema: T.StructType,
                    which: str = "current") -> DataFrame:
    """Current (newest) or last-run (second newest) generation; an absent or
    unreadable generation is an empty DataFrame with ``schema``."""
    gens = list_generations(spark, base)
    idx = {"current": -1, "last_run": -2}[which]
    if len(gens) < -idx:
        return spark.createDataFrame([], schema)
    path = f"{base.rstrip('/')}/gen={gens[idx]}"
    if not _readable(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _readable(spark: SparkSession, path: str) -> bool:
    """False only if a footer of the table is no Parquet; any other trouble raises."""
    try:
        spark.read.option("mergeSchema", "true").parquet(path)
        return True
    except Exception as e:  # the footers are read by a job, whose error type differs by version
        if "CANNOT_READ_FILE_FOOTER" in str(e) or "is not a Parquet file" in str(e):
            return False
        raise


def optional_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A prior table that may be missing: empty with the declared schema then."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).load(path)


# --- S12 / S13 / S14: per-client partitions ----------------------------------

def replace_partitions(df: DataFrame, path: str, partition_cols: list[str]) -> None:
    """Overwrite only the partitions present in ``df`` (delete + write by name).

    An empty ``df`` touches nothing.
    """
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).parquet(path))


def promote_baseline(spark: SparkSession, plans_path: str, clients: DataFrame,
                     schema: T.StructType) -> None:
    """Copy ``version=current`` of the given clients to ``version=last_processed``."""
    cur = optional_table(spark, plans_path, schema).where(F.col("version") == "current")
    sel = cur.join(clients.select("client").distinct(), "client", "left_semi") \
        .withColumn("version", F.lit("last_processed"))
    replace_partitions(sel, plans_path, ["version", "client"])


def full_run_reset(prior: DataFrame, full_run: bool) -> DataFrame:
    """On a full run prior state counts as empty (it is then overwritten)."""
    return prior.limit(0) if full_run else prior


def replace_client_partitions(df: DataFrame, path: str, clients: DataFrame) -> None:
    """Replace the partitions of all given clients; those without rows in ``df`` go.

    ``df`` is evaluated once, by the write. A client that has no rows in it is one whose
    folder the write has not replaced: its files are older than the write.
    """
    spark = df.sparkSession
    before = _client_folders(spark, path)
    marks = {name: _files(spark, f"{path.rstrip('/')}/{name}") for name in before}
    replace_partitions(df, path, ["client"])
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for row in clients.select("client").distinct().where("client is not null").toLocalIterator():
        name = f"client={escape(row['client'])}"
        if name in marks and _files(spark, f"{path.rstrip('/')}/{name}") == marks[name]:
            _delete(spark, f"{path.rstrip('/')}/{name}")


def _client_folders(spark: SparkSession, path: str) -> list[str]:
    if not _exists(spark, path):
        return []
    fs, p = _fs(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory() and st.getPath().getName().startswith("client=")]


def _files(spark: SparkSession, path: str) -> set[str]:
    if not _exists(spark, path):
        return set()
    fs, p = _fs(spark, path)
    return {st.getPath().getName() for st in fs.listStatus(p)}


def write_ordered_lines(lines: DataFrame, path: str, by: str, order_cols: list[str],
                        line_col: str = "line") -> None:
    """One text file set per ``by`` value (tree listing, diff report), lines in
    ``order_cols`` order: range partitions plus a sort inside each, so part
    files read in name order give the text without gathering a client's lines
    into one row."""
    n = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (lines.repartitionByRange(n, by, *order_cols).sortWithinPartitions(by, *order_cols)
     .select(by, F.col(line_col).alias("value"))
     .write.mode("overwrite").partitionBy(by).text(path))
