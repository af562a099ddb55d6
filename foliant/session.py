"""Session helpers: one place for the Spark settings the jobs rely on."""

from __future__ import annotations

import atexit
import os
import re
import tempfile

from pyspark.sql import SparkSession

# Fixed values that must equal the reference's behaviour.
FOLDER_MIME = "application/vnd.google-apps.folder"
BATCH_LIMIT_BYTES = 150 * 1024 * 1024  # 157,286,400 bytes per concatenated batch
REQUEST_BATCH_SIZE = 100  # names per matching request
DEFAULT_ROOT_NAME = "ROOT"
RESCAN_INTERVAL_HOURS = 6
LINK_PREFIX = "https://drive.google.com/file/d/"
LINK_SUFFIX = "/view"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "foliant") -> SparkSession:
    """Session for tests, the bench and local runs.

    On a cluster the session comes from the launcher; the jobs only read
    settings from it (see ``ensure_checkpoint_dir``).
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("FOLIANT_DRIVER_MEMORY", "8g"))
        .config("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only in a single-JVM session (``local[...]``: tests, local runs) a scratch
    folder is taken when nothing is configured. On a cluster a machine-local
    folder would lose every other executor's files, so there the setting is
    required.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not single_jvm(sc.master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master {sc.master})")
        configured = tempfile.mkdtemp(prefix="foliant-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def single_jvm(master: str) -> bool:
    return re.fullmatch(r"local(\[.*\])?", master) is not None


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder beside the checkpoint folder, with the folder's own URI scheme."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{os.urandom(6).hex()}"


_STAGES: dict[str, SparkSession] = {}


def materialize(df):
    """Cut lineage at a stage boundary with a written table.

    Used where the pipeline would store a table anyway (inventory, tasks,
    plans) and inside loops. The table is written as Parquet under the shared
    checkpoint folder (``spark.checkpoint.dir``) and read back with its
    schema, so a lost executor never replays the upstream jobs and the
    optimizer sees real file sizes. ``release`` removes it after its last use;
    what a returned DataFrame still reads goes when the driver ends.
    """
    spark = df.sparkSession
    path = stage_folder(spark, "stage").path
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stage_path = path
    return out


class StageFolder:
    """A folder for stage tables that are written piece by piece; ``release`` removes it."""

    def __init__(self, spark: SparkSession, path: str):
        self.sparkSession, self.path, self._stage_path = spark, path, path


def stage_folder(spark: SparkSession, name: str) -> StageFolder:
    folder = StageFolder(spark, scratch_dir(spark, name))
    if not _STAGES:
        atexit.register(release_all)
    _STAGES[folder.path] = spark
    return folder


def release(*frames) -> None:
    """Remove the tables behind materialized frames (or stage folders) that nothing reads any more."""
    for df in frames:
        path = getattr(df, "_stage_path", None)
        if path and _STAGES.pop(path, None) is not None:
            _delete(df.sparkSession, path)


def release_all() -> None:
    """Remove every stage table that is left (also run when the driver ends)."""
    for path, spark in list(_STAGES.items()):
        _STAGES.pop(path)
        if spark.sparkContext._jsc is not None:
            _delete(spark, path)


def open_stages() -> list[str]:
    return sorted(_STAGES)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)
