"""Python data sources over files of the shared store: change pages in, named files out.

* ``change_pages`` (stream): landed pages of change records, ``token=<n>`` folders of
  JSON lines. The offset of the stream is the page token, so a stream can start
  behind a token that was recorded before a scan, and its checkpoint is that token.
* ``named_files`` (batch write): ordered pieces become one file per target name, each
  with a bounded buffer. Tasks write below a work folder of the job, with a list of their
  targets beside the files; the driver hears of one folder a task. Tasks then move the files
  of the finished folders to their names; a failed write leaves none.
* ``read_whole_files``: whole files below a folder, listed and read by tasks.

Files are opened through pyarrow's file systems by URI, on executors and driver alike.
"""

from __future__ import annotations

import json
import os
import posixpath
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceStreamReader, DataSourceWriter, InputPartition,
                                    WriterCommitMessage)

PAGE_COLUMNS = ["seq", "change_type", "file_id", "removed", "parent_id", "name", "mime_type", "size"]
PAGE_SCHEMA = ("token long, seq long, change_type string, file_id string, removed boolean, parent_id string, "
               "name string, mime_type string, size long")


def open_store(uri: str):
    """File system and base path of a URI (or plain path)."""
    from pyarrow import fs
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


# -- change pages -------------------------------------------------------------------

def land_pages(changes: DataFrame, path: str, token: str = "token", mode: str = "overwrite") -> None:
    """Write change records as pages, one folder ``token=<n>`` for each value of ``token``."""
    changes.select(F.col(token).cast("long").alias("token"), *PAGE_COLUMNS).repartition("token") \
        .write.mode(mode).partitionBy("token").json(path)


def page_tokens(path: str) -> list[int]:
    """The tokens of the pages that have landed, in order."""
    from pyarrow import fs
    store, base = open_store(path)
    found = store.get_file_info(fs.FileSelector(base, allow_not_found=True))
    return sorted(int(f.base_name[6:]) for f in found if f.type == fs.FileType.Directory and f.base_name.startswith("token="))


def newest_token(path: str) -> int:
    """The token to record before a scan: of the newest page (0: none has landed)."""
    return max(page_tokens(path), default=0)


@dataclass
class _Page(InputPartition):
    token: int

    def __init__(self, token: int):
        self.token = token


class PagesReader(DataSourceStreamReader):
    def __init__(self, path: str, start: int):
        self.path, self.start = path, start

    def initialOffset(self) -> dict:
        return {"token": self.start}

    def latestOffset(self) -> dict:
        return {"token": max(newest_token(self.path), self.start)}

    def partitions(self, start: dict, end: dict):
        return [_Page(t) for t in page_tokens(self.path) if start["token"] < t <= end["token"]]

    def read(self, partition):
        from pyarrow import fs
        store, base = open_store(self.path)
        folder = f"{base}/token={partition.token}"
        for info in sorted(store.get_file_info(fs.FileSelector(folder)), key=lambda f: f.path):
            if info.base_name.startswith(("_", ".")) or info.type != fs.FileType.File:
                continue
            with store.open_input_stream(info.path) as stream:
                for line in _lines(stream):
                    row = json.loads(line)
                    yield (partition.token, *[row.get(c) for c in PAGE_COLUMNS])


def _lines(stream, block: int = 1 << 20):
    held = b""
    while data := stream.read(block):
        *whole, held = (held + data).split(b"\n")
        yield from (w for w in whole if w.strip())
    if held.strip():
        yield held


class ChangePages(DataSource):
    """Options: ``path``, and ``startToken`` (default 0): pages above it are read."""

    @classmethod
    def name(cls) -> str:
        return "change_pages"

    def schema(self) -> str:
        return PAGE_SCHEMA

    def streamReader(self, schema):
        return PagesReader(self.options["path"], int(self.options.get("startToken", 0)))


def read_pages(spark: SparkSession, path: str, start_token: int = 0) -> DataFrame:
    """The stream of the change records of the pages above ``start_token``."""
    spark.dataSource.register(ChangePages)
    return spark.readStream.format("change_pages").option("path", path).option("startToken", str(start_token)).load()


# -- named files ---------------------------------------------------------------------

#: Files of a work folder: the targets of a task's files, and the folders of the finished tasks.
TARGETS, FINISHED = "_targets", "_finished"


@dataclass
class _Written(WriterCommitMessage):
    folder: str | None = None  # of the task's files; None: it had no rows


class NamedFilesWriter(DataSourceWriter):
    def __init__(self, path: str, work: str):
        self.path, self.work = path, work

    def write(self, iterator):
        store, base = open_store(self.path)
        folder = uuid.uuid4().hex
        attempt = f"{base}/{self.work}/{folder}"
        out, target, listed, n = None, None, None, 0
        try:
            for row in iterator:
                if row["target"] != target:
                    if out is not None:
                        out.close()
                    target = row["target"]
                    if listed is None:
                        store.create_dir(attempt, recursive=True)
                        listed = store.open_output_stream(f"{attempt}/{TARGETS}", compression=None)
                    listed.write(json.dumps([str(n), target]).encode() + b"\n")
                    out = store.open_output_stream(f"{attempt}/{n}", compression=None)
                    n += 1
                if row["piece"] is not None:
                    out.write(row["piece"].encode())
        finally:
            for stream in (out, listed):
                if stream is not None:
                    stream.close()
        return _Written(folder if listed is not None else None)

    def commit(self, messages) -> None:
        store, base = open_store(self.path)
        store.create_dir(f"{base}/{self.work}", recursive=True)
        with store.open_output_stream(f"{base}/{self.work}/{FINISHED}", compression=None) as out:
            out.write("\n".join(m.folder for m in messages if m is not None and m.folder is not None).encode())

    def abort(self, messages) -> None:
        _remove(self.path, self.work)


class NamedFiles(DataSource):
    """Options ``path`` and ``work``, the work folder's name; rows ``target, piece``, all rows of a target in
    one task and in order. ``write_named_files`` moves what has been written to its names."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "target string, piece string"

    def writer(self, schema, overwrite):
        return NamedFilesWriter(self.options["path"], self.options["work"])


def _remove(path: str, work: str) -> None:
    from pyarrow import fs
    store, base = open_store(path)
    if store.get_file_info(f"{base}/{work}").type != fs.FileType.NotFound:
        store.delete_dir(f"{base}/{work}")


def _move_files(spark: SparkSession, path: str, work: str) -> None:
    """Move the files of the finished tasks to their names, the files of a folder in one task."""
    store, base = open_store(path)
    with store.open_input_stream(f"{base}/{work}/{FINISHED}") as stream:
        folders = stream.read().decode().split()
    if not folders:
        return

    def listed(batches):
        import pandas as pd
        store, base = open_store(path)
        for batch in batches:
            for folder in batch["folder"]:
                with store.open_input_stream(f"{base}/{work}/{folder}/{TARGETS}") as stream:
                    rows = []
                    for line in _lines(stream):
                        name, target = json.loads(line)
                        rows.append((f"{work}/{folder}/{name}", target))
                        if len(rows) == 10_000:
                            yield pd.DataFrame(rows, columns=["source", "target"])
                            rows = []
                    yield pd.DataFrame(rows, columns=["source", "target"], dtype=object)

    def moved(batches):
        from pyarrow import fs
        store, base = open_store(path)
        made = None
        for batch in batches:
            for source, target in zip(batch["source"], batch["target"]):
                final = f"{base}/{target}"
                if posixpath.dirname(final) != made:
                    made = posixpath.dirname(final)
                    store.create_dir(made, recursive=True)
                try:
                    store.move(f"{base}/{source}", final)
                except FileNotFoundError:  # moved by an earlier attempt of this task
                    if store.get_file_info(final).type == fs.FileType.NotFound:
                        raise
            yield batch[["target"]]

    files = spark.createDataFrame([(f,) for f in folders], "folder string").repartition(len(folders)) \
        .mapInPandas(listed, "source string, target string")
    if not files.groupBy("target").count().where("count > 1").isEmpty():
        raise ValueError("a target's pieces came from several tasks or out of order")
    files.mapInPandas(moved, "target string").count()


def write_named_files(pieces: DataFrame, path: str, target: str, order_cols: list[str], piece: str = "piece") -> None:
    """One file ``path/<target>`` for each value of ``target`` (a relative path), its pieces in
    order. A target is written by one task, which holds one piece at a time; files of
    the same names are replaced, others stay."""
    spark = pieces.sparkSession
    spark.dataSource.register(NamedFiles)
    rows = pieces.select(F.col(target).alias("target"), F.col(piece).alias("piece"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)])
    rows = rows.repartition("target").sortWithinPartitions("target", *[f"_o{i}" for i in range(len(order_cols))]).select("target", "piece")
    work = f"_work-{uuid.uuid4().hex}"
    try:
        rows.write.format("named_files").option("path", path).option("work", work).mode("append").save()
        _move_files(spark, path, work)
    finally:
        _remove(path, work)


# -- whole files ---------------------------------------------------------------------

#: Bytes of file contents that a reading task hands over at once (a longer file alone).
READ_BATCH = 8 << 20


def _entries(store, folder: str):
    """``path, is_folder`` of what a folder holds, but for the names that Spark's readers leave out."""
    from pyarrow import fs
    if isinstance(store, fs.LocalFileSystem):
        with os.scandir(folder) as found:
            rows = ((f.name, f.is_dir()) for f in found)
            yield from ((posixpath.join(folder, name), is_folder) for name, is_folder in rows if not _left_out(name))
    else:
        for f in store.get_file_info(fs.FileSelector(folder)):
            if not _left_out(f.base_name):
                yield f.path, f.type == fs.FileType.Directory


def _left_out(name: str) -> bool:
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _files_below(store, folder: str):
    for path, is_folder in _entries(store, folder):
        if is_folder:
            yield from _files_below(store, path)
        else:
            yield path


def read_whole_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, content`` of every file below a folder (or of one file) that is not empty, as ``binaryFile`` gives
    them. One task lists the folder itself, the folders in it are shared out and listed by tasks, and so are the
    files to be read; the driver knows of none. A writer of very many files puts them into several folders.
    A path with a pattern goes to ``binaryFile``."""
    from pyarrow import fs
    if any(c in path for c in "*?[{"):
        return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place)
    uri, shown = place.toUri().toString(), place.toString()
    store, base = open_store(uri)
    kind = store.get_file_info(base).type
    if kind == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    prefix = shown.removesuffix(base)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def batches_of(rows, columns, kinds, size=lambda row: 1, most=10_000):
        import pyarrow as pa
        held, total = [], 0
        for row in rows:
            if held and total + size(row) > most:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], columns)
                held, total = [], 0
            held.append(row)
            total += size(row)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], columns)

    def top(batches):
        import pyarrow as pa
        store, _ = open_store(uri)
        rows = (row for batch in batches for folder in batch.column(0).to_pylist() for row in _entries(store, folder))
        yield from batches_of(rows, ["path", "is_folder"], [pa.string(), pa.bool_()])

    def below(batches):
        import pyarrow as pa
        store, _ = open_store(uri)
        found = (row for batch in batches for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        rows = ((file,) for name, is_folder in found for file in (_files_below(store, name) if is_folder else [name]))
        yield from batches_of(rows, ["path"], [pa.string()])

    def read(batches):
        import pyarrow as pa
        store, _ = open_store(uri)

        def contents():
            for batch in batches:
                for name in batch.column(0).to_pylist():
                    with store.open_input_stream(name, compression=None) as stream:
                        content = stream.read()
                    if content:
                        yield prefix + name, content
        yield from batches_of(contents(), ["path", "content"], [pa.string(), pa.binary()], lambda row: len(row[1]) + 200, READ_BATCH)

    start = spark.createDataFrame([(base,)], "path string")
    if kind == fs.FileType.Directory:
        start = start.mapInArrow(top, "path string, is_folder boolean").repartition(n, "path").mapInArrow(below, "path string")
    return start.repartition(n, "path").mapInArrow(read, "path string, content binary")
