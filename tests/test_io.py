"""Writers, readers and the streaming sink's idempotency."""

import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from foliant.operators import assembly as A
from foliant.operators import changes as CH
from foliant.operators.hierarchy import tree_paths
from foliant.session import scratch_dir
from foliant.streaming import changefeed as CF

FOLDER = "application/vnd.google-apps.folder"
CONTENT = ("client string, fmt string, batch_pos long, batch_id string, item_pos long, file_id string, "
           "file_name string, text string")


def local(uri):
    return uri.removeprefix("file:")


def test_write_batch_texts_matches_concat(spark):
    rows = [("X", "txt", 0, "txt_batch_1", i, f"f{i}", f"n{i}.txt", f"line {i}\nmore {i}") for i in range(30)]
    contents = spark.createDataFrame(rows, CONTENT)
    names = spark.createDataFrame([("X", "txt", "txt_batch_1", "X_batch_1.txt")],
                                  "client string, fmt string, batch_id string, output_name string")
    expected = A.concat_texts(contents, names).collect()[0].text
    path = scratch_dir(spark, "batch-texts")
    A.write_batch_texts(contents, names, path)
    parts = sorted(glob.glob(f"{local(path)}/client=X/output_name=X_batch_1.txt/part-*"))
    written = "".join(open(p, encoding="utf-8").read() for p in parts)
    assert written == expected


def test_read_text_lenient_drops_bad_bytes(spark):
    d = tempfile.mkdtemp()
    with open(os.path.join(d, "good.txt"), "wb") as fh:
        fh.write("ação ok".encode("utf-8"))
    with open(os.path.join(d, "bad.txt"), "wb") as fh:
        fh.write(b"abc\xff\xfedef")
    got = {os.path.basename(r.path): r.text for r in A.read_text_lenient(spark, d).collect()}
    assert got == {"good.txt": "ação ok", "bad.txt": "abcdef"}


def test_whole_files_are_listed_by_tasks(spark, tmp_path):
    """The driver holds no list of the files; folders of any depth are read, hidden names left out, paths as Spark writes them."""
    files = {f"{i % 7}/f{i}.txt": f"text {i}" for i in range(60)} | {"top.txt": "top", "a b%41/c#/deep.txt": "deep", "k=1/_x=2/p.txt": "part"}
    for name, text in (files | {"empty.txt": "", "_hidden/h.txt": "no", ".h.txt": "no", "1/_SUCCESS": "no", "2/z._COPYING_": "no"}).items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    df = A.read_text_lenient(spark, str(tmp_path))
    assert df.inputFiles() == []
    assert sorted((r.path, r.text) for r in df.collect()) == sorted((f"file:{tmp_path}/{name}", text) for name, text in files.items())
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path)).select("path")
    assert sorted(r.path for r in listed.collect()) == sorted(r.path for r in df.collect())
    assert [r.text for r in A.read_text_lenient(spark, f"{tmp_path}/top.txt").collect()] == ["top"]
    assert A.read_text_lenient(spark, f"{tmp_path}/1/*.txt").count() == 9
    (tmp_path / "none").mkdir()
    assert A.read_text_lenient(spark, f"{tmp_path}/none").count() == 0
    with pytest.raises(FileNotFoundError):
        A.read_text_lenient(spark, f"{tmp_path}/absent")


def test_stream_epoch_replay_is_skipped(spark):
    nodes = spark.createDataFrame([("root", None, "ROOT", FOLDER, None), ("a", "root", "a", "text/plain", 1)],
                                  "id string, parent_id string, name string, mime_type string, size long")
    inv = tree_paths(nodes, "root").select(*CH.INVENTORY_COLS)
    store = CF.InventoryStore(spark, scratch_dir(spark, "store"))
    CF.init_store(store, inv, nodes)
    batch = spark.createDataFrame(
        [(1, "file", "b", False, "root", "b", "text/plain", 2, None)], CF.CHANGE_FLAT) \
        .withColumn("batch_day", F.lit("2024-01-01").cast("date"))
    write = CF.make_batch_writer(store, "root", "ROOT")
    write(batch, 0)
    gen = store.current_gen()
    assert {r.id for r in store.read("inventory").collect()} == {"root", "a", "b"}
    write(batch, 0)  # replay of the same epoch: no new generation
    assert store.current_gen() == gen
    assert store.state()["last_seq"] == 1


def test_stream_keeps_poll_order_when_a_parent_changes(spark):
    nodes = spark.createDataFrame([("root", None, "ROOT", FOLDER, None), ("F", "root", "old", FOLDER, None)],
                                  "id string, parent_id string, name string, mime_type string, size long")
    inv = tree_paths(nodes, "root").select(*CH.INVENTORY_COLS)
    store = CF.InventoryStore(spark, scratch_dir(spark, "store2"))
    CF.init_store(store, inv, nodes)
    batch = spark.createDataFrame([
        (1, "file", "x", False, "F", "x", "text/plain", 1, None),
        (2, "file", "F", False, "root", "new", FOLDER, None, None)], CF.CHANGE_FLAT) \
        .withColumn("batch_day", F.when(F.col("seq") == 1, F.lit("2024-01-01")).otherwise(F.lit("2024-01-02"))
                    .cast("date"))
    CF.make_batch_writer(store, "root", "ROOT")(batch, 0)
    paths = {r.id: r.path for r in store.read("inventory").collect()}
    # poll 1 placed x under the old name; poll 2 renames F without cascading
    assert paths == {"root": "ROOT", "F": "ROOT/new", "x": "ROOT/old/x"}


def test_tree_lines_written_in_order(spark):
    from foliant.operators.hierarchy import client_tree_lines, render_tree_text
    from foliant.operators.prefix import prefix_members
    from foliant.sources.store import write_ordered_lines
    rows = [("root", None, "ROOT", FOLDER), ("A", "root", "A", FOLDER), ("acme", "A", "ACME", FOLDER)]
    rows += [(f"f{i:03d}", "acme", f"file{i:03d}.pdf", "application/pdf") for i in range(200)]
    nodes = spark.createDataFrame(rows, "id string, parent_id string, name string, mime_type string")
    inv = tree_paths(nodes, "root")
    cf = spark.createDataFrame([("ACME", 0, "ACME", "ROOT/A/ACME")],
                               "client string, pos int, folder_name string, folder_path string")
    lines = client_tree_lines(cf, prefix_members(inv, cf, ["client", "pos"]))
    expected = render_tree_text(lines).collect()[0].tree_text
    path = scratch_dir(spark, "trees")
    write_ordered_lines(lines, path, "client", ["section", "pos", "ord", "path", "id"])
    parts = sorted(glob.glob(f"{local(path)}/client=ACME/part-*"))
    assert "".join(open(p, encoding="utf-8").read() for p in parts) == expected


def test_listener_full_scan_and_decision(spark):
    import datetime as dt

    from foliant.plans import listener as L
    from foliant.sources.store import list_generations, scan_inventory
    nodes = spark.createDataFrame([("root", None, "ROOT", FOLDER), ("b", "root", "b", "text/plain"),
                                   ("a", "root", "a", "text/plain")],
                                  "id string, parent_id string, name string, mime_type string")
    base = scratch_dir(spark, "scans")
    for _ in range(3):
        L.full_scan(spark, nodes, "root", base)
    assert list_generations(spark, base) == [2, 3]
    paths = [r.path for r in scan_inventory(spark, f"{base}/gen=3").collect()]
    assert sorted(paths) == ["ROOT", "ROOT/a", "ROOT/b"]
    state_path = scratch_dir(spark, "state")
    st = L.read_state(spark, state_path)
    d = L.poll_decision(st, dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2, 12)).collect()[0]
    assert d.rescan_due and d.report_changed
    st = spark.createDataFrame([(dt.datetime(2024, 1, 2, 9), dt.datetime(2024, 1, 2), None)], st.schema)
    L.write_state(st, state_path)
    d = L.poll_decision(L.read_state(spark, state_path), dt.datetime(2024, 1, 2),
                        dt.datetime(2024, 1, 2, 12)).collect()[0]
    assert not d.rescan_due and not d.report_changed
