"""Change feed at scale: keyed state, touched buckets, subtree cascade, pointer doubling."""

import os
import random

import pytest

from foliant import session
from foliant.operators import cascade as CC
from foliant.operators import changes as CH
from foliant.operators import hierarchy as H
from foliant.session import FOLDER_MIME, scratch_dir
from foliant.streaming import changefeed as CF
from foliant.streaming import statefeed as SF

NODE = "id string, parent_id string, name string, mime_type string, size long"
CHANGE = "seq long, change_type string, file_id string, removed boolean, parent_id string, name string, mime_type string, size long"


def tree(rnd, folders, files):
    rows = [("root", None, "ROOT", FOLDER_MIME, None)]
    ids = ["root"]
    for i in range(folders):
        rows.append((f"d{i}", rnd.choice(ids[-30:]), f"n{i}", FOLDER_MIME, None))
        ids.append(f"d{i}")
    rows += [(f"f{i}", rnd.choice(ids), f"file{i}", "text/plain", i) for i in range(files)]
    return rows


def as_rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


# -- walk and upward paths ------------------------------------------------------

def test_walk_of_a_deep_tree_has_a_short_plan(spark):
    nodes = spark.createDataFrame([("root", None, "ROOT", FOLDER_MIME, None)]
                                  + [(f"d{i}", "root" if not i else f"d{i - 1}", f"n{i}", FOLDER_MIME, None) for i in range(40)], NODE)
    before = session.open_stages()
    walked = H.tree_paths(nodes, "root", store_result=False)
    assert len(walked._jdf.queryExecution().toString()) < 1_000_000
    assert walked.where("id = 'd39'").first().indent == 39
    stored = H.tree_paths(nodes, "root")
    assert stored.count() == 41
    assert len(session.open_stages()) == len(before) + 3  # folders and levels of the lazy one, the stored result


def test_pointer_doubling_takes_logarithmic_rounds(spark, monkeypatch):
    rows = [("root", None, "ROOT", FOLDER_MIME, None)] + [(f"d{i}", "root" if not i else f"d{i - 1}", f"n{i}", FOLDER_MIME, None) for i in range(1000)]
    rows += [("x", "d999", "x", "text/plain", 1), ("lost", "nowhere", "y", "text/plain", 1), ("a", "b", "a", FOLDER_MIME, None), ("b", "a", "b", FOLDER_MIME, None)]
    nodes = spark.createDataFrame(rows, NODE)
    wanted = spark.createDataFrame([("x",), ("lost",), ("d3",), ("gone",)], "id string")
    writes = []
    real = H.materialize
    monkeypatch.setattr(H, "materialize", lambda df: writes.append(1) or real(df))
    got = {r.id: r.path for r in H.resolve_changed_paths(wanted, nodes, "root", chase_rounds=0).collect()}
    assert got == {"x": "ROOT/" + "/".join(f"n{i}" for i in range(1000)) + "/x", "lost": "ROOT/Unknown/y", "d3": "ROOT/n0/n1/n2/n3", "gone": "ROOT/Unknown"}
    assert len(writes) <= 15
    assert {r.id: r.path for r in H.resolve_changed_paths(wanted, nodes, "root").collect()} == got
    with pytest.raises(H.TreeDepthError):
        H.resolve_changed_paths(spark.createDataFrame([("a",)], "id string"), nodes, "root")


# -- cascade ---------------------------------------------------------------------

@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cascade_equals_a_whole_walk(spark, seed):
    rnd = random.Random(seed)
    rows = tree(rnd, 60, 80) + [("orphan", "later", "o", "text/plain", 1), ("kid", "d5x", "k", FOLDER_MIME, None)]
    nodes = spark.createDataFrame(rows, NODE)
    changes = []
    for seq in range(25):
        target = rnd.choice([f"d{rnd.randrange(60)}", f"f{rnd.randrange(80)}", f"new{rnd.randrange(4)}", "later"])
        folder = target[0] in "dnl"
        if rnd.random() < 0.25:
            changes.append((seq, "file", target, True, None, None, None, None))
        else:  # now and then below itself, a file, or nothing
            parent = rnd.choice([f"d{rnd.randrange(60)}"] * 6 + ["root", "new1", f"f{rnd.randrange(80)}", "nowhere", target])
            changes.append((seq, "file", target, False, parent, f"c{seq}", FOLDER_MIME if folder else "text/plain", None if folder else seq))
    changes = spark.createDataFrame(changes, CHANGE)
    got, live = CC.cascade_changes(H.tree_paths(nodes, "root"), nodes, changes, "root")
    want = H.tree_paths(CH.apply_to_nodes(nodes, CH.latest_changes(changes)), "root")
    assert as_rows(got, *CH.INVENTORY_COLS) == as_rows(want, *CH.INVENTORY_COLS)
    assert live.count() >= got.count()


def test_intervals_are_nested(spark, monkeypatch):
    monkeypatch.setattr(CC, "BLOCK", 4)
    rows = tree(random.Random(5), 70, 10)
    parent = {r[0]: r[1] for r in rows}
    inv = H.tree_paths(spark.createDataFrame(rows, NODE), "root")
    ranges = CC.folder_intervals(inv, "root")
    at = {r.id: (r.lo, r.hi) for r in ranges.collect()}
    folders = [r[0] for r in rows if r[3] == FOLDER_MIME]
    assert sorted(lo for lo, _ in at.values()) == list(range(len(folders)))

    def below(x):
        out = set()
        for f in folders:
            up = f
            while up is not None and up != x:
                up = parent[up]
            if up == x:
                out.add(f)
        return out

    for f in folders:
        assert {g for g in folders if at[f][0] <= at[g][0] <= at[f][1]} == below(f)
    some = ranges.where("id in ('d3', 'd10', 'd40')")
    assert {r.id for r in CC.within(ranges, some.select("lo", "hi")).collect()} == below("d3") | below("d10") | below("d40")


# -- buckets -----------------------------------------------------------------------

def files_below(path):
    path = path.removeprefix("file:")
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_one_change_rewrites_one_bucket(spark):
    rows = tree(random.Random(8), 40, 200)
    nodes = spark.createDataFrame(rows, NODE)
    base = scratch_dir(spark, "buckets")
    store = CH.node_store(spark, base, H.tree_paths(nodes, "root"), nodes, n_buckets=16)
    before = files_below(base)
    change = spark.createDataFrame([(1, "file", "f7", False, "d11", "renamed", "text/plain", 5)], CHANGE)
    open_before = session.open_stages()
    gen, rescanned = CH.apply_changes_bucketed(store, change, "root", "ROOT")
    assert (gen, rescanned) == (2, False) and session.open_stages() == open_before or len(session.open_stages()) <= len(open_before) + 1
    after = files_below(base)
    assert {p: after[p] for p in before} == before
    assert {p.split("/gen=")[0].rsplit("/", 1)[1] + "/" + p.split("/")[-2] for p in set(after) - set(before)} == {
        f"{part}/bucket={b}" for part in ("nodes", "inventory") for b in store.buckets_of(change, "file_id")}
    want, _, _ = CH.apply_changes(H.tree_paths(nodes, "root"), nodes, change, "root", "ROOT")
    assert as_rows(store.read("inventory"), *CH.INVENTORY_COLS) == as_rows(want, *CH.INVENTORY_COLS)


def test_bucket_store_over_many_polls(spark):
    rnd = random.Random(9)
    rows = tree(rnd, 30, 60)
    nodes = spark.createDataFrame(rows, NODE)
    inv = H.tree_paths(nodes, "root")
    base = scratch_dir(spark, "buckets")
    store = CH.node_store(spark, base, inv, nodes, n_buckets=8)
    seq = 0
    for poll in range(4):
        changes = []
        for _ in range(5):
            seq += 1
            gone = rnd.random() < 0.3
            changes.append((seq, "drive" if poll == 2 and seq % 5 == 0 else "file", f"f{rnd.randrange(70)}", gone, None if gone else f"d{rnd.randrange(30)}",
                            f"c{seq}", "text/plain", seq))
        df = spark.createDataFrame(changes, CHANGE)
        _, flag = CH.apply_changes_bucketed(store, df, "root", "ROOT")
        inv, nodes, want = CH.apply_changes(inv, nodes, df, "root", "ROOT")
        inv, nodes = session.materialize(inv), session.materialize(nodes)
        assert flag == want == (poll == 2)
        for part, df in (("inventory", inv), ("nodes", nodes)):
            assert as_rows(store.read(part), *df.columns) == as_rows(df, *df.columns)
    assert store.generations() == [4, 5]


def test_an_aborted_generation_leaves_the_last_one(spark):
    nodes = spark.createDataFrame(tree(random.Random(1), 5, 5), NODE)
    base = scratch_dir(spark, "buckets")
    store = CH.node_store(spark, base, H.tree_paths(nodes, "root"), nodes, n_buckets=4)
    nodes.limit(1).selectExpr("*", "0 as bucket").write.partitionBy("bucket").parquet(f"{base}/nodes/gen=2")  # no manifest
    assert store.read("nodes").count() == nodes.count()
    store.commit({"nodes": (nodes.where("id = 'root'"), None)})
    assert [r.id for r in store.read("nodes").collect()] == ["root"] and store.read("inventory").count() == 11


# -- keyed state --------------------------------------------------------------------

DAYS = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]


def feed(spark, nodes, days):
    rows = [(1, "file", "f1", False, "d1", "a", "text/plain", 5, DAYS[0]), (2, "file", "f1", True, None, None, None, None, DAYS[0]),
            (3, "file", "f1", True, None, None, None, None, DAYS[1]), (4, "drive", None, False, None, None, None, None, DAYS[1]),
            (5, "file", "f1", False, "d2", "b", "text/plain", None, DAYS[2]), (6, None, "f9", None, "d2", "new", "text/plain", 7, DAYS[2]),
            (7, "file", "f9", False, "d3", "new2", "text/plain", 8, DAYS[3]), (8, "file", None, False, "d3", "x", "text/plain", 8, DAYS[3])]
    df = spark.createDataFrame([r for r in rows if r[-1] in days], CHANGE + ", batch_day string") \
        .withColumn("batch_day", session_date("batch_day"))
    cols = [f.name for f in CF.CHANGE_FLAT.fields]
    return df.select(*cols) if nodes is None else SF.snapshot_records(nodes).unionByName(df.select(*cols))


def session_date(col):
    from pyspark.sql import functions as F
    return F.col(col).cast("date")


def test_state_stream_goes_on_after_a_restart(spark):
    nodes = spark.createDataFrame([("f1", "d0", "old", "text/plain", 1), ("f2", "d0", "two", "text/plain", 2)], NODE)
    cols = ["file_id", "seq", "kind", "parent_id", "name", "size", "old_name", "old_size"]

    def landed(parts, trigger):
        landing, out, ckpt = (scratch_dir(spark, n) for n in ("land", "out", "ckpt"))
        for i, (n, days) in enumerate(parts):
            CF.land_changes(feed(spark, n, days), landing, mode="append" if i else "overwrite")
            SF.run_state_stream(spark, landing, out, ckpt, files_per_trigger=trigger)
        return spark.read.parquet(out)

    whole = landed([(nodes, DAYS)], 1)
    parted = landed([(nodes, DAYS[:2]), (None, DAYS[2:])], 5)
    assert as_rows(whole, *cols) == as_rows(parted, *cols)
    assert [r for r in as_rows(whole, *cols) if r[1] > 0] == [
        ("f1", 1, "update", "d1", "a", 5, "old", 1), ("f1", 2, "delete", None, None, None, "a", 5), ("f1", 3, "none", None, None, None, None, None),
        ("f1", 5, "insert", "d2", "b", None, None, None), ("f9", 6, "insert", "d2", "new", 7, None, None), ("f9", 7, "update", "d3", "new2", 8, "new", 7)]
    live = SF.live_nodes(whole)
    assert as_rows(live, "id", "name") == [("f1", "b"), ("f2", "two"), ("f9", "new2")]


def test_an_epoch_that_is_run_again_gives_the_same_rows(spark):
    out, ckpt = scratch_dir(spark, "out"), scratch_dir(spark, "ckpt")
    write = SF.make_state_writer(out, ckpt)
    write(feed(spark, None, DAYS[:1]), 0)
    before = []
    for _ in range(2):  # the second time its state has been written already
        write(feed(spark, None, DAYS[1:]), 1)
        before.append(as_rows(spark.read.parquet(out), "epoch", "file_id", "seq", "kind", "name", "old_name"))
    assert before[0] == before[1] == [(0, "f1", 1, "insert", "a", None), (0, "f1", 2, "delete", None, "a"), (1, "f1", 3, "none", None, None),
                                      (1, "f1", 5, "insert", "b", None), (1, "f9", 6, "insert", "new", None), (1, "f9", 7, "update", "new2", "new")]
    write(feed(spark, None, DAYS), 2)  # all applied already
    assert spark.read.parquet(out).count() == 6


# -- stored inventory ----------------------------------------------------------------

def test_an_epoch_writes_its_last_tables_once(spark, monkeypatch):
    """No stage copy of the tables that the new generation keeps, whichever way the epoch ends."""
    rows = tree(random.Random(3), 30, 60)
    nodes = spark.createDataFrame(rows, NODE)
    store = CF.InventoryStore(spark, scratch_dir(spark, "store"))
    CF.init_store(store, H.tree_paths(nodes, "root"), nodes)
    copies = []
    real = CF.materialize
    monkeypatch.setattr(CF, "materialize", lambda df: copies.append(1) or real(df))
    write = CF.make_batch_writer(store, "root", "ROOT")
    changes = [(1, "file", "f1", False, "d4", "a", "text/plain", 5, DAYS[0]), (2, "file", "d7", False, "d1", "b", FOLDER_MIME, None, DAYS[0]),
               (3, "drive", None, False, None, None, None, None, DAYS[1]), (4, "file", "f2", True, None, None, None, None, DAYS[1])]
    more = [(5, "file", "f3", False, "d7", "c", "text/plain", 6, DAYS[2])]
    inv = H.tree_paths(nodes, "root")
    before = session.open_stages()
    for epoch, batch in enumerate((changes, more)):
        df = spark.createDataFrame(batch, CHANGE + ", batch_day string").withColumn("batch_day", session_date("batch_day"))
        write(df, epoch)
        inv, nodes, _ = CH.apply_changes(inv, nodes, df, "root", "ROOT")
        assert as_rows(store.read("inventory"), *CH.INVENTORY_COLS) == as_rows(inv, *CH.INVENTORY_COLS)
        assert as_rows(store.read("nodes"), *CH.NODE_COLS) == as_rows(nodes, *CH.NODE_COLS)
        assert store.read("inventory").columns == CH.INVENTORY_COLS and store.current_gen() == epoch + 2
    assert copies == [] and len(session.open_stages()) >= len(before)
