"""End-to-end walk-through: scan -> change -> patch -> only the touched client is
replanned -> processed -> baseline moved -> diff empty."""

from pyspark.sql import functions as F

from foliant.operators import changes as CH
from foliant.operators.hierarchy import tree_paths
from foliant.operators.packing import pack_batches
from foliant.operators.plandiff import plan_diff
from foliant.operators.tasks import client_files, task_columns
from foliant.plans.planner import plan_clients
from foliant.session import materialize

FOLDER = "application/vnd.google-apps.folder"
NODE = "id string, parent_id string, name string, mime_type string, size long"


def test_walkthrough(spark):
    nodes = spark.createDataFrame([
        ("root", None, "ROOT", FOLDER, None), ("s", "root", "ATUAIS", FOLDER, None),
        ("c1", "s", "ACME", FOLDER, None), ("c2", "s", "BETA", FOLDER, None),
        ("f1", "c1", "a.pdf", "application/pdf", 40), ("f2", "c1", "b.txt", "text/plain", 10),
        ("f3", "c2", "c.pdf", "application/pdf", 30)], NODE)
    inv1 = materialize(tree_paths(nodes, "root").select(*CH.INVENTORY_COLS))
    cf = spark.createDataFrame([("ACME", 0, "c1", "ACME", "ROOT/ATUAIS/ACME"),
                                ("BETA", 0, "c2", "BETA", "ROOT/ATUAIS/BETA")],
                               "client string, pos int, folder_id string, folder_name string, folder_path string")
    tasks1 = task_columns(client_files(inv1, cf))
    items1 = materialize(pack_batches(tasks1, limit=100))
    # processed: the first plan is also the baseline
    base_items, base_tasks = items1, tasks1

    ch = spark.createDataFrame([(1, "file", "f4", False, "c1", "d.pdf", "application/pdf", 20)],
                               "seq long, change_type string, file_id string, removed boolean, parent_id string, "
                               "name string, mime_type string, size long")
    inv2, _, rescanned = CH.apply_changes(inv1, nodes, ch, "root", "ROOT")
    assert not rescanned
    inv2 = materialize(inv2)
    assert inv2.where(F.col("id") == "f4").select("path").collect()[0].path == "ROOT/ATUAIS/ACME/d.pdf"

    res = plan_clients(inv2, inv1, cf, items1, tasks1, base_items, base_tasks, limit=100)
    assert [r.client for r in res.clients.collect()] == ["ACME"]
    diff = {(r.file_id, r.op) for r in res.diff.collect()}
    assert diff == {("f4", "ADDED")}
    # f1 and f2 keep their batches (sticky)
    old = {r.file_id: r.batch_id for r in items1.collect()}
    new = {r.file_id: r.batch_id for r in res.items.collect()}
    assert new["f1"] == old["f1"] and new["f2"] == old["f2"]
    # after processing, the new plan is the baseline and the diff is empty
    assert plan_diff(res.items, res.tasks, res.items, res.tasks).count() == 0
    # nothing changed since: no client needs a plan
    again = plan_clients(inv2, inv2, cf, res.items, res.tasks, res.items, res.tasks, limit=100)
    assert again.clients.count() == 0
