"""Seeded random properties: prefix join = naive join; packing invariants."""

import random

from pyspark.sql import functions as F

from foliant.operators import packing as P
from foliant.operators.prefix import prefix_members


def naive_prefix_members(items, folders, folder_keys,
                         folder_path = "folder_path", item_path = "path"):
    """Reference form (cartesian product + filter); only for tests on tiny input."""
    fcols = list(dict.fromkeys(folder_keys + [folder_path]))
    f = folders.select(*fcols).where(F.col(folder_path).isNotNull() & (F.col(folder_path) != ""))
    return items.join(f, F.startswith(F.col(item_path), F.col(folder_path)))


def _random_paths(rng, n):
    names = ["A", "AB", "ABC", "B", "B 2", "C", "CA"]
    out = set()
    for _ in range(n):
        depth = rng.randint(1, 4)
        out.add("/".join(["R"] + [rng.choice(names) for _ in range(depth)]))
    return sorted(out)


def test_prefix_join_equals_naive(spark):
    rng = random.Random(7)
    paths = _random_paths(rng, 300)
    items = spark.createDataFrame([(f"i{i}", p) for i, p in enumerate(paths)], "id string, path string")
    folders = spark.createDataFrame(
        [(f"c{k % 4}", p) for k, p in enumerate(rng.sample(paths, 12))] + [("c9", "R/A"), ("c9", "R/A/AB")],
        "client string, folder_path string")
    fast = prefix_members(items, folders, ["client"], dedupe_by=["client"]).select("client", "id").collect()
    naive = naive_prefix_members(items, folders, ["client"]).select("client", "id").distinct().collect()
    assert sorted(map(tuple, fast)) == sorted(map(tuple, naive))
    comp = prefix_members(items, folders, ["client", "folder_path"], boundary="component") \
        .select("client", "folder_path", "id").collect()
    naive_c = naive_prefix_members(items, folders, ["client"]).where(
        (F.col("path") == F.col("folder_path")) | F.startswith("path", F.concat("folder_path", F.lit("/")))) \
        .select("client", "folder_path", "id").collect()
    assert sorted(map(tuple, comp)) == sorted(map(tuple, naive_c))


def _random_tasks(spark, rng, n):
    rows = []
    for i in range(n):
        fmt = rng.choice(["pdf", "txt"])
        rows.append((rng.choice(["X", "Y"]), f"f{i:04d}", f"f{i:04d}", rng.randint(0, 130), "DIRECT_INCLUDE", fmt))
    return spark.createDataFrame(rows, "client string, file_id string, file_name string, size long, "
                                       "task_type string, output_format string")


def test_packing_invariants(spark):
    rng = random.Random(11)
    tasks = _random_tasks(spark, rng, 400)
    items = P.pack_batches(tasks, limit=100)
    rows = items.collect()
    assert len(rows) == 400 and len({(r.client, r.file_id) for r in rows}) == 400
    loads = {}
    for r in rows:
        loads.setdefault((r.client, r.batch_id), []).append(r.size)
    for sizes in loads.values():
        assert len(sizes) == 1 or sum(sizes) <= 100
    # Same tasks again with the plan as history: nothing moves.
    again = P.repack_batches(tasks, items, tasks, limit=100)
    key = lambda r: (r.client, r.file_id, r.batch_id)
    a = {key(r) for r in again.collect()}
    b = {key(r) for r in rows}
    oversize = {(r.client, r.file_id) for r in rows if r.size > 100}
    assert {k for k in a if k[:2] not in oversize} == {k for k in b if k[:2] not in oversize}


def test_new_batch_numbers_are_tried_once():
    import pandas as pd

    tries = []

    class Fmt(str):
        def __format__(self, spec):
            tries.append(1)
            return str(self)

    fmt = Fmt("pdf")
    kept = [(0, "X", fmt, i, f"pdf_batch_{i + 1001 + (i >= 500)}", 100, 1, "", 0) for i in range(1000)]
    new = [(1, "X", fmt, 0, "", 0, 0, f"f{i:04}", 100) for i in range(500)]
    cols = ["kind", "client", "fmt", "batch_pos", "batch_id", "load", "next_item", "file_id", "size"]
    out = pd.concat(P._placer(100)(iter([pd.DataFrame(kept + new, columns=cols)])))
    # first free number at or above list length + 1: 1501 is free, then all from 2002 on
    assert out["batch_id"].tolist() == ["pdf_batch_1501"] + [f"pdf_batch_{n}" for n in range(2002, 2501)]
    assert out["batch_pos"].tolist() == list(range(1000, 1500))
    assert len(tries) <= len(kept) + len(new) + 1
