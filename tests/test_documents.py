"""Plan documents, named files, change pages, matching generations, digests."""

import json
import os

import pytest
from pyspark.sql import functions as F

from foliant.operators import matching as M
from foliant.operators import plandoc as PD
from foliant.operators import snapshots as SN
from foliant.plans import matcher as MJ
from foliant.session import scratch_dir
from foliant.sources import files as FL

TASK = ("client string, file_id string, file_name string, file_path string, drive_link string, mime_type string, size long, "
        "task_type string, output_format string")


def plan(spark):
    tasks = [("A \"q\"\n", f"f{i}", f"n{i}", f"p/{i % 3}", "l", "text/plain", i * 10**6, "IGNORE" if i == 4 else "CONVERT", "txt" if i % 2 else "pdf") for i in range(7)]
    tasks += [("B", "g1", "only", None, "l", "x/y", None, "IGNORE", None)]
    items = [("A \"q\"\n", f, b, f"b-{f}-{b}", k, fid, s) for f, b, k, fid, s in
             [("pdf", 0, 0, "f0", 0), ("pdf", 0, 1, "f2", 2 * 10**6), ("pdf", 1, 0, "f6", 6 * 10**6), ("txt", 0, 0, "f1", 10**6), ("txt", 0, 1, "f3", 3 * 10**6), ("txt", 2, 0, "f5", 5 * 10**6)]]
    folders = [("A \"q\"\n", 0, "d1", "one", "R/one"), ("A \"q\"\n", 1, "d2", "two \"x\"", "R/two"), ("C", 0, "d3", None, "R/three")]
    return (spark.createDataFrame(folders, "client string, pos int, folder_id string, folder_name string, folder_path string"), spark.createDataFrame(tasks, TASK),
            spark.createDataFrame(items, "client string, fmt string, batch_pos long, batch_id string, item_pos long, file_id string, size long"))


def test_plan_documents_are_json(spark):
    folders, tasks, items = plan(spark)
    parts = PD.plan_fragments(folders, tasks, items, "2025-01-01T00:00:00").repartition(5)
    text = {}
    for r in sorted(parts.collect(), key=lambda r: tuple(r[c] for c in PD.ORDER)):
        text.setdefault(r.client, []).append(r.line)
    docs = {c: json.loads("\n".join(lines)) for c, lines in text.items()}
    assert set(docs) == {"A \"q\"\n", "B", "C"}
    a = docs["A \"q\"\n"]
    assert list(a) == ["plan_generated_at", "client_master_name", "client_source_folders", "processing_tasks", "concatenation_plan"]
    assert a["client_master_name"] == "A \"q\"\n" and [f["id"] for f in a["client_source_folders"]] == ["d1", "d2"]
    assert {t["source_file_id"] for t in a["processing_tasks"]} == {f"f{i}" for i in range(7)}
    assert [t["task_type"] for t in a["processing_tasks"]].count("IGNORE") == 1
    plans = a["concatenation_plan"]
    assert {f: [(b["batch_id"], [t["source_file_id"] for t in b["source_tasks"]]) for b in plans[f]] for f in plans} == {
        "pdf": [("b-pdf-0", ["f0", "f2"]), ("b-pdf-1", ["f6"])], "txt": [("b-txt-0", ["f1", "f3"]), ("b-txt-2", ["f5"])]}
    assert plans["pdf"][0]["total_size_mb"] == round(2 * 10**6 / 2**20, 2)
    assert docs["B"]["concatenation_plan"] == {} and docs["B"]["processing_tasks"][0]["source_file_path"] is None
    assert docs["C"]["client_source_folders"] == [{"id": "d3", "name": None, "path": "R/three"}] and docs["C"]["processing_tasks"] == []
    assert PD.read_tasks(parts).count() == 8 and PD.read_folders(parts).count() == 3 and PD.read_batches(parts).count() == 6


def below(path):
    path = path.removeprefix("file:")
    return {os.path.relpath(os.path.join(d, f), path): open(os.path.join(d, f)).read() for d, _, names in os.walk(path) for f in names if not f.endswith(".crc")}


def test_named_files_hold_their_pieces_in_order(spark):
    path = scratch_dir(spark, "named")
    rows = [(f"c{i % 3}/out_{i % 7}.txt", i, f"piece {i} é\n") for i in range(200)] + [("c9/empty.txt", 0, None)]
    df = spark.createDataFrame(rows, "name string, pos int, piece string").repartition(6)
    FL.write_named_files(df, path, "name", ["pos"])
    want = {}
    for name, _, piece in sorted(rows, key=lambda r: (r[0], r[1])):
        want[name] = want.get(name, "") + (piece or "")
    assert below(path) == want
    FL.write_named_files(spark.createDataFrame([("c0/out_0.txt", 0, "new")], "name string, pos int, piece string"), path, "name", ["pos"])
    assert below(path) == {**want, "c0/out_0.txt": "new"}


def test_a_failed_write_leaves_no_files(spark):
    path = scratch_dir(spark, "named")
    bad = F.when(F.col("id") == 77, F.raise_error(F.lit("broken"))).otherwise(F.col("id").cast("string"))
    df = spark.range(100).select(F.concat(F.lit("f"), F.col("id") % 5).alias("name"), F.col("id").alias("pos"), bad.alias("piece"))
    with pytest.raises(Exception):
        FL.write_named_files(df, path, "name", ["pos"])
    assert below(path) == {} if os.path.exists(path.removeprefix("file:")) else True


def test_a_task_of_named_files_tells_the_driver_one_folder(spark, tmp_path):
    """What a writing task sends back does not grow with its files; the moves bring them to their names."""
    import pickle

    def sent(n, work):
        writer = FL.NamedFiles({"path": str(tmp_path), "work": work}).writer(None, False)
        return writer, writer.write({"target": f"c{i}/a long name of file {i}.txt", "piece": "x"} for i in range(n))

    sizes = [len(pickle.dumps(sent(n, f"_work-{n}")[1])) for n in (1, 500)]
    assert sizes[0] == sizes[1]
    writer, message = sent(300, "_work-a")
    writer.commit([message, None])
    FL._move_files(spark, str(tmp_path), "_work-a")
    assert sum(name.startswith("c") for name in below(str(tmp_path))) == 300
    writer, twice = sent(3, "_work-b")
    writer.commit([twice, sent(1, "_work-b")[1]])
    with pytest.raises(ValueError):
        FL._move_files(spark, str(tmp_path), "_work-b")


def test_pages_are_read_from_a_token(spark):
    path, ckpt, out = (scratch_dir(spark, n) for n in ("pages", "ckpt", "out"))
    change = "token long, seq long, change_type string, file_id string, removed boolean, parent_id string, name string, mime_type string, size long"
    rows = [(t, 10 * t + k, "file", f"f{k}", k == 2, None, f"n{t}", None, t) for t in (1, 2, 3) for k in range(3)]
    assert FL.newest_token(path) == 0
    FL.land_pages(spark.createDataFrame(rows, change), path)
    assert FL.page_tokens(path) == [1, 2, 3]

    def run(start):
        q = FL.read_pages(spark, path, start).writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt) \
            .trigger(availableNow=True).start()
        q.awaitTermination()
        return sorted((r.token, r.seq, r.removed, r.size) for r in spark.read.parquet(out).collect())

    assert run(1) == [(t, 10 * t + k, k == 2, t) for t in (2, 3) for k in range(3)]
    FL.land_pages(spark.createDataFrame([(4, 41, "file", "x", False, None, "n", None, None)], change), path, mode="append")
    assert run(1)[-1] == (4, 41, False, None) and len(run(1)) == 7


def test_matching_generations_hold_together(spark):
    base = scratch_dir(spark, "matching")
    names = spark.createDataFrame([("a", "A")], MJ.NAME_MAP)
    matches = spark.createDataFrame([("A", "f", "F", "R/F")], MJ.MATCHES)
    rows = spark.createDataFrame([(0, {"x": "1"})], MJ.REPORT_ROWS)
    assert MJ.save_results(base, names, matches, rows) == 1
    assert MJ.save_results(base, names, matches.limit(0)) == 2
    got = MJ.read_results(spark, base)
    assert got[0].count() == 1 and got[1].count() == 0 and MJ.read_part(spark, base, "rows").count() == 0
    names.write.parquet(f"{base}/names/gen=9")  # a generation without a state does not count
    assert MJ.read_results(spark, base)[1].count() == 0
    assert MJ.save_results(base, names, matches) == 10


def test_union_keeps_the_old_matches(spark):
    old, new = (spark.createDataFrame(r, "k string, v string") for r in ([("a", "1"), ("b", "2")], [("a", "3"), ("a", "1")]))
    assert sorted(map(tuple, M.incremental_merge(old, new, "k", on_conflict="union").collect())) == [("a", "1"), ("a", "3"), ("b", "2")]
    assert sorted(map(tuple, M.incremental_merge(old, new, "k").collect())) == [("a", "1"), ("a", "3"), ("b", "2")]
    with pytest.raises(ValueError):
        M.incremental_merge(old, new, "k", on_conflict="else")


def test_answers_must_be_strict_json(spark):
    fence = "```json\n%s\n```"
    rows = [(0, fence % "{'consolidation_map': {'a': 'A'}}"), (1, fence % '{"consolidation_map": {"a": "A"}, "match_map": ["x"]}'),
            (2, fence % '{"consolidation_map": {"a": "A"}, "match_map": null}'), (3, fence % '{"match_map": {"A": ["x"]}}')]
    parsed = M.parse_responses(spark.createDataFrame(rows, "batch_no int, response string"))
    assert {r.batch_no for r in parsed.where("ok").collect()} == {2, 3}


def test_only_differing_buckets_are_joined(spark):
    before = spark.range(5000).selectExpr("concat('c', id % 3) client", "concat('f', id) id", "concat('n', id) name", "id size")
    after = before.where("id <> 'f17'").unionByName(spark.createDataFrame([("c1", "new", "n", 5)], "client string, id string, name string, size long"))
    renamed = before.withColumn("name", F.when(F.col("id") == "f30", F.lit("other")).when(F.col("id") == "f31", F.lit(None)).otherwise(F.col("name")))
    clients = before.select("client").distinct()
    digest = SN.member_digests(before, n_buckets=16)
    assert SN.differing_buckets(SN.member_digests(after, n_buckets=16), digest).count() in (1, 2)
    changed = lambda *a, **k: sorted(r.client for r in SN.changed_clients_by_digest(*a, **k).collect())
    assert changed(after, before, clients) == sorted(r.client for r in SN.changed_clients(after, before, clients).collect()) == ["c1", "c2"]
    assert changed(renamed, before, clients) == [] and changed(renamed, before, clients, ("id", "name")) == ["c0", "c1"]
    assert changed(after, before, clients, prev_digests=SN.member_digests(before)) == ["c1", "c2"]
    assert changed(before.unionByName(before.limit(10)), before, clients) == []  # repeats don't change a set


def test_deltas_carry_memberships(spark):
    folders = spark.createDataFrame([("A", 0, "R/a"), ("B", 0, "R/b")], "client string, pos int, folder_path string")
    before = spark.createDataFrame([("1", "R/a/1"), ("2", "R/a/2"), ("3", "R/x/3"), ("4", "R/b/4")], "id string, path string")
    after = spark.createDataFrame([("1", "R/b/1"), ("2", "R/a/other"), ("3", "R/a/3"), ("5", "R/b/5")], "id string, path string")
    deltas = SN.member_deltas(*SN.changed_rows(before, after), folders)
    assert sorted(map(tuple, deltas.collect())) == [("A", "1", -1), ("A", "3", 1), ("B", "1", 1), ("B", "4", -1), ("B", "5", 1)]
    counts = spark.createDataFrame([("A", "1", 1), ("A", "2", 1), ("B", "4", 1)], "client string, id string, n long")
    assert sorted(map(tuple, SN.apply_member_deltas(counts, deltas).collect())) == [("A", "2", 1), ("A", "3", 1), ("B", "1", 1), ("B", "5", 1)]


def test_changes_during_a_scan_are_applied_once(spark):
    import datetime as dt

    from foliant.plans import listener as LS
    from foliant.session import FOLDER_MIME
    from foliant.streaming import changefeed as CF
    pages, base = scratch_dir(spark, "pages"), scratch_dir(spark, "store")
    change = "token long, seq long, change_type string, file_id string, removed boolean, parent_id string, name string, mime_type string, size long"

    def land(token, *rows, mode="append"):
        FL.land_pages(spark.createDataFrame([(token, 10 * token + k, "file", *r) for k, r in enumerate(rows)], change), pages, mode=mode)

    land(1, ("a", False, "root", "a", "text/plain", 1), mode="overwrite")

    def listing():  # page 2 lands while the scan runs, and the scan sees it
        land(2, ("b", False, "root", "b", "text/plain", 2), ("gone", True, None, None, None, None))
        return spark.createDataFrame([("root", None, "ROOT", FOLDER_MIME, None), ("a", "root", "a", "text/plain", 1), ("b", "root", "b", "text/plain", 2)],
                                     "id string, parent_id string, name string, mime_type string, size long")

    now = dt.datetime(2024, 5, 1, 12)
    store = CF.InventoryStore(spark, base)
    assert LS.scan_to_store(spark, listing, pages, store, "root", now) == 1 and store.state()["start_token"] == 1
    land(3, ("b", False, "root", "b2", "text/plain", 3), ("c", False, "root", "c", "text/plain", 4))
    ckpt = scratch_dir(spark, "ckpt")
    CF.run_page_stream(spark, pages, store, ckpt, "root", "ROOT")
    assert sorted(r.path for r in store.read("inventory").collect()) == ["ROOT", "ROOT/a", "ROOT/b2", "ROOT/c"]
    polls = store.state()["n_polls"]
    CF.run_page_stream(spark, pages, store, ckpt, "root", "ROOT")  # nothing new
    assert (polls, store.state()["n_polls"]) == (2, 2)
    LS.record_report(store, now)
    decided = LS.poll_decision(store.read("state"), now, now + dt.timedelta(hours=7)).first()
    assert (decided.report_changed, decided.rescan_due) == (False, True)
    assert not LS.poll_decision(store.read("state"), now, now + dt.timedelta(hours=5)).first().rescan_due
