"""Hand-derived micro-cases (see FIXTURES.md section 4)."""


from foliant.functions import classify_task, mb_rounded, sanitize_name
from foliant.operators import assembly as A
from foliant.operators import changes as CH
from foliant.operators import matching as M
from foliant.operators import packing as P
from foliant.operators import plandiff as D
from foliant.operators.hierarchy import client_tree_lines, render_tree_text, tree_paths
from foliant.operators.prefix import prefix_members

TASK = "client string, file_id string, file_name string, size long, task_type string, output_format string"
FOLDER = "application/vnd.google-apps.folder"


def _tasks(spark, rows):
    return spark.createDataFrame([("X", fid, fid, size, tt, fmt) for fid, size, tt, fmt in rows], TASK)


def _batches(items):
    out = {}
    for r in items.orderBy("batch_pos", "item_pos").collect():
        out.setdefault(r.batch_id, []).append(r.file_id)
    return out


def test_pack_least_loaded(spark):
    t = _tasks(spark, [("a", 60, "DIRECT_INCLUDE", "pdf"), ("b", 50, "DIRECT_INCLUDE", "pdf"),
                       ("c", 30, "DIRECT_INCLUDE", "pdf")])
    assert _batches(P.pack_batches(t, limit=100)) == {"pdf_batch_1": ["a"], "pdf_batch_2": ["b", "c"]}


def test_pack_oversize_alone(spark):
    t = _tasks(spark, [(f, s, "DIRECT_INCLUDE", "pdf") for f, s in
                       [("f", 120), ("a", 70), ("b", 50), ("c", 40), ("d", 30), ("e", 20)]])
    assert _batches(P.pack_batches(t, limit=100)) == {
        "pdf_batch_1": ["f"], "pdf_batch_2": ["a", "d"], "pdf_batch_3": ["b", "c"], "pdf_batch_4": ["e"]}


def _history(spark):
    old_tasks = _tasks(spark, [("a", 60, "DIRECT_INCLUDE", "pdf"), ("b", 30, "DIRECT_INCLUDE", "pdf"),
                               ("c", 50, "DIRECT_INCLUDE", "pdf"), ("d", 40, "DIRECT_INCLUDE", "pdf"),
                               ("z", 10, "IGNORE", "none")])
    old_items = spark.createDataFrame(
        [("X", "pdf", 0, "pdf_batch_1", 0, "a", 60), ("X", "pdf", 0, "pdf_batch_1", 1, "b", 30),
         ("X", "pdf", 1, "pdf_batch_2", 0, "c", 50), ("X", "pdf", 2, "pdf_batch_3", 0, "d", 40)],
        "client string, fmt string, batch_pos long, batch_id string, item_pos long, file_id string, size long")
    new_tasks = _tasks(spark, [("a", 60, "DIRECT_INCLUDE", "pdf"), ("b", 50, "DIRECT_INCLUDE", "pdf"),
                               ("d", 40, "DIRECT_INCLUDE", "pdf"), ("e", 55, "DIRECT_INCLUDE", "pdf"),
                               ("z", 10, "DIRECT_INCLUDE", "pdf")])
    return old_tasks, old_items, new_tasks


def test_repack_strict_loses_reactivated(spark):
    old_tasks, old_items, new_tasks = _history(spark)
    items = P.repack_batches(new_tasks, old_items, old_tasks, limit=100, place_reactivated=False)
    assert _batches(items) == {"pdf_batch_3": ["d", "a"], "pdf_batch_2": ["e"], "pdf_batch_4": ["b"]}
    names = {r.batch_id: r.output_name for r in D.output_names(items).collect()}
    assert names == {"pdf_batch_3": "X_batch_1.pdf", "pdf_batch_2": "X_batch_2.pdf", "pdf_batch_4": "X_batch_3.pdf"}


def test_repack_places_reactivated(spark):
    old_tasks, old_items, new_tasks = _history(spark)
    items = P.repack_batches(new_tasks, old_items, old_tasks, limit=100)
    assert _batches(items) == {"pdf_batch_3": ["d", "a"], "pdf_batch_2": ["e"], "pdf_batch_4": ["b", "z"]}


def test_plan_diff_lines(spark):
    old_tasks, old_items, new_tasks = _history(spark)
    items = P.repack_batches(new_tasks, old_items, old_tasks, limit=100, place_reactivated=False)
    diff = {r.file_id: (r.op, r.old_batch, r.new_batch)
            for r in D.plan_diff(old_items, old_tasks, items, new_tasks).collect()}
    assert diff == {"a": ("MOVED", "pdf_batch_1", "pdf_batch_3"), "b": ("MOVED", "pdf_batch_1", "pdf_batch_4"),
                    "c": ("REMOVED", "pdf_batch_2", None), "e": ("ADDED", None, "pdf_batch_2")}
    text = D.render_diff_text(D.plan_diff_lines(D.plan_diff(old_items, old_tasks, items, new_tasks), "T")) \
        .collect()[0].diff_text
    assert text.startswith("Cumulative plan changes for client: X at T\n\n")
    assert "MOVED: 'a' (ID: a) moved from pdf_batch_1 to pdf_batch_3." in text
    assert "REMOVED: 'c' (ID: c) was removed from pdf_batch_2." in text


def test_diff_of_identical_plans_is_empty(spark):
    old_tasks, old_items, _ = _history(spark)
    assert D.plan_diff(old_items, old_tasks, old_items, old_tasks).count() == 0


def test_mb_rounding_half_even(spark):
    r = spark.createDataFrame([(131072,), (393216,)], "b long").select(mb_rounded("b").alias("mb")).collect()
    assert [x.mb for x in r] == [0.12, 0.38]


def test_tree_listing(spark):
    nodes = spark.createDataFrame([
        ("root", None, "ROOT", FOLDER), ("A", "root", "A", FOLDER), ("acme", "A", "ACME", FOLDER),
        ("sub", "acme", "sub", FOLDER), ("y", "sub", "y", "text/plain"), ("x", "acme", "x.pdf", "application/pdf"),
    ], "id string, parent_id string, name string, mime_type string")
    inv = tree_paths(nodes, "root")
    cf = spark.createDataFrame([("ACME", 0, "ACME", "ROOT/A/ACME")],
                               "client string, pos int, folder_name string, folder_path string")
    members = prefix_members(inv, cf, ["client", "pos"])
    text = render_tree_text(client_tree_lines(cf, members)).collect()[0].tree_text
    assert text == ("File tree for: ACME\n===================\n\n--- Source Folder: ACME ---\n"
                    "ACME\nsub\n|- y\nx.pdf\n")


def test_change_replay(spark):
    nodes = spark.createDataFrame([("root", None, "ROOT", FOLDER, None), ("a", "root", "a", "text/plain", 1),
                                   ("b", "root", "b", "text/plain", 2)], "id string, parent_id string, name string, mime_type string, size long")
    inv = tree_paths(nodes, "root").select(*CH.INVENTORY_COLS)
    ch = spark.createDataFrame([
        (1, "file", "c", False, "root", "c", "text/plain", 3), (2, "file", "a", True, None, None, None, None),
        (3, "file", "a", True, None, None, None, None), (4, "file", "a", False, "root", "a", "text/plain", 1)],
        "seq long, change_type string, file_id string, removed boolean, parent_id string, name string, mime_type string, size long")
    new, _, rescanned = CH.apply_changes(inv, nodes, ch, "root", "ROOT")
    assert not rescanned
    rows = {r.id: (r.path, r.indent) for r in new.collect()}
    assert set(rows) == {"root", "a", "b", "c"} and rows["a"] == ("ROOT/a", 0)
    drive = ch.unionByName(spark.createDataFrame([(5, "drive", None, False, None, None, None, None)], ch.schema))
    assert CH.apply_changes(inv, nodes, drive, "root", "ROOT")[2]
    no_parent = spark.createDataFrame([(6, "file", "q", False, None, "q", "text/plain", 1)], ch.schema)
    assert CH.apply_changes(inv, nodes, no_parent, "root", "ROOT")[2]


def test_patch_twice_equals_once(spark):
    nodes = spark.createDataFrame([("root", None, "ROOT", FOLDER, None), ("a", "root", "a", "text/plain", 1)],
                                  "id string, parent_id string, name string, mime_type string, size long")
    inv = tree_paths(nodes, "root").select(*CH.INVENTORY_COLS)
    ch = spark.createDataFrame([(1, "file", "c", False, "root", "c", "text/plain", 3)],
                               "seq long, change_type string, file_id string, removed boolean, parent_id string, name string, mime_type string, size long")
    once, live, _ = CH.apply_changes(inv, nodes, ch, "root", "ROOT")
    twice, _, _ = CH.apply_changes(once, live, ch, "root", "ROOT")
    assert sorted(once.collect()) == sorted(twice.collect())


def test_rollup_and_last_wins(spark):
    folders = spark.createDataFrame([
        ("g", "GRUPO G", "R/S/GRUPO G", None, ("R/S/GRUPO G", 0, "R/S/GRUPO G")),
        ("j", "G JP", "R/S/GRUPO G/G JP", "GRUPO G", ("R/S/GRUPO G", 1, "R/S/GRUPO G/G JP")),
        ("r", "G RIO", "R/S/GRUPO G/G RIO", "GRUPO G", ("R/S/GRUPO G", 1, "R/S/GRUPO G/G RIO")),
        ("s", "Solo", "R/S/Solo", None, ("R/S/Solo", 0, "R/S/Solo"))],
        "id string, name string, path string, group_name string, sort_key struct<a:string,b:int,c:string>")
    entries = spark.createDataFrame([("M", n) for n in ["G JP", "G RIO", "Solo", "Nope"]],
                                    "master string, folder_name string")
    resolved = M.resolve_folders(M.rollup_to_group(entries, folders), folders)
    assert sorted(r.folder_name for r in resolved.collect()) == ["GRUPO G", "Solo"]
    old = spark.createDataFrame([("M", "f1"), ("N", "f2")], "client string, folder string")
    new = spark.createDataFrame([], "client string, folder string")
    keys = spark.createDataFrame([("M",)], "client string")
    merged = M.incremental_merge(old, new, "client", keys)
    assert sorted(tuple(r) for r in merged.collect()) == [("N", "f2")]


def test_concat_text_frame(spark):
    contents = spark.createDataFrame([("X", "txt", 0, "txt_batch_1", 0, "n", "n.txt", "hi")],
                                     "client string, fmt string, batch_pos long, batch_id string, item_pos long, file_id string, file_name string, text string")
    names = spark.createDataFrame([("X", "txt", "txt_batch_1", "X_batch_1.txt")],
                                  "client string, fmt string, batch_id string, output_name string")
    out = A.concat_texts(contents, names).collect()[0]
    assert out.text == "\n--- START OF n.txt ---\nhi\n--- END OF n.txt ---\n\n"


def test_mime_rules(spark):
    mimes = ["application/pdf", "text/plain", "text/markdown", "audio/mpeg",
             "application/vnd.google-apps.document", "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
             "application/vnd.google-apps.spreadsheet", "image/png", "image/svg+xml", "application/msword", None]
    df = spark.createDataFrame([(m,) for m in mimes], "mime_type string")
    got = [(r.k.task_type, r.k.output_format) for r in df.select(classify_task("mime_type").alias("k")).collect()]
    assert got == [("DIRECT_INCLUDE", "pdf"), ("DIRECT_INCLUDE", "txt"), ("DIRECT_INCLUDE", "txt"),
                   ("DIRECT_INCLUDE", "mp3"), ("CONVERT", "txt"), ("CONVERT", "txt"), ("CONVERT", "txt"),
                   ("OCR", "pdf"), ("OCR", "pdf"), ("IGNORE", "none"), ("IGNORE", "none")]


def test_sanitize_name(spark):
    r = spark.createDataFrame([("Ação & Cia. Ltda_  ",)], "n string").select(sanitize_name("n").alias("s")).collect()
    assert r[0].s == "Ação  Cia Ltda_"


def test_parse_responses(spark):
    df = spark.createDataFrame([
        (0, 'x ```json\n{"consolidation_map": {"a": "M"}, "match_map": {"M": ["f1", "f2"]}}\n``` y'),
        (1, "no json here"), (2, "```json\n{not json\n```")], "batch_no int, response string")
    p = M.parse_responses(df)
    assert {r.batch_no: r.ok for r in p.collect()} == {0: True, 1: False, 2: False}
    assert [tuple(r) for r in M.match_entries(p).orderBy("pos").collect()] == [(0, "M", 0, "f1"), (0, "M", 1, "f2")]


def test_name_batches_positions(spark):
    names = spark.createDataFrame([(f"n{i:03d}", i) for i in range(250)], "name string, ord long")
    b = M.name_batches(names, size=100)
    rows = sorted((r.idx, r.batch_no, r.name) for r in b.collect())
    assert [r[0] for r in rows] == list(range(250))
    assert [r[1] for r in rows] == [i // 100 for i in range(250)]
    assert rows[0][2] == "n000" and rows[-1][2] == "n249"


def test_deterministic_matcher(spark):
    names = M.normalize_names(spark.createDataFrame(
        [("ACME Ltda.",), ("Açaí S A",), ("Beta Corp",), ("acme",), ("Zeta Nine",)], "name string"), "name")
    assert {r.name: r.norm for r in names.collect()} == {
        "ACME Ltda.": "ACME", "Açaí S A": "ACAI", "Beta Corp": "BETA", "acme": "ACME", "Zeta Nine": "ZETA NINE"}
    folders = M.normalize_names(spark.createDataFrame(
        [("f1", "GRUPO ACME", "R/S/GRUPO ACME"), ("f2", "ACAI", "R/S/ACAI"), ("f3", "Omega", "R/S/Omega")],
        "folder_id string, folder_name string, folder_path string"), "folder_name")
    best = {(r.name, r.folder_id) for r in M.match_best(M.match_pairs(names, folders)).collect()}
    assert best == {("ACME Ltda.", "f1"), ("acme", "f1"), ("Açaí S A", "f2")}
    masters = {r.name: r.master for r in M.consolidate_names(names).collect()}
    assert masters["ACME Ltda."] == masters["acme"] == "ACME"
    assert masters["Zeta Nine"] == "ZETA NINE"


def test_upward_paths_with_missing_ancestor(spark):
    from foliant.operators.hierarchy import resolve_changed_paths
    nodes = spark.createDataFrame([
        ("root", None, "ROOT"), ("d", "root", "docs"), ("x", "d", "x.pdf"), ("y", "gone", "y.pdf"),
        ("z", None, "z.pdf")], "id string, parent_id string, name string")
    ids = spark.createDataFrame([("x",), ("y",), ("z",), ("nope",)], "id string")
    got = {r.id: r.path for r in resolve_changed_paths(ids, nodes, "root", "ROOT").collect()}
    assert got == {"x": "ROOT/docs/x.pdf", "y": "ROOT/Unknown/y.pdf", "z": "ROOT/z.pdf", "nope": "ROOT/Unknown"}


def test_report_needs_a_fourth_column(spark):
    narrow = spark.createDataFrame([("1", "a", "b")], "r string, s string, c string")
    assert M.report_clients(narrow, "r").count() == 0
    wide = spark.createDataFrame([("1", "a", "b", "  ACME "), ("2", "a", "b", ""), ("3", "a", "b", "ACME")],
                                 "r string, s string, c string, client string")
    assert [(x.name, x.ord) for x in M.report_clients(wide, "r").collect()] == [("ACME", 1)]
