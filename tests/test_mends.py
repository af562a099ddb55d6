"""Cases that the fixture tables do not reach."""

import pytest

from foliant import session
from foliant.operators import assembly as A
from foliant.operators import changes as CH
from foliant.operators import matching as M
from foliant.operators.components import connected_components
from foliant.operators.hierarchy import TreeDepthError, resolve_changed_paths, tree_paths
from foliant.operators.positional import with_global_index
from foliant.plans.processor import process_all, read_outputs
from foliant.session import FOLDER_MIME, scratch_dir, single_jvm
from foliant.streaming import changefeed as CF

NODE = "id string, parent_id string, name string, mime_type string, size long"


def chain(n):
    return [("root", None, "ROOT", FOLDER_MIME, None)] + [
        (f"d{i}", "root" if i == 0 else f"d{i - 1}", f"n{i}", FOLDER_MIME, None) for i in range(n)]


def test_edit_similar_names_are_found_without_a_common_token(spark):
    names = ["ACME BRASIL COMERCIO", "ACMEE BRASIL COMERCIO", "INDUSTRIAS", "INDUSTRIA", "ME", "Grupo S/A", "\u65e5\u672c\u96fb\u6c17", "OTHER"]
    df = M.normalize_names(spark.createDataFrame([(n,) for n in names], "name string"), "name")
    got = {r.name: r.master for r in M.consolidate_names(df).collect()}
    assert set(got) == set(names)
    assert got["ACMEE BRASIL COMERCIO"] == got["ACME BRASIL COMERCIO"] and got["INDUSTRIAS"] == got["INDUSTRIA"] == "INDUSTRIA"
    assert got["ME"] == "ME" and got["OTHER"] == "OTHER"


def test_long_chain_of_names(spark):
    edges = spark.createDataFrame([(f"k{i:04d}", f"k{i + 1:04d}") for i in range(300)], "u string, v string")
    got = connected_components(edges).collect()
    assert len(got) == 301 and {r.component for r in got} == {"k0000"}


def test_component_rounds_by_shuffle_equal_those_in_one_task(spark, monkeypatch):
    import random

    from foliant.operators import components
    rng = random.Random(5)
    edges = spark.createDataFrame([(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(None, 1), (4, 4)], "u long, v long")
    small = sorted(map(tuple, connected_components(edges).collect()))
    monkeypatch.setattr(components, "SMALL", 0)
    assert sorted(map(tuple, connected_components(edges).collect())) == small


def test_deep_tree_and_cycles(spark):
    nodes = spark.createDataFrame(chain(110), NODE).coalesce(1)
    deepest = tree_paths(nodes, "root", checkpoint_every=20).where("id = 'd109'").collect()[0]
    assert deepest.indent == 109 and deepest.path.count("/") == 110
    ids = spark.createDataFrame([("d20",)], "id string").coalesce(1)
    assert resolve_changed_paths(ids, nodes, "root").collect()[0].path.count("/") == 21
    loop = spark.createDataFrame([("a", "b", "a", FOLDER_MIME, None), ("b", "c", "b", FOLDER_MIME, None), ("c", "a", "c", FOLDER_MIME, None)], NODE)
    with pytest.raises(TreeDepthError):
        resolve_changed_paths(spark.createDataFrame([("a",)], "id string"), loop, "root")


def test_empty_answer_lists_and_trailing_text(spark):
    fence = "```json\n%s\n```"
    rows = [(0, fence % '{"consolidation_map": {"a": "A"}, "match_map": {"A": []}}'),
            (1, fence % '{"consolidation_map": {"b": "B"}, "match_map": {}} trailing'), (2, fence % "5"), (3, "no block"), (4, None)]
    answers = spark.createDataFrame(rows, "batch_no int, response string")
    parsed = M.parse_responses(answers)
    assert {r.batch_no for r in parsed.where("ok").collect()} == {0}
    assert [r.master for r in M.match_masters(parsed).collect()] == ["A"] and M.match_entries(parsed).count() == 0
    assert {r.batch_no for r in M.rejected_responses(answers).collect()} == {1, 2, 3, 4}


def test_missing_change_types_and_replays(spark):
    change = "seq long, change_type string, file_id string, removed boolean, parent_id string, name string, mime_type string, size long, batch_day date"
    import datetime as dt
    day = dt.date(2024, 1, 1)
    first = spark.createDataFrame([(1, None, "f", False, "root", "one", "text/plain", 1, day)], change)
    assert CH.latest_changes(first).count() == 1
    nodes = spark.createDataFrame([("root", None, "ROOT", FOLDER_MIME, None)], NODE)
    store = CF.InventoryStore(spark, scratch_dir(spark, "store3"))
    CF.init_store(store, tree_paths(nodes, "root"), nodes)
    apply = CF.make_batch_writer(store, "root", "ROOT")
    apply(first, 5)
    apply(first, 5)
    assert store.state()["n_polls"] == 1
    apply(spark.createDataFrame([(2, "file", "g", False, "root", "two", "text/plain", 1, day)], change), 0)  # a new checkpoint
    assert {r.id for r in store.read("inventory").collect()} == {"root", "f", "g"}


def test_vanished_outputs_are_removed(spark):
    out = scratch_dir(spark, "outputs2")
    item = "client string, fmt string, batch_id string, batch_pos int, item_pos int, file_id string"
    task = "client string, file_id string, file_name string, file_path string, drive_link string, task_type string"

    def run(members, clients):
        items = spark.createDataFrame([(c, "txt", f"b{b}", b, k, f) for c, b, k, f in members], item)
        tasks = spark.createDataFrame([(c, f, f, f"p/{f}", "l", "CONVERT") for c, b, k, f in members], task)
        texts = spark.createDataFrame([(f, f"text {f}") for _, _, _, f in members], "file_id string, text string")
        process_all(spark, items, tasks, texts, out, clients=spark.createDataFrame([(c,) for c in clients], "client string"))
        return {(r.client, r.output_name): r.text for r in read_outputs(spark, out).collect()}

    assert len(run([("X", 0, 0, "a"), ("X", 1, 0, "b"), ("Y 1", 0, 0, "c"), ("Z", 0, 0, "z")], ["X", "Y 1", "Z"])) == 4
    got = run([("X", 0, 0, "b"), ("X", 0, 1, "a")], ["X", "Y 1"])
    assert sorted(got) == [("X", "X_batch_1.txt"), ("Z", "Z_batch_1.txt")]
    assert got["X", "X_batch_1.txt"].index("text b") < got["X", "X_batch_1.txt"].index("text a")


def test_index_counts_every_row_once(spark):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = with_global_index(spark.range(200_000).selectExpr("hash(id) a", "id"), ["a", "id"])
        assert got.selectExpr("count(distinct idx) n", "max(idx) m").first() == (200_000, 199_999)
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_lenient_decode_passes_only_bad_rows(spark):
    df = spark.createDataFrame([(b"ok \xc3\xa9",), (b"bad \xff tail",), (None,)], "content binary")
    assert [r[0] for r in df.select(A.decode_lenient("content")).collect()] == ["ok \u00e9", "bad  tail", None]


def test_strip_takes_off_unicode_space(spark):
    from foliant.functions import strip_all
    texts = [" \u00a0ACME\u3000\t", "\x1cA B\x85", "\u200bkept", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(strip_all("t")).collect()] == [t.strip() for t in texts]


def test_stages_are_released_and_need_a_shared_folder(spark):
    before = session.open_stages()
    df = session.materialize(spark.range(3))
    assert len(session.open_stages()) == len(before) + 1
    session.release(df)
    assert session.open_stages() == before
    assert single_jvm("local[4]") and single_jvm("local") and not single_jvm("local-cluster[3,2,1024]") and not single_jvm("yarn")


def test_matcher_job(spark):
    from foliant.plans import matcher as MJ
    report = spark.createDataFrame([(0, "a", "b", "ACME LTDA"), (1, "a", "b", "ACMEE"), (2, "a", "b", "Known"), (3, "a", "b", "Nobody at all")],
                                   "ord int, x string, y string, client string")
    folders = spark.createDataFrame([("f1", "ACME", "R/ACME", None), ("f2", "OTHER", "R/OTHER", None)],
                                    "id string, name string, path string, group_name string") \
        .selectExpr("*", "named_struct('a', path, 'b', 0, 'c', path) as sort_key")
    old_names = spark.createDataFrame([("Known", "K")], MJ.NAME_MAP)
    old = spark.createDataFrame([("K", "f2", "OTHER", "R/OTHER"), ("ACME", "f2", "OTHER", "R/OTHER")], MJ.MATCHES)
    got = MJ.match_report(report, "ord", folders, old_names, old)
    base = scratch_dir(spark, "match-results")
    MJ.save_results(base, got.names, got.matches)
    names, matches = MJ.read_results(spark, base)
    assert {(r.raw_name, r.master) for r in names.collect()} == {("Known", "K"), ("ACME LTDA", "ACME"), ("ACMEE", "ACMEE"),
                                                                 ("Nobody at all", "NOBODY AT ALL")}
    assert {(r.client, r.folder_id) for r in matches.collect()} == {("K", "f2"), ("ACME", "f1")}


def test_cascade_follows_changed_and_removed_folders(spark):
    change = "seq long, change_type string, file_id string, removed boolean, parent_id string, name string, mime_type string, size long"
    nodes = spark.createDataFrame([("root", None, "ROOT", FOLDER_MIME, None), ("f", "root", "F", FOLDER_MIME, None), ("x", "f", "x", "text/plain", 1),
                                   ("g", "root", "G", FOLDER_MIME, None), ("y", "g", "y", "text/plain", 1)], NODE)
    changes = spark.createDataFrame([(1, "file", "f", True, None, None, None, None), (2, "file", "g", False, "root", "H", FOLDER_MIME, None)], change)
    got, _, _ = CH.apply_changes(tree_paths(nodes, "root"), nodes, changes, "root", "ROOT", cascade=True)
    assert {r.path for r in got.collect()} == {"ROOT", "ROOT/H", "ROOT/H/y"}
