"""Hierarchy operators: paths from a parent/child catalog, children, tree listings.

Scale notes
-----------
``tree_paths`` walks *folders only*, one level per iteration (a frontier
join), and then attaches every item to its resolved parent folder with one
equi-join. Folders are a small share of an inventory, so the per-level joins
stay small; the single big join is on ``parent_id`` and a parent with a huge
number of children is split by AQE's skew-join handling. Each level is written as a
partition of one table of folder paths, so neither lineage nor plan text
grows with depth and a lost executor only recomputes one level.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from foliant.functions import first_parent, path_depth
from foliant.session import DEFAULT_ROOT_NAME, FOLDER_MIME, materialize, release, stage_folder


class TreeDepthError(RuntimeError):
    pass


def with_parent_id(items: DataFrame) -> DataFrame:
    """Add ``parent_id`` = first parent when only ``parents`` is present."""
    if "parent_id" in items.columns:
        return items
    return items.withColumn("parent_id", first_parent("parents"))


def _broadcast_bound(spark) -> int:
    """Largest side (bytes) this module broadcasts: the session's threshold, at
    most 256 MB; none where the session has turned broadcasts off."""
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    try:
        val = int(str(raw).lower().rstrip("b"))
    except ValueError:
        val = 10 * 1024 * 1024
    return -1 if val < 0 else min(val, 256 * 1024 * 1024)


def _write_level(level: DataFrame, path: str) -> tuple[int, int]:
    """Write ``id, path`` of one level; its rows and approximate bytes, measured by the write itself."""
    seen = Observation()
    size = F.octet_length("path") + F.octet_length("id") + F.lit(16)
    level.observe(seen, F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("b")) \
        .write.mode("overwrite").parquet(path)
    return int(seen.get["n"]), int(seen.get["b"])


def tree_paths(nodes: DataFrame, root_id: str,
               checkpoint_every: int | None = None, broadcast_bytes: int | None = None,
               store_result: bool = True, store=materialize) -> DataFrame:
    """Full path and indent of every node reachable from ``root_id``.

    ``nodes`` has at least ``id, parent_id, name, mime_type``; other columns
    are carried through. The root gets ``path = coalesce(name, 'ROOT')`` and
    ``indent = -1``, its children ``indent = 0``; only folders are descended
    into, like a listing scan. Returns the node columns plus ``path, indent``.

    The folders are stored once, and each level of the walk is one job: the
    level above joins the folders and is written as partition ``level=N`` of one
    table, which the next step reads. A level is broadcast into the next join
    only when its measured size (observed by the write) is below the broadcast
    bound; larger levels go through a shuffle join. With ``store_result`` (default)
    the result is written by ``store``, as a stage table, and the folder and level tables are
    removed before returning. There is no bound on the depth: a walk longer than
    the number of folders has met a cycle (ids that repeat with several parents)
    and raises. ``checkpoint_every`` is accepted for old callers and has no effect,
    since every level is written.
    """
    spark = nodes.sparkSession
    bound = broadcast_bytes if broadcast_bytes is not None else _broadcast_bound(spark)
    nodes = with_parent_id(nodes)
    root = nodes.where(F.col("id") == F.lit(root_id))
    folders = materialize(nodes.where((F.col("mime_type") == FOLDER_MIME) & (F.col("id") != F.lit(root_id)))
                          .select("id", "parent_id", "name"))
    levels = stage_folder(spark, "levels")
    first = root.select("id", F.coalesce("name", F.lit(DEFAULT_ROOT_NAME)).alias("path"))
    count, size = _write_level(first, f"{levels.path}/level=-1")
    total, depth, checked = size, -1, 64
    while count > 0:
        parent = spark.read.schema(first.schema).parquet(f"{levels.path}/level={depth}") \
            .select(F.col("id").alias("parent_id"), F.col("path").alias("_pp"))
        if size <= bound:
            parent = F.broadcast(parent)
        step = folders.join(parent, "parent_id").select("id", F.concat("_pp", F.lit("/"), "name").alias("path"))
        depth += 1
        if depth >= checked:
            checked = folders.count() + 1  # the last step finds no folder
            if depth >= checked:
                release(folders, levels)
                raise TreeDepthError(f"a path longer than the {checked - 1} folders: the tree has a cycle")
        count, size = _write_level(step, f"{levels.path}/level={depth}")
        total += size
    parents = spark.read.schema(f"id {first.schema['id'].dataType.simpleString()}, path string, level int").parquet(levels.path) \
        .select(F.col("id").alias("parent_id"), F.col("path").alias("_pp"), F.col("level").alias("_pi"))
    if total <= bound:
        parents = F.broadcast(parents)
    items = nodes.join(parents, "parent_id").withColumn(
        "path", F.concat("_pp", F.lit("/"), "name")).withColumn("indent", F.col("_pi") + 1)
    items = items.drop("_pp", "_pi")
    root_row = root.withColumn("path", F.coalesce("name", F.lit(DEFAULT_ROOT_NAME))) \
        .withColumn("indent", F.lit(-1))
    result = items.unionByName(root_row.select(*items.columns))
    if not store_result:
        return result
    stored = store(result)
    release(folders, levels)
    return stored


def root_name(inventory: DataFrame, root_id: str) -> DataFrame:
    """One row ``root_name``: the root item's name, ``ROOT`` if it is absent."""
    found = inventory.where(F.col("id") == F.lit(root_id)).agg(
        F.max_by("name", "path").alias("name"))
    return found.select(F.coalesce("name", F.lit(DEFAULT_ROOT_NAME)).alias("root_name"))


def children_by_parent(inventory: DataFrame) -> DataFrame:
    """Items keyed by their first parent; items without parents are dropped."""
    inv = with_parent_id(inventory)
    return inv.where(F.col("parent_id").isNotNull())


def split_files_folders(inventory: DataFrame) -> tuple[DataFrame, DataFrame]:
    is_folder = F.col("mime_type") == FOLDER_MIME
    return inventory.where(~is_folder | F.col("mime_type").isNull()), inventory.where(is_folder)


def with_path_depth(inventory: DataFrame, col: str = "path", out: str = "depth") -> DataFrame:
    return inventory.withColumn(out, path_depth(col))


#: Rounds that follow single pointers before pointers are doubled.
CHASE_ROUNDS = 8


def doubled_paths(parents: DataFrame, root_id: str, rounds: int | None = None) -> DataFrame:
    """``id, cur, acc`` of every row of ``parents`` (``id, parent_id, name``; distinct ids) by
    pointer doubling: each round joins the piece of the ancestor that the pointer names and
    takes over its pointer, so a path of ``d`` levels takes about ``log2(d)`` rounds.

    ``acc`` is the path below the root, ``cur`` null; an id whose ancestors come back to where
    they were keeps its pointer. Pieces and pointers are one stage table a round.
    """
    state = materialize(parents.select(
        "id", F.when(F.col("parent_id") != F.lit(root_id), F.col("parent_id")).alias("cur"),
        F.coalesce("name", F.lit("Unknown")).alias("acc")))
    n = state.count()
    left = rounds if rounds is not None else n.bit_length() + 1
    while left > 0 and not state.where("cur is not null").isEmpty():
        left -= 1
        above = state.select(F.col("id").alias("cur"), F.lit(True).alias("_known"), F.col("cur").alias("_next"), F.col("acc").alias("_piece"))
        waiting = state.where("cur is not null").join(above, "cur", "left").select(
            "id", F.col("_next").alias("cur"), F.concat(F.coalesce("_piece", F.lit("Unknown")), F.lit("/"), "acc").alias("acc"))
        following = materialize(state.where("cur is null").unionByName(waiting))
        release(state)
        state = following
    return state


def resolve_changed_paths(changed: DataFrame, nodes: DataFrame, root_id: str, root_label: str | None = None,
                          chase_rounds: int = CHASE_ROUNDS, lookup=None) -> DataFrame:
    """Path of each changed id, resolved upward through the *latest* node table.

    ``changed``: ``id`` (distinct). ``nodes``: ``id, parent_id, name`` of the
    current tree (including the changed rows). Semantics of an upward lookup:
    a missing item, an item without parent or whose parent is the root gets
    ``<root>/<name or Unknown>``; otherwise ``<parent path>/<name or Unknown>``.

    The first ``chase_rounds`` levels follow each changed id's pointer, so the usual
    work is (changed ids) x (depth), not the whole tree. What has not reached the
    root by then takes its path from ``doubled_paths`` over the rows that are parents,
    whose rounds grow with the logarithm of the depth; there is no bound on the
    depth, and a changed id whose ancestors form a cycle raises. ``lookup``, where given,
    returns the node rows of a frame of ids (``id``) in place of ``nodes`` while chasing.
    """
    label = root_label or DEFAULT_ROOT_NAME
    wanted = ["id", "parent_id", "name"]
    rows_of = (lambda ids: lookup(ids).select(*wanted)) if lookup is not None else (lambda ids: nodes.select(*wanted))
    ids = changed.select("id")
    first = ids.join(rows_of(ids), "id", "left")
    # state: id, cur (next ancestor to look up), acc (path piece built so far)
    state = materialize(first.select(
        "id", F.when(F.col("parent_id") != F.lit(root_id), F.col("parent_id")).alias("cur"),
        F.coalesce("name", F.lit("Unknown")).alias("acc")))
    rounds = 0
    while not (waiting := state.where("cur is not null")).isEmpty():
        if rounds == chase_rounds:
            following = _from_doubled(state, nodes, root_id)
        else:
            above = rows_of(waiting.select(F.col("cur").alias("id")).distinct())
            step = waiting.join(above.select(F.col("id").alias("cur"), F.col("parent_id").alias("_pp"), F.col("name").alias("_pn")), "cur", "left")
            # a missing ancestor resolves to <root>/Unknown, like an upward lookup that finds nothing
            step = step.select("id", F.when(F.col("_pp") != F.lit(root_id), F.col("_pp")).alias("cur"),
                               F.concat(F.coalesce("_pn", F.lit("Unknown")), F.lit("/"), "acc").alias("acc"))
            following = materialize(state.where("cur is null").unionByName(step))
        rounds += 1
        release(state)
        state = following
    return state.select("id", F.concat(F.lit(label), F.lit("/"), "acc").alias("path"))


def _from_doubled(state: DataFrame, nodes: DataFrame, root_id: str) -> DataFrame:
    nodes = nodes.select("id", "parent_id", "name")
    parents = nodes.join(nodes.select(F.col("parent_id").alias("id")).unionByName(state.select(F.col("cur").alias("id"))).distinct(),
                         "id", "left_semi")
    paths = doubled_paths(parents, root_id)
    above = paths.select(F.col("id").alias("cur"), F.col("cur").alias("_next"), F.col("acc").alias("_piece"))
    found = materialize(state.join(above, "cur", "left").select(
        "id", "_next", F.when(F.col("cur").isNull(), F.col("acc"))
        .otherwise(F.concat(F.coalesce("_piece", F.lit("Unknown")), F.lit("/"), "acc")).alias("acc")))
    release(paths)
    if not found.where("_next is not null").isEmpty():
        release(found)
        raise TreeDepthError("an ancestor chain comes back to where it was: the tree has a cycle")
    return found.select("id", F.col("_next").alias("cur"), "acc")


def client_tree_lines(client_folders: DataFrame, members: DataFrame) -> DataFrame:
    """Lines of the per-client tree listing, one row per output line.

    ``client_folders``: ``client, pos, folder_name, folder_path`` (list order
    in ``pos``). ``members``: output of the prefix join with ``client, pos,
    folder_path, id, name, path, indent``. A sort key ``(client, section,
    pos, path, id)`` orders the lines; ``section`` 0 is the title block.
    Writing the lines range-partitioned by that key gives each client's text
    file in order without building one string per client.
    """
    cf = client_folders.where(F.col("folder_path").isNotNull() & (F.col("folder_path") != ""))
    clients = cf.select("client").distinct()
    title = F.concat(F.lit("File tree for: "), "client")
    head = clients.select(
        "client", F.lit(0).alias("section"), F.lit(-1).alias("pos"), F.lit(0).alias("ord"),
        F.lit("").alias("path"), F.lit("").alias("id"),
        F.concat(title, F.lit("\n"), F.repeat(F.lit("="), F.length(title)), F.lit("\n")).alias("line"))
    last_pos = client_folders.groupBy("client").agg(F.max("pos").alias("_last"))
    folder_head = cf.select(
        "client", F.lit(1).alias("section"), "pos", F.lit(0).alias("ord"), F.lit("").alias("path"),
        F.lit("").alias("id"),
        F.concat(F.lit("--- Source Folder: "), F.coalesce("folder_name", F.lit("None")),
                 F.lit(" ---")).alias("line"))
    base = F.length("folder_path") - F.length(F.replace("folder_path", F.lit("/"), F.lit("")))
    rel = F.coalesce(F.col("indent"), F.lit(0)) - base
    prefix = F.when(rel > 0, F.concat(F.repeat(F.lit("  "), rel - 1), F.lit("|- "))).otherwise(F.lit(""))
    item_lines = members.select(
        "client", F.lit(1).alias("section"), "pos", F.lit(1).alias("ord"), "path", "id",
        F.concat(prefix, F.coalesce("name", F.lit("Unknown"))).alias("line"))
    # Blank separator after every folder block except the client's last one.
    sep = cf.join(last_pos, "client").where(F.col("pos") < F.col("_last")).select(
        "client", F.lit(1).alias("section"), "pos", F.lit(2).alias("ord"), F.lit("").alias("path"),
        F.lit("").alias("id"), F.lit("").alias("line"))
    return head.unionByName(folder_head).unionByName(item_lines).unionByName(sep)


def render_tree_text(lines: DataFrame) -> DataFrame:
    """Whole tree text per client (small clients / tests): ordered ``listagg``."""
    return lines.groupBy("client").agg(
        F.expr("listagg(concat(line, '\\n'), '') within group "
               "(order by section, pos, ord, path, id)").alias("tree_text"))
