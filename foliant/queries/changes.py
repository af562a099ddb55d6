"""Change feed queries: last change per file, rescan decision, patch, stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliant import fixtures as fx
from foliant.operators import cascade as CC
from foliant.operators import changes as CH
from foliant.operators.hierarchy import resolve_changed_paths
from foliant.operators import snapshots as SN
from foliant.operators.tasks import client_files
from foliant.plans.fixture_runs import client_folders, inventory
from foliant.session import materialize, scratch_dir
from foliant.sources import files as FL
from foliant.streaming import changefeed as CF
from foliant.streaming import statefeed as SF

V = fx.with_views
FOLDER = "'application/vnd.google-apps.folder'"
FILES_PER_TRIGGER = 10


def _base(spark, sf):
    inv = inventory(spark, sf)
    nodes = fx.fx_node(spark, sf).select(*CH.NODE_COLS)
    return inv, nodes


def _patchable(changes):
    """The polls, whole, that need no re-walk."""
    polls = CH.needs_rescan(changes, ["batch_day"]).where(~F.col("needs_rescan")).select("batch_day")
    return changes.join(polls, "batch_day", "left_semi")


def q_latest_changes(spark, sf):
    return CH.latest_changes(fx.fx_change(spark, sf)).select(
        "file_id", "seq", "removed", "parent_id", "name", "size")


def q_dedupe_last(spark, sf):
    inv = inventory(spark, sf)
    return inv.groupBy("name").agg(F.max_by(F.struct("id", "path"), F.struct("path", "id")).alias("w")) \
        .select("name", "w.id", "w.path")


def q_needs_rescan(spark, sf):
    return CH.needs_rescan(fx.fx_change(spark, sf), ["batch_day"])


def q_apply_changes(spark, sf):
    inv, nodes = _base(spark, sf)
    new, _, _ = CH.apply_changes(inv, nodes, fx.fx_change(spark, sf), fx.ROOT_ID, fx.ROOT_NAME)
    return new


def q_apply_changes_patch(spark, sf):
    inv, nodes = _base(spark, sf)
    new, _, rescanned = CH.apply_changes(inv, nodes, _patchable(fx.fx_change(spark, sf)),
                                         fx.ROOT_ID, fx.ROOT_NAME)
    assert not rescanned
    return new


def q_resolve_changed_paths(spark, sf):
    _, nodes = _base(spark, sf)
    last = CH.latest_changes(_patchable(fx.fx_change(spark, sf)))
    live = CH.apply_to_nodes(nodes, last)
    ids = last.where(~F.col("removed")).select(F.col("file_id").alias("id"))
    return resolve_changed_paths(ids, live, fx.ROOT_ID, fx.ROOT_NAME)


def q_replan_from_changes(spark, sf):
    inv, nodes = _base(spark, sf)
    after, _, _ = CH.apply_changes(inv, nodes, fx.fx_change(spark, sf), fx.ROOT_ID, fx.ROOT_NAME)
    after = materialize(after)
    cf = client_folders(inv)
    return CH.replan_from_changes(client_files(inv, cf), client_files(after, cf), cf)


def _landed(spark, sf):
    landing = scratch_dir(spark, "landing")
    CF.land_changes(fx.fx_change(spark, sf), landing)
    return landing


def q_stream_changes(spark, sf):
    landing = _landed(spark, sf)
    out = scratch_dir(spark, "ingested")
    CF.stream_to_table(spark, landing, out, scratch_dir(spark, "ingest-ckpt"))
    return spark.read.parquet(out).select("seq", "batch_day", "change_type", "file_id", "removed",
                                          "parent_id", "name", "mime_type", "size")


def _run_stream(spark, sf):
    inv, nodes = _base(spark, sf)
    store = CF.InventoryStore(spark, scratch_dir(spark, "inventory-store"))
    CF.init_store(store, inv, nodes)
    CF.run_change_stream(spark, _landed(spark, sf), store, scratch_dir(spark, "stream-ckpt"),
                         fx.ROOT_ID, fx.ROOT_NAME, files_per_trigger=FILES_PER_TRIGGER)
    return store


def q_stream_apply_changes(spark, sf):
    return _run_stream(spark, sf).read("inventory").select(*CH.INVENTORY_COLS)


def q_listener_state(spark, sf):
    return _run_stream(spark, sf).read("state").select("last_seq", "n_polls", "last_rescan_day", "last_poll_day")


def q_stream_state_changes(spark, sf):
    """The snapshot, then all changes, through the keyed state: what each record did."""
    feed = SF.snapshot_records(fx.fx_node(spark, sf)).unionByName(
        fx.fx_change(spark, sf).select(*[f.name for f in CF.CHANGE_FLAT.fields]))
    landing = scratch_dir(spark, "state-landing")
    CF.land_changes(feed, landing)
    out = scratch_dir(spark, "state-changes")
    SF.run_state_stream(spark, landing, out, scratch_dir(spark, "state-ckpt"), files_per_trigger=FILES_PER_TRIGGER)
    return spark.read.parquet(out).drop("epoch").where(F.col("seq") > SF.SNAPSHOT_SEQ)


def q_apply_changes_buckets(spark, sf):
    inv, nodes = _base(spark, sf)
    store = CH.node_store(spark, scratch_dir(spark, "bucket-store"), inv, nodes)
    _, rescanned = CH.apply_changes_bucketed(store, _patchable(fx.fx_change(spark, sf)), fx.ROOT_ID, fx.ROOT_NAME)
    assert not rescanned
    return store.read("inventory")


def q_cascade_changes(spark, sf):
    inv, nodes = _base(spark, sf)
    return CC.cascade_changes(inv, nodes, fx.fx_folder_change(spark, sf), fx.ROOT_ID)[0]


def q_folder_intervals(spark, sf):
    return CC.folder_intervals(inventory(spark, sf), fx.ROOT_ID).select("id", "lo", "hi")


def q_member_deltas(spark, sf):
    inv, nodes = _base(spark, sf)
    after, _ = CC.cascade_changes(inv, nodes, fx.fx_folder_change(spark, sf), fx.ROOT_ID)
    return SN.member_deltas(*SN.changed_rows(inv, after), client_folders(inv))


def q_changed_clients_by_content(spark, sf):
    """Clients whose files changed by id, name or size through the folder changes."""
    inv, nodes = _base(spark, sf)
    after, _ = CC.cascade_changes(inv, nodes, fx.fx_folder_change(spark, sf), fx.ROOT_ID)
    cf = client_folders(inv)
    return SN.changed_clients_by_digest(client_files(after, cf), client_files(inv, cf), cf, ("id", "name", "size"))


def _pages(spark, sf):
    """The feed as pages, one a day; the token is the day's number."""
    return fx.fx_change(spark, sf).withColumn("token", F.datediff("batch_day", F.lit("1970-01-01").cast("date")))


def q_poll_from_token(spark, sf):
    """Live nodes after a scan that ran while pages 11 and 12 landed, polled from the token
    that was recorded before it: what the scan has seen already is applied again without effect."""
    nodes = fx.fx_node(spark, sf).select(*CH.NODE_COLS)
    feed = _pages(spark, sf)
    landing = scratch_dir(spark, "pages")
    FL.land_pages(feed, landing)
    tokens = FL.page_tokens(landing)
    recorded, seen = tokens[9], tokens[11]
    scanned = materialize(CH.apply_to_nodes(nodes, CH.latest_changes(feed.where(F.col("token") <= seen).drop("token", "ts"))))
    store = CF.InventoryStore(spark, scratch_dir(spark, "token-store"))
    CF.init_store(store, inventory(spark, sf).limit(0), scanned, start_token=recorded)
    CF.run_page_stream(spark, landing, store, scratch_dir(spark, "token-ckpt"), fx.ROOT_ID, fx.ROOT_NAME)
    return store.read("nodes")


QUERIES = {
    "latest_changes": q_latest_changes,
    "dedupe_last": q_dedupe_last,
    "needs_rescan": q_needs_rescan,
    "apply_changes": q_apply_changes,
    "apply_changes_patch": q_apply_changes_patch,
    "resolve_changed_paths": q_resolve_changed_paths,
    "replan_from_changes": q_replan_from_changes,
    "stream_changes": q_stream_changes,
    "stream_apply_changes": q_stream_apply_changes,
    "listener_state": q_listener_state,
    "stream_state_changes": q_stream_state_changes,
    "apply_changes_buckets": q_apply_changes_buckets,
    "cascade_changes": q_cascade_changes,
    "folder_intervals": q_folder_intervals,
    "member_deltas": q_member_deltas,
    "changed_clients_by_content": q_changed_clients_by_content,
    "poll_from_token": q_poll_from_token,
}

_LAST = ("last", """select * from (select *, row_number() over (partition by file_id order by seq desc) rn
    from fx_change where coalesce(change_type, '') <> 'drive' and file_id is not null) where rn = 1""")
_PLAST = ("last", """select * from (select *, row_number() over (partition by file_id order by seq desc) rn
    from fx_change where coalesce(change_type, '') <> 'drive' and file_id is not null and batch_day not in (
        select batch_day from fx_change group by batch_day having bool_or(coalesce(change_type, '') = 'drive'
          or (not coalesce(removed, false) and (file_id is null or parent_id is null)))))
    where rn = 1""")
_LIVE = [
    ("live", """select id, parent_id, name, mime_type, size from fx_node
        where id not in (select file_id from last)
        union all select file_id, parent_id, name, mime_type, size from last where not removed"""),
    ("lwalk", f"""select id, name path, -1 indent from live where id = 'root'
        union all select n.id, w.path || '/' || n.name, w.indent + 1 from live n join lwalk w on n.parent_id = w.id
        where w.id in (select id from live where mime_type = {FOLDER})"""),
    ("linv", """select w.id, n.parent_id, n.name, n.mime_type, n.size, w.path, w.indent
        from lwalk w join live n using (id)"""),
]
_UP = [
    ("targets", "select file_id id from last where not removed"),
    ("up", """select t.id, case when l.parent_id is null or l.parent_id = 'root' then null else l.parent_id end cur,
          coalesce(l.name, 'Unknown') acc, 0 lvl
        from targets t left join live l on l.id = t.id
        union all
        select u.id, case when n.id is null or n.parent_id is null or n.parent_id = 'root' then null
                          else n.parent_id end,
          coalesce(n.name, 'Unknown') || '/' || u.acc, u.lvl + 1
        from up u left join live n on n.id = u.cur where u.cur is not null"""),
    ("resolved", "select id, 'ROOT/' || acc path from up where cur is null"),
]
_PATCHED = """select id, parent_id, name, mime_type, size, path, indent from fx_inventory
        where id not in (select file_id from last)
        union all
        select u.file_id, u.parent_id, u.name, u.mime_type, u.size, r.path,
          (length(r.path) - length(replace(r.path, '/', '')) - 1)::int
        from last u join resolved r on r.id = u.file_id where not u.removed"""

_PAIRS = """select distinct cf.client, i.id from {inv} i join fx_client_folder cf on starts_with(i.path, cf.folder_path)"""

SQL = {
    "latest_changes": V("fx_change", extra=[_LAST]) + "select file_id, seq, removed, parent_id, name, size from last",
    "dedupe_last": V("fx_inventory") + """select name, arg_max(id, (path, id)) id, arg_max(path, (path, id)) path
        from fx_inventory group by name""",
    "needs_rescan": V("fx_change") + """select batch_day, count(*) n_changes,
        bool_or(change_type = 'drive' or (not coalesce(removed, false)
                and (file_id is null or parent_id is null))) needs_rescan
        from fx_change group by batch_day""",
    "apply_changes": V("fx_change", "fx_node", extra=[_LAST, *_LIVE]) +
    "select id, parent_id, name, mime_type, size, path, indent from linv",
    "apply_changes_patch": V("fx_change", "fx_inventory", extra=[_PLAST, _LIVE[0], *_UP]) + _PATCHED,
    "resolve_changed_paths": V("fx_change", "fx_node", extra=[_PLAST, _LIVE[0], *_UP]) +
    "select id, path from resolved",
    "replan_from_changes": V("fx_change", "fx_client_folder", extra=[
        _LAST, *_LIVE,
        ("pa", _PAIRS.format(inv="linv")), ("pb", _PAIRS.format(inv="fx_inventory"))]) + """
        select distinct coalesce(pa.client, pb.client) client from pa full outer join pb
          on pa.client = pb.client and pa.id = pb.id where pa.id is null or pb.id is null""",
    "stream_changes": V("fx_change") + """select seq, batch_day, change_type, file_id, removed, parent_id, name,
        mime_type, size from fx_change""",
    "stream_apply_changes": V("fx_change", "fx_node", extra=[_LAST, *_LIVE]) +
    "select id, parent_id, name, mime_type, size, path, indent from linv",
    "listener_state": V("fx_change") + """select max(seq) last_seq, count(distinct batch_day) n_polls,
        max(batch_day) filter (where change_type = 'drive' or (not coalesce(removed, false)
          and (file_id is null or parent_id is null))) last_rescan_day,
        max(batch_day) last_poll_day from fx_change""",
}

SQL["apply_changes_buckets"] = SQL["apply_changes_patch"]
SQL["stream_state_changes"] = V("fx_change", "fx_node") + """select file_id, seq, case when removed then (case when was then 'delete' else 'none' end)
      else (case when was then 'update' else 'insert' end) end kind,
      case when not removed then parent_id end parent_id, case when not removed then name end as name,
      case when not removed then mime_type end mime_type, case when not removed then size end as size,
      case when was then old_parent_id end old_parent_id, case when was then old_name end old_name,
      case when was then old_mime_type end old_mime_type, case when was then old_size end old_size
    from (select *, coalesce(not lag(removed) over w, false) was, lag(parent_id) over w old_parent_id, lag(name) over w old_name,
            lag(mime_type) over w old_mime_type, lag(size) over w old_size
          from (select file_id, seq, coalesce(removed, false) removed, parent_id, name, mime_type, size from fx_change
                where change_type <> 'drive' and file_id is not null
                union all select id, -1, false, parent_id, name, mime_type, size from fx_node)
          window w as (partition by file_id order by seq)) where seq >= 0"""
_FLAST = ("last", "select * from (select *, row_number() over (partition by file_id order by seq desc) rn from fx_folder_change) where rn = 1")
SQL["cascade_changes"] = V("fx_folder_change", "fx_node", extra=[_FLAST, *_LIVE]) + \
    "select id, parent_id, name, mime_type, size, path, indent from linv"
SQL["folder_intervals"] = V("fx_inventory", extra=[
    ("trails", f"""select id, id trail from fx_inventory where id = 'root'
        union all select i.id, t.trail || chr(1) || i.id from fx_inventory i join trails t on i.parent_id = t.id where i.mime_type = {FOLDER}"""),
    ("placed", "select id, trail, row_number() over (order by trail) - 1 lo from trails")]) + """
    select p.id, p.lo, p.lo + (select count(*) from trails t where t.trail = p.trail or starts_with(t.trail, p.trail || chr(1))) - 1 hi from placed p"""
SQL["member_deltas"] = V("fx_folder_change", "fx_client_folder", extra=[
    _FLAST, *_LIVE, ("pa", _PAIRS.format(inv="linv")), ("pb", _PAIRS.format(inv="fx_inventory"))]) + """
    select coalesce(pa.client, pb.client) client, coalesce(pa.id, pb.id) id, case when pb.id is null then 1 else -1 end delta
    from pa full outer join pb on pa.client = pb.client and pa.id = pb.id where pa.id is null or pb.id is null"""
SQL["poll_from_token"] = V("fx_change", "fx_node", extra=[_LAST, _LIVE[0]]) + "select id, parent_id, name, mime_type, size from live"
_CONTENT = """select distinct cf.client, i.id, i.name, i.size from {inv} i join fx_client_folder cf on starts_with(i.path, cf.folder_path)"""
SQL["changed_clients_by_content"] = V("fx_folder_change", "fx_client_folder", extra=[
    _FLAST, *_LIVE, ("pa", _CONTENT.format(inv="linv")), ("pb", _CONTENT.format(inv="fx_inventory"))]) + """
    select distinct client from ((select * from pa except select * from pb) union all (select * from pb except select * from pa))"""
