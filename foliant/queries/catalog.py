"""Sources, sinks, catalog lookups, generations and snapshot comparison."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from foliant import fixtures as fx
from foliant.operators import packing as P
from foliant.operators import snapshots as SN
from foliant.operators.tasks import client_files
from foliant.plans.fixture_runs import client_folders, inventory, tasks_for
from foliant.queries.planning import fold_ctes
from foliant.queries.tree import tasks_sql
from foliant.schemas import BATCH_ITEM
from foliant.session import materialize, scratch_dir
from foliant.sources import catalog as C
from foliant.sources import store as ST

V = fx.with_views


def q_scan_inventory(spark, sf):
    path = scratch_dir(spark, "inventory-jsonl")
    ST.inventory_to_json_rows(inventory(spark, sf)).write.mode("overwrite").json(path)
    return ST.scan_inventory(spark, path).select("id", "name", "mime_type", "size", "parent_id",
                                                 "path", "indent")


def q_write_inventory_sorted(spark, sf):
    path = scratch_dir(spark, "inventory-sorted")
    ST.write_inventory_sorted(ST.inventory_to_json_rows(inventory(spark, sf)), path)
    back = ST.scan_inventory(spark, path)
    return back.select("id", "path", "indent")


def q_latest_report(spark, sf):
    return C.latest_by_mtime(fx.fx_catalog(spark, sf), ".xlsx")


def q_catalog_lookup(spark, sf):
    return C.catalog_lookup(fx.fx_catalog(spark, sf), "drive_scan.jsonl")


def q_catalog_lookup_ordered(spark, sf):
    """The plan file of the last name per folder, by mime type."""
    files = fx.fx_catalog(spark, sf)
    mime = F.when(F.endswith("name", F.lit("n.json")), F.lit("application/json")).otherwise(F.lit("text/plain"))
    return C.catalog_lookup(files.withColumn("mime_type", mime), ".json", mime_type="application/json", order_by="name", descending=True)


def q_catalog_lookup_in_folder(spark, sf):
    """One folder only: the parent of the file with the smallest id."""
    files = fx.fx_catalog(spark, sf)
    folder = files.where("name = 'drive_scan.jsonl' and not trashed").agg(F.min_by("parent_id", "id")).first()[0]
    return C.catalog_lookup(files, "drive_scan.jsonl", parent_id=folder)


def q_select_plans(spark, sf):
    return C.select_plans(fx.fx_catalog(spark, sf)).select("id", "name")


def q_select_plans_test(spark, sf):
    return C.select_plans(fx.fx_catalog(spark, sf), limit_clients=2).select("id", "name")


def q_list_children(spark, sf):
    inv = inventory(spark, sf)
    cands = client_folders(inv).select(F.col("folder_id").alias("nid"))
    parents = inv.join(cands, F.col("parent_id") == F.col("nid")).select(F.col("id").alias("parent_id"))
    return C.list_children(fx.fx_catalog(spark, sf), parents).select("parent_id", "id", "name")


def q_lookup_by_id(spark, sf):
    ids = fx.fx_change(spark, sf).select(F.col("file_id").alias("id"))
    return C.lookup_by_id(inventory(spark, sf), ids, ["name", "parent_id", "size"])


def q_rescan_due(spark, sf):
    ch = fx.fx_change(spark, sf)
    daily = ch.groupBy("batch_day").agg(
        F.max(F.when(F.col("change_type") == "drive", F.col("ts"))).alias("_scan"))
    w = Window.orderBy("batch_day").rowsBetween(Window.unboundedPreceding, -1)
    state = daily.select("batch_day", F.max("_scan").over(w).alias("last_full_scan_ts"))
    now = F.col("batch_day").cast("timestamp") + F.expr("INTERVAL 12 HOURS")
    return C.rescan_due(state, now).select("batch_day", "last_full_scan_ts", "rescan_due")


def q_report_changed(spark, sf):
    cat = fx.fx_catalog(spark, sf)
    reports = cat.where(C.name_matches("name", ".xlsx") & ~F.col("trashed"))
    daily = reports.groupBy(F.col("mtime").cast("date").alias("poll_day")).agg(F.max("mtime").alias("_m"))
    w = Window.orderBy("poll_day")
    latest = daily.select("poll_day", F.max("_m").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("latest"))
    stored = F.lag("latest").over(w)
    return latest.select("poll_day", "latest", C.report_changed(F.col("latest"), stored).alias("changed"))


def q_snapshot_rotate(spark, sf):
    base = scratch_dir(spark, "scan-generations")
    cols = ["id", "path", "indent"]
    ST.rotate_snapshot(inventory(spark, sf, "prev").select(*cols), base)
    ST.rotate_snapshot(inventory(spark, sf, "curr").select(*cols), base)
    ST.rotate_snapshot(inventory(spark, sf, "curr").select(*cols).limit(0), base)  # empty: no-op
    ST.rotate_snapshot(inventory(spark, sf).select(*cols), base)
    schema = inventory(spark, sf).select(*cols).schema
    cur = ST.read_generation(spark, base, schema, "current").withColumn("which", F.lit("current"))
    last = ST.read_generation(spark, base, schema, "last_run").withColumn("which", F.lit("last_run"))
    n_gens = len(ST.list_generations(spark, base))
    return cur.unionByName(last).withColumn("n_gens", F.lit(n_gens))


def _grupo(col="client"):
    return F.startswith(F.col(col), F.lit("GRUPO"))


def q_replace_partition(spark, sf):
    path = scratch_dir(spark, "tasks-by-client")
    cols = ["client", "file_id", "task_type", "size"]
    ST.replace_partitions(tasks_for(spark, sf, "prev").select(*cols), path, ["client"])
    ST.replace_partitions(tasks_for(spark, sf, "curr").select(*cols).where(_grupo()), path, ["client"])
    ST.replace_partitions(tasks_for(spark, sf, "curr").select(*cols).limit(0), path, ["client"])
    return spark.read.parquet(path).select(*cols)


def q_promote_baseline(spark, sf):
    path = scratch_dir(spark, "plans")
    prev = P.pack_batches(tasks_for(spark, sf, "prev")).withColumn("version", F.lit("last_processed"))
    curr = P.pack_batches(tasks_for(spark, sf, "curr")).withColumn("version", F.lit("current"))
    ST.replace_partitions(prev, path, ["version", "client"])
    ST.replace_partitions(curr, path, ["version", "client"])
    schema = BATCH_ITEM.add("version", "string")
    processed = curr.select("client").where(_grupo()).distinct()
    ST.promote_baseline(spark, path, processed, schema)
    return spark.read.schema(schema).parquet(path).where(F.col("version") == "last_processed") \
        .select("client", "fmt", "batch_pos", "batch_id", "item_pos", "file_id", "size")


def q_full_run_reset(spark, sf):
    prev_items = materialize(P.pack_batches(tasks_for(spark, sf, "prev")))
    return P.repack_batches(tasks_for(spark, sf, "curr"), ST.full_run_reset(prev_items, True))


def _members(spark, sf, gen):
    inv_cur = inventory(spark, sf, "curr")
    cf = client_folders(inv_cur)
    inv = inv_cur if gen == "curr" else inventory(spark, sf, gen)
    return client_files(inv, cf), cf


def q_client_signatures(spark, sf):
    members, _ = _members(spark, sf, "curr")
    return SN.client_signatures(members)


def q_changed_clients(spark, sf):
    cur, cf = _members(spark, sf, "curr")
    old, _ = _members(spark, sf, "prev")
    return SN.changed_clients(cur, old, cf)


def q_changed_clients_by_digest(spark, sf):
    cur, cf = _members(spark, sf, "curr")
    old, _ = _members(spark, sf, "prev")
    return SN.changed_clients_by_digest(cur, old, cf)


def q_clients_to_replan(spark, sf):
    cur, cf = _members(spark, sf, "curr")
    old, _ = _members(spark, sf, "prev")
    return SN.clients_to_replan(cf, SN.changed_clients(cur, old, cf), full_run=False)


def q_clients_to_replan_full(spark, sf):
    cur, cf = _members(spark, sf, "curr")
    return SN.clients_to_replan(cf, cf.limit(0), full_run=True)


def q_optional_snapshot(spark, sf):
    """First run: the last-run scan is absent and counts as empty."""
    cur, cf = _members(spark, sf, "curr")
    base = scratch_dir(spark, "no-history")
    prev = ST.read_generation(spark, base, inventory(spark, sf, "curr").schema, "last_run")
    old = client_files(prev, cf)
    return SN.changed_clients(cur, old, cf)


QUERIES = {
    "scan_inventory": q_scan_inventory,
    "write_inventory_sorted": q_write_inventory_sorted,
    "latest_report": q_latest_report,
    "catalog_lookup": q_catalog_lookup,
    "catalog_lookup_ordered": q_catalog_lookup_ordered,
    "catalog_lookup_in_folder": q_catalog_lookup_in_folder,
    "select_plans": q_select_plans,
    "select_plans_test": q_select_plans_test,
    "list_children": q_list_children,
    "lookup_by_id": q_lookup_by_id,
    "rescan_due": q_rescan_due,
    "report_changed": q_report_changed,
    "snapshot_rotate": q_snapshot_rotate,
    "replace_partition": q_replace_partition,
    "promote_baseline": q_promote_baseline,
    "full_run_reset": q_full_run_reset,
    "client_signatures": q_client_signatures,
    "changed_clients": q_changed_clients,
    "changed_clients_by_digest": q_changed_clients_by_digest,
    "clients_to_replan": q_clients_to_replan,
    "clients_to_replan_full": q_clients_to_replan_full,
    "optional_snapshot": q_optional_snapshot,
}

_PAIRS = [
    ("cf_curr", "select * from fx_client_folder_curr"),
    ("pairs_curr", """select distinct cf.client, i.id from fx_inventory_curr i
        join cf_curr cf on starts_with(i.path, cf.folder_path)"""),
    ("pairs_prev", """select distinct cf.client, i.id from fx_inventory_prev i
        join cf_curr cf on starts_with(i.path, cf.folder_path)"""),
    ("changed", """select distinct coalesce(c.client, p.client) client
        from pairs_curr c full outer join pairs_prev p on c.client = p.client and c.id = p.id
        where c.id is null or p.id is null"""),
]
_SV = V("fx_client_folder_curr", "fx_inventory_prev", extra=_PAIRS)

_CURR_PLAN = [("tasks_curr", tasks_sql("_curr")),
              ("act_curr", "select client, file_id, size, output_format from tasks_curr where task_type <> 'IGNORE'")] \
    + fold_ctes("items_curr", "act_curr", None)
_PREV_PLAN = [("tasks_prev", tasks_sql("_prev")),
              ("act_prev", "select client, file_id, size, output_format from tasks_prev where task_type <> 'IGNORE'")] \
    + fold_ctes("items_prev", "act_prev", None)

SQL = {
    "scan_inventory": V("fx_inventory") + "select id, name, mime_type, size, parent_id, path, indent from fx_inventory",
    "write_inventory_sorted": V("fx_inventory") + "select id, path, indent from fx_inventory",
    "latest_report": V("fx_catalog") + """select parent_id, id, name, mtime from (
        select *, row_number() over (partition by parent_id order by mtime desc, id) rn
        from fx_catalog where contains(name, '.xlsx') and not coalesce(trashed, false)) where rn = 1""",
    "catalog_lookup": V("fx_catalog") + """select parent_id, id, name, mtime from (
        select *, row_number() over (partition by parent_id order by id) rn
        from fx_catalog where name = 'drive_scan.jsonl' and not coalesce(trashed, false)) where rn = 1""",
    "select_plans": V("fx_catalog") + """select id, name from fx_catalog where contains(name, '_plan.json')
        and not contains(name, '_last_run') and not contains(name, '_last_processed')
        and not coalesce(trashed, false)""",
    "select_plans_test": V("fx_catalog") + """select id, name from fx_catalog where contains(name, '_plan.json')
        and not contains(name, '_last_run') and not contains(name, '_last_processed')
        and not coalesce(trashed, false)
        order by name, id limit 2""",
    "list_children": V("fx_client_folder", "fx_catalog") + """select k.parent_id, k.id, k.name from fx_catalog k
        where not coalesce(k.trashed, false) and k.parent_id in
          (select i.id from fx_inventory i join fx_client_folder cf on i.parent_id = cf.folder_id)""",
    "lookup_by_id": V("fx_inventory", "fx_change") + """select c.id, i.name, i.parent_id, i.size
        from (select distinct file_id id from fx_change) c left join fx_inventory i on i.id = c.id""",
    "rescan_due": V("fx_change") + """select batch_day, last_full_scan_ts,
          coalesce(last_full_scan_ts, timestamp '1970-01-01') < cast(batch_day as timestamp) + interval 12 hours
            - interval 6 hours rescan_due
        from (select batch_day, max(scan) over (order by batch_day rows between unbounded preceding
                and 1 preceding) last_full_scan_ts
              from (select batch_day, max(case when change_type = 'drive' then ts end) scan
                    from fx_change group by batch_day))""",
    "report_changed": V("fx_catalog") + """select poll_day, latest,
          (latest is not null and latest is distinct from lag(latest) over (order by poll_day)) changed
        from (select poll_day, max(m) over (order by poll_day rows between unbounded preceding and current row) latest
              from (select cast(mtime as date) poll_day, max(mtime) m from fx_catalog
                    where contains(name, '.xlsx') and not trashed group by 1))""",
    "snapshot_rotate": V("fx_inventory", "fx_inventory_curr") + """
        select id, path, indent, 'current' which, 2 n_gens from fx_inventory
        union all select id, path, indent, 'last_run', 2 from fx_inventory_curr""",
    "replace_partition": V("fx_client_folder_prev", "fx_client_folder_curr",
                           extra=[("tp", tasks_sql("_prev")), ("tc", tasks_sql("_curr"))]) + """
        select client, file_id, task_type, size from tp
          where client not in (select client from tc where starts_with(client, 'GRUPO'))
        union all select client, file_id, task_type, size from tc where starts_with(client, 'GRUPO')""",
    "promote_baseline": V("fx_client_folder_prev", "fx_client_folder_curr", extra=_CURR_PLAN + _PREV_PLAN) + """
        select * from items_prev where client not in (select client from items_curr where starts_with(client, 'GRUPO'))
        union all select * from items_curr where starts_with(client, 'GRUPO')""",
    "full_run_reset": V("fx_client_folder_curr", extra=_CURR_PLAN) + "select * from items_curr",
    "client_signatures": _SV + """select client, count(*) n_ids, min(id) first_id, max(id) last_id,
          cast(sum(cast('0x' || substr(md5(id), 1, 8) as bigint)) as bigint) id_digest
        from pairs_curr group by client""",
    "changed_clients": _SV + "select client from changed where client in (select client from cf_curr)",
    "clients_to_replan": _SV + "select client from changed where client in (select client from cf_curr)",
    "clients_to_replan_full": _SV + "select distinct client from cf_curr",
    "optional_snapshot": _SV + "select distinct client from pairs_curr",
}
SQL["changed_clients_by_digest"] = SQL["changed_clients"]
SQL["catalog_lookup_ordered"] = V("fx_catalog") + """select parent_id, id, name, mtime from (
    select *, row_number() over (partition by parent_id order by name desc, id) rn
    from fx_catalog where contains(name, '.json') and ends_with(name, 'n.json') and not trashed) where rn = 1"""
SQL["catalog_lookup_in_folder"] = V("fx_catalog") + """select parent_id, id, name, mtime from fx_catalog where name = 'drive_scan.jsonl' and not trashed
    and parent_id = (select arg_min(parent_id, id) from fx_catalog where name = 'drive_scan.jsonl' and not trashed) order by id limit 1"""
