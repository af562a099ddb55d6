"""Hierarchy, candidate folders, prefix join and task classification."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliant import fixtures as fx
from foliant.functions import classify_task, path_depth, sanitize_name
from foliant.operators import hierarchy as H
from foliant.operators import tasks as T
from foliant.operators.prefix import prefix_members
from foliant.plans.fixture_runs import client_folders, inventory, tasks_for

V = fx.with_views
FOLDER = "'application/vnd.google-apps.folder'"


def q_tree_paths(spark, sf):
    return H.tree_paths(fx.fx_node(spark, sf), fx.ROOT_ID)


def q_path_depth(spark, sf):
    inv = inventory(spark, sf)
    return inv.select("id", "indent", path_depth("path").alias("depth"))


def q_children_by_parent(spark, sf):
    inv = H.children_by_parent(inventory(spark, sf))
    return inv.groupBy("parent_id").agg(
        F.count(F.lit(1)).alias("n_children"),
        F.sum(F.when(F.col("mime_type") == fx.FOLDER_MIME, 1).otherwise(0)).alias("n_folders"))


def q_split_files_folders(spark, sf):
    files, folders = H.split_files_folders(inventory(spark, sf))
    agg = [F.count(F.lit(1)).alias("n_items"), F.sum("size").alias("total_size")]
    return files.agg(*agg).select(F.lit("file").alias("kind"), "*").unionByName(
        folders.agg(*agg).select(F.lit("folder").alias("kind"), "*"))


def q_root_name(spark, sf):
    return H.root_name(inventory(spark, sf), fx.ROOT_ID)


def q_client_candidates(spark, sf):
    inv = inventory(spark, sf)
    return T.client_candidates(inv, fx.ROOT_NAME, fx.STATUS_FOLDERS).select("id", "name", "path", "indent")


def q_expand_groups(spark, sf):
    inv = inventory(spark, sf)
    cands = T.client_candidates(inv, fx.ROOT_NAME, fx.STATUS_FOLDERS)
    return T.expand_groups(inv, cands).select("id", "name", "path", "group_name")


def q_client_files(spark, sf):
    inv = inventory(spark, sf)
    return T.client_files(inv, client_folders(inv)).select("client", "id", "name", "path", "size", "mime_type")


def q_client_files_component(spark, sf):
    inv = inventory(spark, sf)
    return T.client_files(inv, client_folders(inv), boundary="component") \
        .select("client", "id", "name", "path", "size", "mime_type")


def q_classify_tasks(spark, sf):
    kind = classify_task("mime_type")
    return inventory(spark, sf).select("id", "mime_type", kind["task_type"].alias("task_type"),
                                       kind["output_format"].alias("output_format"))


def q_task_columns(spark, sf):
    return tasks_for(spark, sf)


def q_active_tasks(spark, sf):
    return T.active_tasks(tasks_for(spark, sf))


def q_tasks_by_format(spark, sf):
    return T.tasks_by_format(tasks_for(spark, sf))


def q_sanitize_name(spark, sf):
    inv = inventory(spark, sf)
    return inv.select("id", "name", sanitize_name("name").alias("safe_name"))


def q_client_tree(spark, sf):
    inv = inventory(spark, sf)
    cf = client_folders(inv)
    members = prefix_members(inv, cf, ["client", "pos"])
    return H.client_tree_lines(cf, members).select("client", "section", "pos", "ord", "path", "id", "line")


QUERIES = {
    "tree_paths": q_tree_paths,
    "path_depth": q_path_depth,
    "children_by_parent": q_children_by_parent,
    "split_files_folders": q_split_files_folders,
    "root_name": q_root_name,
    "client_candidates": q_client_candidates,
    "expand_groups": q_expand_groups,
    "client_files": q_client_files,
    "client_files_component": q_client_files_component,
    "classify_tasks": q_classify_tasks,
    "task_columns": q_task_columns,
    "active_tasks": q_active_tasks,
    "tasks_by_format": q_tasks_by_format,
    "sanitize_name": q_sanitize_name,
    "client_tree": q_client_tree,
}

CLASSIFY_SQL = """case
      when coalesce(mime_type, '') = 'application/pdf' then 'DIRECT_INCLUDE'
      when coalesce(mime_type, '') in ('text/plain', 'text/markdown') then 'DIRECT_INCLUDE'
      when coalesce(mime_type, '') = 'audio/mpeg' then 'DIRECT_INCLUDE'
      when contains(coalesce(mime_type, ''), 'google-apps.document')
        or contains(coalesce(mime_type, ''), 'wordprocessingml') then 'CONVERT'
      when contains(coalesce(mime_type, ''), 'google-apps.spreadsheet')
        or contains(coalesce(mime_type, ''), 'spreadsheetml') then 'CONVERT'
      when contains(coalesce(mime_type, ''), 'image/') then 'OCR'
      else 'IGNORE' end"""

FORMAT_SQL = """case
      when coalesce(mime_type, '') = 'application/pdf' then 'pdf'
      when coalesce(mime_type, '') in ('text/plain', 'text/markdown') then 'txt'
      when coalesce(mime_type, '') = 'audio/mpeg' then 'mp3'
      when contains(coalesce(mime_type, ''), 'google-apps.document')
        or contains(coalesce(mime_type, ''), 'wordprocessingml') then 'txt'
      when contains(coalesce(mime_type, ''), 'google-apps.spreadsheet')
        or contains(coalesce(mime_type, ''), 'spreadsheetml') then 'txt'
      when contains(coalesce(mime_type, ''), 'image/') then 'pdf'
      else 'none' end"""


def client_files_sql(gen: str = "", boundary: str = "raw") -> str:
    cond = ("starts_with(i.path, cf.folder_path)" if boundary == "raw"
            else "(i.path = cf.folder_path or starts_with(i.path, cf.folder_path || '/'))")
    return f"""select distinct cf.client, i.id, i.name, i.path, i.size, i.mime_type, i.parent_id
  from fx_inventory{gen} i join fx_client_folder{gen} cf on {cond}"""


def tasks_sql(gen: str = "") -> str:
    return f"""select client, id file_id, name file_name, path file_path,
         concat('https://drive.google.com/file/d/', id, '/view') drive_link,
         coalesce(mime_type, '') mime_type, coalesce(size, 0) size,
         {CLASSIFY_SQL} task_type, {FORMAT_SQL} output_format
  from ({client_files_sql(gen)})"""


SQL = {
    "tree_paths": V("fx_inventory") + "select * from fx_inventory",
    "path_depth": V("fx_inventory") + """select id, indent,
        (length(path) - length(replace(path, '/', '')) - 1)::int depth from fx_inventory""",
    "children_by_parent": V("fx_inventory") + f"""select parent_id, count(*) n_children,
        sum(case when mime_type = {FOLDER} then 1 else 0 end)::bigint n_folders
        from fx_inventory where parent_id is not null group by parent_id""",
    "split_files_folders": V("fx_inventory") + f"""
        select 'file' kind, count(*) n_items, sum(size)::bigint total_size from fx_inventory
          where mime_type is null or mime_type <> {FOLDER}
        union all
        select 'folder', count(*), sum(size)::bigint from fx_inventory where mime_type = {FOLDER}""",
    "root_name": V("fx_inventory") + """select coalesce(max(name), 'ROOT') root_name
        from fx_inventory where id = 'root'""",
    "client_candidates": V("fx_inventory") + f"""select id, name, path, indent from fx_inventory
        where indent = 1 and mime_type = {FOLDER}
          and (starts_with(path, 'ROOT/AFRICA/') or starts_with(path, 'ROOT/ASIA/'))""",
    "expand_groups": V("fx_inventory", extra=[("c", f"""select * from fx_inventory
          where indent = 1 and mime_type = {FOLDER}
          and (starts_with(path, 'ROOT/AFRICA/') or starts_with(path, 'ROOT/ASIA/'))""")]) + f"""
        select id, name, path, cast(null as varchar) group_name from c
        union all
        select k.id, k.name, k.path, c.name from fx_inventory k join c on k.parent_id = c.id
        where starts_with(upper(c.name), 'GRUPO') and k.mime_type = {FOLDER}""",
    "client_files": V("fx_client_folder") + "select client, id, name, path, size, mime_type from ("
    + client_files_sql() + ")",
    "client_files_component": V("fx_client_folder") + "select client, id, name, path, size, mime_type from ("
    + client_files_sql(boundary="component") + ")",
    "classify_tasks": V("fx_inventory") + f"""select id, mime_type, {CLASSIFY_SQL} task_type,
        {FORMAT_SQL} output_format from fx_inventory""",
    "task_columns": V("fx_client_folder") + tasks_sql(),
    "active_tasks": V("fx_client_folder") + f"select * from ({tasks_sql()}) where task_type <> 'IGNORE'",
    "tasks_by_format": V("fx_client_folder") + f"""select client, task_type, output_format,
        count(*) n_files, sum(size)::bigint total_bytes from ({tasks_sql()})
        group by client, task_type, output_format""",
    "sanitize_name": V("fx_inventory") + r"""select id, name,
        rtrim(regexp_replace(name, '[^\p{L}\p{N} _]', '', 'g'), ' ') safe_name from fx_inventory""",
    "client_tree": V("fx_client_folder") + r"""
        , m as (select cf.client, cf.pos, cf.folder_path, i.id, i.name, i.path, i.indent
                from fx_inventory i join fx_client_folder cf on starts_with(i.path, cf.folder_path))
        , lastpos as (select client, max(pos) last_pos from fx_client_folder group by client)
        select client, 0 section, -1 pos, 0 ord, '' path, '' id,
               concat('File tree for: ', client, chr(10), repeat('=', length('File tree for: ' || client)),
                      chr(10)) line
        from (select distinct client from fx_client_folder where folder_path <> '')
        union all
        select client, 1, pos, 0, '', '', concat('--- Source Folder: ', coalesce(folder_name, 'None'), ' ---')
        from fx_client_folder where folder_path <> ''
        union all
        select client, 1, pos, 1, path, id,
               concat(case when coalesce(indent, 0) - (length(folder_path) - length(replace(folder_path, '/', ''))) > 0
                      then repeat('  ', coalesce(indent, 0) - (length(folder_path)
                           - length(replace(folder_path, '/', ''))) - 1) || '|- ' else '' end,
                      coalesce(name, 'Unknown'))
        from m
        union all
        select cf.client, 1, cf.pos, 2, '', '', '' from fx_client_folder cf join lastpos l using (client)
        where cf.folder_path <> '' and cf.pos < l.last_pos""",
}
