"""Planning: packing, sticky repacking, diff against the processed baseline.

Scenario on the fixtures: the ``prev`` generation was planned (no history)
and processed, so its plan is both the last-run plan and the baseline; the
``curr`` generation is then repacked against it and diffed.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from foliant import fixtures as fx
from foliant.operators import packing as P
from foliant.operators import plandiff as D
from foliant.plans.fixture_runs import tasks_for
from foliant.queries.tree import tasks_sql
from foliant.session import materialize

V = fx.with_views
LIMIT = 157286400
GENERATED_AT = "2025-01-01T00:00:00"


def _scenario(spark, sf):
    prev_tasks = tasks_for(spark, sf, "prev")
    curr_tasks = tasks_for(spark, sf, "curr")
    prev_items = materialize(P.pack_batches(prev_tasks))
    return prev_tasks, prev_items, curr_tasks


def q_pack_batches(spark, sf):
    return P.pack_batches(tasks_for(spark, sf))


def q_repack_batches(spark, sf):
    prev_tasks, prev_items, curr_tasks = _scenario(spark, sf)
    return P.repack_batches(curr_tasks, prev_items, prev_tasks)


def q_repack_batches_strict(spark, sf):
    prev_tasks, prev_items, curr_tasks = _scenario(spark, sf)
    return P.repack_batches(curr_tasks, prev_items, prev_tasks, place_reactivated=False)


def q_retain_batches(spark, sf):
    prev_tasks, prev_items, curr_tasks = _scenario(spark, sf)
    return P.retain_batches(prev_items, curr_tasks)


def q_plan_new_ids(spark, sf):
    return P.plan_new_ids(tasks_for(spark, sf, "prev"), tasks_for(spark, sf, "curr"))


def q_plan_deleted_ids(spark, sf):
    return P.plan_deleted_ids(tasks_for(spark, sf, "prev"), tasks_for(spark, sf, "curr"))


def q_oversize_batches(spark, sf):
    prev_tasks, prev_items, curr_tasks = _scenario(spark, sf)
    return P.oversize_batches(prev_items, curr_tasks)


def q_batch_totals(spark, sf):
    prev_tasks, prev_items, curr_tasks = _scenario(spark, sf)
    return P.batch_totals(P.repack_batches(curr_tasks, prev_items, prev_tasks))


def q_assemble_plan(spark, sf):
    tasks = tasks_for(spark, sf)
    return D.assemble_batches(P.pack_batches(tasks)).select(
        "client", "fmt", "batch_pos", "batch_id", "total_size_mb", "n_tasks", "source_tasks")


def q_flatten_plan(spark, sf):
    tasks = tasks_for(spark, sf)
    flat = D.flatten_plan(D.assemble_batches(P.pack_batches(tasks), tasks))
    return flat.select("client", "fmt", "batch_pos", "batch_id", "item_pos",
                       F.col("task.file_id").alias("file_id"), F.col("task.file_name").alias("file_name"),
                       F.col("task.task_type").alias("task_type"))


def _diff(spark, sf):
    prev_tasks, prev_items, curr_tasks = _scenario(spark, sf)
    new_items = P.repack_batches(curr_tasks, prev_items, prev_tasks)
    return D.plan_diff(prev_items, prev_tasks, new_items, curr_tasks)


def q_plan_diff(spark, sf):
    return _diff(spark, sf)


def q_plan_diff_text(spark, sf):
    return D.plan_diff_lines(_diff(spark, sf), GENERATED_AT)


def q_output_names(spark, sf):
    prev_tasks, prev_items, curr_tasks = _scenario(spark, sf)
    items = P.repack_batches(curr_tasks, prev_items, prev_tasks)
    return D.output_names(items).select("client", "fmt", "batch_id", "ordinal", "output_name")


QUERIES = {
    "pack_batches": q_pack_batches,
    "repack_batches": q_repack_batches,
    "repack_batches_strict": q_repack_batches_strict,
    "retain_batches": q_retain_batches,
    "plan_new_ids": q_plan_new_ids,
    "plan_deleted_ids": q_plan_deleted_ids,
    "oversize_batches": q_oversize_batches,
    "batch_totals": q_batch_totals,
    "assemble_plan": q_assemble_plan,
    "flatten_plan": q_flatten_plan,
    "plan_diff": q_plan_diff,
    "plan_diff_text": q_plan_diff_text,
    "output_names": q_output_names,
}


# ---------------------------------------------------------------------------
# DuckDB oracle: the packing as a recursive fold over tasks numbered by
# (size desc, file_id) per (client, fmt), carrying the batch lists.
# ---------------------------------------------------------------------------

def fold_ctes(name: str, to_place: str, seeds: str | None) -> list[tuple[str, str]]:
    """CTEs ``<name>`` (placed rows) for tasks ``to_place(client, output_format,
    file_id, size)`` and optional ``seeds(client, fmt, batch_pos, batch_id, load, next_item)``."""
    t = f"{name}_t"
    s = f"{name}_s"
    ctes = [(t, f"""select client, output_format fmt, file_id, size,
        row_number() over (partition by client, output_format order by size desc, file_id) rn
        from {to_place}""")]
    if seeds:
        ctes.append((s, f"""select client, fmt, list(load order by batch_pos) loads,
            list(batch_id order by batch_pos) ids, list(batch_pos order by batch_pos) poss,
            list(next_item order by batch_pos) nexts, max(batch_pos) maxpos
            from {seeds} group by client, fmt"""))
        init = f"""select g.client, g.fmt, 0 rn, coalesce(s.loads, []::bigint[]) loads,
            coalesce(s.ids, []::varchar[]) ids, coalesce(s.poss, []::bigint[]) poss,
            coalesce(s.nexts, []::bigint[]) nexts, coalesce(s.maxpos, -1)::bigint maxpos,
            null::varchar file_id, null::bigint size, null::varchar batch_id,
            null::bigint batch_pos, null::bigint item_pos
            from (select distinct client, fmt from {t}) g left join {s} s
            on s.client = g.client and s.fmt = g.fmt"""
    else:
        init = f"""select client, fmt, 0 rn, []::bigint[] loads, []::varchar[] ids,
            []::bigint[] poss, []::bigint[] nexts, -1::bigint maxpos, null::varchar file_id,
            null::bigint size, null::varchar batch_id, null::bigint batch_pos, null::bigint item_pos
            from (select distinct client, fmt from {t})"""
    step = f"""select client, fmt, rn,
          case when tgt is null then list_append(loads, size)
               else list_transform(range(1, len(loads) + 1),
                    lambda i: case when i = tgt then loads[i] + size else loads[i] end) end,
          case when tgt is null then list_append(ids, newid) else ids end,
          case when tgt is null then list_append(poss, maxpos + 1) else poss end,
          case when tgt is null then list_append(nexts, 1::bigint)
               else list_transform(range(1, len(nexts) + 1),
                    lambda i: case when i = tgt then nexts[i] + 1 else nexts[i] end) end,
          case when tgt is null then maxpos + 1 else maxpos end,
          file_id, size,
          case when tgt is null then newid else ids[tgt] end,
          case when tgt is null then maxpos + 1 else poss[tgt] end,
          case when tgt is null then 0::bigint else nexts[tgt] end
        from (select f.client, f.fmt, t.rn, f.loads, f.ids, f.poss, f.nexts, f.maxpos, t.file_id, t.size,
                list_position(f.loads, list_min(list_filter(f.loads, lambda x: x + t.size <= {LIMIT}))) tgt,
                f.fmt || '_batch_' || list_min(list_filter(range(len(f.ids) + 1, 2 * len(f.ids) + 2),
                    lambda k: not list_contains(f.ids, f.fmt || '_batch_' || k))) newid
              from {name}_fold f join {t} t
                on t.client = f.client and t.fmt = f.fmt and t.rn = f.rn + 1)"""
    ctes.append((f"{name}_fold", f"{init}\n        union all\n        {step}"))
    ctes.append((name, f"""select client, fmt, batch_pos, batch_id, item_pos, file_id, size
        from {name}_fold where rn > 0"""))
    return ctes


def scenario_ctes(strict: bool = False) -> list[tuple[str, str]]:
    ctes = [
        ("tasks_prev", tasks_sql("_prev")),
        ("tasks_curr", tasks_sql("_curr")),
        ("act_prev", "select client, file_id, size, output_format from tasks_prev where task_type <> 'IGNORE'"),
        ("act_curr", "select client, file_id, size, output_format from tasks_curr where task_type <> 'IGNORE'"),
    ]
    ctes += fold_ctes("items_prev", "act_prev", None)
    ctes += [
        ("retained", """select o.client, o.batch_pos, o.batch_id, o.item_pos, o.file_id, a.size,
            split_part(o.batch_id, '_', 1) fmt
            from items_prev o join act_curr a on a.client = o.client and a.file_id = o.file_id"""),
        ("loads", """select client, fmt, batch_pos, batch_id, sum(size)::bigint load,
            max(item_pos) + 1 next_item from retained group by client, fmt, batch_pos, batch_id"""),
        ("kept", f"select * from loads where load <= {LIMIT}"),
        ("kept_members", """select r.* from retained r
            where exists (select 1 from kept k where k.client = r.client and k.batch_id = r.batch_id)"""),
    ]
    to_place = """select a.* from act_curr a where not exists
            (select 1 from kept_members m where m.client = a.client and m.file_id = a.file_id)"""
    if strict:
        to_place += """ and (not exists (select 1 from tasks_prev p
                  where p.client = a.client and p.file_id = a.file_id)
                or exists (select 1 from retained r where r.client = a.client and r.file_id = a.file_id
                  and not exists (select 1 from kept k where k.client = r.client and k.batch_id = r.batch_id)))"""
    ctes.append(("to_place", to_place))
    ctes += fold_ctes("placed", "to_place", "kept")
    ctes.append(("items_new", """select client, fmt, batch_pos, batch_id, item_pos, file_id, size from kept_members
        union all select client, fmt, batch_pos, batch_id, item_pos, file_id, size from placed"""))
    return ctes


def _sv(extra):
    return V("fx_client_folder_prev", "fx_client_folder_curr", extra=extra)


PACK_ALL = [("tasks_all", tasks_sql()),
            ("act_all", "select client, file_id, size, output_format from tasks_all where task_type <> 'IGNORE'")] \
    + fold_ctes("items_all", "act_all", None)

DIFF = [("diff", """select coalesce(o.client, n.client) client, coalesce(o.file_id, n.file_id) file_id,
          o.batch_id old_batch, n.batch_id new_batch
        from items_prev o full outer join items_new n on o.client = n.client and o.file_id = n.file_id
        where o.batch_id is distinct from n.batch_id"""),
        ("diff_named", """select d.client, d.file_id,
          case when tn.file_id is not null or tp.file_id is not null
               then coalesce(case when tn.file_id is not null then tn.file_name else tp.file_name end, 'Unknown File')
               else 'Unknown File' end file_name,
          case when old_batch is not null and new_batch is not null then 'MOVED'
               when new_batch is not null then 'ADDED' else 'REMOVED' end op,
          old_batch, new_batch
        from diff d left join tasks_curr tn on tn.client = d.client and tn.file_id = d.file_id
        left join tasks_prev tp on tp.client = d.client and tp.file_id = d.file_id""")]

SQL = {
    "pack_batches": V("fx_client_folder", extra=PACK_ALL) + "select * from items_all",
    "repack_batches": _sv(scenario_ctes()) + "select * from items_new",
    "repack_batches_strict": _sv(scenario_ctes(strict=True)) + "select * from items_new",
    "retain_batches": _sv(scenario_ctes()) + """select client, batch_pos, batch_id, item_pos, file_id,
        size, fmt from retained""",
    "plan_new_ids": _sv(scenario_ctes()) + """select client, file_id from act_curr a where not exists
        (select 1 from tasks_prev p where p.client = a.client and p.file_id = a.file_id)""",
    "plan_deleted_ids": _sv(scenario_ctes()) + """select client, file_id from tasks_prev p where not exists
        (select 1 from act_curr a where p.client = a.client and p.file_id = a.file_id)""",
    "oversize_batches": _sv(scenario_ctes()) + f"""select client, fmt, batch_id, load from loads
        where load > {LIMIT}""",
    "batch_totals": _sv(scenario_ctes()) + """select client, fmt, batch_pos, batch_id,
        sum(size)::bigint total_bytes, count(*) n_files,
        round_even(sum(size) / 1048576.0, 2)::double total_size_mb
        from items_new group by client, fmt, batch_pos, batch_id""",
    "assemble_plan": V("fx_client_folder", extra=PACK_ALL) + """select client, fmt, batch_pos, batch_id,
        round_even(sum(size) / 1048576.0, 2)::double total_size_mb, count(*) n_tasks,
        list(file_id order by item_pos) source_tasks
        from items_all group by client, fmt, batch_pos, batch_id""",
    "flatten_plan": V("fx_client_folder", extra=PACK_ALL) + """select i.client, i.fmt, i.batch_pos, i.batch_id,
        (row_number() over (partition by i.client, i.fmt, i.batch_pos order by i.item_pos) - 1)::int item_pos,
        i.file_id, t.file_name, t.task_type
        from items_all i left join tasks_all t on t.client = i.client and t.file_id = i.file_id""",
    "plan_diff": _sv(scenario_ctes() + DIFF) + "select * from diff_named",
    "plan_diff_text": _sv(scenario_ctes() + DIFF) + f"""
        select distinct client, 0 ord, '' file_id,
          'Cumulative plan changes for client: ' || client || ' at {GENERATED_AT}' || chr(10) line
        from diff_named
        union all
        select client, 1, file_id,
          case op when 'MOVED' then 'MOVED: ''' || file_name || ''' (ID: ' || file_id || ') moved from '
                                    || old_batch || ' to ' || new_batch || '.'
                  when 'ADDED' then 'ADDED: ''' || file_name || ''' (ID: ' || file_id || ') was added to '
                                    || new_batch || '.'
                  else 'REMOVED: ''' || file_name || ''' (ID: ' || file_id || ') was removed from '
                       || old_batch || '.' end
        from diff_named""",
    "output_names": _sv(scenario_ctes()) + """select client, fmt, batch_id,
        row_number() over (partition by client, fmt order by batch_pos) ordinal,
        replace(client, ' ', '_') || '_batch_' || row_number() over (partition by client, fmt order by batch_pos)
          || '.' || fmt output_name
        from (select distinct client, fmt, batch_pos, batch_id from items_new)""",
}
