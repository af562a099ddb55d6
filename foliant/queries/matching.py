"""Matching: report names, request batches, answers, merges, roll-up and the
deterministic matcher."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliant import fixtures as fx
from foliant.operators import matching as M
from foliant.operators.tasks import client_candidates
from foliant.plans import matcher as MJ
from foliant.plans.fixture_runs import inventory
from foliant.session import scratch_dir

V = fx.with_views
SPLIT_BATCH = 12  # answers below this batch number form the previous run


def _report(spark, sf):
    return fx.fx_report(spark, sf).withColumn("ord", F.col("row_id").cast("long"))


def _names(spark, sf):
    return M.report_clients(_report(spark, sf), "ord")


def _folders(spark, sf):
    inv = inventory(spark, sf)
    return M.request_folders(inv, client_candidates(inv, fx.ROOT_NAME, fx.STATUS_FOLDERS))


def _parsed(spark, sf):
    return M.parse_responses(fx.fx_response(spark, sf))


def q_scan_report(spark, sf):
    path = scratch_dir(spark, "report-csv")
    opts = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    fx.fx_report(spark, sf).write.mode("overwrite").options(**opts).csv(path)
    schema = "row_id string, segment string, code string, client string"
    return spark.read.options(**opts).schema(schema).csv(path).na.fill("")


def q_report_clients(spark, sf):
    return _names(spark, sf)


def q_new_client_names(spark, sf):
    old = M.consolidation_entries(_parsed(spark, sf))
    return M.new_client_names(_names(spark, sf), old)


def q_name_batches(spark, sf):
    return M.name_batches(_names(spark, sf)).select("name", "ord", "idx", "batch_no")


def q_match_requests(spark, sf):
    return M.match_requests(M.name_batches(_names(spark, sf)))


def q_request_folder_lines(spark, sf):
    return M.request_folder_lines(_folders(spark, sf))


def _name_maps(spark, sf):
    entries = M.consolidation_entries(_parsed(spark, sf))
    old, new = entries.where(F.col("batch_no") < SPLIT_BATCH), entries.where(F.col("batch_no") >= SPLIT_BATCH)
    return tuple(M.merge_last_wins(e, "raw_name", "master", "batch_no") for e in (old, new))


def q_merge_name_map(spark, sf):
    old, new = _name_maps(spark, sf)
    return M.incremental_merge(old, new, "raw_name")


def q_matching_results(spark, sf):
    """The saved result of a matching run, read back: both maps as rows."""
    base = scratch_dir(spark, "matching-state")
    old, new = _name_maps(spark, sf)
    MJ.save_results(base, M.incremental_merge(old, new, "raw_name"), q_incremental_match(spark, sf))
    names, matches = MJ.read_results(spark, base)
    return names.select(F.lit("name").alias("kind"), F.col("raw_name").alias("key"), F.col("master").alias("value")).unionByName(
        matches.select(F.lit("folder").alias("kind"), F.col("client").alias("key"), F.col("folder_id").alias("value")))


def q_parse_responses(spark, sf):
    p = _parsed(spark, sf)
    return p.select("batch_no", "ok",
                    F.coalesce(F.size("parsed.consolidation_map"), F.lit(0)).alias("n_names"),
                    F.coalesce(F.size("parsed.match_map"), F.lit(0)).alias("n_masters")) \
        .withColumn("n_names", F.when(F.col("ok"), F.col("n_names")).otherwise(0)) \
        .withColumn("n_masters", F.when(F.col("ok"), F.col("n_masters")).otherwise(0))


def q_merge_match_maps(spark, sf):
    return M.merge_match_lists(M.match_entries(_parsed(spark, sf)))


def q_merge_last_wins(spark, sf):
    return M.merge_last_wins(M.consolidation_entries(_parsed(spark, sf)), "raw_name", "master", "batch_no")


def _customer_entries(spark, sf):
    """Answers that also list sub-folders: every customer folder under master M_<nation>."""
    return fx.table(spark, sf, "customer").select(
        F.concat(F.lit("M_"), F.col("c_nationkey").cast("string")).alias("master"),
        F.col("c_name").alias("folder_name"))


def _entries_with_subfolders(spark, sf):
    ans = M.match_entries(_parsed(spark, sf)).select("master", "folder_name")
    return ans.unionByName(_customer_entries(spark, sf))


def q_rollup_to_group(spark, sf):
    return M.rollup_to_group(_entries_with_subfolders(spark, sf), _folders(spark, sf))


def q_resolve_folders(spark, sf):
    folders = _folders(spark, sf)
    return M.resolve_folders(M.rollup_to_group(_entries_with_subfolders(spark, sf), folders), folders)


def q_incremental_match(spark, sf):
    folders = _folders(spark, sf)
    parsed = _parsed(spark, sf)
    ent = M.match_entries(parsed)
    old_e = ent.where(F.col("batch_no") < SPLIT_BATCH).select("master", "folder_name") \
        .unionByName(_customer_entries(spark, sf))
    new_e = ent.where(F.col("batch_no") >= SPLIT_BATCH).select("master", "folder_name")
    old = M.resolve_folders(M.rollup_to_group(old_e, folders), folders)
    new = M.resolve_folders(M.rollup_to_group(new_e, folders), folders)
    new_keys = M.match_masters(parsed).where(F.col("batch_no") >= SPLIT_BATCH).select(F.col("master").alias("client"))
    return M.incremental_merge(old, new, "client", new_keys)


def _norm_names(spark, sf):
    return M.normalize_names(_names(spark, sf), "name")


def _norm_folders(spark, sf):
    f = _folders(spark, sf).select(F.col("id").alias("folder_id"), F.col("name").alias("folder_name"),
                                   F.col("path").alias("folder_path"))
    return M.normalize_names(f, "folder_name")


def q_normalize_names(spark, sf):
    return _norm_names(spark, sf).select("name", "norm")


def q_match_pairs(spark, sf):
    return M.match_pairs(_norm_names(spark, sf), _norm_folders(spark, sf))


def q_match_best(spark, sf):
    return M.match_best(M.match_pairs(_norm_names(spark, sf), _norm_folders(spark, sf)))


def q_consolidate_names(spark, sf):
    return M.consolidate_names(_norm_names(spark, sf))


def q_matching_roundtrip(spark, sf):
    folders = _folders(spark, sf)
    res = M.client_folder_table(M.resolve_folders(
        M.rollup_to_group(_entries_with_subfolders(spark, sf), folders), folders))
    doc = res.groupBy("client").agg(F.array_sort(F.collect_list(F.struct(
        "pos", "folder_id", "folder_name", "folder_path"))).alias("folders"))
    path = scratch_dir(spark, "matching-results")
    doc.select(F.to_json(F.struct("client", "folders")).alias("value")).write.mode("overwrite").text(path)
    schema = "client string, folders array<struct<pos:int,folder_id:string,folder_name:string,folder_path:string>>"
    back = spark.read.text(path).select(F.from_json("value", schema).alias("d"))
    return back.select(F.col("d.client").alias("client"), F.explode("d.folders").alias("f")) \
        .select("client", "f.pos", "f.folder_id", "f.folder_name", "f.folder_path")


def _companies(spark, sf):
    # the names come from a small file: dealt out before they are cut and compared
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return M.normalize_names(fx.fx_company(spark, sf).repartition(n), "name")


def q_company_edges(spark, sf):
    return M.name_edges(_companies(spark, sf))


def q_consolidate_companies(spark, sf):
    return M.consolidate_names(_companies(spark, sf)).distinct()


QUERIES = {
    "scan_report": q_scan_report,
    "report_clients": q_report_clients,
    "new_client_names": q_new_client_names,
    "name_batches": q_name_batches,
    "match_requests": q_match_requests,
    "request_folder_lines": q_request_folder_lines,
    "merge_name_map": q_merge_name_map,
    "matching_results": q_matching_results,
    "parse_responses": q_parse_responses,
    "merge_match_maps": q_merge_match_maps,
    "merge_last_wins": q_merge_last_wins,
    "rollup_to_group": q_rollup_to_group,
    "resolve_folders": q_resolve_folders,
    "incremental_match": q_incremental_match,
    "normalize_names": q_normalize_names,
    "match_pairs": q_match_pairs,
    "match_best": q_match_best,
    "consolidate_names": q_consolidate_names,
    "matching_roundtrip": q_matching_roundtrip,
    "company_edges": q_company_edges,
    "consolidate_companies": q_consolidate_companies,
}

# --------------------------------------------------------------------------- SQL

# The characters that ``str.strip`` takes off, in DuckDB's pattern syntax.
_WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_NAMES = ("names", f"""select regexp_replace(client, '^{_WS}+|{_WS}+$', '', 'g') name, min(cast(row_id as bigint)) ord
    from fx_report where regexp_replace(client, '^{_WS}+|{_WS}+$', '', 'g') <> '' group by 1""")
_FOLDERS = [
    ("cand", """select * from fx_inventory where indent = 1
        and mime_type = 'application/vnd.google-apps.folder'
        and (starts_with(path, 'ROOT/AFRICA/') or starts_with(path, 'ROOT/ASIA/'))"""),
    ("req_folders", """select id, name, path, null::varchar group_name, path sa, 0 sb, path sc from cand
        union all
        select k.id, k.name, k.path, c.name, c.path, 1, k.path from fx_inventory k join cand c
          on k.parent_id = c.id
        where starts_with(upper(c.name), 'GRUPO') and k.mime_type = 'application/vnd.google-apps.folder'"""),
]
_PARSE = [
    ("blocks", r"""select batch_no, regexp_extract(response, '```json\s*([\s\S]+?)\s*```', 1) blk
        from fx_response"""),
    ("parsed", "select batch_no, blk::json j from blocks where blk <> '' and json_valid(blk)"),
    ("cons", """select batch_no, k raw_name, j -> 'consolidation_map' ->> k master
        from (select batch_no, j, unnest(json_keys(j, '$.consolidation_map')) k from parsed)"""),
    ("ment", """select batch_no, master, pos, folder_name from (
        select batch_no, master, generate_subscripts(arr, 1) - 1 pos, unnest(arr) folder_name from (
          select batch_no, k master, from_json(j -> 'match_map' -> k, '["VARCHAR"]') arr
          from (select batch_no, j, unnest(json_keys(j, '$.match_map')) k from parsed)))"""),
]
_ROLL = [
    ("sub", """select master, folder_name from ment union all
        select 'M_' || cast(c_nationkey as varchar), c_name from customer"""),
    ("child_map", """select name folder_name, arg_max(group_name, (sa, sb, sc)) group_name
        from req_folders where group_name is not null group by name"""),
    ("rolled", """select distinct s.master, coalesce(c.group_name, s.folder_name) folder_name
        from sub s left join child_map c on c.folder_name = s.folder_name"""),
    ("lookup", """select name folder_name, arg_max(id, (sa, sb, sc)) id, arg_max(path, (sa, sb, sc)) path
        from req_folders group by name"""),
    ("resolved", """select r.master client, l.id folder_id, r.folder_name, l.path folder_path
        from rolled r join lookup l on l.folder_name = r.folder_name"""),
]


def _norm_sql(src: str, col: str, extra_cols: str) -> str:
    up = f"translate(upper({col}), '{M.ACCENTS_FROM}', '{M.ACCENTS_TO}')"
    spaced = f"regexp_replace(' ' || regexp_replace({up}, '[^A-Z0-9]+', ' ', 'g') || ' ', ' S A ', ' ', 'g')"
    stops = ", ".join(f"'{t}'" for t in M.STOP_TOKENS)
    raw = f"regexp_replace({col}, '^{_WS}+|{_WS}+$', '', 'g')"
    toks = f"list_filter(string_split_regex(trim({spaced}), ' +'), lambda t: t <> '' and not list_contains([{stops}], t))"
    return f"""select {extra_cols}, list_sort(list_distinct(toks)) tokens, array_to_string(toks, ' ') norm
        from (select *, case when len({toks}) > 0 then {toks} else [{raw}] end toks from {src})
        where array_to_string(toks, ' ') <> ''"""


def _score_sql(a, b, ta, tb):
    return (f"greatest(1.0 - levenshtein({a}, {b})::double / greatest(length({a}), length({b}))::double, "
            f"len(list_intersect({ta}, {tb}))::double / len(list_distinct(list_concat({ta}, {tb})))::double)")


_MATCH = [
    _NAMES, *_FOLDERS,
    ("nn", _norm_sql("names", "name", "name")),
    ("nf", _norm_sql("(select id folder_id, name folder_name, path folder_path from req_folders)",
                     "folder_name", "folder_id, folder_name, folder_path")),
    # every name against every folder
    ("pairs", f"""select * from (select n.name, f.folder_id, f.folder_name, f.folder_path,
          {_score_sql('n.norm', 'f.norm', 'n.tokens', 'f.tokens')} score
        from nn n cross join nf f)
        where score * 100 >= {M.THRESHOLD_PCT} - 1e-9"""),
]

_CONS = [
    _NAMES,
    ("nn", _norm_sql("names", "name", "name")),
    ("u", "select distinct norm, tokens from nn"),
    ("e1", f"""select norm, other from (select a.norm, b.norm other,
          {_score_sql('a.norm', 'b.norm', 'a.tokens', 'b.tokens')} score
        from u a join u b on a.norm < b.norm)
        where score * 100 >= {M.THRESHOLD_PCT} - 1e-9"""),
    ("edges", "select norm, other from e1 union all select other, norm from e1"),
    ("reach", """select norm, norm label from u
        union select e.other, r.label from reach r join edges e on e.norm = r.norm"""),
    ("labels", "select norm, min(label) label from reach group by norm"),
]

_COMPANIES = [("nn", _norm_sql("fx_company", "name", "name")), *_CONS[2:]]

SQL = {
    "scan_report": V("fx_report") + "select * from fx_report",
    "report_clients": V("fx_report", extra=[_NAMES]) + "select * from names",
    "new_client_names": V("fx_report", "fx_response", extra=[_NAMES, *_PARSE]) + """
        select * from names where name not in (select raw_name from cons)""",
    "name_batches": V("fx_report", extra=[_NAMES]) + """select name, ord,
        row_number() over (order by ord, name) - 1 idx,
        (row_number() over (order by ord, name) - 1) // 100 batch_no from names""",
    "request_folder_lines": V("fx_inventory", extra=_FOLDERS) + """
        select row_number() over (order by sa, sb, sc, id) - 1 pos, '- ' || name line from req_folders""",
    "merge_name_map": V("fx_response", extra=_PARSE) + """select raw_name, arg_max(master, batch_no) master
        from cons group by raw_name""",
    "match_requests": V("fx_report", extra=[_NAMES]) + """
        select batch_no, count(*) n_names,
          string_agg('- ' || name, chr(10) order by idx) names_block
        from (select name, row_number() over (order by ord, name) - 1 idx,
                (row_number() over (order by ord, name) - 1) // 100 batch_no from names)
        group by batch_no""",
    "parse_responses": V("fx_response", extra=_PARSE) + """
        select b.batch_no, p.batch_no is not null ok,
          coalesce(len(json_keys(p.j, '$.consolidation_map')), 0)::int n_names,
          coalesce(len(json_keys(p.j, '$.match_map')), 0)::int n_masters
        from blocks b left join parsed p using (batch_no)""",
    "merge_match_maps": V("fx_response", extra=_PARSE) + "select master, batch_no, pos::int pos, folder_name from ment",
    "merge_last_wins": V("fx_response", extra=_PARSE) + """select raw_name, arg_max(master, batch_no) master
        from cons group by raw_name""",
    "rollup_to_group": V("fx_response", "fx_inventory", extra=[*_PARSE, *_FOLDERS, *_ROLL]) +
    "select master, folder_name from rolled",
    "resolve_folders": V("fx_response", "fx_inventory", extra=[*_PARSE, *_FOLDERS, *_ROLL]) +
    "select * from resolved",
    "incremental_match": V("fx_response", "fx_inventory", extra=[*_PARSE, *_FOLDERS, *_ROLL[:1],
        ("old_e", f"""select master, folder_name from ment where batch_no < {SPLIT_BATCH}
            union all select 'M_' || cast(c_nationkey as varchar), c_name from customer"""),
        ("new_e", f"select master, folder_name from ment where batch_no >= {SPLIT_BATCH}"),
        ("new_m", f"""select k master from (select batch_no, unnest(json_keys(j, '$.match_map')) k from parsed)
            where batch_no >= {SPLIT_BATCH}"""),
        *_ROLL[1:2], *_ROLL[3:4],
        ("res_old", """select r.master client, l.id folder_id, r.folder_name, l.path folder_path from
            (select distinct s.master, coalesce(c.group_name, s.folder_name) folder_name
             from old_e s left join child_map c on c.folder_name = s.folder_name) r
            join lookup l on l.folder_name = r.folder_name"""),
        ("res_new", """select r.master client, l.id folder_id, r.folder_name, l.path folder_path from
            (select distinct s.master, coalesce(c.group_name, s.folder_name) folder_name
             from new_e s left join child_map c on c.folder_name = s.folder_name) r
            join lookup l on l.folder_name = r.folder_name""")]) + """
        select * from res_old where client not in (select master from new_m)
        union all select * from res_new""",
    "normalize_names": V("fx_report", extra=[_NAMES, ("nn", _norm_sql("names", "name", "name"))]) +
    "select name, norm from nn",
    "match_pairs": V("fx_report", "fx_inventory", extra=_MATCH) + "select * from pairs",
    "match_best": V("fx_report", "fx_inventory", extra=_MATCH) + """select p.* from pairs p
        join (select name, max(score) best from pairs group by name) b
        on b.name = p.name and p.score = b.best""",
    "consolidate_names": V("fx_report", extra=_CONS) + """select n.name, l.label master
        from nn n join labels l using (norm)""",
    "matching_roundtrip": V("fx_response", "fx_inventory", extra=[*_PARSE, *_FOLDERS, *_ROLL]) + """
        select client, (row_number() over (partition by client order by folder_path, folder_id) - 1)::int pos,
          folder_id, folder_name, folder_path from resolved""",
}

SQL["company_edges"] = V("fx_company", extra=_COMPANIES[:3]) + "select * from e1"
SQL["consolidate_companies"] = V("fx_company", extra=_COMPANIES) + "select distinct n.name, l.label master from nn n join labels l using (norm)"

_INCREMENTAL = SQL["incremental_match"]
_HEAD, _TAIL = _INCREMENTAL[:_INCREMENTAL.rindex("select * from res_old")], _INCREMENTAL[_INCREMENTAL.rindex("select * from res_old"):]
SQL["matching_results"] = _HEAD + f"""select 'name' kind, raw_name "key", arg_max(master, batch_no) "value" from cons group by raw_name
    union all select 'folder', client, folder_id from ({_TAIL})"""
