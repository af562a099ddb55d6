"""Test views derived from the given tables (FIXTURES.md section 2).

The tree is ROOT / region / nation / customer / order: regions act as the
status folders, nations as client folders (every 4th renamed ``GRUPO ...``),
customers as sub-folders and orders as files of several mime types.

Each builder reads the parquet tables with Spark so the work grows with the
scale factor. ``SQL`` holds the same views as DuckDB CTE text for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.session import FOLDER_MIME

ROOT_ID = "root"
ROOT_NAME = "ROOT"
# The two status folders whose children are client folders.
STATUS_FOLDERS = ("AFRICA", "ASIA")
PREV_CUTOFF = "2001-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_ORDER_MIMES = [
    (0, "application/pdf"), (1, "application/pdf"), (2, "text/plain"), (3, "text/markdown"),
    (4, "audio/mpeg"),
    (5, "application/vnd.openxmlformats-officedocument.wordprocessingml.document"),
    (6, "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet"),
    (7, "image/png"), (8, "application/vnd.google-apps.document"),
]


def _order_mime(key):
    expr = None
    for k, mime in _ORDER_MIMES:
        cond = (key % 10) == k
        expr = F.when(cond, mime) if expr is None else expr.when(cond, mime)
    return expr.otherwise("application/zip")


def fx_node(spark: SparkSession, sf_dir: str, gen: str = "all") -> DataFrame:
    """Tree nodes ``id, parent_id, name, mime_type, size, ts`` of one generation.

    ``gen``: ``all``; ``prev`` = rows without time or older than 2001;
    ``curr`` = all rows except orders whose key is a multiple of 97.
    """
    folder = F.lit(FOLDER_MIME)
    null_l = F.lit(None).cast("bigint")
    null_t = F.lit(None).cast("timestamp_ntz")
    null_k = F.lit(None).cast("bigint")
    root = spark.range(1).select(
        F.lit(ROOT_ID).alias("id"), F.lit(None).cast("string").alias("parent_id"),
        F.lit(ROOT_NAME).alias("name"), folder.alias("mime_type"), null_l.alias("size"),
        null_t.alias("ts"), null_k.alias("_okey"))
    region = table(spark, sf_dir, "region").select(
        F.concat(F.lit("r"), "r_regionkey").alias("id"), F.lit(ROOT_ID).alias("parent_id"),
        F.col("r_name").alias("name"), folder.alias("mime_type"), null_l.alias("size"),
        null_t.alias("ts"), null_k.alias("_okey"))
    nation = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("n"), "n_nationkey").alias("id"),
        F.concat(F.lit("r"), "n_regionkey").alias("parent_id"),
        F.when(F.col("n_nationkey") % 4 == 0, F.concat(F.lit("GRUPO "), "n_name"))
        .otherwise(F.col("n_name")).alias("name"),
        folder.alias("mime_type"), null_l.alias("size"), null_t.alias("ts"), null_k.alias("_okey"))
    customer = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("c"), "c_custkey").alias("id"),
        F.concat(F.lit("n"), "c_nationkey").alias("parent_id"),
        F.col("c_name").alias("name"), folder.alias("mime_type"), null_l.alias("size"),
        null_t.alias("ts"), null_k.alias("_okey"))
    k = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("o"), k).alias("id"), F.concat(F.lit("c"), "o_custkey").alias("parent_id"),
        F.concat(F.lit("order_"), k).alias("name"), _order_mime(k).alias("mime_type"),
        F.when(k % 10 == 8, null_l).otherwise(F.floor("o_totalprice") * 400).alias("size"),
        F.col("o_orderdate").alias("ts"), k.alias("_okey"))
    nodes = root.unionByName(region).unionByName(nation).unionByName(customer).unionByName(orders)
    if gen == "prev":
        nodes = nodes.where(F.col("ts").isNull() | (F.col("ts") < F.lit(PREV_CUTOFF).cast("timestamp")))
    elif gen == "curr":
        nodes = nodes.where(F.col("_okey").isNull() | (F.col("_okey") % 97 != 0))
    elif gen != "all":
        raise ValueError(f"unknown generation {gen!r}")
    return nodes.drop("_okey")


def fx_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered change feed derived from ``events`` (flat form)."""
    e = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        e.alias("seq"), F.col("ts").cast("date").alias("batch_day"),
        F.when(e % 997 == 0, "drive").otherwise("file").alias("change_type"),
        F.concat(F.lit("o"), "user_id").alias("file_id"),
        (F.col("event_type") == "error").alias("removed"),
        F.when(e % 499 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("c"), "user_id")).alias("parent_id"),
        F.concat(F.lit("order_"), "user_id", F.lit("_v"), e).alias("name"),
        F.lit("application/pdf").alias("mime_type"),
        (F.floor("value") * 100000).alias("size"), F.col("ts"))


def fx_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-string report; the 4th column holds free-text client names."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    m = F.col("c_custkey") % 4
    return c.join(n, F.col("n_nationkey") == F.col("c_nationkey")).select(
        F.col("c_custkey").cast("string").alias("row_id"), F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").cast("string").alias("code"),
        F.when(m == 0, F.col("n_name"))
        .when(m == 1, F.concat(F.lit("  "), "n_name", F.lit(" ")))
        .when(m == 2, F.concat(F.lower("n_name"), F.lit(" LTDA")))
        .otherwise(F.lit("")).alias("client"))


def fx_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model response per nation; every 10th has no fenced JSON block."""
    n = table(spark, sf_dir, "nation")
    body = F.concat(
        F.lit("Here it is: ```json\n{\"consolidation_map\": {\""), F.col("n_name"), F.lit("\": \"M_"),
        F.col("n_regionkey").cast("string"), F.lit("\"}, \"match_map\": {\"M_"),
        F.col("n_regionkey").cast("string"), F.lit("\": [\""), F.col("n_name"),
        F.lit("\", \"missing\"]}}\n``` done"))
    return n.select(F.col("n_nationkey").alias("batch_no"),
                    F.when(F.col("n_nationkey") % 10 == 9, F.lit("no json here"))
                    .otherwise(body).alias("response"))


def fx_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracted text per file."""
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("o"), "doc_id").alias("file_id"), F.col("doc_id").alias("pos"), "text")


def fx_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named files with modification time and trash flag."""
    k = F.col("o_orderkey")
    m = k % 5
    name = (F.when(m == 0, F.concat(F.lit("report_"), k, F.lit(".xlsx")))
            .when(m == 1, F.concat(F.lit("k"), k, F.lit("_plan.json")))
            .when(m == 2, F.concat(F.lit("k"), k, F.lit("_plan_last_run.json")))
            .when(m == 3, F.concat(F.lit("k"), k, F.lit("_plan_last_processed.json")))
            .otherwise(F.lit("drive_scan.jsonl")))
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("f"), k).alias("id"), F.concat(F.lit("c"), "o_custkey").alias("parent_id"),
        name.alias("name"), F.col("o_orderdate").alias("mtime"), (k % 11 == 0).alias("trashed"))


_LETTERS = ("0123456789abcdef", "ABCDEFGHIJKLMNOP")


def fx_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company names that grow with the customers, most with a long common ending; every
    fourth is the name of the customer before it with typing mistakes."""
    k = F.col("c_custkey")
    base = F.when(k % 4 == 3, k - 1).otherwise(k)
    letters = F.translate(F.substring(F.md5(base.cast("string")), 1, 8), *_LETTERS)
    ending = F.when(base % 3 == 0, " COMERCIO DE ALIMENTOS LTDA").when(base % 3 == 1, " INDUSTRIA E COMERCIO S/A").otherwise(" SERVICOS")
    name = F.concat(letters, ending)
    typo = F.when(k % 12 == 3, F.concat(F.substring(name, 1, 3), F.substring(name, 5, 100))) \
        .when(k % 12 == 7, F.concat(F.substring(name, 1, 5), F.lit("Z"), F.substring(name, 6, 100))) \
        .otherwise(F.concat(F.lower(F.substring(name, 1, 1)), F.lit("X"), F.substring(name, 3, 100)))
    return table(spark, sf_dir, "customer").select(k.alias("ord"), F.when(k % 4 == 3, typo).otherwise(name).alias("name"))


def fx_folder_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of folders (customers move, are renamed or removed, now and then a nation)
    among changes of files, none of which asks for a re-walk."""
    e, u = F.col("event_id"), F.col("user_id")
    folder = F.lit(FOLDER_MIME)
    events = table(spark, sf_dir, "events")
    null_s = F.lit(None).cast("string")
    customers = events.where(e % 23 == 3).select(
        e.alias("seq"), F.concat(F.lit("c"), u).alias("file_id"), (e % 5 == 0).alias("removed"),
        F.concat(F.lit("n"), e % 25).alias("parent_id"), F.concat(F.lit("moved_"), e).alias("name"), folder.alias("mime_type"),
        F.lit(None).cast("bigint").alias("size"))
    nations = events.where(e % 1511 == 11).select(
        e.alias("seq"), F.concat(F.lit("n"), e % 25).alias("file_id"), F.lit(False).alias("removed"),
        F.concat(F.lit("r"), e % 5).alias("parent_id"), F.concat(F.lit("nation_"), e).alias("name"), folder.alias("mime_type"),
        F.lit(None).cast("bigint").alias("size"))
    files = events.where((e % 23 != 3) & (e % 1511 != 11)).select(
        e.alias("seq"), F.concat(F.lit("o"), u).alias("file_id"), (F.col("event_type") == "error").alias("removed"),
        F.concat(F.lit("c"), u).alias("parent_id"), F.concat(F.lit("order_"), u, F.lit("_v"), e).alias("name"),
        F.lit("application/pdf").alias("mime_type"), (F.floor("value") * 100000).alias("size"))
    return customers.unionByName(nations).unionByName(files).withColumn("change_type", F.lit("file")) \
        .withColumn("parent_id", F.when(F.col("removed"), null_s).otherwise(F.col("parent_id")))


# ---------------------------------------------------------------------------
# DuckDB text of the same views, for oracle_sql().
# ---------------------------------------------------------------------------

_NODE_SQL = """
  select 'root' id, cast(null as varchar) parent_id, 'ROOT' name,
         'application/vnd.google-apps.folder' mime_type, cast(null as bigint) size,
         cast(null as timestamp) ts, cast(null as bigint) okey
  union all select concat('r', r_regionkey), 'root', r_name, 'application/vnd.google-apps.folder',
         null, null, null from region
  union all select concat('n', n_nationkey), concat('r', n_regionkey),
         case when n_nationkey % 4 = 0 then concat('GRUPO ', n_name) else n_name end,
         'application/vnd.google-apps.folder', null, null, null from nation
  union all select concat('c', c_custkey), concat('n', c_nationkey), c_name,
         'application/vnd.google-apps.folder', null, null, null from customer
  union all select concat('o', o_orderkey), concat('c', o_custkey), concat('order_', o_orderkey),
         case o_orderkey % 10 when 0 then 'application/pdf' when 1 then 'application/pdf'
           when 2 then 'text/plain' when 3 then 'text/markdown' when 4 then 'audio/mpeg'
           when 5 then 'application/vnd.openxmlformats-officedocument.wordprocessingml.document'
           when 6 then 'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet'
           when 7 then 'image/png' when 8 then 'application/vnd.google-apps.document'
           else 'application/zip' end,
         case when o_orderkey % 10 = 8 then null else cast(floor(o_totalprice) as bigint) * 400 end,
         o_orderdate, o_orderkey
  from orders"""

_GEN_FILTER = {
    "all": "true",
    "prev": "ts is null or ts < timestamp '2001-01-01'",
    "curr": "okey is null or okey % 97 <> 0",
}

SQL_VIEWS = {
    "fx_change": """
  select event_id seq, cast(ts as date) batch_day,
         case when event_id % 997 = 0 then 'drive' else 'file' end change_type,
         concat('o', user_id) file_id, event_type = 'error' removed,
         case when event_id % 499 = 0 then null else concat('c', user_id) end parent_id,
         concat('order_', user_id, '_v', event_id) name, 'application/pdf' mime_type,
         cast(floor(value) as bigint) * 100000 size, ts
  from events""",
    "fx_report": """
  select cast(c_custkey as varchar) row_id, c_mktsegment segment, cast(c_nationkey as varchar) code,
         case c_custkey % 4 when 0 then n_name when 1 then concat('  ', n_name, ' ')
              when 2 then concat(lower(n_name), ' LTDA') else '' end client
  from customer join nation on n_nationkey = c_nationkey""",
    "fx_response": """
  select n_nationkey batch_no,
         case when n_nationkey % 10 = 9 then 'no json here' else
           concat('Here it is: ```json', chr(10), '{"consolidation_map": {"', n_name, '": "M_',
                  n_regionkey, '"}, "match_map": {"M_', n_regionkey, '": ["', n_name,
                  '", "missing"]}}', chr(10), '``` done') end response
  from nation""",
    "fx_company": """
  select c_custkey ord, case when c_custkey % 4 <> 3 then name when c_custkey % 12 = 3 then substr(name, 1, 3) || substr(name, 5, 100)
         when c_custkey % 12 = 7 then substr(name, 1, 5) || 'Z' || substr(name, 6, 100)
         else lower(substr(name, 1, 1)) || 'X' || substr(name, 3, 100) end name
  from (select c_custkey, translate(substr(md5(cast(b as varchar)), 1, 8), '0123456789abcdef', 'ABCDEFGHIJKLMNOP')
           || case b % 3 when 0 then ' COMERCIO DE ALIMENTOS LTDA' when 1 then ' INDUSTRIA E COMERCIO S/A' else ' SERVICOS' end name
        from (select c_custkey, case when c_custkey % 4 = 3 then c_custkey - 1 else c_custkey end b from customer))""",
    "fx_folder_change": """
  select event_id seq, concat('c', user_id) file_id, event_id % 5 = 0 removed,
         case when event_id % 5 = 0 then null else concat('n', event_id % 25) end parent_id, concat('moved_', event_id) name,
         'application/vnd.google-apps.folder' mime_type, null::bigint size from events where event_id % 23 = 3
  union all select event_id, concat('n', event_id % 25), false, concat('r', event_id % 5), concat('nation_', event_id),
         'application/vnd.google-apps.folder', null from events where event_id % 1511 = 11
  union all select event_id, concat('o', user_id), event_type = 'error', case when event_type = 'error' then null else concat('c', user_id) end,
         concat('order_', user_id, '_v', event_id), 'application/pdf', cast(floor(value) as bigint) * 100000
  from events where event_id % 23 <> 3 and event_id % 1511 <> 11""",
    "fx_content": "select concat('o', doc_id) file_id, doc_id pos, text from documents",
    "fx_catalog": """
  select concat('f', o_orderkey) id, concat('c', o_custkey) parent_id,
         case o_orderkey % 5 when 0 then concat('report_', o_orderkey, '.xlsx')
           when 1 then concat('k', o_orderkey, '_plan.json')
           when 2 then concat('k', o_orderkey, '_plan_last_run.json')
           when 3 then concat('k', o_orderkey, '_plan_last_processed.json')
           else 'drive_scan.jsonl' end name,
         o_orderdate mtime, o_orderkey % 11 = 0 trashed
  from orders""",
}

for _g, _cond in _GEN_FILTER.items():
    _suffix = "" if _g == "all" else f"_{_g}"
    SQL_VIEWS[f"fx_node{_suffix}"] = (
        f"select id, parent_id, name, mime_type, size, ts from ({_NODE_SQL}) where {_cond}")
    SQL_VIEWS[f"fx_walk{_suffix}"] = f"""
  select id, name path, -1 indent from fx_node{_suffix} where id = 'root'
  union all
  select n.id, concat(w.path, '/', n.name), w.indent + 1
  from fx_node{_suffix} n join fx_walk{_suffix} w on n.parent_id = w.id
  where w.id in (select id from fx_node{_suffix}
                 where mime_type = 'application/vnd.google-apps.folder')"""
    SQL_VIEWS[f"fx_inventory{_suffix}"] = f"""
  select w.id, n.parent_id, n.name, n.mime_type, n.size, n.ts, w.path, w.indent
  from fx_walk{_suffix} w join fx_node{_suffix} n on n.id = w.id"""

# Client folders used by the planner fixtures: every candidate folder is a client.
for _g in ("", "_prev", "_curr"):
    SQL_VIEWS[f"fx_client_folder{_g}"] = f"""
  select name client, 0 pos, id folder_id, name folder_name, path folder_path
  from fx_inventory{_g}
  where indent = 1 and mime_type = 'application/vnd.google-apps.folder'
    and (starts_with(path, 'ROOT/AFRICA/') or starts_with(path, 'ROOT/ASIA/'))"""

_DEPS = {
    "fx_walk": ["fx_node"], "fx_inventory": ["fx_node", "fx_walk"],
    "fx_client_folder": ["fx_inventory"],
}


def _deps(name: str) -> list[str]:
    base = name
    suffix = ""
    for s in ("_prev", "_curr"):
        if name.endswith(s):
            base, suffix = name[: -len(s)], s
    out = []
    for d in _DEPS.get(base, []):
        for dd in _deps(d + suffix):
            if dd not in out:
                out.append(dd)
    if name not in out:
        out.append(name)
    return out


def with_views(*names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH RECURSIVE`` prelude defining the named views (and what they need)."""
    order: list[str] = []
    for n in names:
        for d in _deps(n):
            if d not in order:
                order.append(d)
    parts = [f"{n} as ({SQL_VIEWS[n]}\n)" for n in order]
    for n, body in extra or []:
        parts.append(f"{n} as ({body}\n)")
    if not parts:
        return ""
    return "with recursive " + ",\n".join(parts) + "\n"
