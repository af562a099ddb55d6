"""Assembly: contents per task, ordered batch texts, manifests, processor job."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliant import fixtures as fx
from foliant.operators import assembly as A
from foliant.operators import packing as P
from foliant.operators import plandiff as D
from foliant.operators import plandoc as PD
from foliant.plans.fixture_runs import client_folders, inventory, tasks_for
from foliant.plans.processor import process_all, read_outputs
from foliant.queries.planning import GENERATED_AT, PACK_ALL
from foliant.schemas import BATCH_ITEM
from foliant.session import materialize, scratch_dir
from foliant.sources import files as FL
from foliant.sources import store as ST

V = fx.with_views
TEXT_FOLDERS = 512


def _plan(spark, sf):
    tasks = tasks_for(spark, sf)
    items = materialize(P.pack_batches(tasks))
    return tasks, items, fx.fx_content(spark, sf)


def q_resolve_contents(spark, sf):
    tasks, _, ext = _plan(spark, sf)
    return A.resolve_contents(tasks, ext).select("client", "file_id", "task_type", "has_output",
                                                 F.length("text").alias("n_chars"))


def q_missing_outputs(spark, sf):
    tasks, _, ext = _plan(spark, sf)
    return A.missing_outputs(tasks, ext).select("client", "file_id", "task_type")


def q_batch_contents(spark, sf):
    tasks, items, ext = _plan(spark, sf)
    return A.batch_contents(items, ext, tasks).select(
        "client", "fmt", "batch_id", "batch_pos", "item_pos", "file_id", "file_name",
        F.length("text").alias("n_chars"))


def q_concat_texts(spark, sf):
    tasks, items, ext = _plan(spark, sf)
    contents = A.batch_contents(items, ext, tasks)
    return A.concat_texts(contents, D.output_names(items)).select(
        "client", "fmt", "batch_id", "output_name", "n_items", "text")


def q_batch_manifest(spark, sf):
    tasks, items, ext = _plan(spark, sf)
    return A.batch_manifest(A.batch_contents(items, ext, tasks), D.output_names(items))


def q_drop_empty_outputs(spark, sf):
    ext = fx.fx_content(spark, sf)
    return A.drop_empty_outputs(ext).select("file_id", F.length("text").alias("n_chars"))


def _fragments(spark, sf):
    return fx.fx_content(spark, sf).select("file_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "text"))


def q_join_fragments(spark, sf):
    return A.join_fragments(_fragments(spark, sf), "paragraphs")


def q_join_fragments_pages(spark, sf):
    return A.join_fragments(_fragments(spark, sf), "pages")


def q_read_text_lenient(spark, sf):
    docs = fx.table(spark, sf, "documents")
    bad = F.when(F.col("doc_id") % 7 == 0, F.unhex(F.lit("FF"))).otherwise(F.unhex(F.lit("")))
    raw = docs.select(F.concat(F.lit("o"), "doc_id").alias("file_id"),
                      F.concat(F.encode("text", "UTF-8"), bad, F.encode(F.lit(" tail"), "UTF-8")).alias("content"))
    return raw.select("file_id", A.decode_lenient("content").alias("text"))


def q_read_text_files(spark, sf):
    """Texts written as files, dealt over folders so that tasks can list them, and read back whole."""
    path = scratch_dir(spark, "text-files")
    folder = F.pmod(F.xxhash64("file_id"), F.lit(TEXT_FOLDERS)).cast("string")
    docs = fx.fx_content(spark, sf).select(F.concat(folder, F.lit("/"), "file_id", F.lit(".txt")).alias("target"), F.lit(0).alias("n"), "text")
    FL.write_named_files(docs, path, "target", ["n"], "text")
    return A.read_text_lenient(spark, path).select(F.regexp_extract("path", r"([^/]+)\.txt$", 1).alias("file_id"), "text")


def q_process_all(spark, sf):
    tasks, items, ext = _plan(spark, sf)
    out = scratch_dir(spark, "outputs")
    plans = scratch_dir(spark, "plans")
    schema = BATCH_ITEM.add("version", "string")
    ST.replace_partitions(items.withColumn("version", F.lit("current")), plans, ["version", "client"])
    process_all(spark, items, tasks, ext, out, on_missing="skip", plans_path=plans, plan_schema=schema)
    return read_outputs(spark, out)


def q_plan_roundtrip(spark, sf):
    tasks, items, _ = _plan(spark, sf)
    nested = D.assemble_batches(items, tasks.drop("size"))
    path = scratch_dir(spark, "plan-json")
    nested.select("client", F.to_json(F.struct("fmt", "batch_pos", "batch_id", "total_size_mb",
                                               "source_tasks")).alias("value")) \
        .write.mode("overwrite").partitionBy("client").text(path)
    schema = ("fmt string, batch_pos long, batch_id string, total_size_mb double, "
              "source_tasks array<struct<file_id:string,file_name:string,file_path:string,"
              "drive_link:string,mime_type:string,task_type:string,output_format:string>>")
    back = spark.read.text(path).select("client", F.from_json("value", schema).alias("b"))
    flat = D.flatten_plan(back.select("client", "b.*"))
    return flat.select("client", "fmt", "batch_id", "item_pos", F.col("task.file_id").alias("file_id"),
                       F.col("task.file_name").alias("file_name"))


def q_named_outputs(spark, sf):
    """The batch texts as named files, read back: name, size and digest of each."""
    tasks, items, ext = _plan(spark, sf)
    pieces = A.batch_pieces(A.batch_contents(items, ext, tasks), D.output_names(items))
    path = scratch_dir(spark, "named")
    A.write_named_outputs(pieces, path)
    return A.read_named_outputs(spark, path).select("client", "output_name", F.length("content").cast("long").alias("n_bytes"),
                                                    F.sha2("content", 256).alias("digest"))


def _document(spark, sf):
    tasks, items, _ = _plan(spark, sf)
    folders = client_folders(inventory(spark, sf))
    rows = PD.plan_fragments(folders, tasks, items, GENERATED_AT)
    path = scratch_dir(spark, "plan-document")
    rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def q_plan_document(spark, sf):
    """The batch members of the plan documents, read back record by record."""
    return PD.read_batches(_document(spark, sf)).drop("client_master_name")


def q_plan_document_tasks(spark, sf):
    return PD.read_tasks(_document(spark, sf))


QUERIES = {
    "resolve_contents": q_resolve_contents,
    "missing_outputs": q_missing_outputs,
    "batch_contents": q_batch_contents,
    "concat_texts": q_concat_texts,
    "batch_manifest": q_batch_manifest,
    "drop_empty_outputs": q_drop_empty_outputs,
    "join_fragments": q_join_fragments,
    "join_fragments_pages": q_join_fragments_pages,
    "read_text_lenient": q_read_text_lenient,
    "read_text_files": q_read_text_files,
    "process_all": q_process_all,
    "plan_roundtrip": q_plan_roundtrip,
    "named_outputs": q_named_outputs,
    "plan_document": q_plan_document,
    "plan_document_tasks": q_plan_document_tasks,
}

_NAMES = ("names", """select client, fmt, batch_id,
    replace(client, ' ', '_') || '_batch_' || row_number() over (partition by client, fmt order by batch_pos)
      || '.' || fmt output_name
    from (select distinct client, fmt, batch_pos, batch_id from items_all)""")
_CONTENTS = ("contents", """select i.*, c.text, t.file_name, t.file_path, t.drive_link from items_all i
    join fx_content c on c.file_id = i.file_id
    left join tasks_all t on t.client = i.client and t.file_id = i.file_id""")
_BASE = V("fx_client_folder", "fx_content", extra=[*PACK_ALL, _NAMES, _CONTENTS])
_PIECE = ("chr(10) || '--- START OF ' || file_name || ' ---' || chr(10) || text || chr(10) || '--- END OF ' "
          "|| file_name || ' ---' || chr(10) || chr(10)")
_CONCAT = f"""select c.client, c.fmt, c.batch_id, n.output_name, count(*) n_items,
        string_agg({_PIECE}, '' order by item_pos) text
        from contents c join names n using (client, fmt, batch_id) where c.fmt = 'txt'
        group by c.client, c.fmt, c.batch_id, n.output_name"""

SQL = {
    "resolve_contents": _BASE + """select t.client, t.file_id, t.task_type, c.file_id is not null has_output,
        length(c.text)::int n_chars from tasks_all t left join fx_content c on c.file_id = t.file_id
        where t.task_type <> 'IGNORE'""",
    "missing_outputs": _BASE + """select client, file_id, task_type from tasks_all t where task_type <> 'IGNORE'
        and not exists (select 1 from fx_content c where c.file_id = t.file_id)""",
    "batch_contents": _BASE + """select client, fmt, batch_id, batch_pos, item_pos, file_id, file_name,
        length(text)::int n_chars from contents""",
    "concat_texts": _BASE + _CONCAT,
    "batch_manifest": _BASE + """select c.client, n.output_name, c.batch_id, c.item_pos, c.file_id,
        'Source Path: ' || c.file_path header_path, 'Source URL: ' || c.drive_link header_url
        from contents c join names n using (client, fmt, batch_id) where c.fmt in ('pdf', 'mp3')""",
    "drop_empty_outputs": V("fx_content") + """select file_id, length(text)::int n_chars from fx_content
        where text is not null and length(text) > 0""",
    "join_fragments": V("fx_content") + """select file_id, string_agg(t, chr(10) order by pos) text from (
        select file_id, unnest(string_split(text, chr(10))) t, generate_subscripts(string_split(text, chr(10)), 1) pos
        from fx_content) group by file_id""",
    "join_fragments_pages": V("fx_content") + """select file_id, string_agg(t, '' order by pos) text from (
        select file_id, unnest(string_split(text, chr(10))) t, generate_subscripts(string_split(text, chr(10)), 1) pos
        from fx_content) group by file_id""",
    "read_text_lenient": "select 'o' || doc_id file_id, text || ' tail' text from documents",
    "process_all": _BASE + f"select client, output_name, text from ({_CONCAT})",
    "plan_roundtrip": _BASE + """select i.client, i.fmt, i.batch_id, i.item_pos::int item_pos, i.file_id, t.file_name
        from items_all i left join tasks_all t on t.client = i.client and t.file_id = i.file_id""",
}
SQL["named_outputs"] = _BASE + f"""select client, output_name, octet_length(encode(text))::bigint n_bytes, sha256(text) digest from ({_CONCAT})"""
_TASK_SQL = """t.file_id source_file_id, t.file_name source_file_name, t.file_path source_file_path, t.drive_link,
    t.mime_type input_mime_type, t.size estimated_size_bytes, t.task_type, t.output_format"""
SQL["plan_document"] = _BASE + f"""select i.client, i.fmt, i.batch_pos, i.item_pos, {_TASK_SQL}
    from items_all i left join tasks_all t on t.client = i.client and t.file_id = i.file_id"""
SQL["plan_document_tasks"] = _BASE + f"select t.client client_master_name, {_TASK_SQL} from tasks_all t"
SQL["read_text_files"] = V("fx_content") + "select file_id, coalesce(text, '') as text from fx_content"
