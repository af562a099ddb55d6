"""Explicit schemas of the entities (never inferred)."""

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()
I = T.IntegerType()

# Inventory line as stored by a scan: Drive fields plus derived path/indent.
INVENTORY = T.StructType([
    T.StructField("id", S, False),
    T.StructField("name", S, True),
    T.StructField("mime_type", S, True),
    T.StructField("size", L, True),
    T.StructField("parents", T.ArrayType(S), True),
    T.StructField("path", S, True),
    T.StructField("indent", I, True),
])

# Inventory as JSON lines from the listener (size is a decimal string there).
INVENTORY_JSON = T.StructType([
    T.StructField("id", S, True),
    T.StructField("name", S, True),
    T.StructField("mimeType", S, True),
    T.StructField("size", S, True),
    T.StructField("parents", T.ArrayType(S), True),
    T.StructField("path", S, True),
    T.StructField("indent", I, True),
])

# Tree node before traversal: one parent per node (first parent only).
NODE = T.StructType([
    T.StructField("id", S, False),
    T.StructField("parent_id", S, True),
    T.StructField("name", S, True),
    T.StructField("mime_type", S, True),
    T.StructField("size", L, True),
    T.StructField("ts", T.TimestampType(), True),
])

CHANGE_FILE = T.StructType([
    T.StructField("parents", T.ArrayType(S), True),
    T.StructField("name", S, True),
    T.StructField("mime_type", S, True),
    T.StructField("size", L, True),
])

# Ordered change feed record.
CHANGE = T.StructType([
    T.StructField("seq", L, False),
    T.StructField("batch_day", T.DateType(), True),
    T.StructField("change_type", S, True),
    T.StructField("file_id", S, True),
    T.StructField("removed", T.BooleanType(), True),
    T.StructField("file", CHANGE_FILE, True),
])

TASK_FIELDS = [
    ("client", S), ("file_id", S), ("file_name", S), ("file_path", S), ("drive_link", S),
    ("mime_type", S), ("size", L), ("task_type", S), ("output_format", S),
]
TASK = T.StructType([T.StructField(n, t, True) for n, t in TASK_FIELDS])

# Flat batch membership: one row per task placed in a batch.
BATCH_ITEM = T.StructType([
    T.StructField("client", S, True),
    T.StructField("fmt", S, True),
    T.StructField("batch_pos", L, True),
    T.StructField("batch_id", S, True),
    T.StructField("item_pos", L, True),
    T.StructField("file_id", S, True),
    T.StructField("size", L, True),
])

CLIENT_FOLDER = T.StructType([
    T.StructField("client", S, True),
    T.StructField("pos", I, True),
    T.StructField("folder_id", S, True),
    T.StructField("folder_name", S, True),
    T.StructField("folder_path", S, True),
])

LISTENER_STATE = T.StructType([
    T.StructField("last_full_scan_ts", T.TimestampType(), True),
    T.StructField("last_report_mtime", T.TimestampType(), True),
    T.StructField("last_seq", L, True),
])
