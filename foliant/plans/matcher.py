"""Matcher job: new report names -> masters -> client folders -> saved results.

Only names that the saved map does not know are matched. Their masters and folders
come from the deterministic matcher; answers of an external model enter the same
way through ``operators.matching`` (``parse_responses`` and the merges). New
entries replace old ones of the same key, or join them. Both maps and the parsed
report rows are one generation: its parts are written, empty ones too, and then
its state row, which makes it count.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.operators import matching as M
from foliant.session import materialize
from foliant.sources import store as ST

NAME_MAP = "raw_name string, master string"
MATCHES = "client string, folder_id string, folder_name string, folder_path string"
REPORT_ROWS = "ord long, row map<string,string>"
PARTS = {"names": NAME_MAP, "matches": MATCHES, "rows": REPORT_ROWS}


@dataclass
class MatchResult:
    names: DataFrame      # raw_name, master
    matches: DataFrame    # client, folder_id, folder_name, folder_path
    new_clients: DataFrame
    rows: DataFrame       # ord, row


def report_rows(report: DataFrame, order_col: str) -> DataFrame:
    """The parsed report: each row as a map from column to text (null: empty)."""
    cells = [x for c in report.columns if c != order_col for x in (F.lit(c), F.coalesce(F.col(c).cast("string"), F.lit("")))]
    return report.select(F.col(order_col).cast("long").alias("ord"), F.create_map(*cells).alias("row"))


def match_report(report: DataFrame, order_col: str, folders: DataFrame, old_names: DataFrame,
                 old_matches: DataFrame, on_conflict: str = "replace") -> MatchResult:
    """``folders``: the request folder list (``operators.matching.request_folders``)."""
    fresh = M.new_client_names(M.report_clients(report, order_col), old_names)
    normal = materialize(M.normalize_names(fresh, "name"))
    masters = materialize(M.consolidate_names(normal))
    listed = M.normalize_names(folders.select(F.col("id").alias("folder_id"), F.col("name").alias("folder_name"),
                                              F.col("path").alias("folder_path")), "folder_name")
    wanted = M.normalize_names(masters.select(F.col("master").alias("name")).distinct(), "name")
    best = M.match_best(M.match_pairs(wanted, listed)).select(F.col("name").alias("master"), "folder_name")
    resolved = materialize(M.resolve_folders(M.rollup_to_group(best, folders), folders))
    new_names = masters.select(F.col("name").alias("raw_name"), "master")
    clients = new_names.select(F.col("master").alias("client")).distinct()
    return MatchResult(M.incremental_merge(old_names, new_names, "raw_name"),
                       M.incremental_merge(old_matches, resolved, "client", clients, on_conflict), clients,
                       report_rows(report, order_col))


def save_results(base: str, names: DataFrame, matches: DataFrame, rows: DataFrame | None = None) -> int:
    """Write the parts as one generation and keep the last two; the generation written."""
    spark, base = names.sparkSession, base.rstrip("/")
    gen = max([0, *(g for part in (*PARTS, "state") for g in ST.list_generations(spark, f"{base}/{part}"))]) + 1
    if rows is None:
        rows = spark.createDataFrame([], REPORT_ROWS)
    for (part, schema), df in zip(PARTS.items(), (names, matches, rows)):
        cols = [c.strip().split(" ")[0] for c in schema.replace("map<string,string>", "map").split(",")]
        df.select(*cols).write.mode("overwrite").parquet(f"{base}/{part}/gen={gen}")
    spark.createDataFrame([(gen,)], "gen int").coalesce(1).write.mode("overwrite").parquet(f"{base}/state/gen={gen}")
    for part in (*PARTS, "state"):
        for old in ST.list_generations(spark, f"{base}/{part}")[:-2]:
            ST._delete(spark, f"{base}/{part}/gen={old}")
    return gen


def read_part(spark: SparkSession, base: str, part: str) -> DataFrame:
    """A part (``names``, ``matches``, ``rows``) of the newest whole generation; empty where nothing was saved."""
    gens = [g for g in ST.list_generations(spark, f"{base.rstrip('/')}/state")
            if ST._exists(spark, f"{base.rstrip('/')}/state/gen={g}/_SUCCESS")]
    if not gens:
        return spark.createDataFrame([], PARTS[part])
    return spark.read.schema(PARTS[part]).parquet(f"{base.rstrip('/')}/{part}/gen={gens[-1]}")


def read_results(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """The newest saved maps, of one generation."""
    return read_part(spark, base, "names"), read_part(spark, base, "matches")
