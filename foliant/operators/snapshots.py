"""Snapshot comparison: which clients' file sets changed between generations.

Sets are compared as (client, id) pairs with a full outer join: a client
changed iff some pair exists on one side only. No per-client array is ever
built, so a client holding a large share of all files is no problem; the
join shuffles on (client, id), which spreads evenly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.operators.tasks import client_files
from foliant.session import materialize, release


def client_pairs(members: DataFrame) -> DataFrame:
    return members.select("client", "id").distinct()


def client_signatures(members: DataFrame) -> DataFrame:
    """Compact signature per client: size of the id set, its bounds, and a sum of
    the ids' digests that does not depend on order. The set itself is the pairs."""
    digest = F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 8), 16, 10).cast("bigint")
    return client_pairs(members).groupBy("client").agg(
        F.count(F.lit(1)).alias("n_ids"), F.min("id").alias("first_id"), F.max("id").alias("last_id"),
        F.sum(digest).alias("id_digest"))


def changed_clients(curr_members: DataFrame, prev_members: DataFrame,
                    clients_with_folders: DataFrame) -> DataFrame:
    """Clients (with at least one folder) whose id set differs between generations."""
    cur = client_pairs(curr_members).withColumn("_c", F.lit(True))
    old = client_pairs(prev_members).withColumn("_o", F.lit(True))
    diff = cur.join(old, ["client", "id"], "full_outer") \
        .where(F.col("_c").isNull() | F.col("_o").isNull()).select("client").distinct()
    return diff.join(clients_with_folders.select("client").distinct(), "client", "left_semi")


DIGEST_BUCKETS = 64


def member_digests(members: DataFrame, signature_cols: tuple[str, ...] = ("id",), n_buckets: int = DIGEST_BUCKETS) -> DataFrame:
    """``client, bucket, n, total, mixed``: a multiset hash of the chosen columns for every bucket
    of ids of a client. A hot client's files spread over its buckets, and rows are
    aggregated before they are exchanged."""
    row = F.struct(*[F.col(c) for c in signature_cols])
    return members.select("client", F.pmod(F.xxhash64("id"), F.lit(n_buckets)).cast("int").alias("bucket"),
                          F.xxhash64(row).alias("_h"), F.xxhash64(F.lit(1), row).alias("_g")) \
        .groupBy("client", "bucket").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_h").cast("decimal(20,0)")).alias("total"),
                                         F.bit_xor("_g").alias("mixed"))


def differing_buckets(curr_digests: DataFrame, prev_digests: DataFrame) -> DataFrame:
    """``client, bucket`` of the buckets whose digests differ, or that only one side has."""
    marks = ["n", "total", "mixed"]
    old = prev_digests.select("client", "bucket", F.struct(*marks).alias("_old"))
    new = curr_digests.select("client", "bucket", F.struct(*marks).alias("_new"))
    return new.join(old, ["client", "bucket"], "full_outer").where(~F.col("_new").eqNullSafe(F.col("_old"))).select("client", "bucket")


def changed_clients_by_digest(curr_members: DataFrame, prev_members: DataFrame, clients_with_folders: DataFrame,
                              signature_cols: tuple[str, ...] = ("id",), n_buckets: int = DIGEST_BUCKETS,
                              prev_digests: DataFrame | None = None) -> DataFrame:
    """``changed_clients`` over the set of ``signature_cols`` of each client's files: digests decide which
    buckets may differ, and only the rows of these are joined.

    ``prev_digests``: stored ``member_digests`` of the generation before, with the same columns.
    """
    if "id" not in signature_cols:
        raise ValueError("signature_cols must hold the id")
    now = member_digests(curr_members, signature_cols, n_buckets)
    before = prev_digests if prev_digests is not None else member_digests(prev_members, signature_cols, n_buckets)
    open_ = materialize(differing_buckets(now, before))

    def rows(members, flag):
        own = members.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(n_buckets)).cast("int")).join(open_, ["client", "bucket"], "left_semi")
        return own.select("client", F.struct(*signature_cols).alias("_row")).distinct().withColumn(flag, F.lit(True))

    cur, old = rows(curr_members, "_c"), rows(prev_members, "_o")
    both = cur.join(old.withColumnRenamed("client", "_client").withColumnRenamed("_row", "_old"),
                    (F.col("client") == F.col("_client")) & F.col("_row").eqNullSafe(F.col("_old")), "full_outer")
    diff = materialize(both.where(F.col("_c").isNull() | F.col("_o").isNull()).select(F.coalesce("client", "_client").alias("client")).distinct())
    release(open_)
    return diff.join(clients_with_folders.select("client").distinct(), "client", "left_semi")


def changed_rows(before: DataFrame, after: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of two inventories (``id, path``) whose id has another path, or none, on the other side."""
    old, new = before.select("id", "path"), after.select("id", "path")
    both = old.withColumnRenamed("path", "_old").join(new.withColumnRenamed("path", "_new"), "id", "full_outer")
    moved = materialize(both.where(~F.col("_old").eqNullSafe(F.col("_new"))))
    return (moved.where("_old is not null").select("id", F.col("_old").alias("path")),
            moved.where("_new is not null").select("id", F.col("_new").alias("path")))


def member_deltas(gone: DataFrame, come: DataFrame, client_folders: DataFrame) -> DataFrame:
    """``client, id, delta`` (+1, -1) of the memberships that changed rows (``id, path``) end and begin.

    Only the changed rows go through the prefix join. A file that stays under the same
    client cancels out.
    """
    minus = client_files(gone, client_folders).select("client", "id", F.lit(-1).alias("delta"))
    plus = client_files(come, client_folders).select("client", "id", F.lit(1).alias("delta"))
    return plus.unionByName(minus).groupBy("client", "id").agg(F.sum("delta").cast("int").alias("delta")).where("delta <> 0")


def apply_member_deltas(counts: DataFrame, deltas: DataFrame) -> DataFrame:
    """``client, id, n`` after the deltas; memberships that are over are left out."""
    moved = deltas.select("client", "id", F.col("delta").cast("long").alias("n"))
    return counts.select("client", "id", "n").unionByName(moved).groupBy("client", "id").agg(F.sum("n").alias("n")).where("n > 0")


def clients_to_replan(client_map: DataFrame, changed: DataFrame, full_run: bool) -> DataFrame:
    """All clients of the map on a full run, else the changed ones."""
    if full_run:
        return client_map.select("client").distinct()
    return changed.select("client").distinct()
