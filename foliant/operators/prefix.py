"""Path-prefix join: an item belongs to a folder when its path starts with the
folder's path (raw string prefix, no ``/`` boundary by default).

A naive ``startswith`` join plans as a cartesian product. This version is
exact and uses only equi-joins:

* Let ``k`` be the number of slashes in a folder path ``F``. A path ``P``
  starts with ``F`` iff ``P`` has at least ``k`` slashes, its first ``k``
  components equal those of ``F`` and its component ``k`` starts with the last
  component of ``F``.
* So each item is cut to its ancestor string ``anc_k`` (first ``k+1``
  components) for the few distinct ``k`` of the folder set (a list bounded by
  the tree depth, applied with ``explode`` on each item: no join).
* The *distinct* ancestors are matched to folders by enumerating the prefixes
  of their last component and equi-joining on ``(k, dir, prefix)``: the
  fan-out is the name length, never the number of sibling folders.
* Items then equi-join the matched ancestors on ``(k, anc)``. The matched
  table is small (one row per matched ancestor) and AQE broadcasts it when
  its runtime size allows; otherwise a sort-merge join whose skewed keys
  (one folder holding a large share of all items) AQE splits.
* With ``dedupe_by`` a match is dropped when a shallower ancestor of the same
  group already matched, so every item appears once per group without a
  final shuffle on (group, id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions import path_depth
from foliant.session import ensure_checkpoint_dir, materialize


def _slashes(col):
    return path_depth(col) + F.lit(1)


def _first_components(path_col, n_col):
    """First ``n`` '/'-separated components of a path, joined again."""
    return F.array_join(F.slice(F.split(path_col, "/", -1), F.lit(1), n_col), "/")


def prefix_members(items: DataFrame, folders: DataFrame, folder_keys: list[str],
                   folder_path: str = "folder_path", item_path: str = "path",
                   boundary: str = "raw", dedupe_by: list[str] | None = None) -> DataFrame:
    """All (folder key, item) pairs where the item path starts with the folder path.

    ``folders`` has the key columns and ``folder_path``; rows with a null or
    empty path are ignored. ``boundary='component'`` requires the match to
    end at a ``/`` (``ACME`` does not take ``ACME 2``). Returns the item
    columns plus the folder key columns (and ``folder_path``).
    """
    spark = items.sparkSession
    ensure_checkpoint_dir(spark)
    fcols = list(dict.fromkeys(folder_keys + [folder_path]))
    f = folders.select(*fcols).where(F.col(folder_path).isNotNull() & (F.col(folder_path) != ""))
    f = f.withColumn("_k", _slashes(folder_path))
    f = f.withColumn("_dir", _first_components(F.col(folder_path), F.col("_k"))) \
        .withColumn("_base", F.element_at(F.split(folder_path, "/", -1), F.col("_k") + 1))
    f = materialize(f)
    # Distinct slash counts of the folder paths: at most one value per tree
    # level, so this list is bounded by the tree depth.
    ks = sorted(r[0] for r in f.select("_k").distinct().collect())
    if not ks:
        empty = items.limit(0)
        for c in fcols:
            empty = empty.withColumn(c, F.lit(None).cast(dict(f.dtypes)[c]))
        return empty
    n = _slashes(item_path)
    it = items.withColumn("_k", F.explode(F.filter(F.array(*[F.lit(k) for k in ks]), lambda k: k <= n)))
    it = it.withColumn("_anc", _first_components(F.col(item_path), F.col("_k") + 1))

    anc = it.select("_k", "_anc").distinct()
    if boundary == "component":
        matched = anc.join(f, (anc["_k"] == f["_k"]) & (anc["_anc"] == F.col(folder_path))) \
            .select(anc["_k"], "_anc", *fcols)
    elif boundary == "raw":
        parts = F.split("_anc", "/", -1)
        anc = anc.withColumn("_dir", _first_components(F.col("_anc"), F.col("_k"))) \
            .withColumn("_last", F.element_at(parts, F.col("_k") + 1))
        # Only directories that hold a folder need their names expanded.
        anc = anc.join(f.select("_k", "_dir").distinct(), ["_k", "_dir"], "left_semi")
        anc = anc.withColumn("_pre", F.explode(F.expr(
            "transform(sequence(0, length(_last)), i -> substring(_last, 1, i))")))
        matched = anc.join(f, (anc["_k"] == f["_k"]) & (anc["_dir"] == f["_dir"])
                           & (anc["_pre"] == f["_base"])) \
            .select(anc["_k"], "_anc", *fcols)
    else:
        raise ValueError("boundary must be 'raw' or 'component'")

    if dedupe_by:
        grp = list(dedupe_by)
        if len(ks) > 1:
            # Drop a match if a shallower ancestor of the same item already
            # matched for the same group (then the deeper folder adds nothing).
            m = materialize(matched.select(*grp, "_k", "_anc").distinct())
            up = m.withColumn("_k1", F.explode(F.filter(F.array(*[F.lit(k) for k in ks]),
                                                        lambda k: k < F.col("_k")))) \
                .withColumn("_anc1", _first_components(F.col("_anc"), F.col("_k1") + 1))
            redundant = up.join(
                m.select(*grp, F.col("_k").alias("_k1"), F.col("_anc").alias("_anc1")),
                grp + ["_k1", "_anc1"], "left_semi").select(*grp, "_k", "_anc")
            matched = matched.join(redundant, grp + ["_k", "_anc"], "left_anti")
        # Several folders of one group can share one ancestor string.
        matched = matched.dropDuplicates(grp + ["_k", "_anc"])
    # The matched-ancestor table is small (one row per matched ancestor); storing
    # it keeps the final plan from repeating the item lineage.
    matched = materialize(matched)
    out = it.join(matched, ["_k", "_anc"])
    return out.drop("_k", "_anc")
