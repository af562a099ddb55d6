"""Connected components by alternating large-star and small-star rounds.

Every round is joins and aggregations on edges, so one huge component spreads
over all tasks, and the number of rounds grows with the logarithm of the largest
component, not with its diameter. There is no bound on the rounds. Once ``SMALL``
edges or fewer are left (a few megabytes, counted), one task finishes them by
union-find, since the time would otherwise go into starting tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.session import materialize, release

SMALL = 200_000


def _finish(batches):
    """Edges ``u, v`` in one task -> ``u, v``: each node but the smallest of a component, and that one."""
    parent: dict = {}

    def root(x):
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    kind = None
    for batch in batches:
        kind = batch.schema.field("u").type
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    if kind is not None:
        rows = [(x, r) for x in parent if (r := root(x)) != x]
        for at in range(0, len(rows), 50_000):
            us, vs = zip(*rows[at: at + 50_000])
            yield pa.RecordBatch.from_arrays([pa.array(us, kind), pa.array(vs, kind)], ["u", "v"])


def _tree_edges(u, v):
    """Of edges between numbers: each node but the smallest of a component, and that one."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u):]
    least = np.arange(len(nodes))
    while True:
        a, b = least[a], least[b]
        open_ = a != b
        a, b = a[open_], b[open_]
        if not len(a):
            break
        np.minimum.at(least, np.maximum(a, b), np.minimum(a, b))
        while ((nearer := least[least]) != least).any():
            least = nearer
    other = least != np.arange(len(nodes))
    return nodes[other], nodes[least[other]]


def spanning_forest(edges: DataFrame, a: str = "u", b: str = "v", held: int = 2_000_000) -> DataFrame:
    """``a, b``: edges of the same components, between numbers (long), before any exchange: each task keeps only
    those that connect its nodes. A task holds up to ``held`` edges between two reductions; once its
    trees are half as large, it gives them out and begins again."""
    def reduce(batches):
        us, vs, n = [], [], 0

        def rows(u, v):
            for i in range(0, len(u), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(u[i: i + 100_000], pa.int64()), pa.array(v[i: i + 100_000], pa.int64())], [a, b])

        for batch in batches:
            us.append(batch.column(0).to_numpy(zero_copy_only=False))
            vs.append(batch.column(1).to_numpy(zero_copy_only=False))
            n += batch.num_rows
            if n >= held:
                u, v = _tree_edges(np.concatenate(us), np.concatenate(vs))
                us, vs, n = [u], [v], len(u)
                if 2 * n >= held:
                    yield from rows(u, v)
                    us, vs, n = [], [], 0
        if n:
            yield from rows(*_tree_edges(np.concatenate(us), np.concatenate(vs)))

    pairs = edges.select(F.col(a).cast("long").alias(a), F.col(b).cast("long").alias(b)).where(F.col(a).isNotNull() & F.col(b).isNotNull())
    return pairs.mapInArrow(reduce, f"{a} long, {b} long")


def _star(directed: DataFrame) -> DataFrame:
    """``u, v, m``: m is the smallest of u and all its v."""
    least = directed.groupBy("u").agg(F.min("v").alias("m"))
    return directed.join(least, "u").withColumn("m", F.least("u", "m"))


def _both(first, second):
    """Two rows for each one; unlike a union this keeps the number of partitions."""
    return F.inline(F.array(F.struct(F.col(first[0]).alias("u"), F.col(first[1]).alias("v")),
                            F.struct(F.col(second[0]).alias("u"), F.col(second[1]).alias("v"))))


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select(_both(("u", "v"), ("v", "u")))
    return _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    # edges point from the larger to the smaller node
    return _star(edges).select(_both(("v", "m"), ("u", "m"))).where("u > v").distinct()


def _mark(edges: DataFrame):
    mark = F.pmod(F.xxhash64("u", "v"), F.lit(2_147_483_647))
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mark)).first())


def connected_components(edges: DataFrame, a: str = "u", b: str = "v") -> DataFrame:
    """``id, component`` of every node that has an edge to another one; the
    component is its smallest node. Null ends and loops are ignored."""
    pairs = edges.select(F.col(a).alias("_a"), F.col(b).alias("_b")).where("_a <> _b") \
        .select(F.greatest("_a", "_b").alias("u"), F.least("_a", "_b").alias("v")).distinct()
    current = materialize(pairs)
    mark = _mark(current)
    while mark[0] > SMALL:
        following = materialize(_small(_large(current)))
        release(current)
        current, before, mark = following, mark, _mark(following)
        if mark == before:
            break
    else:
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in current.schema.fields)
        following = materialize(current.coalesce(1).mapInArrow(_finish, kinds))
        release(current)
        current = following
    out = current.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return out.unionByName(out.select(F.col("component").alias("id"), "component").distinct())
