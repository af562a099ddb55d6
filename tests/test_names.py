"""Edit candidates of names: complete, and few where names share a long ending."""

import random

import pytest
from pyspark.sql import functions as F

from foliant.operators import matching as M

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def word(rnd, n):
    return "".join(rnd.choice(LETTERS) for _ in range(n))


def typo(rnd, name):
    out = list(name)
    for _ in range(rnd.randrange(4)):
        i = rnd.randrange(len(out))
        kind = rnd.randrange(3)
        if kind == 0:
            out[i] = rnd.choice(LETTERS)
        elif kind == 1:
            out.insert(i, rnd.choice(LETTERS))
        elif len(out) > 4:
            del out[i]
    return "".join(out)


def ending(rnd):
    return [word(rnd, 8) + " COMERCIO DE ALIMENTOS" for _ in range(700)]


def near_endings(rnd):
    return ["".join(rnd.choice("ABCDE") for _ in range(8)) + " COMERCIO DE ALIMENTOS" for _ in range(500)]


def mixed(rnd):
    return [word(rnd, rnd.randrange(6, 12)) + rnd.choice([" COMERCIO DE ALIMENTOS", " INDUSTRIA E COMERCIO", " SERVICOS", ""]) for _ in range(500)]


def typos(rnd):
    base = [word(rnd, rnd.randrange(5, 40)) for _ in range(120)]
    return [typo(rnd, rnd.choice(base)) for _ in range(500)]


def alike(rnd):
    return ["A" * rnd.randrange(1, 30) + rnd.choice("AB") for _ in range(60)] + [word(rnd, 1), word(rnd, 2)]


@pytest.mark.parametrize("names", [ending, near_endings, mixed, typos, alike])
def test_edit_candidates_are_complete(spark, names):
    rows = sorted(set(names(random.Random(3))))
    u = spark.createDataFrame([(n, n.split()) for n in rows], "norm string, tokens array<string>").cache()
    found = M._edit_candidates(u, u, M.cut_table(u)).cache()
    pairs = u.select(F.col("norm").alias("a")).join(u.select(F.col("norm").alias("b")), F.length("a") <= F.length("b"))
    true = pairs.where(F.levenshtein("a", "b") <= F.floor(F.lit(15) * F.length("b") / 100)).where("length(b) >= 7").cache()
    assert true.join(found, ["a", "b"], "left_anti").count() == 0
    print(names.__name__, len(rows), found.count(), true.count())
    if names is ending:  # half of the letters that differ may change
        assert found.count() < len(rows) ** 2 / 8
    if names is near_endings:
        assert found.count() < 20 * true.count()


@pytest.mark.parametrize("names, kept", [(ending, 4), (near_endings, 3), (mixed, 2), (typos, 2), (alike, 3), (alike, 1)])
def test_edges_by_several_segments_are_complete(spark, names, kept):
    """Lengths at which many names meet ask for several segments at once; every pair within the edits is still found."""
    rows = sorted(set(names(random.Random(5))))[:400]
    if names is alike:
        rows += ["\u00c9\u4e2d" * 5, "\u00c9\u4e2d" * 4 + "\u4e2d", "X" * 8, "X" * 7]
    u = M._numbered_forms(spark.createDataFrame([(n, n.split()) for n in rows], "norm string, tokens array<string>"))
    lengths = sorted({len(n) for n in rows if 7 <= len(n) < 45 and 15 * len(n) // 100 + kept <= len(n)})
    dense = {n: (kept, M._equal_cuts(([3.0] * 8 + [0.02] * n)[:n], 15 * n // 100 + kept)) for n in lengths}
    ids = {r.norm: r.id for r in u.collect()}
    assert sorted(ids, key=ids.get) == sorted(rows, key=str.encode)
    found = {(r.a, r.b) for r in M._dense_rows(u, dense).collect()}
    assert all(len(a) < len(b) or len(a) == len(b) and a < b for a, b in found)
    pairs = spark.createDataFrame([(a, b) for a in rows for b in rows if len(b) in dense and (len(a), a) < (len(b), b)], "a string, b string")
    true = pairs.where(F.levenshtein("a", "b") <= F.floor(F.lit(15) * F.length("b") / 100))
    assert found == {(r.a, r.b) for r in true.collect()} and found


def test_many_names_of_one_length_ask_for_several_segments(spark):
    rows = [(w, [w]) for w in sorted({word(random.Random(i), 8) + " COMERCIO DE ALIMENTOS" for i in range(6000)})]
    u = M._numbered_forms(spark.createDataFrame(rows, "norm string, tokens array<string>"))
    dense = M._dense_cuts(M.place_weights(u), u)
    kept, cuts = dense[30]
    assert kept > 1 and len(cuts) == 4 + kept and all(z >= 1 for _, z in cuts)
    assert [s for s, _ in cuts] == [sum(z for _, z in cuts[:i]) for i in range(len(cuts))] and sum(z for _, z in cuts) == 30


def test_pairs_within_the_edits_are_not_joined_with_the_names_again(spark):
    names = spark.createDataFrame([(w, w, w.split()) for w in ending(random.Random(6))], "name string, norm string, tokens array<string>")
    plan = M.name_edges(names)._jdf.queryExecution().optimizedPlan().toString()
    last = plan[:plan.index("Union")]  # behind the union of pairs by edits and pairs by tokens
    assert "Join" not in last and last.count("Aggregate") == 1, last


def test_forest_keeps_components_and_few_edges(spark):
    from foliant.operators.components import connected_components, spanning_forest
    rnd = random.Random(7)
    rows = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(5000)] + [(1000 + rnd.randrange(900), 1000 + rnd.randrange(900)) for _ in range(500)] \
        + [(5000, 5000), (None, 3), (4, None)]
    edges = spark.createDataFrame(rows, "x long, y long").repartition(3)
    want = sorted(map(tuple, connected_components(edges, "x", "y").collect()))
    for held in (40, 2_000_000):
        forest = spanning_forest(edges, "x", "y", held).cache()
        assert sorted(map(tuple, connected_components(forest, "x", "y").collect())) == want
    assert forest.count() < 3 * 1200 < len(rows)
    assert spanning_forest(edges.limit(0), "x", "y").count() == 0


def test_cuts_cover_every_name(spark):
    rnd = random.Random(4)
    rows = sorted(set(mixed(rnd) + typos(rnd) + alike(rnd)))
    cuts = {}
    for r in M.cut_table(spark.createDataFrame([(n,) for n in rows], "norm string")).collect():
        cuts.setdefault(r.n, []).append((r.k, r.s, r.z, r.t))
    assert set(cuts) == {len(n) for n in rows if len(n) >= 7}
    for n, parts in cuts.items():
        parts.sort()
        assert [p[0] for p in parts] == list(range(15 * n // 100 + 1))
        assert all(z >= 1 for _, _, z, _ in parts)
        assert [p[1] for p in parts] == [sum(q[2] for q in parts[:i]) for i in range(len(parts))] and sum(p[2] for p in parts) == n


def test_only_the_cuts_are_broadcast(spark):
    """By the size of its file a list of names can pass for a small table; the joins must not send it to the driver."""
    rows = [(f"{i:05d}", f"N{i:05d} SERVICOS", ["SERVICOS", f"N{i:05d}"]) for i in range(50)]
    names = spark.createDataFrame(rows, "name string, norm string, tokens array<string>")
    folders = names.select(F.col("name").alias("folder_id"), F.col("name").alias("folder_name"), F.col("name").alias("folder_path"), "norm", "tokens")
    for df in (M.name_edges(names), M.consolidate_names(names), M.match_pairs(names, folders)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        cuts = plan.count("strategy=broadcast")
        physical = df._jdf.queryExecution().executedPlan().toString()
        assert physical.count("BroadcastHashJoin") <= cuts, physical
