"""MinHash near-dedup as a chosen-path set similarity join.

A document is its set of distinct 5-word shingles (A-Z lower-cased; fewer words:
the whole sequence as one). Documents with equal sets form one class and go on
as the class's smallest doc_id. Every class has a sketch of ``COORDS`` minwise
tokens. ``TREES`` independent trees branch the classes: a node chooses one or two
sketch coordinates (4/3 on average, the inverse of the threshold), and a class
goes to the child of each chosen coordinate's minwise token.

1. The root children of all trees that hold several classes. In small ones (up to
   ``LEAF_PAIRS`` pairs) every class names the child's smallest class if the sketches
   are alike enough, else its best partner; in large ones each class is tested against
   the smallest one, whose sketch comes with the child. Every class keeps one
   partner, so this is linear however many copies there are.
2. These pairs are confirmed on the full sets and contracted to components.
3. The trees go on below the root children that still hold several components.
   Small nodes are compared exhaustively between components (a node of one large
   component and a few other classes is such a one); larger nodes branch again.
   After ``LEVELS`` levels, what is left in large nodes is compared by a join of
   the classes outside the node's largest component with the node, so no pair is
   dropped for its node's size.
4. Deeper paths lose more pairs: classes whose nodes branched below the root go
   through more trees, as many as the deepest of these levels asks for
   (``trees_for``), with steps 3 of their own.
5. All pairs of steps 3 and 4 that the sketches allow are confirmed on the full sets.

Partners are found on the low bytes of the minwise tokens. A leaf tests its pairs on a
second sketch, the smallest hashes of ``BINS`` bins, which with the sizes is near exact
for short texts. Bytes that are equal by chance only add pairs to confirm.

A pair of similarity 0.75 misses all its trees with a probability below ``MISS`` at
every depth. Each sketch filter lets a true pair fail with a probability below 1e-4.

Defined results: null and empty texts have empty sets and link with nothing; a
null doc_id links with nothing (``component_id`` null, kept); rows that repeat a
doc_id are one document, whose sets all link; empty tables give an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.text import cut_words, fold_az, hash_spans, mix, runs, shingles, small_batches, utf8
from foliant.operators.components import connected_components
from foliant.session import materialize, release

WORDS = 5
#: Documents link with 100 * intersection >= PERCENT * union.
PERCENT = 75
COORDS, TREES, LEVELS = 128, 11, 6
#: Chance at most that the trees miss a pair at the threshold.
MISS = 1e-5
#: Nodes are compared exhaustively up to so many pairs between components, and so many classes.
LEAF_PAIRS, LEAF_ROWS = 2_000_000, 20_000
#: Equal sketch coordinates that a pair needs to be confirmed: 0.75 less 3.9 standard deviations.
MIN_EQUAL = 77
#: Equal coordinates from which a child's smallest class is taken without looking for a better partner.
STAR_EQUAL = 102
#: Bins of the second sketch, which leaves compare before a pair leaves them.
BINS = 512
_FACTORS = np.random.default_rng(5).integers(0, 2**63, COORDS, np.uint64) * np.uint64(2) + np.uint64(1)


def sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of the texts (with repeats) and their n + 1 offsets."""
    data, offsets = utf8(texts)
    data = fold_az(data)
    starts, lengths, word_at = cut_words(data, offsets)
    return shingles(hash_spans(data, starts, lengths), word_at, WORDS)


def minwise(own: np.ndarray) -> np.ndarray:
    """The sketch of one set."""
    low = np.full(COORDS, 0xFFFFFFFF, np.uint64)
    for at in range(0, len(own), 512):
        low = np.minimum(low, ((own[at: at + 512, None] * _FACTORS) >> np.uint64(32)).min(axis=0))
    return low.astype(np.uint32)


def binned(own: np.ndarray) -> np.ndarray:
    """One permutation sketch of a sorted set: a byte (1 to 255) of the smallest hash of each bin, 0 where it is empty."""
    out = np.zeros(BINS, np.uint8)
    place = (own >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    out[place[first]] = 1 + own[first] % np.uint64(255)
    return out


def bins_allow(bins: np.ndarray, sizes: np.ndarray, one: np.ndarray, size: int) -> np.ndarray:
    """Whether sets may be similar enough to one set, by their second sketches and sizes.

    The smallest elements of the bins that are not empty in both are a random sample,
    without replacement, of the union, whose size at the threshold follows from the
    two sizes. Its part in common may fall short by 3.9 standard deviations.
    """
    equal = ((bins == one) & (one > 0)).sum(axis=1)
    drawn = ((bins > 0) | (one > 0)).sum(axis=1)
    at = PERCENT / 100
    union = np.maximum((sizes + size) / (1 + at), 2.0)
    left = np.clip((union - drawn) / (union - 1), 0.0, 1.0)
    enough = equal >= at * drawn - 3.9 * np.sqrt(drawn * at * (1 - at) * left) - 0.5
    return enough & (100 * np.minimum(sizes, size) >= PERCENT * np.maximum(sizes, size))


def _sketch(batches):
    for batch in batches:
        hashes, offsets = sets(batch.column("text"))
        sizes, digests, sketches, bins = [], [], [], []
        for a, b in zip(offsets[:-1], offsets[1:]):
            own = np.unique(hashes[a:b])
            sizes.append(len(own))
            digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
            sketches.append(minwise(own).tobytes() if len(own) else None)
            bins.append(binned(own).tobytes() if len(own) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(sketches, pa.binary()),
             pa.array(bins, pa.binary())], ["doc_id", "n_shingles", "digest", "sketch", "bins"])


def _chosen(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each child of the nodes: index of its node and the chosen coordinate."""
    draw = mix(nodes)
    two = (draw >> np.uint64(40)) % np.uint64(3) == 0
    first = draw % np.uint64(COORDS)
    second = (first + np.uint64(1) + (draw >> np.uint64(20)) % np.uint64(COORDS - 1)) % np.uint64(COORDS)
    at = np.arange(len(nodes))
    return np.concatenate([at, at[two]]), np.concatenate([first, second[two]]).astype(np.int64)


def _branch(nodes: np.ndarray, sketches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Child node names and the index of the row that goes to each."""
    at, coord = _chosen(nodes)
    token = sketches[at, coord].astype(np.uint64)
    child = mix(mix(nodes[at] + coord.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ token)
    return child.view(np.int64), at


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDS)


def _bytes(values: list) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.uint8).reshape(-1, COORDS)


def _low_bytes(sketches: np.ndarray) -> pa.Array:
    low = sketches.astype(np.uint8)
    return pa.array([row.tobytes() for row in low], pa.binary())


def _short(batches):
    """Classes -> the low bytes of their sketches."""
    for batch in batches:
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays([batch.column("rep"), _low_bytes(_matrix(batch.column("sketch")))], ["rep", "short"])


def trees_miss(levels: int, trees: int) -> float:
    """Chance that a pair at the threshold, past the sketch filter, meets in none of the
    trees, where nodes branch on so many levels below the root."""
    at = PERCENT / 100
    total = passed = 0.0
    for equal in range(MIN_EQUAL, COORDS + 1):
        chance = math.comb(COORDS, equal) * at**equal * (1 - at) ** (COORDS - equal)
        miss = 0.0
        for _ in range(levels + 1):
            one = 1 - equal / COORDS * (1 - miss)
            miss = (2 * one + one * one) / 3  # one coordinate or two
        passed += chance
        total += chance * miss**trees
    return total / passed


def trees_for(levels: int) -> int:
    """Trees for classes whose nodes branch on so many levels below the root."""
    trees = TREES
    while trees_miss(levels, trees) > MISS:
        trees += 1
    return trees


def _roots(batches):
    """Classes -> their root children in the trees above ``low`` up to ``high``."""
    for batch in batches:
        if batch.num_rows:
            low, high = (batch.column(c).to_numpy().astype(np.int64) for c in ("low", "high"))
            tree, own = runs(low + 1, high - low).astype(np.uint64), np.repeat(np.arange(batch.num_rows), high - low)
            child, at = _branch(mix(tree * np.uint64(0xD6E8FEB86659FD93)), _matrix(batch.column("sketch"))[own])
            yield pa.RecordBatch.from_arrays([pa.array(child), batch.column("rep").take(pa.array(own[at]))], ["node", "rep"])


def _children(batches):
    for batch in batches:
        if batch.num_rows:
            child, at = _branch(batch.column("node").to_numpy().view(np.uint64), _matrix(batch.column("sketch")))
            at = pa.array(at)
            yield pa.RecordBatch.from_arrays([pa.array(child), batch.column("rep").take(at), batch.column("label").take(at)],
                                             ["node", "rep", "label"])


def _allowed(batches):
    """Keep pairs with enough equal coordinates, and count these."""
    for batch in batches:
        if batch.num_rows:
            equal = (_bytes(batch.column("short_a").to_pylist()) == _bytes(batch.column("short_b").to_pylist())).sum(axis=1)
            keep = pa.array(equal >= MIN_EQUAL)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep),
                                              pa.array(equal, pa.int64()).filter(keep)], ["a", "b", "equal"])


def _by_node(batches, columns):
    """Rows sorted by node -> the lists of ``columns`` of each node of several rows."""
    held: list = []
    node = None
    for batch in batches:
        for n, *row in zip(*[batch.column(c).to_pylist() for c in ("node", *columns)]):
            if n != node:
                if len(held) > 1:
                    yield tuple(map(list, zip(*held)))
                node, held = n, []
            held.append(row)
    if len(held) > 1:
        yield tuple(map(list, zip(*held)))


def _first_common(own: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Least common node of one row's nodes and of each other row's (padded with ``_NO_NODE``)."""
    common = (others[:, :, None] == own[own != _NO_NODE][None, None, :]).any(axis=2)
    return np.where(common, others, np.iinfo(np.int64).max).min(axis=1)


_NO_NODE = np.iinfo(np.int64).min


def _leaf_pairs(batches):
    """Rows sorted by node -> pairs of different components that the second sketches allow.
    Rows that share several leaves (``nodes``) are compared in each, but give their pair in one."""
    for node, reps, labels, sizes, bins, nodes in _by_node(batches, ("node", "rep", "label", "n_shingles", "bins", "nodes")):
        reps, labels, sizes = (np.array(x, np.int64) for x in (reps, labels, sizes))
        m = np.frombuffer(b"".join(bins), np.uint8).reshape(-1, BINS)
        every = np.full((len(nodes), max(map(len, nodes))), _NO_NODE, np.int64)
        for i, own in enumerate(nodes):
            every[i, : len(own)] = own
        names, own, counts = np.unique(labels, return_inverse=True, return_counts=True)
        # one largest component first and in one piece, also among equals: it is never the outer side
        order = np.lexsort((labels, -counts[own]))
        reps, labels, sizes, m, every = reps[order], labels[order], sizes[order], m[order], every[order]
        a, b = [], []
        for i in range(int(counts.max()), len(reps)):
            hit = np.flatnonzero(bins_allow(m[:i], sizes[:i], m[i], int(sizes[i])) & (labels[:i] != labels[i]))
            if len(hit):
                hit = hit[_first_common(every[i], every[hit]) == node[0]]
            a.append(reps[hit])
            b.append(np.full(len(hit), reps[i]))
        if a:
            a, b = np.concatenate(a), np.concatenate(b)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def _leaf_partners(batches):
    """Rows sorted by node -> a partner ``a`` of each class ``b``, if the sketches allow one:
    the node's smallest class where it is alike enough, else the most alike one."""
    for reps, shorts in _by_node(batches, ("rep", "short")):
        reps, m = np.array(reps, np.int64), _bytes(shorts)
        a, b, counts = [], [], []
        head = int(reps.argmin())
        star = (m == m[head]).sum(axis=1)
        for i in range(len(reps)):
            if i == head:
                continue
            best, equal = head, int(star[i])
            if equal < STAR_EQUAL:
                every = (m == m[i]).sum(axis=1)
                every[i] = 0
                best = int(every.argmax())
                equal = int(every[best])
            if equal >= MIN_EQUAL:
                a.append(reps[best])
                b.append(reps[i])
                counts.append(equal)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(counts, pa.int64())], ["a", "b", "equal"])


def _confirm(batches):
    """Keep the pairs whose full sets are similar enough."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sides = [sets(batch.column(c)) for c in ("text_a", "text_b")]
        keep, last, own = [], None, None
        ids = batch.column("b").to_pylist()
        for i in range(batch.num_rows):
            (ha, oa), (hb, ob) = sides
            a = np.unique(ha[oa[i]: oa[i + 1]])
            if last != ids[i]:
                last, own = ids[i], np.unique(hb[ob[i]: ob[i + 1]])
            both = len(np.intersect1d(a, own, assume_unique=True))
            keep.append(len(a) > 0 and 100 * both >= PERCENT * (len(a) + len(own) - both))
        keep = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])


_ROOTS = "node bigint, rep bigint"
_PAIRS, _COUNTED = "a bigint, b bigint", "a bigint, b bigint, equal bigint"


def _side(classes: DataFrame, name: str) -> DataFrame:
    return classes.select(F.col("rep").alias(name), F.col("short").alias(f"short_{name}"))


def _best(candidates: DataFrame) -> DataFrame:
    """One partner ``a`` of each ``b``: the smallest of those that are alike enough to be the head of a
    star, so that copies meet in one; else the one of most equal coordinates."""
    star = F.col("equal") >= STAR_EQUAL
    order = F.struct(star.cast("int").alias("_s"), F.when(star, -F.col("a")).otherwise(F.col("equal")).alias("_e"), (-F.col("a")).alias("_a"))
    best = candidates.groupBy("b").agg(F.max(order).alias("_top"))
    return best.select((-F.col("_top._a")).alias("a"), "b")


def _partners(shared: DataFrame) -> DataFrame:
    """Allowed pairs in the root children ``node, rep, short, leaf, head``: a partner for each class."""
    small = shared.where("leaf").select("node", "rep", "short") \
        .repartition("node").sortWithinPartitions("node").mapInArrow(_leaf_partners, _COUNTED)
    large = shared.where("not leaf")
    heads = large.where("rep = head").select("node", F.col("rep").alias("a"), F.col("short").alias("short_a"))
    stars = large.where("rep <> head").select("node", F.col("rep").alias("b"), F.col("short").alias("short_b")).join(heads, "node")
    return small.unionByName(stars.select("a", "b", "short_a", "short_b").mapInArrow(_allowed, _COUNTED))


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``a, b`` of doc_ids whose texts' full sets are similar enough."""
    one = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    both = one.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    return materialize(both.mapInArrow(_confirm, _PAIRS))


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels, rows["rep"] == labels["id"], "left") \
        .select("node", "rep", F.coalesce("component", "rep").alias("label"))


def _open_nodes(rows: DataFrame) -> DataFrame:
    """Nodes that hold several components, whether they are small enough to compare, and
    their largest component ``top``."""
    sizes = rows.groupBy("node", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("node").agg(
        F.count(F.lit(1)).alias("labels"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("sq"),
        F.max(F.struct("n", "label")).alias("_top"))
    return sizes.where("labels > 1").select("node", _is_leaf(F.col("n"), F.col("sq")).alias("leaf"), F.col("_top.label").alias("top"))


def _is_leaf(rows, squares):
    return (rows * rows - squares <= 2 * LEAF_PAIRS) & (rows <= LEAF_ROWS)


def _descend(rows: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Pairs between components below root children (``node, rep, label``), and ``rep, levels``
    of the classes whose nodes branched (None: none did)."""
    pairs = deep = above = None
    for level in range(LEVELS + 1):
        rows = materialize(rows.join(_open_nodes(rows).select("node", "leaf"), "node").select("node", "rep", "label", "leaf"))
        if above is not None:
            release(above)
        leaves = rows.where("leaf").groupBy("rep").agg(F.min("label").alias("label"), F.collect_set("node").alias("nodes"))
        leaves = leaves.join(classes.select("rep", "n_shingles", "bins"), "rep") \
            .select(F.explode("nodes").alias("node"), "rep", "label", "n_shingles", "bins", "nodes")
        found = leaves.repartition("node").sortWithinPartitions("node").mapInArrow(_leaf_pairs, _PAIRS)
        large = rows.where("not leaf")
        last = level == LEVELS or large.isEmpty()
        if level == LEVELS:
            found = found.unionByName(_rest(large, classes))
        found = materialize(found.distinct())
        pairs = found if pairs is None else pairs.unionByName(found)
        if last:
            release(rows)
            return pairs, deep
        branched = materialize(large.select("rep", F.lit(level + 1).alias("levels")).distinct())
        deep = branched if deep is None else deep.unionByName(branched)
        below = large.select("node", "rep", "label").join(classes.select("rep", "sketch"), "rep").select("node", "rep", "label", "sketch") \
            .mapInArrow(_children, "node bigint, rep bigint, label bigint").distinct()
        above, rows = rows, materialize(below)
        release(above)
        above = rows


def near_links(docs: DataFrame, sketched: DataFrame) -> DataFrame:
    """``id, component`` of the class representatives that link with another class."""
    classes = materialize(sketched.where("doc_id is not null and n_shingles > 0").groupBy("digest", "n_shingles")
                          .agg(F.min("doc_id").alias("rep"), F.min("sketch").alias("sketch"), F.min("bins").alias("bins"))
                          .select("rep", "n_shingles", "sketch", "bins"))
    trees = classes.select("rep", "sketch", F.lit(0).alias("low"), F.lit(TREES).alias("high"))
    roots = trees.mapInArrow(_roots, _ROOTS)
    # root children of several classes; the hints keep the plan the same at every size
    several = roots.groupBy("node").agg(F.min("rep").alias("head"), F.count(F.lit(1)).alias("_n")).where("_n > 1") \
        .select("node", "head", _is_leaf(F.col("_n"), F.col("_n")).alias("leaf"))
    shorts = classes.select("rep", "sketch").mapInArrow(_short, "rep bigint, short binary")
    shared = materialize(roots.join(several.hint("merge"), "node").join(shorts.hint("merge"), "rep")
                         .select("node", "rep", "short", "leaf", "head"))
    # their texts, once
    ids = shared.select(F.col("rep").alias("doc_id")).distinct()
    texts = materialize(docs.select("doc_id", "text").join(ids.hint("merge"), "doc_id", "left_semi"))
    # 1. and 2. one partner for each class
    first = confirmed(_best(_partners(shared)), texts)
    labels = materialize(connected_components(first, "a", "b"))
    # 3. the trees below, between components only
    pairs, depths = _descend(_labelled(shared, labels), classes)
    release(shared)
    # 4. more trees for classes whose nodes branched
    need = F.lit([trees_for(levels) for levels in range(LEVELS + 1)])
    ran = None
    while depths is not None:
        wanted = depths.groupBy("rep").agg(F.get(need, F.max("levels")).alias("high"))
        wanted = wanted.withColumn("low", F.lit(TREES)) if ran is None else \
            wanted.join(ran.select("rep", F.col("high").alias("low")), "rep")
        ran = materialize(wanted.where("high > low"))
        if ran.isEmpty():
            break
        more = classes.join(ran, "rep").select("rep", "sketch", "low", "high").mapInArrow(_roots, _ROOTS)
        more, depths = _descend(_labelled(more, labels), classes)
        pairs = pairs.unionByName(more)
    # 5. confirm
    second = confirmed(pairs.distinct(), texts)
    linked = materialize(connected_components(first.unionByName(second), "a", "b"))
    release(classes, texts, labels, first, second)
    return linked


def _rest(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs in large nodes: classes outside the node's largest component with the node."""
    outside = rows.join(_open_nodes(rows).select("node", "top"), "node").where(F.col("label") != F.col("top")) \
        .select("node", F.col("rep").alias("x"), F.col("label").alias("lx"))
    pairs = rows.select("node", "rep", "label").join(outside, "node").where(F.col("label") != F.col("lx")) \
        .select(F.least("rep", "x").alias("a"), F.greatest("rep", "x").alias("b")).distinct()
    shorts = classes.select("rep", "sketch").mapInArrow(_short, "rep bigint, short binary")
    return pairs.join(_side(shorts, "a"), "a").join(_side(shorts, "b"), "b") \
        .select("a", "b", "short_a", "short_b").mapInArrow(_allowed, _COUNTED).select("a", "b")


def near_dedup(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs`` (``doc_id, text``)."""
    small_batches(docs, 250)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    sketched = materialize(docs.mapInArrow(
        _sketch, "doc_id bigint, n_shingles bigint, digest binary, sketch binary, bins binary"))
    linked = near_links(docs, sketched)
    members = sketched.select("doc_id", "n_shingles", "digest")
    reps = members.where("doc_id is not null and n_shingles > 0").groupBy("digest", "n_shingles") \
        .agg(F.min("doc_id").alias("rep"))
    placed = members.join(reps, ["digest", "n_shingles"], "left").join(linked, F.col("rep") == F.col("id"), "left") \
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
                .alias("component_id"))
    # a doc_id with several texts links all their classes
    several = placed.where("doc_id is not null").groupBy("doc_id") \
        .agg(F.min("component_id").alias("_lo"), F.max("component_id").alias("_hi")).where("_lo <> _hi")
    if not several.isEmpty():
        again = connected_components(placed.join(several, "doc_id").select("doc_id", "component_id")
                                     .unionByName(placed.select("doc_id", "component_id")), "doc_id", "component_id")
        placed = placed.join(again, F.col("doc_id") == F.col("id"), "left") \
            .select("doc_id", "n_shingles", F.coalesce("component", "component_id").alias("component_id"))
    return placed.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group, with all columns: the one of the smallest doc_id
    (of rows that repeat it, one). Rows without doc_id stay."""
    kept = near_dedup(docs).where("kept and doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n"))
    kept = materialize(kept.select(F.col("doc_id").alias("_id"), "_n"))
    rows = docs.join(kept.select("_id").hint("merge"), F.col("doc_id") == F.col("_id"), "left_semi")
    if not kept.where("_n > 1").isEmpty():
        rows = rows.dropDuplicates(["doc_id"])
    return rows.unionByName(docs.where("doc_id is null"))


SQL = r"""
WITH RECURSIVE
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
       FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS id, doc_id AS r FROM n UNION SELECT reach.id, edges.y FROM reach JOIN edges ON edges.x = reach.r),
comp AS (SELECT id, min(r) AS c FROM reach GROUP BY id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(comp.c, d.doc_id) AS component_id,
       d.doc_id = coalesce(comp.c, d.doc_id) AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN comp ON comp.id = d.doc_id
"""
