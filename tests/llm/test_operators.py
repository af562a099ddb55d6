import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash

from foliant.llm import (decontaminate, license_scan, lm_scoring, near_dedup, quality_classifier, quality_rules,
                         sentencepiece_codec, suffix_dedup, toxicity, warc)
from foliant.llm.queries import piece_model
from tests.llm.conftest import english, odd_rows

WHITE = re.compile(r"[^\x20\x09-\x0D]+")


def lower_az(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


# -- 1 ------------------------------------------------------------------------

def test_sentencepiece_equals_the_library(odd_docs, no_docs):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    want = []
    for i, t in odd_rows():
        ids = sp.encode(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), tuple(ids), sp.decode(ids)))
    got = sentencepiece_codec.encode(odd_docs, piece_model(), block_bytes=2000)
    got = sorted(((r.doc_id, r.n_tokens, r.ids_sha256, tuple(r.ids), r.decoded) for r in got.collect()), key=repr)
    assert got == sorted(want, key=repr)
    assert sentencepiece_codec.digest(no_docs, piece_model()).collect() == []


@pytest.mark.parametrize("text", ["", " ", "  ", " a", "a ", "a  b", "▁", "a▁", "\n", "a\n b", "   a   "])
def test_marked_words_cover_the_text(text):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    lone = sp.piece_to_id("▁")
    own = [i for w in sentencepiece_codec.marked_words(text.replace("▁", " ")) for i in (sp.encode(w) if w else [lone])]
    assert own == sp.encode(text)


# -- 2 ------------------------------------------------------------------------

ITEM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_hits(text, items):
    w = ITEM.findall(lower_az(text or ""))
    hit, names = set(), set()
    for name, item in items:
        v = ITEM.findall(lower_az(item or ""))
        n = min(len(v), 10)
        for win in ({tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if v else ()):
            for p in range(len(w) - n + 1):
                if tuple(w[p:p + n]) == win:
                    hit.update(range(p, p + n))
                    names.add("" if name is None else str(name))
    return len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


def test_decontamination_equals_brute_force(spark, odd_docs, no_docs):
    items = [(1, " ".join(english(120, 1).split()[20:45])), (2, "one"), (3, "Two, THREE"), (4, None), (5, ""), (None, "zwei wörter"),
             (10, "spam " * 12), (10, "spam " * 12), (11, english(30, 9)), (12, "w1 w1 w1")]
    bench = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, len string")
    got = rows_of(decontaminate.digest(decontaminate.decontaminate(odd_docs, bench)),
                  "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == sorted(((i, *brute_hits(t, items)) for i, t in odd_rows()), key=repr)
    clean = decontaminate.clean(odd_docs, bench)
    assert clean.columns == odd_docs.columns
    assert clean.count() == sum(not r[5] for r in got)
    assert decontaminate.decontaminate(no_docs, bench).collect() == []
    none = decontaminate.decontaminate(odd_docs, bench.limit(0))
    assert none.where("contaminated").count() == 0 and none.count() == len(odd_rows())


# -- 3 ------------------------------------------------------------------------

def test_decontamination_with_exchanged_tokens(spark):
    """Beyond the broadcast bound no row carries a whole text, and the result is the same."""
    long = english(20_000, 11).split()
    items = [(1, " ".join(long[700:715])), (2, " ".join(long[19_990:])), (3, "short one"), (4, english(30, 12))]
    rows = [(1, " ".join(long)), (2, english(300, 13)), (3, "x short one y"), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    toks = decontaminate.tokens(decontaminate.windows(bench))
    plan = decontaminate.places(docs, toks, 0)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan
    both = [sorted(decontaminate.digest(decontaminate.decontaminate(docs, bench, n)).collect(), key=repr) for n in (0, 1_000_000)]
    assert both[0] == both[1]
    got = sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in both[0]), key=repr)
    assert got == sorted(((i, *brute_hits(t, items)) for i, t in rows), key=repr)


def test_cross_entropy_difference(spark, no_docs, odd_docs, odd_labels):
    good = [(i, english(60, i % 3)) for i in range(40)]
    bad = [(100 + i, " ".join(f"q{(i * 31 + k) % 97}" for k in range(60))) for i in range(40)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)] + [(100 + i, 0, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in lm_scoring.cross_entropy_difference(docs, labels, 500, 12).collect()}
    held = sorted(got, key=lambda i: got[i].score)[:40]
    assert set(held) == set(range(40))
    assert all(abs(r.score - (r.target_loss - r.background_loss)) < 1e-9 for r in got.values())
    odd = rows_of(lm_scoring.cross_entropy_difference(odd_docs, odd_labels, 500, 12), "doc_id", "n_words", "score")
    assert [(i, n) for i, n, _ in odd] == sorted(((i, len(WHITE.findall(t or ""))) for i, t in odd_rows()), key=repr) \
        or sorted((repr((i, n)) for i, n, _ in odd)) == sorted(repr((i, len(WHITE.findall(t or "")))) for i, t in odd_rows())
    assert all(s == 0 for _, n, s in odd if n == 0)
    assert lm_scoring.cross_entropy_difference(no_docs, labels, 500, 12).collect() == []


def test_shared_vocabulary_is_the_most_frequent_words(spark):
    import numpy as np
    from foliant.llm.text import hash_spans
    docs = spark.createDataFrame([(i, "a a b " + ("c " * 5 if i == 3 else "") + f"rare{i}") for i in range(8)], "doc_id long, text string")
    known = lm_scoring.vocabulary(docs, 3)
    want = [hash_spans(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0] for w in (b"a", b"b", b"c")]
    assert sorted(known.tolist()) == sorted(int(x) for x in want)


def brute_losses(rows, good):
    """Mean losses of each row under models with a count for every word and pair."""
    import math
    texts = [(i, WHITE.findall(lower_az(t or ""))) for i, t in rows]
    word, pair, history = ([Counter(), Counter()] for _ in range(3))
    for i, w in texts:
        for m in (0, 1) if i in good else (0,):
            for v, x in zip([None, *w], w):
                word[m][x] += 1
                pair[m][v, x] += 1
                history[m][v] += 1
    size, total = len(word[0]), [sum(c.values()) for c in word]

    def loss(m, v, x):
        p = (word[m][x] + size * (word[0][x] + 1) / (total[0] + size)) / (total[m] + size)
        return -math.log((pair[m][v, x] + 20 * p) / (history[m][v] + 20))

    return sorted(((i, len(w), *[sum(loss(m, v, x) for v, x in zip([None, *w], w)) / len(w) if w else None for m in (0, 1)])
                   for i, w in texts), key=lambda r: (repr(r[:2]), r[2] or 0))


@pytest.mark.parametrize("words, bits, chunk", [(3, 2, 50), (30_000, 20, 500_000)])
def test_lm_losses_equal_brute_force(spark, odd_docs, odd_labels, monkeypatch, words, bits, chunk):
    """Every word and pair has its own counts, whatever is broadcast."""
    monkeypatch.setattr(lm_scoring, "CHUNK", chunk)
    good = {i for i in range(1, 21) if i not in (13, 15, 20)} | {99}
    got = lm_scoring.cross_entropy_difference(odd_docs, odd_labels, words, bits).collect()
    got = sorted(((r.doc_id, r.n_words, r.background_loss, r.target_loss) for r in got), key=lambda r: (repr(r[:2]), r[2] or 0))
    want = brute_losses(odd_rows(), good)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    for g, x in zip(got, want):
        assert g[2:] == x[2:] == (None, None) or g[2:] == pytest.approx(x[2:], abs=1e-8)


# -- 4 ------------------------------------------------------------------------

def shingle_set(t):
    w = WHITE.findall(lower_az(t or ""))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in sets:
        for j, b in sets:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=repr)


def test_near_dedup_equals_brute_force(odd_docs, no_docs):
    got = near_dedup.near_dedup(odd_docs)
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == brute_components(odd_rows())
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got.collect())
    kept = near_dedup.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for i, _, c in brute_components(odd_rows()) if i is not None})
    assert near_dedup.near_dedup(no_docs).collect() == []


def test_near_dedup_in_large_nodes(spark, monkeypatch):
    """Small leaves and few levels drive every branch: stars, branching and the rest join."""
    monkeypatch.setattr(near_dedup, "LEAF_PAIRS", 2)
    monkeypatch.setattr(near_dedup, "LEVELS", 1)
    base = english(100, 1).split()
    rows = [(i, " ".join(base[:i % 30] + [f"n{i}"] + base[i % 30 + 1:])) for i in range(40)]
    rows += [(100 + i, " ".join(base[:60] + english(40, i).split())) for i in range(20)]
    got = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == brute_components(rows)


def test_leaves_compare_components_of_equal_size():
    """Interleaved components that tie for the largest: every cross pair is compared."""
    import numpy as np
    import pyarrow as pa
    bins = [np.full(near_dedup.BINS, k, np.uint8).tobytes() for k in (7, 7, 8, 9)]
    batch = pa.RecordBatch.from_arrays([pa.array([5] * 4), pa.array([1, 2, 3, 4]), pa.array([1, 2, 1, 2]), pa.array([90] * 4), pa.array(bins),
                                        pa.array([[5, 9], [9, 5], [5], [5]])], ["node", "rep", "label", "n_shingles", "bins", "nodes"])
    got = [r for out in near_dedup._leaf_pairs([batch]) for r in out.to_pylist()]
    assert got == [{"a": 1, "b": 2}]


def test_leaves_give_a_pair_once():
    import numpy as np
    import pyarrow as pa
    nodes = {1: [4, 7, 9], 2: [9, 7], 3: [4, 9], 4: [7]}
    rows = sorted((n, r, ns) for r, ns in nodes.items() for n in ns)
    one = np.full(near_dedup.BINS, 3, np.uint8).tobytes()
    batch = pa.RecordBatch.from_arrays([pa.array([n for n, _, _ in rows]), pa.array([r for _, r, _ in rows]), pa.array([r for _, r, _ in rows]),
                                        pa.array([90] * len(rows)), pa.array([one] * len(rows)), pa.array([ns for _, _, ns in rows])],
                                       ["node", "rep", "label", "n_shingles", "bins", "nodes"])
    got = [(r["a"], r["b"]) for out in near_dedup._leaf_pairs([batch]) for r in out.to_pylist()]
    assert sorted(got) == [(1, 2), (1, 3), (1, 4), (2, 3), (2, 4)]  # 3 and 4 share no leaf


def test_second_sketch_keeps_all_similar_sets():
    """Pairs at the threshold pass, at every size; most pairs well below it don't."""
    import numpy as np
    draw = np.random.default_rng(8)

    def passed(size, common, times):
        out = 0
        for _ in range(times):
            values = np.unique(draw.integers(0, 2**64, 2 * size - common + 8, np.uint64))
            draw.shuffle(values)
            a, b = np.sort(values[:size]), np.sort(values[size - common: 2 * size - common])
            out += int(near_dedup.bins_allow(near_dedup.binned(a)[None, :], np.array([size]), near_dedup.binned(b), size)[0])
        return out

    for size in (4, 7, 35, 140, 700, 7000):
        common = -(-150 * size // 175)  # similarity 0.75 or just above
        assert passed(size, common, 300) == 300
    for size in (140, 700, 7000):
        common = 124 * size // 162  # similarity 0.62
        assert passed(size, common, 200) < 20
    assert not near_dedup.bins_allow(near_dedup.binned(np.arange(9, dtype=np.uint64))[None, :], np.array([9]), near_dedup.binned(np.arange(13, dtype=np.uint64)), 13)[0]


def test_trees_follow_the_depth():
    """At six levels, by simulation: the trees of the root lose pairs, those for the depth don't."""
    import numpy as np
    from foliant.llm.text import mix
    draw = np.random.default_rng(3)
    pairs, c = 2000, near_dedup.COORDS
    left = draw.integers(0, 2**32, (8 * pairs, c), np.uint32)
    same = draw.random((8 * pairs, c)) < 0.75
    at = np.flatnonzero(same.sum(axis=1) >= near_dedup.MIN_EQUAL)[:pairs]
    left, same = left[at], same[at]
    right = np.where(same, left, left ^ np.uint32(1))

    def lost(trees):
        met = np.zeros(pairs, bool)
        for tree in range(1, trees + 1):
            node = np.repeat(mix(np.array([tree], np.uint64) * np.uint64(0xD6E8FEB86659FD93)), pairs)
            own = np.arange(pairs)
            for _ in range(7):
                a, i = near_dedup._branch(node, left[own])
                b, _ = near_dedup._branch(node, right[own])
                node, own = a[a == b].view(np.uint64), own[i[a == b]]
            met[own] = True
        return int((~met).sum())

    assert lost(near_dedup.TREES) >= 5
    assert lost(near_dedup.trees_for(6)) == 0
    assert near_dedup.trees_for(0) == near_dedup.TREES


def test_deep_nodes_get_more_trees(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "LEAF_PAIRS", 0)
    monkeypatch.setattr(near_dedup, "LEVELS", 2)
    rounds, descend = [], near_dedup._descend

    def spy(rows, classes):
        rounds.append(rows.select("rep").distinct().count())
        return descend(rows, classes)

    monkeypatch.setattr(near_dedup, "_descend", spy)
    base = english(100, 1).split()
    rows = [(i, " ".join(base[:60] + [f"n{i // 2}x{k}" for k in range(40 - i % 2)])) for i in range(24)]
    got = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == brute_components(rows)
    assert len(rounds) > 1 and rounds[1] > 1


# -- 5 ------------------------------------------------------------------------

def test_license_scan_finds_families(spark, odd_docs, no_docs):
    lines = {"apache-2.0": "Licensed under the Apache License, Version 2.0.", "mit": "Released under the MIT License.",
             "gpl": "this work is licensed under the GNU general public license, version 3"}
    rows = [(i, english(60, i) + "\n" + english(20, i + 50)) for i in range(200)]
    rows += [(1000 + k, english(30, k) + "\n" + t + "\n" + english(10, k)) for k, t in enumerate(lines.values())]
    rows += [(2000, "The license of the version is under the public software."), (2001, " and ".join(lines[k] for k in ("mit",)))]
    got = {r.doc_id: r for r in license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[1000 + k].families for k in range(3)] == list(lines)
    assert all(got[i].n_licensed == 0 for i in [*range(200), 2000]) and got[2001].families == "mit"
    assert got[1000].n_paragraphs == 3
    odd = license_scan.license_scan(odd_docs)
    assert odd.count() == len(odd_rows())
    assert [r.families for r in odd.where("doc_id = 18").collect()] == ["apache-2.0"]
    assert license_scan.license_scan(no_docs).collect() == []


def test_license_scan_of_real_notices(spark):
    """Notices as they stand in files, most of them wrapped over lines."""
    notices = {
        "mit": "The above copyright notice and this permission notice shall be included in\nall copies or substantial portions of the Software.\n"
               "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\n"
               "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "bsd": "3. Neither the name of the project nor the names of its contributors may be used\nto endorse or promote products derived from this software without specific\nprior written permission.",
        "isc": "Permission to use, copy, modify, and distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.",
        "unlicense": "This is free and unencumbered software released into the public domain.",
        "agpl": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU Affero General Public License as published\nby the Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.",
        "gpl": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 2 of the License, or\n(at your option) any later version.",
        "apache-2.0": "// SPDX-License-Identifier: Apache-2.0", "zlib": "This notice may not be removed or altered from any source distribution.",
        "epl-2.0": "# SPDX-License-Identifier: EPL-2.0", "mpl-2.0": "If a copy of the MPL was not distributed with this\nfile, You can obtain one at http://mozilla.org/MPL/2.0/.",
    }
    rows = [(i, english(60, i) + "\n" + english(20, i + 50)) for i in range(120)]
    rows += [(1000 + k, english(30, k) + "\n\n" + t + "\n\n" + english(10, k)) for k, t in enumerate(notices.values())]
    rows += [(1100, "// SPDX-License-Identifier: MIT"), (1101, "see the terms"), (1102, "of the software")]
    got = {r.doc_id: r for r in license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {f: got[1000 + k].families for k, f in enumerate(notices)} == {f: f for f in notices}
    assert got[1100].families == "mit" and got[1101].families == got[1102].families == ""
    assert all(got[i].n_licensed == 0 for i in range(120))


def test_license_training_takes_every_line(spark, monkeypatch):
    """Each distinct line of unknown class teaches or calibrates, beyond any fixed number."""
    from pyspark.sql import functions as F
    seen, weights = [], []

    class Recorded(license_scan.LogisticRegression):
        def fit(self, learn):
            weights.append(learn.where("label = 0").agg(F.sum("weight")).first()[0])
            return super().fit(learn)

    real = license_scan.train
    monkeypatch.setattr(license_scan, "train", lambda known, unknown, *a: seen.append(unknown.groupBy("held").count().collect()) or real(known, unknown, *a))
    monkeypatch.setattr(license_scan, "LogisticRegression", Recorded)
    lines = [english(8, i) for i in range(4500)]
    rows = [(i, "\n".join(lines[3 * i: 3 * i + 6] + ["Released under the MIT License."])) for i in range(1500)]
    got = license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string"))
    taught, held = (dict(seen[0])[k] for k in (False, True))
    assert taught + held == 4500 and 900 < held < 1350
    assert abs(weights[0] - license_scan.TAUGHT) < 1e-6  # taught x (TAUGHT / taught)
    assert got.where(F.col("families") == "mit").count() == 1500


def test_license_threshold_is_the_exact_percentile(spark):
    from pyspark.sql import functions as F
    rnd = random.Random(4)
    for n in (1, 2, 900, 3001):
        df = spark.createDataFrame([(rnd.random(),) for _ in range(n)], "probability double")
        want = df.agg(F.percentile("probability", F.lit(1 - license_scan.FALSE_RATE))).first()[0]
        assert abs(license_scan._percentile(df, n) - want) < 1e-12
    assert license_scan._percentile(df.limit(0), 0) == 0.0


def test_license_probabilities_equal_plain_python(spark):
    """The joined scoring against the softmax of summed weights."""
    import math
    from pyspark.sql import functions as F
    rnd = random.Random(6)
    n = len(license_scan.FAMILIES)
    lines = [[f"w{rnd.randrange(30)}" for _ in range(rnd.randrange(1, 12))] for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(lines)), "key long, w array<string>")
    buckets = {r.key: set(r.b) for r in df.select("key", license_scan._buckets(F.col("w")).alias("b")).collect()}
    used = sorted({b for bs in buckets.values() for b in bs})
    table = {b: [rnd.gauss(0, 1) for _ in range(n)] for b in used[::2]}
    bias = [rnd.gauss(0, 1) for _ in range(n)]
    weights = spark.createDataFrame(list(table.items()), "bucket int, weights array<double>")
    for r in license_scan.probabilities(df, weights, bias).collect():
        z = [bias[i] + sum(table[b][i] for b in buckets[r.key] if b in table) for i in range(n)]
        e = [math.exp(x - max(z)) for x in z]
        best = max(range(1, n), key=lambda i: e[i])
        assert r.family == license_scan.FAMILIES[best] and abs(r.probability - e[best] / sum(e)) < 1e-8


# -- 6 and 10 -------------------------------------------------------------------

def check_folds(got, of, held):
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % of == held)
        assert 0 <= r.score <= 1


def test_toxicity(spark, odd_docs, odd_labels, no_docs):
    rows = [(i, english(40, i) + (" you pathetic, Idiot! " if i % 5 == 0 else "")) for i in range(600)]
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(600)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(spark.createDataFrame(rows, "doc_id long, text string"), labels).collect()
    check_folds(got, 5, 0)
    held = [r for r in got if r.held_out]
    assert held and sum(r.predicted == int(r.doc_id % 5 == 0) for r in held) >= 0.97 * len(held)
    odd = toxicity.toxicity(odd_docs, odd_labels).collect()
    check_folds(odd, 5, 0)
    assert len(odd) == len(odd_rows())
    assert toxicity.toxicity(no_docs, odd_labels).collect() == []
    assert {r.score for r in toxicity.toxicity(odd_docs, odd_labels.limit(0)).collect()} == {0.5}


def test_quality_classifier(spark, odd_docs, odd_labels, no_docs):
    rows = [(i, " | ".join(english(40, i).split()) if i % 4 == 0 else english(60, i)) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(400)], "doc_id long, quality int, toxic int")
    got = quality_classifier.quality(spark.createDataFrame(rows, "doc_id long, text string"), labels).collect()
    check_folds(got, 4, 2)
    held = [r for r in got if r.held_out]
    assert held and sum(r.predicted == int(r.doc_id % 4 != 0) for r in held) >= 0.95 * len(held)
    assert all(r.predicted == int(r.score >= 0.7) for r in got)
    odd = quality_classifier.quality(odd_docs, odd_labels).collect()
    check_folds(odd, 4, 2)
    assert len(odd) == len(odd_rows())
    assert quality_classifier.quality(no_docs, odd_labels).collect() == []


def test_training_sample_is_bounded_by_rows(spark):
    """A labelled doc_id that many rows repeat doesn't pass the bound."""
    from foliant.llm.labelled import sample
    docs = spark.createDataFrame([(1, f"t{i % 30}") for i in range(60)] + [(2, "u")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, y int")
    assert sample(docs, labels, "y", 5, -1, 8).count() == 8
    assert sample(docs, labels, "y", 5, -1, 100).count() == 31


# -- 7 ------------------------------------------------------------------------

def test_warc_round_trip(spark):
    rows = [(1, "http://a/", "<p>x</p>"), (2, "http://b/", "<p>x</p>"), (3, None, None), (4, "http://c/\n d", ""), (5, "u", "ä" * 5000),
            (None, "http://n/", "<p>x</p>"), (None, "http://n/", "solo"), (7, "http://t/", "tie\r\n\r\nWARC/1.1"), (7, "http://t/", "tie\r\n\r\nWARC/1.1")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, payload string")
    got = rows_of(warc.round_trip(pages), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    want = []
    for i, _, h in rows:
        same = [j for j, _, g in rows if (g or "") == (h or "") and j is not None]
        first = min(same) if same else None
        visit = first is not None and i != first
        data = (h or "").encode()
        want.append((i, len(data), warc.digest_of(data), "revisit" if visit else "response", first if visit else None))
    assert got == sorted(want, key=repr)
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_archives_are_read_by_several_tasks(spark, tmp_path):
    names = spark.createDataFrame([(f"a{i}",) for i in range(40)], "archive string")
    frame = warc.read_archives(spark, str(tmp_path), names)
    assert frame.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1
    from pyspark.sql import functions as F
    dealt = names.distinct().repartition(4, F.xxhash64("archive", F.lit("deal"))).groupBy(F.spark_partition_id()).count().collect()
    assert len(dealt) > 1


def test_warc_records_stand_alone(spark, tmp_path):
    """Any record can be read by the dictionary and its offset."""
    import struct
    import zstandard
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"<html><body>{english(200, i)}</body></html>") for i in range(300)],
                                  "page_id long, url string, html string")
    index = warc.write_archives(pages, str(tmp_path / "arc")).collect()
    assert len(index) == 300
    for r in index[::37]:
        data = (tmp_path / "arc" / r.archive).read_bytes()
        magic, size = struct.unpack("<II", data[:8])
        assert magic == warc.SKIPPABLE and size > 0
        tool = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8: 8 + size]))
        text = tool.decompressobj().decompress(data[r.offset: r.offset + r.length])
        assert f"X-Page-ID: {r.page_id}\r\n".encode() in text


# -- 8 ------------------------------------------------------------------------

def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def word_hash(w):
    return signed(xxhash.xxh64(w.encode(), seed=42).intdigest())


def pair_hash(a, b):
    first = xxhash.xxh64((a & (1 << 64) - 1).to_bytes(8, "little"), seed=42).intdigest()
    return signed(xxhash.xxh64((b & (1 << 64) - 1).to_bytes(8, "little"), seed=first).intdigest())


def grams(t):
    h = [word_hash(w) for w in WHITE.findall(t or "")]
    return h + [pair_hash(a, b) for a, b in zip(h, h[1:])]


def brute_rules(rows, target, buckets, threshold):
    import math
    raw, good = Counter(), Counter()
    for i, t in rows:
        own = Counter(g % buckets for g in grams(t))
        raw.update(own)
        if i in target:
            good.update(own)
    n, m = sum(raw.values()) + buckets, sum(good.values()) + buckets
    table = [round((math.log((good[b] + 1) / m) - math.log((raw[b] + 1) / n)) * 1_000_000) for b in range(buckets)]
    out = []
    for i, t in rows:
        t = t or ""
        w = WHITE.findall(t)
        lines = [x for x in t.split("\n") if WHITE.search(x)]
        win = defaultdict(list)
        for p in range(len(w) - 4):
            win[tuple(w[p:p + 5])].append(p)
        rep = {q for ps in win.values() if len(ps) > 1 for p in ps for q in range(p, p + 5)}
        g = grams(t)
        llr = sum(table[x % buckets] for x in g) / len(g) / 1_000_000 if g else 0.0
        failed = len(w) < 10 or 100 * len(rep) > 20 * len(w)
        out.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(rep),
                    round(llr, 9), failed, not failed and llr >= threshold))
    return sorted(out, key=repr)


def test_quality_rules_equal_brute_force(spark, odd_docs, odd_labels, no_docs):
    target = {r.doc_id for r in odd_labels.collect() if r.quality == 1 and r.doc_id is not None}
    got = quality_rules.quality_rules(odd_docs, odd_labels, buckets=64, threshold=-0.05)
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, round(r.llr, 9), r.base_failed, r.kept)
                  for r in got.collect()), key=repr)
    assert got == brute_rules(odd_rows(), target, 64, -0.05)
    kept = quality_rules.keep_good(odd_docs, odd_labels, buckets=64, threshold=-0.05)
    assert kept.columns == odd_docs.columns and kept.count() == sum(r[-1] for r in got)
    assert quality_rules.quality_rules(no_docs, odd_labels).collect() == []
    assert quality_rules.quality_rules(odd_docs, odd_labels.limit(0)).count() == len(odd_rows())


def test_target_is_counted_over_all_good_ids(spark, monkeypatch):
    """All rows are good ones, so both multinomials are equal."""
    docs = spark.range(20_500).selectExpr("id as doc_id", "concat('w', id % 50, ' x') as text")
    labels = docs.selectExpr("doc_id", "1 as quality")
    ids = quality_rules.good_ids(labels)
    assert set(quality_rules.log_ratios(docs, ids, 64)) == {0}
    few = quality_rules.log_ratios(docs, ids.where("doc_id < 700"), 64)
    monkeypatch.setattr(quality_rules, "BROADCAST_IDS", 5)
    assert quality_rules.log_ratios(docs, ids.where("doc_id < 700"), 64) == few


# -- 9 ------------------------------------------------------------------------

def brute_repeats(rows):
    """Rows in order -> n_bytes, n_removed, n_spans, what is left."""
    seen, out = set(), []
    for t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            s = b[p:p + 100]
            if s in seen:
                gone[p:p + 100] = b"\1" * 100
            seen.add(s)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone) if not g)))
    return out


def check_repeats(spark, rows):
    got = {r.doc_id: r for r in suffix_dedup.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    rows = sorted(rows)
    for (i, _), (n, removed, spans, left) in zip(rows, brute_repeats([t for _, t in rows])):
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, removed, spans, hashlib.sha256(left).hexdigest()), i
    assert len(got) == len(rows)


def test_suffix_dedup_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "RUN", 200)
    passage = english(60, 1)
    rows = [(i, english(20, i + 10) + " " + passage[i:] + " " + english(10, i + 40)) for i in range(25)]
    rows += [(30, "ab" * 400), (31, "ab" * 60 + "c" + "ab" * 200), (32, "é" * 150), (33, "x" + "é" * 90), (34, passage), (35, passage[:99]),
             (36, passage[:100]), (37, ""), (38, None), (39, passage + passage), (40, english(5000, 3)), (41, english(5000, 3)[7:20000])]
    rows += [(50 + i, "The same short line of all documents, again.\n" + english(30, 200 + i)) for i in range(60)]
    check_repeats(spark, [(i, t or "") for i, t in rows])


def test_suffix_dedup_odd_rows(spark, odd_docs, no_docs):
    got = rows_of(suffix_dedup.suffix_dedup(odd_docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    key = lambda r: (r[0] is None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest())
    distinct = {key(r): r for r in odd_rows()}
    order = sorted(distinct)
    figures = dict(zip(order, brute_repeats([distinct[k][1] for k in order])))
    want = sorted(((r[0], *figures[key(r)][:3], hashlib.sha256(figures[key(r)][3]).hexdigest()) for r in odd_rows()), key=repr)
    assert got == want
    cut = suffix_dedup.cut_repeats(odd_docs)
    assert cut.columns == odd_docs.columns and cut.count() == len(odd_rows())
    assert all(r.n_chars == len(r.text) for r in cut.collect() if r.text is not None)
    assert suffix_dedup.suffix_dedup(no_docs).collect() == []


def test_loser_tree_gives_known_prefixes():
    import random
    rng = random.Random(3)
    runs, everything = [], []
    for n in range(7):
        own = sorted((bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 9))), (n, k)) for k in range(rng.randrange(0, 40)))
        everything += own
        shared, lengths, rests = suffix_dedup.front_code([s for s, _ in own])
        runs.append(suffix_dedup.read_run(shared, lengths, rests, [e for _, e in own]))
    got = list(suffix_dedup.merge_runs(runs))
    assert [(s, e) for _, s, e in got] == sorted(everything)
    for (_, a, _), (k, b, _) in zip(got, got[1:]):
        assert k == suffix_dedup.common(a, b, 0)


# -- pipeline -------------------------------------------------------------------

def test_pipeline_equals_its_parts(spark, tmp_path):
    import sentencepiece

    import corpus_pipeline as C
    bench = [(1, english(25, 900))]
    rows = [(i, english(80, i) + "\n" + english(40, i + 300)) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(5)] + [(110, rows[7][1] + " tail"), (120, english(40, 500) + " " + bench[0][1]),
                                                         (130, "too short"), (131, None), (132, "")]
    rows += [(140 + i, english(60, 600 + i) + " " + english(60, 1) + " " + english(60, 700 + i)) for i in range(3)]
    for name, data, schema in (("documents", [(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long"),
                               ("benchmark", bench, "item_id long, text string"),
                               ("labels", [(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int")):
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    rules = brute_rules(rows, set(range(60)), quality_rules.BUCKETS, quality_rules.THRESHOLD)
    left = sorted((i, dict(rows)[i]) for i in [r[0] for r in rules if r[-1]])
    comp = {i: c for i, _, c in brute_components(left)}
    left = [(i, t) for i, t in left if comp[i] == i]
    left = [(i, x[3].decode(errors="ignore")) for (i, _), x in zip(left, brute_repeats([t for _, t in left]))]
    left = [(i, t) for i, t in left if not brute_hits(t, bench)[-1]]
    sp = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    got = {r.doc_id: list(r.ids) for r in C.run(spark, str(tmp_path)).collect()}
    assert got == {i: sp.encode(t) for i, t in left}
    assert 120 not in got and 100 not in got and 131 not in got and len(got) > 30
