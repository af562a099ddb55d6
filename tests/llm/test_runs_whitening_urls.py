"""Periodic runs, embedding whitening and URL filter against brute force."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from foliant.llm import periodic_runs, url_filter, whitening
from tests.llm.conftest import EXTRA, english, odd_rows

WHITE = re.compile(r"[^\x20\x09-\x0D]+")


# -- 11 -----------------------------------------------------------------------

def brute_runs(words, least=24, power=3):
    found = set()
    for q in range(1, len(words) // power + 1):
        same = [words[k] == words[k + q] for k in range(len(words) - q)] + [False]
        start = 0
        for k, equal in enumerate(same):
            if not equal:
                length = k - start + q
                if length >= max(least, power * q):
                    own = words[start:start + length]
                    if not any(own[r:] == own[:-r] for r in range(1, q)):
                        found.add((start, length, q))
                start = k + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_digest(doc_id, text):
    words = WHITE.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    return (doc_id, len(runs), *top, None if top[0] is None else 1000 * top[1] // top[2],
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def run_rows():
    rnd = random.Random(4)
    rows = [r for r in odd_rows() if len(r[1] or "") < 100_000]
    for i in range(200, 320):
        words = []
        while len(words) < 150:
            part = [f"w{rnd.randrange(rnd.choice([1, 2, 3, 40]))}" for _ in range(rnd.randrange(1, 25))]
            words += part * rnd.choice([1, 1, 2, 3, 4, 9])
        rows.append((i, " \n".join(words)))
    return rows


def test_runs_equal_brute_force(spark, no_docs):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame(run_rows(), "doc_id long, text string").repartition(3).select("*", *[F.lit("x").alias(c) for c in [*EXTRA, "runs", "start"]])
    got = periodic_runs.digest(periodic_runs.periodic_runs(docs, periodic_runs.planted)).collect()
    want = [brute_digest(i, t) for i, t in run_rows()]
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=repr) == sorted(want, key=repr)
    assert sum(w[1] > 0 for w in want) > 50
    assert periodic_runs.digest(periodic_runs.periodic_runs(no_docs, periodic_runs.planted)).collect() == []


def test_runs_of_a_very_long_text(spark):
    block = english(2000, 9).split()
    words = english(3000, 5).split() + block * 5 + ["x"] * 30
    got = periodic_runs.periodic_runs(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")).first()
    assert [(r.start, r.length, r.period) for r in got.runs] == [(3000, 10000, 2000), (13000, 30, 1)]
    assert got.collapsed == " ".join(words[:5000] + ["x"])


def test_runs_of_small_alphabets():
    rnd = random.Random(7)
    for _ in range(300):
        words = []
        while len(words) < rnd.choice([20, 60, 120]):
            words += [rnd.randrange(rnd.choice([1, 2, 3])) for _ in range(rnd.randrange(1, 9))] * rnd.choice([1, 2, 5])
        assert sorted((s, m, q) for _, s, m, q in periodic_runs.runs_of([words])) == sorted(brute_runs(words))
        h = np.array(words, np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(5)
        low, high = periodic_runs.stretches(h, np.array([0, len(words)]))
        inside = sorted((int(low[k]) + s, m, q) for k, s, m, q in periodic_runs.runs_of([words[a:b] for a, b in zip(low, high)]))
        assert inside == sorted(brute_runs(words))


def test_lce_equals_comparison():
    text = [1, 2, 1, 2, 2, 1, 1, 2, 1, 2, 2, 1, 3, 1, -1]
    lce = periodic_runs.Lce(text)
    for a in range(len(text)):
        for b in range(len(text)):
            if a != b:
                k = 0
                while max(a, b) + k < len(text) and text[a + k] == text[b + k]:
                    k += 1
                assert lce(np.array([a]), np.array([b]))[0] == k


# -- 12 -----------------------------------------------------------------------

def brute_white(vectors, k=8):
    x = np.array([[int(np.floor(1024 * float(c))) + 100_000 for c in v] for v in vectors], object)
    n, s = len(x), x.sum(axis=0)
    z = n * x - s
    v = (z.astype(float) / n)
    values, axes = np.linalg.eigh(v.T @ v / n)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    return (z ** 2).sum(axis=1), v @ axes / np.sqrt(values), values / np.trace(v.T @ v / n)


@pytest.mark.parametrize("d", [3, 24])
def test_whitening_equals_brute_force(spark, d):
    rnd = np.random.default_rng(d)
    good = (rnd.standard_normal((300, d)) * np.linspace(1, 4, d)).astype(np.float32)
    good[7] = good[8]
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(c) for c in v], "x") for i, v in enumerate(good)]
    rows += [(900, None, "x"), (901, [nan] * d, "x"), (902, [None] + [1.0] * (d - 1), "x"), (903, [inf] * d, "x"), (904, [], "x"),
             (905, [1.0] * (d + 1), "x"), (None, rows[3][1], "x"), (5, rows[9][1], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, whitened string").repartition(5)
    got = whitening.whiten(df).collect()
    kept = [r for r in rows if r[0] is None or r[0] < 900]
    deviation, white, explained = brute_white([r[1] for r in kept])
    k = min(8, d)
    assert len(got) == k * len(kept) and {r.n for r in got} == {len(kept)} and {r.component for r in got} == set(range(1, k + 1))
    assert all(r.identity_error <= 1e-10 for r in got)
    assert sorted(r.deviation for r in got if r.component == 1) == sorted(int(v) for v in deviation)
    for c in range(1, k + 1):
        mine = {}
        for r in got:
            if r.component == c:
                mine.setdefault((r.vec_id, r.deviation), r.whitened)
                assert abs(r.explained / explained[c - 1] - 1) < 1e-10
        values = np.array([mine[row[0], int(v)] for row, v in zip(kept, deviation)])
        sign = np.sign((values * white[:, c - 1]).sum())
        assert np.abs(values - sign * white[:, c - 1]).max() < 1e-8


def test_whitening_without_spread(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [float("nan")])], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(i, [0.5, 0.25]) for i in range(9)], schema)).collect() == []
    one = whitening.whiten(spark.createDataFrame([(i, [float(i), 0.25]) for i in range(9)], schema)).collect()
    assert {r.component for r in one} == {1} and len(one) == 9
    huge = whitening.whiten(spark.createDataFrame([(i, [float(i) * 3e37, 0.25]) for i in range(3)], schema)).collect()
    assert {r.component for r in huge} == {1}


@pytest.mark.parametrize("kind", ["spread", "equal", "clusters", "few"])
def test_leading_pairs_reach_double_precision(kind):
    rnd = np.random.default_rng(2)
    d = 60
    x = rnd.standard_normal((500, d))
    if kind == "clusters":
        x += 4 * rnd.standard_normal((10, d))[rnd.integers(0, 10, 500)]
    if kind == "few":
        x[:, 5:] = 0
    a = np.eye(d) if kind == "equal" else x.T @ x / 500
    values, axes, residual = whitening.leading_pairs(lambda b: a @ b, d, 8)
    assert residual < 1e-12 and np.allclose(values, np.linalg.eigvalsh(a)[::-1][:8], rtol=1e-12, atol=1e-13)
    assert np.abs(axes.T @ axes - np.eye(8)).max() < 1e-13


# -- 13 -----------------------------------------------------------------------

URLS = [
    "http://a.example.net/en/1", "HTTP://EXAMPLE.NET/EN/1", "https://b.org/fr/x?utm_source=a", "https://www.site.com/page/?ref=x&page=2#top",
    "http://site.com:80/page?page=2&utm_medium=y", "site.com/page", "ftp://x.example.com/de/1", "http://notexample.com/de/2", "http://net", "http://net/",
    "http://x.net?/q", "a://b://c/d", "https://www.other.io/a//", "https://other.io/a", None, "", "://", "http://", "http://ex.io/a\n", "http://ex.io/a",
    "http://org/fr/", "http://example.net/en", "https://ünï.de/ä?x=1", "https://long.io/" + "a/" * 20_000,
]
LISTED = ["http://site.com/page?page=2", "http://other.io/a/", "https://long.io/" + "a/" * 20_000, None, "http://b.org/fr/x", "http://ex.io/a"]


def brute_canonical(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in re.match(r"[^/?#]*", rest)[0])
    tail = rest[len(host):]
    path = re.match(r"[^?#]*", tail)[0]
    query = tail[len(path):].split("#", 1)[0][1:] if tail[len(path):].startswith("?") else ""
    bare = re.sub(r"^www\.", "", re.sub(r":(80|443)\Z", "", host))
    params = [p for p in query.split("&") if not re.match(r"(utm_[^&=]*|ref)=", p)]
    query = "&".join(params).lstrip("&")
    return host, path, bare + path.rstrip("/") + (f"?{query}" if query else "")


def brute_verdict(url, listed):
    host, path, canon = brute_canonical(url)
    best = None
    for verdict, h, p in url_filter.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, verdict)
    if best:
        return host, path, best[0], best[1]
    return host, path, None, "block" if canon is not None and canon in listed else "allow"


@pytest.mark.parametrize("broadcast_blocks", [100_000, 0])
def test_url_filter_equals_brute_force(spark, broadcast_blocks):
    rnd = random.Random(3)
    more = [f"http://{rnd.choice(['', 'www.'])}h{rnd.randrange(40)}.{rnd.choice(['com', 'io', 'net', 'org'])}/{rnd.choice(['fr', 'en'])}/{rnd.randrange(30)}{rnd.choice(['', '/', '?ref=a'])}"
            for _ in range(3000)]
    urls = URLS + more + ["http://hot.io/x"] * 1000
    listed = LISTED + ["http://hot.io/x"] + [f"https://h{i}.io/en/{k}" for i in range(40) for k in range(0, 30, 3)]
    names = {brute_canonical(u)[2] for u in listed if u is not None}
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)] + [(None, "http://a.net/", "x", "y")],
                                  "page_id long, url string, verdict string, possible string").repartition(4)
    got = url_filter.url_filter(pages, spark.createDataFrame([(u,) for u in listed], "url string"), broadcast_blocks=broadcast_blocks)
    want = [(i, *brute_verdict(u, names)) for i, u in enumerate(urls)] + [(None, "a.net", "/", "net/", "block")]
    rows = sorted((tuple(r[c] for c in ("page_id", "host", "path", "rule", "verdict")) for r in got.collect()), key=repr)
    assert rows == sorted(want, key=repr)
    assert sum(w[-1] == "block" for w in want) > 1000


def test_url_filter_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    some = spark.createDataFrame([(1, "http://a.io/"), (2, "http://a.net/")], "page_id long, url string")
    assert url_filter.url_filter(none, some.select("url")).collect() == []
    assert sorted((r.page_id, r.verdict) for r in url_filter.url_filter(some, none.select("url")).collect()) == [(1, "allow"), (2, "block")]
    assert sorted((r.page_id, r.verdict) for r in url_filter.url_filter(some, some.select("url"), rules=[]).collect()) == [(1, "block"), (2, "block")]


def test_bloom_filter_has_no_false_negatives_and_few_false_positives(spark):
    names = spark.range(20_000).selectExpr("concat('u', id) AS url")
    blocks = -(-20_000 * url_filter.BITS // 256)
    table = url_filter.bloom_blocks(names, blocks)
    tried = spark.range(60_000).selectExpr("concat('u', id) AS canonical_url", "id")
    got = url_filter.with_possible(tried, table, blocks, True)
    assert got.where("id < 20000 and not possible").count() == 0
    assert got.where("id >= 20000 and possible").count() < 40_000 * 0.01
