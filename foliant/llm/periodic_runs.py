"""Periodic run detection over the words of a document by suffix-tree LCE.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q``
apart are identical), at least ``max(LEAST_WORDS, LEAST_POWER * q)`` words long,
that no neighbouring word extends with period ``q``.

1. Stretches that can hold a run: a run has at least 8 equal words ``q`` apart at
   each of its 8-word grams, either before or behind, and ``q`` is at most a third
   of the run. So a run lies in a maximal stretch of grams that recur in their
   document at a distance of at most a third of the stretch. Stretches are cut by
   this rule until nothing changes; all other words are in no run. This is exact
   (equal hashes of unequal grams only leave longer stretches).
2. Ukkonen trees of the stretches of a document and of their reversal, each
   stretch ended by a symbol of its own. An Euler tour of each tree with a sparse
   table of minima gives the longest common extension (LCE) of two places in
   constant time, forwards and backwards.
3. Every run has a Lyndon root under one of the two orders of the words: the longest
   Lyndon word from a place ends at the next smaller suffix, by the order of the
   tree's leaves. Each place thus gives one candidate period per order; the two
   LCEs extend it to both sides.

Memory in a task: one Arrow batch of documents, and for one document at a time about
300 bytes times log2 of the words in its stretches.

Defined results: a null or empty text has no words and no runs; rows that repeat a
doc_id or have none are documents of their own; empty tables give an empty result;
other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.text import cut_words, hash_spans, mix, small_batches, utf8

LEAST_WORDS, LEAST_POWER = 24, 3
#: Words of the grams that find stretches. With least words 24 and power 3, all grams of
#: a run recur within it for every period up to this length (24 >= 2 q + 7 up to 8, 3 q beyond).
GRAM = 8
_STEP = np.uint64(0x9E3779B97F4A7C15)


# -- trees ----------------------------------------------------------------------

class SuffixTree:
    """Ukkonen's suffix tree of a list of ints whose last one occurs once.

    Node 0 is the root; node ``v > 0`` is entered by the symbols
    ``start[v]..end[v]`` (leaves: to the end of the text).
    """

    def __init__(self, text: list[int]):
        self.text = text
        n = len(text)
        children: list[dict[int, int] | None] = [{}]
        start, end, link = [0], [0], [0]
        node = edge = length = left = 0
        for at, symbol in enumerate(text):
            left += 1
            pending = 0
            while left:
                if not length:
                    edge = at
                below = children[node].get(text[edge])
                if below is None:
                    children[node][text[edge]] = len(start)
                    children.append(None)
                    start.append(at)
                    end.append(n)
                    link.append(0)
                    if pending:
                        link[pending] = node
                    pending = node
                else:
                    size = (end[below] if end[below] <= at else at + 1) - start[below]
                    if length >= size:
                        edge += size
                        length -= size
                        node = below
                        continue
                    if text[start[below] + length] == symbol:
                        length += 1
                        if pending:
                            link[pending] = node
                        break
                    middle = len(start)
                    children[node][text[edge]] = middle
                    start.append(start[below])
                    end.append(start[below] + length)
                    link.append(0)
                    start[below] += length
                    children.append({text[start[below]]: below, symbol: middle + 1})
                    children.append(None)
                    start.append(at)
                    end.append(n)
                    link.append(0)
                    if pending:
                        link[pending] = middle
                    pending = middle
                left -= 1
                if not node and length:
                    length -= 1
                    edge = at - left + 1
                elif node:
                    node = link[node]
        self.children, self.start, self.end = children, start, end

    def tour(self, descending: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Euler tour in ascending order of the symbols: suffixes as their leaves are met, and
        between two leaves the string depth at which the tour turned, which is the depth of
        their lowest common ancestor. ``descending`` turns the order of the symbols from 0 up;
        those below 0 stay first."""
        children, start, end, n = self.children, self.start, self.end, len(self.text)
        leaves, turns = [], []
        turn = 0
        stack = [(0, 0, 0)]  # node, string depth above it, depth of the turn before it
        while stack:
            node, depth, turn = stack.pop()
            below = children[node]
            if below is None:
                leaves.append(start[node] - depth)
                turns.append(turn)
                continue
            if node:
                depth += end[node] - start[node]
            # the first child keeps the turn of its parent; the others turn here
            order = sorted(below, key=lambda s: (s < 0, s)) if descending else sorted(below, reverse=True)
            last = order.pop()
            for symbol in order:
                stack.append((below[symbol], depth, depth))
            stack.append((below[last], depth, turn))
        return np.array(leaves, np.int64), np.array(turns[1:], np.int32)


class Lce:
    """Longest common extension of two suffixes of a text in constant time."""

    def __init__(self, text: list[int]):
        self.tree = SuffixTree(text)
        leaves, turns = self.tree.tour()
        self.rank = np.empty(len(text), np.int64)
        self.rank[leaves] = np.arange(len(text))
        self.table = [turns]
        width = 1
        while 2 * width <= len(turns):
            row = self.table[-1]
            self.table.append(np.minimum(row[:-width], row[width:]))
            width *= 2

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For places ``a <> b`` of the text."""
        x, y = self.rank[a], self.rank[b]
        low, high = np.minimum(x, y), np.maximum(x, y)  # least of turns[low:high]
        power = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int64)
        for p in np.unique(power):
            at = np.flatnonzero(power == p)
            row = self.table[p]
            out[at] = np.minimum(row[low[at]], row[high[at] - (1 << int(p))])
        return out


def next_smaller(rank: list[int]) -> np.ndarray:
    """For each place the next one of smaller rank (the length where there is none)."""
    out = np.empty(len(rank), np.int64)
    stack: list[int] = []
    for i in range(len(rank) - 1, -1, -1):
        own = rank[i]
        while stack and rank[stack[-1]] > own:
            stack.pop()
        out[i] = stack[-1] if stack else len(rank)
        stack.append(i)
    return out


def _lyndon_ends(lce: Lce) -> list[np.ndarray]:
    """End of the longest Lyndon word from each place, by the order of the words and by its
    reverse (the symbols that end a stretch are the smallest in both)."""
    down = np.empty(len(lce.rank), np.int64)
    down[lce.tree.tour(descending=True)[0]] = np.arange(len(down))
    return [next_smaller(lce.rank.tolist()), next_smaller(down.tolist())]


def runs_of(stretches: list[list[int]]) -> list[tuple[int, int, int, int]]:
    """``stretch, start, length, period`` of the runs of lists of word numbers (0 and up)."""
    text: list[int] = []
    owner: list[np.ndarray] = []
    starts = []
    for k, words in enumerate(stretches):
        starts.append(len(text))
        text += words
        text.append(-1 - k)
        owner.append(np.full(len(words) + 1, k))
    n = len(text)
    if not n:
        return []
    own = np.concatenate(owner)
    first = np.array(starts)
    real = np.array(text) >= 0
    forward = Lce(text)
    # the reversal, ended by the last stretch's symbol: place i stands at n - 2 - i
    backward = Lce(text[-2::-1] + [text[-1]])
    found = []
    for ends in _lyndon_ends(forward):
        place = np.flatnonzero(real)
        ahead = ends[place]
        keep = (ahead < n) & (ahead > place)
        place, ahead = place[keep], ahead[keep]
        keep = real[ahead] & (own[place] == own[ahead])
        place, ahead = place[keep], ahead[keep]
        period = ahead - place
        right = forward(place, ahead)
        left = np.zeros(len(place), np.int64)
        inner = np.flatnonzero(place > first[own[place]])
        left[inner] = backward(n - 1 - place[inner], n - 1 - ahead[inner])
        start, length = place - left, period + left + right
        keep = length >= np.maximum(LEAST_WORDS, LEAST_POWER * period)
        found.append(np.stack([start[keep], length[keep], period[keep]], axis=1))
    unique = np.unique(np.concatenate(found), axis=0)
    k = own[unique[:, 0]] if len(unique) else np.zeros(0, np.int64)
    return [(int(j), int(s - first[j]), int(m), int(q)) for j, (s, m, q) in zip(k, unique)]


# -- stretches ------------------------------------------------------------------

def _distances(key: np.ndarray) -> np.ndarray:
    """Distance of each place to the nearest other one of the same key (0: none)."""
    n = len(key)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    gap = np.where(same, np.diff(order), n + 1)
    near = np.full(n, n + 1, np.int64)
    near[order[1:]] = gap
    near[order[:-1]] = np.minimum(near[order[:-1]], gap)
    return np.where(near > n, 0, near)


def stretches(h: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of the stretches that can hold a run; ``h``: word hashes of all
    documents, ``offsets``: their n + 1 word offsets. Stretches never cross documents."""
    n_words = np.diff(offsets)
    grams = np.maximum(n_words - GRAM + 1, 0)
    doc = np.repeat(np.arange(len(grams)), grams)
    at = np.arange(grams.sum()) + np.repeat(offsets[:-1] - (np.cumsum(grams) - grams), grams)
    key = mix(doc.astype(np.uint64) * _STEP + np.uint64(7))
    for j in range(GRAM):
        key = mix(key * _STEP + h[at + j])
    near = _distances(key)
    live = np.flatnonzero(near)
    at, doc, near = at[live], doc[live], near[live]
    while len(at):
        edge = np.flatnonzero((np.diff(at) != 1) | (np.diff(doc) != 0)) + 1
        bounds = np.concatenate([[0], edge, [len(at)]])
        words = np.diff(bounds) + GRAM - 1
        words_of = np.repeat(words, np.diff(bounds))
        keep = (words_of >= LEAST_WORDS) & (LEAST_POWER * near <= words_of)
        if keep.all():
            return at[bounds[:-1]], at[bounds[:-1]] + words
        at, doc, near = at[keep], doc[keep], near[keep]
    return np.zeros(0, np.int64), np.zeros(0, np.int64)


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds behind its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    gone = np.cumsum(change[:-1]) > 0
    return [w for w, g in zip(words, gone.tolist()) if not g]


def _analyse(change: Callable | None):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()),
                        ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
                        ("collapsed", pa.string())])

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("doc_id").to_pylist()
            data, offsets = utf8(batch.column("text"))
            if change is not None:  # the changed words of some documents in place of their texts
                texts = [data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
                texts = [t if (w := change(i, t)) is None else w for i, t in zip(ids, texts)]
                data, offsets = utf8(pa.array([t.decode() for t in texts], pa.string()))
            starts, lengths, word_at = cut_words(data, offsets)
            low, high = stretches(hash_spans(data, starts, lengths), word_at)
            owner = np.searchsorted(word_at, low, side="right") - 1
            n_words = np.diff(word_at)
            runs: list[list[dict]] = [[] for _ in ids]
            texts = []
            for d in range(len(ids)):
                own = np.flatnonzero(owner == d) if len(owner) else owner
                words = data[offsets[d]: offsets[d + 1]].tobytes().split()
                if len(own):
                    numbers: dict[bytes, int] = {}
                    base = int(word_at[d])
                    pieces = [(int(low[k]) - base, int(high[k]) - base) for k in own]
                    lists = [[numbers.setdefault(w, len(numbers)) for w in words[a:b]] for a, b in pieces]
                    spans = sorted((pieces[k][0] + s, m, q) for k, s, m, q in runs_of(lists))
                    runs[d] = [dict(start=s, length=m, period=q) for s, m, q in sorted(spans, key=lambda r: (r[0], r[2]))]
                    words = kept_words(words, spans)
                texts.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words, pa.int64()),
                                              pa.array(runs, schema.field("runs").type), pa.array(texts, pa.string())], schema=schema)

    return run


def periodic_runs(docs: DataFrame, change: Callable[[int | None, bytes], bytes | None] | None = None) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row of ``docs`` (``doc_id, text``).

    ``runs``: ``start, length, period`` by start, then period. ``collapsed``: the words
    that no run holds behind its first period, joined by one space. ``change`` may give
    another text in place of a document's (UTF-8; None: its own).
    """
    small_batches(docs, 250)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        _analyse(change), "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


# -- query ----------------------------------------------------------------------

def planted(doc_id: int | None, text: bytes) -> bytes | None:
    """A tenth of the documents (by the CRC of their id) become periodic from a word on."""
    if doc_id is None:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    words = text.split()
    n, g = len(words), h // 10
    if not n:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return b" ".join(words[:a] + [words[a + i % p] for i in range(n - a)])


def _longest(runs) -> tuple[int, int, int] | None:
    return max(((r["start"], r["length"], r["period"]) for r in runs),
               key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


def _top(batches):
    """The run of the greatest exact length / period beside the others (ties: first start, then period)."""
    for batch in batches:
        top = [_longest(r) or (None, None, None) for r in batch.column("runs").to_pylist()]
        cols = list(zip(*top)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(c, pa.int64()) for c in cols]],
                                         [*batch.schema.names, "start", "length", "period"])


def digest(runs: DataFrame) -> DataFrame:
    """Counts, the strongest run and digests of ``periodic_runs``."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    listed = F.concat_ws("", F.transform(lines, lambda x: F.concat(x, F.lit("\n"))))
    kinds = {f.name: f.dataType.simpleString() for f in runs.schema.fields}
    out = runs.select("doc_id", "n_words", "runs", F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    kinds.update(runs_sha256="string", collapsed_sha256="string")
    schema = ", ".join(f"{c} {kinds[c]}" for c in out.columns) + ", start bigint, length bigint, period bigint"
    return out.mapInArrow(_top, schema).select(
        "doc_id", "n_words", F.size("runs").cast("bigint").alias("n_runs"), "start", "length", "period",
        F.expr("(1000 * length) div period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
