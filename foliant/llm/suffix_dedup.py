"""Suffix-array dedup: a distributed, common-prefix-aware merge sort of suffixes.

Every byte is removed that is covered by a string of ``LENGTH`` bytes that also
starts earlier (smaller doc_id, or the same document and an earlier start).

Not all suffixes need sorting. Each window of LENGTH bytes chooses an anchor, the
first of its smallest hashed 32-byte grams; equal windows choose equal anchors,
so an anchor whose gram occurs nowhere else can't belong to a repeat. For every
other anchor the stretch of all windows that chose it (about 130 bytes) is a
suffix to sort:

1. tasks cut the stretches, sort them into runs, drop those that an earlier one
   of the same run equals, cut the runs at range splitters and front-code them
   (length of the prefix shared with the predecessor, and the rest);
2. a task takes the runs of its range and merges them with a loser tree that
   keeps, for each run's head, the length of the prefix shared with the last
   winner, and compares bytes only behind it. Equal stretches come out together:
   all but the earliest are repeats as a whole;
3. the stretches that are left can still share some of their windows with one
   that differs at an end. Their windows are taken in blocks of neighbouring
   offsets; blocks that share the 66 bytes common to all their windows meet, and
   their windows are compared one by one (64-bit hashes at equal offsets).

Defined results: a null text is empty; texts below LENGTH bytes lose nothing;
rows without doc_id come after all others; rows that repeat a doc_id are ordered
by the hash of their text, and equal rows count as one document with equal
results; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.text import hash_spans, lanes, mix, runs, small_batches, utf8
from foliant.operators.positional import with_global_index
from foliant.session import materialize

LENGTH, GRAM = 100, 32
SPAN = LENGTH - GRAM + 1  # grams of a window
#: Window offsets that are compared under one name in step 3.
BLOCK = 35
#: Stretches of a run, at most, and about how many documents the range splitters come from.
RUN, SAMPLE_DOCS = 150_000, 300
_PAIR = "khash bigint, num bigint, at bigint"
_FLOW = "part int, num bigint, first bigint, last bigint, khash bigint, at bigint, payload binary"


# -- anchors ------------------------------------------------------------------

def anchors(data: np.ndarray, offsets: np.ndarray):
    """Anchor, first and last window start, and gram hash of every stretch."""
    n = len(data)
    starts = runs(offsets[:-1], np.maximum(np.diff(offsets) - LENGTH + 1, 0))
    if not len(starts):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    view = lanes(np.concatenate([data, np.zeros(GRAM, np.uint8)]))
    h = np.full(n, np.uint64(GRAM))
    for at in range(0, GRAM, 8):
        h = (h ^ view[at: at + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    h = mix(h)
    # smallest hash, then first place: the upper half of the hash above the place
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    rows = np.full((-(-n // SPAN) + 1, SPAN), np.uint64(2**64 - 1))
    rows.ravel()[:n] = key
    upto = np.minimum.accumulate(rows, axis=1).ravel()
    onward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    chosen = (np.minimum(onward[starts], upto[starts + SPAN - 1]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.diff(chosen, prepend=-1))
    return chosen[new], starts[new], starts[np.append(new[1:], len(starts)) - 1], h[chosen[new]]


def _pack(anchor, first, last):
    """First window start in its document, offsets of anchor and last start (below 256)."""
    return (first << 16) | ((anchor - first) << 8) | (last - first)


_SURE = 1 << 62


def _cut(batches):
    """Candidate anchors by gram hash. Of a gram that a batch holds more than once
    one row goes to the others of its hash, marked as surely repeated; the rest are
    sure as well and are dealt out at random, so no frequent gram gathers its rows."""
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        anchor, first, last, h = anchors(data, offsets)
        row = np.searchsorted(offsets, first, "right") - 1
        base = offsets[row]
        at = _pack(anchor - base, first - base, last - base)
        _, one, count = np.unique(h, return_index=True, return_counts=True)
        again = np.ones(len(h), bool)
        again[one[count == 1]] = False
        passing = again.copy()
        passing[one] = False
        key = np.where(passing, mix(h + np.arange(len(h), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)), h)
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column("num").take(pa.array(row)),
                                          pa.array(np.where(again, at | _SURE, at))], ["khash", "num", "at"])


def _repeated(batches):
    """Rows sorted by gram hash -> those whose hash occurs again."""
    last, waiting = None, None
    for batch in batches:
        h = batch.column("khash").to_numpy()
        if not len(h):
            continue
        same = h[1:] == h[:-1]
        keep = np.zeros(len(h), bool)
        keep[1:] |= same
        keep[:-1] |= same
        at = batch.column("at").to_numpy()
        keep |= at >= _SURE
        if last == h[0]:
            keep[0] = True
            if waiting is not None:
                yield waiting
        rows = pa.RecordBatch.from_arrays([batch.column("num"), pa.array(at & (_SURE - 1))], ["num", "at"])
        last, waiting = h[-1], None if keep[-1] else rows.slice(len(h) - 1, 1)
        if keep.any():
            yield rows.filter(pa.array(keep))


# -- runs ---------------------------------------------------------------------

def front_code(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Prefix shared with the predecessor, length of the rest, and the rests of sorted strings."""
    shared = np.zeros(len(strings), np.int32)
    for i in range(1, len(strings)):
        shared[i] = common(strings[i - 1], strings[i], 0)
    rests = [s[k:] for s, k in zip(strings, shared.tolist())]
    return shared, np.fromiter(map(len, rests), np.int32, len(rests)), b"".join(rests)


def common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of two strings that share ``known`` bytes."""
    n = min(len(a), len(b)) - known
    if n <= 0:
        return known
    x = int.from_bytes(a[known: known + n], "big") ^ int.from_bytes(b[known: known + n], "big")
    return known + n - (x.bit_length() + 7) // 8


def read_run(shared: np.ndarray, lengths: np.ndarray, rests: bytes, entries):
    """Strings of a front-coded run: shared prefix, string, entry."""
    last, at = b"", 0
    for k, n, entry in zip(shared.tolist(), lengths.tolist(), entries):
        last = last[:k] + rests[at: at + n]
        at += n
        yield k, last, entry


def merge_runs(sources: list):
    """Merge sorted runs; gives (prefix shared with the last given string, string, entry).

    A loser tree: every inner node keeps the loser of its match and the length
    of the prefix that it shares with the winner. Of two strings that share
    different lengths with the last winner the one that shares more is smaller;
    only at equal lengths are bytes behind that length compared.
    """
    k = 1
    while k < len(sources):
        k *= 2
    heads = [next(s, None) for s in sources] + [None] * (k - len(sources))
    shared = [0] * k
    losers = [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's shared length becomes that with the winner."""
        x, y = heads[a], heads[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        p, q = x[1], y[1]
        n = common(p, q, shared[a])
        # the end of a string comes before every byte; equal strings by their entry
        if n == len(p) and n == len(q):
            first = x[2] <= y[2]
        elif n == len(p) or n == len(q):
            first = n == len(p)
        else:
            first = p[n] < q[n]
        if first:
            shared[b] = n
            return a, b
        shared[a] = n
        return b, a

    def build(node: int) -> int:
        if node >= k:
            return node - k
        winner, losers[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    top = build(1)
    while heads[top] is not None:
        _, string, entry = heads[top]
        yield shared[top], string, entry
        heads[top] = following = next(sources[top], None)
        shared[top] = following[0] if following else 0
        node = (top + k) // 2
        while node:
            top, losers[node] = play(top, losers[node])
            node //= 2


def _spans(num: np.ndarray, first: np.ndarray, last: np.ndarray):
    """Union of the byte ranges of each document."""
    order = np.lexsort((first, num))
    num, first, last = num[order], first[order], last[order]
    if not len(num):
        return num, first, last
    row = np.cumsum(np.append(0, np.diff(num) != 0))
    reach = np.maximum.accumulate(last + row * (1 << 40))  # per document, as rows lie far apart
    new = np.append(True, (first[1:] + row[1:] * (1 << 40)) > reach[:-1])
    at = np.flatnonzero(new)
    ends = np.append(at[1:], len(num)) - 1
    return num[at], first[at], reach[ends] - row[ends] * (1 << 40)


def _span_batch(num, first, last):
    n = len(num)
    rng = mix(np.asarray(num, np.int64).view(np.uint64)) & np.uint64(0x7FFFFFFF)
    return pa.RecordBatch.from_arrays(
        [pa.array(rng.astype(np.int32)), pa.array(num, pa.int64()), pa.array(first, pa.int64()), pa.array(last, pa.int64()),
         pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())],
        ["part", "num", "first", "last", "khash", "at", "payload"])


def _make_runs(splitters: list[bytes], size: int):
    """Documents with their candidate anchors -> front-coded runs, and repeats inside a run."""
    from bisect import bisect_right

    import zstandard

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1)

        def close(held):
            held.sort()
            strings, entries, gone = [], [], []
            for string, num, at in held:
                if strings and string == strings[-1]:
                    gone.append((num, at >> 16, (at >> 16) + len(string)))
                else:
                    strings.append(string)
                    entries.append((num, at))
            if gone:
                yield _span_batch(*_spans(*np.array(gone, np.int64).T))
            part = [bisect_right(splitters, s) for s in strings]
            bounds = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(strings))
            rows = []
            for a, b in zip(bounds[:-1], bounds[1:]):
                shared, lengths, rests = front_code(strings[a:b])
                own = np.array(entries[a:b], np.int64)
                blob = np.int32(b - a).tobytes() + shared.tobytes() + lengths.tobytes() + own[:, 0].tobytes() + own[:, 1].tobytes() + rests
                rows.append((part[a], pack.compress(blob)))
            n = len(rows)
            if n:
                none = pa.nulls(n, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), none, none, none, none, none,
                                                  pa.array([r[1] for r in rows], pa.binary())],
                                                 ["part", "num", "first", "last", "khash", "at", "payload"])

        held = []
        for batch in batches:
            unpack = zstandard.ZstdDecompressor()
            for num, text, places in zip(*[batch.column(c).to_pylist() for c in ("num", "text", "places")]):
                text = unpack.decompress(text)
                for at in places:
                    first = at >> 16
                    held.append((text[first: first + (at & 255) + LENGTH], num, at))
                if len(held) >= size:
                    yield from close(held)
                    held = []
        if held:
            yield from close(held)
    return run


def _merge(batches):
    """Runs sorted by range -> repeats, and the distinct stretches with their gram hash."""
    import zstandard

    from collections import deque

    def sources(blobs):
        for blob in blobs:
            data = zstandard.ZstdDecompressor().decompress(blob)
            n = int(np.frombuffer(data, np.int32, 1)[0])
            shared, lengths = np.frombuffer(data, np.int32, 2 * n, 4).reshape(2, n)
            num, at = np.frombuffer(data, np.int64, 2 * n, 4 + 8 * n).reshape(2, n)
            yield read_run(shared, lengths, data[4 + 24 * n:], zip(num.tolist(), at.tolist()))

    def merged(blobs):
        gone, kept, last = [], deque(), None
        for shared, string, (num, at) in merge_runs(list(sources(blobs))):
            if last is not None and shared == len(string) == last:
                gone.append((num, at >> 16, (at >> 16) + len(string)))
            else:
                kept.append((num, at, string))
            last = len(string)
            if len(kept) >= 20000:
                yield heads(kept)
                kept = deque()
            if len(gone) >= 100000:
                yield _span_batch(*_spans(*np.array(gone, np.int64).T))
                gone = []
        if kept:
            yield heads(kept)
        if gone:
            yield _span_batch(*_spans(*np.array(gone, np.int64).T))

    def heads(kept):
        # a row for each block of window offsets, named by the bytes that all windows of the block share
        rows = []
        for num, at, string in kept:
            first, place, more = at >> 16, (at >> 8) & 255, at & 255
            for low in range((place - more) // BLOCK * BLOCK, place + 1, BLOCK):
                begin, end = max(place - low - BLOCK + 1, 0), min(place - low, more)
                rows.append((num, ((first + begin) << 16) | ((place - begin) << 8) | (end - begin),
                             string[begin: end + LENGTH], string[place - low: place - low + LENGTH - BLOCK + 1]))
        num, at, strings, cores = zip(*rows)
        data, offsets = utf8(pa.array(cores, pa.binary()).view(pa.string()))
        core = hash_spans(data, offsets[:-1], np.diff(offsets))
        n = len(rows)
        return pa.RecordBatch.from_arrays(
            [pa.array((core & np.uint64(0x7FFFFFFF)).astype(np.int32)), pa.array(num, pa.int64()), pa.nulls(n, pa.int64()),
             pa.nulls(n, pa.int64()), pa.array(core.view(np.int64)), pa.array(at, pa.int64()), pa.array(strings, pa.binary())],
            ["part", "num", "first", "last", "khash", "at", "payload"])

    part, blobs = None, []
    for batch in batches:
        spans = batch.filter(batch.column("num").is_valid())
        if spans.num_rows:
            yield spans
        rows = batch.filter(batch.column("num").is_null())
        for p, blob in zip(rows.column("part").to_pylist(), rows.column("payload").to_pylist()):
            if p != part and blobs:
                yield from merged(blobs)
                blobs = []
            part = p
            blobs.append(blob)
    if blobs:
        yield from merged(blobs)


def _windows(batches):
    """Stretches sorted by gram hash -> ranges of bytes whose windows start earlier elsewhere."""

    def compare(rows):
        khash, num, at, strings = rows
        h = khash.view(np.uint64)
        again = np.zeros(len(h) + 1, bool)
        again[1:-1] = h[1:] == h[:-1]
        keep = np.flatnonzero(again[:-1] | again[1:])
        if not len(keep):
            return None
        data, offsets = utf8(pa.array([strings[i] for i in keep], pa.binary()).view(pa.string()))
        at, num, h = at[keep], num[keep], h[keep]
        count = (at & 255) + 1
        row = np.repeat(np.arange(len(keep)), count)
        begin = runs(offsets[:-1], count)
        step = begin - offsets[row]
        own = hash_spans(data, begin, np.full(len(begin), LENGTH))
        place = ((at >> 8) & 255)[row] - step  # the anchor inside the window
        key = mix(own + mix(h[row] + place.astype(np.uint64)))
        start = (at >> 16)[row] + step
        order = np.lexsort((start, num[row], key))
        same = np.flatnonzero(key[order[1:]] == key[order[:-1]]) + 1
        hit = order[same]
        if not len(hit):
            return None
        return _span_batch(*_spans(num[row][hit], start[hit], start[hit] + LENGTH))

    held: list = []

    def joined(upto=None):
        return tuple(np.concatenate([b[i] for b in held]) if i < 3 else [s for b in held for s in b[3]] for i in range(4))

    size = 0
    for batch in batches:
        spans = batch.filter(batch.column("khash").is_null())
        if spans.num_rows:
            yield spans.select(["num", "first", "last"])
        rows = batch.filter(batch.column("khash").is_valid())
        if not rows.num_rows:
            continue
        held.append((rows.column("khash").to_numpy(), rows.column("num").to_numpy(), rows.column("at").to_numpy(),
                     rows.column("payload").to_pylist()))
        size += rows.num_rows
        if size >= 8000:
            own = joined()
            tail = int(np.flatnonzero(own[0] == own[0][-1])[0])  # the last gram may go on
            if tail:
                out = compare(tuple(x[:tail] for x in own))
                if out is not None:
                    yield out.select(["num", "first", "last"])
                held = [tuple(x[tail:] for x in own)]
                size -= tail
            else:
                held = [own]
    if size:
        out = compare(joined())
        if out is not None:
            yield out.select(["num", "first", "last"])


# -- the operator ---------------------------------------------------------------

def _packed(batches):
    """Compress the texts, so that shuffles and their files stay small."""
    import zstandard
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts = pa.array([pack.compress(t.encode()) for t in batch.column("text").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("num"), texts], ["num", "text"])


def _splitters(docs: DataFrame, parts: int) -> list[bytes]:
    step = max(1, docs.count() // SAMPLE_DOCS)
    sample = docs.where((F.pmod(F.xxhash64("num"), F.lit(step)) == 0) & (F.length("text") >= LENGTH)) \
        .select(F.substring("text", 1, 20_000).alias("text")).limit(4 * SAMPLE_DOCS).collect()
    strings = sorted(t[i: i + 24] for r in sample for t in [r["text"].encode()] for i in range(0, len(t) - LENGTH, 37))
    return sorted({strings[len(strings) * i // parts] for i in range(1, parts)}) if strings else []


def repeats(docs: DataFrame) -> DataFrame:
    """``num, first, last``: byte ranges to remove from ``docs`` (``num, text``); they may overlap."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = docs.mapInArrow(_cut, _PAIR)
    found = cut.repartition(parts, "khash").sortWithinPartitions("khash").mapInArrow(_repeated, "num bigint, at bigint")
    places = found.groupBy("num").agg(F.collect_list("at").alias("places"))
    packed = docs.mapInArrow(_packed, "num bigint, text binary")
    flow = packed.join(places, "num").mapInArrow(_make_runs(_splitters(docs, parts), RUN), _FLOW)
    flow = flow.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(_merge, _FLOW)
    flow = flow.repartition(parts, "part").sortWithinPartitions("khash")
    return flow.mapInArrow(_windows, "num bigint, first bigint, last bigint")


_FIGURES = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _remove(batches):
    import zstandard
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        rows = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            text = unpack.decompress(text)
            kept, at, removed, count = [], 0, 0, 0
            for first, last in sorted((s["first"], s["last"]) for s in spans or ()):
                if count == 0 or first > at:
                    kept.append(text[at: first])
                    count += 1
                    removed += last - first
                    at = last
                elif last > at:
                    removed += last - at
                    at = last
            left = b"".join([*kept, text[at:]])
            rows.append((len(text), removed, count, hashlib.sha256(left).hexdigest(), left.decode(errors="ignore")))
        n, removed, count, sha, left = zip(*rows) if rows else ([],) * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column("num"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(count, pa.int64()),
             pa.array(sha, pa.string()), pa.array(left, pa.string())],
            ["num", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])


def removed(docs: DataFrame) -> DataFrame:
    """``num, n_bytes, n_removed, n_spans, kept_sha256, kept_text`` of ``docs`` (``num, text``).

    ``kept_text`` is what is left, without the pieces of characters that lost a part.
    """
    small_batches(docs, 500)
    spans = materialize(repeats(docs))
    own = spans.groupBy("num").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    return docs.mapInArrow(_packed, "num bigint, text binary").join(own, "num", "left").mapInArrow(
        _remove, _FIGURES.replace("doc_id", "num") + ", kept_text string")


def with_numbers(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_num``, the place of a row's document in the order of documents.

    That is the doc_id where it is a key. Else rows are numbered by doc_id (null
    last) and hash of the text; equal rows share a number.
    """
    counts = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if counts.where("n > 1 or doc_id is null").isEmpty():
        return docs.withColumn("_num", F.col("doc_id").cast("bigint"))
    rows = docs.withColumn("_h", F.sha2(F.coalesce("text", F.lit("")), 256))
    keys = materialize(rows.select(F.col("doc_id").isNull().alias("_last"), F.col("doc_id").alias("_d"), F.col("_h").alias("_hh")).distinct())
    numbers = materialize(with_global_index(keys, ["_last", "_d", "_hh"], "_num")).drop("_last")
    return materialize(rows.join(numbers, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_h") == F.col("_hh")))
                       .drop("_h", "_d", "_hh"))


def _figures(rows: DataFrame, one_each: bool) -> DataFrame:
    texts = rows.select(F.col("_num").alias("num"), F.coalesce("text", F.lit("")).alias("text"))
    return removed(texts if one_each else texts.groupBy("num").agg(F.first("text").alias("text")))


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row of ``docs`` (``doc_id, text``)."""
    rows = with_numbers(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    if not hasattr(rows, "_stage_path"):  # the doc_id is the number
        return _figures(rows, True).withColumnRenamed("num", "doc_id").select(*names)
    return rows.select("doc_id", "_num").join(_figures(rows, False), F.col("_num") == F.col("num")).select(*names)


def cut_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with what is left of each text (a null text stays null) and, where
    there is such a column, ``n_chars`` of it."""
    rows = with_numbers(docs)
    left = _figures(rows, not hasattr(rows, "_stage_path")).select(F.col("num").alias("_key"), F.col("kept_text").alias("_kept"))
    rows = rows.withColumn("_null", F.col("text").isNull()).drop("text").join(left, F.col("_num") == F.col("_key")) \
        .withColumn("text", F.when(~F.col("_null"), F.col("_kept")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
