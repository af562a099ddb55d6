"""Text helpers of the operators: word patterns and row keys for the SQL side, and
vectorised word cutting and hashing over Arrow buffers for the Python side."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WHITE = " \t\n\x0b\x0c\r"

# 64-bit mixing constants (the finaliser of splitmix64).
_M1, _M2, _M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
#: Words longer than this are hashed one by one.
LONG_WORD = 4096


def small_batches(df: DataFrame, rows: int = 1000) -> None:
    """Lower the session's Arrow batch size, so that a batch of long texts stays small."""
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def lower_az(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def white_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text (null: none) as an array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[ \t-\r]+"), lambda w: w != "")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows and the n + 1 row offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int32)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
#: ASCII characters that are neither letter nor digit.
PUNCTUATION = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def fold_az(data: np.ndarray) -> np.ndarray:
    return _FOLD[data]


def cut_words(data: np.ndarray, offsets: np.ndarray,
              between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length of each word, and the n + 1 word offsets of the rows; words
    never cross rows. ``between`` marks the bytes that separate words."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = ~between[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = edge[:-1].copy()
    before[1:] |= ~word[:-1]
    after = edge[1:].copy()
    after[:-1] |= ~word[1:]
    after[-1] = before[0] = True
    starts = np.flatnonzero(word & before)
    ends = np.flatnonzero(word & after) + 1
    return starts, ends - starts, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def lanes(data: np.ndarray) -> np.ndarray:
    """View whose element i holds the 8 bytes from i on (zeros behind the end)."""
    padded = np.zeros(len(data) + 16, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 8,), "<u8", padded.data, strides=(1,))


def hash_spans(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes."""
    h = mix(lengths.astype(np.uint64) * _M3 + np.uint64(1))
    if not len(starts):
        return h
    view = lanes(data)
    at, left, rows = starts, lengths, None
    huge = np.flatnonzero(lengths > LONG_WORD)
    if len(huge):
        rows = np.flatnonzero(lengths <= LONG_WORD)
        at, left = starts[rows], lengths[rows]
        for i in huge:
            span = data[starts[i]: starts[i] + lengths[i]].tobytes()
            h[i] = int.from_bytes(hashlib.blake2b(span, digest_size=8).digest(), "little")
    while len(at):
        lane = view[at]
        short = left < 8
        lane = np.where(short, lane & ((np.uint64(1) << (np.uint64(8) * np.where(short, left, 0).astype(np.uint64))) - np.uint64(1)), lane)
        if rows is None:
            h = mix((h ^ lane) + _M3)
        else:
            h[rows] = mix((h[rows] ^ lane) + _M3)
        more = np.flatnonzero(left > 8)
        rows = more if rows is None else rows[more]
        at, left = at[more] + 8, left[more] - 8
    return h


def runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenation of ``arange(starts[i], starts[i] + counts[i])``."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(counts) - counts
    return np.arange(total) + np.repeat(starts - first, counts)


def shingles(h: np.ndarray, word_offsets: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each row and their n + 1 offsets. A row of
    fewer than k words, but not none, has its whole sequence as one."""
    n_words = np.diff(word_offsets)
    short = np.flatnonzero((n_words > 0) & (n_words < k))
    counts = np.where(n_words >= k, n_words - k + 1, 0)
    at = runs(word_offsets[:-1], counts)
    s = np.full(len(at), k, np.uint64)
    for j in range(k):
        s = mix(s * _M3 + h[at + j])
    out_counts = counts.copy()
    out_counts[short] = 1
    offsets = np.concatenate([[0], np.cumsum(out_counts)])
    if not len(short):
        return s, offsets
    out = np.empty(offsets[-1], np.uint64)
    out[runs(offsets[:-1], counts)] = s
    for i in short:
        v = np.array([n_words[i]], np.uint64)
        for j in range(word_offsets[i], word_offsets[i + 1]):
            v = mix(v * _M3 + h[j: j + 1])
        out[offsets[i]] = v[0]
    return out, offsets
