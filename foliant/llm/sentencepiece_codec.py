"""SentencePiece encoding and decoding over a table of distinct chunks.

The vocabulary's pieces never hold a whitespace marker behind another character,
so no merge crosses the start of a marked word and every marked word can be
segmented on its own:

1. blocks of documents are cut into marked words; a block keeps its distinct
   words, numbered, and each document as the sequence of its word numbers;
2. the blocks' word lists are dealt out by word hash, and a task segments each
   distinct word that it gets once;
3. the ids come back to their block, and the documents' ids are put together by
   position.

Blocks are cut twice (for 1 and for 3) rather than stored; a block's name is made
of its content, and a block whose words did not all come back fails the job
instead of giving wrong ids.

Defined results: a null text counts as empty; the empty text has no ids; a
literal U+2581 is a space, as in the library; repeated rows each yield their own
row; null doc_ids stay null; an empty table gives an empty result; other columns
than ``doc_id`` and ``text`` are ignored by the query and kept by ``encode``'s
callers. A text of any length works; its block grows to hold it.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.text import hash_spans, mix, runs, small_batches, utf8

#: Bytes of text after which a block is closed.
BLOCK_BYTES = 12 << 20
MARK = "▁"


def processor(path: str):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path)


def _packed(array: np.ndarray) -> bytes:
    """Bytes of equal weight together, compressed."""
    import zstandard
    width = array.dtype.itemsize
    return zstandard.ZstdCompressor(level=3).compress(array.view(np.uint8).reshape(-1, width).T.tobytes())


def _unpacked(blob: bytes, kind: str) -> np.ndarray:
    import zstandard
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return planes.reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()


def _id_kind(sp) -> str:
    return "<u2" if sp.vocab_size() <= 1 << 16 else "<i4"


def check_markers(path: str) -> None:
    """Refuse a vocabulary in which a piece could cross the start of a marked word."""
    sp = processor(path)
    crossing = [p for p in map(sp.id_to_piece, range(sp.vocab_size())) if MARK in p.lstrip(MARK)]
    if crossing:
        raise ValueError(f"pieces cross whitespace markers: {crossing[:5]}")


def marked_words(text: str) -> list[str]:
    """The marked words of a text, each without its first marker; ``""`` is a
    marker alone."""
    return [c[1:] for c in re.findall(" +[^ ]*", " " + text)] if text else []


def cut_block(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Number of marked words of each text, and all the words in order."""
    texts = pc.replace_substring(texts.fill_null(""), MARK, " ")
    parts = pc.split_pattern(texts, " ")
    if isinstance(parts, pa.ChunkedArray):
        parts = parts.combine_chunks()
    counts = np.diff(parts.offsets.to_numpy())
    words = parts.flatten()
    empty = np.asarray(pc.equal(words, ""))
    if not empty.any():
        return counts, words
    # runs of spaces, spaces at an end and empty texts: cut these texts by the general rule
    row_of = np.repeat(np.arange(len(counts)), counts)
    odd = set(row_of[empty].tolist())
    ends = np.cumsum(counts)
    pieces, done = [], 0
    for i in sorted(odd):
        pieces.append(words.slice(done, ends[i] - counts[i] - done))
        own = marked_words(texts[i].as_py())
        pieces.append(pa.array(own, pa.string()))
        done, counts[i] = ends[i], len(own)
    pieces.append(words.slice(done))
    return counts, pa.concat_arrays([p.cast(pa.string()) for p in pieces])


def _blocks(batches, block_bytes: int):
    """Merge Arrow batches of ``doc_id, text`` to blocks of about ``block_bytes``."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.column("text").nbytes
        if size >= block_bytes:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _numbered(block: pa.Table, buckets: int):
    """Name of a block, word count of each row, word numbers by position, and the
    distinct words in the order of their numbers with the bucket of each."""
    texts = block.column("text").combine_chunks() if block.column("text").num_chunks != 1 else block.column("text").chunk(0)
    counts, words = cut_block(texts)
    coded = pc.dictionary_encode(words)
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    data, offsets = utf8(coded.dictionary)
    hashes = hash_spans(data, offsets[:-1], np.diff(offsets))
    bucket = (hashes % np.uint64(buckets)).astype(np.int32)
    by_word = pc.sort_indices(coded.dictionary).to_numpy()  # neighbours share prefixes and compress well
    order = by_word[np.argsort(bucket[by_word], kind="stable")]
    number = np.empty(len(order), np.int32)
    number[order] = np.arange(len(order), dtype=np.int32)
    at = number[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.int32)
    ids = np.asarray(block.column("doc_id").fill_null(-1).to_numpy()).astype(np.int64).view(np.uint64)
    content = np.concatenate([ids, np.asarray(counts, np.uint64), hashes, np.array([len(at)], np.uint64)])
    name = hashlib.blake2b(mix(content).tobytes() + at.tobytes(), digest_size=8).digest()
    return int.from_bytes(name, "little", signed=True), counts, at, coded.dictionary.take(pa.array(order)), bucket[order]


def _word_lists(buckets: int, block_bytes: int):
    import zstandard

    def run(batches):
        pack = zstandard.ZstdCompressor(level=3)
        for block in _blocks(batches, block_bytes):
            name, _, _, words, bucket = _numbered(block, buckets)
            starts = np.flatnonzero(np.diff(bucket, prepend=-1))
            if not len(words):
                continue
            ends = np.append(starts[1:], len(words))
            lists = []
            for a, b in zip(starts, ends):
                data, offsets = utf8(words.slice(a, b - a))
                lists.append((_packed(np.diff(offsets).astype("<i4")), pack.compress(data.tobytes())))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(starts), name, np.int64)), pa.array(bucket[starts].astype(np.int32)),
                 pa.array(starts.astype(np.int32)), pa.array([n for n, _ in lists], pa.binary()),
                 pa.array([d for _, d in lists], pa.binary())], ["block", "bucket", "first", "lengths", "words"])
    return run


def _segment(path: str):
    import zstandard

    def run(batches):
        sp = processor(path)
        kind, unpack = _id_kind(sp), zstandard.ZstdDecompressor()
        lone = np.array([sp.piece_to_id(MARK)], kind)
        known: dict[str, np.ndarray] = {"": lone}
        for batch in batches:
            out = []
            for lengths, data in zip(batch.column("lengths").to_pylist(), batch.column("words").to_pylist()):
                text, ends = unpack.decompress(data), np.cumsum(_unpacked(lengths, "<i4"))
                words = [text[a:b].decode() for a, b in zip(np.append(0, ends[:-1]).tolist(), ends.tolist())]
                fresh = [w for w in words if w not in known]
                for w, ids in zip(fresh, sp.encode(fresh, num_threads=1) if fresh else []):
                    known[w] = np.array(ids, kind)
                ids = [known[w] for w in words]
                counts = np.fromiter(map(len, ids), "<i4", len(ids))
                out.append((_packed(counts), _packed(np.concatenate(ids))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("first"), pa.array([c for c, _ in out], pa.binary()),
                 pa.array([i for _, i in out], pa.binary()), pa.nulls(len(out), pa.list_(pa.int64()))],
                ["block", "first", "counts", "ids", "doc_ids"])
    return run


def _positions(buckets: int, block_bytes: int):
    def run(batches):
        for block in _blocks(batches, block_bytes):
            name, counts, at, _, _ = _numbered(block, buckets)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name], pa.int64()), pa.array([-1], pa.int32()),
                 pa.array([_packed(np.asarray(counts).astype("<i4"))], pa.binary()), pa.array([_packed(at.astype("<i4"))], pa.binary()),
                 pa.array([block.column("doc_id").to_pylist()], pa.list_(pa.int64()))],
                ["block", "first", "counts", "ids", "doc_ids"])
    return run


def _joined(path: str, with_ids: bool, with_text: bool):
    """Rows sorted by block and first number -> documents with their ids."""
    def documents(head, lists, sp, decimal):
        n_ids = np.concatenate([c for c, _ in lists]) if lists else np.zeros(0, np.int32)
        flat = np.concatenate([i for _, i in lists]) if lists else np.zeros(0, np.int32)
        starts = np.cumsum(n_ids, dtype=np.int64) - n_ids
        doc_ids, counts, packed = head
        at = _unpacked(packed, "<i4")
        if len(at) and at.max() >= len(n_ids):
            raise RuntimeError("a block's words did not all come back")
        begin, rows = 0, []
        for doc_id, n in zip(doc_ids, counts.tolist()):
            own = at[begin: begin + n]
            begin += n
            ids = flat[runs(starts[own], n_ids[own].astype(np.int64))].tolist()
            text = sp.decode(ids)
            rows.append((doc_id, len(ids), hashlib.sha256(b",".join([decimal[i] for i in ids])).hexdigest(),
                         hashlib.sha256(text.encode()).hexdigest(), ids if with_ids else None, text if with_text else None))
            if len(rows) >= 256:
                yield rows
                rows = []
        if rows:
            yield rows

    def run(batches):
        sp = processor(path)
        decimal = [str(i).encode() for i in range(sp.vocab_size())]
        kind = _id_kind(sp)
        block, head, lists, expect, copies = None, None, [], 0, []

        def flush():
            for rows in documents(head, lists, sp, decimal) if head else ():
                columns = list(zip(*rows))
                arrays = [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                          pa.array(columns[2], pa.string()), pa.array(columns[3], pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    arrays.append(pa.array(columns[4], pa.list_(pa.int32())))
                    names.append("ids")
                if with_text:
                    arrays.append(pa.array(columns[5], pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            for name, first, counts, ids, doc_ids in zip(*[batch.column(c).to_pylist() for c in
                                                           ("block", "first", "counts", "ids", "doc_ids")]):
                if first < 0:
                    if name == block:  # equal blocks (repeated rows) share the word lists
                        copies.append((doc_ids, _unpacked(counts, "<i4"), ids))
                        continue
                    for c in copies:
                        head = c
                        yield from flush()
                    block, lists, expect = name, [], 0
                    copies = [(doc_ids, _unpacked(counts, "<i4"), ids)]
                elif first == expect:
                    n = _unpacked(counts, "<i4")
                    lists.append((n, _unpacked(ids, kind)))
                    expect += len(n)
                elif first > expect:
                    raise RuntimeError("a block's words did not all come back")
        for c in copies:
            head = c
            yield from flush()
    return run


def encode(docs: DataFrame, model_path: str, block_bytes: int = BLOCK_BYTES, with_ids: bool = True,
           with_text: bool = True) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, if asked for, ``ids``
    (array) and ``decoded`` (text) of every row of ``docs`` (``doc_id, text``)."""
    check_markers(model_path)
    small_batches(docs)
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    words = docs.mapInArrow(_word_lists(buckets, block_bytes), "block bigint, bucket int, first int, lengths binary, words binary")
    coded = "block bigint, first int, counts binary, ids binary, doc_ids array<bigint>"
    ids = words.repartition(buckets, "bucket").mapInArrow(_segment(model_path), coded)
    heads = docs.mapInArrow(_positions(buckets, block_bytes), coded)
    both = heads.unionByName(ids).repartition(buckets, "block").sortWithinPartitions("block", "first")
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" \
        + (", ids array<int>" if with_ids else "") + (", decoded string" if with_text else "")
    return both.mapInArrow(_joined(model_path, with_ids, with_text), schema)


def digest(docs: DataFrame, model_path: str) -> DataFrame:
    """The contract's columns."""
    return encode(docs, model_path, with_ids=False, with_text=False)
