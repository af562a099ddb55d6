"""WARC archives compressed with a Zstandard dictionary.

A dictionary is built from a bounded sample of the records, stands in a skippable
frame at the head of every archive, and every record is a Zstandard frame of its
own, so one record can be read by the dictionary and its offset alone. Of pages
with equal payloads the one with the smallest page_id is archived as a response;
the others are revisit records that name it.

Tasks write archives straight into a folder that all executors share, under a
name no other attempt uses, and return the index of their records. Only archives
that stand in the stored index count, so files of lost or repeated attempts are
never read.

Defined results: a null html is the empty payload; pages without page_id come
after all others (and revisit, if an equal payload has an id); repeated rows of
the smallest page_id are all responses; a null url leaves the target out; an
empty table writes no archive; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.text import small_batches
from foliant.session import materialize, scratch_dir

#: Payloads of fewer bytes are always archived as responses.
MIN_REVISIT_BYTES = 0
#: The dictionary: its size, about how many records it is built from (at most twice as many), and bytes of each.
DICT_BYTES, DICT_RECORDS, DICT_RECORD_BYTES = 64 << 10, 400, 32 << 10
#: An archive is closed after so many compressed bytes.
ARCHIVE_BYTES = 64 << 20
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
SKIPPABLE = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(kind: str, page_id) -> str:
    return f"<urn:uuid:{uuid.uuid4() if page_id is None else uuid.uuid5(_SPACE, f'{kind}:{page_id}')}>"


def record(page_id, url, payload: bytes, refers_to, revisit: bool) -> bytes:
    """One WARC record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    kind = "revisit" if revisit else "response"
    head = [("WARC-Type", kind), ("WARC-Record-ID", _urn(kind, page_id)), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", "".join(c if c > " " else f"%{ord(c):02X}" for c in url)))
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    head += [("WARC-Payload-Digest", "sha1:" + digest_of(payload)), ("X-Payload-Length", str(len(payload)))]
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn("response", refers_to)), ("X-Refers-To-Page-ID", str(refers_to))]
    block = http if revisit else http + payload
    head += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _open(uri: str):
    from pyarrow import fs
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def build_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary of the records; none (empty) where they are too few to give one."""
    import zstandard
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _compressor(dictionary: bytes):
    import zstandard
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def classified(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Pages with their payload and, for revisits, the page that holds it."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url",
                        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")) \
        .withColumn("_sha", F.sha1("payload"))
    first = rows.groupBy("_sha").agg(F.min("page_id").alias("_first"))
    joined = rows.join(first, "_sha")
    revisit = (F.length("payload") >= min_bytes) & F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return joined.select("page_id", "url", "payload", F.when(revisit, F.col("_first")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Archive all pages below ``folder``; the stored index ``page_id, archive, offset, length``."""
    small_batches(pages, 200)
    rows = classified(pages)
    step = max(1, pages.count() // DICT_RECORDS)
    sample = pages.where(F.pmod(F.xxhash64("page_id", "url"), F.lit(step)) == 0).select(
        "page_id", "url", F.substring(F.encode(F.coalesce("html", F.lit("")), "UTF-8"), 1, DICT_RECORD_BYTES).alias("payload")) \
        .limit(2 * DICT_RECORDS).collect()
    dictionary = build_dictionary([record(r["page_id"], r["url"], bytes(r["payload"]), None, False) for r in sample])
    shared = pages.sparkSession.sparkContext.broadcast(dictionary)

    def run(batches):
        store, base = _open(folder)
        pack = _compressor(shared.value)
        out, name, offset = None, None, 0
        for batch in batches:
            index = []
            for page_id, url, payload, refers_to in zip(*[batch.column(c).to_pylist() for c in
                                                          ("page_id", "url", "payload", "refers_to")]):
                if out is None:
                    store.create_dir(base, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                    head = struct.pack("<II", SKIPPABLE, len(shared.value)) + shared.value
                    out.write(head)
                    offset = len(head)
                frame = pack.compress(record(page_id, url, payload, refers_to, refers_to is not None))
                out.write(frame)
                index.append((page_id, name, offset, len(frame)))
                offset += len(frame)
                if offset >= ARCHIVE_BYTES:
                    out.close()
                    out = None
            if index:
                ids, names, offsets, lengths = zip(*index)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(names), pa.array(offsets, pa.int64()),
                                                  pa.array(lengths, pa.int64())], ["page_id", "archive", "offset", "length"])
        if out is not None:
            out.close()

    return materialize(rows.mapInArrow(run, "page_id bigint, archive string, offset bigint, length bigint"))


def parse_records(stream):
    """Header fields and block of each record of a decompressed archive."""
    held = b""

    def more() -> bool:
        nonlocal held
        data = stream.read(1 << 20)
        held += data
        return bool(data)

    while True:
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not more():
                if held.strip():
                    raise ValueError("an archive ends inside a record")
                return
        lines = held[:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record: {lines[0][:60]}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        total = end + 4 + int(fields["Content-Length"]) + 4
        parts, have = [held], len(held)
        while have < total:
            data = stream.read(max(1 << 20, total - have))
            if not data:
                raise ValueError("an archive ends inside a record")
            parts.append(data)
            have += len(data)
        held = b"".join(parts)
        yield fields, held[end + 4: total - 4]
        held = held[total:]


def read_archives(spark, folder: str, names: DataFrame) -> DataFrame:
    """The records of the archives ``archive`` (a column of names) below ``folder``:
    ``page_id, url, payload_bytes, payload_digest, record_type, refers_to``. The
    digest of every response is computed anew and must equal its header."""

    def records(store, path):
        import zstandard
        with store.open_input_file(path) as f:
            magic, size = struct.unpack("<II", f.read(8))
            if magic != SKIPPABLE:
                raise ValueError(f"{path}: no dictionary frame")
            dictionary = f.read(size)
            tool = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
            for fields, block in parse_records(tool.stream_reader(f, read_across_frames=True)):
                kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                if kind == "response":
                    payload = block[block.index(b"\r\n\r\n") + 4:]
                    if digest_of(payload) != digest or len(payload) != int(fields["X-Payload-Length"]):
                        raise ValueError(f"{path}: payload and digest differ")
                number = lambda k: int(fields[k]) if k in fields else None
                yield (number("X-Page-ID"), fields.get("WARC-Target-URI"), int(fields["X-Payload-Length"]), digest, kind,
                       number("X-Refers-To-Page-ID"))

    def run(batches):
        store, base = _open(folder)
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        fields = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        held = []

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], fields)

        for batch in batches:
            for name in batch.column("archive").to_pylist():
                for row in records(store, f"{base}/{name}"):
                    held.append(row)
                    if len(held) >= 5000:
                        yield flush()
                        held = []
        if held:
            yield flush()

    # dealt by an expression of its own: by the plain name the planner would drop this exchange as
    # equal to the one of distinct(), whose few small rows then meet in one task
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return names.select("archive").distinct().repartition(partitions, F.xxhash64("archive", F.lit("deal"))).mapInArrow(
        run, "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the pages to archives, read the archives back, and give their records."""
    spark = pages.sparkSession
    folder = folder or scratch_dir(spark, "warc")
    index = write_archives(pages, folder)
    return read_archives(spark, folder, index).drop("url")


SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(((CAST('0x' || substr(h, CAST((k // 4) * 5 + 1 AS BIGINT), 5) AS INTEGER) >> CAST(15 - 5 * (k % 4) AS INTEGER)) & 31) + 1 AS BIGINT), 1) for k in range(0, 32)], '') AS payload_digest,
       CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN NULL ELSE first END AS refers_to
FROM p JOIN f USING (h)
"""
