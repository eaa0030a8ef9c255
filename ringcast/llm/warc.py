"""WARC archives with a dictionary: one Zstandard frame per record.

Each archive is a file whose first frame is a skippable frame (magic
0x184D2A5D) that holds a Zstandard dictionary, built from records spread
evenly over that archive; every record follows as a frame of its own, made with
the dictionary, so a reader can start at any record's offset. Records of one
task go to archives of about ``archive_bytes`` each; a task holds one archive's
records at a time. Files are written under a temporary name and then renamed,
so a task that runs again leaves no half archive; only files that the finished
tasks report are read.

Rows with equal payloads are one group, whatever its size: the digest's largest
id is found by partial aggregation, and joined back salted by page, so a payload
of a third of all rows is spread over the tasks.

Defined results: null html is an empty payload; null url is an empty target. Of
rows with equal payloads those with the largest page_id are responses (several
if that page_id repeats), the others revisits; a null page_id counts as smallest,
refers to the response like any other, and is a response where all of its group
are null. Payloads shorter than ``min_bytes`` are all responses. Other columns
are ignored. An empty table gives no archive and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringcast.session import materialize, scratch_path

DICTIONARY_MAGIC = 0x184D2A5D
ARCHIVE_BYTES = 48 << 20
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 4 << 20
SALTS = 16
READ_ARCHIVES = 4    # archives that a task reads back
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def page_uri(page_id: int | None) -> str:
    return f"<urn:x-ringcast:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record; a revisit keeps the response's HTTP header, not its payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    target = url.replace("\r", "%0D").replace("\n", "%0A")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {page_uri(page_id)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}",
            f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {page_uri(refers_to)}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Fields of one record, with its payload checked against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:] if ": " in x)
    size = int(fields["Content-Length"])
    block, end = rest[:size], rest[size:]
    if lines[0] != "WARC/1.1" or end != b"\r\n\r\n":
        raise ValueError(f"not a whole WARC record: {lines[:3]}")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x[16:]) for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (
            len(payload) != length or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")

    def page(uri: str | None) -> int | None:
        text = (uri or "").rstrip(">").rpartition(":")[2]
        return int(text) if text else None

    return {"page_id": page(fields["WARC-Record-ID"]), "payload_bytes": length, "payload_digest": digest,
            "record_type": fields["WARC-Type"], "refers_to": page(fields.get("WARC-Refers-To")),
            "payload": payload if fields["WARC-Type"] == "response" else None}


def build_dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary from records taken at even steps, up to SAMPLE_BYTES; None
    where there are too few to train on."""
    step = max(1, sum(map(len, records)) // SAMPLE_BYTES)
    samples = [r[:SAMPLE_BYTES // 16] for r in records[::step]]
    if len(samples) < 8:
        return None
    size = max(256, min(DICTIONARY_BYTES, sum(map(len, samples)) // 8))
    try:
        return zstandard.train_dictionary(size, samples)
    except zstandard.ZstdError:
        return None


def archive_bytes_of(records: list[bytes]):
    """An archive's frames: the dictionary's skippable frame, then each record's."""
    dictionary = build_dictionary(records)
    raw = dictionary.as_bytes() if dictionary else b""
    yield struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw
    codec = zstandard.ZstdCompressor(level=3, dict_data=dictionary)
    for r in records:
        yield codec.compress(r)


def read_archive(stream):
    """The raw records of an archive, one frame at a time."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no dictionary frame at the start of the archive")
    raw = stream.read(size)
    codec = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
    rest, frame, out = b"", codec.decompressobj(), []
    while True:
        block = rest or stream.read(1 << 20)
        if not block:
            break
        out.append(frame.decompress(block))
        rest = frame.unused_data
        if frame.eof:
            yield b"".join(out)
            frame, out = codec.decompressobj(), []
        else:
            rest = b""
    if out and any(out):
        raise ValueError("the archive ends within a record")


def _file_system(uri: str):
    """File system and path of a folder's URI; a bare path is local."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def with_types(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html, refers_to, revisit of every page."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
                     F.coalesce("html", F.lit("")).alias("html"))
    p = p.withColumns({"digest": F.unhex(F.sha1(F.encode("html", "UTF-8"))),
                       "salt": F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")})
    least = F.octet_length("html") >= min_bytes
    first = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("html", F.lit("")).alias("html")) \
        .filter(least).select(F.unhex(F.sha1(F.encode("html", "UTF-8"))).alias("digest"), "page_id") \
        .groupBy("digest").agg(F.max("page_id").alias("top"), F.count("*").alias("n")).filter("n > 1") \
        .select("digest", "top", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    p = p.join(first, ["digest", "salt"], "left")
    revisit = least & F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    return p.select("page_id", "url", "html", F.when(revisit, F.col("top")).alias("refers_to"),
                    F.coalesce(revisit, F.lit(False)).alias("revisit"))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0,
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write every page's record to archives in ``folder``; (file, records, bytes)
    of the archives of the finished tasks."""
    def write(batches):
        fs, root = _file_system(folder)
        fs.create_dir(root, recursive=True)

        def save(records):
            name = f"{uuid.uuid4().hex}.warc.zst"
            total = 0
            with fs.open_output_stream(f"{root}/.{name}.part", compression=None) as out:
                for frame in archive_bytes_of(records):
                    total += len(frame)
                    out.write(frame)
            fs.move(f"{root}/.{name}.part", f"{root}/{name}")
            return pa.record_batch({"file": [name], "records": pa.array([len(records)], pa.int64()),
                                    "bytes": pa.array([total], pa.int64())})

        held, size = [], 0
        for batch in batches:
            cols = [batch.column(i) for i in range(5)]
            for i in range(batch.num_rows):
                page_id, url, html, refers_to, revisit = (c[i].as_py() for c in cols)
                r = record(page_id, url, html.encode(), refers_to, revisit)
                held.append(r)
                size += len(r)
                if size >= archive_bytes:
                    yield save(held)
                    held, size = [], 0
        if held:
            yield save(held)

    return with_types(pages, min_bytes).mapInArrow(write, "file string, records long, bytes long")


def read_archives(spark: SparkSession, files: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The records of the archives that ``files`` (column file) names in ``folder``."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * with_payload
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def read(batches):
        fs, root = _file_system(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for raw in read_archive(stream):
                        x = parse(raw)
                        rows.append(x)
                        size += len(raw)
                        if len(rows) >= 1000 or size > 1 << 22:
                            yield pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in zip(names, types)], names=names)
                            rows, size = [], 0
                if rows:
                    yield pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in zip(names, types)], names=names)

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long" \
        + ", payload binary" * with_payload
    # a task for every few archives; ``files`` is a stored table, so counting it reads names only
    tasks = max(1, -(-files.count() // READ_ARCHIVES))
    return files.select("file").repartition(tasks).mapInArrow(read, schema)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the archives under the shared folder, and read all records back."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    files = materialize(write_archives(pages, folder, min_bytes), "warc-files")
    return read_archives(spark, files, folder)


ORACLE_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
s AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS hex FROM p),
d AS (SELECT page_id, payload_bytes, hex, list_aggregate(list_transform(range(32), lambda i:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(list_aggregate(list_transform(range(5), lambda j:
        ((instr('0123456789abcdef', substr(hex, CAST(1 + (5 * i + j) // 4 AS INTEGER), 1)) - 1) >> CAST(3 - (5 * i + j) % 4 AS INTEGER))
        % 2 * CAST(pow(2, 4 - j) AS INTEGER)), 'sum') AS INTEGER), 1)), 'string_agg', '') AS payload_digest FROM s),
t AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS top FROM d)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to FROM t"""
