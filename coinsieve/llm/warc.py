"""WARC archives: written with an index, read by coalesced byte ranges.

Each record is a gzip member of its own. Writing gives one index row per record: file,
offset, length, URL, digest. Reading starts from selected index rows: ranges are sorted
by file and offset, near ones are read in one go, and records are cut out of them.

Of records with equal payloads the one with the smallest page_id is a response and holds
the payload; the others are revisits that refer to it. Payloads below ``least_bytes`` are
always written whole.

A file's name is new for each attempt of a task, and the index names the files of the
attempts that counted, so a repeated task does no harm. The folder is any place
that pyarrow's file systems and Spark both reach (a shared mount, HDFS, an object store).

Cases: a null html is an empty payload. A null URL is written as about:blank; characters
that a header cannot hold are percent-encoded. Rows that share the smallest page_id and the payload
are all responses. Rows without page_id refer to the smallest one, or are responses if
there is none. Other columns are not read. An empty table gives an empty index.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coinsieve.llm.storage import stored
from coinsieve.session import scratch_path

FILE_BYTES = 32 << 20  # a file is closed when it is larger
GAP_BYTES = 64 << 10  # unwanted bytes read rather than seeking past them
READ_BYTES = 8 << 20  # of one read, unless one record is larger
TASK_BYTES = 32 << 20  # of archives read by one task, about
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PRINTABLE = "".join(chr(c) for c in range(33, 127) if chr(c) not in '<>"')

INDEX = (
    "file string, offset bigint, length bigint, page_id bigint, url string, payload_digest string, "
    "record_type string, refers_to bigint, payload_bytes bigint"
)
RECORD = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
    "target_uri string, payload binary"
)


def names(schema: str) -> list[str]:
    return [c.split(" ")[0] for c in schema.split(", ")]


def file_system(folder: str):
    """(file system, path) of a folder given as a path or URI."""
    from pyarrow import fs

    for hadoop, plain in (("s3a://", "s3://"), ("s3n://", "s3://")):
        folder = folder.replace(hadoop, plain, 1) if folder.startswith(hadoop) else folder
    return fs.FileSystem.from_uri(folder)


def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, digest: str, refers_to: int | None, size: int, payload: bytes) -> bytes:
    """One record: a response with its payload, or a revisit without."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url, safe=PRINTABLE) if url else 'about:blank'}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head[3:3] = [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    return "\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple:
    """The RECORD row of one record; a response's digest is checked against its payload."""
    head, _, block = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    if version != "WARC/1.1":
        raise ValueError("not a record")
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or sha1_base32(payload) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")

    def page(name: str) -> int | None:
        value = fields.get(name, "<urn:x-page:none>")[len("<urn:x-page:") : -1]
        return None if value == "none" else int(value)

    return (
        page("WARC-Record-ID"), size, digest, kind, page("WARC-Refers-To"), fields["WARC-Target-URI"],
        payload if kind == "response" else None,
    )


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def decided(pages: DataFrame, least_bytes: int) -> DataFrame:
    """page_id, url, html and refers_to (null for responses).

    Only digests and numbers are grouped; digests that occur once need no join partner.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint"), F.col("url").cast("string"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("sha1", F.sha1(F.col("html").cast("binary")))
    copied = (
        rows.filter(F.octet_length("html") >= least_bytes)
        .groupBy("sha1")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )
    copied = stored(copied.select("sha1", "first_id"), "copies")
    other = ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.join(copied, "sha1", "left").select(
        "page_id", "url", "html", F.when(other, F.col("first_id")).alias("refers_to")
    )


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write all pages below ``folder``; returns the stored index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        system.create_dir(root, recursive=True)
        stream, name, offset = None, "", 0
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                page_id, url, html, refers_to = (batch.column(j)[i].as_py() for j in range(4))
                payload = html.encode()
                digest = sha1_base32(payload)
                raw = record(page_id, url, digest, refers_to, len(payload), payload)
                member = gzip.compress(raw, 6, mtime=0)
                if stream is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    stream, offset = system.open_output_stream(f"{root}/{name}", compression=None), 0
                stream.write(member)
                kind = "response" if refers_to is None else "revisit"
                rows.append((name, offset, len(member), page_id, url, digest, kind, refers_to, len(payload)))
                offset += len(member)
                if offset >= file_bytes:
                    stream.close()
                    stream = None
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), INDEX_TYPES, strict=True)], names=names(INDEX)
                )
        if stream is not None:
            stream.close()

    return stored(decided(pages, least_bytes).mapInArrow(run, INDEX), "index")


INDEX_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
RECORD_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]


def coalesce_ranges(offsets: np.ndarray, lengths: np.ndarray, gap: int = GAP_BYTES, most: int = READ_BYTES) -> list[tuple[int, int]]:
    """[from, to) places in the sorted arrays of ranges that are read together."""
    groups, start = [], 0
    for i in range(1, len(offsets) + 1):
        if i < len(offsets):
            end = offsets[i - 1] + lengths[i - 1]
            if offsets[i] - end <= gap and offsets[i] + lengths[i] - offsets[start] <= most:
                continue
        groups.append((start, i))
        start = i
    return groups


def read_records(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The RECORD rows of the selected index rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        for batch in batches:
            files = batch.column(0).to_pylist()
            offsets, lengths = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            start = 0
            while start < len(files):
                end = start
                while end < len(files) and files[end] == files[start]:
                    end += 1
                with system.open_input_file(f"{root}/{files[start]}") as source:
                    for a, b in coalesce_ranges(offsets[start:end], lengths[start:end]):
                        a, b = a + start, b + start
                        held = source.read_at(int(offsets[b - 1] + lengths[b - 1] - offsets[a]), int(offsets[a]))
                        rows = []
                        for o, n in zip((offsets[a:b] - offsets[a]).tolist(), lengths[a:b].tolist(), strict=True):
                            row = parse(zlib.decompress(held[o : o + n], 31))
                            rows.append(row if payloads else (*row[:-1], None))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), RECORD_TYPES, strict=True)],
                            names=names(RECORD),
                        )
                start = end

    # Index rows are small next to what they point to: tasks by bytes of the archives.
    wanted = index.select("file", "offset", "length")
    tasks = -(-(wanted.agg(F.sum("length").alias("n")).first().n or 1) // TASK_BYTES)
    return wanted.repartition(tasks, "file").sortWithinPartitions("file", "offset").mapInArrow(run, RECORD)


def round_trip(pages: DataFrame) -> DataFrame:
    """Every page written to an archive below the shared folder and read back."""
    folder = scratch_path(pages.sparkSession, "warc")
    index = write_archives(pages, folder)
    return read_records(index, folder, payloads=False).drop("payload", "target_uri")
