"""WARC archives as seekable Zstandard bundles.

A bundle is a row of independent Zstandard frames, each with a group of records, and a footer: a skippable frame with
the seek table of the public seekable format (compressed and plain size of every frame). Any decoder of plain
Zstandard reads the whole bundle; with the footer, one record costs one frame. The manifest, a table with one row per
record, maps record ids to bundle, frame and offset within the frame.

Writing: tasks write bundles of bounded size straight to the shared folder, under a name of their own, and move
them into place when complete; the manifest names the bundles of the attempt that succeeded, so a lost executor or a
repeated task leaves at most files that nothing refers to. A payload seen before (same SHA-256, at least
``MIN_REVISIT`` bytes) becomes a revisit record of the smallest page id that has it.

Defined results: a null payload is the empty one; a null URL leaves its header out; a null page id is archived like
any other, never is the target of a revisit unless it stands alone (then its twins are all responses), and rows that
repeat the smallest page id are all responses; a payload may be larger than a bundle, which then holds it alone.
"""

from __future__ import annotations

import hashlib
import math
import re
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.llm.common import fields, query, table
from skyloom.session import durable, work_path

MIN_REVISIT = 100
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 64 << 20
FRAMES_A_TASK = 64
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"

#: Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

MANIFEST = fields(
    bundle=T.StringType(), record_id=T.StringType(), page_id=T.LongType(), frame=T.IntegerType(), start=T.LongType(),
    length=T.LongType(),
)
RECORD = fields(
    page_id=T.LongType(), url=T.StringType(), payload_bytes=T.LongType(), payload_digest=T.StringType(),
    record_type=T.StringType(), refers_to=T.LongType(), record_id=T.StringType(), bundle=T.StringType(),
    frame=T.IntegerType(), start=T.LongType(), payload=T.BinaryType(),
)


# ---------------------------------------------------------------- records
def _header_value(value) -> str:
    """A value on one header line: control characters, blanks at the ends and % as escapes."""
    return re.sub(r"[\x00-\x1f\x7f%]", lambda m: f"%{ord(m[0]):02X}", str(value))


def _plain_value(value: str) -> str:
    return re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), value)


def record_id(page_id, digest: str, row: str) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}/{row}')}"


def make_record(page_id, url, payload: bytes, digest: str, refers_to, row: str) -> tuple[str, bytes]:
    """Record id and bytes of one response, or of a revisit if ``refers_to`` is given."""
    revisit = refers_to is not None
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    name = record_id(page_id, digest, row)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{name}>",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if url is not None:
        head.append(f"WARC-Target-URI: {_header_value(url)}")
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"X-Refers-To-Page-Id: {refers_to}")
    return name, "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, headers and block of every record in plain WARC bytes."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        head = dict(line.split(": ", 1) for line in lines[1:])
        start, size = end + 4, int(head["Content-Length"])
        yield at, head, data[start:start + size]
        at = start + size + 4


def read_record(head: dict[str, str], block: bytes) -> dict:
    """The archived page of a record; a revisit has the full payload's size and digest, and no payload."""
    http, payload = block.split(b"\r\n\r\n", 1)
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = head["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError("payload differs from its digest")
    number = {k: int(head[k]) if k in head else None for k in ("X-Page-Id", "X-Refers-To-Page-Id")}
    url = head.get("WARC-Target-URI")
    return {
        "page_id": number["X-Page-Id"], "url": None if url is None else _plain_value(url), "payload_bytes": size,
        "payload_digest": digest, "record_type": kind, "refers_to": number["X-Refers-To-Page-Id"],
        "record_id": head["WARC-Record-ID"].strip("<>"), "payload": payload if kind == "response" else None,
    }


# ---------------------------------------------------------------- bundles
def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The footer for frames of these (compressed, plain) sizes."""
    entries = b"".join(struct.pack("<II", *pair) for pair in sizes)
    body = entries + struct.pack("<IBI", len(sizes), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def open_folder(uri: str):
    return pyarrow.fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class Bundle:
    """One bundle being written."""

    def __init__(self, folder: str):
        self.fs, root = open_folder(folder)
        self.fs.create_dir(root, recursive=True)
        name = uuid.uuid4().hex
        self.partial, self.path = f"{root}/.{name}.part", f"{root}/{name}.warc.zst"
        self.uri = f"{folder.rstrip('/')}/{name}.warc.zst"
        self.out = self.fs.open_output_stream(self.partial)
        self.pack = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.sizes: list[tuple[int, int]] = []
        self.group: list[bytes] = []
        self.held = self.written = 0
        self.rows: list[tuple] = []

    def add(self, name: str, page_id, record: bytes) -> None:
        self.rows.append((self.uri, name, page_id, len(self.sizes), self.held, len(record)))
        self.group.append(record)
        self.held += len(record)
        self.written += len(record)
        if self.held >= FRAME_BYTES:
            self.end_frame()

    def end_frame(self) -> None:
        if self.group:
            frame = self.pack.compress(b"".join(self.group))
            self.out.write(frame)
            self.sizes.append((len(frame), self.held))
            self.group, self.held = [], 0

    def close(self) -> list[tuple]:
        self.end_frame()
        self.out.write(seek_table(self.sizes))
        self.out.close()
        self.fs.move(self.partial, self.path)
        return self.rows


class BundleReader:
    """Random access to a bundle by its footer."""

    def __init__(self, uri: str):
        fs, path = open_folder(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        count, _, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"no seek table in {uri}")
        entries = self.file.read_at(8 * count, size - 9 - 8 * count)
        self.frames, at = [], 0
        for k in range(count):
            packed, plain = struct.unpack_from("<II", entries, 8 * k)
            self.frames.append((at, packed, plain))
            at += packed

    def frame(self, number: int) -> bytes:
        at, packed, plain = self.frames[number]
        return zstandard.ZstdDecompressor().decompress(self.file.read_at(packed, at), max_output_size=plain)

    def record(self, frame: int, start: int, length: int) -> dict:
        """One record by its place in the manifest; reads one frame."""
        _, head, block = next(parse_records(self.frame(frame)[start:start + length]))
        return read_record(head, block)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.file.close()


# ---------------------------------------------------------------- archives of a table
def with_targets(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, digest`` and ``refers_to``, the response a revisit points to (else null)."""
    hashed = pages.select(
        "page_id", "url", "html", F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256).alias("digest"),
        F.octet_length(F.coalesce("html", F.lit(""))).alias("n"),
    )
    # Only digests that occur more than once travel on; the pages themselves are not shuffled for this unless
    # repeated payloads are too many to be sent to every task.
    again = durable(
        hashed.where(F.col("n") >= MIN_REVISIT).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1").select("digest", "first"),
        "digests",
    )
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return hashed.join(again, "digest", "left").select(
        "page_id", "url", "html", "digest", F.when(revisit, F.col("first")).alias("refers_to")
    )


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write one record per row of ``pages(page_id, url, html)``; returns the manifest, written beside the bundles."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bundle, n = None, 0
        for batch in batches:
            for page_id, url, html, digest, refers_to in batch.itertuples(index=False):
                bundle = bundle or Bundle(folder)
                page_id, refers_to = (None if v is None else int(v) for v in (page_id, refers_to))
                payload = html.encode() if html else b""
                name, record = make_record(page_id, url, payload, digest, refers_to, f"{bundle.uri}/{n}")
                bundle.add(name, page_id, record)
                n += 1
                if bundle.written >= BUNDLE_BYTES:
                    yield frame(bundle.close())
                    bundle = None
        if bundle:
            yield frame(bundle.close())

    def frame(rows):
        return pd.DataFrame(rows, columns=MANIFEST.fieldNames()).astype({"page_id": "Int64"})

    # Ids travel as text: a column of whole numbers with nulls would become floating point on the way.
    rows = with_targets(pages).withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    return durable(rows.mapInPandas(write, MANIFEST), "manifest")


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of the bundles a manifest names, read back frame by frame and checked against its digest."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri, number in batch.itertuples(index=False):
                with BundleReader(uri) as bundle:
                    rows = []
                    for at, head, block in parse_records(bundle.frame(number)):
                        row = read_record(head, block) | {"bundle": uri, "frame": number, "start": at}
                        rows.append(row if payloads else row | {"payload": None})
                yield pd.DataFrame(rows, columns=RECORD.fieldNames()).astype({"page_id": "Int64", "refers_to": "Int64"})

    frames = manifest.select("bundle", "frame").distinct()
    # A row here stands for about FRAME_BYTES of records, so tasks are cut by number of rows, not by their bytes.
    tasks = max(manifest.sparkSession.sparkContext.defaultParallelism, math.ceil(frames.count() / FRAMES_A_TASK))
    return frames.repartition(tasks, "bundle", "frame").mapInPandas(read, RECORD)


def archive_folder(spark: SparkSession) -> str:
    return work_path(spark, "warc")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""


@query("op6_warc", ORACLE)
def op6_warc(spark, sf_dir):
    manifest = write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), archive_folder(spark))
    return read_archives(manifest, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
