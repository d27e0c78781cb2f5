"""WARC archives as seekable Zstandard bundles.

Each task writes its records to one bundle file under a folder all machines
share: records are grouped into frames of about FRAME bytes, every frame is
compressed on its own, and a skippable frame at the end holds the seek table
(compressed and plain size of each frame), so any reader of Zstandard reads
the file whole and one that knows the table reads a single frame.  An index
maps record ids to bundle, frame and the offset in the plain frame.

Of records with equal payloads that of the smallest id is a ``response``, the
others are ``revisit`` records that name it and carry no payload.

A bundle is written under a name of its own for every attempt and becomes
part of the archive only through the index, which Spark commits: a lost or
repeated attempt leaves a file that no index row names, never a wrong read.

Defined results: null html is an empty payload; rows whose id is null are
responses or revisits like others, with the greatest id; several rows with the
smallest id of their payload are all responses; an empty table gives an empty
index; columns other than those named are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from functools import partial
from urllib.parse import urlparse

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package
from .common import stored

FRAME = 1 << 20
LEVEL = 3
#: Smallest payload, in bytes, for which revisits are written.
MIN_REVISIT = 0
# Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
END = b"\r\n\r\n"


def _files(folder: str):
    """File system and path of a shared folder named by a URI or plain path."""
    from pyarrow import fs
    if urlparse(folder).scheme in ("", "file"):
        return fs.LocalFileSystem(), urlparse(folder).path
    return fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", folder))


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(record_id: str, kind: str, url: str | None, payload: bytes, sha1: str, refers_to: str | None) -> bytes:
    """One WARC/1.1 record; a revisit's block is empty."""
    block = payload if kind == "response" else b""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head += [f"WARC-Payload-Digest: sha1:{sha1}", f"X-Payload-Length: {len(payload)}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + END + block + END


def parse(frame: bytes, offset: int) -> tuple[dict[str, str], bytes, int]:
    """Header fields, block and end of the record at ``offset`` of a frame."""
    stop = frame.index(END, offset)
    lines = frame[offset:stop].decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no record starts here")
    head = dict(x.split(": ", 1) for x in lines[1:])
    begin = stop + len(END)
    end = begin + int(head["Content-Length"])
    if frame[end:end + len(END)] != END:
        raise ValueError("a record does not end where its length says")
    return head, frame[begin:end], end + len(END)


class BundleWriter:
    """Appends records to a bundle, frame by frame."""

    def __init__(self, sink, frame: int = FRAME):
        self.sink, self.limit, self.table, self.plain = sink, frame, [], bytearray()
        self.zstd = zstandard.ZstdCompressor(level=LEVEL)

    def add(self, data: bytes) -> tuple[int, int]:
        """(frame, offset in its plain bytes) of the record."""
        if self.plain and len(self.plain) + len(data) > self.limit:
            self._close_frame()
        at = (len(self.table), len(self.plain))
        self.plain += data
        return at

    def _close_frame(self) -> None:
        packed = self.zstd.compress(bytes(self.plain))
        self.sink.write(packed)
        self.table.append((len(packed), len(self.plain)))
        self.plain = bytearray()

    def finish(self) -> None:
        if self.plain:
            self._close_frame()
        body = b"".join(struct.pack("<II", *x) for x in self.table)
        body += struct.pack("<IBI", len(self.table), 0, SEEKABLE_MAGIC)
        self.sink.write(struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body)


class BundleReader:
    """Reads single frames of a bundle through its seek table."""

    def __init__(self, source):
        self.source = source
        end = source.seek(0, 2)
        source.seek(end - 9)
        frames, _, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError("no seek table")
        source.seek(end - 9 - 8 * frames)
        raw = source.read(8 * frames)
        self.table, at = [], 0
        for packed, plain in struct.iter_unpack("<II", raw):
            self.table.append((at, packed, plain))
            at += packed
        self.zstd = zstandard.ZstdDecompressor()

    def frame(self, number: int) -> bytes:
        at, packed, plain = self.table[number]
        self.source.seek(at)
        return self.zstd.decompress(self.source.read(packed), max_output_size=plain)


INDEX = "page_id long, bundle string, frame int, offset long, record_type string, refers_to long"


def _write(folder: str, frame: int, batches):
    files, path = _files(folder)
    name = f"part-{uuid.uuid4().hex}.warc.zst"
    writer = sink = None
    names = [x.split()[0] for x in INDEX.split(", ")]
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            rows = []
            for key, url, html, first in zip(*(part.column(j).to_pylist() for j in range(4))):
                if writer is None:
                    sink = files.open_output_stream(f"{path}/{name}", compression=None)
                    writer = BundleWriter(sink, frame)
                payload = (html or "").encode("utf-8", "surrogatepass")
                revisit = first is not None and first != key
                kind = "revisit" if revisit else "response"
                data = record(f"<urn:page:{key}>", kind, url, payload, digest(payload),
                              f"<urn:page:{first}>" if revisit else None)
                rows.append((key, name, *writer.add(data), kind, first if revisit else None))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.int32(), pa.int64(),
                                                                 pa.string(), pa.int64()))], names=names)
    if writer is not None:
        writer.finish()
        sink.close()


def write_archive(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html", frame: int = FRAME, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write bundles of ``pages`` into ``folder``; the stored index."""
    spark = pages.sparkSession
    ship_package(spark)
    files, path = _files(folder)
    files.create_dir(path, recursive=True)
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        html.alias("html"), F.sha1(html.cast("binary")).alias("sha1"))
    smallest = (rows.where(F.octet_length("html") >= min_revisit)
                .groupBy("sha1").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
                .where("n > 1").select("sha1", "first"))
    # Stored: few repeated payloads are sent to every task, which Spark decides
    # by their size; many meet the pages in a join whose large partitions split.
    smallest = stored(smallest, "warc-repeated")
    marked = (rows.join(smallest, "sha1", "left")
              .select("page_id", "url", "html", "first"))
    return stored(marked.mapInArrow(partial(_write, folder, frame), INDEX), "warc-index")


def _read(folder: str, batches):
    files, path = _files(folder)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    opened, last, data = {}, None, b""
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            rows = []
            for key, bundle, frame, offset in zip(*(part.column(j).to_pylist() for j in range(4))):
                if (bundle, frame) != last:
                    if bundle not in opened:
                        opened.clear()
                        opened[bundle] = BundleReader(files.open_input_file(f"{path}/{bundle}"))
                    last, data = (bundle, frame), opened[bundle].frame(frame)
                head, block, _ = parse(data, offset)
                if head["WARC-Record-ID"] != f"<urn:page:{key}>":
                    raise ValueError("the index names another record")
                kind, sha1 = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
                refers = head.get("WARC-Refers-To")
                if kind == "response" and digest(block) != sha1:
                    raise ValueError("a payload does not match its digest")
                rows.append((key, int(head["X-Payload-Length"]), sha1, kind,
                             int(refers.rstrip(">").rpartition(":")[2]) if refers else None,
                             block if kind == "response" else None))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string(), pa.string(),
                                                                 pa.int64(), pa.binary()))], names=names)


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Every record the index names, read through the bundles' seek tables.
    Sort the index by bundle, frame and offset (as stored) to open a frame once."""
    ship_package(index.sparkSession)
    return index.select("page_id", "bundle", "frame", "offset").mapInArrow(
        partial(_read, folder),
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def fresh_folder(spark) -> str:
    return scratch_path(spark, "warc")
