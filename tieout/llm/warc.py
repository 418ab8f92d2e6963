"""WARC bundles in the seekable Zstandard format.

Records are grouped into frames that decompress on their own; a seek table at the end of each
bundle lists the sizes of its frames. The index maps a record to its bundle, its frame and the
place inside the frame, so one record is read with one seek and one small decompression.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieout.llm.common import found_by_tasks, stored
from tieout.session import scratch_path

# Fixed values of the seekable format: skippable-frame magic, seek table magic, entry layout.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
#: Payloads below this are always stored.
LEAST_SHARED = 1000
#: Uncompressed bytes after which a frame is closed, compressed bytes after which a bundle is.
FRAME_BYTES, BUNDLE_BYTES = 1 << 20, 256 << 20
LEVEL = 6
DATE = "2026-01-01T00:00:00Z"
ID_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(ID_SPACE, f'{page_id}/{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record. A revisit keeps the HTTP head, with the length, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {record_id(refers_to, digest)}")
        head.append(f"X-Refers-To-Page-ID: {refers_to}")
    block = http.encode() + (payload if refers_to is None else b"")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at ``at``."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no record at {at}")
    headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    start = end + 4
    stop = start + int(headers["Content-Length"])
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError(f"record at {at} does not end where it says")
    return headers, data[start:stop], stop + 4


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The closing skippable frame: compressed and plain size of each frame, count, magic."""
    body = b"".join(struct.pack("<II", packed, plain) for packed, plain in frames)
    body += struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(source) -> list[tuple[int, int, int]]:
    """(offset, compressed size, plain size) of each frame of an open bundle."""
    end = source.size()
    n, flags, magic = struct.unpack("<IBI", source.read_at(9, end - 9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    width = 12 if flags & 0x80 else 8
    table = source.read_at(n * width, end - 9 - n * width)
    out, at = [], 0
    for i in range(n):
        packed, plain = struct.unpack_from("<II", table, i * width)
        out.append((at, packed, plain))
        at += packed
    return out


def read_record(path: str, frame: int, at: int) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record by its place in the index."""
    fs, name = pafs.FileSystem.from_uri(path)
    with fs.open_input_file(name) as source:
        offset, packed, plain = read_seek_table(source)[frame]
        data = zstandard.ZstdDecompressor().decompress(source.read_at(packed, offset), plain)
    headers, block, _ = parse(data, at)
    return headers, block


class _Bundle:
    """A bundle being written; frames are closed by size, never inside a record."""

    def __init__(self, folder: str):
        self.uri = f"{folder}/bundle-{uuid.uuid4().hex}.warc.zst"
        fs, name = pafs.FileSystem.from_uri(self.uri)
        fs.create_dir(name.rsplit("/", 1)[0], recursive=True)
        self.out = fs.open_output_stream(name, compression=None)
        self.packer = zstandard.ZstdCompressor(level=LEVEL)
        self.frames: list[tuple[int, int]] = []
        self.held: list[bytes] = []
        self.plain = self.written = 0

    def add(self, data: bytes) -> tuple[str, int, int, int, int]:
        """Bundle, frame, frame's offset, place in the frame and length of the new record."""
        place = (self.uri, len(self.frames), self.written, self.plain, len(data))
        self.held.append(data)
        self.plain += len(data)
        if self.plain >= FRAME_BYTES:
            self.flush()
        return place

    def flush(self) -> None:
        if self.held:
            packed = self.packer.compress(b"".join(self.held))
            self.out.write(packed)
            self.frames.append((len(packed), self.plain))
            self.written += len(packed)
            self.held, self.plain = [], 0

    def close(self) -> None:
        self.flush()
        self.out.write(seek_table(self.frames))
        self.out.close()


INDEX = (
    "record_id string, page_id long, bundle string, frame int, frame_offset long,"
    " offset_in_frame long, length long"
)


def _write(folder: str) -> Callable:
    """A task writes bundles under names of its own; only those of the attempt whose index rows
    are committed are ever read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = None
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                rows = []
                for page_id, url, html, digest, refers_to in zip(
                    *(c.to_pylist() for c in whole.slice(at, 500).columns), strict=True
                ):
                    if bundle is not None and bundle.written >= BUNDLE_BYTES:
                        bundle.close()
                        bundle = None
                    bundle = bundle or _Bundle(folder)
                    payload = (html or "").encode("utf-8")
                    place = bundle.add(record(page_id, url, payload, digest, refers_to))
                    rows.append((record_id(page_id, digest), page_id, *place))
                kinds = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                names = [x.split()[0] for x in INDEX.split(", ")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names
                )
        if bundle is not None:
            bundle.close()

    return run


def write_bundles(pages: DataFrame, folder: str) -> DataFrame:
    """Writes ``pages(page_id, url, html)`` to bundles in ``folder``; returns the stored index.

    Of equal payloads of ``LEAST_SHARED`` bytes or more the one with the largest page_id is a
    response and the others revisit it; so are rows without page_id, unless all copies lack
    one. Rows that repeat the largest page_id are responses too. A null html is an empty
    payload, a null url an empty address. An empty table writes no bundle.

    The join brings one row per repeated payload to the pages: where that is small Spark
    broadcasts it, else both sides are plain exchanges that adaptive execution can split.
    """
    found_by_tasks(pages.sparkSession)
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(
        F.col("page_id").cast("long"), "url", "html", F.sha1(payload).alias("digest")
    )
    shared = (
        rows.where(F.octet_length(F.coalesce("html", F.lit(""))) >= LEAST_SHARED)
        .groupBy("digest")
        .agg(F.max("page_id").alias("largest"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select(F.col("digest").alias("same"), "largest")
    )
    first = stored(shared, "payloads")
    roles = rows.join(first, F.col("digest") == F.col("same"), "left").select(
        "page_id", "url", "html", "digest",
        F.expr("if(page_id is null or page_id < largest, largest, null)").alias("refers_to"),
    )
    return stored(roles.mapInArrow(_write(folder), INDEX), "index")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_()]
    for batch in batches:
        for uri in batch.column(0).to_pylist():
            fs, name = pafs.FileSystem.from_uri(uri)
            with fs.open_input_file(name) as source:
                for offset, packed, plain in read_seek_table(source):
                    data = unpack.decompress(source.read_at(packed, offset), plain)
                    rows, at = [], 0
                    while at < len(data):
                        headers, block, at = parse(data, at)
                        head, _, payload = block.partition(b"\r\n\r\n")
                        length = int(head.rsplit(b"Content-Length: ", 1)[1])
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        is_response = headers["WARC-Type"] == "response"
                        page, refers = headers.get("X-Page-ID"), headers.get("X-Refers-To-Page-ID")
                        rows.append((
                            headers["WARC-Record-ID"], None if page is None else int(page),
                            unquote(headers["WARC-Target-URI"]), length, digest, headers["WARC-Type"],
                            None if refers is None else int(refers),
                            not is_response
                            or (len(payload) == length and hashlib.sha1(payload).hexdigest() == digest),
                        ))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                        names=[x.split()[0] for x in RECORDS.split(", ")],
                    )


RECORDS = (
    "record_id string, page_id long, url string, payload_bytes long, payload_digest string,"
    " record_type string, refers_to long, intact boolean"
)


def read_bundles(index: DataFrame) -> DataFrame:
    """Every record of the bundles an index names, frame by frame. ``intact`` says that a
    response's payload has the length and digest its headers give."""
    found_by_tasks(index.sparkSession)
    bundles = index.select("bundle").distinct()
    n = max(1, int(np.ceil(bundles.count())))
    return bundles.repartition(min(n, 4096), "bundle").mapInArrow(_read, RECORDS)


def archived(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes all pages and reads the archives back: one row per record."""
    folder = folder or _as_uri(scratch_path(pages.sparkSession, "warc"))
    return read_bundles(write_bundles(pages, folder))


def _as_uri(path: str) -> str:
    if path.startswith("file:/"):
        return "file:///" + path[len("file:") :].lstrip("/")
    return path if "://" in path else f"file://{path}"
