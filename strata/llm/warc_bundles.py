"""WARC archives as seekable Zstandard bundles.

A bundle is one file: independent Zstandard frames of some WARC records each,
then two skippable frames. The first maps every record's identifier to its
frame and its place in that frame, the second is the seek table of the
Zstandard seekable format, which ends the file. Any Zstandard tool
decompresses a bundle to plain WARC; a reader that wants one record takes the
index, skips to the frame and decompresses only that.

Spark's own text writer writes the files (and commits them, so that a lost
executor leaves none of its own behind): a row is a whole bundle but for its
last four bytes, and the line separator is these four, the magic number that
ends every seek table. Nothing opens a path in Python, so archives can lie
in any store that Spark writes.

Of records with equal payloads one is a ``response``, the others are
``revisit`` records that name it and carry no payload. Digests are grouped
before anything is joined; a payload crosses the network only when there are
too many repeated digests to broadcast.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.tables import sized, written

FRAME_BYTES = 256 << 10  # plain bytes after which a frame is closed
BUNDLE_BYTES = 32 << 20  # compressed bytes after which a bundle is closed

# Fixed values of the Zstandard seekable format and of WARC 1.1.
INDEX_FRAME = 0x184D2A50
SEEK_TABLE_FRAME = 0x184D2A5E
SEEKABLE_MAGIC = b"\xb1\xea\x92\x8f"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_HEAD = struct.Struct("<II")  # magic number, size of what follows
_ENTRY = struct.Struct("<II")  # compressed and plain size of a frame
_PLACE = struct.Struct("<16sIII")  # record identifier, frame, offset in the frame, length
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")
_RECORDS = (
    "record_id string, id string, url string, record_type string, payload_bytes long, payload_digest string, "
    "refers_to string, payload binary"
)
_INDEX = "record_id string, path string, frame int, frame_offset long, frame_bytes long, offset long, length long"


def _identifier(id_: str | None, sha1: str) -> bytes:
    """16 bytes that name a record: what is known of it, and of the response that a revisit refers to."""
    return hashlib.md5(f"{'' if id_ is None else 'id:' + id_}\n{sha1}".encode(), usedforsecurity=False).digest()


def _urn(identifier: bytes) -> str:
    h = identifier.hex()
    return f"urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}"


def _line(value: str) -> str:
    """A header's value: what would end its line is percent-encoded."""
    return _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", value)


def _record(id_, url, size, sha1, refers_to, refers_url, payload, date) -> tuple[bytes, bytes]:
    """Identifier and bytes of one WARC record; ``payload`` is None in a revisit."""
    name = _identifier(id_, sha1)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if payload is not None else 'revisit'}", f"WARC-Record-ID: <{_urn(name)}>"]
    head += [f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    if id_ is not None:
        head.append(f"X-Source-Id: {quote(id_)}")
    head.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}")
    if payload is None:
        head.append(f"WARC-Profile: {PROFILE}")
        head.append(f"WARC-Refers-To: <{_urn(_identifier(refers_to, sha1))}>")
        head.append(f"X-Refers-To-Source-Id: {quote(refers_to)}")
        if refers_url is not None:
            head.append(f"WARC-Refers-To-Target-URI: {_line(refers_url)}")
    head.append("Content-Type: application/http; msgtype=response")
    head.append(f"Content-Length: {len(block)}")
    return name, "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Bundle:
    """Frames of one bundle as they are filled."""

    def __init__(self):
        self.compressor = zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.places: list[bytes] = []
        self.open: list[bytes] = []
        self.filled = self.bytes = 0

    def add(self, name: bytes, record: bytes) -> None:
        self.places.append(_PLACE.pack(name, len(self.frames), self.filled, len(record)))
        self.open.append(record)
        self.filled += len(record)
        if self.filled >= FRAME_BYTES:
            self.close_frame()

    def close_frame(self) -> None:
        if self.open:
            self.frames.append(self.compressor.compress(b"".join(self.open)))
            self.sizes.append((len(self.frames[-1]), self.filled))
            self.bytes += len(self.frames[-1])
            self.open, self.filled = [], 0

    def finish(self) -> bytes:
        """The file without the magic number at its end, which the writer adds."""
        self.close_frame()
        index = b"".join(self.places)
        index = _HEAD.pack(INDEX_FRAME, len(index)) + index
        sizes = [*self.sizes, (len(index), 0)]
        table = b"".join(_ENTRY.pack(*s) for s in sizes)
        tail = _HEAD.pack(SEEK_TABLE_FRAME, len(table) + 9) + table + struct.pack("<IB", len(sizes), 0)
        return b"".join([*self.frames, index, tail])


def _places(index: memoryview) -> Iterator[tuple[bytes, int, int, int]]:
    """Identifier, frame, offset in the frame and length of every record of a bundle."""
    return _PLACE.iter_unpack(index)


def _layout(data: memoryview) -> tuple[list[tuple[int, int]], memoryview]:
    """Offsets and sizes of a bundle's data frames, and its index, from the footer alone."""
    if bytes(data[-4:]) != SEEKABLE_MAGIC:
        raise ValueError("not a seekable bundle: the seek table is missing")
    n = struct.unpack("<I", data[-9:-5])[0]
    sizes = [_ENTRY.unpack_from(data, len(data) - 9 - 8 * (n - k))[0] for k in range(n)]
    frames, at = [], 0
    for size in sizes:
        frames.append((at, size))
        at += size
    start, size = frames.pop()
    return frames, data[start + 8 : start + size]


def repeated_payloads(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``sha1, bytes, mark, response`` of the payloads of ``least_bytes`` and more that several rows share.

    ``pages`` has ``id, url, payload, sha1, bytes, mark``. Counted before any
    row moves: a payload is one row per task, however many rows repeat it.
    """
    some = pages.where(F.col("bytes") >= least_bytes).groupBy("sha1", "bytes", "mark")
    return some.agg(F.count("*").alias("n"), F.max(F.struct("id", "url")).alias("response")).where("n > 1").drop("n")


def archive(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0, date: str | None = None
) -> None:
    """Writes a record per row of ``pages`` to bundles in the new folder ``path``.

    Of rows with equal payloads of at least ``least_bytes`` bytes, the one with
    the largest ``key`` becomes a response and the others revisit it. Repeated
    rows of that largest key are responses all, as are rows of a payload
    whose keys are all null. A null payload is an empty one; a null key or url is left
    out of the record. White space and control characters of a url are
    percent-encoded, as in any URI. Other columns are not read; no rows make
    a folder without bundles. Texts are archived in UTF-8, binary payloads as
    they are.
    """
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).alias("id"), F.col(url).alias("url"), body.alias("payload"))
    rows = rows.withColumns({"sha1": F.sha1("payload"), "bytes": F.octet_length("payload"), "mark": F.xxhash64("payload")})
    shared = written(repeated_payloads(rows, least_bytes), "warc-repeated")
    rows = rows.join(sized(shared), ["sha1", "bytes", "mark"], "left")
    revisit = F.col("response.id").isNotNull() & ~F.col("id").eqNullSafe(F.col("response.id"))
    rows = rows.select(
        F.col("id").cast("string").alias("id"), "url", F.col("bytes").cast("long").alias("bytes"), "sha1",
        F.when(revisit, F.col("response.id").cast("string")).alias("refers_to"),
        F.when(revisit, F.col("response.url")).alias("refers_url"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = lambda b: pa.RecordBatch.from_arrays([pa.array([b.finish()], pa.binary())], names=["bundle"])
        bundle = _Bundle()
        for batch in batches:
            columns = batch.columns
            for i in range(batch.num_rows):
                bundle.add(*_record(*(c[i].as_py() for c in columns), date))
                if bundle.bytes >= BUNDLE_BYTES:
                    yield done(bundle)
                    bundle = _Bundle()
        if bundle.places:
            yield done(bundle)

    bundles = rows.mapInArrow(run, "bundle binary").select(F.col("bundle").cast("string").alias("value"))
    writer = bundles.write.option("lineSep", SEEKABLE_MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1")
    writer.option("maxRecordsPerFile", 1).option("compression", "none").text(path)


def _files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").load(paths).where("length > 0").select("path", "content")


def _headers(lines: bytes) -> dict[str, str]:
    return dict(x.split(": ", 1) for x in lines.decode().split("\r\n")[1:])


def _read(record: memoryview) -> tuple:
    """One record's row of :data:`_RECORDS`; a response's payload is held against its digest."""
    data = bytes(record)
    warc, _, block = data.partition(b"\r\n\r\n")
    head = _headers(warc)
    http, _, body = block[: int(head["Content-Length"])].partition(b"\r\n\r\n")
    size, digest = int(_headers(http)["Content-Length"]), head["WARC-Payload-Digest"].removeprefix("sha1:")
    if (kind := head["WARC-Type"]) == "response":
        if len(body) != size or base64.b32encode(hashlib.sha1(body, usedforsecurity=False).digest()).decode() != digest:
            raise ValueError(f"payload and digest differ in {head['WARC-Record-ID']}")
    else:
        body = None
    source, refers = (None if x is None else unquote(x) for x in (head.get("X-Source-Id"), head.get("X-Refers-To-Source-Id")))
    return (head["WARC-Record-ID"].strip("<>"), source, head.get("WARC-Target-URI"), kind, size, digest, refers, body)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def _record_schema(payloads: bool) -> tuple[str, pa.Schema]:
    kinds = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.string(), pa.binary()]
    names = [x.split()[0] for x in _RECORDS.split(", ")]
    n = len(names) - (not payloads)
    return ", ".join(_RECORDS.split(", ")[:n]), pa.schema(list(zip(names[:n], kinds[:n], strict=True)))


def records(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """Every record of the bundles in ``path``: its identifier, ``id``, url, type, size and digest of the full payload, ``refers_to``.

    ``payloads`` adds the payload (null in a revisit, see :func:`fetch`). A
    response whose payload does not fit its digest is an error. One frame is
    plain in memory at a time. ``id`` and ``refers_to`` are the source's ids as text.
    """
    ddl, schema = _record_schema(payloads)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = zstandard.ZstdDecompressor()
        for batch in batches:
            for content in batch.column(0):
                data = memoryview(content.as_buffer())
                frames, index = _layout(data)
                places: dict[int, list[tuple[int, int]]] = {}
                for _, frame, offset, length in _places(index):
                    places.setdefault(frame, []).append((offset, length))
                for k, (start, size) in enumerate(frames):
                    text = memoryview(plain.decompress(data[start : start + size]))
                    yield _batch([_read(text[o : o + n])[: len(schema)] for o, n in places[k]], schema)

    return _files(spark, path).select("content").mapInArrow(run, ddl)


def index(spark: SparkSession, path: str) -> DataFrame:
    """``record_id, path, frame, frame_offset, frame_bytes, offset, length`` per record, from the footers: no frame is decompressed."""
    kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 4]
    schema = pa.schema(list(zip([x.split()[0] for x in _INDEX.split(", ")], kinds, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                frames, places = _layout(memoryview(content.as_buffer()))
                rows = [(_urn(r), name.as_py(), f, *frames[f], o, n) for r, f, o, n in _places(places)]
                if rows:
                    yield _batch(rows, schema)

    return _files(spark, path).mapInArrow(run, _INDEX)


def fetch(spark: SparkSession, entries: DataFrame) -> DataFrame:
    """The records, with payloads, that ``entries`` (rows of :func:`index`) point to.

    Only the files they name are read, and of these only their frames go to
    Python and are decompressed: a frame is cut out of its file in the JVM. For
    lookups: the paths named are listed on the driver.
    """
    ddl, schema = _record_schema(True)
    paths = [r.path for r in entries.select("path").distinct().collect()]
    if not paths:
        return spark.createDataFrame([], ddl)
    frame = F.expr("substring(content, int(frame_offset + 1), int(frame_bytes))").alias("bytes")
    cut = _files(spark, paths).join(sized(entries), "path").select(frame, "offset", "length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = zstandard.ZstdDecompressor()
        for batch in batches:
            for data, offset, length in zip(*batch.columns, strict=True):
                text = memoryview(plain.decompress(data.as_py()))
                yield _batch([_read(text[offset.as_py() : offset.as_py() + length.as_py()])], schema)

    return cut.mapInArrow(run, ddl)
