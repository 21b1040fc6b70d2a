"""WARC records in seekable Zstandard bundles.

Records are grouped into independent Zstandard frames of about
``frame_bytes``, frames into bundles. A bundle file is

1. the data frames, each the records of one group;
2. a skippable frame with the index: for every record its page_id, frame number
   and offset inside the decompressed frame;
3. the seek table: a skippable frame with the two sizes of every frame before it
   (the index counts as a frame of decompressed size 0) and the footer.

Any Zstandard reader decompresses the whole; a reader of one record needs the
tail of the file and one frame.

Tasks turn their rows into bundles as they stream, holding one bundle at a
time. Spark's own text writer puts each into a file of its own below
``bundle=<id>``: the row holds the bundle without its last four bytes and the
line separator is exactly these, the constant magic number that ends a seek
table. So output goes through Spark's commit protocol to any store it knows,
and a lost task leaves nothing behind.

Equal payloads of at least ``min_revisit`` bytes: the record with the largest
page_id is the response, the others revisit it. One digest row per distinct
payload is joined back; Spark splits a hot digest.

Defined cases: a null html is an empty payload; rows that repeat the largest
page_id of a payload are responses, as a revisit refers to another record; a row
without page_id revisits if any copy has one, else it is a response; control
characters and spaces in a url are percent-encoded, a null url is left out.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_dir

MIN_REVISIT = 1000
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 4 << 20
DATE = "2024-01-01T00:00:00Z"

# Fixed values of the seekable format.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK = 0x184D2A5E
SEEK_MAGIC = b"\xb1\xea\x92\x8f"

INDEX_ROW = struct.Struct("<BqIQ")  # has page_id, page_id, frame, offset


def record_id(page_id: int | None) -> str:
    return f"<urn:tidemark:page:{'null' if page_id is None else page_id}>"


def _page_of(identifier: str) -> int | None:
    last = identifier.strip("<>").rpartition(":")[2]
    return None if last == "null" else int(last)


def _safe(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def write_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit (``refers_to``) has the HTTP head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", DATE),
        *([("WARC-Target-URI", _safe(url))] if url else []),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        *([("WARC-Refers-To", record_id(refers_to)),
           ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")] if refers_to is not None else []),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode() + block + b"\r\n\r\n"


def read_record(data: bytes, at: int = 0) -> tuple[dict, int]:
    """The record at ``at`` and where the next one begins."""
    if not data.startswith(b"WARC/1.1\r\n", at):
        raise ValueError(f"no WARC record at offset {at}")
    end = data.index(b"\r\n\r\n", at)
    fields = dict(line.split(": ", 1) for line in data[at:end].decode().split("\r\n")[1:])
    start, length = end + 4, int(fields["Content-Length"])
    block = data[start : start + length]
    head, _, payload = block.partition(b"\r\n\r\n")
    http = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = fields["WARC-Type"]
    if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != int(http["Content-Length"])):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    refers = fields.get("WARC-Refers-To")
    return {
        "page_id": _page_of(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_type": kind,
        "payload_bytes": int(http["Content-Length"]), "payload_digest": digest,
        "refers_to": None if refers is None else _page_of(refers), "payload": payload if kind == "response" else None,
    }, start + length + 4


def _skippable(magic: int, body: bytes) -> bytes:
    return struct.pack("<II", magic, len(body)) + body


class Bundle:
    """A bundle under construction; holds compressed frames and one open frame."""

    def __init__(self, frame_bytes: int) -> None:
        self.frame_bytes, self.frames, self.sizes, self.index = frame_bytes, [], [], []
        self.open, self.open_bytes, self.bytes = [], 0, 0
        self.press = zstandard.ZstdCompressor(level=3)

    def add(self, page_id: int | None, record: bytes) -> None:
        if self.open and self.open_bytes + len(record) > self.frame_bytes:
            self._close()
        self.index.append(INDEX_ROW.pack(page_id is not None, page_id or 0, len(self.frames), self.open_bytes))
        self.open.append(record)
        self.open_bytes += len(record)

    def _close(self) -> None:
        if self.open:
            frame = self.press.compress(b"".join(self.open))
            self.frames.append(frame)
            self.sizes.append((len(frame), self.open_bytes))
            self.bytes += len(frame)
            self.open, self.open_bytes = [], 0

    def finish(self) -> bytes:
        self._close()
        index = _skippable(SKIPPABLE_INDEX, b"".join(self.index))
        sizes = [*self.sizes, (len(index), 0)]
        table = b"".join(struct.pack("<II", *x) for x in sizes) + struct.pack("<IB", len(sizes), 0) + SEEK_MAGIC
        return b"".join(self.frames) + index + _skippable(SKIPPABLE_SEEK, table)


class BundleReader:
    """Random access to a finished bundle by its seek table and index."""

    def __init__(self, data: bytes) -> None:
        if data[-4:] != SEEK_MAGIC:
            raise ValueError("no seek table at the end of the bundle")
        (n,) = struct.unpack_from("<I", data, len(data) - 9)
        sizes = list(struct.iter_unpack("<II", data[len(data) - 9 - 8 * n : len(data) - 9]))
        self.data, self.starts, self.sizes, at = data, [], sizes, 0
        for packed, _ in sizes:
            self.starts.append(at)
            at += packed
        body = data[self.starts[-1] + 8 : self.starts[-1] + sizes[-1][0]]
        self.index = [(page if has else None, frame, offset) for has, page, frame, offset in INDEX_ROW.iter_unpack(body)]

    def frame(self, number: int) -> bytes:
        at, (packed, size) = self.starts[number], self.sizes[number]
        return zstandard.ZstdDecompressor().decompress(self.data[at : at + packed], max_output_size=size)

    def records(self, wanted: set | None = None) -> Iterator[tuple[int, int, dict]]:
        """(frame, offset, record) in order; only frames that hold a wanted page_id are opened."""
        opened, raw = -1, b""
        for page_id, frame, offset in self.index:
            if wanted is None or page_id in wanted:
                if frame != opened:
                    opened, raw = frame, self.frame(frame)
                yield frame, offset, read_record(raw, offset)[0]


def decide(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, payload, digest and refers_to (null: a response) of every row."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    size = F.octet_length("payload")
    # the narrow pass: one row per payload that occurs more than once
    first = rows.filter(size >= min_revisit).groupBy("digest", size.alias("bytes")).agg(
        F.max("page_id").alias("winner"), F.count(F.lit(1)).alias("n"))
    first = first.filter("n > 1 and winner is not null")
    joined = rows.alias("r").join(first.alias("f"), (F.col("r.digest") == F.col("f.digest")) & (F.octet_length("r.payload") == F.col("bytes")), "left")
    refers = F.when(~F.col("winner").eqNullSafe(F.col("page_id")), F.col("winner"))
    return joined.select("page_id", "url", "payload", "r.digest", refers.alias("refers_to"))


def write_bundles(records: DataFrame, path: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> None:
    """Write decided rows as one seekable file per bundle below ``path``."""

    def bundle(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, now = TaskContext.get().partitionId(), 0, Bundle(frame_bytes)

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([now.finish()[: -len(SEEK_MAGIC)]], pa.binary()), pa.array([f"{part}-{number}"])], names=["data", "bundle"])

        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, payload, digest, refers = (batch.column(c)[i].as_py() for c in range(5))
                now.add(page_id, write_record(page_id, url, payload, digest, refers))
                if now.bytes + now.open_bytes >= bundle_bytes:
                    yield done()
                    number, now = number + 1, Bundle(frame_bytes)
        if now.index:
            yield done()

    rows = records.mapInArrow(bundle, "data binary, bundle string")
    rows.select(F.col("data").cast("string").alias("value"), "bundle").write.partitionBy("bundle").option(
        "encoding", "ISO-8859-1").option("lineSep", SEEK_MAGIC.decode("latin-1")).option("maxRecordsPerFile", 1).text(path)


RECORD = ("bundle string, frame int, offset long, page_id long, url string, record_type string, "
          "payload_bytes long, payload_digest string, refers_to long")


def read_bundles(spark: SparkSession, path: str, wanted: set | None = None, payloads: bool = False) -> DataFrame:
    """Records read back from the files; with ``wanted`` page_ids only their frames are opened."""
    names = [x.split()[0] for x in RECORD.split(", ")] + (["payload"] if payloads else [])
    schema = pa.schema([("bundle", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("page_id", pa.int64()),
                        ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name, content = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                rows = []
                for frame, offset, r in BundleReader(content).records(wanted):
                    rows.append({"bundle": name, "frame": frame, "offset": offset, **r})
                    if not payloads:
                        rows[-1].pop("payload")
                for at in range(0, len(rows), 1000):
                    yield pa.RecordBatch.from_pylist(rows[at : at + 1000], pa.schema([schema.field(n) for n in names]))

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(path)
    files = files.select(F.col("bundle").cast("string").alias("bundle"), "content")
    return files.mapInArrow(unpack, RECORD + (", payload binary" if payloads else ""))


def archive(pages: DataFrame, path: str | None = None) -> tuple[str, DataFrame]:
    """Write all pages as bundles and read the archives back: (folder, records)."""
    path = path or scratch_dir(pages.sparkSession, "warc")
    write_bundles(decide(pages), path)
    return path, read_bundles(pages.sparkSession, path)
