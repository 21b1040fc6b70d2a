"""Items as a Python data source: scanned by segments, put with commit and abort.

An item is one JSON line. ``ItemFiles`` is registered as ``tidemark_items``:

- **Scan.** The committed files are laid end to end and cut into ``segments`` byte ranges of one
  size, one per task. A line belongs to the range it begins in, so any number of segments gives
  the same rows, and a large file is read by many tasks. The schema is given, not inferred; lines
  are parsed to Arrow batches. The column ``_commit_time``, if asked for, is the put's commit.
- **Put.** Every task attempt writes one file of its own and names it in its commit message. The
  driver's ``commit`` publishes the files of the attempts that succeeded in one manifest, written
  aside and moved into place; only files that a manifest names are ever read. Files of failed,
  lost or duplicate attempts are never seen, and ``abort`` removes what a failed put left.

Layout: ``<path>/items/<commit>/<file>.json`` and ``<path>/_puts/<commit>.json``. A folder without
``_puts`` is an export: all its files but hidden ones are items (``.gz`` files are not cut).

Paths go through Arrow's file systems (local or mounted folders, ``hdfs://``, ``s3://``) on driver
and executors alike. Defined cases: blank lines are skipped; missing attributes are null, others
than the schema's are ignored; a value that is not of its declared type fails the scan; a put of
no rows publishes an empty manifest; a put whose commit is published already changes nothing.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.json as pajson
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from tidemark.functions.columns import COMMIT_COL, orderable_columns
from tidemark.operators.keyed import latest_per_key

FORMAT = "tidemark_items"
SEGMENT_BYTES = 128 * 1024 * 1024
BLOCK_BYTES = 4 * 1024 * 1024


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    path = re.sub("^file:/+", "/", path.rstrip("/"))
    return pafs.FileSystem.from_uri(path) if ":" in path.split("/", 1)[0] else (pafs.LocalFileSystem(), path)


def _names(fs: pafs.FileSystem, folder: str, recursive: bool = False) -> list[pafs.FileInfo]:
    found = fs.get_file_info(pafs.FileSelector(folder, recursive=recursive, allow_not_found=True))
    return sorted((f for f in found if f.type == pafs.FileType.File), key=lambda f: f.path)


def committed_files(path: str) -> list[tuple[str, int, str | None]]:
    """(path, bytes, commit) of the item files that are to be read."""
    fs, root = _open(path)
    if fs.get_file_info(f"{root}/_puts").type == pafs.FileType.NotFound:
        hidden = [f for f in _names(fs, root, recursive=True) if not any(p[:1] in ("_", ".") for p in f.path[len(root) :].split("/") if p)]
        return [(f.path, f.size, None) for f in hidden]
    out = []
    for f in _names(fs, f"{root}/_puts"):
        if f.base_name.endswith(".json") and f.base_name[:1] not in ("_", "."):
            with fs.open_input_stream(f.path) as s:
                put = json.loads(s.read())
            out += [(f"{root}/items/{put['commit']}/{x['name']}", x["bytes"], put["commit"]) for x in put["files"]]
    return out


@dataclass
class Segment(InputPartition):
    """Byte ranges (path, from, to, commit) of one task."""

    ranges: list[tuple[str, int, int, str | None]]


def cut_segments(files: Sequence[tuple[str, int, str | None]], segments: int) -> list[Segment]:
    """``segments`` ranges of one size over the files laid end to end; empty ones are left out."""
    total = sum(size for _, size, _ in files)
    out = [Segment([]) for _ in range(max(1, segments))]
    bounds = [total * i // len(out) for i in range(len(out) + 1)]
    at, i = 0, 0
    for path, size, commit in files:
        end = at + size
        while i < len(out) - 1 and bounds[i + 1] <= at:
            i += 1
        if path.endswith(".gz"):
            out[i].ranges.append((path, 0, size, commit))
        else:
            j, lo = i, at
            while lo < end:
                hi = min(end, bounds[j + 1]) if j < len(out) - 1 else end
                if hi > lo:
                    out[j].ranges.append((path, lo - at, hi - at, commit))
                lo, j = hi, j + 1
        at = end
    return [s for s in out if s.ranges] or [Segment([])]


def lines_in(f, lo: int, hi: int, block: int = BLOCK_BYTES) -> Iterator[bytes]:
    """Blocks of the whole lines that begin in [lo, hi)."""
    start = max(lo - 1, 0)
    f.seek(start)
    held, skip = b"", lo > 0
    while start < hi:
        chunk = f.read(block)
        held += chunk
        if skip:
            # the line that holds the byte before lo began earlier
            cut = held.find(b"\n") + 1
            skip = not cut
            start, held = start + (cut or len(held)), held[cut:] if cut else b""
            if skip and not chunk:
                return
            if skip:
                continue
        if start >= hi:
            return
        if start + len(held) >= hi:
            end = held.find(b"\n", hi - 1 - start) + 1
            if end or not chunk:
                yield held[:end] if end else held
                return
        else:
            end = held.rfind(b"\n") + 1
            if end:
                yield held[:end]
                start, held = start + end, held[end:]
            if not chunk:
                if held:
                    yield held
                return


class SegmentReader(DataSourceReader):
    def __init__(self, path: str, segments: int | None, schema: StructType):
        self.path, self.segments, self.schema = path, segments, schema

    def partitions(self) -> list[Segment]:
        files = committed_files(self.path)
        return cut_segments(files, self.segments or -(-sum(f[1] for f in files) // SEGMENT_BYTES))

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        fs, _ = _open(self.path)
        schema = to_arrow_schema(self.schema)
        fields = pa.schema([f for f in schema if f.name != COMMIT_COL])
        parse = pajson.ParseOptions(explicit_schema=fields, unexpected_field_behavior="ignore")
        for path, lo, hi, commit in partition.ranges:
            with fs.open_input_stream(path, compression="gzip") if path.endswith(".gz") else fs.open_input_file(path) as f:
                for block in [f.read()] if path.endswith(".gz") else lines_in(f, lo, hi):
                    if not block.strip():
                        continue
                    rows = pajson.read_json(pa.BufferReader(block), pajson.ReadOptions(use_threads=False, block_size=len(block) + 1), parse)
                    columns = [pa.repeat(pa.scalar(commit, pa.string()), len(rows)) if f.name == COMMIT_COL else rows.column(f.name).cast(f.type) for f in schema]
                    yield from pa.table(columns, schema=schema).to_batches(max_chunksize=10_000)


@dataclass
class ItemFile(WriterCommitMessage):
    name: str
    bytes: int
    rows: int


class ItemWriter(DataSourceArrowWriter):
    def __init__(self, path: str, commit: str):
        self.path, self.put = path, commit

    def write(self, iterator: Iterator[pa.RecordBatch]) -> ItemFile:
        from pyspark import TaskContext

        context = TaskContext.get()
        fs, root = _open(self.path)
        folder = f"{root}/items/{self.put}"
        name = f"{context.partitionId()}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}.json"
        size = rows = 0
        fs.create_dir(folder, recursive=True)
        with fs.open_output_stream(f"{folder}/{name}") as out:
            for batch in iterator:
                if batch.num_rows:
                    data = ("\n".join(batch.column(0).to_pylist()) + "\n").encode()
                    out.write(data)
                    size, rows = size + len(data), rows + batch.num_rows
        return ItemFile(name, size, rows)

    def commit(self, messages: list[ItemFile | None]) -> None:
        fs, root = _open(self.path)
        files = [m for m in messages if m is not None]
        published = f"{root}/_puts/{self.put}.json"
        if fs.get_file_info(published).type == pafs.FileType.File:
            for m in files:
                fs.delete_file(f"{root}/items/{self.put}/{m.name}")
            return
        for m in files:
            info = fs.get_file_info(f"{root}/items/{self.put}/{m.name}")
            if info.type != pafs.FileType.File or info.size != m.bytes:
                raise ValueError(f"item file {m.name} is not whole")
        named = {m.name for m in files if m.rows}
        put = {"commit": self.put, "files": [{"name": m.name, "bytes": m.bytes, "rows": m.rows} for m in files if m.rows]}
        fs.create_dir(f"{root}/_puts", recursive=True)
        aside = f"{root}/_puts/.{self.put}-{uuid.uuid4().hex[:8]}"
        with fs.open_output_stream(aside) as out:
            out.write(json.dumps(put).encode())
        fs.move(aside, published)
        for f in _names(fs, f"{root}/items/{self.put}"):
            if f.base_name not in named:
                fs.delete_file(f.path)  # what failed attempts left

    def abort(self, messages: list[ItemFile | None]) -> None:
        fs, root = _open(self.path)
        folder = f"{root}/items/{self.put}"
        if fs.get_file_info(f"{root}/_puts/{self.put}.json").type == pafs.FileType.NotFound and fs.get_file_info(folder).type == pafs.FileType.Directory:
            fs.delete_dir(folder)


class ItemFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        raise ValueError("items have no schema of their own: give one")

    def reader(self, schema: StructType) -> SegmentReader:
        return SegmentReader(self.options["path"], int(self.options["segments"]) if "segments" in self.options else None, schema)

    def writer(self, schema: StructType, overwrite: bool) -> ItemWriter:
        if overwrite or schema.simpleString() != "struct<item:string>":
            raise ValueError("items are appended, as one text column called item")
        return ItemWriter(self.options["path"], self.options["commit"])


def scan_items(spark: SparkSession, path: str, schema: str, segments: int | None = None) -> DataFrame:
    """The committed items below ``path`` (of an export: all), read by ``segments`` tasks
    (None: one for every 128 MB)."""
    spark.dataSource.register(ItemFiles)
    reader = spark.read.format(FORMAT).schema(schema)
    return (reader.option("segments", segments) if segments else reader).load(path)


def put_items(items: DataFrame, path: str, commit: str) -> None:
    """Append ``items`` (their columns are the attributes) as one put, all or nothing."""
    spark = items.sparkSession
    spark.dataSource.register(ItemFiles)
    lines = items.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in items.columns])).alias("item"))
    lines.write.format(FORMAT).mode("append").option("commit", commit).save(path)


def current_items(spark: SparkSession, path: str, schema: str, keys: Sequence[str], segments: int | None = None) -> DataFrame:
    """One item per key: the last put wins, then the greatest attributes."""
    rows = scan_items(spark, path, f"{schema}, {COMMIT_COL} string", segments)
    ties = orderable_columns(rows, exclude=[*keys, COMMIT_COL])
    return latest_per_key(rows, list(keys), [COMMIT_COL, *ties]).drop(COMMIT_COL)
