"""Token counts by a scan for separators in flat token files.

A flat file is the token ids of its documents one after another, two bytes
each, every document closed by the end-of-document id. There is no index.

Writing: tasks encode their documents as they stream and hand them, in order, to
Spark's text writer, whose line separator is the two bytes of the
end-of-document id. So each row becomes its tokens and one separator, the file
is flat, and commits are Spark's. A task begins a new shard after about
``SHARD_BYTES``. The same job writes the documents' ids, as records of one
width in the same order, to files of their own; no text is shuffled.

Scanning: files are read as binary and cut into blocks of ``BLOCK_TOKENS``. Each
block is searched for the separator at once (only at token positions, so two
neighbouring halves are never taken for one). A block knows its own separators
and its length; what lies before its first separator belongs to a document that
began in an earlier block. A prefix scan over the block summaries (running
number of separators, running last separator) gives every block the number of
its first document and the place where that document began.

Defined cases: a null or empty text has 0 tokens and still its separator; tokens
after the last separator of a file are an unfinished document, reported with
``finished`` false; an odd last byte raises an error; an empty file has no documents;
repeated rows are documents of their own. Control strings in texts are ordinary text.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import fs
from tidemark.session import scratch_dir

#: Folder with the public vocabularies and the module that names their pattern.
TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
END_OF_DOCUMENT = 50256
BLOCK_TOKENS = 1 << 18
SHARD_BYTES = 32 << 20
ID = "<Bq"  # whether there is an id, the id

_loaded: dict = {}


def encoder(folder: str = TOKENIZERS, vocabulary: str = VOCABULARY):
    """The byte-level BPE encoder of a vocabulary file (loaded once per task process)."""
    if (folder, vocabulary) not in _loaded:
        import importlib.util

        import tiktoken

        spec = importlib.util.spec_from_file_location("public_tokenizers", f"{folder}/__init__.py")
        public = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(public)
        with open(f"{folder}/{vocabulary}", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _loaded[folder, vocabulary] = tiktoken.Encoding("flat", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _loaded[folder, vocabulary]


def write_flat(docs: DataFrame, path: str, folder: str = TOKENIZERS, end: int = END_OF_DOCUMENT, shard_bytes: int = SHARD_BYTES) -> None:
    """Write the documents' tokens below ``kind=tokens/shard=<s>`` and their ids, in the same order, below ``kind=ids``."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder, part, shard, filled, row = encoder(folder), TaskContext.get().partitionId(), 0, 0, 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                b = batch.slice(lo, 256)
                data, shards = [], []
                for x in b.column("text").to_pylist():
                    if filled >= shard_bytes:
                        shard, filled = shard + 1, 0
                    data.append(np.array(coder.encode_ordinary(x), "<u2").tobytes())
                    shards.append(f"{part}-{shard}")
                    filled += len(data[-1]) + 2
                ids = [struct.pack(ID, x is not None, x or 0) for x in b.column("doc_id").to_pylist()]
                n, at = b.num_rows, pa.array(np.arange(row, row + b.num_rows))
                row += n
                for kind, values in (("tokens", data), ("ids", ids)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([kind] * n), pa.array(shards), at, pa.array(values, pa.binary())], names=["kind", "shard", "row", "data"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    flat = rows.mapInArrow(encode, "kind string, shard string, row long, data binary").sortWithinPartitions("kind", "shard", "row")
    flat.select(F.col("data").cast("string").alias("value"), "kind", "shard").write.partitionBy("kind", "shard").option(
        "maxRecordsPerFile", 0).option("encoding", "ISO-8859-1").option("lineSep", end.to_bytes(2, "little").decode("latin-1")).text(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(shard, number, doc_id) from the id files below ``path``."""
    width = struct.calcsize(ID) + 2

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content").to_pylist(), strict=True):
                at = range(0, len(content), width)
                found = [struct.unpack_from(ID, content, i) for i in at]
                for lo in range(0, len(found), 20_000):
                    some = found[lo : lo + 20_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([shard] * len(some)), pa.array(np.arange(lo, lo + len(some))), pa.array([x if has else None for has, x in some], pa.int64())],
                        names=["shard", "number", "doc_id"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    whole = F.count("*").over(Window.partitionBy("shard")) == 1
    files = files.select(_shard("path").alias("shard"), "content").withColumn(
        "content", F.when(whole, F.col("content")).otherwise(F.raise_error(F.concat(F.lit("more than one file in shard "), "shard")).cast("binary")))
    return files.mapInArrow(unpack, "shard string, number long, doc_id long")


def _shard(path: str) -> Column:
    return F.regexp_extract(path, r"shard=([0-9]+-[0-9]+)/", 1)


def scan_flat(spark: SparkSession, path: str, end: int = END_OF_DOCUMENT, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, number, n_tokens, finished) of every document of the flat files below ``path``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.col("path").alias("file"), "content")
    schema = "file string, block int, tokens long, ends array<long>"

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("file").to_pylist(), batch.column("content"), strict=True):
                data = memoryview(content.as_buffer())
                if len(data) % 2:
                    raise ValueError(f"{name}: {len(data)} bytes are not whole tokens")
                ids = np.frombuffer(data, "<u2")
                for block, at in enumerate(range(0, len(ids), block_tokens)):
                    part = ids[at : at + block_tokens]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name]), pa.array([block], pa.int32()), pa.array([len(part)], pa.int64()),
                         pa.array([np.flatnonzero(part == end)], pa.list_(pa.int64()))], names=["file", "block", "tokens", "ends"])

    found = files.mapInArrow(search, schema)
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("tokens").over(before), F.lit(0))
    last = F.when(F.size("ends") > 0, F.element_at("ends", -1))
    placed = found.withColumns({"start": start, "first": F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0))})
    # a document began behind the last separator of any block before
    placed = placed.withColumn("began", F.coalesce(F.max(F.col("start") + last + 1).over(before), F.lit(0)))
    final = F.lead("block").over(order).isNull()
    placed = placed.withColumn("open", F.when(final, F.col("start") + F.col("tokens") - F.coalesce(F.col("start") + last + 1, F.col("began"))))
    whole = placed.select("file", "first", "start", "began", "ends", F.posexplode("ends").alias("at", "end"))
    length = F.when(F.col("at") == 0, F.col("start") + F.col("end") - F.col("began")).otherwise(
        F.col("end") - F.col("ends")[F.greatest(F.col("at") - 1, F.lit(0))] - 1)
    whole = whole.select("file", (F.col("first") + F.col("at")).alias("number"), length.alias("n_tokens"), F.lit(True).alias("finished"))
    rest = placed.filter("open > 0").select("file", (F.col("first") + F.size("ends")).alias("number"), F.col("open").alias("n_tokens"), F.lit(False).alias("finished"))
    return whole.unionByName(rest)


def token_counts(docs: DataFrame, path: str | None = None, folder: str = TOKENIZERS) -> DataFrame:
    """(doc_id, n_tokens): write the documents as flat token files, scan these and name the counts."""
    spark, path = docs.sparkSession, path or scratch_dir(docs.sparkSession, "flat-tokens")
    write_flat(docs, path, folder)
    if not fs.exists(spark, f"{path}/kind=ids"):
        return spark.range(0).select(F.col("id").alias("doc_id"), F.col("id").alias("n_tokens"))
    counted = scan_flat(spark, f"{path}/kind=tokens").select(_shard("file").alias("shard"), "number", "n_tokens")
    return read_ids(spark, f"{path}/kind=ids").join(counted, ["shard", "number"]).select("doc_id", "n_tokens")
