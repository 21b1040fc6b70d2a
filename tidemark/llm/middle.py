"""Fill-in-middle transformation by secondary sort.

A document is cut into units, its lines. Two hashes of its id choose the units
that end the prefix and the middle, two more whether and in which order the
sections go out:

    plain  text        psm  <P>prefix<S>suffix<M>middle        spm  <S>suffix<P>prefix<M>middle

No whole text is assembled to be checked. Each document goes out as pieces, runs of
whole units of ``CHUNK`` bytes at most (a longer unit is cut), keyed by document and
output position. One shuffle by document with a sort inside the partitions brings
the pieces in output order; a task streams them into the output's digest, reads the
sections back from the three marks, and hands the pieces on under their place in the
text. A second sort of the same partitions, without another shuffle, streams the
restored text into its digest. (``repartition`` and ``sortWithinPartitions`` are the
DataFrame form of ``repartitionAndSortWithinPartitions``; pieces stay in Spark's
binary rows, and sorts spill.)

Defined cases: a null text is the empty text; a null id hashes as the empty text
behind ``SEED``; a text that holds one of the marks stays plain, so marks are
always read back exactly; repeated rows are documents of their own, told apart by
partition and count among equals; an empty table gives an empty result. Other
columns than doc_id and text take no part. A group of equal rows spreads over all
tasks: the shuffle key holds the digest of id and text, partition and count.
"""

from __future__ import annotations

import hashlib
import struct
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import raw_bytes, text_batches

CHUNK = 1 << 15
SEED = "7:"
RATE = 100  # per cent of the documents to transform
SPM = 50  # per cent of these in the order suffix, prefix, middle

P, S, M = b"<P>", b"<S>", b"<M>"
PREFIX, MIDDLE, SUFFIX = range(3)
#: Marks and the sections behind them, in output order.
FORMS = {"psm": ((P, PREFIX), (S, SUFFIX), (M, MIDDLE)), "spm": ((S, SUFFIX), (P, PREFIX), (M, MIDDLE))}

_HEAD = "n long, form string, prefix_chars long, middle_chars long"
_PIECES = f"row binary, place long, piece binary, {_HEAD}"
_BATCH_ROWS, _BATCH_BYTES = 4096, 1 << 22


class _Rows:
    """Rows gathered to Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, row: tuple, size: int) -> None:
        self.rows.append(row)
        self.size += size

    def full(self) -> bool:
        return len(self.rows) >= _BATCH_ROWS or self.size >= _BATCH_BYTES

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * len(self.schema)
        self.rows, self.size = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, self.schema, strict=True)], schema=self.schema)


def _arrow_schema(df: DataFrame, ddl: str) -> tuple[str, pa.Schema]:
    """``ddl`` with a doc_id of the table's type in front, as DDL and as Arrow schema."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ddl = f"doc_id {df.schema['doc_id'].dataType.simpleString()}, {ddl}"
    return ddl, to_arrow_schema(StructType.fromDDL(ddl))


def choose(doc_id: object, n: int, seed: str = SEED, rate: int = RATE, spm: int = SPM) -> tuple[int, int, str]:
    """Units before the middle, units before the suffix, and form, of a document without marks."""
    digest = hashlib.sha256(f"{seed}{'' if doc_id is None else doc_id}".encode()).digest()
    h1, h2, h3, h4 = struct.unpack_from(">4I", digest)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    return a, b, "plain" if n == 0 or h3 % 100 >= rate else "spm" if h4 % 100 < spm else "psm"


def _cut(text: bytes, chunk: int) -> Iterator[bytes]:
    """Runs of whole units of at most ``chunk`` bytes; a longer unit is cut."""
    at = 0
    while len(text) - at > chunk:
        end = text.rfind(b"\n", at, at + chunk) + 1 or at + chunk
        yield text[at:end]
        at = end
    yield text[at:]


def pieces(docs: DataFrame, seed: str = SEED, rate: int = RATE, spm: int = SPM, chunk: int = CHUNK) -> DataFrame:
    """The pieces of every document's output: ``row`` names the document's row, ``place`` the output
    position; the first piece of a document carries what is known of it."""
    ddl, schema = _arrow_schema(docs, _PIECES)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen, out = TaskContext.get().partitionId(), Counter(), _Rows(schema)
        for batch in text_batches(batches, "text"):
            data, offsets = raw_bytes(batch.column("text"))
            line_ends = np.flatnonzero(data == 10)
            chars = np.zeros(len(data) + 1, np.int64)
            np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
            lines = np.searchsorted(line_ends, offsets)
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                lo, hi = int(offsets[i]), int(offsets[i + 1])
                ends = line_ends[lines[i] : lines[i + 1]] + 1
                n = len(ends) + int(hi > lo and data[hi - 1] != 10)
                text = data[lo:hi].tobytes()
                a, b, form = choose(doc_id, n, seed, rate, spm)
                if any(mark in text for mark in (P, S, M)):
                    form = "plain"
                name = hashlib.blake2b(f"{doc_id}:".encode() + text, digest_size=16).digest()
                row = name + struct.pack(">II", part, seen[name])
                seen[name] += 1
                if form == "plain":
                    head, sections = (n, form, None, None), [(b"", text)]
                else:
                    x, y = (lo if not u else int(ends[u - 1]) if u <= len(ends) else hi for u in (a, b))
                    head = (n, form, int(chars[x] - chars[lo]), int(chars[y] - chars[x]))
                    held = {PREFIX: text[: x - lo], MIDDLE: text[x - lo : y - lo], SUFFIX: text[y - lo :]}
                    sections = [(mark, held[section]) for mark, section in FORMS[form]]
                place = 0
                for mark, section in sections:
                    for piece in _cut(section, chunk):
                        known = (doc_id, row, place, mark + piece, *head) if place == 0 else (None, row, place, mark + piece, None, None, None, None)
                        out.add(known, len(piece))
                        mark, place = b"", place + 1
                        if out.full():
                            yield out.batch()
        yield out.batch()

    return docs.select("doc_id", "text").mapInArrow(emit, ddl)


def _in_order(rows: DataFrame) -> DataFrame:
    return rows.repartition("row").sortWithinPartitions("row", "place")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(is the row's first, row of the batch as a tuple) over sorted batches."""
    last = None
    for batch in batches:
        for values in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            yield values[1] != last, values
            last = values[1]


class _Sections:
    """Reads the sections back from an output that arrives in pieces."""

    def __init__(self, form: str):
        self.marks = list(FORMS.get(form, ()))
        self.section, self.rest, self.count = PREFIX, b"", 0

    def feed(self, piece: bytes) -> Iterator[tuple[int, bytes]]:
        """(place in the text, bytes) of all that is certain so far."""
        piece = self.rest + piece
        while self.marks and (at := piece.find(self.marks[0][0])) >= 0:
            yield from self._out(piece[:at])
            mark, self.section = self.marks.pop(0)
            piece = piece[at + len(mark) :]
        # a mark may lie over the end of a piece
        keep = len(piece) - (len(P) - 1) if self.marks else len(piece)
        self.rest = piece[max(keep, 0) :]
        yield from self._out(piece[: max(keep, 0)])

    def end(self) -> Iterator[tuple[int, bytes]]:
        yield from self._out(self.rest)

    def _out(self, some: bytes) -> Iterator[tuple[int, bytes]]:
        if some:
            yield self.section << 48 | self.count, some
            self.count += 1


def transformed(docs: DataFrame, seed: str = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the output text of every document."""
    ddl, schema = _arrow_schema(docs, f"{_HEAD}, output string")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, head, held = _Rows(schema), None, []
        for first, (doc_id, _, _, piece, *known) in _documents(batches):
            if first:
                if head is not None:
                    text = b"".join(held)
                    out.add((*head, text.decode()), len(text))
                    if out.full():
                        yield out.batch()
                head, held = (doc_id, *known), []
            held.append(piece)
        if head is not None:
            out.add((*head, b"".join(held).decode()), 0)
        yield out.batch()

    return _in_order(pieces(docs, seed, rate, spm)).mapInArrow(join, ddl)


def digests(docs: DataFrame, seed: str = SEED, rate: int = RATE, spm: int = SPM, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, and the digests of the output and of the text restored from it."""
    ddl, schema = _arrow_schema(docs, f"{_PIECES}, output_sha256 string")
    end_ddl, end_schema = _arrow_schema(docs, f"{_HEAD}, output_sha256 string, restored_sha256 string")
    nothing = (None,) * 4

    def outputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Digest every output; pieces go on under their place in the text, behind what is known of the document."""
        out, head, row, digest, sections = _Rows(schema), None, None, None, None

        def closed() -> None:
            for place, some in sections.end():
                out.add((None, row, place, some, *nothing, None), len(some))
            out.add((head[0], row, -1, None, *head[1:], digest.hexdigest()), 0)

        for first, (doc_id, name, _, piece, *known) in _documents(batches):
            if first:
                if head is not None:
                    closed()
                head, row, digest, sections = (doc_id, *known), name, hashlib.sha256(), _Sections(known[1])
            digest.update(piece)
            for place, some in sections.feed(piece):
                out.add((None, row, place, some, *nothing, None), len(some))
            if out.full():
                yield out.batch()
        if head is not None:
            closed()
        yield out.batch()

    def restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, head, digest = _Rows(end_schema), None, None
        for first, (doc_id, _, _, piece, *known) in _documents(batches):
            if first:
                if head is not None:
                    out.add((*head, digest.hexdigest()), 0)
                    if out.full():
                        yield out.batch()
                head, digest = (doc_id, *known), hashlib.sha256()
            else:
                digest.update(piece)
        if head is not None:
            out.add((*head, digest.hexdigest()), 0)
        yield out.batch()

    placed = _in_order(pieces(docs, seed, rate, spm, chunk)).mapInArrow(outputs, ddl)
    # the partitions still hold whole documents: sorting them again needs no exchange
    return placed.sortWithinPartitions("row", "place").mapInArrow(restored, end_ddl)
