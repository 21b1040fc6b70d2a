"""Language-model scores by context-tree weighting over binary-decomposed bytes.

A text is its lower-cased words, each followed by a space, then one end mark.
Every byte is eight binary decisions (255 nodes of a byte tree), each with
a context tree of its own over the ``DEPTH`` bytes before, latest first, whatever words
they belong to; before the start of a text stands filling. Every tree node has a
Krichevsky-Trofimov estimate from the training counts, and the weighted mixture over
all depths gives the probability: ``P_w = (P_kt + product of the children's P_w) / 2``.
A text's probability is the product over its bytes; code length per byte follows.

How the work is dealt out:

- One scan turns texts into blocks. A block is one row with its documents as word
  numbers, and packed lists of its distinct (context, byte) keys and of its words, with
  training counts. Lists are dealt to ``BINS`` by the last three context bytes (words: by
  hash), a row per block and bin.
- A bin's lists are merged as they stream by, so a task holds the distinct keys of one
  bin, however many blocks there are, and builds the trees of some ten thousand keys at a
  time. It gives the merged list and the nodes of depth 3.
- Nodes of depth 2 are sums of these by a shuffle. The two uppermost levels are at most
  256 x 255 nodes, whatever the corpus; only these reach the driver.
- Bins then meet their nodes' shares of the levels above, and answer every block's list
  with the probabilities of its keys, in the order of the list.
- Blocks meet the answers: the one time that documents are shuffled.

Probabilities travel as whole multiples of 2^-33 in log10 (rounded, 6e-11 at most). No model
is broadcast.

The unigram base counts words as whole tokens with add-one smoothing.

Defined cases: null and empty texts are the end mark alone; without training
texts all counts are 0 and every bit costs one bit; repeated rows count each
time; a null id is scored like any other row. Other columns take no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import crc_mod, written
from tidemark.llm.words import SEGMENT, U, hash_words, mix, text_batches, text_bytes, word_spans

DEPTH = 6
BLOCK_BYTES = 16 * SEGMENT
#: Bytes of texts whose keys are held at once (or a single longer text).
PIECE_BYTES = 2 * SEGMENT
BINS = 1024
#: Keys whose trees are built at once, and keys gathered before they are merged.
TREE_KEYS = 50_000
MERGE_KEYS = 4_000_000
#: Keys looked up at once (they stay in a core's cache).
LOOKUP_KEYS = 1 << 16
END_HASH, END_WORD = 0, b"\n"
FILLING = b"\x20"

BLOCK, KEYS, WORDS = range(3)
ROWS = ("kind int, block long, bin int, keys binary, weights binary, "
        "doc_ids array<long>, held array<boolean>, tokens array<long>, words binary, ids binary")

_LN2 = np.log(2.0)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma for x >= 0.5 (Stirling's series after a shift by seven)."""
    rising = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6)
    y = x + 7
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(rising)


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - np.log(np.pi) - log_gamma(n0 + n1 + 1.0)


class Tree:
    """The nodes of all depths from ``depth`` up to ``top`` that the given keys touch.

    A node's code is its context (latest byte first) and the bits so far of the
    byte, led by a 1. ``up[d]`` maps nodes of depth d to their parents.
    """

    def __init__(self, keys: np.ndarray, weights: np.ndarray, top: int, depth: int = DEPTH) -> None:
        symbol, context = keys & 255, keys >> 8
        bits = np.arange(8)
        prefix = (256 | symbol[:, None]) >> (8 - bits)
        self.bit = symbol[:, None] >> (7 - bits) & 1
        code, self.leaf = np.unique((context[:, None] << 8 | prefix).ravel(), return_inverse=True)
        w = np.repeat(weights, 8).astype(np.float64)
        ones = np.bincount(self.leaf, w * self.bit.ravel(), len(code))
        zeros = np.bincount(self.leaf, w, len(code)) - ones
        self.top, self.depth = top, depth
        self.code, self.n0, self.n1, self.up, self.kt, self.mixed = {depth: code}, {depth: zeros}, {depth: ones}, {}, {}, {}
        self.kt[depth] = self.mixed[depth] = log_kt(zeros, ones)
        for d in range(depth, top, -1):
            parent, up = np.unique(self.code[d] >> 16 << 8 | self.code[d] & 255, return_inverse=True)
            self.code[d - 1], self.up[d] = parent, up
            self.n0[d - 1] = np.bincount(up, self.n0[d], len(parent))
            self.n1[d - 1] = np.bincount(up, self.n1[d], len(parent))
            self.kt[d - 1] = log_kt(self.n0[d - 1], self.n1[d - 1])
            self.mixed[d - 1] = np.logaddexp(self.kt[d - 1], np.bincount(up, self.mixed[d], len(parent))) - _LN2

    def log10_probability(self, fixed: np.ndarray, share: np.ndarray) -> np.ndarray:
        """log10 P(byte | context) of every key. For a node of depth ``top``, the
        levels above give ``fixed + share * (what this level predicts)``."""
        for d in range(self.top, self.depth + 1):
            if d > self.top:
                fixed, share = fixed[self.up[d]], share[self.up[d]]
            one = (self.n1[d] + 0.5) / (self.n0[d] + self.n1[d] + 1.0)
            weight = np.exp(self.kt[d] - _LN2 - self.mixed[d]) if d < self.depth else 1.0
            fixed, share = fixed + share * weight * one, share * (1.0 - weight)
        one = fixed[self.leaf].reshape(-1, 8)
        return np.log10(np.where(self.bit == 1, one, 1.0 - one)).sum(1)


# ------------------------------------------------------------ packed lists
def _planes(x: np.ndarray, width: int = 8) -> bytes:
    """The lower ``width`` bytes of 64-bit numbers, plane by plane, compressed."""
    return zstandard.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T[:width]).tobytes(), 3)


def _numbers(x: bytes, width: int = 8) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(x), np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.reshape(-1).view(np.uint64)


def pack_sorted(x: np.ndarray) -> bytes:
    return _planes(np.diff(x, prepend=x.dtype.type(0)))


def unpack_sorted(x: bytes) -> np.ndarray:
    return np.cumsum(_numbers(x).view(np.int64))


def pack_logs(p: np.ndarray) -> bytes:
    """Logarithms from -128 to 0, rounded to 2^-33."""
    return _planes(np.rint(p * -(2.0**33)).astype(np.uint64), 5)


def unpack_logs(x: bytes) -> np.ndarray:
    return _numbers(x, 5).astype(np.float64) * -(2.0**-33)


def key_bins(keys: np.ndarray) -> np.ndarray:
    """Bin of every key: by the last three bytes before. (Numbers of 16 bits are sorted by radix.)"""
    return (mix((keys >> 8 * (DEPTH - 2)).astype(U)) % U(BINS)).astype(np.uint16)


def hash_bins(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes.view(U)) % U(BINS)).astype(np.uint16)


def _firsts(x: np.ndarray) -> np.ndarray:
    """Where the runs of equal numbers begin."""
    new = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    return np.flatnonzero(new)


def _distinct(x: np.ndarray) -> np.ndarray:
    """The different numbers, sorted. A plain sort is several times faster than hashing or than sorting places."""
    x = np.sort(x)
    return x[_firsts(x)]


def _spans(bins: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bin, first, behind) of the runs of sorted bins."""
    first = _firsts(bins)
    yield from zip(bins[first].tolist(), first.tolist(), [*first[1:].tolist(), len(bins)], strict=True)


def lookup(keys: np.ndarray, values: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """A map from keys, all of them among the distinct ``keys``, to their values: a hash table of sorted buckets."""
    bits = (2 * len(keys)).bit_length()
    hashes = mix(keys.view(U))  # one to one, so that hashes stand for keys
    order = np.argsort(hashes)
    hashes, values = hashes[order], values[order]
    size = np.bincount((hashes >> U(64 - bits)).view(np.int64), minlength=1 << bits)
    start = (np.cumsum(size) - size).astype(np.int32 if len(keys) < 1 << 31 else np.int64)

    def find(asked: np.ndarray) -> np.ndarray:
        out = np.empty(len(asked))
        for lo in range(0, len(asked), LOOKUP_KEYS):
            h = mix(asked[lo : lo + LOOKUP_KEYS].view(U))
            at = start[(h >> U(64 - bits)).view(np.int64)]
            off = np.flatnonzero(hashes[at] != h)
            while len(off):
                at[off] += 1
                off = off[hashes[at[off]] != h[off]]
            out[lo : lo + LOOKUP_KEYS] = values[at]
        return out

    return find


# ------------------------------------------------------------------ blocks
def running_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(key of every byte of the texts, bytes of each text).

    A key is the ``DEPTH`` bytes of its text before it, latest first, then the byte itself.
    """
    pad = FILLING * DEPTH
    lengths = np.array([len(t) for t in texts], np.int64)
    stream = b"".join([pad + t for t in texts]) + bytes(8)
    # eight bytes from DEPTH before every place: a little-endian number with the latest byte first
    window = np.ndarray((len(stream) - 8,), "<u8", stream, strides=(1,))
    own = np.ones(len(window), bool)
    starts = np.cumsum(lengths + DEPTH) - lengths
    for back in range(1, DEPTH + 1):
        own[starts - back] = False
    seen = window[: len(window) - DEPTH].copy()[own[DEPTH:]]
    keys = (seen & U((1 << 8 * DEPTH) - 1)) << U(8)
    seen >>= U(8 * DEPTH)
    seen &= U(255)
    keys |= seen
    return keys.view(np.int64), lengths


def _filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches joined until they hold a block's bytes, so that short texts fill blocks too."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0
        if size >= BLOCK_BYTES:
            whole, held, size = pa.Table.from_batches(held).combine_chunks(), [], 0
            del batch
            yield from whole.to_batches()
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    types = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("bin", pa.int32()), ("keys", pa.binary()), ("weights", pa.binary()),
                       ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("tokens", pa.list_(pa.int64())),
                       ("words", pa.binary()), ("ids", pa.binary())])
    part = TaskContext.get().partitionId()

    def rows(n: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in types], schema=types)

    def lists(kind: int, block: int, bins: np.ndarray, keys: np.ndarray, weights: np.ndarray) -> pa.RecordBatch:
        spans = list(_spans(bins))
        return rows(len(spans), kind=[kind] * len(spans), block=[block] * len(spans), bin=[b for b, _, _ in spans],
                    keys=[pack_sorted(keys[a:z]) for _, a, z in spans], weights=[_planes(weights[a:z]) for _, a, z in spans])

    for number, batch in enumerate(text_batches(_filled(batches), "text", BLOCK_BYTES)):
        block, n = part << 24 | number, batch.num_rows
        held = np.array(batch.column("held").to_pylist(), bool)
        found, said, ids, tokens = _words(batch)
        # frequent words have small numbers; the end mark has the last one
        order = np.argsort(-np.bincount(ids, minlength=len(found)), kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        words = b"\n".join([said[i] for i in order.tolist()])
        train = np.concatenate([[int((~held).sum())], np.bincount(ids[np.repeat(~held, tokens)], minlength=len(found))])
        ids = np.insert(rank[ids], np.cumsum(tokens), len(order))
        del said, order, rank
        yield rows(1, kind=[BLOCK], block=[block], doc_ids=[batch.column("doc_id").to_pylist()], held=[held], tokens=[tokens + 1],
                   words=[zstandard.compress(words, 3)], ids=[_planes(ids, 4)])
        # hashes by bin, then by value
        hashes = np.concatenate([[END_HASH], found.view(np.int64)])
        by = np.lexsort((hashes, hash_bins(hashes)))
        yield lists(WORDS, block, hash_bins(hashes)[by], hashes[by], train[by])
        del found, hashes, train, by
        merged = []
        for at, texts in _pieces(words, ids, tokens + 1):
            keys, lengths = running_keys(texts)
            merged.append(_counted(keys << 1 | np.repeat(~held[at], lengths)))
        keys = _distinct(np.concatenate([own for own, _ in merged]))
        weight = np.zeros(len(keys), np.int64)
        for own, times in merged:
            weight[np.searchsorted(keys, own)] += times
        bins = key_bins(keys)
        by = np.argsort(bins, kind="stable")
        yield lists(KEYS, block, bins[by], keys[by], weight[by])


def _numbered(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(different numbers, which of them each is, a place of each)."""
    coded = pa.array(x).dictionary_encode()
    number, at = coded.indices.to_numpy(), np.empty(len(coded.dictionary), np.int64)
    at[number] = np.arange(len(number))
    return coded.dictionary.to_numpy(), number, at


def _words(batch: pa.RecordBatch) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """(hashes of the different words, these words, the number of every word said, words of each text)."""
    raw, hashes, spans, numbers, tokens, base = [], [], [], [], [], 0
    for some in text_batches(iter([batch]), "text", PIECE_BYTES):
        data, offsets = text_bytes(some.column("text"))
        start, end = word_spans(data, offsets)
        word, text = hash_words(data, offsets, (start, end))
        found, number, at = _numbered(word)
        raw.append(data.tobytes())
        hashes.append(found)
        spans.append((start[at] + base, end[at] + base))
        numbers.append(number)
        tokens.append(np.bincount(text, minlength=some.num_rows))
        base += len(data)
    found, number, at = _numbered(np.concatenate(hashes))
    start, end = (np.concatenate(x)[at] for x in zip(*spans, strict=True))
    data = b"".join(raw)
    ids = np.concatenate([own[n] for own, n in zip(np.split(number, np.cumsum([len(x) for x in hashes[:-1]])), numbers, strict=True)])
    return found, [data[a:z] for a, z in zip(start.tolist(), end.tolist(), strict=True)], ids, np.concatenate(tokens)


def _counted(coded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, sorted, and how often each counts, from keys whose lowest bit says whether they do."""
    coded.sort()
    first = _firsts(coded)
    times = np.where(coded[first] & 1, np.diff(first, append=len(coded)), 0)
    keys = coded[first] >> 1
    first = _firsts(keys)
    return keys[first], np.add.reduceat(times, first).astype(np.uint32 if len(coded) < 1 << 32 else np.int64)


def _pieces(words: bytes, ids: np.ndarray, tokens: np.ndarray) -> Iterator[tuple[slice, list[bytes]]]:
    """Texts given as numbers of the lines of ``words`` or, for the end mark, of the line behind, some at a time:
    (which, their bytes)."""
    said = (words + b"\n").replace(b"\n", b" ") + END_WORD if words else END_WORD
    offsets = np.flatnonzero(np.frombuffer(b"\n" + words + b"\n\n" if words else b"\n\n", np.uint8) == ord(b"\n"))
    sizes = np.diff(offsets)
    said = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(said)])
    ends = np.cumsum(tokens)
    begin = ends - tokens
    bytes_to = np.cumsum(np.add.reduceat(sizes[ids], begin)) if len(ids) else ends
    at = 0
    while at < len(tokens):
        base = int(bytes_to[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(bytes_to, base + PIECE_BYTES, side="right")))
        raw = said.take(pa.array(ids[begin[at] : ends[end - 1]])).buffers()[2].to_pybytes()
        cuts = [0, *(bytes_to[at:end] - base).tolist()]
        yield slice(at, end), [raw[a:z] for a, z in zip(cuts[:-1], cuts[1:], strict=True)]
        at = end


# -------------------------------------------------------------------- bins
def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, dict]]:
    """(bin, kind, columns as lists) of the runs of sorted rows; None for bin and kind at the end."""
    for batch in batches:
        if not batch.num_rows:
            continue
        bins, kinds = batch.column("bin").to_numpy(), batch.column("kind").to_numpy()
        cuts = [0, *(np.flatnonzero((bins[1:] != bins[:-1]) | (kinds[1:] != kinds[:-1])) + 1).tolist(), len(bins)]
        for a, z in zip(cuts[:-1], cuts[1:], strict=True):
            some = batch.slice(a, z - a)
            yield int(bins[a]), int(kinds[a]), {c: some.column(c) for c in some.schema.names}
    yield None, None, {}


class _Merged:
    """Keys and weights, added up; memory follows the distinct keys."""

    def __init__(self) -> None:
        self.parts, self.held = [], 0

    def add(self, keys: np.ndarray, weights: np.ndarray) -> None:
        self.parts.append((keys, weights))
        self.held += len(keys)
        if self.held > MERGE_KEYS and len(self.parts) > 1:
            self.parts = [self.sums()]
            self.held = len(self.parts[0][0]) // 2  # gather as much again

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        keys, weights = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.argsort(keys)
        keys = keys[order]
        first = _firsts(keys)
        return keys[first], np.add.reduceat(weights[order], first)


def _merging(emit: Callable[[int, np.ndarray, np.ndarray], Iterator[pa.RecordBatch]]) -> Callable:
    """A map over lists sorted by bin: ``emit`` gets each bin's distinct keys and their weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, merged = None, _Merged()
        for b, _, columns in _runs(batches):
            if b != last and last is not None:
                yield from emit(last, *merged.sums())
                merged = _Merged()
            last = b
            if b is not None:
                for keys, weights in zip(columns["keys"].to_pylist(), columns["weights"].to_pylist(), strict=True):
                    merged.add(unpack_sorted(keys), _numbers(weights).view(np.int64))

    return run


def _chunks(keys: np.ndarray) -> Iterator[slice]:
    """Sorted keys in runs of about TREE_KEYS that share no four bytes before."""
    cuts = np.concatenate([np.unique(keys >> 8 * (DEPTH - 3), return_index=True)[1], [len(keys)]])
    at = 0
    while at < len(keys):
        end = int(cuts[max(np.searchsorted(cuts, at + TREE_KEYS, side="right") - 1, np.searchsorted(cuts, at, side="right"))])
        yield slice(at, end)
        at = end


def _parents(code: np.ndarray) -> np.ndarray:
    return code >> 16 << 8 | code & 255


_TREES = "kind int, bin int, keys binary, weights binary, code long, n0 double, n1 double, mixed double"


def _trees(b: int, keys: np.ndarray, weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A bin's merged list, and counts and mixed evidence of its nodes of depth 3."""
    parts = [[], [], [], []]
    for at in _chunks(keys):
        tree = Tree(keys[at], weights[at], 4)
        for x, y in zip(parts, (_parents(tree.code[4]), tree.n0[4], tree.n1[4], tree.mixed[4]), strict=True):
            x.append(y)
    below, n0, n1, mixed = map(np.concatenate, parts)
    code, at = np.unique(below, return_inverse=True)
    n0, n1, mixed = (np.bincount(at, x, len(code)) for x in (n0, n1, mixed))
    mixed = np.logaddexp(log_kt(n0, n1), mixed) - _LN2
    names = [x.split()[0] for x in _TREES.split(", ")]
    yield pa.RecordBatch.from_arrays(
        [pa.array([0], pa.int32()), pa.array([b], pa.int32()), pa.array([pack_sorted(keys)], pa.binary()), pa.array([_planes(weights)], pa.binary()),
         pa.nulls(1, pa.int64()), *[pa.nulls(1, pa.float64())] * 3], names=names)
    for lo in range(0, len(code), 10_000):
        n = len(code[lo : lo + 10_000])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, 1, np.int32)), pa.array(np.full(n, b, np.int32)), *[pa.nulls(n, pa.binary())] * 2,
             *[pa.array(x[lo : lo + 10_000]) for x in (code, n0, n1, mixed)]], names=names)


def _second_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Evidence and mixed evidence of nodes of depth 2 from the sums below them."""
    for batch in batches:
        n0, n1, below = (batch.column(c).to_numpy() for c in ("n0", "n1", "below"))
        kt = log_kt(n0, n1)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("code", "n0", "n1")), pa.array(kt), pa.array(np.logaddexp(kt, below) - _LN2)],
                                         names=["code", "n0", "n1", "kt", "mixed"])


def _upper_levels(nodes: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """What the two uppermost levels contribute: fixed and share by (last byte, prefix); 65,536 numbers each."""
    sums = nodes.groupBy(F.shiftright("code", 16).alias("before"), F.col("code").bitwiseAND(F.lit(255)).alias("prefix")).agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("mixed").alias("mixed")).toArrow()
    n0, n1, below = (np.zeros((256, 256)) for _ in range(3))
    at = sums.column("before").to_numpy(), sums.column("prefix").to_numpy()
    n0[at], n1[at], below[at] = (sums.column(c).to_numpy() for c in ("n0", "n1", "mixed"))
    kt1 = log_kt(n0, n1)
    mixed1 = np.logaddexp(kt1, below) - _LN2
    r0, r1 = n0.sum(0), n1.sum(0)
    kt0 = log_kt(r0, r1)
    mixed0 = np.logaddexp(kt0, mixed1.sum(0)) - _LN2
    w0, w1 = np.exp(kt0 - _LN2 - mixed0), np.exp(kt1 - _LN2 - mixed1)
    fixed = w0 * (r1 + 0.5) / (r0 + r1 + 1.0) + (1 - w0) * w1 * (n1 + 0.5) / (n0 + n1 + 1.0)
    return fixed, (1 - w0) * (1 - w1)


def _passed_down(fixed: np.ndarray, share: np.ndarray, n0: np.ndarray, n1: np.ndarray, kt: np.ndarray, mixed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What a level's nodes add to what comes from above, for the level below."""
    own = np.exp(kt - _LN2 - mixed)
    return fixed + share * own * (n1 + 0.5) / (n0 + n1 + 1.0), share * (1 - own)


def _second_shares(fixed: np.ndarray, share: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = batch.column("code").to_numpy()
            f, s = fixed[code >> 16, code & 255], share[code >> 16, code & 255]
            f, s = _passed_down(f, s, *(batch.column(c).to_numpy() for c in ("n0", "n1", "kt", "mixed")))
            yield pa.RecordBatch.from_arrays([batch.column("code"), pa.array(f), pa.array(s)], names=["up", "f", "s"])

    return run


def _answers(value: Callable[[np.ndarray, np.ndarray, dict], np.ndarray], pack: Callable[[np.ndarray], bytes], what: int) -> Callable:
    """A map over rows sorted by bin and kind (0: the merged list, 1: nodes, 2: lists of blocks): ``value`` gives
    a number for each merged key, and every block's list is answered by the numbers of its keys."""
    names = ["of_block", "what", "of_bin", "data"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, nodes, keys, numbers = None, {}, None, None
        for b, kind, columns in _runs(batches):
            if b is None:
                return
            if b != last:
                last, nodes, keys, numbers = b, {}, None, None
            if kind == 0:
                keys, weights = unpack_sorted(columns["keys"][0].as_py()), _numbers(columns["weights"][0].as_py()).view(np.int64)
            elif kind == 1:
                for c in ("code", "n0", "n1", "mixed", "f", "s"):
                    nodes.setdefault(c, []).append(columns[c].to_numpy())
            else:
                if numbers is None:
                    numbers = value(keys, weights, {c: np.concatenate(x) for c, x in nodes.items()})
                data = [pack(numbers[np.searchsorted(keys, unpack_sorted(x))]) for x in columns["keys"].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [columns["block"], pa.array(np.full(len(data), what, np.int32)), pa.array(np.full(len(data), b, np.int32)), pa.array(data, pa.binary())], names=names)

    return run


def _probabilities(keys: np.ndarray, weights: np.ndarray, nodes: dict) -> np.ndarray:
    """log10 P of every key of a bin."""
    order = np.argsort(nodes["code"])
    code, n0, n1, mixed, f, s = (nodes[c][order] for c in ("code", "n0", "n1", "mixed", "f", "s"))
    f, s = _passed_down(f, s, n0, n1, log_kt(n0, n1), mixed)
    p = np.empty(len(keys))
    for at in _chunks(keys):
        tree = Tree(keys[at], weights[at], 4)
        up = np.searchsorted(code, _parents(tree.code[4]))
        p[at] = tree.log10_probability(f[up], s[up])
    return p


# --------------------------------------------------------------- documents
def _document_scores(n_train: int, v: int) -> Callable:
    def score(key, rows: pa.Table, found: pa.Table) -> pa.Table:
        """Every document of a block, from the answers to the block's lists."""
        block = {c: rows.column(c)[0].as_py() for c in rows.column_names}
        got = {k: [x for _, x in sorted((b, x) for w, b, x in zip(*(found.column(c).to_pylist() for c in ("what", "of_bin", "data")), strict=True) if w == k)]
               for k in (KEYS, WORDS)}
        tokens = np.array(block["tokens"], np.int64)
        ids = _numbers(block["ids"], 4).view(np.int64)
        words = zstandard.decompress(block["words"])
        # counts came in the order of the words' hashes within their bins, the end mark's among them
        hashes = np.concatenate([_word_hashes(words), [END_HASH]])
        c = np.empty(len(hashes), np.int64)
        c[np.lexsort((hashes, hash_bins(hashes)))] = np.concatenate([_numbers(x).view(np.int64) for x in got[WORDS]])
        keys = _distinct(np.concatenate([_distinct(running_keys(texts)[0]) for _, texts in _pieces(words, ids, tokens)]))
        p = np.empty(len(keys))
        p[np.argsort(key_bins(keys), kind="stable")] = np.concatenate([unpack_logs(x) for x in got[KEYS]])
        find, scores, lengths = lookup(keys, p), np.empty(len(tokens)), np.empty(len(tokens), np.int64)
        for at, texts in _pieces(words, ids, tokens):
            keys, lengths[at] = running_keys(texts)
            scores[at] = np.add.reduceat(find(keys), np.cumsum(lengths[at]) - lengths[at])
        begin = np.cumsum(tokens) - tokens
        base = np.add.reduceat(np.log10((c + 1.0) / (n_train + 1.0 * (v + 1)))[ids], begin)
        known = np.add.reduceat((c > 0).astype(np.int64)[ids], begin)
        return pa.table({
            "doc_id": pa.array(block["doc_ids"], pa.int64()), "held_out": pa.array(block["held"], pa.bool_()), "n_tokens": pa.array(tokens),
            "n_known": pa.array(known), "train_tokens": pa.array([n_train] * len(tokens), pa.int64()), "base_score": pa.array(base),
            "score": pa.array(scores), "bits_per_byte": pa.array(-scores / np.log10(2.0) / lengths)})

    return score


def _word_hashes(words: bytes) -> np.ndarray:
    column = pa.array([words], pa.large_binary()).cast(pa.large_string(), safe=False)
    return hash_words(*text_bytes(column))[0].view(np.int64)


def held_out(doc_id: Column) -> Column:
    """Ids whose crc32 leaves 2 when divided by 7; these are never learned from."""
    return crc_mod(doc_id, 7) == 2


def score_texts(docs: DataFrame, held: Column | None = None) -> DataFrame:
    """Model and base scores of every document, learned from those for which ``held`` is false."""
    held = held_out(F.col("doc_id")) if held is None else held
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(held, F.lit(False)).alias("held"))
    rows = written(rows.mapInArrow(_scan, ROWS), "lm-blocks", compression="zstd")
    lists = {kind: rows.filter(F.col("kind") == kind).select("bin", F.lit(2).alias("kind"), "block", "keys", "weights") for kind in (KEYS, WORDS)}

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition("bin").sortWithinPartitions("bin", "kind")

    def merged_words(b: int, keys: np.ndarray, weights: np.ndarray) -> Iterator[pa.RecordBatch]:
        arrays = [[0], [b], [pack_sorted(keys)], [_planes(weights)], [int(weights.sum())], [int((weights > 0).sum())]]
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(arrays, kinds, strict=True)], names=["kind", "bin", "keys", "weights", "n", "v"])

    def no_nodes(df: DataFrame) -> DataFrame:
        return df.select("kind", "bin", "keys", "weights")

    words = dealt(lists[WORDS]).mapInArrow(_merging(merged_words), "kind int, bin int, keys binary, weights binary, n long, v long")
    words = written(words, "lm-words", compression="zstd")
    total = words.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    asked = no_nodes(words).unionByName(lists[WORDS].drop("weights"), allowMissingColumns=True)
    schema = "of_block long, what int, of_bin int, data binary"
    counted = dealt(asked).mapInArrow(_answers(lambda keys, weights, nodes: weights, _planes, WORDS), schema)

    trees = written(dealt(lists[KEYS]).mapInArrow(_merging(_trees), _TREES), "lm-trees", compression="zstd")
    nodes = trees.filter("kind = 1").select("kind", "bin", "code", "n0", "n1", "mixed")
    up = F.shiftleft(F.shiftright("code", 16), 8) + F.col("code").bitwiseAND(F.lit(255))
    second = nodes.groupBy(up.alias("code")).agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("mixed").alias("below"))
    second = written(second.mapInArrow(_second_level, "code long, n0 double, n1 double, kt double, mixed double"), "lm-second")
    shares = second.mapInArrow(_second_shares(*_upper_levels(second)), "up long, f double, s double")
    nodes = nodes.withColumn("up", up).join(shares, "up").drop("up")
    asked = no_nodes(trees.filter("kind = 0")).unionByName(nodes, allowMissingColumns=True).unionByName(lists[KEYS].drop("weights"), allowMissingColumns=True)
    scored = dealt(asked).mapInArrow(_answers(_probabilities, pack_logs, KEYS), schema)

    blocks = rows.filter(F.col("kind") == BLOCK).select("block", "doc_ids", "held", "tokens", "words", "ids")
    return blocks.groupBy("block").cogroup(scored.unionByName(counted).groupBy("of_block")).applyInArrow(
        _document_scores(int(total["n"] or 0), int(total["v"] or 0)),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double")
