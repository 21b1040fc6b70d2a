"""Approximate nearest neighbours in a hash-prefix forest.

Each of ``TREES`` trees gives every vector a string of ``BITS`` bits: the sides of
random hyperplanes it lies on. A tree is the array of these strings, sorted. A
query descends to its longest prefix match in every tree; all trees then go up
together, one bit at a time, until the distinct rows expected under the prefixes
reach the number wanted. Those rows are scored, each once however many trees lead to
it. (With ``c`` of ``n`` rows under each tree's prefix, ``n (1 - prod(1 - c / n))`` are
expected to differ.)

The rows are dealt to shards of about ``SHARD_ROWS`` by a hash of the id, and every shard
holds a forest of its own rows: a row is hashed and shuffled once, not once a tree, and
no group of rows has to fit a task but a shard. Queries are hashed once and go, with
their strings, to every shard; a task meets them in batches.

How many rows are wanted is a share of each shard's rows, the least of ``SHARES`` for which a
forest of a bounded sample finds ``RECALL`` of the true neighbours: ``SAMPLE_ROWS`` rows and
``SAMPLE_QUERIES`` of them as queries, those of lowest id hash, on the driver. Of a sample
the k nearest are farther away than of all rows, so the share is rather too large than too
small. On vectors without structure it stays near a third whatever the number of rows;
clustered ones need far less. Shards smaller than what is wanted are searched whole.

Other defined cases are in ``vectors``; zero vectors take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import vectors as V

K = 20
TREES = 96
BITS = 16
SHARD_ROWS = 8192
SAMPLE_ROWS, SAMPLE_QUERIES = 8192, 100
RECALL = 0.95
SHARES = (0.01, 0.02, 0.04, 0.07, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.6, 0.7, 0.8, 1.0)
SEED = 11


def hyperplanes(dim: int, trees: int = TREES, bits: int = BITS) -> np.ndarray:
    """Normals of ``trees * bits`` random hyperplanes, a column each; runs of ``dim`` are orthogonal."""
    normals = np.random.default_rng(SEED).normal(size=(dim, trees * bits))
    for at in range(0, trees * bits - dim + 1, dim):
        normals[:, at : at + dim] = np.linalg.qr(normals[:, at : at + dim])[0]
    return normals


def strings(v: np.ndarray, normals: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hash strings as numbers of ``bits`` bits, a column per tree."""
    out = np.empty((len(v), normals.shape[1] // bits), np.uint16)
    place = (1 << np.arange(bits - 1, -1, -1)).astype(np.uint16)
    for at in range(0, len(v), 2048):
        side = (v[at : at + 2048] @ normals > 0).reshape(-1, out.shape[1], bits)
        out[at : at + 2048] = (side * place).sum(2, dtype=np.uint16)
    return out


class Forest:
    """Sorted arrays of one shard's strings."""

    def __init__(self, of: np.ndarray, bits: int = BITS):
        self.n, self.bits = len(of), bits
        self.rows = np.argsort(of, axis=0, kind="stable").T.astype(np.int32)
        # where the strings from every number on begin in each array
        self.begin = np.zeros((of.shape[1], (1 << bits) + 1), np.int32)
        for t in range(of.shape[1]):
            np.cumsum(np.bincount(of[:, t], minlength=1 << bits), out=self.begin[t, 1:])

    def runs(self, of: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """The run of each array that shares the first bits of each string."""
        trees, rest = np.arange(of.shape[1]), self.bits - bits
        prefix = of.astype(np.int64) >> rest
        return self.begin[trees, prefix << rest], self.begin[trees, (prefix + 1) << rest]

    def candidates(self, of: np.ndarray, wanted: int) -> Iterator[np.ndarray]:
        """Distinct rows under the longest prefixes that together have about ``wanted`` of them."""
        first, last = self.runs(of, 0)
        down = np.arange(len(of))
        # a query stays at the deepest level that still has enough rows
        for bits in range(1, self.bits + 1):
            a, b = self.runs(of[down], bits)
            enough = self.n * (1 - np.prod(1 - (b - a) / self.n, axis=1)) >= wanted
            down = down[enough]
            if not len(down):
                break
            first[down], last[down] = a[enough], b[enough]
        for lo, hi in zip(first.tolist(), last.tolist(), strict=True):
            if hi[0] - lo[0] == self.n:
                yield np.arange(self.n)
                continue
            seen = np.zeros(self.n, bool)
            seen[np.concatenate([tree[a:b] for tree, a, b in zip(self.rows, lo, hi, strict=True)])] = True
            yield np.flatnonzero(seen)


def wanted_rows(n: int, share: float, k: int) -> int:
    """Rows to see of ``n``; never fewer than the k asked for and the query itself."""
    return max(k + 1, int(np.ceil(share * n)))


def share_for_recall(sample: np.ndarray, normals: np.ndarray, k: int = K, recall: float = RECALL, asked: int = SAMPLE_QUERIES) -> float:
    """The least of ``SHARES`` at which a forest of the sample finds ``recall`` of the k nearest of its first rows."""
    if len(sample) <= k + 1:
        return 1.0
    of = strings(sample, normals)
    forest, q = Forest(of), sample[:asked]
    scores = q @ sample.T
    np.fill_diagonal(scores, -np.inf)
    true = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    for share in SHARES:
        found = forest.candidates(of[: len(q)], wanted_rows(len(sample), share, k))
        if np.mean([np.isin(t, rows).mean() for t, rows in zip(true, found, strict=True)]) >= recall:
            return share
    return 1.0


def doubles(v: Column) -> Column:
    return F.transform(v, lambda x: x.cast("double"))


def nearest(table: DataFrame, is_query: Column, k: int = K, share: float | None = None, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found, by inner product, of rows where ``is_query`` holds.

    ``share``: of the rows to see; None measures it.
    """
    usable = F.exists("v", lambda x: x != 0)
    rows = V.stored(V.clean(table, doubles(F.col("embedding")), usable).distinct(), "doubles")
    held = V.stored(V.folded(rows, k), "folded")
    queries = rows.filter(is_query)
    named = V.stored(V.query_vectors(queries), "asked")
    sizes = held.agg(F.count("*"), F.max(F.size("v"))).first()
    normals = hyperplanes(int(sizes[1] or 1))
    if share is None:
        share = share_for_recall(V.sample_rows(held, SAMPLE_ROWS), normals, k)
    shards = max(1, -(-int(sizes[0]) // shard_rows))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = strings(V.matrix(batch.column("v")), normals)
                yield pa.RecordBatch.from_arrays([batch.column("qid"), batch.column("v"), pa.array([x.tobytes() for x in own], pa.binary())], names=["qid", "v", "strings"])

    known: dict[str, object] = {}

    def search(ids: np.ndarray, places: np.ndarray, v: np.ndarray, asked: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if known.get("ids") is not ids:  # the next shard
            known.update(ids=ids, forest=Forest(strings(v, normals)))
        q, qid = V.matrix(asked.column("v")), asked.column("qid").to_numpy()
        of = np.frombuffer(b"".join(asked.column("strings").to_pylist()), np.uint16).reshape(len(q), -1)
        out_q, out_x, out_s = [], [], []
        for i, seen in enumerate(known["forest"].candidates(of, wanted_rows(len(ids), share, k))):
            s, x = np.einsum("nd,d->n", v[seen], q[i]), ids[seen]
            if len(s) > k + 1:
                # all that tie with the (k + 1)-th stay in the choice
                some = np.flatnonzero(s >= np.partition(s, len(s) - k - 1)[len(s) - k - 1])
                some = some[np.lexsort((x[some], -s[some]))[: k + 1]]
                s, x = s[some], x[some]
            out_q.append(np.full(len(s), qid[i]))
            out_x.append(x)
            out_s.append(s)
        if out_q:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (out_q, out_x, out_s)], names=["qid", "vec_id", "score"])

    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("string").alias("block")
    array = held.select(shard, F.lit(0).cast("long").alias("place"), "vec_id", "v")
    asked = named.select("qid", "v").mapInArrow(hashed, "qid long, v array<double>, strings binary")
    asked = asked.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda x: x.cast("string"))).alias("block"), "qid", "v", "strings")
    found = V.meet(array, asked, search, "qid long, vec_id long, score double")
    return V.answers(found, queries, named, k)
