"""Exact top-k by inner product over a pivot-distance index.

Each vector is extended by one coordinate so that all have the norm of the
longest; then the largest inner product is the smallest distance
(``2 <q, v> = |q|^2 + M^2 - d^2``). A vector's key is its nearest pivot and its
distance to it. A pivot's vectors are ordered by distance and cut into annuli.
The triangle inequality bounds every distance from a query into an annulus, and
so the best score possible there.

A query first searches the annulus it would lie in itself; its k-th score so far
is a threshold. Then it is sent to those annuli whose bound reaches the
threshold, nearest first within a task, and passes over every piece whose bound
is below its k-th score. Bounds are widened by a hair against
rounding; scores are exact integers.

Pivots and the cut points come from a bounded sample (``SAMPLE`` rows) and the
number of annuli is at most ``MOST_ANNULI``, so what tasks get sent is bounded; an
annulus with many vectors is split into blocks of about ``BLOCK_ROWS``, each
visited by the annulus's queries. All rows are indexed.

Scores must fit a signed 64-bit integer. Other defined cases are in ``vectors``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import vectors as V

K = 20
SAMPLE = 4096
PIVOTS = 16
MOST_ANNULI = 1024
BLOCK_ROWS = 4096
CHUNK = 512


def whole_numbers(v: Column) -> Column:
    """floor(64 x) of every component, as long."""
    return F.transform(v, lambda x: F.floor(x.cast("double") * 64).cast("long"))


def spread(sample: np.ndarray, n: int) -> np.ndarray:
    """Up to n distinct sample rows, each the farthest from those before."""
    chosen = [0]
    far = ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < n and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def _distances(v: np.ndarray, norms: np.ndarray, extra: np.ndarray, pivots: np.ndarray, pivot_extra: np.ndarray) -> np.ndarray:
    squared = norms[:, None] + extra[:, None] ** 2 - 2 * (v @ pivots.T + extra[:, None] * pivot_extra) + (pivots**2).sum(1) + pivot_extra**2
    return np.sqrt(np.maximum(squared, 0))


def _exact(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Integer inner products, by floats where these are exact."""
    if np.abs(v).max(initial=0).astype(float) * np.abs(q).max(initial=0) * v.shape[1] < 2.0**53:
        return (q.astype(np.float64) @ v.T.astype(np.float64)).astype(np.int64)
    return q @ v.T


def top_k(table: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): for rows where ``is_query`` (of vec_id) holds, the k best other rows."""
    rows = V.stored(V.clean(table, whole_numbers(F.col("embedding"))).distinct(), "whole")
    candidates = V.stored(V.folded(rows, k), "folded")
    queries = rows.filter(is_query)
    named = V.stored(V.query_vectors(queries), "asked")
    square = F.aggregate("v", F.lit(0).cast("double"), lambda a, x: a + x.cast("double") * x)
    size = candidates.agg(F.count(F.lit(1)), F.max(square)).first()
    sample = V.sample_rows(candidates, SAMPLE).astype(np.float64)
    if not len(sample):
        sample = np.zeros((1, 1))
    longest = float(size[1] or 0.0)

    def extend(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        norms = (v**2).sum(1)
        return norms, np.sqrt(np.maximum(longest - norms, 0))

    annuli = int(max(1, min(MOST_ANNULI, (size[0] or 0) // BLOCK_ROWS)))
    pivots = spread(sample, max(1, min(PIVOTS, int(round(annuli**0.5)))))
    _, pivot_extra = extend(pivots)
    to_pivots = _distances(sample, *extend(sample), pivots, pivot_extra)
    cell = to_pivots.argmin(1)
    cuts = []
    for p in range(len(pivots)):
        d = np.sort(to_pivots[cell == p, p])
        n = max(1, round(annuli * len(d) / len(sample)))
        cuts.append(d[(np.arange(1, n) * len(d)) // n] if len(d) else d)
    first = np.concatenate([[0], np.cumsum([len(c) + 1 for c in cuts])])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = V.matrix(batch.column("v")).astype(np.float64)
            d = _distances(v, *extend(v), pivots, pivot_extra)
            at = d.argmin(1)
            own = d[np.arange(len(at)), at]
            ring = np.array([first[p] + np.searchsorted(cuts[p], x, side="right") for p, x in zip(at, own, strict=True)], np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.array(at, pa.int32()), pa.array(own), pa.array(ring)], names=["vec_id", "v", "cell", "place", "ring"])

    indexed = candidates.mapInArrow(index, "vec_id long, v array<long>, cell int, place double, ring int")
    indexed = V.stored(indexed, "index")
    # one row per annulus, MOST_ANNULI + PIVOTS at most
    rings = indexed.groupBy("ring", "cell").agg(F.min("place").alias("lo"), F.max("place").alias("hi"), F.count(F.lit(1)).alias("n")).orderBy("ring").toPandas()
    blocks_of = dict(zip(rings["ring"], np.ceil(rings["n"] / BLOCK_ROWS).astype(int), strict=True))
    blocks = F.lit(1)
    many = [(int(r), int(b)) for r, b in blocks_of.items() if b > 1]
    if many:
        table_of = F.create_map(*[F.lit(x) for pair in many for x in pair])
        blocks = F.coalesce(table_of[F.col("ring")], F.lit(1))
    block = F.concat_ws("-", F.col("ring").cast("string"), F.pmod(F.xxhash64("vec_id"), blocks).cast("string"))
    held = indexed.select(block.alias("block"), "place", "vec_id", "v")
    slack = 1e-6 * (1.0 + longest)

    def bounds(v: np.ndarray, rings: pd.DataFrame) -> np.ndarray:
        """The largest score a query can have in each annulus."""
        norms = (v**2).sum(1)
        d = _distances(v, norms, np.zeros(len(v)), pivots, pivot_extra)[:, rings["cell"]]
        near = np.maximum(0, np.maximum(rings["lo"].to_numpy() - d, d - rings["hi"].to_numpy()))
        return (norms[:, None] + longest - near**2) / 2 + slack

    def routes(first_round: bool):
        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows or not len(rings):
                    continue
                best = bounds(V.matrix(batch.column("v")).astype(np.float64), rings)
                home = best.argmax(1)
                if first_round:
                    q, r = np.arange(len(home)), home
                else:
                    need = best >= batch.column("least").to_numpy()[:, None]
                    need[np.arange(len(home)), home] = False
                    q, r = np.nonzero(need)
                names = [f"{x}-{b}" for x in rings["ring"].iloc[r] for b in range(blocks_of[x])]
                q = np.repeat(q, [blocks_of[x] for x in rings["ring"].iloc[r]])
                for lo in range(0, len(q), 4096):
                    rows = batch.take(pa.array(q[lo : lo + 4096]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names[lo : lo + 4096], pa.string()), rows.column("qid"), rows.column("v"), rows.column("least")], names=["block", "qid", "v", "least"])

        return send

    def search(ids: np.ndarray, places: np.ndarray, v: np.ndarray, asked: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        q, qid = V.matrix(asked.column("v")), asked.column("qid").to_numpy()
        least = asked.column("least").to_numpy().copy()
        pieces = [(lo, min(lo + CHUNK, len(ids))) for lo in range(0, len(ids), CHUNK)]
        where = int(_distances(v[:1].astype(np.float64), *extend(v[:1].astype(np.float64)), pivots, pivot_extra).argmin())
        spans = pd.DataFrame({"cell": where, "lo": [places[a] for a, _ in pieces], "hi": [places[b - 1] for _, b in pieces]})
        best = bounds(q.astype(np.float64), spans)
        kept = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in qid]
        for piece in np.argsort(-best.max(0), kind="stable"):
            go = np.flatnonzero(best[:, piece] >= least)
            if not len(go):
                continue  # a later piece's bound can be higher for another query
            a, b = pieces[piece]
            scores = _exact(v[a:b], q[go])
            for row, i in zip(scores, go, strict=True):
                some = np.flatnonzero(row >= least[i])
                s, x = np.concatenate([kept[i][0], row[some]]), np.concatenate([kept[i][1], ids[a:b][some]])
                if len(s) > k + 1:
                    order = np.lexsort((x, -s))[: k + 1]
                    s, x = s[order], x[order]
                    least[i] = max(least[i], s[-1])
                kept[i] = (s, x)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(qid, [len(s) for s, _ in kept])), pa.array(np.concatenate([x for _, x in kept])),
             pa.array(np.concatenate([s for s, _ in kept]))], names=["qid", "vec_id", "score"])

    schema = "qid long, vec_id long, score long"
    sent = "block string, qid long, v array<long>, least double"
    start = named.select("qid", "v", F.lit(float("-inf")).alias("least"))
    near = V.stored(V.meet(held, start.mapInArrow(routes(True), sent), search, schema), "near")
    # the (k + 1)-th score so far of queries that have so many
    kth = near.groupBy("qid").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s")).select(
        "qid", F.when(F.size("s") >= k + 1, F.element_at("s", k + 1).cast("double")).alias("kth"))
    again = named.join(kth, "qid", "left").select("qid", "v", F.coalesce("kth", F.lit(float("-inf"))).alias("least"))
    far = V.meet(held, again.mapInArrow(routes(False), sent), search, schema)
    return V.answers(near.unionByName(far), queries, named, k)
