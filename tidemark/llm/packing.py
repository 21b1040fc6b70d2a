"""Conflict-constrained best-fit packing of documents into sequences.

Documents go to shards of about ``shard_rows`` by a hash of a row number of
the written table, so no key, however common, fills a shard. In a shard pieces
are placed by falling size. Open bins stand ordered by what they have left; the
search starts at the first bin with room and goes on to its successors until a
compatible one is found: the tightest that fits. A bin carries a bitmap of
its duplicate clusters and ``per_source`` bitmaps of its sources (the j-th has
the sources of which it holds at least j documents). A document joins a bin
only if its cluster is not in it and its source is in the last bitmap not yet.

A document longer than ``capacity`` is cut into whole bins and a last piece;
nothing is dropped, no number of bins is set.

Defined cases: null text and documents without words have a size of 1 (their
end mark) like any text's last token; null sources are one source, null
clusters conflict with nothing; repeated rows are documents of their own.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import n_words, written

CAPACITY = 2048
PER_SOURCE = 2
SHARD_ROWS = 8192

PACKED = "doc_id long, source string, size long, piece int, piece_size long, shard int, bin int, position int, start long"


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int, per_source: int) -> list[tuple[int, int, int, int]]:
    """(document, piece, bin, piece size) of every piece, in the order of placing."""
    repeated = {c for c, n in Counter(c for c in clusters if c is not None).items() if n > 1}
    cluster_bit = {c: 1 << i for i, c in enumerate(sorted(repeated))}
    source_bit = {s: 1 << i for i, s in enumerate(sorted(set(sources), key=lambda s: (s is None, s or "")))}
    pieces = []
    for d, size in enumerate(sizes):
        for p in range(0, max(size, 1), capacity):
            pieces.append((min(capacity, size - p), d, p // capacity))
    pieces.sort(key=lambda x: (-x[0], x[1], x[2]))
    open_bins: list[tuple[int, int]] = []  # (left, bin), ordered
    held: list[tuple[int, list[int]]] = []  # per bin: cluster bitmap, source bitmaps
    out = []
    for size, d, p in pieces:
        c, s = cluster_bit.get(clusters[d], 0), source_bit[sources[d]]
        at = bisect_left(open_bins, (size, -1))
        while at < len(open_bins):
            in_clusters, in_sources = held[open_bins[at][1]]
            if not in_clusters & c and not in_sources[-1] & s:
                break
            at += 1
        if at < len(open_bins):
            left, b = open_bins.pop(at)
        else:
            left, b = capacity, len(held)
            held.append((0, [0] * per_source))
        in_clusters, in_sources = held[b]
        level = next(j for j in range(per_source) if not in_sources[j] & s)
        in_sources[level] |= s
        held[b] = (in_clusters | c, in_sources)
        if left > size:
            insort(open_bins, (left - size, b))
        out.append((d, p, b, size))
    return out


def _pack(capacity: int, per_source: int):
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["__size", "__row"], ascending=[False, True], kind="stable")
        none = lambda x: None if pd.isna(x) else x
        sources, clusters = [none(x) for x in pdf["__source"]], [none(x) for x in pdf["__cluster"]]
        placed = best_fit(pdf["__size"].tolist(), sources, clusters, capacity, per_source)
        count, fill, rows = Counter(), Counter(), []
        for d, p, b, size in placed:
            rows.append((d, p, size, b, count[b], fill[b]))
            count[b] += 1
            fill[b] += size
        out = pd.DataFrame(rows, columns=["d", "piece", "piece_size", "bin", "position", "start"])
        of = pdf.iloc[out["d"]].reset_index(drop=True)
        return pd.DataFrame({
            "doc_id": of["__doc_id"], "source": of["__source"], "size": of["__size"], "piece": out["piece"],
            "piece_size": out["piece_size"], "shard": of["__shard"], "bin": out["bin"], "position": out["position"], "start": out["start"]})

    return pack


def token_size(text: Column) -> Column:
    """Default size: words and an end mark."""
    return n_words(text) + 1


def copy_cluster(text: Column) -> Column:
    """Default cluster: texts with equal words, letter case and white space aside; none without words."""
    plain = F.trim(F.regexp_replace(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), r"[\x20\x09-\x0D]+", " "))
    return F.when(F.length(plain) > 0, F.xxhash64(plain))


def pack_documents(
    docs: DataFrame,
    size: Column | None = None,
    cluster: Column | None = None,
    capacity: int = CAPACITY,
    per_source: int = PER_SOURCE,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """One row per piece: its bin (``shard``, ``bin``), place in it and size."""
    if capacity < 1 or per_source < 1:
        raise ValueError("capacity and per_source must be at least 1")
    size = token_size(F.col("text")) if size is None else size
    cluster = copy_cluster(F.col("text")) if cluster is None else cluster
    narrow = written(docs.select(
        F.col("doc_id").cast("long").alias("__doc_id"), F.col("source").cast("string").alias("__source"),
        size.cast("long").alias("__size"), cluster.cast("string").alias("__cluster"),
        F.monotonically_increasing_id().alias("__row")), "pack-units")
    shards = max(1, -(-narrow.count() // shard_rows))
    shard = F.pmod(F.xxhash64("__row"), F.lit(shards)).cast("int")
    return narrow.withColumn("__shard", shard).groupBy("__shard").applyInPandas(_pack(capacity, per_source), PACKED)


def whole_sequences(packed: pd.DataFrame) -> Iterator[tuple[tuple[int, int], pd.DataFrame]]:
    """The bins of packed rows, each in the order of its pieces."""
    for key, rows in packed.groupby(["shard", "bin"], sort=True):
        yield key, rows.sort_values("position")
