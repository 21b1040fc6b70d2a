"""What both vector searches share: clean vectors, equal rows folded, and the
streaming scorer that meets each block of candidates with the queries sent to it.

Rows with equal vectors score alike, so of a group of copies only the ``k + 1``
smallest ids can be among anyone's first ``k`` (one more as a query never finds
itself). Folding them is exact, and Spark cuts each group within every task
before the shuffle. Queries with equal vectors are answered once, with one more
neighbour than asked, and each drops its own id.

Defined cases: vectors that are null or hold null or non-finite components take
no part, neither do rows without an id; a row given twice counts once; rows that
share an id with different vectors are never each other's neighbours; shorter
vectors count as if filled with zeros.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import valid_vector, written


def clean(table: DataFrame, vector: Column, usable: Column | None = None) -> DataFrame:
    """(vec_id, v): distinct usable rows, ``v`` computed from ``embedding`` and filled to one length."""
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(F.col("vec_id").isNotNull() & valid_vector(F.col("embedding")))
    rows = rows.select("vec_id", vector.alias("v"))
    if usable is not None:
        rows = rows.filter(usable)
    size = rows.agg(F.max(F.size("v")), F.min(F.size("v"))).first()
    if size[0] != size[1]:
        rows = rows.withColumn("v", F.concat("v", F.array_repeat(F.element_at("v", 1) * 0, F.lit(size[0]) - F.size("v"))))
    return rows


def folded(rows: DataFrame, k: int) -> DataFrame:
    """Candidates: of every distinct vector the k + 1 smallest ids."""
    rank = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    return rows.distinct().withColumn("__n", rank).filter(F.col("__n") <= k + 1).drop("__n")


def query_vectors(queries: DataFrame) -> DataFrame:
    """(qid, v): one row per distinct query vector, named by its smallest id."""
    return queries.groupBy("v").agg(F.min("vec_id").alias("qid"))


def answers(found: DataFrame, queries: DataFrame, named: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of every query row from ``found`` (qid, vec_id, score)."""
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    top = found.groupBy("qid", "vec_id").agg(F.max("score").alias("score")).withColumn("__n", F.row_number().over(best)).filter(F.col("__n") <= k + 1)
    lists = top.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))).alias("near"))
    asked = queries.distinct().join(named, "v").join(lists, "qid").select(F.col("vec_id").alias("query_id"), "near")
    own = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return asked.select("query_id", F.posexplode(own).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.s")).alias("score"))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column as a matrix, a row per list (all of one length)."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def meet(candidates: DataFrame, queries: DataFrame, score: Callable, schema: str) -> DataFrame:
    """Stream (block, place, vec_id, v) and queries (block, ..., qid, v) sorted by block.

    ``score(ids, places, vectors, queries)`` gets a block's candidates and some of
    its queries (a RecordBatch) and yields RecordBatches. A task holds one block
    and one batch of queries.
    """
    names = candidates.columns + [c for c in queries.columns if c not in candidates.columns]
    types = {f.name: f.dataType for f in [*candidates.schema, *queries.schema]}
    fill = lambda df: [F.col(c) if c in df.columns else F.lit(None).cast(types[c]).alias(c) for c in names]
    both = candidates.select(F.lit(0).alias("kind"), *fill(candidates)).unionByName(queries.select(F.lit(1).alias("kind"), *fill(queries)))
    both = both.repartition("block").sortWithinPartitions("block", "kind", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, whole = None, [], None
        for batch in batches:
            blocks, kinds = np.array(batch.column("block").to_pylist(), object), batch.column("kind").to_numpy()
            change = np.flatnonzero((blocks[1:] != blocks[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for lo, hi in zip([0, *change], [*change, len(kinds)], strict=True):
                piece = batch.slice(lo, hi - lo)
                if blocks[lo] != block:
                    block, parts, whole = blocks[lo], [], None
                if kinds[lo] == 0:
                    parts.append(piece)
                elif parts:
                    if whole is None:
                        t = pa.Table.from_batches(parts).combine_chunks()
                        whole = (t.column("vec_id").to_numpy(), t.column("place").to_numpy(), np.concatenate([matrix(c) for c in t.column("v").chunks]))
                    yield from score(*whole, piece)

    return both.mapInArrow(run, schema)


def sample_rows(rows: DataFrame, most: int) -> np.ndarray:
    """At most ``most`` vectors, those of lowest id hash (the same at every run)."""
    got = rows.select("vec_id", "v").orderBy(F.xxhash64("vec_id"), "vec_id").limit(most).select("v").toArrow().column("v").combine_chunks()
    if isinstance(got, pa.ChunkedArray):
        got = got.combine_chunks()
    return matrix(got) if len(got) else np.zeros((0, 1))


def stored(rows: DataFrame, name: str) -> DataFrame:
    return written(rows, f"vectors-{name}")
