"""The corpus pipeline against a brute-force version of its stages."""

from __future__ import annotations

import tempfile
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F
from tests.llm.test_operators import DOCS, ROWS, brute_components, near_copies, sentence
from tidemark.llm import mixing, neardup, packing, quality


def stored(spark, docs, labels) -> str:
    folder = tempfile.mkdtemp(prefix="tidemark-pipeline-")
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages_equal_brute_force(spark):
    bad = [(3000 + i, " ".join(w + "$$$" for w in sentence(40, 700 + i).split()), "en", "b", 0) for i in range(50)]
    rows = ROWS + near_copies(80, 6) + bad + [(4000 + i, sentence(30, 2000 + i), "en", "ab"[i % 2], 0) for i in range(80)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("__score", F.lit("x"))
    labels = [(r[0], int(r[0] not in range(3000, 3050)), 0) for r in rows if r[0] is not None]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    folder = stored(spark, docs, labels)

    # stage 1: rows whose score reaches the threshold
    scores = quality.quality_scores(docs, labels).collect()
    good = [r["doc_id"] for r in scores if r["predicted"]]
    assert not set(good) & set(range(3000, 3050)) and Counter(range(4000, 4080)) == Counter(i for i in good if i and i >= 4000)
    # stage 2: one row per component of what is left
    left = [r for r in rows if (r[0] in set(good))]
    names = brute_components(left, corpus_pipeline.SHINGLE_WORDS)
    ids = {c for _, n, c in names if n} | {i for i, n, _ in names if not n}
    kept = list({r[0]: r for r in left if r[0] in ids}.values())
    # stage 3: copies by the mix of those rows
    copies = mixing.mix_counts(spark.createDataFrame(kept, DOCS)).collect()
    want = Counter({r["doc_id"]: r["copies"] for r in copies if r["copies"]})
    # stage 4: every copy once, within capacity, copies apart
    out = corpus_pipeline.run(spark, folder).toPandas()
    got = Counter(None if x != x else int(x) for x in out[out.piece == 0].doc_id)
    assert got == want
    assert (out.groupby(["shard", "bin"]).piece_size.sum() <= packing.CAPACITY).all()
    whole = out[out["size"] <= packing.CAPACITY]
    assert whole.groupby(["shard", "bin"]).doc_id.apply(lambda x: x.is_unique).all()


def test_stages_keep_the_columns_and_take_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    folder = stored(spark, docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert len(corpus_pipeline.STAGES) == 4
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_near_dedup_stage_uses_five_word_shingles(spark):
    """Scattered word changes: similar by two-word shingles, not by five-word ones; an equal copy still goes."""
    words = [f"w{i}" for i in range(500)]
    changed = [f"x{i}" if i % 25 == 12 else w for i, w in enumerate(words)]
    tail = words[:-2] + ["y0", "y1"]
    rows = [(1, " ".join(words), "en", "a", 0), (2, " ".join(changed), "en", "a", 0), (3, " ".join(tail), "en", "a", 0),
            (4, "one two three", "en", "a", 0), (5, "One  two three", "en", "a", 0), (6, "one two four", "en", "a", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    stage = dict(corpus_pipeline.STAGES)["MinHash near-dedup"]
    assert sorted(r["doc_id"] for r in stage(spark, docs, "").collect()) == [1, 2, 4, 6]
    assert sorted(r["doc_id"] for r in neardup.drop_near_duplicates(docs, 2).collect()) == [1, 4, 6]
