"""Quality by votes of labelled neighbours in a latent-semantic space.

Terms are byte trigrams of the whole text (letter case kept), hashed to
``DIMS`` places and weighted ``log(1 + tf) * idf``, and word shapes (kind of first
and last byte, length class, whether the word repeats the one before), weighted
by the root of their share; either block has unit length. The space is the
truncated singular value decomposition of a bounded sample of labelled
documents. Every document is projected and compared with all sampled vectors, in blocks of
exact cosine products; its ``k`` nearest vote with their similarity as weight.
The shorter a text, the more the sample's mean label joins the vote.

What is sent to tasks is bounded by parameters: ``fit_rows`` x ``rank`` numbers
and a ``TERMS`` x ``rank`` projection. The sample is the ``fit_rows`` labelled rows
of lowest id hash, the same at every run.

Defined cases: null and empty texts score the sample's mean label; without any
usable label every score is 0.5; labels without a document or without a value
are left out; repeated rows score alike. Nothing but the text enters a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import crc_mod, free_name
from tidemark.llm.words import U, hash_words, mix, raw_bytes, text_batches, word_spans

DIMS = 2048
RANK = 64
FIT_ROWS = 3000
NEIGHBOURS = 25
THRESHOLD = 0.3
#: A text of this many words weighs the sample's mean label as much as its neighbours.
EVEN_WORDS = 3

#: Kinds of a byte: lower case or beyond ASCII, upper case, digit, sentence mark, other.
_KIND = np.zeros(256, np.int32)
_KIND[33:128] = 4
_KIND[65:91], _KIND[97:123], _KIND[48:58] = 1, 0, 2
_KIND[[ord(x) for x in ".,;:!?'\"()-"]] = 3
SHAPES = 5 * 5 * 5 * 2
TERMS = DIMS + SHAPES

_PLACE = (mix(np.arange(1 << 16, dtype=U)) % U(DIMS)).astype(np.int32)
_TURN = (mix(np.arange(1 << 8, dtype=U) + U(1 << 20)) % U(DIMS)).astype(np.int32)


def term_counts(column: pa.Array) -> np.ndarray:
    """Hashed trigram counts, a row per text; a text counts with a space at both ends."""
    data, offsets = raw_bytes(column)
    n = len(offsets) - 1
    lengths = np.diff(offsets)
    text = np.repeat(np.arange(n), lengths)
    padded = np.full(len(data) + 2 * n, 32, np.uint8)
    padded[np.arange(len(data)) + 2 * text + 1] = data
    of = np.repeat(np.arange(n), lengths + 2)
    pair = padded[:-2].astype(np.int32) << 8 | padded[1:-1] if len(padded) > 2 else np.zeros(0, np.int32)
    place = (_PLACE[pair] + _TURN[padded[2:]]) % DIMS if len(pair) else pair
    inside = of[:-2] == of[2:] if len(pair) else np.zeros(0, bool)
    counts = np.bincount(of[:-2][inside].astype(np.int64) * DIMS + place[inside], minlength=n * DIMS) if n else np.zeros(0)
    counts = counts.reshape(n, DIMS).astype(np.float32)
    counts[lengths == 0] = 0
    return np.hstack([counts, shape_counts(data, offsets)])


def shape_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of word shapes, a row per text."""
    n = len(offsets) - 1
    start, end = word_spans(data, offsets)
    word, text = hash_words(data, offsets)
    if not len(start):
        return np.zeros((n, SHAPES), np.float32)
    again = np.zeros(len(word), np.int64)
    again[1:] = (word[1:] == word[:-1]) & (text[1:] == text[:-1])
    length = np.searchsorted([2, 3, 5, 9], end - start, side="right")
    shape = ((_KIND[data[start]] * 5 + _KIND[data[end - 1]]) * 5 + length) * 2 + again
    return np.bincount(text.astype(np.int64) * SHAPES + shape, minlength=n * SHAPES).reshape(n, SHAPES).astype(np.float32)


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Term weights: both blocks of unit length."""
    terms = np.log1p(counts[:, :DIMS]) * idf
    terms /= np.maximum(np.linalg.norm(terms, axis=1, keepdims=True), 1e-12)
    shapes = counts[:, DIMS:]
    return np.hstack([terms, np.sqrt(shapes / np.maximum(shapes.sum(1, keepdims=True), 1))])


@dataclass
class Model:
    """Everything a task needs; sizes are bounded by FIT_ROWS, DIMS and RANK."""

    idf: np.ndarray
    basis: np.ndarray  # TERMS x rank
    vectors: np.ndarray  # sample x rank, unit length
    labels: np.ndarray
    prior: float
    k: int

    def project(self, counts: np.ndarray) -> np.ndarray:
        v = weigh(counts, self.idf) @ self.basis
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)

    def score(self, counts: np.ndarray) -> np.ndarray:
        out = np.full(len(counts), self.prior)
        some = counts.any(axis=1)
        if not some.any() or not len(self.labels):
            return out
        counts = counts[some]
        v = self.project(counts)
        votes = np.empty(len(v))
        k = min(self.k, len(self.labels))
        for at in range(0, len(v), 512):
            sims = v[at : at + 512] @ self.vectors.T
            near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(sims, near, 1), 1e-6).astype(np.float64)
            words = counts[at : at + 512, DIMS:].sum(1)
            doubt = self.k * EVEN_WORDS / (words + EVEN_WORDS)
            votes[at : at + 512] = ((weight * self.labels[near]).sum(1) + doubt * self.prior) / (weight.sum(1) + doubt)
        out[some] = np.clip(votes, 0.0, 1.0)
        return out


def _sample_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_batches(batches, "text"):
        counts = term_counts(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), pa.array([x.tobytes() for x in counts.astype(np.uint32)], pa.binary())],
            names=["doc_id", "label", "counts"])


def fit(docs: DataFrame, labels: DataFrame, train: Column | None = None, label: str = "quality",
        fit_rows: int = FIT_ROWS, rank: int = RANK, k: int = NEIGHBOURS) -> Model:
    """Learn from at most ``fit_rows`` labelled documents for which ``train`` (of doc_id) holds.

    Labels of ids without a document cannot be learned and do not count toward the bound.
    """
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).dropna()
    if train is not None:
        usable = usable.filter(train)
    usable = usable.groupBy("doc_id").agg(F.max("label").alias("label"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    usable = usable.join(texts.select("doc_id"), "doc_id", "left_semi")
    usable = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    rows = texts.join(usable, "doc_id")
    rows = rows.mapInArrow(_sample_counts, "doc_id long, label int, counts binary")
    # a repeated id counts once; at most fit_rows rows of TERMS numbers reach the driver
    rows = rows.groupBy("doc_id").agg(F.max(F.struct("label", "counts")).alias("x")).orderBy("doc_id")
    got = rows.select("x.label", "x.counts").toArrow()
    y = np.array(got.column("label").to_pylist(), np.float64)
    counts = np.array([np.frombuffer(x, np.uint32) for x in got.column("counts").to_pylist()], np.float32).reshape(-1, TERMS)
    some = counts.any(axis=1)
    if not len(y):
        return Model(np.zeros(DIMS, np.float32), np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), y, 0.5, k)
    prior, y, counts = float(y.mean()), y[some], counts[some]
    idf = np.log((1 + len(y)) / (1 + (counts[:, :DIMS] > 0).sum(0))).astype(np.float32) + 1
    x = weigh(counts, idf)
    rank = max(1, min(rank, len(y)))
    rng = np.random.default_rng(7)
    q = np.linalg.qr(x.T @ rng.normal(size=(len(y), min(rank + 16, len(y)))).astype(np.float32))[0] if len(y) else np.zeros((TERMS, 1))
    for _ in range(4):
        q = np.linalg.qr(x.T @ (x @ q))[0]
    _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
    basis = (q @ vt.T)[:, :rank].astype(np.float32)
    v = x @ basis
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    return Model(idf, basis, v.astype(np.float32), y, prior, k)


def score_documents(docs: DataFrame, model: Model, keep: list[str], name: str = "score") -> DataFrame:
    """The columns ``keep`` and a score in 0..1, called ``name``, for every document's whole text."""
    text = free_name(docs, "__text")
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select(*[f"`{c}`" for c in keep]).schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, text):
            scores = held.value.score(term_counts(batch.column(text)))
            arrays = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(scores, pa.float64())], names=[*keep, name])

    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias(text))
    return rows.mapInArrow(score, schema.add(name, "double"))


def held_out(doc_id: Column) -> Column:
    """Every fifth id by crc32; labels of these are never learned."""
    return crc_mod(doc_id, 5) == 0


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for every document."""
    model = fit(docs, labels, ~held_out(F.col("doc_id")))
    return score_documents(docs, model, ["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
