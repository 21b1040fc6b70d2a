"""Source divergence audit with late string materialization.

For every language, the terms of enough of its documents are kept; every source of
the language (and the language as a whole) has a smoothed share of each kept term,
as a whole number of billionths. Sources are compared with each other (sum of the
shares' differences) and with their language (terms a source uses more).

Only fixed-width digests of terms are shuffled: (lang, source, digest) with counts,
combined in every batch and every task. Strings are looked up for candidate digests
alone, once, as the least and the greatest string of each digest. Where these differ,
terms collide: the digest is split, its terms are counted again by string, and go on
as (digest, string). The strings of the outputs are joined back last, after ranks.

Sources are compared in tiles: a task holds ``SOURCES`` sources against as many
others for ``TERMS`` terms and gives partial sums, so neither the number of terms nor
that of sources of a language has to fit a task. Terms that neither tile has
differ by the two sources' shares of an unseen term and need no rows.

Defined cases: null text, lang and source read as empty; every row is a document,
repeated ones too; sources without a term, and languages without a kept one, are
compared like the others (all differences 0 where no term is kept); an empty table
gives no rows. Other columns take no part. Texts of any length are cut at non-term
bytes. All numbers are whole, products as decimals of 38 digits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import written
from tidemark.llm.words import SEGMENT, text_batches, text_bytes

DOCUMENTS = 30
SCALE = 1_000_000_000
EXTRA = 5
RANKS = 50
#: Bits of a digest, and of the bitmap that tells which digests to spell (1 MB, whatever the input).
DIGEST_BITS = 64
BITMAP_BITS = 23
SOURCES = 128
TERMS = 2048

_PART = np.zeros(256, bool)
_PART[0x41:0x5B] = _PART[0x61:0x7B] = _PART[0x80:] = True


def _segments(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Per segment: its distinct terms, the number of each occurrence's term, and of its text."""
    at = 0
    while at < len(data):
        end = min(at + 4 * SEGMENT, len(data))
        while end < len(data) and _PART[data[end - 1]]:
            end += 1
        part = _PART[data[at:end]]
        first = np.zeros(end - at + 1, bool)
        # a text's end separates terms
        first[offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, end, side="right")] - at] = True
        starts, ends = part.copy(), part.copy()
        starts[1:] &= ~part[:-1] | first[1:-1]
        ends[:-1] &= ~part[1:] | first[1:-1]
        starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        if len(starts):
            bounds = np.zeros(len(starts) + 1, np.int64)
            np.cumsum(ends - starts, out=bounds[1:])
            found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data[at:end][part])])
            found = found.dictionary_encode()
            yield found.dictionary, found.indices.to_numpy(), np.searchsorted(offsets, starts + at, side="right") - 1
        at = end


def _digests(terms: pa.Array, bits: int) -> np.ndarray:
    whole = np.fromiter(map(xxhash.xxh64_intdigest, terms.to_pylist()), np.uint64, len(terms))
    return (whole >> np.uint64(64 - bits)).view(np.int64)


def _bit(digests: np.ndarray) -> np.ndarray:
    return digests & ((1 << BITMAP_BITS) - 1)


def _groups(batch: pa.RecordBatch) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Number of each row's (lang, source) and the distinct ones."""
    lang, source = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
    both = lang.indices.to_numpy().astype(np.int64) * max(1, len(source.dictionary)) + source.indices.to_numpy()
    names, of = np.unique(both, return_inverse=True)
    width = max(1, len(source.dictionary))
    return of, lang.dictionary.take(pa.array(names // width)), source.dictionary.take(pa.array(names % width))


def _combined(group: np.ndarray, key: np.ndarray, text: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct (group, key) with the sum of ``n`` and the number of texts."""
    order = np.lexsort((text, key, group))
    group, key, text, n = group[order], key[order], text[order], n[order]
    new = np.r_[True, (group[1:] != group[:-1]) | (key[1:] != key[:-1])]
    start = np.flatnonzero(new)
    fresh = new | np.r_[True, text[1:] != text[:-1]]
    return group[start], key[start], np.add.reduceat(n, start), np.add.reduceat(fresh.astype(np.int64), start)


def _counts(bits: int, marked: Callable[[], np.ndarray] | None = None) -> Callable:
    """A map of batches to (lang, source, digest, n, docs), where every (lang, source) also comes
    once without a digest; with a bitmap, to those of the terms it marks, by ``term`` as well."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text"):
            of, lang, source = _groups(batch)
            texts, keys, n, strings = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
            for terms, code, text in _segments(*text_bytes(batch.column("text"))):
                if marked is not None:
                    some = marked()[_bit(_digests(terms, bits))][code]
                    code, text = code[some], text[some]
                pair, times = np.unique(text * len(terms) + code, return_counts=True)
                texts.append(pair // len(terms))
                n.append(times)
                if marked is None:
                    keys.append(_digests(terms, bits)[pair % len(terms)])
                else:
                    strings.append(terms.take(pa.array(pair % len(terms))))
            if marked is not None:
                named = pa.chunked_array(strings, pa.large_binary()).combine_chunks().dictionary_encode()
                keys = [named.indices.to_numpy().astype(np.int64)]
            text = np.concatenate(texts)
            if not len(text):
                found = (np.zeros(0, np.int64),) * 4
            else:
                found = _combined(of[text], np.concatenate(keys), text, np.concatenate(n))
            group, key, total, docs = found
            if marked is not None:
                which, at = pa.array(group), pa.array(key)
                arrays = [lang.take(which), source.take(which), pa.array(_digests(named.dictionary, bits)).take(at), _strings(named.dictionary.take(at)), pa.array(total), pa.array(docs)]
                yield pa.RecordBatch.from_arrays(arrays, names=["lang", "source", "digest", "term", "n", "docs"])
                continue
            own = np.arange(len(lang))
            which, zero = pa.array(np.r_[own, group]), np.zeros(len(own), np.int64)
            missing = np.arange(len(own) + len(key)) < len(own)
            arrays = [lang.take(which), source.take(which), pa.array(np.r_[zero, key], mask=missing), pa.array(np.r_[zero, total]), pa.array(np.r_[zero, docs])]
            yield pa.RecordBatch.from_arrays(arrays, names=["lang", "source", "digest", "n", "docs"])

    return count


def _strings(terms: pa.Array) -> pa.Array:
    return terms.cast(pa.large_string()).cast(pa.string())


def _spell(bits: int, marked: Callable[[], np.ndarray]) -> Callable:
    """A map of batches to the distinct (digest, term) of the digests a bitmap marks."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text"):
            for terms, _, _ in _segments(*text_bytes(batch.column("text"))):
                digest = _digests(terms, bits)
                some = np.flatnonzero(marked()[_bit(digest)])
                yield pa.RecordBatch.from_arrays([pa.array(digest[some]), _strings(terms.take(pa.array(some)))], names=["digest", "term"])

    return spell


def _bitmap(digests: DataFrame) -> Callable[[], np.ndarray]:
    """A broadcast bitmap of ``BITMAP_BITS`` bits; at most 257 rows of 4 KB reach the driver."""
    bit = F.col("digest").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
    rows = digests.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    marks = np.zeros(1 << BITMAP_BITS, bool)
    for r in rows.collect():
        # bucket b > 0 holds the numbers from 32768 (b - 1) + 1; bucket 0 the number 0
        bits = np.flatnonzero(np.unpackbits(np.frombuffer(bytes(r["bits"]), np.uint8), bitorder="little"))
        marks[bits + 32768 * (r["bucket"] - 1) + 1 if r["bucket"] else bits] = True
    held = digests.sparkSession.sparkContext.broadcast(np.packbits(marks))
    unpacked: list[np.ndarray] = []

    def marked() -> np.ndarray:
        if not unpacked:
            unpacked.append(np.unpackbits(held.value).astype(bool))
        return unpacked[0]

    return marked


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + EXTRA) / (total + EXTRA * terms)), exact; null where there are no terms."""
    above = (n + F.lit(EXTRA)).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = F.when(terms > 0, (total + terms * F.lit(EXTRA)).cast("decimal(20,0)"))
    return F.call_function("div", above, below) + F.lit(1)


TERM = ["lang", "digest", "split"]
GROUP = ["lang", "source"]


def term_counts(docs: DataFrame, documents: int = DOCUMENTS, bits: int = DIGEST_BITS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(counts, groups, names). ``counts``: lang, source, digest, split, n, total of every kept term that a
    source has. ``groups``: lang, source, n, total of kept terms, terms. ``names``: digest, split, term.

    ``split`` is empty but for terms whose digest another term shares: there it is the term itself.
    """
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counted = texts.mapInArrow(_counts(bits), "lang string, source string, digest long, n long, docs long")
    counted = written(counted.groupBy(*GROUP, "digest").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term-counts")
    some = counted.filter(F.col("digest").isNotNull())
    candidates = written(some.groupBy("lang", "digest").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= documents).select("digest").distinct(), "candidates")
    spelled = texts.select("text").mapInArrow(_spell(bits, _bitmap(candidates)), "digest long, term string")
    spelled = spelled.groupBy("digest").agg(F.min("term").alias("term"), F.max("term").alias("other")).join(candidates, "digest", "left_semi")
    spelled = written(spelled, "spelled")
    alone, shared = F.col("term") == F.col("other"), F.col("term") != F.col("other")
    names = spelled.filter(alone).select("digest", F.lit("").alias("split"), "term")
    terms = some.join(spelled.filter(alone).select("digest"), "digest", "left_semi").withColumn("split", F.lit(""))
    split = spelled.filter(shared).select("digest")
    if not split.isEmpty():
        by_string = texts.mapInArrow(_counts(bits, _bitmap(split)), "lang string, source string, digest long, term string, n long, docs long")
        by_string = by_string.join(split, "digest", "left_semi").withColumnRenamed("term", "split")
        by_string = written(by_string.groupBy(*GROUP, "digest", "split").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "split-terms")
        terms = terms.unionByName(by_string)
        names = names.unionByName(by_string.select("digest", "split", F.col("split").alias("term")).distinct())
    kept = terms.groupBy(*TERM).agg(F.sum("docs").alias("docs"), F.sum("n").alias("total")).filter(F.col("docs") >= documents).drop("docs")
    counts = written(terms.drop("docs").join(kept, TERM), "kept-terms")
    of_lang = counts.groupBy(*TERM).agg(F.max("total").alias("total")).groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("total"))
    groups = counted.select(*GROUP).distinct().join(counts.groupBy(*GROUP).agg(F.sum("n").alias("n")), GROUP, "left")
    groups = groups.join(of_lang, "lang", "left").fillna(0, ["n", "terms", "total"])
    return counts, written(groups, "term-groups"), names


def excess_terms(counts: DataFrame, groups: DataFrame, names: DataFrame, ranks: int = RANKS) -> DataFrame:
    """lang, source, item, value, rank: the terms a source uses more than its language does."""
    totals = groups.select(*GROUP, F.col("n").alias("group_n"), F.col("total").alias("lang_n"), "terms")
    rows = counts.join(totals, GROUP).select(
        *GROUP, "digest", "split", (share(F.col("n"), F.col("group_n"), F.col("terms")) - share(F.col("total"), F.col("lang_n"), F.col("terms"))).alias("value"))
    # all that tie at the last rank stay until their strings are known
    rows = rows.filter(F.col("value") > 0).withColumn("rank", F.rank().over(Window.partitionBy(*GROUP).orderBy(F.desc("value")))).filter(F.col("rank") <= ranks)
    rows = rows.join(names, ["digest", "split"]).select(*GROUP, F.col("term").alias("item"), "value")
    order = Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= ranks)


def _compare(table: pa.Table) -> pa.Table:
    """Partial sums for one block of terms and one pair of tiles: each pair of sources once."""
    own = table.filter(pc.is_null(table.column("digest")))
    rows = table.filter(pc.is_valid(table.column("digest")))
    source = own.column("source").to_pylist()
    tile, unseen = own.column("tile").to_numpy(), own.column("p").to_numpy()
    at = {x: i for i, x in enumerate(source)}
    digest, split = rows.column("digest").combine_chunks(), rows.column("split").combine_chunks().dictionary_encode()
    _, term = np.unique(np.c_[digest.to_numpy(zero_copy_only=False), split.indices.to_numpy(zero_copy_only=False)], axis=0, return_inverse=True)
    term = term.ravel()
    seen = int(term.max()) + 1 if len(term) else 0
    p = np.repeat(unseen[:, None], seen, 1)
    p[[at[x] for x in rows.column("source").to_pylist()], term] = rows.column("p").to_numpy()
    first, second = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    left, right = np.flatnonzero(tile == first), np.flatnonzero(tile == second)
    a, b, sums = [], [], []
    for i in left:
        other = right[right > i] if first == second else right
        a.append(np.full(len(other), i))
        b.append(other)
        sums.append(np.abs(p[other] - p[i]).sum(1))
    a, b = np.concatenate([np.zeros(0, np.int64), *a]).astype(np.int64), np.concatenate([np.zeros(0, np.int64), *b]).astype(np.int64)
    names = own.column("source").combine_chunks()
    return pa.table({
        "lang": pa.array([table.column("lang")[0].as_py()] * len(a), pa.string()), "a": names.take(pa.array(a)), "b": names.take(pa.array(b)),
        "unseen_a": unseen[a], "unseen_b": unseen[b], "value": np.concatenate([np.zeros(0, np.int64), *sums]).astype(np.int64), "seen": np.full(len(a), seen)})


def source_pairs(counts: DataFrame, groups: DataFrame, sources: int = SOURCES, terms: int = TERMS) -> DataFrame:
    """lang, source, item, value, rank: every other source of the language by the difference of all shares."""
    per_lang = groups.groupBy("lang").agg(F.ceil(F.count("*") / sources).cast("int").alias("tiles"))
    held = groups.join(per_lang, "lang").withColumns({
        "tile": F.pmod(F.xxhash64("source"), "tiles").cast("int"), "blocks": F.greatest(F.ceil(F.col("terms") / terms), F.lit(1)).cast("int"),
        "unseen": F.coalesce(share(F.lit(0), F.col("n"), F.col("terms")), F.lit(0))})
    rows = counts.join(held.select(*GROUP, F.col("n").alias("group_n"), "terms", "tile", "tiles", "blocks"), GROUP).select(
        *GROUP, "tile", "tiles", "digest", "split", share(F.col("n"), F.col("group_n"), F.col("terms")).alias("p"),
        F.pmod(F.xxhash64("digest", "split"), "blocks").cast("int").alias("block"))
    # a source's share of an unseen term goes to every block of terms
    own = held.select(*GROUP, "tile", "tiles", F.lit(None).cast("long").alias("digest"), F.lit("").alias("split"), F.col("unseen").alias("p"),
                      F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    met = rows.unionByName(own).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    met = met.withColumns({"i": F.least("tile", "with"), "j": F.greatest("tile", "with")}).drop("tiles", "with")
    schema = "lang string, a string, b string, unseen_a long, unseen_b long, value long, seen long"
    parts = met.groupBy("lang", "block", "i", "j").applyInArrow(_compare, schema)
    whole = parts.groupBy("lang", "a", "b", "unseen_a", "unseen_b").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    whole = whole.join(groups.groupBy("lang").agg(F.max("terms").alias("terms")), "lang")
    whole = whole.withColumn("value", F.col("value") + (F.col("terms") - F.col("seen")) * F.abs(F.col("unseen_a") - F.col("unseen_b")))
    both = whole.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("x"), "value")
    return both.select("lang", "x.source", "x.item", "value", F.row_number().over(Window.partitionBy("lang", "x.source").orderBy(F.desc("value"), "x.item")).alias("rank"))


def audit(docs: DataFrame, documents: int = DOCUMENTS, ranks: int = RANKS, bits: int = DIGEST_BITS, sources: int = SOURCES, terms: int = TERMS) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank."""
    counts, groups, names = term_counts(docs, documents, bits)
    parts = {"pair": source_pairs(counts, groups, sources, terms), "term": excess_terms(counts, groups, names, ranks)}
    out = [rows.select(*GROUP, F.lit(part).alias("part"), "item", "value", "rank") for part, rows in parts.items()]
    return out[0].unionByName(out[1])
