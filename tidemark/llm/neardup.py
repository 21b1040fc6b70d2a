"""Near-duplicate groups by a signature-coordinate inverted join.

Every text becomes its set of distinct shingles of ``width`` words and a MinHash
signature of ``K`` coordinates; each coordinate with its value is a posting
key. Texts with equal sets are one node. Two nodes of similarity ``s`` agree
on a coordinate with probability ``s``, so a linked pair (0.8 or more) agrees on
fewer than ``T`` of ``K`` with a chance below one in a million.

- Prefix: a pair with ``T`` common keys shares one among the ``K - T + 1`` keys
  that come first in any fixed order, for either node. Keys go by rising
  frequency. Of a node's keys those that no other node has come first and need
  no list, so of its ``m`` shared keys the ``m - T + 1`` rarest are posted, and a
  node with fewer than ``T`` shared keys is posted nowhere.
- Skip: sets whose sizes are more than 20% apart cannot link, so lists without
  two close sizes and pairs of far sizes are passed over; agreements are
  counted over whole signatures, and pairs below ``T`` are left out.
- Links are confirmed on the full sets of the whole texts.

A list is not expanded into all its pairs. First every member meets the list's
pivot, which joins groups of copies in linear work. Then only lists whose
members are still in different components go on, in blocks of bounded size,
and only for pairs across components; each such pair is settled in one list,
that of its first common key. So every pair of different components that may
link is checked, and links within a component are not needed.

Defined cases: texts without words are linked with nothing; a text of fewer words
than a shingle is one shingle; rows that repeat an id are nodes by their text, and a component's
id is the smallest id in it; null ids never name a component that has another
id. Rows without an id stay unless linked with a row that has one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written
from tidemark.llm.words import U, hash_words, mix, text_batches, text_bytes

WIDTH = 2
K = 64
T = 34
STAR = 512
BLOCK = 1024
BUCKET_ROWS = 4096
#: Bytes of text of a group of links to confirm; groups are split by rows and by bytes.
GROUP_BYTES = 32 << 20

_A = mix(np.arange(1, K + 1, dtype=U)) | U(1)
_B = mix(np.arange(1, K + 1, dtype=U) + U(1 << 32))
_AT = np.arange(K, dtype=U) << U(32)


def shingle_sets(column: pa.Array, width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the shingles of ``width`` words of every text."""
    data, offsets = text_bytes(column)
    word, text = hash_words(data, offsets)

    def joined(h: np.ndarray, n: int, step: int) -> np.ndarray:
        """Hashes of the runs of ``step`` words at the first n places."""
        out = h[:n]
        for i in range(1, step):
            x = h[i : i + n]
            out = mix(out * U(3) + (x << U(1) | x >> U(63)))
        return out

    runs = joined(word, max(0, len(word) - width + 1), width)
    bounds = np.searchsorted(text, np.arange(len(offsets)))
    out = []
    for a, z in zip(bounds[:-1], bounds[1:], strict=True):
        if z - a >= width:
            out.append(np.unique(runs[a : z - width + 1]))
        else:
            out.append(mix(joined(word[a:z], min(1, z - a), z - a) + U(7)))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """K minima of permuted shingle hashes, their upper 32 bits."""
    low = np.full(K, ~U(0))
    for at in range(0, len(shingles), 2048):
        x = shingles[at : at + 2048]
        for k in range(K):
            low[k] = min(low[k], ((x ^ _B[k]) * _A[k]).min())
    return (low >> U(32)).astype(np.uint32)


def _sign(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in text_batches(batches, "text"):
        sizes, prints, sigs = [], [], []
        for s in shingle_sets(batch.column("text"), width):
            sizes.append(len(s))
            if len(s):
                at = np.arange(1, len(s) + 1, dtype=U)
                prints.append(mix(s * (at * U(2) + U(1))).sum(dtype=U).tobytes() + mix(s ^ at).sum(dtype=U).tobytes())
                sigs.append(signature(s).tobytes())
            else:
                prints.append(None)
                sigs.append(None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()),
             pa.array(sigs, pa.binary()), pc.binary_length(batch.column("text")).cast(pa.int64())],
            names=["doc_id", "text_hash", "n_shingles", "print", "sig", "bytes"])


def _keys(sigs: np.ndarray) -> np.ndarray:
    return mix(_AT[None, :] | sigs.astype(U))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, K)


def _spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All keys of every node, with their coordinates."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 2048):
            b = batch.slice(lo, 2048)
            keys = _keys(_matrix(b.column("sig")))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel().view(np.int64)), b.column("node").take(pa.array(np.repeat(np.arange(b.num_rows), K))),
                 pa.array(np.tile(np.arange(K, dtype=np.int8), b.num_rows))], names=["key", "node", "coordinate"])


def _postings(nodes: DataFrame) -> DataFrame:
    """(node, n_shingles, bytes, mask, posted): the keys each node is posted under; ``mask`` has their coordinates as bits."""
    spelled = nodes.select("node", "sig").mapInArrow(_spell, "key long, node long, coordinate byte")
    often = spelled.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = spelled.join(often, "key").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "key", "coordinate"))).alias("x"))
    posted = shared.filter(F.size("x") >= T).withColumn("x", F.slice("x", 1, F.size("x") - (T - 1)))
    bits = F.aggregate("x", F.lit(0).cast("long"), lambda m, x: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), x["coordinate"].cast("int"))))
    posted = posted.select("node", bits.alias("mask"), F.transform("x", lambda x: x["key"]).alias("posted"))
    return posted.join(nodes.select("node", "n_shingles", "bytes"), "node")


def _similar_size(a: Column, b: Column) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * 80


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b), by alternating large and small stars.

    Each round is written to the shared folder; the roots are the smallest nodes.
    """
    now = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        # done when the links are stars: every node has one link, to a node without any
        ends = now.select("b").distinct().join(now.select(F.col("a").alias("b")).distinct(), "b", "left_semi")
        if ends.isEmpty() and now.groupBy("a").count().filter("count > 1").isEmpty():
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = written(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "links")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _confirm(groups: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Links (a, b) among rows (group, idx, node, partners): node with each partner idx, on full sets."""

    def check(rows: pa.Table) -> pa.Table:
        sets = shingle_sets(rows.column("text"), width)
        at = {i: n for n, i in enumerate(rows.column("idx").to_pylist())}
        node = rows.column("node").to_pylist()
        a, b = [], []
        for n, partners in enumerate(rows.column("partners").to_pylist()):
            for p in partners:
                x, y = sets[n], sets[at[p]]
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= 80 * (len(x) + len(y) - common):
                    a.append(node[n])
                    b.append(node[at[p]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return groups.join(texts, "node").groupBy("group").applyInArrow(check, "a long, b long")


def _agreeing(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose whole signatures agree on T coordinates or more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = (_matrix(batch.column("sa")) == _matrix(batch.column("sb"))).sum(1) >= T
            yield batch.select(["a", "b"]).filter(pa.array(good))

    a = nodes.select(F.col("node").alias("a"), F.col("sig").alias("sa"))
    b = nodes.select(F.col("node").alias("b"), F.col("sig").alias("sb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "sa", "sb").mapInArrow(count, "a long, b long")


def _parts(rows: int) -> Column:
    """Into how many parts a group goes, so that each has about ``rows`` rows and GROUP_BYTES of text at most."""
    return F.greatest(F.ceil(F.count(F.lit(1)) / rows), F.ceil(F.sum("bytes") / GROUP_BYTES), F.lit(1)).cast("int")


def _stars(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Groups of a pivot (a) and some of its partners (b)."""
    pairs = pairs.join(nodes.select(F.col("node").alias("b"), "bytes"), "b")
    degree = pairs.groupBy("a").agg(_parts(STAR).alias("parts"))
    group = lambda part: F.concat_ws("|", F.col("a").cast("string"), part.cast("string"))
    members = pairs.join(degree, "a").select(
        group(F.pmod(F.xxhash64("b"), F.col("parts"))).alias("group"), F.lit(1).alias("idx"), F.col("b").alias("node"), F.array(F.lit(0)).alias("partners"))
    centres = degree.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).select(
        group(F.col("part")).alias("group"), F.lit(0).alias("idx"), F.col("a").alias("node"), F.array().cast("array<int>").alias("partners"))
    return members.unionByName(centres)


def _across(lists: DataFrame, nodes: DataFrame) -> DataFrame:
    """Groups (group, idx, node, partners) of pairs across components that may still link.

    ``lists`` has (key, node, n_shingles, bytes, mask, comp). Short lists share buckets of
    about BUCKET_ROWS rows; a long one goes in blocks of about BLOCK rows against
    each other, so a task holds one bucket or two blocks. Long texts make for fewer
    rows in either.
    """
    buckets = int(lists.agg(_parts(BUCKET_ROWS)).first()[0] or 1)
    blocks = lists.groupBy("key").agg(_parts(BLOCK).alias("blocks"))
    dealt = lists.join(blocks, "key").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    i, j = F.least("own", "other").cast("string"), F.greatest("own", "other").cast("string")
    group = F.when(F.col("blocks") == 1, F.pmod("key", F.lit(buckets)).cast("string")).otherwise(F.concat_ws("|", F.col("key").cast("string"), i, j))
    dealt = dealt.select(group.alias("group"), "key", "own", (F.col("blocks") > 1).alias("long"), (i == j).alias("same"), "node", "n_shingles", "mask", "comp")
    dealt = dealt.join(nodes.select("node", "sig"), "node")

    def compare(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("key", "ascending"), ("n_shingles", "ascending")])
        key, size, comp, own, node = (rows.column(c).to_numpy() for c in ("key", "n_shingles", "comp", "own", "node"))
        crossing = bool(rows.column("long")[0].as_py() and not rows.column("same")[0].as_py())
        sigs, key = _matrix(rows.column("sig")), key.view(U)
        keys = _keys(sigs)
        first = (rows.column("mask").to_numpy().view(U)[:, None] >> np.arange(K, dtype=U) & U(1)).astype(bool)
        left, right, at = [], [], np.arange(len(key) - 1)
        step = 1
        while len(at):
            # within a list sizes rise: a row that is too large ends the run of its predecessor
            at = at[at + step < len(key)]
            at = at[(key[at] == key[at + step]) & (size[at] * 100 >= size[at + step] * 80)]
            x, y = at, at + step
            good = comp[x] != comp[y]
            if crossing:
                good &= own[x] != own[y]
            x, y = x[good], y[good]
            for lo in range(0, len(x), 1 << 16):
                a, b = x[lo : lo + (1 << 16)], y[lo : lo + (1 << 16)]
                same = sigs[a] == sigs[b]
                many = same.sum(1) >= T
                a, b, same = a[many], b[many], same[many]
                # settled in the list of the pair's first common key
                lowest = np.where(same & first[a] & first[b], keys[a], ~U(0)).min(1)
                mine = lowest == key[a]
                left.append(node[a[mine]])
                right.append(node[b[mine]])
            step += 1
        left = np.concatenate([*left, np.zeros(0, np.int64)])
        right = np.concatenate([*right, np.zeros(0, np.int64)])
        used, place = np.unique(np.concatenate([left, right]), return_inverse=True)
        partners: list[list[int]] = [[] for _ in used]
        for a, b in zip(place[: len(left)], place[len(left) :], strict=True):
            partners[a].append(b)
        group = rows.column("group")[0].as_py()
        return pa.table({"group": pa.array([group] * len(used), pa.string()), "idx": pa.array(np.arange(len(used)), pa.int32()),
                         "node": pa.array(used, pa.int64()), "partners": pa.array(partners, pa.list_(pa.int32()))})

    return dealt.groupBy("group").applyInArrow(compare, "group string, idx int, node long, partners array<int>")


def near_duplicates(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id and root (its component's node; null without words) of every row."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    signed = written(rows.mapInArrow(partial(_sign, width=width), "doc_id long, text_hash long, n_shingles long, print binary, sig binary, bytes long"), "dedup-signed")
    some = signed.filter("print is not null").dropDuplicates(["print"]).withColumn("node", F.monotonically_increasing_id())
    nodes = written(some.select("node", "print", "doc_id", "text_hash", "n_shingles", "sig", "bytes"), "dedup-nodes")
    posted = written(_postings(nodes), "dedup-posted")
    postings = posted.select(F.explode("posted").alias("key"), "node", "n_shingles", "bytes", "mask")
    heads = postings.groupBy("key").agg(
        F.min(F.struct(F.xxhash64("node"), "node", "n_shingles")).alias("p"), F.count(F.lit(1)).alias("n"),
        F.min("n_shingles").alias("lo"), F.max("n_shingles").alias("hi"), (F.sum("n_shingles") - F.min("n_shingles") - F.max("n_shingles")).alias("mid"))
    # lists of two or three members show by their sums whether any two sizes are close
    close = F.when(F.col("n") == 2, _similar_size(F.col("lo"), F.col("hi"))).when(
        F.col("n") == 3, _similar_size(F.col("lo"), F.col("mid")) | _similar_size(F.col("mid"), F.col("hi"))).otherwise(F.col("n") > 3)
    lists = written(postings.join(heads.filter(close).select("key", "p"), "key"), "dedup-lists")
    met = lists.filter((F.col("node") != F.col("p.node")) & _similar_size(F.col("n_shingles"), F.col("p.n_shingles")))
    met = met.select(F.col("p.node").alias("a"), F.col("node").alias("b")).distinct()
    agreed = written(_agreeing(met, nodes), "dedup-agreed")

    # texts of the nodes that may link, from one row of each
    of = nodes.join(lists.select("node").distinct(), "node").select("node", "doc_id", "text_hash").alias("o")
    texts = rows.alias("d").join(of, (F.col("d.text_hash") == F.col("o.text_hash")) & F.col("d.doc_id").eqNullSafe(F.col("o.doc_id")))
    texts = texts.select("node", "text")
    repeated = signed.groupBy("doc_id", "text_hash").count().filter("count > 1")
    if not repeated.isEmpty():
        texts = texts.dropDuplicates(["node"])
    texts = written(texts, "dedup-texts", compression="zstd")

    links = written(_confirm(_stars(agreed, nodes), texts, width), "dedup-links")
    comp = components(links)

    open_lists = lists.drop("p").join(comp, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root")
    open_lists = written(open_lists, "dedup-open")
    mixed = open_lists.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("key")
    rest = written(_across(open_lists.join(mixed, "key"), nodes), "dedup-across")
    # the components found so far are the nodes of the second round
    bridges = _confirm(rest, texts, width).join(comp.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left").join(
        comp.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left")
    joined = components(bridges.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")))
    joined = joined.select(F.col("node").alias("root"), F.col("root").alias("last"))

    named = signed.select("doc_id", "text_hash", "n_shingles", "print").join(nodes.select("print", "node"), "print", "left")
    named = named.join(comp, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = named.join(joined, "root", "left").withColumn("root", F.coalesce("last", "root")).drop("last")
    named = written(named, "dedup-named")
    least = named.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    out = named.join(least, "root", "left")
    component = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return out.select("doc_id", "text_hash", "n_shingles", "root", component.alias("component_id"))


def document_groups(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, component_id and kept per document."""
    return near_duplicates(docs, width).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One document of each group, with all its columns; texts without words all stay."""
    found = written(near_duplicates(docs, width), "dedup-rows")
    stay = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    # one row of each component: repeated ids and equal texts count once
    first = stay.filter("root is not null").groupBy("root").agg(F.min(F.struct("doc_id", "text_hash")).alias("x")).select("x.*")
    empty = stay.filter("root is null").select("doc_id", "text_hash")
    stay = first.unionByName(empty).distinct()
    many = found.filter("root is not null").groupBy("doc_id", "text_hash").count().filter("count > 1").select("doc_id", "text_hash", F.lit(True).alias("many"))
    stay = stay.alias("s").join(many.alias("m"), F.expr("s.doc_id <=> m.doc_id and s.text_hash = m.text_hash"), "left").select(
        "s.*", F.coalesce("many", F.lit(False)).alias("many"))
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("text_hash")).alias("d")
    rows = rows.join(stay.alias("s"), F.expr("d.text_hash = s.text_hash and d.doc_id <=> s.doc_id"))
    rows = rows.select("row", "d.doc_id", "d.text_hash", "many")
    once = rows.filter("many").dropDuplicates(["doc_id", "text_hash"])
    return rows.filter("not many").unionByName(once).select("row.*")
