"""Source divergence against a plain version: collisions, tiles, ties, nulls."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from tests.llm.test_operators import DOCS, ROWS, clashing
from tidemark.llm import divergence
from tidemark.llm.words import text_bytes

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_terms(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(rows, documents, ranks):
    rows = [(lang or "", source or "", plain_terms(text)) for _, text, lang, source, _ in rows]
    out = []
    for lang in {r[0] for r in rows}:
        docs, total, by = Counter(), Counter(), defaultdict(Counter)
        for _, source, terms in (r for r in rows if r[0] == lang):
            docs.update(set(terms))
            total.update(terms)
            by[source].update(terms)
        kept = {t for t, n in docs.items() if n >= documents}
        by["", None] = total  # the language itself
        share = {}
        for g, counts in by.items():
            below = sum(counts[t] for t in kept) + 5 * len(kept)
            share[g] = {t: 1 + 1_000_000_000 * (counts[t] + 5) // below for t in kept}
        q = share.pop(("", None))
        for g, p in share.items():
            pairs = sorted((-sum(abs(p[t] - o[t]) for t in kept), h.encode()) for h, o in share.items() if h != g)
            terms = sorted((q[t] - p[t], t.encode()) for t in kept if by[g][t] and p[t] > q[t])[:ranks]
            out += [(lang, g, "pair", x.decode(), -v, i) for i, (v, x) in enumerate(pairs, 1)]
            out += [(lang, g, "term", x.decode(), -v, i) for i, (v, x) in enumerate(terms, 1)]
    return Counter(out)


def table(n=160, seed=4):
    r = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdé漢" for b in "xyzÄß"]
    rows = [(i, " ".join(r.choices(words, [1 + (j * (i % 7)) % 11 for j in range(len(words))], k=r.randint(0, 40))).title(),
             r.choice(["en", "de", None]), r.choice([None, "", "s1", "s2", "S2", "ü", "s3"]), 0) for i in range(n)]
    return rows + [(900, None, "xx", "only", 0), (901, "", "en", "silent", 0), (902, "1 2 3 --", "de", "silent", 0)] + rows[:5]


def got(df):
    return Counter(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.mark.parametrize("bits, sources, terms", [(64, 128, 2048), (3, 128, 2048), (64, 2, 4), (4, 3, 3)])
def test_audit_equals_a_plain_version(spark, bits, sources, terms):
    """Digests of 3 and 4 bits collide nearly everywhere and are split; tiles of 2 sources and 4 terms."""
    rows = table()
    df = clashing(spark.createDataFrame(rows, DOCS), "digest", "split", "term", "n", "item")
    want = plain(rows, 12, 5)
    assert got(divergence.audit(df.repartition(3), 12, 5, bits, sources, terms)) == want
    assert {k[2] for k in want} == {"pair", "term"} and any(k[0] == "xx" or k[1] == "silent" for k in want)


def test_edge_rows_and_the_empty_table(spark):
    df = spark.createDataFrame(ROWS, DOCS)
    assert got(divergence.audit(df, 1, 50)) == plain(ROWS, 1, 50)
    assert got(divergence.audit(df, 99, 50)) == plain(ROWS, 99, 50)
    assert divergence.audit(df.limit(0)).count() == 0


def test_terms_of_segments_equal_a_regular_expression(monkeypatch):
    monkeypatch.setattr(divergence, "SEGMENT", 5)
    texts = [r[1] for r in ROWS if len(r[1] or "") < 10_000] + ["a" * 300 + " b-c", "Ünï", "x", "", "y z", "[q]^{r}\x7fs"]
    found = [[] for _ in texts]
    for terms, code, text in divergence._segments(*text_bytes(pa.array(texts))):
        for c, t in zip(code, text, strict=True):
            found[t].append(terms[int(c)].as_py().decode())
    assert found == [plain_terms(t) for t in texts]


def test_only_digests_are_shuffled_for_counts(spark):
    """The plan of the count has no string but the group's in its exchange."""
    texts = spark.createDataFrame(ROWS, DOCS).select("lang", "source", "text")
    counted = texts.mapInArrow(divergence._counts(64), "lang string, source string, digest long, n long, docs long")
    assert [f.dataType.simpleString() for f in counted.schema[2:]] == ["bigint"] * 3
