"""Fill-in-middle against a plain version: every case, any piece size."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tests.llm.test_operators import DOCS, ROWS, clashing, sentence
from tidemark.llm import middle

LINES = "\n".join(sentence(7, i) for i in range(3000))
CASES = ROWS + [
    (20, "a\nb\nc\nd", "en", "a", 7), (21, "a\nb\nc\n", "en", "a", 6), (22, "\n\n\n", "en", "a", 3), (23, "no line end", "en", "a", 3),
    (24, "has <P> in it\nx", "en", "a", 3), (25, "has <S>", "en", "a", 3), (26, "<M>\n", "en", "a", 3), (27, "<\n<P\n<S\n<\n<M\n>", "en", "a", 3),
    (28, LINES, "en", "a", 3), (28, LINES, "en", "b", 3), (29, "ü\r\n€\n" * 400, "de", "a", 3), (None, None, None, None, None), (-3, "a\nb", "en", "a", 3),
]


def plain(doc_id, text, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, None)))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return doc_id, len(units), "plain", None, None, text
    spm = h[3] % 100 < spm
    return doc_id, len(units), "spm" if spm else "psm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("chunk", [5, 100, middle.CHUNK])
def test_digests_equal_a_plain_version(spark, chunk):
    rows = [r for r in CASES if chunk > 5 or len(r[1] or "") < 5000]
    df = clashing(spark.createDataFrame(rows, DOCS), "row", "place", "piece", "form", "n")
    want = Counter((*(x := plain(i, t))[:5], sha(x[5]), sha(t or "")) for i, t, *_ in rows)
    assert Counter(tuple(r) for r in middle.digests(df.repartition(3), chunk=chunk).collect()) == want
    assert {"plain", "spm", "psm"} == {k[2] for k in want}


def test_outputs_are_the_whole_texts(spark):
    df = spark.createDataFrame(CASES, DOCS)
    got = middle.transformed(df, rate=60, spm=30).collect()
    assert Counter(tuple(r) for r in got) == Counter(plain(i, t, 60, 30) for i, t, *_ in CASES)
    assert middle.transformed(df.limit(0)).count() == middle.digests(df.limit(0)).count() == 0


def test_restoration_reads_the_output_and_not_the_input(spark):
    """Sections come from the marks in the pieces: a changed output restores to a changed text."""
    sections = middle._Sections("spm")
    got = sorted(x for piece in (b"<S>su", b"f<", b"P>pre<M", b">mid<") for x in sections.feed(piece)) + sorted(sections.end())
    assert b"".join(x for _, x in sorted(got)) == b"premid<suf"


def test_a_crowd_of_equal_rows_spreads(spark):
    """Rows that are equal in id and text get keys of their own, alike on every run."""
    df = spark.range(600).select(F.lit(1).alias("doc_id"), F.lit("x\ny\nz").alias("text")).repartition(4)
    keys = [Counter(bytes(r.row) for r in middle.pieces(df).collect()) for _ in range(2)]
    assert keys[0] == keys[1] and len(keys[0]) == 600
    plan = middle.digests(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(row") == 1
