"""Mixing sources to target weights by Pareto order sampling.

Every document of a source expects ``e = min(3, c * x)`` copies, ``x`` growing
with the square root of its size in powers of two and ``c`` set so that the
source's expected words meet its target. ``floor(e)`` whole copies are certain.
The rest ``p = e - floor(e)`` is an inclusion probability: documents are ranked
by random odds over inclusion odds, ``(u / (1 - u)) / (p / (1 - p))``, and taken
in that order while they fit the words still missing (the sample's fixed
size). One document, the one whose size comes nearest to the last gap, tops
the source up if that brings it nearer to its target.

``u`` comes from a hash of the document, so reruns agree. All decisions are
per-source numbers: a document is judged by its own columns and its source's
parameters, no source is gathered or sorted as a whole. The cut point is found
from word sums of rank buckets, then within the one bucket it falls into.

Defined cases: a null text counts as empty; documents without words are never
taken (no copies); the null source is a source of its own; rows that repeat
id, source and text are one unit, taken or left together; other columns pass
through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import n_words, written
from tidemark.operators.numbering import dense_numbers

WEIGHTS = (5, 2, 1)
MOST = 3
RANK_BUCKETS = 1 << 13


def _units(docs: DataFrame) -> DataFrame:
    """docs with ``__size`` (words), ``__h`` (text hash) and ``__u`` (its random number in (0, 1))."""
    text = F.coalesce(F.col("text"), F.lit(""))
    named = docs.withColumns({"__size": n_words(F.col("text")), "__h": F.md5(text)})
    digits = F.substring(F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("__h"))), 1, 12)
    whole = F.conv(digits, 16, 10).cast("long")
    return named.withColumn("__u", (whole.cast("double") + F.lit(0.5)) / F.lit(float(1 << 48)))


def _growth(size: Column) -> Column:
    """x of a size: 2 ** (number of its bits // 2); none for a size of 0."""
    return F.when(size > 0, F.pow(F.lit(2.0), F.floor(F.length(F.bin(size)) / 2)))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size) -> with ``target``: all words shared by repeating weights in
    code-point order (null last), none above ``most`` times its source's size.

    Sources are numbered by ranges. The level at which the others share what full sources
    leave rises round by round, each a sum over sources, until no further source is full.
    """
    numbers, n = dense_numbers(sizes, "source", "__i")
    s = sizes.alias("s").join(numbers.alias("n"), F.col("s.source") == F.col("n.source"), "left").select(
        "s.source", "s.source_size", F.coalesce("__i", F.lit(n)).alias("__i"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("__i") % len(weights) + 1).cast("int"))
    s = s.withColumn("__w", w).withColumn("__cap", F.col("source_size") * F.lit(float(most)))
    s = written(s.withColumn("__q", F.col("__cap") / F.col("__w")), "mix-sources")
    level = 0.0
    while True:
        full = F.col("__q") < F.lit(level)
        left, open_weight = s.agg(
            F.sum("source_size") - F.sum(F.when(full, F.col("__cap")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("__w")))).first()
        if not open_weight:
            level = float("inf")
            break
        if left / open_weight <= level:
            break
        level = left / open_weight
    target = F.when(F.col("__q") <= F.lit(level), F.col("__cap")).otherwise(F.col("__w") * F.lit(level))
    return s.select("source", "source_size", target.cast("double").alias("target"))


def _factors(classes: DataFrame, targets: DataFrame, most: int) -> DataFrame:
    """The c of each source, from word sums of its size classes (64 at most)."""
    j = classes.join(targets, classes["source"].eqNullSafe(targets["source"])).select(targets["source"], "target", "__x", "words")
    w = Window.partitionBy("source").orderBy(F.desc("__x"))
    full = F.coalesce(F.sum("words").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum(F.col("words") * F.col("__x")).over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    c = (F.col("target") - F.lit(float(most)) * full) / rest
    j = j.withColumn("__c", c)
    # the first class that is not full once all larger ones are
    return j.groupBy("source", "target").agg(
        F.min(F.when(F.col("__c") * F.col("__x") <= F.lit(float(most)), F.struct(-F.col("__x"), "__c")))["__c"].alias("__c"))


def _expected(docs: DataFrame, most: int) -> DataFrame:
    e = F.when(F.col("__size") > 0, F.least(F.lit(float(most)), F.coalesce(F.col("__c"), F.lit(float(most))) * _growth(F.col("__size"))))
    e = F.when(F.col("target") > 0, e)
    docs = docs.withColumn("__e", F.coalesce(e, F.lit(0.0))).withColumn("__sure", F.floor("__e"))
    p = F.col("__e") - F.col("__sure")
    odds = (F.col("__u") / (F.lit(1.0) - F.col("__u"))) / (p / (F.lit(1.0) - p))
    return docs.withColumn("__q", F.when(p > 0, odds))


def mix_plan(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """(units, plan): every document's numbers, and one row of parameters per source.

    ``units`` is a written narrow table (no texts); ``plan`` has source,
    source_size, target, ``__c`` and the cut points.
    """
    units = written(_units(docs.select("doc_id", "source", "text")).select("doc_id", "source", "__size", "__h", "__u"), "mix-units")
    sizes = units.groupBy("source").agg(F.sum("__size").alias("source_size"))
    targets = written(source_targets(sizes, weights, most), "mix-targets")
    classes = units.filter("__size > 0").groupBy("source", _growth(F.col("__size")).alias("__x")).agg(F.sum("__size").alias("words"))
    factors = _factors(classes, targets.select("source", "target"), most)
    t = targets.alias("t").join(factors.alias("f"), F.expr("t.source <=> f.source"), "left").select("t.*", "f.__c")
    t = written(t, "mix-factors")

    judged = _expected(_with(units, t), most)
    bucket = F.floor(F.col("__q") / (F.lit(1.0) + F.col("__q")) * RANK_BUCKETS)
    judged = judged.withColumn("__b", bucket)
    sums = judged.groupBy("source", "__b").agg(
        F.sum("__size").alias("words"), F.sum(F.col("__sure") * F.col("__size")).alias("sure"))
    per = Window.partitionBy("source")
    run = per.orderBy(F.col("__b").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.withColumn("__sure_words", F.sum("sure").over(per)).filter("__b is not null")
    sums = sums.withColumn("__upto", F.sum("words").over(run))
    cut = sums.alias("s").join(t.alias("t"), F.expr("s.source <=> t.source")).select(
        "s.source", "s.__b", (F.col("target") - F.col("__sure_words")).alias("__room"), "__upto", "words")
    # the first bucket that does not fit as a whole, and the words before it
    cut = cut.filter("__upto > __room").groupBy("source", "__room").agg(F.min(F.struct("__b", (F.col("__upto") - F.col("words")).alias("w"))).alias("x"))
    cut = cut.select("source", "__room", F.col("x.__b").alias("__cut_b"), F.col("x.w").alias("__before"))
    sure = judged.groupBy("source").agg(F.sum(F.col("__sure") * F.col("__size")).alias("__sure_words"))
    everything = judged.filter("__b is not null").groupBy("source").agg(F.sum("__size").alias("__all"))
    plan = (t.alias("t").join(cut.alias("c"), F.expr("t.source <=> c.source"), "left")
            .join(sure.alias("s"), F.expr("t.source <=> s.source"), "left")
            .join(everything.alias("a"), F.expr("t.source <=> a.source"), "left")
            .select("t.*", "__cut_b", "__before", (F.col("target") - F.col("__sure_words")).alias("__room"),
                    F.coalesce("__all", F.lit(0)).alias("__all")))
    plan = written(plan, "mix-cut")

    # inside the bucket of the cut: unit by unit
    inside = _with(units, plan.filter("__cut_b is not null"), "inner")
    inside = _expected(inside, most).withColumn("__b", bucket).filter("__b = __cut_b")
    inside = inside.groupBy("source", "__room", "__before", "__q", "doc_id", "__h").agg(F.sum("__size").alias("words"))
    order = Window.partitionBy("source").orderBy("__q", F.col("doc_id").asc_nulls_last(), "__h")
    inside = inside.withColumn("__upto", F.col("__before") + F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    last = inside.groupBy("source").agg(
        F.min(F.when(F.col("__upto") > F.col("__room"), F.struct("__q", F.col("doc_id").isNull().alias("n"), "doc_id", "__h"))).alias("__stop"),
        F.coalesce(F.max(F.when(F.col("__upto") <= F.col("__room"), F.col("__upto"))), F.min("__before")).alias("__got"))
    plan = plan.alias("p").join(last.alias("l"), F.expr("p.source <=> l.source"), "left").select(
        "p.*", "__stop", (F.col("__room") - F.coalesce("__got", "__all")).alias("__gap"))
    plan = written(plan, "mix-stop")

    # the unit that fills the last gap best
    rest = _expected(_with(units, plan), most).filter(F.col("__size") > 0).filter(F.col("__sure") < most).filter(~_in_prefix())
    rest = rest.groupBy("source", "__gap", "doc_id", "__h").agg(F.sum("__size").alias("words"))
    off = F.abs(F.col("words") - F.col("__gap"))
    top = rest.filter(off < F.col("__gap")).groupBy("source").agg(
        F.min(F.struct(off.alias("off"), F.col("doc_id").isNull().alias("n"), "doc_id", "__h")).alias("__top"))
    plan = plan.alias("p").join(top.alias("t"), F.expr("p.source <=> t.source"), "left").select("p.*", "__top")
    return units, written(plan, "mix-plan")


def _with(units: DataFrame, plan: DataFrame, how: str = "left") -> DataFrame:
    """Documents with their source's parameters (Spark picks the join by measured size and splits a hot source)."""
    kept = [F.col(f"u.`{c}`") for c in units.columns] + [F.col(f"p.`{c}`") for c in plan.columns if c != "source"]
    return units.alias("u").join(plan.alias("p"), F.expr("u.source <=> p.source"), how).select(*kept)


def _in_prefix() -> Column:
    here = F.struct("__q", F.col("doc_id").isNull().alias("n"), "doc_id", "__h")
    return F.col("__q").isNotNull() & (F.col("__stop").isNull() | (here < F.col("__stop")))


def _copies() -> Column:
    top = (F.col("__top.n") == F.col("doc_id").isNull()) & F.col("__top.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("__top.__h") == F.col("__h"))
    more = _in_prefix() | F.coalesce(top, F.lit(False))
    return F.when(F.col("__size") > 0, F.col("__sure") + more.cast("int")).otherwise(F.lit(0)).cast("long")


def mix_counts(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, size, source_size, target, copies and taken (words, repeats counted) per document."""
    units, plan = mix_plan(docs, weights, most)
    judged = _expected(_with(units, plan), most)
    return judged.select(
        "doc_id", F.col("__size").alias("size"), "source_size", "target", _copies().alias("copies"),
        (_copies() * F.col("__size")).alias("taken"))


def mix_sources(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mixed corpus: every document as many times as the mix takes it, with its own columns."""
    _, plan = mix_plan(docs, weights, most)
    named = _units(docs.select(F.struct("*").alias("__row"), "doc_id", "source", "text"))
    times = _expected(_with(named, plan), most).withColumn("__n", _copies()).filter("__n > 0")
    return times.withColumn("__k", F.explode(F.sequence(F.lit(1), F.col("__n").cast("int")))).select("__row.*")
