"""URL filters by rules, and by link-graph propagation where no rule fits.

A rule is ``host/path``: it fits its host and all subdomains where the url's path
starts with the rule's path; the longest rule wins (block before allow among rules
of one length and text). Urls that rules decide are the seeds of two walks over the
graph of hosts that link to each other:

- trust, personalised PageRank: mass starts at hosts of allowed urls and follows the
  links, in proportion to their number;
- distrust: mass starts at hosts of blocked urls and follows the links backwards, to
  the hosts that link there.

A host whose distrust exceeds ``RATIO`` times its trust is blocked, others are
allowed. A host's part of the seeds is its part of all decided urls, of pages and
link targets alike, so a blocked host that only appears as a target counts too.

Masses are whole numbers (``SCALE`` in all), products decimals of 38 digits, so sums do
not depend on their order. ``ROUNDS`` rounds run at most; when a round changes no
mass, neither do all later ones, and the walk ends. Mass of hosts without links to
follow is not dealt out again.

Links are the ``href`` values of ``a`` elements that name a host of their own
(``http://``, ``https://`` or ``//``); links inside a host are no edges. All links of a
page and all hosts count. Edges are summed in every task before they are shuffled, so a
host that holds a third of the links is one row per partner and task.

Defined cases: a null url, or one without ``://``, has an empty host and path, fits no
rule, has no links and is allowed; null html has no links; every row is judged, repeated
ones too, and counts among the seeds; an empty table gives no rows. Other columns take
no part.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import written

#: Fixed by the task.
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]

SCALE = 10**15
FOLLOW = 85  # per cent of the mass that follows links
ROUNDS = 20
CUT = 5  # rounds between written states
RATIO = 1

_LINK = r"""(?i)<a[ \t\r\n\f][^<>]*?href[ \t\r\n\f]*=[ \t\r\n\f]*["']?([^"' \t\r\n\f<>]+)"""
_ABSOLUTE = r"^(?i:https?:)?//"


def _lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def _parts(rest: Column) -> tuple[Column, Column]:
    """(host, path) of what follows ``://``."""
    return _lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a url; both empty for null or without ``://``."""
    return _parts(F.when(F.contains(url, F.lit("://")), F.substr(url, F.locate("://", url) + 3)).otherwise(""))


def links(pages: DataFrame) -> DataFrame:
    """(src, host, path) of every link from a page's host to another host."""
    own, _ = host_and_path(F.col("url"))
    found = pages.select(own.alias("src"), F.explode(F.regexp_extract_all("html", F.lit(_LINK), 1)).alias("link"))
    found = found.filter(F.col("link").rlike(_ABSOLUTE) & (F.col("src") != ""))
    host, path = _parts(F.regexp_replace("link", _ABSOLUTE, ""))
    return found.select("src", host.alias("host"), path.alias("path")).filter((F.col("host") != "") & (F.col("host") != F.col("src")))


def fitting_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, fits) of the hosts that rules name: their rules, the longest first."""
    path = F.when(F.contains("rule", F.lit("/")), F.expr("substring(rule, locate('/', rule))")).otherwise("")
    rules = rules.select("verdict", "rule", F.substring_index("rule", "/", 1).alias("ends"), path.alias("start"))
    # no rule names more labels than these
    most = rules.agg(F.max(F.size(F.split("ends", r"\.")))).first()[0] or 1
    labels = F.split("host", r"\.")
    labels = F.slice(labels, F.greatest(F.size(labels) - (most - 1), F.lit(1)), most)
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    named = hosts.select("host", F.explode(ends).alias("ends")).join(rules, "ends")
    order = F.struct((-F.length("rule")).alias("n"), "rule", F.when(F.col("verdict") == "block", 0).otherwise(1).alias("v"), "verdict", "start")
    return named.groupBy("host").agg(F.sort_array(F.collect_set(order)).alias("fits"))


def decide(urls: DataFrame, fitting: DataFrame) -> DataFrame:
    """``urls`` (host, path, ...) with ``rule`` and the rule's ``verdict``, null where none fits."""
    fit = F.expr("filter(fits, x -> startswith(path, x.start))")
    best = F.when(F.size(fit) > 0, fit[0])
    return urls.join(fitting, "host", "left").withColumns({"rule": best["rule"], "verdict": best["verdict"]}).drop("fits")


def _part(n: Column, of: Column, whole: Column) -> Column:
    """floor(n * of / whole), exact."""
    return F.call_function("div", n.cast("decimal(20,0)") * of.cast("decimal(18,0)"), whole.cast("decimal(20,0)"))


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, distrust) from ``edges`` (src, dst, n) and ``seeds`` (host, verdict, n)."""
    total = {r["verdict"]: r["n"] for r in seeds.groupBy("verdict").agg(F.sum("n").alias("n")).collect()}  # two rows
    whole = F.when(F.col("verdict") == "allow", F.lit(total.get("allow", 0))).otherwise(F.lit(total.get("block", 0)))
    seeds = written(seeds.select(F.col("verdict").alias("walk"), "host", _part(F.col("n"), F.lit(SCALE), whole).alias("mass")), "link-seeds")
    ways = [
        edges.select(F.lit("allow").alias("walk"), F.col("src").alias("host"), F.col("dst").alias("to"), "n"),
        edges.select(F.lit("block").alias("walk"), F.col("dst").alias("host"), F.col("src").alias("to"), "n"),
    ]
    ways = ways[0].unionByName(ways[1])
    ways = written(ways.join(ways.groupBy("walk", "host").agg(F.sum("n").alias("all")), ["walk", "host"]), "link-ways")
    base = seeds.select("walk", "host", F.call_function("div", F.col("mass") * F.lit(100 - FOLLOW), F.lit(100)).alias("base"), F.lit(0).cast("long").alias("flow"))

    def walked(state: DataFrame) -> DataFrame:
        flow = state.join(ways, ["walk", "host"]).select("walk", F.col("to").alias("host"), F.lit(0).cast("long").alias("base"), _part(F.col("mass"), F.col("n"), F.col("all")).alias("flow"))
        met = base.unionByName(flow).groupBy("walk", "host").agg(F.sum("base").alias("base"), F.sum("flow").alias("flow"))
        return met.select("walk", "host", (F.col("base") + F.call_function("div", F.col("flow") * F.lit(FOLLOW), F.lit(100))).alias("mass"))

    state, at = seeds, 0
    while at < rounds:
        steps = min(CUT, rounds - at)
        for _ in range(steps - 1):
            state = walked(state)
        before = written(state, "link-state")
        state = written(walked(before), "link-state")
        at += steps
        change = state.join(before.withColumnRenamed("mass", "was"), ["walk", "host"], "full").filter(~F.col("mass").eqNullSafe(F.col("was")))
        if change.isEmpty():
            break
    mass = [F.sum(F.when(F.col("walk") == w, F.col("mass")).otherwise(0)).alias(name) for w, name in (("allow", "trust"), ("block", "distrust"))]
    return state.groupBy("host").agg(*mass)


def judge(pages: DataFrame, rules: list[tuple[str, str]] | DataFrame = RULES, ratio: int = RATIO, rounds: int = ROUNDS) -> DataFrame:
    """page_id, host, path, rule, verdict, and the host's trust and distrust, of every page's url."""
    spark: SparkSession = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(rules, "verdict string, rule string")
    pages = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    # links of one host to one place are one row from here on
    linked = written(links(pages).groupBy("src", "host", "path").agg(F.count("*").alias("n")), "host-links")
    hosts = urls.select("host").union(linked.select("host")).distinct()
    fitting = written(fitting_rules(hosts, rules), "host-rules")
    decided = decide(urls, fitting)
    seeds = decided.select("host", "verdict", F.lit(1).cast("long").alias("n")).unionByName(decide(linked, fitting).select("host", "verdict", "n"))
    seeds = written(seeds.filter(F.col("verdict").isNotNull()).groupBy("host", "verdict").agg(F.sum("n").alias("n")), "url-seeds")
    edges = linked.groupBy("src", F.col("host").alias("dst")).agg(F.sum("n").alias("n"))
    scores = propagate(edges, seeds, rounds)
    out = decided.join(scores, "host", "left").fillna(0, ["trust", "distrust"])
    found = F.when(F.col("distrust") > F.lit(ratio) * F.col("trust"), "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", found).alias("verdict"), "trust", "distrust")
