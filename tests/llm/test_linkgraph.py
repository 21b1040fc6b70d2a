"""Url verdicts against a plain version: rules, link forms, two walks."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import duckdb
from tests.llm.test_operators import clashing
from tidemark.llm import linkgraph
from tidemark.llm.oracles import ORACLES

PAGES = "page_id long, url string, html string"


def split(rest):
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path, rules):
    fits = [(len(r), r, v) for v, r in rules for h, _, p in [r.partition("/")]
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return max(fits)[1:] if fits else (None, None)


def plain(rows, rules=linkgraph.RULES, rounds=20):
    places, seeds, edges = [], {"allow": Counter(), "block": Counter()}, Counter()
    for _, url, html in rows:
        src, path = split(url.split("://", 1)[1]) if url and "://" in url else ("", "")
        places.append((src, path))
        found = re.findall(r"""<a[ \t\r\n\f][^<>]*?href[ \t\r\n\f]*=[ \t\r\n\f]*["']?([^"' \t\r\n\f<>]+)""", html or "", re.I)
        targets = [split(re.sub("^(https?:)?//", "", x, flags=re.I)) for x in found if re.match("(https?:)?//", x, re.I)]
        targets = [t for t in targets if src and t[0] and t[0] != src]
        edges.update((src, h) for h, _ in targets)
        for h, p in [(src, path), *targets]:
            if v := rule_of(h, p, rules)[1]:
                seeds[v][h] += 1
    mass = {}
    for walk, ways in (("allow", edges), ("block", Counter({(b, a): n for (a, b), n in edges.items()}))):
        whole, all_out = sum(seeds[walk].values()), Counter()
        for (a, _), n in ways.items():
            all_out[a] += n
        first = now = {h: n * linkgraph.SCALE // whole for h, n in seeds[walk].items()}
        for _ in range(rounds):
            flow = defaultdict(int)
            for (a, b), n in ways.items():
                if a in now:
                    flow[b] += now[a] * n // all_out[a]
            now = {h: first.get(h, 0) * 15 // 100 + flow[h] * 85 // 100 for h in first.keys() | flow.keys()}
        mass[walk] = now
    out = []
    for (page, *_), (host, path) in zip(rows, places):
        t, d = mass["allow"].get(host, 0), mass["block"].get(host, 0)
        rule, verdict = rule_of(host, path, rules)
        out.append((page, host, path, rule, verdict or ("block" if d > t else "allow"), t, d))
    return Counter(out)


def graph(n=200, seed=1):
    r = random.Random(seed)
    hosts = [f"{a}{b}.{t}" for a in ("", "www.", "M.") for b in ("spam", "news", "x.example") for t in ("com", "net", "org", "example.com")]
    forms = ['<a href="{}">', "<A class=x HREF = '{}' >", "<a\nhref={}>", '<a id="1" href="{}"', "<link href={}>", "<abbr href={}>"]

    def page():
        urls = [r.choice(["http://{}/fr/1", "HTTPS://{}/de/", "//{}", "{}/rel", "https://{}?q=/en/", "#{}", "mailto:{}"]).format(r.choice(hosts)) for _ in range(r.randint(0, 5))]
        return "<p>".join(r.choice(forms).format(u) for u in urls)

    rows = [(i, r.choice(["http://{}/de/{}", "https://{}/en/{}", "http://{}/fr/{}?x#y", "http://{}/{}.html", "http://{}#{}"]).format(r.choice(hosts), i), page()) for i in range(n)]
    rows += [(500, None, "<a href=//a.net/>"), (501, "no scheme.net/", "<a href=//a.net/>"), (502, "x://", None), (503, "http://NET/", ""), (504, "http://net", ""),
             (505, "http://example.net/en/1", None), (506, "ftp://u@example.net:80/en/", None), (507, "http://notexample.net/en/", None),
             (508, "http://a.org/fr/?://b.net/", None), (None, "http://é.org/fr/ü#", None), (509, "http://a.net./", None)]
    return rows + rows[:7]


def columns(df):
    return Counter(tuple(r) for r in df.select("page_id", "host", "path", "rule", "verdict", "trust", "distrust").collect())


def test_verdicts_equal_a_plain_version(spark):
    rows = graph()
    df = clashing(spark.createDataFrame(rows, PAGES), "host", "path", "rule", "verdict", "fits", "src")
    want = plain(rows)
    assert columns(linkgraph.judge(df.repartition(3))) == want
    by_method = {k[4] for k in want if k[3] is None}
    assert by_method == {"allow", "block"}


def test_other_rules(spark):
    rows = graph(60, 2)
    rules = [("allow", "spam.com/"), ("block", "com/"), ("allow", "www.spam.com/de/"), ("block", "org/"), ("allow", "org/"), ("block", "x.example.com/fr/")]
    got = linkgraph.judge(spark.createDataFrame(rows, PAGES), rules)
    want = plain(rows, [r for r in rules if r != ("allow", "org/")])
    assert columns(got) == want


def test_trust_follows_links_and_distrust_goes_against_them(spark):
    """good -> friend; shill -> bad; the neutral host between hears of neither. A chain of hosts takes some rounds."""
    def link(*hosts):
        return "".join(f'<a href="http://{h}/">' for h in hosts)

    rows = [(1, "http://a.org/fr/", link("friend.com")), (2, "http://friend.com/", link("next.com")), (3, "http://next.com/", ""),
            (4, "http://shill.com/", link("bad.net")), (5, "http://far.com/", link("shill.com")), (6, "http://alone.com/", ""),
            (7, "http://torn.com/", link("bad.net")), (8, "http://a.org/fr/2", link("torn.com"))]
    got = {r.host: r for r in linkgraph.judge(spark.createDataFrame(rows, PAGES)).collect()}
    assert got["friend.com"].trust > got["next.com"].trust > 0 == got["next.com"].distrust
    assert got["shill.com"].distrust > got["far.com"].distrust > 0 == got["far.com"].trust
    assert got["torn.com"].trust > 0 < got["torn.com"].distrust
    verdicts = {h: r.verdict for h, r in got.items()}
    assert {h for h, v in verdicts.items() if v == "block"} >= {"shill.com", "far.com"} and verdicts["alone.com"] == verdicts["next.com"] == "allow"


def test_empty_and_linkless_tables(spark):
    empty = spark.createDataFrame([], PAGES)
    assert linkgraph.judge(empty).count() == 0
    rows = [(1, None, None), (2, "http://a.net/x", None), (3, "http://b.com", "")]
    assert columns(linkgraph.judge(spark.createDataFrame(rows, PAGES))) == plain(rows)


def test_the_sql_form_follows_links_too(spark):
    rows = graph(150, 5)
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    got = con.execute(f"SELECT page_id, host, path, rule, verdict, trust, distrust FROM ({ORACLES['op13_url_verdicts']})").fetchall()
    assert Counter(got) == plain(rows)
