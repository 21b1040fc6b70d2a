"""DuckDB statements for the queries that SQL can express."""

_WORDS = r"CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT)"

_OP1 = rf"""
WITH d AS (SELECT doc_id, source, {_WORDS} AS size, md5(coalesce(text, '')) AS h FROM documents),
u AS (SELECT *, (CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || h), 1, 12)) AS BIGINT)::DOUBLE + 0.5)
      / 281474976710656.0::DOUBLE AS u,
      CASE WHEN size > 0 THEN pow(2.0, length(bin(size)) // 2) END AS x FROM d),
s AS (SELECT source, sum(size)::DOUBLE AS source_size FROM u GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS i FROM s),
s2 AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][CAST(i % 3 AS INT) + 1] AS w, source_size * 3.0::DOUBLE AS cap FROM s1),
s3 AS (SELECT *, cap / w AS q FROM s2),
s4 AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY q, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
      / sum(w) OVER (ORDER BY q, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s3),
free AS (SELECT level FROM s4 WHERE q >= level ORDER BY q, i LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN free.level IS NULL OR q <= free.level THEN cap ELSE w * free.level END AS target
      FROM s4 LEFT JOIN free ON true),
c AS (SELECT u.source, t.target, x, sum(size)::DOUBLE AS words FROM u JOIN t ON u.source IS NOT DISTINCT FROM t.source
      WHERE size > 0 GROUP BY ALL),
c1 AS (SELECT *, (target - 3.0::DOUBLE * coalesce(sum(words) OVER (PARTITION BY source ORDER BY x DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
      / sum(words * x) OVER (PARTITION BY source ORDER BY x DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS c FROM c),
f AS (SELECT source, arg_max(c, x) AS c FROM c1 WHERE c * x <= 3.0 GROUP BY source),
e AS (SELECT u.*, t.source_size, t.target,
      CASE WHEN size > 0 AND t.target > 0 THEN least(3.0::DOUBLE, coalesce(f.c, 3.0::DOUBLE) * x) ELSE 0.0::DOUBLE END AS e
      FROM u JOIN t ON u.source IS NOT DISTINCT FROM t.source LEFT JOIN f ON u.source IS NOT DISTINCT FROM f.source),
e1 AS (SELECT *, floor(e) AS sure, e - floor(e) AS p FROM e),
e2 AS (SELECT *, CASE WHEN p > 0 THEN (u / (1.0 - u)) / (p / (1.0 - p)) END AS q,
      target - sum(sure * size) OVER (PARTITION BY source) AS room FROM e1),
g AS (SELECT source, room, q, doc_id, h, sum(size) AS words FROM e2 WHERE q IS NOT NULL GROUP BY ALL),
g1 AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY q, doc_id NULLS LAST, h ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM g),
got AS (SELECT source, max(upto) AS got FROM g1 WHERE upto <= room GROUP BY source),
k AS (SELECT e2.*, coalesce(g1.upto <= e2.room, false) AS pre, e2.room - coalesce(got.got, 0) AS gap
      FROM e2 LEFT JOIN g1 ON e2.source IS NOT DISTINCT FROM g1.source AND e2.q = g1.q AND e2.doc_id IS NOT DISTINCT FROM g1.doc_id AND e2.h = g1.h
      LEFT JOIN got ON e2.source IS NOT DISTINCT FROM got.source),
r AS (SELECT source, gap, doc_id, h, sum(size) AS words FROM k WHERE size > 0 AND sure < 3 AND NOT pre GROUP BY ALL),
top AS (SELECT source, doc_id, h FROM r WHERE abs(words - gap) < gap
      QUALIFY row_number() OVER (PARTITION BY source ORDER BY abs(words - gap), doc_id NULLS LAST, h) = 1)
SELECT k.doc_id, k.size, CAST(k.source_size AS BIGINT) AS source_size, k.target,
  CASE WHEN k.size > 0 THEN CAST(k.sure AS BIGINT) + (k.pre OR top.h IS NOT NULL)::BIGINT ELSE 0 END AS copies,
  CASE WHEN k.size > 0 THEN (CAST(k.sure AS BIGINT) + (k.pre OR top.h IS NOT NULL)::BIGINT) * k.size ELSE 0 END AS taken
FROM k LEFT JOIN top ON k.source IS NOT DISTINCT FROM top.source AND k.doc_id IS NOT DISTINCT FROM top.doc_id AND k.h = top.h
"""

_ESCAPED = r"regexp_replace({}, '<(\\*)\|', '<\\\1|', 'g')"
_OP2 = rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')),
e AS (SELECT *, {_ESCAPED.format('text')} AS body,
  {_ESCAPED.format("replace(replace(role, '%', '%25'), chr(10), '%0A')")} AS head FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(head) + length(body) + {len('<|im_start|>') + 1 + len('<|im_end|>') + 1}) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

_OP3 = """
WITH p AS (SELECT page_id, url, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT *, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest FROM p),
w AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS winner FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN winner IS NULL OR winner IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN winner IS DISTINCT FROM page_id THEN winner END AS refers_to
FROM w
"""

_OP5 = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) > 1 THEN list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) ELSE w END AS s FROM w),
n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM s),
u AS (SELECT doc_id, unnest(s) AS x FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM u a JOIN u b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 80 * (na.n + nb.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a AS x, b AS y FROM e UNION SELECT r.x, e.b FROM r JOIN e ON e.a = r.y),
m AS (SELECT x, min(y) AS y FROM r GROUP BY x)
SELECT doc_id, n AS n_shingles, coalesce(least(doc_id, y), doc_id) AS component_id, coalesce(least(doc_id, y), doc_id) = doc_id AS kept
FROM n LEFT JOIN m ON m.x = doc_id
"""

_OP4 = """
WITH v AS (SELECT DISTINCT vec_id, [floor(64 * CAST(x AS DOUBLE)) for x in embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""

_OP11 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
  sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
h AS (SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || x[1:8] AS BIGINT) AS h1, CAST('0x' || x[9:16] AS BIGINT) AS h2,
  CAST('0x' || x[17:24] AS BIGINT) AS h3, CAST('0x' || x[25:32] AS BIGINT) AS h4 FROM d),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
       WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h),
s AS (SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
         ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM s
"""

_OP12 = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
k AS (SELECT lang, term, count(*) AS total FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 30),
v AS (SELECT lang, count(*) AS v, sum(total) AS ln FROM k GROUP BY lang),
x AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.total FROM g JOIN k USING (lang)
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
gn AS (SELECT lang, source, sum(n) AS gn FROM x GROUP BY ALL),
p AS (SELECT x.lang, x.source, x.term, x.n, 1 + (1000000000::HUGEINT * (x.n + 5)) // (gn.gn + 5 * v.v) AS p,
  1 + (1000000000::HUGEINT * (x.total + 5)) // (v.ln + 5 * v.v) AS q
  FROM x JOIN gn USING (lang, source) JOIN v USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pairs.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM found QUALIFY part = 'pair' OR rank <= 50
"""

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _walks(rounds: int = 20) -> str:
    """The rounds of both walks, one statement each."""
    out = []
    for i in range(1, rounds + 1):
        out.append(f"""s{i} AS MATERIALIZED (SELECT walk, host, CAST(sum(base) + (sum(flow) * 85) // 100 AS BIGINT) AS mass FROM (
  SELECT walk, host, (mass * 15) // 100 AS base, 0 AS flow FROM s0
  UNION ALL SELECT w.walk, w.dst, 0, CAST((s.mass::HUGEINT * w.n) // w.whole AS BIGINT) FROM s{i - 1} s JOIN ways w ON w.walk = s.walk AND w.host = s.host) GROUP BY ALL)""")
    return ",\n".join(out)


_OP13 = rf"""
WITH p AS (SELECT row_number() OVER () AS r, page_id, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT r, page_id, html, translate(regexp_extract(rest, '^([^/?#]*)', 1), {_AZ}) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
a AS (SELECT host AS src, unnest(regexp_extract_all(html, '<a[ \t\r\n\f][^<>]*?href[ \t\r\n\f]*=[ \t\r\n\f]*["'']?([^"'' \t\r\n\f<>]+)', 1, 'i')) AS link FROM u),
b AS (SELECT src, regexp_replace(link, '^(https?:)?//', '', 'i') AS rest FROM a WHERE regexp_matches(link, '^(https?:)?//', 'i') AND src <> ''),
l AS (SELECT -row_number() OVER () AS r, src, translate(regexp_extract(rest, '^([^/?#]*)', 1), {_AZ}) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM b),
links AS (SELECT * FROM l WHERE host <> '' AND host <> src),
rules (v, rule, ends, start) AS (VALUES ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
  ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')),
urls AS (SELECT r, host, path FROM u UNION ALL SELECT r, host, path FROM links),
fit AS (SELECT r, host, rule, v FROM urls JOIN rules ON (host = ends OR ends_with(host, '.' || ends)) AND starts_with(path, start)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY length(rule) DESC) = 1),
seeds AS (SELECT v AS walk, host, count(*) AS n FROM fit GROUP BY ALL),
s0 AS MATERIALIZED (SELECT walk, host, CAST((n::HUGEINT * 1000000000000000) // sum(n) OVER (PARTITION BY walk) AS BIGINT) AS mass FROM seeds),
edges AS (SELECT src, host AS dst, count(*) AS n FROM links GROUP BY ALL),
both_ways AS (SELECT 'allow' AS walk, src AS host, dst, n FROM edges UNION ALL SELECT 'block', dst, src, n FROM edges),
ways AS MATERIALIZED (SELECT *, sum(n) OVER (PARTITION BY walk, host) AS whole FROM both_ways),
{_walks()},
m AS (SELECT host, CAST(coalesce(sum(mass) FILTER (walk = 'allow'), 0) AS BIGINT) AS trust, CAST(coalesce(sum(mass) FILTER (walk = 'block'), 0) AS BIGINT) AS distrust FROM s20 GROUP BY host)
SELECT u.page_id, u.host, u.path, fit.rule, coalesce(fit.v, CASE WHEN m.distrust > m.trust THEN 'block' ELSE 'allow' END) AS verdict,
  coalesce(m.trust, 0) AS trust, coalesce(m.distrust, 0) AS distrust
FROM u LEFT JOIN fit ON fit.r = u.r LEFT JOIN m ON m.host = u.host
"""

ORACLES = {
    "op13_url_verdicts": _OP13,
    "op12_source_divergence": _OP12,
    "op11_fill_in_middle": _OP11,
    "op4_exact_top_k": _OP4,
    "op5_near_duplicates": _OP5,
    "op3_warc": _OP3,
    "op2_chat_format": _OP2,
    "op1_mix_sources": _OP1,
}
