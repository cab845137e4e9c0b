"""SQL (DuckDB) for the operator queries that SQL can express."""

from __future__ import annotations

_WORDS = r"[^\x20\x09-\x0D]+"


def _tree(blocks: str, levels: int) -> str:
    """Common table expressions that split the table ``blocks`` (rank, pass, block) among 2 ** levels shards: the last one is ``dealt``."""
    steps = [f"t0 AS (SELECT rank, pass, block, 0 AS lo, {1 << levels} AS hi FROM {blocks})"]
    for k in range(levels):
        low = f"row_number() OVER (PARTITION BY lo ORDER BY md5('mix:{k}:' || rank || ':' || pass || ':' || block)) <= round(count(*) OVER (PARTITION BY lo) / 2)"
        steps.append(f"u{k} AS (SELECT *, {low} AS low, (lo + hi) // 2 AS mid FROM t{k})")
        steps.append(f"t{k + 1} AS (SELECT rank, pass, block, CASE WHEN low THEN lo ELSE mid END AS lo, CASE WHEN low THEN mid ELSE hi END AS hi FROM u{k})")
    steps.append(f"quota AS (SELECT rank, lo, count(*) AS n FROM t{levels} GROUP BY rank, lo), ends AS (SELECT *, sum(n) OVER (PARTITION BY rank ORDER BY lo ROWS UNBOUNDED PRECEDING) AS last FROM quota)")
    steps.append(f"permuted AS (SELECT rank, pass, block, row_number() OVER (PARTITION BY rank ORDER BY md5('mix:permuted:' || rank || ':' || pass || ':' || block)) AS at FROM t{levels})")
    steps.append("dealt AS (SELECT p.rank, p.pass, p.block, e.lo AS shard FROM permuted p JOIN ends e ON e.rank = p.rank AND p.at > e.last - e.n AND p.at <= e.last)")
    return ",\n".join(steps)

ORACLES: dict[str, str] = {
    "op7_warc": """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest, CASE WHEN n >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
CASE WHEN n >= 100 AND first <> page_id THEN first END AS refers_to FROM f""",
    "op8_ngram_join": rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
n AS (SELECT doc_id, len(s) AS n, s FROM s), e AS (SELECT doc_id, n, unnest(s) AS x FROM n),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r AS (SELECT doc_id, doc_id AS c FROM n UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id)
SELECT n.doc_id, n.n::BIGINT AS n_shingles, min(r.c) AS component_id FROM n JOIN r ON r.doc_id = n.doc_id GROUP BY n.doc_id, n.n""",
    "op9_mixing": rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORDS}'))::BIGINT AS size, md5('mix:' || coalesce(doc_id::VARCHAR, 'null')) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS z FROM d GROUP BY source),
k AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s), w AS (SELECT *, [3.0::DOUBLE, 1.0, 2.0][(rank % 3 + 1)::INT] AS weight, z * 2.0::DOUBLE AS cap FROM k),
v AS (SELECT *, (sum(z) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level, row_number() OVER (ORDER BY cap / weight, rank) AS o FROM w WINDOW b AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, z, rank, least(cap, coalesce((SELECT arg_min(level, o) FROM v WHERE level * weight <= cap) * weight, cap)) AS target FROM v),
q AS (SELECT *, CASE WHEN z > 0 THEN round(target)::BIGINT // z ELSE 0 END AS passes FROM t), x AS (SELECT *, round(target)::BIGINT - passes * z AS extra FROM q),
c AS (SELECT d.*, x.z, x.rank, x.target, x.passes, x.extra, ('0x' || substr(key, 1, 3))::INT // 64 AS block, sum(d.size) OVER (PARTITION BY d.source ORDER BY key, d.size ROWS UNBOUNDED PRECEDING) - d.size AS before FROM d JOIN x ON x.source IS NOT DISTINCT FROM d.source),
e AS (SELECT *, greatest(0, least(size, extra - before)) AS more FROM c), last AS (SELECT rank, max(block) AS block FROM e WHERE more > 0 GROUP BY rank),
passes AS (SELECT rank, unnest(generate_series(0, passes)) AS pass, passes FROM x), b AS (SELECT p.rank, p.pass, unnest(generate_series(0, CASE WHEN p.pass < p.passes THEN 63 ELSE l.block END)) AS block FROM passes p LEFT JOIN last l USING (rank) WHERE p.pass < p.passes OR l.block IS NOT NULL),
{_tree("b", 4)},
g AS (SELECT e.doc_id, e.key, string_agg(dealt.shard, ',' ORDER BY dealt.pass) AS shards FROM e JOIN dealt ON dealt.rank = e.rank AND dealt.block = e.block WHERE e.size > 0 AND (dealt.pass < e.passes OR e.more > 0) GROUP BY e.doc_id, e.key)
SELECT e.doc_id, e.size, e.z AS source_size, e.target, (e.passes * e.size + e.more)::BIGINT AS taken, coalesce(g.shards, '') AS shards FROM e LEFT JOIN g ON g.doc_id IS NOT DISTINCT FROM e.doc_id""",
    "op11_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
b AS (SELECT doc_id, n, o, substr(x, 2 * o + 1, 1098) AS x FROM (SELECT *, unnest(range(0, n - 49, 500)) AS o FROM d)),
p AS (SELECT doc_id, o + i AS i, md5(substr(x, 2 * i + 1, 100)) AS h FROM (SELECT *, unnest(range(0, least(500, n - 49 - o))) AS i FROM b)),
f AS (SELECT h, min(doc_id) AS first FROM p GROUP BY h),
u AS (SELECT doc_id, i FROM p JOIN f USING (h) WHERE doc_id > first),
g AS (SELECT doc_id, i, CASE WHEN i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 1 ELSE 0 END AS new FROM u),
k AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS k FROM g),
s AS (SELECT doc_id, k, min(i) AS a, max(i) + 50 AS b FROM k GROUP BY doc_id, k),
e AS (SELECT doc_id, k, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY k), 0) AS before FROM s),
j AS (SELECT doc_id, string_agg(substr(d.x, 2 * before + 1, 2 * (a - before)), '' ORDER BY k) AS head, sum(b - a) AS removed, count(*) AS spans, max(b) AS last FROM e JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(head, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN j USING (doc_id)""",
    "op12_periodic_runs": rf"""
WITH h AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(generate_series(1, length(doc_id::VARCHAR)), lambda i: ascii((doc_id::VARCHAR)[i])::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), generate_series(1, 8)), lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) AS h FROM documents),
g AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS hit, h // 10 AS g FROM h),
a AS (SELECT *, CASE WHEN hit THEN g % n END AS a FROM g), p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
t AS (SELECT doc_id, n, unnest(CASE WHEN hit THEN list_transform(w, lambda x, i: CASE WHEN i - 1 >= a THEN w[a + (i - 1 - a) % p + 1] ELSE x END) ELSE w END) AS word, unnest(range(0, n)) AS i FROM p),
m AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM t x JOIN t y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND y.i - x.i <= x.n // 4),
k AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM m),
s AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM k GROUP BY doc_id, q, k HAVING count(*) + q >= greatest(6, 4 * q)),
r AS (SELECT doc_id, start, length, min(q) AS period FROM s GROUP BY doc_id, start, length),
l AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM r GROUP BY doc_id),
o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) AS o FROM r),
c AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM t WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.doc_id = t.doc_id AND t.i >= r.start + r.period AND t.i < r.start + r.length) GROUP BY doc_id)
SELECT d.doc_id, coalesce(l.n_runs, 0)::BIGINT AS n_runs, o.start::BIGINT AS start, o.length::BIGINT AS length, o.period::BIGINT AS period, (1000 * o.length // o.period)::BIGINT AS exponent_milli, sha256(coalesce(l.lines, '')) AS runs_sha256, sha256(coalesce(c.kept, '')) AS collapsed_sha256
FROM documents d LEFT JOIN l USING (doc_id) LEFT JOIN (FROM o WHERE o = 1) o USING (doc_id) LEFT JOIN c USING (doc_id)""",
    "op13_divergence": r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
w AS (SELECT id, lang, source, unnest(t) AS t FROM d), k AS (SELECT lang, t, count(*) AS n FROM w GROUP BY lang, t HAVING count(DISTINCT id) >= 10),
l AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang), c AS (SELECT w.lang, w.source, w.t, count(*) AS n FROM w JOIN k ON k.lang = w.lang AND k.t = w.t GROUP BY w.lang, w.source, w.t),
s AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY lang, source), g AS (SELECT DISTINCT lang, source FROM d),
p AS (SELECT g.lang, g.source, k.t, coalesce(c.n, 0) AS c, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(s.n, 0) + 2 * l.v) AS p, 1 + (1000000000::HUGEINT * (k.n + 2)) // (l.n + 2 * l.v) AS q
  FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN s ON s.lang = g.lang AND s.source = g.source LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.t = k.t),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce((SELECT sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) FROM p x JOIN p y ON y.lang = x.lang AND y.t = x.t WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  UNION ALL SELECT lang, source, 'term', t, (p - q) * (p - q) // (p + q) FROM p WHERE c > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM o WHERE part = 'pair' OR rank <= 10""",
}
