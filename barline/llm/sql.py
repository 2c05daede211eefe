"""SQL for the queries that SQL can express."""

from __future__ import annotations


OP1 = """
WITH good AS (
  SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM good q JOIN good c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

OP2 = """
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
bad AS (
  SELECT doc_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 WHEN toxic IS NOT NULL OR quality IS NOT NULL THEN 0 END) AS bad
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
h0 AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad, string_split(host, '.') AS l
  FROM parts LEFT JOIN bad ON page_id = doc_id GROUP BY host),
h1 AS (
  SELECT host, n, bad, list_aggregate(l[greatest(len(l) - 1, 1):], 'string_agg', '.') IN ('co.uk', 'org.uk', 'com.au', 'co.jp', 'com.br') AS wide, l FROM h0),
hosts AS (
  SELECT host, n, bad,
         list_aggregate(l[greatest(len(l) - CASE WHEN wide THEN 2 ELSE 1 END, 1):], 'string_agg', '.') AS domain,
         list_aggregate(l[greatest(len(l) - CASE WHEN wide THEN 1 ELSE 0 END, 1):], 'string_agg', '.') AS suffix FROM h1),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY domain, suffix),
base AS (SELECT (coalesce(sum(bad), 0) + 0.5::DOUBLE) / (coalesce(sum(n), 0) + 1) AS rate FROM domains),
ends AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(rate) AS p, 0::DOUBLE AS doubt FROM domains, base GROUP BY suffix),
e1 AS (SELECT *, (SELECT sum(n) FROM ends) AS all_n, (SELECT sum(bad) FROM ends) AS all_bad FROM ends),
end_level AS (
  SELECT least(greatest(coalesce(sum(off - free) FILTER (ordinary) / nullif(sum(free * (n - 1)) FILTER (ordinary), 0), 0),
                        1 / (2 + coalesce(sum(n), 0))::DOUBLE), 0.99) AS rho,
         (1 + count(*) FILTER (n >= 5 AND NOT ordinary)) / (100 + count(*) FILTER (n >= 5))::DOUBLE AS share
  FROM (SELECT *, n = all_n OR off <= 25 * free AS ordinary
  FROM (SELECT n, all_n, (bad - n * r) * (bad - n * r) AS off, n * r * (1 - r) * (1 - n / all_n) AS free
        FROM (SELECT *, all_bad / all_n AS r FROM e1 WHERE n > 0)))),
d1 AS (SELECT domain, d.n, d.bad, e.n AS all_n, e.bad AS all_bad, p, doubt FROM domains d JOIN ends e USING (suffix)),
d2 AS (
  SELECT domain, n, bad, (1 - v) * m + v * x AS mean,
         (1 - v) * m * (1 - m) / (k + s + 1) + v * x * (1 - x) / (k + 3) + v * (1 - v) * (m - x) * (m - x) AS variance
  FROM (SELECT *, (h + s * p) / (k + s) AS m, (h + 1) / (k + 2) AS x,
               1 / (1 + exp(least(lgamma(h + s * p) - lgamma(s * p) + lgamma(k - h + s * (1 - p)) - lgamma(s * (1 - p)) - lgamma(k + s) + lgamma(s)
                                  - lgamma(h + 1) - lgamma(k - h + 1) + lgamma(k + 2) + ln((1 - share) / share), 700))) AS v
        FROM (SELECT *, (all_n - n)::DOUBLE AS k, (all_bad - bad)::DOUBLE AS h, 1 / least(rho + doubt, 0.99) - 1 AS s FROM d1, end_level))),
d3 AS (SELECT domain, n, bad, mean AS p, variance / (mean * (1 - mean)) AS doubt FROM d2),
domain_level AS (
  SELECT least(greatest(coalesce(sum(off - free) FILTER (ordinary) / nullif(sum(free * (n - 1)) FILTER (ordinary), 0), 0),
                        1 / (2 + coalesce(sum(n), 0))::DOUBLE), 0.99) AS rho,
         (1 + count(*) FILTER (n >= 5 AND NOT ordinary)) / (100 + count(*) FILTER (n >= 5))::DOUBLE AS share
  FROM (SELECT *, n = all_n OR off <= 25 * free AS ordinary
  FROM (SELECT n, all_n, (bad - n * r) * (bad - n * r) AS off, n * r * (1 - r) * (1 - n / all_n) AS free
        FROM (SELECT *, all_bad / all_n AS r FROM d1 WHERE n > 0)))),
h2 AS (SELECT host, h.n, h.bad, d.n AS all_n, d.bad AS all_bad, p, doubt FROM hosts h JOIN d3 d USING (domain)),
h3 AS (
  SELECT host, n, bad, (1 - v) * m + v * x AS mean,
         (1 - v) * m * (1 - m) / (k + s + 1) + v * x * (1 - x) / (k + 3) + v * (1 - v) * (m - x) * (m - x) AS variance
  FROM (SELECT *, (h + s * p) / (k + s) AS m, (h + 1) / (k + 2) AS x,
               1 / (1 + exp(least(lgamma(h + s * p) - lgamma(s * p) + lgamma(k - h + s * (1 - p)) - lgamma(s * (1 - p)) - lgamma(k + s) + lgamma(s)
                                  - lgamma(h + 1) - lgamma(k - h + 1) + lgamma(k + 2) + ln((1 - share) / share), 700))) AS v
        FROM (SELECT *, (all_n - n)::DOUBLE AS k, (all_bad - bad)::DOUBLE AS h, 1 / least(rho + doubt, 0.99) - 1 AS s FROM h2, domain_level))),
h4 AS (SELECT host, n, bad, mean AS p, variance / (mean * (1 - mean)) AS doubt FROM h3),
host_level AS (
  SELECT least(greatest(coalesce(sum(off - free) FILTER (ordinary) / nullif(sum(free * (n - 1)) FILTER (ordinary), 0), 0),
                        1 / (2 + coalesce(sum(n), 0))::DOUBLE), 0.99) AS rho,
         (1 + count(*) FILTER (n >= 5 AND NOT ordinary)) / (100 + count(*) FILTER (n >= 5))::DOUBLE AS share
  FROM (SELECT *, n = all_n OR off <= 25 * free AS ordinary
  FROM (SELECT n, all_n, (bad - n * r) * (bad - n * r) AS off, n * r * (1 - r) * (1 - n / all_n) AS free
        FROM (SELECT *, all_bad / all_n AS r FROM h2 WHERE n > 0)))),
h5 AS (
  SELECT host, (1 - v) * m + v * x AS mean,
         (1 - v) * m * (1 - m) / (k + s + 1) + v * x * (1 - x) / (k + 3) + v * (1 - v) * (m - x) * (m - x) AS variance
  FROM (SELECT *, (h + s * p) / (k + s) AS m, (h + 1) / (k + 2) AS x,
               1 / (1 + exp(least(lgamma(h + s * p) - lgamma(s * p) + lgamma(k - h + s * (1 - p)) - lgamma(s * (1 - p)) - lgamma(k + s) + lgamma(s)
                                  - lgamma(h + 1) - lgamma(k - h + 1) + lgamma(k + 2) + ln((1 - share) / share), 700))) AS v
        FROM (SELECT *, n::DOUBLE AS k, bad::DOUBLE AS h, 1 / least(rho + doubt, 0.99) - 1 AS s FROM h4, host_level))),
bounds AS (SELECT host, mean - 2.0 * sqrt(variance) AS bound, 3 * rate / (1 - rate) / (1 + 3 * rate / (1 - rate)) AS most FROM h5, base),
ruled AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM parts)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN bound > most THEN 'block' ELSE 'allow' END AS verdict
FROM ruled LEFT JOIN bounds USING (host)
"""

OP4 = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
lengths AS (
  SELECT *, 15 + length(CASE WHEN role IN ('user', 'assistant', 'system', 'tool') THEN role ELSE '@' || url_encode(role) END)
            + length(regexp_replace(text, '(\\*)(### |</turn>)', '\\\1\2', 'g')) AS chars FROM said)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       length(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM lengths GROUP BY conv_id
"""


OP12 = """
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words FROM documents),
firsts AS (SELECT text, min(doc_id) AS first FROM texts GROUP BY text),
fails AS (
  SELECT part, (len(words) < 200)::INTEGER + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INTEGER
         + 4 * (100 * len(regexp_replace(t.text, '[^A-Z]', '', 'g')) > 3 * len(t.text))::INTEGER
         + 8 * regexp_matches(t.text, '[#$%&*|]')::INTEGER + 16 * coalesce(doc_id > first, false)::INTEGER AS mask,
         (doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL))::INTEGER AS good,
         (doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL))::INTEGER AS toxic
  FROM texts t JOIN firsts f ON t.text = f.text),
kinds AS (SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM fails GROUP BY part, mask),
letter AS (SELECT unnest(range(5)) AS i),
orders AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
steps AS (
  SELECT list_aggregate([substr('ABCDE', i + 1, 1) FOR i IN o], 'string_agg', '') AS filter_order, step, o[step] AS f,
         list_sum([1 << i FOR i IN o[:step]]) - (1 << o[step]) AS before FROM orders, range(1, 6) r(step)),
found AS (
  SELECT part, filter_order, step, f,
         sum(CASE WHEN mask & (before | (1 << f)) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & before = 0 AND mask & (1 << f) > 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & before > 0 AND mask & (1 << f) > 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = 1 << f THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & before = 0 AND mask & (1 << f) > 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & before = 0 AND mask & (1 << f) > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM kinds, steps GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM found
"""

OP13 = """
WITH RECURSIVE
polynomial AS (
  SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS t FROM range(256) r(b)),
sums AS (
  SELECT doc_id, text, xor(list_reduce(
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS crc FROM documents, polynomial),
kinds AS (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 16 AS size, crc AS text_crc32, count(*) AS copies
  FROM sums GROUP BY 1, 2, 3),
pieces AS (
  SELECT doc_id, size, text_crc32, least(4096, copies - 4096 * piece) AS copies, piece, coalesce(doc_id::VARCHAR, '') AS name
  FROM (SELECT *, unnest(range((copies - 1) // 4096 + 1)) AS piece FROM kinds)),
keyed AS (
  SELECT *, ('0x' || substr(md5(name), 1, 7))::BIGINT >> 14 AS cell, md5(concat_ws('/', name, size, text_crc32, piece)) AS place FROM pieces),
points AS (
  SELECT shard, ('0x' || substr(md5(shard || '/' || replica), 1, 7))::BIGINT >> 14 AS cell, md5(shard || '/' || replica) AS digest
  FROM range(40) s(shard), range(64) r(replica)),
nodes AS (SELECT row_number() OVER (ORDER BY cell, digest, shard) - 1 AS arc, shard, cell FROM points),
cells AS (
  SELECT c.cell, coalesce((SELECT min(arc) FROM nodes n WHERE n.cell >= c.cell), 0) AS arc FROM (SELECT DISTINCT cell FROM keyed) c),
ranked AS (
  SELECT doc_id, size, text_crc32, arc, copies,
         sum(copies) OVER (PARTITION BY arc ORDER BY cell, place, doc_id, size, text_crc32 ROWS UNBOUNDED PRECEDING) - copies AS first
  FROM keyed JOIN cells USING (cell)),
loads AS (SELECT arc, sum(copies) AS n FROM ranked GROUP BY arc),
total AS (SELECT coalesce(sum(copies), 0) AS n FROM ranked),
filled AS (
  SELECT arc, shard, coalesce(l.n, 0) AS n, t.n // 40 + CASE WHEN shard < t.n % 40 THEN 1 ELSE 0 END AS capacity,
         sum(coalesce(l.n, 0)) OVER (PARTITION BY shard ORDER BY arc ROWS UNBOUNDED PRECEDING) - coalesce(l.n, 0) AS before
  FROM nodes LEFT JOIN loads l USING (arc), total t),
arcs AS (SELECT *, greatest(0, least(n, capacity - before)) AS own FROM filled),
shards AS (SELECT shard, max(capacity) AS capacity, sum(own) AS mine FROM arcs GROUP BY shard),
laps AS (
  SELECT arc, shard, n - own AS over FROM arcs UNION ALL SELECT arc + 40 * 64, shard, 0 FROM arcs),
walk AS (
  SELECT -1::BIGINT AS arc, NULL::BIGINT AS shard, 0::HUGEINT AS held, 0::HUGEINT AS taken,
         (SELECT list((capacity - mine)::HUGEINT ORDER BY shard) FROM shards) AS room
  UNION ALL
  SELECT l.arc, l.shard, w.held + l.over - least(w.held + l.over, w.room[l.shard + 1]), least(w.held + l.over, w.room[l.shard + 1]),
         [CASE WHEN i = l.shard + 1 THEN x - least(w.held + l.over, x) ELSE x END FOR x, i IN w.room]
  FROM walk w JOIN laps l ON l.arc = w.arc + 1),
takes AS (
  SELECT w.shard, taken, sum(taken) OVER (ORDER BY arc ROWS UNBOUNDED PRECEDING) - taken AS got,
         mine + sum(taken) OVER (PARTITION BY w.shard ORDER BY arc ROWS UNBOUNDED PRECEDING) - taken AS base
  FROM walk w JOIN shards USING (shard) WHERE taken > 0),
sent AS (SELECT arc, own, n - own AS over, sum(n - own) OVER (ORDER BY arc ROWS UNBOUNDED PRECEDING) - (n - own) AS sent FROM arcs),
spans AS (
  SELECT arc, 0 AS low, own AS high, shard, before AS base FROM arcs WHERE own > 0
  UNION ALL
  SELECT arc, own + greatest(sent, got) - sent, own + least(sent + over, got + taken) - sent, shard, base + greatest(sent, got) - got
  FROM sent JOIN takes ON sent < got + taken AND got < sent + over),
placed AS (SELECT doc_id, size, text_crc32, arc, first + unnest(range(copies)) AS place FROM ranked)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard::INTEGER AS shard, (base + place - low)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM placed JOIN spans USING (arc) WHERE place >= low AND place < high
"""


def oracle_sql() -> dict[str, str]:
    """SQL by the name of the query."""
    return {"op1_exact_topk": OP1, "op2_url_filters": OP2, "op4_chat_formatting": OP4, "op12_filter_audit": OP12, "op13_sharding": OP13}
