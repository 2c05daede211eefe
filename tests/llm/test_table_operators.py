"""Top-k search, URL filters, Jaccard join, chat formatting and mixing against plain Python, and their edge cases."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from barline.llm import chat, jaccard, mixing, queries, sql, topk, urls
from barline.llm.components import components
from catalog.check import compare, connect

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string"


@pytest.mark.parametrize("name", sorted(sql.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    df = queries.queries()[name](spark, SF)
    result = connect(SF).execute(sql.oracle_sql()[name])
    assert compare(df.columns, [tuple(r) for r in df.collect()], [d[0] for d in result.description], result.fetchall()) == ""


# --- top-k ----------------------------------------------------------------------------------------

def plain_search(rows, k, every):
    used = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            used[i] = min(used.get(i, v), v)
    whole = {i: [math.floor(64 * x) for x in v] for i, v in used.items()}
    out = set()
    for q, v in whole.items():
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), c) for c, w in whole.items() if c != q and len(w) == len(v))
            out |= {(q, rank + 1, c, -s) for rank, (s, c) in enumerate(scores[:k])}
    return out


def test_search_over_tiles_equals_a_plain_search(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([0.0, 0.5, -0.25, rng.gauss(0, 1)]) for _ in range(3)]) for i in range(120)]
    rows += [(200, None), (205, []), (210, [1.0, None, 2.0]), (215, [1.0, math.nan, 2.0]), (220, [math.inf, 0.0, 0.0]), (None, [1.0] * 3),
             (225, [1.0, 2.0]), (230, [1.0, 3.0]), (5, rows[5][1]), (7, [9.0, 9.0, 9.0]), (235, [1.0] * 4)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("SCORE", F.lit(1)).withColumn("block", F.lit(1))
    vectors = topk.quantised(table)
    got = topk.search(vectors, F.col("vec_id") % 5 == 0, k=4, block=7, shard=9)
    assert sorted(map(tuple, got.collect())) == sorted(plain_search(rows, 4, 5))
    assert topk.search(vectors.limit(0), F.col("vec_id") % 5 == 0).count() == 0


def test_large_components_stay_exact(spark):
    rows = [(0, [2.0**40, 1.0]), (1, [2.0**40 + 1, 0.5]), (2, [-(2.0**52), 1.0]), (3, [1e30, 0.0])]
    got = topk.search(topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), F.col("vec_id") == 0, k=3).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 2**63 - 1), (0, 2, 3, 2**63 - 1), (0, 3, 2, 1 - 2**63)]


# --- URL filters ----------------------------------------------------------------------------------

def test_rules_and_parts(spark):
    cases = [
        ("http://A.Example.NET/en/x?y", "a.example.net", "/en/x", "example.net/en/", "allow"),
        ("https://example.net/de/", "example.net", "/de/", "net/", "block"),
        ("https://notexample.net/en/", "notexample.net", "/en/", "net/", "block"),
        ("http://x.example.com/de/1#t", "x.example.com", "/de/1", "example.com/de/", "block"),
        ("http://ÄB.org/fr/", "Äb.org", "/fr/", "org/fr/", "allow"),
        ("http://net?q=/", "net", "", None, "allow"),
        ("http://a.net", "a.net", "", None, "allow"),
        ("no url", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("://", "", "", None, "allow"),
    ]
    pages = spark.createDataFrame([(i, c[0], "x") for i, c in enumerate(cases)], "page_id long, url string, host string")
    labels = spark.createDataFrame([(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    got = {r["page_id"]: tuple(r)[1:5] for r in urls.judge(pages, labels).collect()}
    assert got == {i: c[1:] for i, c in enumerate(cases)}
    assert urls.judge(pages.limit(0), labels.limit(0)).count() == 0
    assert urls.judge(pages, labels.limit(0)).count() == len(cases)


def test_bad_hosts_are_blocked_and_unknown_ones_follow_their_domain(spark):
    pages, labels, n = [], [], 0
    for host, size, bad in (("spam.evil.com", 40, 38), ("shop.evil.com", 30, 29), ("a.fine.com", 60, 1), ("b.fine.com", 3, 2), ("fine.org", 50, 2)):
        for i in range(size):
            pages.append((n, f"http://{host}/{i}"))
            labels.append((n, int(i >= bad), 0))
            n += 1
    pages += [(n, "http://new.evil.com/"), (n + 1, "http://new.fine.com/"), (n + 1, "http://new.fine.com/")]
    found = urls.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    verdicts = {(r["host"], r["verdict"]) for r in found.collect()}
    assert verdicts == {("spam.evil.com", "block"), ("shop.evil.com", "block"), ("a.fine.com", "allow"), ("b.fine.com", "allow"),
                        ("fine.org", "allow"), ("new.evil.com", "block"), ("new.fine.com", "allow")}
    assert found.count() == len(pages)


def plain_posterior(n, bad, p, doubt, rho, share):
    s = 1 / min(rho + doubt, 0.99) - 1
    g = math.lgamma
    alike = g(bad + s * p) - g(s * p) + g(n - bad + s * (1 - p)) - g(s * (1 - p)) - g(n + s) + g(s)
    strange = g(bad + 1) + g(n - bad + 1) - g(n + 2)
    v = 1 / (1 + math.exp(min(700, alike - strange + math.log((1 - share) / share))))
    parts = ((1 - v, bad + s * p, n - bad + s * (1 - p)), (v, bad + 1, n - bad + 1))
    mean = sum(w * a / (a + b) for w, a, b in parts)
    square = sum(w * a * (a + 1) / (a + b) / (a + b + 1) for w, a, b in parts)
    return mean, square - mean * mean


def plain_level(members):
    """(rho, share) of members (n, bad, n of the parent, bad of the parent)."""
    top = below = total = many = strange = 0
    for n, bad, all_n, all_bad in members:
        if not n:
            continue
        p = all_bad / all_n
        off, free = (bad - n * p) ** 2 * (n < all_n), n * p * (1 - p) * (1 - n / all_n)
        total, many = total + n, many + (n >= 5)
        if n == all_n or off <= 25 * free:
            top, below = top + off - free, below + free * (n - 1)
        else:
            strange += n >= 5
    return min(max(top / below if below else 0.0, 1 / (2 + total)), 0.99), (1 + strange) / (100 + many)


def plain_reputations(counts):
    """{host: (mean, variance)} of {host: (n, bad)}; hosts of one-label suffixes."""
    domain, end = {h: ".".join(h.split(".")[-2:]) for h in counts}, {h: h.split(".")[-1] for h in counts}
    total = lambda keys, k: tuple(sum(c[i] for h, c in counts.items() if keys[h] == k) for i in (0, 1))
    less = lambda a, b: (a[0] - b[0], a[1] - b[1])
    prior = lambda m, v: (m, v / (m * (1 - m)))
    n, bad = (sum(c[i] for c in counts.values()) for i in (0, 1))
    base = (bad + 0.5) / (n + 1)
    ends = {e: total(end, e) for e in set(end.values())}
    domains = {d: total(domain, d) for d in set(domain.values())}
    fit = plain_level([(*c, n, bad) for c in ends.values()])
    above = {d: prior(*plain_posterior(*less(ends[d.split(".")[-1]], c), base, 0.0, *fit)) for d, c in domains.items()}
    fit = plain_level([(*c, *ends[d.split(".")[-1]]) for d, c in domains.items()])
    own = {h: prior(*plain_posterior(*less(domains[domain[h]], c), *above[domain[h]], *fit)) for h, c in counts.items()}
    fit = plain_level([(*c, *domains[domain[h]]) for h, c in counts.items()])
    return {h: plain_posterior(*c, *own[h], *fit) for h, c in counts.items()}, base


def outcomes_of(spark, counts):
    """Pages and labels of hosts {host: (n, bad)}, with a column whose name clashes with the operator's own."""
    rows = [(h, i < bad) for h, (n, bad) in counts.items() for i in range(n)] + [(h, None) for h, (n, _) in counts.items() if not n]
    pages = spark.createDataFrame([(i, f"http://{h}/") for i, (h, _) in enumerate(rows)], "page_id long, url string")
    labels = spark.createDataFrame([(i, int(not b), 0) for i, (_, b) in enumerate(rows) if b is not None], "doc_id long, quality int, toxic int")
    return pages.withColumn("bad", F.lit(5)).withColumn("P", F.lit(0.5)), labels.withColumn("host", F.lit("x")).withColumn("N", F.lit(1))


def test_posteriors_equal_plain_ones(spark):
    rng = random.Random(3)
    counts = {}
    for e, rate in (("com", 0.2), ("org", 0.3), ("xyz", 0.9)):
        for d in range(6):
            for h in range(rng.choice([1, 2, 5])):
                n = rng.choice([0, 1, 2, 7, 30])
                counts[f"h{h}.d{d}.{e}"] = (n, sum(rng.random() < rate for _ in range(n)))
    counts["only.bad.com"] = (40, 40)
    counts["only.good.xyz"] = (40, 0)
    pages, labels = outcomes_of(spark, counts)
    found, base = urls.reputations(pages.select("page_id", urls.host_of(F.col("url")).alias("host")), labels)
    want, rate = plain_reputations(counts)
    got = {r.host: r for r in found.collect()}
    assert base == pytest.approx(rate) and set(got) == set(want)
    for host, (mean, variance) in want.items():
        assert (got[host].n, got[host].bad) == counts[host]
        assert got[host].mean == pytest.approx(mean, rel=1e-6) and got[host].variance == pytest.approx(variance, rel=1e-5)


def test_wholly_bad_hosts_stand_out_among_very_many(spark):
    """Fifty bad pages of fifty are blocked among 50 000 hosts whose rates differ by chance only, and these are let through."""
    hosts = spark.range(50_000).select(F.concat(F.lit("www.h"), F.col("id").cast("string"), F.lit(".com")).alias("host"), F.explode(F.sequence(F.lit(1), F.lit(20))).alias("k"))
    bad = spark.range(10).select(F.concat(F.lit("www.evil"), F.col("id").cast("string"), F.lit(".com")).alias("host"), F.explode(F.sequence(F.lit(1), F.lit(50))).alias("k"))
    rows = hosts.withColumn("wrong", F.pmod(F.xxhash64("host", "k"), F.lit(100)) < 26).unionByName(bad.withColumn("wrong", F.lit(True)))
    rows = rows.withColumn("page_id", F.xxhash64("host", "k"))
    pages = rows.select("page_id", F.concat(F.lit("http://"), "host", F.lit("/")).alias("url"))
    labels = rows.select(F.col("page_id").alias("doc_id"), (~F.col("wrong")).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    judged = urls.judge(pages, labels)
    blocked = {r.host for r in judged.where("verdict = 'block'").select("host").distinct().collect()}
    assert blocked == {f"www.evil{i}.com" for i in range(10)}
    assert judged._jdf.queryExecution().executedPlan().toString().count("Exchange") < 40


def test_few_bad_pages_make_no_bad_host(spark):
    counts = {f"h{i}.d{i % 40}.org": (12, 3) for i in range(120)} | {"one.x.org": (1, 1), "two.y.org": (2, 2), "four.z.org": (12, 4), "all.w.org": (30, 30)}
    pages, labels = outcomes_of(spark, counts)
    verdicts = {r.host: r.verdict for r in urls.judge(pages, labels).collect()}
    assert {h for h, v in verdicts.items() if v == "block"} == {"all.w.org"}
    with duckdb.connect() as con:
        con.register("pages", pages.toPandas())
        con.register("labels", labels.toPandas())
        assert {r[1]: r[4] for r in con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({sql.OP2})").fetchall()} == verdicts


@pytest.mark.parametrize("x", [1e-7, 0.01, 0.5, 1.0, 3.7, 50.0, 1e4, 1e9])
def test_log_gamma(spark, x):
    assert spark.range(1).select(urls.log_gamma(F.lit(x)).alias("y")).first().y == pytest.approx(math.lgamma(x), rel=1e-9, abs=1e-8)


# --- Jaccard join ---------------------------------------------------------------------------------

def plain_shingles(text):
    words = (text or "").split(" ")
    words = [w for w in words if w]
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def plain_join(rows):
    sets = [plain_shingles(t) for _, t in rows]
    near = defaultdict(set)
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                near[a].add(b)
                near[b].add(a)
                root[max(top(a), top(b))] = min(top(a), top(b))
    groups = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        groups[top(i)].append(doc)
    return Counter((doc, min(groups[top(i)]), len(near[i])) for i, (doc, _) in enumerate(rows))


def near_copies(seed, families, copies):
    rng = random.Random(seed)
    rows = []
    for _ in range(families):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(60, 200))]
        for _ in range(rng.randint(1, copies)):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5, 9])):
                own[rng.randrange(len(own))] = f"v{rng.randrange(10**6)}"
            rows.append(" ".join(own))
    rng.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)]


def test_join_equals_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", 3)
    rows = near_copies(2, 60, 12)
    n = len(rows)
    rows += [(n, None), (n + 1, ""), (n + 2, " "), (n + 3, "one two"), (n + 4, "one two"), (n + 5, "one two three"), (n + 6, "x " * 30_000), (n + 7, "x " * 30_001)]
    table = spark.createDataFrame([(i, t, None, None) for i, t in rows], DOCS).withColumn("bands", F.lit("clash"))
    got = Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard.joined(table).collect())
    assert got == plain_join(rows)
    kept = jaccard.deduplicated(table)
    assert kept.columns == table.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c, _ in plain_join(rows)})


def test_join_of_repeated_rows_and_ids(spark):
    text, other = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, text), (1, text), (1, other), (2, other), (None, text), (None, None), (3, "unlike anything else in here")]
    table = spark.createDataFrame([(i, t, None, None) for i, t in rows], DOCS)
    got = Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard.joined(table).collect())
    assert got == Counter([(1, 1, 2), (1, 1, 2), (1, 1, 1), (2, 1, 1), (None, 1, 2), (None, None, 0), (3, 3, 0)])
    assert Counter(r["doc_id"] for r in jaccard.deduplicated(table).collect()) == Counter([1, None, 3])
    assert jaccard.joined(table.limit(0)).count() == 0 == jaccard.deduplicated(table.limit(0)).count()


def test_pruning_never_asks_for_more_than_chance_gives():
    need = jaccard.least_matches()
    assert need == sorted(need) and all(m < 0.8 * n for m, n in zip(need, range(30, 151, 30)))


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3)]
    found = {r["id"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(30)}


# --- chat formatting ------------------------------------------------------------------------------

CONTROL = ["### ", "</turn>", "\n</turn>\n", "\\", "\\### ", "\\\\</turn>", "### User: ", "#### ", "</turn", "é", "a", "\n", " "]


def test_any_text_comes_back(spark):
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", "odd: role\n###", ""]), "".join(rng.choice(CONTROL) for _ in range(rng.randint(0, 8))))
            for c in range(80) for t in range(rng.randint(1, 6))]
    rows += [(-7, t, r, "\\### Assistant: </turn> ok") for t, r in enumerate(["user", "assistant"])]
    rows += [(900, None, None, None), (900, 1, "assistant", None), (900, 1, "assistant", "b"), (900, 1, "assistant", "b"), (None, 0, "user", "x" * 200_000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("Formatted", F.lit("clash"))
    chats = chat.formatted(table)
    got = {r["conv_id"]: tuple(r)[1:] for r in chat.digests(chats).collect()}
    texts = {r["conv_id"]: r["formatted"] for r in chats.collect()}
    groups = defaultdict(list)
    for c, t, r, x in rows:
        groups[c].append((t is not None, t or 0, r or "", x or ""))

    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()

    for c, turns in groups.items():
        turns.sort()
        said = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        assert got[c] == (len(turns), sha(said), len(loss), sha(loss), len(texts[c])), c
    assert texts[-7] == "### User: \\\\### Assistant: \\</turn> ok\n</turn>\n### Assistant: \\\\### Assistant: \\</turn> ok\n</turn>\n"
    assert chat.digests(chat.formatted(table.limit(0))).count() == 0


def test_the_parser_rejects_what_the_grammar_does_not_know(spark):
    broken = ["### Nobody: hi\n</turn>\n", "no header\n</turn>\n", "### User: a ### User: b\n</turn>\n"]
    found = spark.createDataFrame([(b,) for b in broken], "t string").select(chat.parse(F.col("t")).alias("p")).collect()
    assert all(r["p"] == [None] for r in found)


# --- mixing ---------------------------------------------------------------------------------------

def test_targets_stop_at_the_limit():
    assert mixing.targets([100, 100, 100], [1, 2, 3]) == pytest.approx([50, 100, 150])
    assert mixing.targets([10, 1000, 10], [1, 2, 3]) == pytest.approx([30, 960, 30])
    assert mixing.targets([0, 10], [1, 2]) == [0, 10] and mixing.targets([0, 0], [1, 2]) == [0, 0] and mixing.targets([], []) == []


def test_permutations_hit_every_place_once():
    for n in (1, 2, 3, 17, 1000):
        for key in (0, 5):
            assert sorted(mixing.permuted(np.full(n, n), np.arange(n), np.full(n, key)).tolist()) == list(range(n))


def corpus(spark, seed=4):
    rng = random.Random(seed)
    rows = [(i, " ".join("w" * rng.randint(1, 9) for _ in range(rng.choice([0, 1, 5, 80, 300, 2000]))), None, f"s{i % 3 if i % 2 else 0}") for i in range(200)]
    rows += [(500, None, None, "s1"), (501, "two words", None, None), (7, rows[7][1], None, rows[7][3]), (None, "a b c", None, "s2"), (502, None, None, "empty")]
    return spark.createDataFrame(rows, DOCS).withColumn("SIZE", F.lit("clash")), rows


def test_the_mix_meets_its_targets(spark):
    table, rows = corpus(spark)
    found = mixing.mix(table).collect()
    assert len(found) == len(rows)
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len((text or "").split())
    order = sorted((s for s in sizes if s is not None)) + [None]
    wanted = dict(zip(order, mixing.targets([sizes[s] for s in order], [1.0 + i % 3 for i in range(len(order))])))
    taken, by_id = Counter(), {r[0]: r[3] for r in rows}
    for r in found:
        source = by_id[r["doc_id"]]
        assert r["source_size"] == sizes[source] and r["target"] == pytest.approx(wanted[source])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[source] += r["taken"]
    for source, target in wanted.items():
        assert abs(taken[source] - target) <= mixing.BLOCK
    again = mixing.mix(table.repartition(7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, found))
    assert mixing.mix(table.limit(0)).count() == 0


def test_mixed_documents_hold_the_words_that_were_taken(spark):
    table, rows = corpus(spark, 5)
    table = table.withColumn("n_chars", F.length("text").cast("long"))
    mixed = mixing.mixed_documents(table)
    assert mixed.columns == table.columns
    taken, words = Counter(), {r[0]: (r[1] or "").split() for r in rows}
    for r in mixed.collect():
        taken[r["doc_id"]] += len(r["text"].split())
        assert r["n_chars"] == len(r["text"]) and set(r["text"].split()) <= set(words[r["doc_id"]])
    want = Counter()
    for r in mixing.mix(table).collect():
        want[r["doc_id"]] += r["taken"]
    assert taken == +want
