"""Filter audit and sharding against plain Python, and their edge cases; their queries are compared with SQL elsewhere."""

import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from barline.llm import audit, sharding

CLASHES = ("Part", "rid", "digest", "salt", "fails A", "GOOD", "prefix", "copies", "cell", "place", "shard", "arc", "n")


def clashing(df):
    return df.withColumns({c: F.lit(1) for c in CLASHES})


# --- audit ----------------------------------------------------------------------------------------

def plain_fails(text, doc_id, least):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {f for f, bad in {
        "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)), "E": doc_id is not None and doc_id > least.get(text, doc_id)}.items() if bad}


def plain_audit(rows, good, toxic):
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    docs = [(lang or "", plain_fails(text or "", i, least), i in good, i in toxic) for i, text, lang in rows]
    out, shapley = [], Counter()
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        for order in permutations("ABCDE"):
            alive = own
            for step, f in enumerate(order):
                gone = [d for d in alive if f in d[1]]
                alive = [d for d in alive if f not in d[1]]
                fails = sum(f in d[1] for d in own)
                shapley[part, f] += len(gone)
                out.append((part, "".join(order), step + 1, len(alive), len(gone), fails - len(gone), sum(d[1] == {f} for d in own),
                            sum(d[2] for d in gone), sum(d[3] for d in gone)))
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def test_audit_equals_plain_filters(spark):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    pool = [None, "", " \t", "A", "a b " * 150, " ".join(words), " ".join(words) + " #", "\x1cx " * 210, " ".join(w.upper() for w in words), "é\x00|"]
    rows = [(i, rng.choice([*pool, " ".join(rng.choices(words, k=rng.randint(1, 500)))]), rng.choice(["xx", "y", None, ""])) for i in range(120)]
    rows += [(None, pool[5], "y"), (None, pool[5], "y"), (-4, pool[5], "y"), (-4, pool[5], "y"), (500, "same", None), (500, "same", None), (500, "other", "xx")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in [*range(0, 120, 2), 4, 4, 500, -4, None]]
    good, toxic = ({i for i, *v in labels if v[k] == 1 and i is not None} for k in (0, 1))
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    ids = [table.where(c).select("doc_id") for c in ("quality = 1", "toxic = 1")]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5))
    got = audit.audit(*audit.relations(docs, F.coalesce("lang", F.lit("")), *ids))
    assert sorted(map(tuple, got.collect())) == plain_audit(rows, good, toxic)
    empty = docs.limit(0)
    assert audit.audit(*audit.relations(empty, F.coalesce("lang", F.lit("")), *ids)).count() == 0


def test_a_part_without_failures_has_zeros(spark):
    text = " ".join(f"w{k}" for k in range(300))
    docs = spark.createDataFrame([(1, text, "de")], "doc_id long, text string, lang string")
    none = docs.limit(0).select("doc_id")
    rows = audit.audit(*audit.relations(docs, F.col("lang"), none, none)).collect()
    assert len(rows) == 600 and {tuple(r)[3:] for r in rows} == {(1, 0, 0, 0, 0, 0, 0)}


# --- sharding -------------------------------------------------------------------------------------

def rows_of(n, seed=1):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["", None, "é" * rng.randint(1, 9), "text"])) for i in range(n)]
    return rows + [(None, "a"), (None, None), (3, rows[3][1]), (3, "another")]


@pytest.mark.parametrize(("n", "shards"), [(0, 3), (5, 8), (300, 7), (41, 1)])
def test_shards_hold_equal_numbers_without_gaps(spark, n, shards):
    rows = rows_of(n) if n else []
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    got = sharding.assign(docs, shards).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    counts = [len(slots.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert sorted(map(str, got)) == sorted(map(str, sharding.assign(docs.repartition(2), shards).collect()))


def test_many_equal_rows_are_dealt_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PIECE", 10)
    monkeypatch.setattr(sharding, "BUCKET", 5)
    docs = spark.range(700).select(F.when(F.col("id") < 400, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("x").alias("text"))
    got = sharding.assign(docs, 6).collect()
    assert len(got) == 700 and sum(r["doc_id"] == 7 for r in got) == 400
    assert len({(r["shard"], r["slot"]) for r in got}) == 700 and len({r["shard"] for r in got if r["doc_id"] == 7}) >= 4
    assert Counter(Counter(r["shard"] for r in got).values()) == {117: 4, 116: 2}


def test_own_arcs_come_first_and_another_shard_moves_few(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("").alias("text"))
    nodes, cells = sharding.ring(spark, 10)
    owner = cells.join(nodes, "arc").select("cell", F.col("shard").alias("own"))
    place = sharding._leading(F.md5(F.col("doc_id").cast("string").cast("binary")), sharding._bits(10, sharding.REPLICAS))
    owned = docs.select("doc_id", place.alias("cell")).join(owner, "cell")
    counts = [r["count"] for r in owned.groupBy("own").count().collect()]
    found = sharding.assign(docs, 10).join(owned, "doc_id")
    assert found.where("shard <> own").count() == sum(max(0, c - 2000) for c in counts)  # no row leaves that need not
    for slack, most in ((0.0, 0.3), (0.25, 0.13)):
        before, after = (sharding.assign(docs, n, slack).select("doc_id", F.col("shard").alias(f"s{n}")) for n in (10, 11))
        both = before.join(after, "doc_id")
        assert both.where("s10 <> s11").count() < most * 20_000
        assert before.groupBy("s10").count().agg(F.max("count")).first()[0] <= -(-20_000 * (1 + slack) // 10)
