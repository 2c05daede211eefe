"""Filter interaction audit: what each filter of a chain removes, in every order of the chain, from relations of failing ids.

Every filter has a stored table of the ids that fail it.  Survivors of a prefix are the ids left after a left-anti join with
each of its filters, so they depend on the set of filters and not on their order: five joins in a row, before each of
which the prefixes so far are doubled by the same prefixes with one more filter, give the survivors of all 32 sets.  A left-semi join of
these with a filter's table gives what the filter removes after each prefix; what it would have removed but for the
prefix is redundant; what it removes after all others fails it only.  Labels are id tables too, joined to the rows
by semi joins once.

Rows that fail nothing survive every prefix: anti joins take them out first and they are counted once, so what is
joined again and again grows with the failing rows.  All joins are on the row's own number, which no two rows share; it is
fixed by storing the rows.  Equal texts are found by their SHA-256: the smallest id is formed in two steps, by digest and a
salt of the row and then by digest, and comes back to rows by digest and salt, so a text that fills a third of the table is
dealt out.  What is gathered of the relations are counts by part, prefix and filter.

Null texts are empty texts.  Null ids have no smaller id and are no smaller id; rows that share an id count each, and are no
copies of one another.  Null parts are the part ''.  No rows give no parts; a part whose rows fail nothing has zeros.
Columns of other names are not looked at.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations, permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barline.llm.common import store

SALT = 64  # parts of the rows that have the same text
_WORD = "[^\\x20\\x09-\\x0D]+"


def conditions(text: Column) -> dict[str, Column]:
    """When a text by itself fails a filter, by the filter's letter."""
    words = F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))
    n_words, distinct = F.size(words), F.size(F.array_distinct(words))
    return {
        "A": n_words < 200,
        "B": 100 * distinct < 50 * n_words,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 3 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def copies(rows: DataFrame) -> DataFrame:
    """The ids ``rid`` of rows (rid, doc_id, digest) whose digest a smaller doc_id has too."""
    named = rows.where("doc_id IS NOT NULL").withColumn("salt", F.pmod(F.xxhash64("rid"), F.lit(SALT)))
    salted = named.groupBy("digest", "salt").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    shared = salted.groupBy("digest").agg(F.min("least").alias("first"), F.max("most").alias("last")).where("first < last")
    first = salted.select("digest", "salt").join(shared.select("digest", "first"), "digest")
    return named.join(first, ["digest", "salt"]).where("doc_id > first").select("rid")


def relations(docs: DataFrame, part: Column, good: DataFrame, toxic: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The rows (rid, part, good, toxic), and by filter the stored table of the failing ``rid``.

    ``good`` and ``toxic`` hold the doc_id of documents with that label.
    """
    text = F.coalesce("text", F.lit(""))
    tests = conditions(text)
    measured = docs.select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", part.alias("part"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        *(test.alias(f"fails {name}") for name, test in tests.items()))
    measured = store(measured, "measured")
    failing = {name: store(measured.where(F.col(f"fails {name}")).select("rid"), f"fails-{name}") for name in tests}
    failing["E"] = store(copies(measured.select("rid", "doc_id", "digest")), "fails-E")
    rows = measured.select("rid", "doc_id", "part")
    for name, ids in (("good", good), ("toxic", toxic)):
        marked = rows.select("rid", "doc_id").join(ids, "doc_id", "left_semi").select(F.col("rid").alias("marked"))
        rows = rows.join(marked, F.col("rid") == F.col("marked"), "left").withColumn(name, F.col("marked").isNotNull().cast("int")).drop("marked")
    return store(rows.drop("doc_id"), "rows"), failing


def survivors(rows: DataFrame, failing: dict[str, DataFrame]) -> DataFrame:
    """The rows with ``prefix``, a bit for each filter, once for every set of filters that they all pass."""
    found = rows.withColumn("prefix", F.lit(0))
    for number, ids in enumerate(failing.values()):
        both = found.withColumn("applied", F.explode(F.array(F.lit(0), F.lit(1 << number))))  # the prefix without and with the filter
        gone = (F.col("rid") == F.col("gone")) & (F.col("applied") > 0)
        found = both.join(ids.withColumnRenamed("rid", "gone"), gone, "left_anti").withColumn(
            "prefix", F.col("prefix").bitwiseOR(F.col("applied"))).drop("applied")
    return found


def removals(rows: DataFrame, failing: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(part, prefix, kept) and (part, prefix, filter, removed, good, toxic), without zeros.

    ``prefix`` is the set of filters applied before, as bits; ``filter`` is a number.
    """
    letters = list(failing)
    anyhow = reduce(DataFrame.union, failing.values())
    failed = rows.join(anyhow, "rid", "left_semi")
    clean = rows.join(anyhow, "rid", "left_anti").groupBy("part").agg(F.count("*").alias("kept"))
    alive = store(survivors(failed, failing), "survivors")
    kept = alive.groupBy("part", "prefix").agg(F.count("*").alias("kept"))
    every = clean.select("part", F.explode(F.sequence(F.lit(0), F.lit(2 ** len(letters) - 1))).alias("prefix"), "kept")
    kept = kept.unionByName(every).groupBy("part", "prefix").agg(F.sum("kept").alias("kept"))
    removed = []
    for number, ids in enumerate(failing.values()):
        before = alive.where(F.col("prefix").bitwiseAND(F.lit(1 << number)) == 0)
        removed.append(before.join(ids, "rid", "left_semi").groupBy("part", "prefix").agg(
            F.count("*").alias("removed"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")).withColumn("filter", F.lit(number)))
    return kept, reduce(DataFrame.unionByName, removed)


def audit(rows: DataFrame, failing: dict[str, DataFrame]) -> DataFrame:
    """part, filter_order and step with kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley."""
    spark, letters = rows.sparkSession, list(failing)
    n = len(letters)
    kept, removed = (store(t, name) for t, name in zip(removals(rows, failing), ("kept", "removed")))
    steps = [("".join(letters[i] for i in order), k + 1, sum(1 << i for i in order[:k]), order[k])
             for order in permutations(range(n)) for k in range(n)]  # 600 for five filters, whatever the rows
    sets = [(sum(1 << i for i in before), f, factorial(len(before)) * factorial(n - 1 - len(before)))
            for f in range(n) for k in range(n) for before in combinations([i for i in range(n) if i != f], k)]
    pairs = F.array(*(F.struct(F.lit(p).alias("prefix"), F.lit(f).alias("filter"), F.lit(w).cast("long").alias("orders")) for p, f, w in sets))
    whole = rows.select("part").distinct().select("part", F.inline(pairs))
    whole = whole.join(removed, ["part", "prefix", "filter"], "left").na.fill(0, ["removed", "good", "toxic"])
    whole = whole.withColumn("after", F.col("prefix").bitwiseOR(F.pow(F.lit(2), "filter").cast("int")))
    whole = whole.join(kept.withColumnRenamed("prefix", "after"), ["part", "after"], "left").na.fill(0, ["kept"])
    own = Window.partitionBy("part", "filter")
    alone = F.max(F.when(F.col("prefix") == 0, F.col("removed"))).over(own)
    only = F.max(F.when(F.col("after") == 2**n - 1, F.col("removed"))).over(own)
    whole = whole.withColumns({
        "redundant": alone - F.col("removed"), "unique_fails": only, "shapley": F.sum(F.col("orders") * F.col("removed")).over(own)})
    orders = spark.createDataFrame(steps, "filter_order string, step int, prefix int, filter int")
    return whole.join(F.broadcast(orders), ["prefix", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"), "shapley")
