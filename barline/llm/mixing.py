"""Mixing sources to target weights in blocks of fixed length.

The words of a source, document after document in a pseudorandom order, are packed into blocks of ``BLOCK`` words, the
last one shorter.  The mix is made of output shards of ``SLOTS`` blocks.  Every shard draws multinomial counts of the
sources; the n-th slot of a source takes the block at place n of a pseudorandom permutation of the source's blocks, with
a new permutation each time that all have been taken.  What the independent draws leave short or over is set right at
the end: slots beyond a source's target are not filled, and a closing shard holds those still missing, its last block cut
to the word.  So a source ends at its target, but for its one shorter block, and a block is taken at most once more than
the whole times that the target is the source's size.

Shares follow from weights; a target stops at ``LIMIT`` times the source's size and the excess is dealt out anew.
All draws hash or seed from ``SEED`` and the rows' own values, so reruns agree.  Null texts have no words; null sources
are one source, the last; a source without words has target 0; no rows give no slots.  Rows that are equal in doc_id and
text change places freely.  Sources and their sizes come to the driver: a mixing table is a small thing.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.llm.common import giving_back, store

BLOCK = 256  # words
SLOTS = 1024  # blocks of a shard
LIMIT = 3  # times a source's size
WEIGHTS = (1.0, 2.0, 3.0)  # of the sources in order, repeating
SEED = 7
_BUCKET = 500  # rows, at least, of a bucket of the packing order


def targets(sizes: list[int], weights: list[float], limit: float = LIMIT) -> list[float]:
    """Words to take of each source: all words by weight, none above ``limit`` times its size."""
    total, left = float(sum(sizes)), list(range(len(sizes)))
    out = [0.0] * len(sizes)
    while left:
        rest = total - sum(out[i] for i in range(len(sizes)) if i not in set(left))
        whole = sum(weights[i] for i in left)
        over = [i for i in left if rest * weights[i] / whole > limit * sizes[i]]
        if not over:
            for i in left:
                out[i] = rest * weights[i] / whole
            break
        for i in over:
            out[i] = float(limit * sizes[i])
        left = [i for i in left if i not in set(over)]
    return out


def sized(docs: DataFrame, *columns: str | Column) -> DataFrame:
    """Stores doc_id, source, ``size`` and the packing key of every row, with the given columns."""
    size = F.coalesce(F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")
    return store(docs.select("doc_id", "source", size.alias("size"), F.xxhash64(F.lit(SEED), "doc_id", "text").alias("place"), *columns), "sized")


def plan(rows: DataFrame, weights=WEIGHTS, block: int = BLOCK, limit: float = LIMIT) -> DataFrame:
    """A row for each source: its number, size, target, blocks, whole rounds, words of the last round and slots."""
    found = [(r["source"], int(r["n"])) for r in rows.groupBy("source").agg(F.sum("size").alias("n")).collect()]
    found.sort(key=lambda x: (x[0] is None, x[0] or ""))  # by code point, null last
    sizes = [n for _, n in found]
    wanted = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], limit)
    out = []
    for i, ((source, size), target) in enumerate(zip(found, wanted)):
        words, blocks = round(target), -(-size // block)
        rounds, rest = divmod(words, size) if size else (0, 0)
        out.append((i, source, size, target, blocks, rounds, rest, rounds * blocks + -(-rest // block)))
    return rows.sparkSession.createDataFrame(
        out, "source_no int, source string, source_size long, target double, blocks long, rounds long, rest long, slots long")


def packed(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Adds to each row its source's number, and ``start``, the place of its first word in the source.

    The order is that of the packing key.  Buckets of it are summed first, then the rows in each bucket, so no task
    sees a whole source; both are about the square root of the rows where there are many.
    """
    n = rows.count()
    bits = max(0, int(n / max(_BUCKET, n**0.5)).bit_length() - 1)
    rows = rows.join(planned.select("source_no", F.col("source").alias("s")), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rows = rows.withColumn("bucket", F.shiftrightunsigned("place", 64 - bits) if bits else F.lit(0).cast("long"))
    part = Window.partitionBy("source_no", "bucket")
    order = part.orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("source_no", "bucket").agg(F.sum("size").alias("n")).select(
        "source_no", "bucket", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset"))
    within = rows.withColumn("within", F.coalesce(F.sum("size").over(order), F.lit(0)))
    return within.join(offsets, ["source_no", "bucket"]).withColumn("start", F.col("offset") + F.col("within")).drop(
        "bucket", "offset", "within", "place")


def permuted(n: np.ndarray, place: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Where a keyed pseudorandom permutation of range(n) puts each place: a Feistel network, walked until inside."""
    bits = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << bits) - np.uint64(1)
    out = place.astype(np.uint64)
    inside = np.zeros(len(out), bool)
    size, key = n.astype(np.uint64), key.astype(np.uint64)
    while not inside.all():
        at = ~inside
        b, m, k = bits[at], mask[at], key[at]
        left, right = out[at] >> b, out[at] & m
        for turn in range(4):
            x = (right + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 % 2**64)) ^ k
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((x ^ (x >> np.uint64(31))) & m)
        out[at] = left << b | right
        inside[at] = out[at] < size[at]
    return out.astype(np.int64)


def slots(planned: DataFrame, block: int = BLOCK, shard_slots: int = SLOTS, seed: int = SEED) -> DataFrame:
    """(shard, source_no, nth, round, block, words): every slot of the mix, and how much of its block it takes."""
    spark = planned.sparkSession
    rows = [r for r in planned.orderBy("source_no").collect() if r["slots"]]
    wanted = [r["slots"] for r in rows]
    total = sum(wanted)
    shards = -(-total // shard_slots)
    share = np.array(wanted, float) / max(total, 1)
    numbers = [r["source_no"] for r in rows]

    def draw(batches):
        for batch in batches:
            for shard in batch["id"]:
                counts = np.random.Generator(np.random.Philox(key=[seed, int(shard)])).multinomial(shard_slots, share)
                yield pd.DataFrame({"shard": shard, "source_no": numbers, "n": counts})

    drawn = spark.range(shards).mapInPandas(draw, "shard long, source_no int, n long")
    order = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    drawn = drawn.withColumn("first", F.coalesce(F.sum("n").over(order), F.lit(0)))
    least = planned.where("slots > 0").select("source_no", "blocks", "rounds", "rest", "slots")
    filled = drawn.join(least, "source_no").withColumn("n", F.least("n", F.col("slots") - F.col("first"))).where("n > 0")
    short = least.join(drawn.groupBy("source_no").agg(F.sum("n").alias("all")), "source_no").where("all < slots").select(
        F.lit(shards).cast("long").alias("shard"), "source_no", (F.col("slots") - F.col("all")).alias("n"), F.col("all").alias("first"),
        "blocks", "rounds", "rest", "slots")
    each = filled.select(*short.columns).union(short)
    nth = each.select("shard", "source_no", "blocks", "rounds", "rest", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("nth"))
    nth = nth.withColumn("round", F.floor(F.col("nth") / F.col("blocks"))).withColumn("at", F.col("nth") % F.col("blocks"))

    def place(batches):
        for f in batches:
            key = f["source_no"].to_numpy() * 1_000_003 + f["round"].to_numpy() * 8191 + seed
            f["block"] = permuted(f["blocks"].to_numpy(), f["at"].to_numpy(), key)
            f["words"] = np.where(f["round"] < f["rounds"], block, np.clip(f["rest"] - f["at"] * block, 0, block))
            yield f[["shard", "source_no", "nth", "round", "block", "words"]]

    return nth.mapInPandas(place, "shard long, source_no int, nth long, round long, block long, words long")


def cuts(rows: DataFrame, taken: DataFrame, block: int = BLOCK) -> DataFrame:
    """The pieces of documents that fill the slots: source_no, start, shard, nth, round, and words ``from`` up to ``to``."""
    reach = rows.where("size > 0").select(
        "source_no", "start", "size",
        F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))).alias("block"))
    begin = F.col("block") * block
    both = reach.join(taken, ["source_no", "block"])
    return both.select(
        "source_no", "start", "shard", "nth", "round", F.greatest(F.lit(0), begin - F.col("start")).alias("from"),
        F.least("size", begin + F.col("words") - F.col("start")).alias("to")).where("to > from")


def mix(docs: DataFrame, weights=WEIGHTS, block: int = BLOCK, limit: float = LIMIT) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row: how many of its words the mix holds."""
    rows = sized(docs)
    planned = store(plan(rows, weights, block, limit), "plan")
    placed = store(packed(rows, planned), "packed")
    taken = cuts(placed, slots(planned, block), block).groupBy("source_no", "start").agg(F.sum(F.col("to") - F.col("from")).alias("taken"))
    words = placed.where("size > 0").join(taken, ["source_no", "start"], "left").unionByName(
        placed.where("size = 0").withColumn("taken", F.lit(0).cast("long")))
    return words.join(planned.select("source_no", "source_size", "target"), "source_no").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, block: int = BLOCK, limit: float = LIMIT) -> DataFrame:
    """The mix as rows of ``docs``: a document once for each round that takes of it, with the words that the round takes.

    A document taken whole keeps its text as it is; else its words are joined by blanks.  ``n_chars``, where there is
    such a column, is brought in line.
    """
    fields = docs.schema.fields
    rows = sized(docs, F.struct("*").alias("doc"))
    planned = store(plan(rows, weights, block, limit), "plan")
    placed = store(packed(rows, planned), "packed")
    parts = cuts(placed, slots(planned, block), block).groupBy("source_no", "start", "round").agg(
        F.sort_array(F.collect_list(F.struct("from", "to"))).alias("parts"))
    whole = placed.where("size > 0").join(parts, ["source_no", "start"]).select("doc", "size", "parts")
    names = [f.name for f in fields]

    def cut(batches):
        for batch in batches:
            columns = dict(zip(names, batch["doc"].flatten()))
            texts = []
            for text, size, spans in zip(columns["text"].to_pylist(), batch["size"].to_pylist(), batch["parts"].to_pylist()):
                if sum(s["to"] - s["from"] for s in spans) < size:
                    words = text.encode().split()
                    text = b" ".join(w for s in spans for w in words[s["from"]:s["to"]]).decode()
                texts.append(text)
            columns["text"] = pa.array(texts, pa.string())
            if "n_chars" in columns:
                columns["n_chars"] = pa.array([len(t) for t in texts], columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)

    return whole.mapInArrow(giving_back(cut), T.StructType(fields))
