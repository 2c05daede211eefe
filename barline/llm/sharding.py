"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has a power of two of cells.  Every shard stands on it ``REPLICAS`` times, at the first digits of the MD5 of
``shard/replica``; a document stands at the first digits of the MD5 of its id and belongs to the next virtual node
clockwise.  A shard takes the documents of its own arcs, arc after arc, as far as its capacity goes.  The rest is carried
clockwise: every virtual node that is passed takes of it what its shard still has room for, those that came furthest
first.  Nothing is carried twice around, since the room of all shards is at least the number of rows, and as few rows as
possible leave their own shard.

Without ``slack`` the capacities are the rows divided by the shards, one more for the first shards if they do not divide:
counts then differ by at most one, which is the law ``rows``.  With it a capacity is 1 + slack times the mean, rounded up:
loads are bounded by that, and another shard moves fewer rows.

Only counts by cell decide, so nothing depends on the order of the input and reruns agree.  Rows are ranked in buckets of a
cell, and the buckets are summed; neither a cell nor a shard is ever sorted in one task.  Rows alike in doc_id, size and
checksum are counted, not repeated, until they have their slots, at most ``PIECE`` of them together; so an id or a text that
fills a third of the table is no hot key.  The ring (cells, virtual nodes, what is carried) is of a fixed size for a number
of shards, and is all that is broadcast.

Null texts have no bytes: size 16, checksum 0.  Rows without doc_id stand where the MD5 of an empty text does, like one hot
id.  Equal rows change places freely.  No rows give no rows; further columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barline.llm.common import store

REPLICAS = 64  # virtual nodes of a shard
ROOMY = 4  # cells, at least, for each virtual node
BUCKET = 2000  # rows, about, that are ranked together
PIECE = 4096  # equal rows that are handled together
OVERHEAD = 16  # bytes of a document besides its text


def _bits(shards: int, replicas: int) -> int:
    """Of the cells' numbers; at most 28 can be read from seven digits."""
    return min(28, (shards * replicas * ROOMY - 1).bit_length())


def _leading(digest: Column, bits: int) -> Column:
    """The first bits of an MD5 in hexadecimal digits."""
    return F.shiftright(F.conv(F.substring(digest, 1, 7), 16, 10).cast("long"), 28 - bits)


def ring(spark: SparkSession, shards: int, replicas: int = REPLICAS) -> tuple[DataFrame, DataFrame]:
    """The virtual nodes (arc, shard) numbered clockwise, and the arc of every cell (cell, arc)."""
    bits = _bits(shards, replicas)
    digest = F.md5(F.concat_ws("/", "shard", "replica").cast("binary"))
    nodes = spark.range(shards * replicas).select(
        F.floor(F.col("id") / replicas).cast("int").alias("shard"), (F.col("id") % replicas).alias("replica"))
    nodes = nodes.withColumn("digest", digest).withColumn("cell", _leading(F.col("digest"), bits))
    nodes = nodes.withColumn("arc", F.row_number().over(Window.orderBy("cell", "digest", "shard")) - 1)
    first = nodes.groupBy("cell").agg(F.min("arc").alias("arc"))
    back = Window.orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = spark.range(1 << bits).withColumnRenamed("id", "cell").join(first, "cell", "left")
    cells = cells.select("cell", F.coalesce(F.last("arc", ignorenulls=True).over(back), F.lit(0)).alias("arc"))
    return nodes.select("arc", "shard"), cells


def keyed(docs: DataFrame, bits: int) -> DataFrame:
    """Stores the different rows: doc_id, size, text_crc32, how many ``copies``, the cell, and ``place``, a digest that orders
    a cell.  Rows with more than ``PIECE`` copies become several, each with a place of its own."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    piece = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / PIECE))).alias("piece")
    rows = rows.select("*", piece).withColumn("copies", F.least(F.lit(PIECE), F.col("copies") - F.col("piece") * PIECE))
    place = F.md5(F.concat_ws("/", name, "size", "text_crc32", "piece").cast("binary"))
    rows = rows.select("doc_id", "size", "text_crc32", "copies", _leading(F.md5(name.cast("binary")), bits).alias("cell"), place.alias("place"))
    return store(rows, "keyed")


def _capacity(total: Column, shards: int, slack: float) -> Column:
    """Rows that a shard may hold."""
    if slack:
        return F.ceil(total * (1 + slack) / shards).cast("long")
    return F.floor(total / shards).cast("long") + F.when(F.col("shard") < total % shards, 1).otherwise(0)


def _carried(arcs: DataFrame) -> DataFrame:
    """(arc, shard, taken) in the order in which carried rows are taken, from (arc, shard, over, room, shards).

    One row holds the ring as an array; it is walked twice, the second time only with what is left over from the first.
    """
    laps = arcs.groupBy("shards").agg(
        F.sort_array(F.collect_list(F.struct("arc", "shard", "over"))).alias("nodes"),
        F.sort_array(F.collect_set(F.struct("shard", "room"))).alias("rooms"))
    again = F.transform("nodes", lambda n: F.struct(n["arc"].alias("arc"), n["shard"].alias("shard"), F.lit(0).cast("long").alias("over")))
    start = F.struct(F.lit(0).cast("long").alias("held"), F.transform("rooms", lambda r: r["room"]).alias("room"),
                     F.array().cast("array<struct<arc:int,shard:int,taken:bigint>>").alias("takes"))

    def step(state, node):
        held = state["held"] + node["over"]
        taken = F.least(held, state["room"][node["shard"]])
        room = F.when(taken > 0, F.transform(state["room"], lambda x, i: F.when(i == node["shard"], x - taken).otherwise(x))).otherwise(state["room"])
        took = F.array(F.struct(node["arc"].alias("arc"), node["shard"].alias("shard"), taken.alias("taken")))
        takes = F.when(taken > 0, F.concat(state["takes"], took)).otherwise(state["takes"])
        return F.struct((held - taken).alias("held"), room.alias("room"), takes.alias("takes"))

    walked = laps.select(F.aggregate(F.concat("nodes", again), start, step, lambda s: s["takes"]).alias("takes"))
    return walked.select(F.posexplode("takes").alias("turn", "t")).select("turn", "t.arc", "t.shard", "t.taken")


def _spans(nodes: DataFrame, counts: DataFrame, shards: int, slack: float) -> DataFrame:
    """(arc, low, high, shard, base): the ranks of an arc that a shard takes, and the slot of the first of them.

    ``counts`` has the rows of every cell.
    """
    total = F.sum("n").over(Window.partitionBy())
    arcs = nodes.join(counts.groupBy("arc").agg(F.sum("n").alias("n")), "arc", "left").select("arc", "shard", F.coalesce("n", F.lit(0)).alias("n"))
    arcs = arcs.withColumn("capacity", _capacity(total, shards, slack))
    order = Window.partitionBy("shard").orderBy("arc").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(order), F.lit(0))
    own = F.greatest(F.lit(0), F.least("n", F.col("capacity") - F.col("before")))
    arcs = arcs.withColumn("before", before).withColumn("own", own).withColumn("over", F.col("n") - F.col("own"))
    mine = F.sum("own").over(Window.partitionBy("shard"))
    arcs = store(arcs.withColumn("mine", mine), "arcs")
    takes = _carried(arcs.select("arc", "shard", "over", (F.col("capacity") - F.col("mine")).alias("room"), F.lit(shards).alias("shards")))

    queue = Window.orderBy("arc").rowsBetween(Window.unboundedPreceding, -1)
    sent = arcs.where("over > 0").withColumn("sent", F.coalesce(F.sum("over").over(queue), F.lit(0))).select("arc", "own", "over", "sent")
    turn = Window.orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    filled = Window.partitionBy("shard").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    taken = takes.select("shard", "taken", F.coalesce(F.sum("taken").over(turn), F.lit(0)).alias("got"),
                         F.coalesce(F.sum("taken").over(filled), F.lit(0)).alias("filled"))
    taken = taken.join(arcs.groupBy("shard").agg(F.max("mine").alias("mine")), "shard")
    low, high = F.greatest("sent", "got"), F.least(F.col("sent") + F.col("over"), F.col("got") + F.col("taken"))
    # both sides are pieces of the ring: its size is fixed by the number of shards
    moved = sent.join(F.broadcast(taken), (F.col("sent") < F.col("got") + F.col("taken")) & (F.col("got") < F.col("sent") + F.col("over"))).select(
        "arc", (F.col("own") + low - F.col("sent")).alias("low"), (F.col("own") + high - F.col("sent")).alias("high"), "shard",
        (F.col("mine") + F.col("filled") + low - F.col("got")).alias("base"))
    stay = arcs.where("own > 0").select("arc", F.lit(0).cast("long").alias("low"), F.col("own").alias("high"), "shard",
                                        F.col("before").alias("base"))
    return stay.unionByName(moved)


def assign(docs: DataFrame, shards: int, slack: float = 0.0, replicas: int = REPLICAS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row of ``docs``; slots of a shard run from 0 without a gap."""
    nodes, cells = ring(docs.sparkSession, shards, replicas)
    rows = keyed(docs, _bits(shards, replicas))
    found = rows.groupBy("cell").agg(F.sum("copies").alias("n"), F.count("*").alias("kinds"))
    digits = F.greatest(F.lit(0), F.least(F.lit(28), F.ceil(F.log2(F.col("kinds") / BUCKET)))).cast("int")  # of a bucket's number
    ahead = Window.partitionBy("arc").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = store(cells.join(found, "cell").withColumns({
        "buckets": F.pow(F.lit(2), digits), "ahead": F.coalesce(F.sum("n").over(ahead), F.lit(0))}), "counts")
    spans = store(_spans(nodes, counts, shards, slack), "spans")

    dealt = rows.join(F.broadcast(counts.select("cell", "arc", "ahead", "buckets")), "cell")  # at most a row for each cell
    dealt = dealt.withColumn("bucket", F.floor(_leading(F.col("place"), 28) * F.col("buckets") / (1 << 28)))
    order = Window.partitionBy("cell", "bucket").orderBy("place", "doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    within = dealt.withColumn("within", F.coalesce(F.sum("copies").over(order), F.lit(0)))
    earlier = Window.partitionBy("cell").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("cell", "bucket").agg(F.sum("copies").alias("n")).select(
        "cell", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    ranked = within.join(offsets, ["cell", "bucket"]).select(
        "doc_id", "size", "text_crc32", "arc", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("nth"),
        (F.col("ahead") + F.col("offset") + F.col("within")).alias("first"))
    rank = F.col("first") + F.col("nth")
    span = F.broadcast(spans.withColumnRenamed("arc", "of"))
    return ranked.join(span, (F.col("arc") == F.col("of")) & (rank >= F.col("low")) & (rank < F.col("high"))).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("base") + rank - F.col("low")).alias("slot"))
