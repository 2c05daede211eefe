"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm.common import store


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every id in edges (a, b): the root is the smallest id that can be reached.

    Each round is two aggregations with two joins and is stored; the number of rounds grows with the logarithm of the
    longest path.  Null ends and loops are ignored; no edges give no rows.
    """
    now = store(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = store(large.where("a <> b").distinct(), "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = store(small.union(least.select("a", "m")).distinct(), "edges")
        if after.count() == now.count() and after.exceptAll(now).isEmpty():
            roots = after.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "id")
            return roots.union(roots.select("root", "root").distinct()).distinct()
        now = after
