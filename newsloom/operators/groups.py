"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.operators.sizing import broadcast_small
from newsloom.session import checkpointed


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node with a link reaches.

    ``links`` has columns a and b. In every round a node takes the smallest label around
    it and then the label of that label, so long chains shorten by halves. Minima combine
    before the shuffle, and each round is kept in reliable storage.
    """
    one_way = links.select("a", "b").filter("a <> b")
    both = checkpointed(one_way.unionByName(one_way.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = checkpointed(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("root")))
    while True:
        known = broadcast_small(labels)
        around = both.join(known.select(F.col("node").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("near"))
        nearer = around.withColumnRenamed("a", "node").join(known, "node").select("node", "root", F.least("root", "near").alias("near"))
        jump = known.select(F.col("node").alias("near"), F.col("root").alias("far"))
        after = checkpointed(nearer.join(jump, "near").select("node", "root", F.least("near", "far").alias("next")))
        labels = after.select("node", F.col("next").alias("root"))
        if after.filter("next <> root").isEmpty():
            return labels
