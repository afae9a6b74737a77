"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import landed, small

#: Rows of a written table that share a file at least.
FILE_ROWS = 200_000
#: Nodes a task keeps in memory while it folds its links.
FOLDED = 500_000
#: Links that one task folds, in place of rounds over all of them.
FEW = FOLDED // 4


def folded(links: DataFrame) -> DataFrame:
    """Links of the same components, at most one for each node and task."""
    kind = links.schema["a"].dataType.simpleString()

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict = {}

        def find(x):  # noqa: ANN001, ANN202
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
            if len(root) > FOLDED:
                yield stars(root, find, both)
                root.clear()
        yield stars(root, find, both)

    def stars(root: dict, find: Callable, schema: pa.Schema) -> pa.RecordBatch:
        pairs = [(r, x) for x in list(root) if (r := find(x)) != x]
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], schema.field("a").type) for k in (0, 1)], ["a", "b"])

    node = pa.int64() if kind == "bigint" else pa.binary()
    both = pa.schema([("a", node), ("b", node)])
    return links.select("a", "b").mapInArrow(of_batches, f"a {kind}, b {kind}")


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from each node that has a link.

    ``links`` has columns a, b of long or binary. Each task first replaces its own links
    by those from each node to the smallest it knows, at most ``FOLDED`` nodes at a time.
    Then, in rounds, a node takes the smallest label around it and after it the label of
    that label, so long chains shorten by halves. Minima are combined before the shuffle,
    and every round is written, so a node with very many links costs one row for each
    task and a lost executor costs one round. Labels are broadcast while they are few.
    Where no more than ``FEW`` links are left after the folding, whatever the input, one task ends
    the job: rounds are many small stages, and their plans fill the driver's memory.
    """
    # Written first: what makes the links may hold Python workers of its own.
    stars = folded(landed(links.select("a", "b"), "links"))
    both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = landed(folded(both.where("a < b").distinct()), "links")
    rows = both.count()
    if rows <= FEW:
        # Fewer nodes than a task keeps: it links each to the smallest of its component.
        stars = landed(folded(both.coalesce(1)), "labels")
        return stars.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
            stars.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
    files = rows // FILE_ROWS + 1
    both = both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root"))
    labels = landed(labels.coalesce(files), "labels")
    while True:
        known = small(labels, 64)
        around = both.join(known.select(F.col("node").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("near"))
        nearer = around.withColumnRenamed("a", "node").join(known, "node").select("node", "root", F.least("root", "near").alias("near"))
        jump = known.select(F.col("node").alias("near"), F.col("root").alias("far"))
        after = landed(nearer.join(jump, "near").select("node", F.least("near", "far").alias("next"), "root").coalesce(files), "labels")
        done = after.where(F.col("next") != F.col("root")).isEmpty()
        labels = after.select("node", F.col("next").alias("root"))
        if done:
            return labels
