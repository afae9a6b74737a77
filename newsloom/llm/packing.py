"""Packing into optimal length buckets (operator 7).

A document's length is its number of tokens: those of the BPE vocabulary at ``path``, counted
over the whole text, a given column, or without either its words. One that is longer than
``MAX_LENGTH`` is split into segments of that length, so nothing is cut off; ``start`` is a
segment's offset in tokens. The lengths
of all segments make one histogram, which has ``MAX_LENGTH + 1`` bins at most and is the
only thing the driver sees. Dynamic programming over it chooses the ``BUCKETS`` bucket
boundaries with the least padding, where a segment is padded to its bucket's boundary.
Inside a bucket, batches hold as many segments as a budget of padded tokens allows.

Segments are numbered in a bucket without bringing it to one task: they are dealt by
range of (bucket, hash, number of the row), numbered within each part, and each part adds the sizes of the
parts before it.

Null, empty and blank texts make one segment of length zero. Repeated rows are packed
each, and ties in the hash are ordered by the number of the row. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.common import each_text, landed, small, words_of
from newsloom.llm.transducer import count_tokens

MAX_LENGTH, BUCKETS, BUDGET = 2048, 16, 32_768


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """The upper bounds of the buckets that pad least; at most ``buckets``, the last one is the largest length."""
    order = np.argsort(lengths)
    value, n = lengths[order].astype(np.int64), counts[order].astype(np.int64)
    m = len(value)
    if not m:
        return []
    many, mass = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(n * value)])
    # cost[i, j]: padding if values i to j share a bucket.
    cost = value[None, :] * (many[None, 1:] - many[:-1, None]) - (mass[None, 1:] - mass[:-1, None])
    cost = np.where(np.arange(m)[:, None] <= np.arange(m)[None, :], cost, np.iinfo(np.int64).max // 4)
    best = cost[0]
    choice = []
    for _ in range(min(buckets, m) - 1):
        # Values up to j, where the last bucket begins at i > 0.
        total = np.concatenate([[0], best[:-1]])[:, None] + cost
        choice.append(np.argmin(total, axis=0))
        best = total[choice[-1], np.arange(m)]
    ends, j = [m - 1], m - 1
    for back in reversed(choice):
        i = int(back[j])
        if i == 0:
            break
        j = i - 1
        ends.append(j)
    return [int(value[k]) for k in reversed(ends)]


def segments(docs: DataFrame, length: Column, doc_id: str, longest: int) -> DataFrame:
    """doc_id, segment, start, n_tokens: every document in parts of at most ``longest`` tokens."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), length.cast("long").alias("total"))
    last = F.greatest(F.ceil(F.col("total") / longest) - 1, F.lit(0)).cast("long")
    cut = rows.select("doc_id", "total", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("segment"))
    start = F.col("segment") * longest
    return cut.select("doc_id", "segment", start.alias("start"), F.least(F.col("total") - start, F.lit(longest)).cast("long").alias("n_tokens"))


def packed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: Column | None = None,
           longest: int = MAX_LENGTH, buckets: int = BUCKETS, budget: int = BUDGET, path: str | None = None) -> DataFrame:
    """doc_id, segment, start, n_tokens, bucket (padded length), batch (number in the bucket), slot (place in the batch)."""
    if path is not None:
        docs = each_text(docs, doc_id, text, lambda texts: {"total": count_tokens(texts, path)[1]}, "total long")
        doc_id, length = "doc_id", F.col("total")
    length = F.size(words_of(F.col(text))) if length is None else length
    parts = landed(segments(docs, length, doc_id, longest).withColumn("salt", F.monotonically_increasing_id()), "segments")
    histogram = parts.groupBy("n_tokens").count().collect()
    bounds = boundaries(np.array([r["n_tokens"] for r in histogram]), np.array([r["count"] for r in histogram]), buckets)
    if not bounds:
        bounds = [longest]
    bucket = F.element_at(F.filter(F.array(*[F.lit(b).cast("long") for b in bounds]), lambda b: b >= F.col("n_tokens")), 1)
    keyed = parts.withColumn("bucket", bucket).withColumn("h", F.xxhash64("doc_id", "segment"))
    dealt = landed(keyed.repartitionByRange("bucket", "h", "salt").withColumn("part", F.spark_partition_id()), "dealt")
    within = Window.partitionBy("bucket", "part").orderBy("h", "salt")
    sizes = dealt.groupBy("bucket", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("bucket").alias("b"), F.col("part").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    numbered = dealt.withColumn("place", F.row_number().over(within) - 1).join(
        small(offsets, 24), (F.col("bucket") == F.col("b")) & (F.col("part") == F.col("p")))
    place = F.col("offset") + F.col("place")
    room = F.greatest(F.floor(F.lit(budget) / F.greatest(F.col("bucket"), F.lit(1))), F.lit(1)).cast("long")
    return numbered.select("doc_id", "segment", "start", "n_tokens", "bucket",
                           F.floor(place / room).cast("long").alias("batch"), (place % room).cast("long").alias("slot"))
