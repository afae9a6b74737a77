"""Exact duplicates through an extendible-hash index (operator 2, DataFrame only).

Two texts are equal when they are the same after every space character of
``[\\x20\\x09-\\x0D]`` is deleted. Each text has a 64-bit hash, and the hashes are the
keys of an extendible-hash index on shared files. The directory has ``2 ** depth``
slots; it doubles while one of its buckets holds more than ``CAPACITY`` keys, and only
overfull buckets are split. Bucket loads count distinct keys, so copies, however many,
never overfill a bucket. Only keys that occur twice or more reach the index files: for
these the owner task of each key range chains the different texts under one hash by
comparing their bytes, and copies are combined before the shuffle.

Null counts as empty, and all empty texts are equal. Of equal texts the one with the
most code points in the original stays, then the smallest doc_id; a null doc_id comes
last. Rows that repeat both the text and the doc_id share their verdict in
``classes`` (and are all marked kept if theirs stays); ``deduplicated`` returns one of
them. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import SPACE, landed, scratch, small

#: Distinct keys a bucket holds before it is split.
CAPACITY = 50_000
#: The directory has 2 ** MAX_DEPTH slots at most; beyond that buckets grow.
MAX_DEPTH = 20


def normal(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE + "+", "")


def slot(key: Column, depth: int) -> Column:
    """The leading ``depth`` bits of a key."""
    return F.call_function("shiftrightunsigned", key, F.lit(64 - depth)) if depth else F.lit(0).cast("long")


def directory(keys: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """(slot, bucket, local_depth) for all slots in use, and the depth of the directory.

    ``keys`` has one row for each distinct ``h``. A bucket is named by its local depth
    and its leading bits.
    """
    loads = landed(keys.groupBy(slot(F.col("h"), MAX_DEPTH).alias("fine")).agg(F.count("*").alias("n")), "loads")

    def load(depth: int) -> DataFrame:
        shift = MAX_DEPTH - depth
        return loads.groupBy(F.shiftright("fine", shift).alias("slot")).agg(F.sum("n").alias("n"))

    depth = 0
    while depth < MAX_DEPTH and not load(depth).where(F.col("n") > capacity).isEmpty():
        depth += 1
    slots = load(depth).select("slot")
    # A slot's bucket is the shallowest prefix that is not overfull.
    local = F.lit(depth)
    for d in reversed(range(depth)):
        full = small(load(d).where(F.col("n") <= capacity).select(F.col("slot").alias("prefix")), 8)
        slots = slots.join(full, F.shiftright("slot", depth - d) == F.col("prefix"), "left")
        slots = slots.withColumnRenamed("prefix", f"p{d}")
    for d in reversed(range(depth)):
        local = F.when(F.col(f"p{d}").isNotNull(), F.lit(d)).otherwise(local)
    table = slots.select("slot", local.cast("int").alias("local_depth"))
    prefix = F.call_function("shiftright", F.col("slot"), F.lit(depth) - F.col("local_depth"))
    return table.select("slot", F.concat_ws("-", "local_depth", prefix).alias("bucket"), "local_depth"), depth


def keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    rows = docs.select(F.struct("*").alias("row"), normal(F.col(text)).alias("norm"), F.col(doc_id).alias("doc_id"),
                       F.char_length(F.coalesce(F.col(text), F.lit(""))).alias("points"))
    return rows.withColumn("h", F.xxhash64("norm"))


def index(rows: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, DataFrame]:
    """The keys that occur twice or more, and the index over their texts on shared files.

    An index row is one different text: h, norm, keep_id, group_size.
    """
    loads = rows.groupBy("h").agg(F.count("*").alias("n"))
    repeated = landed(loads.where("n > 1").select("h"), "repeated")
    slots, depth = directory(repeated, capacity)
    repeated = small(repeated, 16)
    slots = landed(slots, "directory")
    candidates = rows.join(repeated, "h", "left_semi").select("h", "norm", "points", "doc_id")
    # ~doc_id reverses the order of ids, so that one maximum finds the row that stays.
    chained = candidates.groupBy("h", "norm").agg(
        F.max(F.struct("points", F.bitwise_not("doc_id").alias("back"))).alias("best"), F.count("*").alias("group_size"))
    entries = chained.select("h", "norm", F.bitwise_not(F.col("best.back")).alias("keep_id"), "group_size",
                             slot(F.col("h"), depth).alias("slot"))
    owned = entries.join(small(slots, 32), "slot").select("bucket", "h", "norm", "keep_id", "group_size")
    path = scratch(rows.sparkSession, "hash-index")
    owned.repartitionByRange("bucket", "h").sortWithinPartitions("bucket", "h").write.partitionBy("bucket").parquet(path)
    schema = "h long, norm string, keep_id long, group_size long, bucket string"
    return repeated, rows.sparkSession.read.schema(schema).parquet(path)


def looked_up(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", capacity: int = CAPACITY) -> tuple[DataFrame, DataFrame]:
    """Rows whose text occurs once, and rows with the index entry of their text."""
    rows = keyed(docs, text, doc_id)
    repeated, entries = index(rows, capacity)
    single = rows.join(repeated, "h", "left_anti")
    e = entries.select(F.col("h").alias("eh"), F.col("norm").alias("en"), "keep_id", "group_size")
    several = rows.join(repeated, "h", "left_semi").join(e, (F.col("h") == F.col("eh")) & (F.col("norm") == F.col("en")))
    return single, several


def classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row."""
    single, several = looked_up(docs, text, doc_id, capacity)
    sha = F.sha2("norm", 256).alias("text_sha256")
    one = single.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), sha)
    more = several.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), sha)
    return one.unionByName(more)


def deduplicated(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """One document of each class, with its own columns."""
    single, several = looked_up(docs, text, doc_id, capacity)
    stays = several.where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    ordered = stays.groupBy("h", "norm").agg(F.max_by("row", "points").alias("row"))
    return single.select("row.*").unionByName(ordered.select("row.*"))
