"""Insert-if-new by link, and dense ids in arrival order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.session import checkpointed

ARRIVAL = ["source_ordinal", "entry_ordinal"]


def first_arrivals(entries: DataFrame) -> DataFrame:
    """(link, source_ordinal, entry_ordinal) of the first entry of every link.

    Works on the key columns only and combines before the shuffle, so a link
    that fills a third of the entries costs one row per task.
    """
    arrival = F.min(F.struct(*ARRIVAL))
    return (
        entries.filter(F.coalesce(F.col("link"), F.lit("")) != "")
        .groupBy("link")
        .agg(arrival.alias("first"))
        .select("link", "first.*")
    )


def new_arrivals(entries: DataFrame, stored: DataFrame) -> DataFrame:
    """First arrivals whose link the store does not hold yet."""
    return new_arrivals_of(first_arrivals(entries), stored)


def new_arrivals_of(firsts: DataFrame, stored: DataFrame) -> DataFrame:
    return firsts.join(stored.select("link"), "link", "left_anti")


def with_dense_ids(rows: DataFrame, order_by: list[str], start: int | Column) -> DataFrame:
    """Number ``rows`` from ``start`` in the given order, without gaps.

    Rows are range-partitioned and sorted in parallel, then written once to the
    checkpoint folder so both uses below see the same partitions. The offsets
    table has one row per partition.
    """
    position = F.monotonically_increasing_id()
    ordered = checkpointed(
        rows.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("part", F.shiftright(position, 33))
        .withColumn("place", position.bitwiseAND(F.lit((1 << 33) - 1)))
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ordered.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
        .select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    )
    start = start if isinstance(start, Column) else F.lit(start)
    return (
        ordered.join(F.broadcast(offsets), "part")
        .withColumn("id", (start + F.col("offset") + F.col("place")).cast("long"))
        .drop("part", "place", "offset")
    )


def select_arrivals(entries: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Full rows of the chosen arrivals.

    Joining on the whole arrival key keeps copies of a hot link apart. Entries
    that repeat a whole key collapse to one row.
    """
    key = ["link", *ARRIVAL]
    return entries.join(arrivals, key).dropDuplicates(key)


def next_id(stored: DataFrame) -> int:
    """First free id of the store: one aggregate over the id column."""
    return (stored.agg(F.max("id").alias("id")).first()["id"] or 0) + 1
