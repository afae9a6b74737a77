"""Editions from a stream of fetched articles.

Event time is ``fetched_at``. Each edition keeps its best ``size`` articles as state, which
is all a later row can change, so state grows with the editions and not with the articles.
An edition is open until the watermark, the latest ``fetched_at`` less ``delay``, passes
its end. A row of a closed edition is late: it changes nothing and is written as late, so
late rows can be counted and read. Every micro-batch writes the editions it touched to a
folder of its own, which a replay of the batch replaces; the last one of an edition counts.

A row without ``fetched_at`` belongs to no edition, as in the batch form. Ties fall to
the smallest id. Rows that repeat an id count once in an edition.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from newsloom.operators.editorial import TWICE_DAILY

SIZE, DELAY = 15, "1 hour"
ROWS = "edition long, ends long, rank long, id long, published_at string, fetched_us long, late boolean"
STATE = "ids array<long>, published array<string>, fetched array<long>"


def ranked(rows: list[tuple[int, str | None, int]], size: int) -> list[tuple[int, str | None, int]]:
    """The newest of the rows (id, published_at, fetched_us): by date as UTF-8 text, no date last, then by fetch."""
    def order(row: tuple[int, str | None, int]) -> tuple:
        date = row[1].encode() if row[1] is not None else b""
        # Later text first: a text that begins with another is the later one.
        return row[1] is None, [-b for b in date] + [1], -row[2], row[0]

    return sorted({row[0]: row for row in sorted(rows, key=order, reverse=True)}.values(), key=order)[:size]


def edition_rows(size: int):
    """The stateful step: the best rows of an edition so far, or late rows of a closed one."""
    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        edition, ends = int(key[0]), int(key[1])
        closed = state.getCurrentWatermarkMs() >= ends * 1000
        best = list(zip(*state.get, strict=True)) if state.exists else []
        for frame in frames:
            dates = [None if pd.isna(d) else d for d in frame["published_at"]]
            new = list(zip(frame["id"].tolist(), dates, frame["fetched_us"].tolist(), strict=True))
            if closed:
                yield made(edition, ends, new, late=True)
            else:
                best = ranked([*best, *new], size)
        if not closed:
            state.update(tuple(list(column) for column in zip(*best, strict=True)))
            yield made(edition, ends, best, late=False)

    def made(edition: int, ends: int, rows: list, late: bool) -> pd.DataFrame:
        return pd.DataFrame({
            "edition": edition, "ends": ends, "rank": pd.array([None] * len(rows) if late else range(1, len(rows) + 1), "Int64"),
            "id": [r[0] for r in rows], "published_at": pd.Series([r[1] for r in rows], dtype=object),
            "fetched_us": [r[2] for r in rows], "late": late})

    return step


def start_editions(
    articles: DataFrame, path: str, checkpoint: str, size: int = SIZE, every: str = TWICE_DAILY,
    delay: str = DELAY, name: str = "editions",
) -> StreamingQuery:
    """Keeps the editions of a stream (id, published_at, fetched_at) below ``path``; stops when all that landed is read."""
    window = F.window("fetched_at", every)
    dated = articles.filter("fetched_at IS NOT NULL").withWatermark("fetched_at", delay).select(
        F.unix_seconds(window["start"]).alias("edition"), F.unix_seconds(window["end"]).alias("ends"),
        "id", "published_at", F.unix_micros("fetched_at").alias("fetched_us"), "fetched_at")
    kept = dated.groupBy("edition", "ends").applyInPandasWithState(
        edition_rows(size), ROWS, STATE, "update", GroupStateTimeout.NoTimeout)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        kept.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint)
        .queryName(name).trigger(availableNow=True).start()
    )


def _written(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{ROWS}, batch long").parquet(path)


def current_editions(spark: SparkSession, path: str) -> DataFrame:
    """(edition, rank, id): every edition as its last batch left it; ``edition`` is its start in seconds."""
    rows = _written(spark, path).filter("NOT late")
    last = rows.groupBy("edition").agg(F.max("batch").alias("batch"))
    return rows.join(last, ["edition", "batch"]).select("edition", "rank", "id")


def late_articles(spark: SparkSession, path: str) -> DataFrame:
    """(edition, id, fetched_at, batch): the rows that came after their edition was closed."""
    return _written(spark, path).filter("late").select("edition", "id", F.timestamp_micros("fetched_us").alias("fetched_at"), "batch")
