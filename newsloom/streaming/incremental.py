"""Incremental runs with Structured Streaming.

Feeds may list an item at any later time and there is no lateness bound, so
links are not kept as streaming state: every micro-batch asks the store's index of
links instead. A batch adds to partitions named after itself; a replay finds its links
stored and its rows decided and adds nothing, which makes the results exactly-once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from newsloom.plans.lifecycle import Models, run_curation
from newsloom.plans.store import ArticleStore


def start_ingest(
    store: ArticleStore, entries: DataFrame, sources: DataFrame, checkpoint: str,
    name: str = "ingest", pages: DataFrame | None = None,
) -> StreamingQuery:
    """Insert newly landed entries; stops when everything that has landed is stored."""
    store.ensure_tables()

    def ingest(batch: DataFrame, batch_id: int) -> None:
        store.add_entries(batch, sources, f"{name}-{batch_id}", pages)

    return _start(entries, ingest, checkpoint, name)


def start_curation(
    store: ArticleStore, entries: DataFrame, sources: DataFrame, models: Models, checkpoint: str,
    name: str = "curation", pages: DataFrame | None = None,
) -> StreamingQuery:
    """Ingest, then take whatever has no decision or no summary yet."""
    store.ensure_tables()

    def curate(batch: DataFrame, batch_id: int) -> None:
        run_curation(store, batch, sources, models, f"{name}-{batch_id}", pages)

    return _start(entries, curate, checkpoint, name)


def _start(entries: DataFrame, each_batch, checkpoint: str, name: str) -> StreamingQuery:
    return (
        entries.writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint)
        .queryName(name)
        .trigger(availableNow=True)
        .start()
    )
