"""The two jobs over a store: curate what landed, and publish a digest."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.operators.digest import digest_documents, digest_fragments, digest_items
from newsloom.operators.facts import latest_relevance
from newsloom.operators.inference import Model, classify, summarize
from newsloom.operators.stats import relevance_stats
from newsloom.plans.store import ArticleStore, IngestReport
from newsloom.session import checkpointed


#: Items of one part of a digest.
PART_ITEMS = 1_000


@dataclass(frozen=True)
class Models:
    """A model per stage and tier; a tier set to None is skipped."""

    relevance: Model | None = None
    relevance_fallback: Model | None = None
    summary: Model | None = None
    summary_fallback: Model | None = None


@dataclass(frozen=True)
class RunReport:
    ingest: IngestReport
    processed: int
    retained: int
    summarized: int


def filter_backlog(store: ArticleStore, models: Models, run_key: str) -> tuple[int, int]:
    """Decide every article without a decision; (processed, retained) of the run key."""
    settings = store.settings
    decisions = classify(
        store.open_for_filtering(), models.relevance, models.relevance_fallback,
        model_name=settings.primary_model, fallback_name=settings.fallback_model,
    )
    store.record_relevance(decisions, run_key)
    stats = relevance_stats(latest_relevance(store.of_run("relevance_facts", run_key))).first()
    return stats["processed"], stats["retained"]


def summarize_queue(store: ArticleStore, models: Models, run_key: str) -> int:
    """Summarize the newest relevant articles without a summary; how many the run key holds.

    The limit holds for a run key, so a replay takes no further articles.
    """
    settings = store.settings
    held = store.of_run("summary_facts", run_key).select("link").distinct().count()
    limit = settings.top_n_summaries
    queue = store.open_for_summarization(limit if limit < 0 else max(0, limit - held))
    summaries = summarize(
        queue, models.summary, models.summary_fallback,
        model_name=settings.summary_model, fallback_name=settings.fallback_model,
        max_input_chars=settings.max_input_chars,
    )
    return held + store.record_summaries(summaries, run_key)


def run_curation(
    store: ArticleStore, entries: DataFrame, sources: DataFrame, models: Models, run_key: str,
    pages: DataFrame | None = None,
) -> RunReport:
    """Ingest, then relevance, then summaries; what is left open is kept for the next run.

    A replay of ``run_key`` changes nothing; with new entries the key is continued.
    """
    store.ensure_tables()
    ingest = store.add_entries(entries, sources, run_key, pages)
    processed, retained = filter_backlog(store, models, run_key)
    report = RunReport(ingest, processed, retained, summarize_queue(store, models, run_key))
    store.work.refresh()
    return report


def publish_digest(
    store: ArticleStore, run_key: str,
    deliver: Callable[[str, str], bool] | None = None,
    date: Column | None = None,
) -> int:
    """Write the digest of the newest open articles and mark them as sent; how many the run key marked.

    The selection is stored under the run key, so a replay sends the same articles, less
    those another digest has sent by then, and never others; once all are marked it sends
    nothing. ``deliver(subject, html)`` may hand each part of the document on, one after
    the other; only articles of parts for which it returns True are marked.
    """
    store.ensure_tables()
    settings = store.settings
    sent = store.read("sent_facts")
    chosen = store.digest_selection(run_key, settings.digest_size)
    unsent = chosen.join(sent.select(F.col("article_id").alias("id")), "id", "left_anti")
    if unsent.isEmpty():
        return store.of_run("sent_facts", run_key).count()
    part = F.floor((F.col("rank") - 1) / PART_ITEMS).cast("long")
    items = digest_items(unsent.withColumn("part", part)).withColumn("digest_id", F.lit(run_key))
    store.write_digest(digest_documents(items, date, settings.brand), run_key)
    fragments = digest_fragments(unsent.orderBy("rank")).select("html")
    fragments.write.mode("overwrite").text(f"{store.path('digest_parts')}/run_key={quote(run_key, safe='')}")
    ready = checkpointed(unsent.select("id", part.alias("part")))
    if deliver is not None:
        delivered = -1
        for document in store.of_run("digests", run_key).orderBy("part").toLocalIterator():
            if not deliver(document["subject"], document["html"]):
                break
            delivered = document["part"]
        ready = ready.filter(F.col("part") <= delivered)
    store.mark_sent(ready.select(F.col("id").alias("article_id")), run_key, run_key)
    store.work.refresh()
    return store.of_run("sent_facts", run_key).count()
