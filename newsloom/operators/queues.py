"""Work queues: the rows whose next step is still open, newest first.

``published_at`` is text of mixed formats and is ordered as text; pass
``order_by="published_ts"`` to order by real time. Ties fall to the smallest id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom import constants as C
from newsloom.functions.dates import published_timestamp


def take(df: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` rows; a negative limit means all of them."""
    return df if limit < 0 else df.limit(limit)


#: What a digest shows of an article.
CANDIDATE = ("id", "link", "title", "llm_summary", "source_name", "published_at")


def newest_first(order_by: str, id_column: str = "id") -> list[Column]:
    newest = (
        F.col("published_at") if order_by == "published_at"
        else published_timestamp(F.col("published_at"))
    )
    return [newest.desc_nulls_last(), F.col("fetched_at").desc_nulls_last(), F.col(id_column)]


def needs_relevance() -> Column:
    return F.col("is_ai_relevant").isNull()


def needs_summary() -> Column:
    return F.col("is_ai_relevant") & F.col("llm_summary").isNull()


def ready_for_digest() -> Column:
    return (
        F.col("is_ai_relevant") & F.col("llm_summary").isNotNull()
        & F.col("sent_in_newsletter_at").isNull()
    )


def relevance_backlog(articles: DataFrame) -> DataFrame:
    return (
        articles.filter(needs_relevance())
        .orderBy(F.col("fetched_at").desc_nulls_last(), F.col("id"))
        .select("id", "link", "title", "original_summary")
    )


def summary_queue(
    articles: DataFrame, limit: int = C.SUMMARY_QUEUE_LIMIT, order_by: str = "published_at"
) -> DataFrame:
    queue = articles.filter(needs_summary()).orderBy(*newest_first(order_by))
    return take(queue, limit).select("id", "link", "title", "original_summary")


def digest_candidates(
    articles: DataFrame, limit: int = C.DIGEST_QUEUE_LIMIT, order_by: str = "published_at"
) -> DataFrame:
    queue = articles.filter(ready_for_digest()).orderBy(*newest_first(order_by))
    return take(queue, limit).select(
        "id", "link", "title", "llm_summary", "source_name", "published_at"
    )


def ranked_candidates(
    articles: DataFrame, limit: int, order_by: str = "published_at"
) -> DataFrame:
    """The digest candidates with their place; for a bounded ``limit``.

    The window has no partition key, but it only ever sees the ``limit`` rows
    that the top-k below it kept.
    """
    order = newest_first(order_by)
    top = articles.filter(ready_for_digest()).orderBy(*order).limit(limit)
    return top.select(
        "id", "link", "title", "llm_summary", "source_name", "published_at",
        F.row_number().over(Window.orderBy(*order)).alias("rank"),
    )


def inserted_sample(articles: DataFrame, added: int) -> DataFrame:
    """The last inserted rows with their text length, at most three."""
    return take(
        articles.orderBy(F.col("id").desc()), min(C.INSERTED_SAMPLE_SIZE, added)
    ).select(
        "id", "title", "source_name",
        F.length("original_summary").cast("long").alias("summary_len"),
    )
