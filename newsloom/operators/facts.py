"""Append-only decisions, and the current state read from them.

Relevance and summary: the last writer wins. Sent: the first writer wins. All
three reduce to one row per key with aggregates that combine before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom import schemas


def latest_relevance(facts: DataFrame) -> DataFrame:
    return _latest(facts, is_ai_relevant="is_ai_relevant", ai_filter_model_used="model")


def latest_summary(facts: DataFrame) -> DataFrame:
    return _latest(facts, llm_summary="llm_summary", summarizer_model_used="model")


def _latest(facts: DataFrame, **columns: str) -> DataFrame:
    newest = F.max(F.struct(
        F.col("decided_at"), F.col("run_key"),
        *[F.col(source).alias(name) for name, source in columns.items()],
    ))
    return facts.groupBy("link").agg(newest.alias("newest")).select(
        "link", "newest.decided_at", *[f"newest.{name}" for name in columns]
    )


def first_sent(facts: DataFrame) -> DataFrame:
    """First mark of an article: by link if the marks carry it, else by id."""
    key = F.col("link") if "link" in facts.columns else F.col("article_id").alias("id")
    return facts.groupBy(key).agg(F.min("sent_at").alias("sent_in_newsletter_at"))


def with_relevance(articles: DataFrame, decisions: DataFrame) -> DataFrame:
    return _with_decision(
        articles, latest_relevance(decisions), "is_ai_relevant", "ai_filter_model_used"
    )


def with_summary(articles: DataFrame, summaries: DataFrame) -> DataFrame:
    return _with_decision(
        articles, latest_summary(summaries), "llm_summary", "summarizer_model_used"
    )


def with_sent(articles: DataFrame, sent: DataFrame) -> DataFrame:
    first = first_sent(sent)
    return articles.join(first, first.columns[0], "left")


def _with_decision(articles: DataFrame, latest: DataFrame, *columns: str) -> DataFrame:
    """Left join by link.

    A decision on a link that was not stored yet changed nothing at its time, so
    one older than the article finds no partner. With that rule in the join
    condition a later filter on a decision turns the join into an inner one.
    """
    decided = latest.select(F.col("link").alias("decided_link"), "decided_at", *columns)
    same = (F.col("link") == F.col("decided_link")) & (F.col("decided_at") >= F.col("fetched_at"))
    return articles.join(decided, same, "left").drop("decided_link", "decided_at")


def current_articles(
    raw: DataFrame, relevance: DataFrame, summaries: DataFrame, sent: DataFrame
) -> DataFrame:
    """The article table as it stands now.

    With marks by link all facts become one narrow row for each link first, so the
    articles and their text are shuffled once.
    """
    if "link" in sent.columns:
        current = _merged(raw, relevance, summaries, sent)
    else:
        current = with_sent(with_summary(with_relevance(raw, relevance), summaries), sent)
    reserved = {name: F.lit(False) for name in ("user_saved", "user_marked_interesting")}
    return current.withColumns(reserved).select(*schemas.ARTICLE_COLUMNS)


def _merged(raw: DataFrame, relevance: DataFrame, summaries: DataFrame, sent: DataFrame) -> DataFrame:
    decided, written = latest_relevance(relevance), latest_summary(summaries)
    by_link = (
        decided.withColumnRenamed("decided_at", "relevance_at")
        .join(written.withColumnRenamed("decided_at", "summary_at"), "link", "full")
        .join(first_sent(sent), "link", "full")
    )
    # A decision on a link that was not stored yet changed nothing at its time.
    rules = {
        "relevance_at": ("is_ai_relevant", "ai_filter_model_used"),
        "summary_at": ("llm_summary", "summarizer_model_used"),
    }
    return raw.join(by_link, "link", "left").withColumns({
        name: F.when(F.col(at) >= F.col("fetched_at"), F.col(name))
        for at, names in rules.items() for name in names
    })


def not_yet_sent(ids: DataFrame, sent: DataFrame) -> DataFrame:
    """Ids (column ``article_id``) that may still be marked as sent."""
    return ids.select("article_id").distinct().join(sent, "article_id", "left_anti")
