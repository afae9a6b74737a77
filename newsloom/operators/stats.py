"""Counters of each stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _count_all() -> Column:
    return F.count(F.lit(1))


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).cast("long").alias(column)


def ingest_stats(entries: DataFrame, arrivals: DataFrame, by_source: bool = False) -> DataFrame:
    """Entries seen and entries added; seen counts linkless and repeated ones too.

    Both sides shrink to one row per source before they meet.
    """
    seen = entries.groupBy("source_ordinal", "source_name").agg(_count_all().alias("total_items"))
    added = arrivals.groupBy("source_ordinal").agg(_count_all().alias("newly_added"))
    keys = ["source_name"] if by_source else []
    return seen.join(added, "source_ordinal", "left").groupBy(*keys).agg(
        _total("total_items"), _total("newly_added")
    )


def relevance_stats(decisions: DataFrame) -> DataFrame:
    return decisions.agg(
        _count_all().alias("processed"), F.count_if("is_ai_relevant").alias("retained")
    )


def stage_counts(articles: DataFrame) -> DataFrame:
    """Summarized and sent rows of the current table."""
    return articles.agg(
        F.count("llm_summary").alias("summarized"),
        F.count("sent_in_newsletter_at").alias("sent"),
    )
