"""From feed entries to clean article rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom import constants as C
from newsloom.functions.dates import published_text
from newsloom.functions.text import html_to_text, strip
from newsloom.sources.catalogue import usable_sources

ENTRY_KEY = ["link", "source_ordinal", "entry_ordinal"]


def entries_of_sources(entries: DataFrame, sources: DataFrame) -> DataFrame:
    """Entries of enabled sources with their source name and position.

    No broadcast is forced: the planner broadcasts the catalogue while its size
    allows, and AQE splits a hot feed otherwise.
    """
    catalogue = usable_sources(sources).select(
        F.col("url").alias("feed_url"),
        "source_ordinal",
        F.coalesce("name", F.lit(C.DEFAULT_SOURCE_NAME)).alias("source_name"),
    )
    return entries.join(catalogue, "feed_url")


def nested_entries(feeds: DataFrame) -> DataFrame:
    """One row per entry of feeds that arrive as (feed_url, entries array)."""
    return feeds.select(
        "feed_url", F.posexplode("entries").alias("entry_ordinal", "entry")
    ).select("feed_url", F.col("entry_ordinal").cast("long").alias("entry_ordinal"), "entry.*")


def entry_html(content: Column, summary: Column, description: Column) -> Column:
    """The markup an entry offers: typed content, else any content, else summary, else description."""

    def is_text(item: Column) -> Column:
        kind = F.lower(item["type"])
        return (kind.contains("html") | kind.contains("text")) & item["value"].isNotNull()

    typed = F.get(F.filter(content, is_text), F.lit(0))
    untyped = F.get(F.filter(content, lambda item: item["value"] != ""), F.lit(0))
    chosen = F.when(typed.isNotNull(), typed["value"]).otherwise(untyped["value"])
    empty = F.lit("")
    return F.coalesce(
        F.nullif(chosen, empty), F.nullif(summary, empty), F.nullif(description, empty), empty
    )


def entry_text(content: Column, summary: Column, description: Column) -> Column:
    return html_to_text(entry_html(content, summary, description))


def best_text(
    main: Column, feed: Column, threshold: int = C.FEED_FALLBACK_THRESHOLD
) -> Column:
    """The page text, unless it is short and the feed text is longer."""
    main = F.coalesce(main, F.lit(""))
    return F.when(
        (F.length(main) < threshold) & (F.length(feed) > F.length(main)), feed
    ).otherwise(main)


def clean_title(title: Column) -> Column:
    return strip(F.coalesce(title, F.lit(C.DEFAULT_TITLE)))


def article_rows(
    entries: DataFrame, threshold: int = C.FEED_FALLBACK_THRESHOLD, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Insertable columns of entries that carry ``main_text`` from their page."""
    feed_text = entry_text(F.col("content"), F.col("summary"), F.col("description"))
    return entries.withColumn("feed_text", feed_text).select(
        *ENTRY_KEY,
        *keep,
        clean_title(F.col("title")).alias("title"),
        F.coalesce("source_name", F.lit(C.DEFAULT_SOURCE_NAME)).alias("source_name"),
        best_text(F.col("main_text"), F.col("feed_text"), threshold).alias("original_summary"),
        published_text(F.col("published_parsed"), F.col("published")).alias("published_at"),
    )
