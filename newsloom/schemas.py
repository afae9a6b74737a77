"""Declared schemas of every table the library reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


STRING, LONG, BOOLEAN, DOUBLE, TIMESTAMP = (
    T.StringType(), T.LongType(), T.BooleanType(), T.DoubleType(), T.TimestampType(),
)

SOURCES = _struct(
    ("source_ordinal", LONG, False),
    ("name", STRING, True),
    ("url", STRING, True),
    ("notes", STRING, True),
    ("tags", T.ArrayType(STRING), True),
    ("weight", DOUBLE, True),
    ("enabled", BOOLEAN, True),
)

CONTENT_ITEMS = T.ArrayType(_struct(("type", STRING, True), ("value", STRING, True)))

FEED_ENTRIES = _struct(
    ("feed_url", STRING, True),
    ("entry_ordinal", LONG, True),
    ("link", STRING, True),
    ("title", STRING, True),
    ("published", STRING, True),
    ("published_parsed", TIMESTAMP, True),
    ("summary", STRING, True),
    ("description", STRING, True),
    ("content", CONTENT_ITEMS, True),
)

ARTICLES_RAW = _struct(
    ("id", LONG, False),
    ("link", STRING, False),
    ("title", STRING, True),
    ("source_name", STRING, True),
    ("original_summary", STRING, True),
    ("published_at", STRING, True),
    ("fetched_at", TIMESTAMP, True),
    ("batch_key", STRING, True),
)

RELEVANCE_FACTS = _struct(
    ("link", STRING, False),
    ("is_ai_relevant", BOOLEAN, True),
    ("model", STRING, True),
    ("provider_used", STRING, True),
    ("failed", BOOLEAN, True),
    ("decided_at", TIMESTAMP, False),
    ("run_key", STRING, True),
)

SUMMARY_FACTS = _struct(
    ("link", STRING, False),
    ("llm_summary", STRING, True),
    ("model", STRING, True),
    ("provider_used", STRING, True),
    ("summary_status", STRING, True),
    ("decided_at", TIMESTAMP, False),
    ("run_key", STRING, True),
)

SENT_FACTS = _struct(
    ("article_id", LONG, False),
    ("link", STRING, True),
    ("sent_at", TIMESTAMP, False),
    ("digest_id", STRING, True),
    ("run_key", STRING, True),
)

DIGEST_ITEMS = _struct(
    ("id", LONG, False),
    ("link", STRING, False),
    ("title", STRING, True),
    ("llm_summary", STRING, True),
    ("source_name", STRING, True),
    ("published_at", STRING, True),
    ("rank", LONG, False),
    ("run_key", STRING, True),
)

# A digest is delivered in parts of a bounded number of items; most have one.
DIGESTS = _struct(
    ("digest_id", STRING, False),
    ("part", LONG, False),
    ("subject", STRING, True),
    ("html", STRING, True),
    ("items", LONG, True),
    ("run_key", STRING, True),
)

# Column order of the current-state view over the tables above.
ARTICLE_COLUMNS = [
    "id", "link", "title", "source_name", "original_summary", "published_at", "fetched_at",
    "is_ai_relevant", "ai_filter_model_used", "llm_summary", "summarizer_model_used",
    "sent_in_newsletter_at", "user_saved", "user_marked_interesting",
]
