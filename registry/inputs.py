"""Inputs of the registered queries, derived by Spark from the given tables.

Each function has a twin of the same name in ``registry.oracle_inputs``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom import constants as C

PUBLISHED_START = 1_748_736_000
PUBLISHED_SPAN = 2_592_000
FETCHED_START = 1_751_328_000
LINKLESS_CHARS = 60
ENABLED_SOURCES = 16
SUMMARIZED_CHARS = 1_000
RELEVANCE_TERMS = ("license", "licensed", "token")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def first_line(text: Column) -> Column:
    return F.trim(F.split_part(text, F.lit("\n"), F.lit(1)))


def published_ts(doc_id: Column) -> Column:
    return F.timestamp_seconds(F.lit(PUBLISHED_START) + (doc_id * 7919) % PUBLISHED_SPAN)


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels as the current article table."""
    documents = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    stamp = published_ts(F.col("doc_id"))
    relevant = F.col("quality") == 1
    summarized = relevant & (F.col("n_chars") >= SUMMARIZED_CHARS)
    rfc = F.concat(F.date_format(stamp, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    return documents.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("id"),
        article_link().alias("link"),
        F.coalesce(F.nullif(first_line(F.col("text")), F.lit("")), F.lit(C.DEFAULT_TITLE))
        .alias("title"),
        F.col("source").alias("source_name"),
        F.col("text").alias("original_summary"),
        F.when(F.col("lang") == "es", None).when(F.col("lang") == "de", rfc)
        .otherwise(F.date_format(stamp, "yyyy-MM-dd HH:mm:ss")).alias("published_at"),
        F.timestamp_seconds(fetched_seconds()).alias("fetched_at"),
        relevant.alias("is_ai_relevant"),
        F.when(relevant, C.PRIMARY_MODEL).alias("ai_filter_model_used"),
        F.when(summarized, F.concat(F.split_part(F.col("text"), F.lit("."), F.lit(1)), F.lit(".")))
        .alias("llm_summary"),
        F.when(summarized & (F.col("lang") == "fr"), F.lit("2025-07-02 00:00:00"))
        .cast("timestamp").alias("sent_in_newsletter_at"),
    )


def article_link() -> Column:
    return F.concat(
        F.lit("https://news.example/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string")
    )


def fetched_seconds() -> Column:
    return F.lit(FETCHED_START) + F.floor(F.col("doc_id") / 50)


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue: one feed per source of the documents, the later ones disabled."""
    number = F.substring("source", 4, 9).cast("long")
    return table(spark, sf_dir, "documents").select("source").distinct().select(
        number.alias("source_ordinal"),
        F.col("source").alias("name"),
        F.concat(F.lit("https://news.example/"), F.col("source"), F.lit("/feed")).alias("url"),
        F.lit(None).cast("string").alias("notes"),
        F.array(F.lit("AI"), F.col("source")).alias("tags"),
        (F.lit(0.5) + (number % 4) * F.lit(0.5)).alias("weight"),
        F.when(number >= ENABLED_SOURCES, False).alias("enabled"),
    )


def feed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return entries_of_documents(documents, table(spark, sf_dir, "pages"))


def entries_of_documents(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """Every document as a feed entry, a shape per language.

    Equal texts share a link unless a page gives them one, so copies collide as
    syndicated stories do. Very short ones have no link.
    """
    urls = pages.select(F.col("page_id").alias("doc_id"), "url")
    html = F.concat(F.lit("<p>"), F.col("text"), F.lit("</p>"))
    lang = F.col("lang")

    def item(kind: str, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("type"), value.alias("value"))

    content = (
        F.when(lang == "en", F.array(item("image/png", F.lit("")), item("text/html", html)))
        .when(lang == "es", F.array(item("application/x", F.lit("")), item("application/y", html)))
    )
    return documents.join(urls, "doc_id", "left").select(
        F.concat(F.lit("https://news.example/"), F.col("source"), F.lit("/feed"))
        .alias("feed_url"),
        F.col("doc_id").alias("entry_ordinal"),
        F.when(
            F.col("n_chars") >= LINKLESS_CHARS,
            F.coalesce("url", F.concat(F.lit("https://news.example/"), F.md5("text"))),
        ).alias("link"),
        F.split_part(F.col("text"), F.lit("\n"), F.lit(1)).alias("title"),
        F.date_format(published_ts(F.col("doc_id")), "yyyy/MM/dd HH:mm").alias("published"),
        F.when(lang == "en", published_ts(F.col("doc_id"))).alias("published_parsed"),
        F.when(lang == "fr", html).alias("summary"),
        F.when(lang == "de", html).alias("description"),
        content.alias("content"),
    )


def stored_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, link) of what the store holds before ingest: the entries of labelled documents."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("entry_ordinal"))
    return (
        feed_entries(spark, sf_dir).select("entry_ordinal", "link")
        .filter(F.col("link").isNotNull())
        .join(labels, "entry_ordinal", "left_semi")
        .groupBy("link").agg(F.min("entry_ordinal").alias("id"))
    )


def inference_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a log of attempts, four to a request."""
    kind = F.col("event_type")
    user = F.col("user_id").cast("string")
    attempt = F.col("event_id") % 4 + 1
    answer = F.concat(F.lit('{"choices":[{"message":{"content":" v'), user, F.lit(' "}}]}'))
    limited = F.concat(F.lit('{"error":{"message":"Please try again in '), user, F.lit('.5s"}}'))
    return table(spark, sf_dir, "events").select(
        F.floor(F.col("event_id") / 4).alias("request_id"),
        F.when(attempt == 4, "fallback").otherwise("primary").alias("tier"),
        attempt.alias("attempt"),
        F.when(kind == "error", 503).when(kind == "signup", 429).when(kind == "view", 400)
        .otherwise(200).alias("status"),
        F.lit(None).cast("string").alias("error"),
        F.when(kind.isin("click", "purchase"), answer).when(kind == "signup", limited)
        .otherwise("").alias("body"),
    )


def raw_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles(spark, sf_dir).select(
        "id", "link", "title", "source_name", "original_summary", "published_at", "fetched_at"
    )


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").join(
        table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id"
    ).select("doc_id", "lang", "text", "quality", article_link().alias("link"),
             fetched_seconds().alias("fetched"))


def relevance_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A decision per label, reversed later for English, too early to count for Spanish."""
    facts = _facts(spark, sf_dir)
    first = facts.select(
        "link", (F.col("quality") == 1).alias("is_ai_relevant"), F.lit("m1").alias("model"),
        F.timestamp_seconds(
            F.col("fetched") + F.when(F.col("lang") == "es", -86400).otherwise(60)
        ).alias("decided_at"),
        F.lit("r1").alias("run_key"),
    )
    second = facts.filter(F.col("lang") == "en").select(
        "link", (F.col("quality") != 1).alias("is_ai_relevant"), F.lit("m2").alias("model"),
        F.timestamp_seconds(F.col("fetched") + 120).alias("decided_at"),
        F.lit("r2").alias("run_key"),
    )
    return first.unionByName(second)


def summary_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _facts(spark, sf_dir)
    sentence = F.concat(F.split_part(F.col("text"), F.lit("."), F.lit(1)), F.lit("."))
    first = facts.filter(F.col("quality") == 1).select(
        "link", sentence.alias("llm_summary"), F.lit("m1").alias("model"),
        F.timestamp_seconds(F.col("fetched") + 180).alias("decided_at"), F.lit("r1").alias("run_key"),
    )
    second = facts.filter((F.col("quality") == 1) & (F.col("lang") == "fr")).select(
        "link", F.upper(sentence).alias("llm_summary"), F.lit("m2").alias("model"),
        F.timestamp_seconds(F.col("fetched") + 240).alias("decided_at"), F.lit("r2").alias("run_key"),
    )
    return first.unionByName(second)


def sent_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relevant French and German articles, marked twice: the first mark counts."""
    facts = _facts(spark, sf_dir).filter((F.col("quality") == 1) & F.col("lang").isin("fr", "de"))

    def sent(at: str, digest: str) -> DataFrame:
        return facts.select(
            F.col("doc_id").alias("article_id"), F.lit(at).cast("timestamp").alias("sent_at"),
            F.lit(digest).alias("digest_id"),
        )

    return sent("2025-07-02 00:00:00", "d1").unionByName(sent("2025-07-03 00:00:00", "d2"))
