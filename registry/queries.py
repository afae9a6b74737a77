"""The registered queries: one per operator, keyed by its inventory id."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom import constants as C
from newsloom.functions import chat, dates, text
from newsloom.operators import (
    attempts, digest, entries, extract, facts, inference, insertion, queues, stats,
)
from newsloom.plans.lifecycle import Models, run_curation
from newsloom.plans.store import ArticleStore
from newsloom.session import apply_session_conf, shared_folder
from newsloom.settings import Settings
from newsloom.sources import catalogue, feeds, pages
from newsloom.streaming.incremental import start_ingest
from registry import inputs
from registry.editorial import EDITORIAL
from registry.learned import LEARNED
from registry.stories import STORIES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SMALL_BUDGET = 270


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_session_conf(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        return run

    return register


def col(name: str):
    return F.col(name)


# -- sources --------------------------------------------------------------------


@query("A01_source_catalogue")
def source_catalogue(spark, sf_dir):
    usable = catalogue.usable_sources(inputs.sources(spark, sf_dir))
    return usable.select(
        "source_ordinal", "name", "url", F.array_join("tags", ",").alias("tags"), "weight"
    )


def _landed_as(spark, rows: DataFrame, row_tag: str) -> str:
    """Write feed files below a new folder, one per feed, as a collector would land them."""
    folder = f"{shared_folder(spark)}/landed-{uuid.uuid4()}"
    writer = rows.write.format("xml").option("rootTag", "feed").option("rowTag", row_tag)
    writer.partitionBy("feed_url").save(folder)
    return folder


def _landed_result(entries_read: DataFrame) -> DataFrame:
    return entries_read.select(
        "feed_url", "link", entries.clean_title(col("title")).alias("title"),
        F.unix_seconds("published_parsed").alias("published_s"),
        entries.entry_text(col("content"), col("summary"), col("description")).alias("feed_text"),
    )


@query("A02_rss_files")
def rss_files(spark, sf_dir):
    """The documents landed as RSS items and read back."""
    html = entries.entry_html(col("content"), col("summary"), col("description"))
    stamp = F.date_format(inputs.published_ts(col("entry_ordinal")), "EEE, dd MMM yyyy HH:mm:ss")
    items = inputs.feed_entries(spark, sf_dir).select(
        "feed_url", "title", "link", F.concat(stamp, F.lit(" +0200")).alias("pubDate"),
        html.alias("description"),
    )
    return _landed_result(feeds.read_rss(spark, _landed_as(spark, items, "item")))


@query("A02_atom_files")
def atom_files(spark, sf_dir):
    """The documents landed as Atom entries and read back."""
    html = entries.entry_html(col("content"), col("summary"), col("description"))
    stamp = F.date_format(inputs.published_ts(col("entry_ordinal")), "yyyy-MM-dd'T'HH:mm:ss'Z'")

    def link(href, rel):
        return F.struct(href.alias("_href"), F.lit(rel).alias("_rel"))

    items = inputs.feed_entries(spark, sf_dir).select(
        "feed_url", "title",
        F.array(link(col("feed_url"), "self"), link(col("link"), "alternate")).alias("link"),
        stamp.alias("published"),
        F.struct(html.alias("_VALUE"), F.lit("html").alias("_type")).alias("content"),
    )
    return _landed_result(feeds.read_atom(spark, _landed_as(spark, items, "entry")))


@query("A02_rss_guid_links")
def rss_guid_links(spark, sf_dir):
    """The documents landed as RSS items that carry their link as a guid, some of them not permanent."""
    rows = inputs.feed_entries(spark, sf_dir)
    permanent = F.when(col("entry_ordinal") % 3 == 0, "false").when(col("entry_ordinal") % 3 == 1, "true")
    items = rows.select(
        "feed_url", "title", F.struct(col("link").alias("_VALUE"), permanent.alias("_isPermaLink")).alias("guid"),
    )
    return feeds.read_rss(spark, _landed_as(spark, items, "item")).select(
        "feed_url", "link", entries.clean_title(col("title")).alias("title")
    )


def _entries(spark, sf_dir):
    return entries.entries_of_sources(
        inputs.feed_entries(spark, sf_dir), inputs.sources(spark, sf_dir)
    )


@query("A03_entries_of_sources")
def entries_of_sources(spark, sf_dir):
    return _entries(spark, sf_dir).select(
        "source_ordinal", "entry_ordinal", "source_name", "link", "title"
    )


@query("A04_article_text")
def article_text(spark, sf_dir):
    return pages.page_texts(inputs.table(spark, sf_dir, "pages"))


@query("A05_article_scan")
def article_scan(spark, sf_dir):
    return inputs.articles(spark, sf_dir).select(
        "id", "link", "title", "source_name", "original_summary", "published_at",
        F.unix_seconds("fetched_at").alias("fetched_s"), "is_ai_relevant", "ai_filter_model_used",
        "llm_summary", F.unix_seconds("sent_in_newsletter_at").alias("sent_s"),
    )


@query("A06_inserted_sample")
def inserted_sample(spark, sf_dir):
    return queues.inserted_sample(inputs.articles(spark, sf_dir), added=C.INSERTED_SAMPLE_SIZE)


# -- insertion and decisions ------------------------------------------------------


@query("A08_insert_if_new")
def insert_if_new(spark, sf_dir):
    offered = _entries(spark, sf_dir)
    stored = inputs.stored_articles(spark, sf_dir)
    arrivals = insertion.with_dense_ids(
        insertion.new_arrivals(offered, stored), insertion.ARRIVAL, insertion.next_id(stored)
    )
    rows = insertion.select_arrivals(offered, arrivals)
    rows = pages.attach_page_text(
        rows, inputs.table(spark, sf_dir, "pages"), arrivals.select("link")
    )
    return entries.article_rows(rows, keep=("id",))


@query("A09_latest_relevance")
def latest_relevance(spark, sf_dir):
    latest = facts.latest_relevance(inputs.relevance_facts(spark, sf_dir))
    return latest.select("link", "is_ai_relevant", "ai_filter_model_used")


@query("A09b_latest_summary")
def latest_summary(spark, sf_dir):
    latest = facts.latest_summary(inputs.summary_facts(spark, sf_dir))
    return latest.select("link", "llm_summary", "summarizer_model_used")


@query("A09c_first_sent")
def first_sent(spark, sf_dir):
    sent = facts.first_sent(inputs.sent_facts(spark, sf_dir))
    return sent.select("id", F.unix_seconds("sent_in_newsletter_at").alias("sent_s"))


# -- text -------------------------------------------------------------------------


@query("A10_html_to_text")
def html_to_text(spark, sf_dir):
    return inputs.table(spark, sf_dir, "pages").select(
        "page_id", text.html_to_text(col("html")).alias("page_text")
    )


@query("A11_entry_text")
def entry_text(spark, sf_dir):
    return inputs.feed_entries(spark, sf_dir).select(
        "entry_ordinal",
        entries.entry_text(col("content"), col("summary"), col("description")).alias("feed_text"),
    )


@query("A12_best_text")
def best_text(spark, sf_dir):
    """Page text against document text; the first sentence stands in for the short ones."""
    documents = inputs.table(spark, sf_dir, "documents")
    texts = pages.page_texts(inputs.table(spark, sf_dir, "pages")).select(
        col("page_id").alias("doc_id"), "main_text"
    )
    sentence = F.split_part(col("text"), F.lit("."), F.lit(1))
    main = F.coalesce("main_text", F.when(col("lang") == "en", sentence))
    return documents.join(texts, "doc_id", "left").select(
        "doc_id", entries.best_text(main, col("text")).alias("original_summary")
    )


@query("A13_clean_title")
def clean_title(spark, sf_dir):
    return inputs.feed_entries(spark, sf_dir).select(
        "entry_ordinal", entries.clean_title(col("title")).alias("title")
    )


@query("A14_published_at")
def published_at(spark, sf_dir):
    return inputs.feed_entries(spark, sf_dir).select(
        "entry_ordinal",
        dates.published_text(col("published_parsed"), col("published")).alias("published_at"),
    )


@query("A15_relevance_input")
def relevance_input(spark, sf_dir):
    return inputs.articles(spark, sf_dir).select(
        "id",
        chat.relevance_title(col("title")).alias("title_input"),
        chat.relevance_text(col("original_summary")).alias("text_input"),
    )


@query("A16_relevance_prompt")
def relevance_prompt(spark, sf_dir):
    return inputs.articles(spark, sf_dir).select(
        "id", chat.relevance_prompt(col("title"), col("original_summary")).alias("prompt")
    )


@query("A17_relevance_answer")
def relevance_answer(spark, sf_dir):
    """Whole conversation turns as model responses."""
    turns = inputs.table(spark, sf_dir, "conversations")
    response = F.when(col("role") == "user", F.concat(F.lit("  YES, "), col("text"))).when(
        col("turn") > 2, col("text")
    )
    return turns.select(
        "conv_id", "turn", chat.relevance_answer(response).alias("is_ai_relevant")
    )


@query("A18_summary_input")
def summary_input(spark, sf_dir):
    return inputs.articles(spark, sf_dir).select(
        "id", chat.summary_input(col("title"), col("original_summary")).alias("model_input")
    )


@query("A18_summary_input_small_budget")
def summary_input_small_budget(spark, sf_dir):
    model_input = chat.summary_input(col("title"), col("original_summary"), SMALL_BUDGET)
    return inputs.articles(spark, sf_dir).select("id", model_input.alias("model_input"))


@query("A19_summary_result")
def summary_result(spark, sf_dir):
    """Responses: an error for unlabelled articles, the spaced first sentence for the others."""
    articles = inputs.articles(spark, sf_dir)
    response = F.when(
        col("is_ai_relevant").isNull(), F.concat(F.lit("Error: no answer for "), col("link"))
    ).otherwise(F.concat(F.lit("\n "), F.split_part(col("original_summary"), F.lit("."), F.lit(1))))
    content = F.when(F.length("original_summary") >= 150, col("original_summary")).otherwise("  ")
    return articles.select(
        "id",
        chat.summary_result(content, response).alias("llm_summary"),
        chat.summary_status(content, response).alias("summary_status"),
    )


@query("A20_display_date")
def display_date(spark, sf_dir):
    return inputs.articles(spark, sf_dir).select(
        "id", dates.display_date(col("published_at")).alias("published_at_formatted")
    )


@query("A21_escaped_fields")
def escaped_fields(spark, sf_dir):
    page = inputs.table(spark, sf_dir, "pages")
    return page.select(
        "page_id", text.escape_html(col("url")).alias("url_html"),
        text.escape_html(col("html")).alias("html_html"),
    )


# -- requests and responses ---------------------------------------------------------


@query("A22_chat_request")
def chat_request(spark, sf_dir):
    articles = inputs.articles(spark, sf_dir)
    prompt = chat.summary_prompt(col("title"), col("original_summary"))
    return articles.select(
        "id", chat.chat_request(prompt, C.SUMMARY_SYSTEM_PROMPT).alias("request")
    )


@query("A23_response_content")
def response_content(spark, sf_dir):
    return inputs.inference_attempts(spark, sf_dir).select(
        "request_id", "attempt", chat.response_content(col("body")).alias("content")
    )


@query("A24_retry_hint")
def retry_hint(spark, sf_dir):
    log = inputs.inference_attempts(spark, sf_dir)
    wait = F.coalesce(
        chat.retry_hint_seconds(col("body")), chat.backoff_seconds(col("attempt"))
    )
    return log.select("request_id", "attempt", wait.alias("wait_s"))


# -- queues -------------------------------------------------------------------------


@query("A25_relevance_backlog")
def relevance_backlog(spark, sf_dir):
    return queues.relevance_backlog(inputs.articles(spark, sf_dir))


@query("A26_summary_queue")
def summary_queue(spark, sf_dir):
    return queues.summary_queue(inputs.articles(spark, sf_dir))


@query("A26_summary_queue_unlimited")
def summary_queue_unlimited(spark, sf_dir):
    return queues.summary_queue(inputs.articles(spark, sf_dir), limit=-1)


@query("A27_digest_candidates")
def digest_candidates(spark, sf_dir):
    """Newest relevant, summarized, unsent articles with their display date."""
    return digest.digest_items(queues.digest_candidates(inputs.articles(spark, sf_dir)))


@query("A27_digest_candidates_unlimited")
def digest_candidates_unlimited(spark, sf_dir):
    return queues.digest_candidates(inputs.articles(spark, sf_dir), limit=-1)


# -- joins ----------------------------------------------------------------------------


@query("A28_new_links")
def new_links(spark, sf_dir):
    return insertion.new_arrivals(_entries(spark, sf_dir), inputs.stored_articles(spark, sf_dir))


@query("A29_current_articles")
def current_articles(spark, sf_dir):
    current = facts.current_articles(
        inputs.raw_articles(spark, sf_dir), inputs.relevance_facts(spark, sf_dir),
        inputs.summary_facts(spark, sf_dir), inputs.sent_facts(spark, sf_dir),
    )
    return current.select(
        "id", "link", "title", "source_name", "original_summary", "published_at",
        F.unix_seconds("fetched_at").alias("fetched_s"), "is_ai_relevant", "ai_filter_model_used",
        "llm_summary", "summarizer_model_used",
        F.unix_seconds("sent_in_newsletter_at").alias("sent_s"),
        "user_saved", "user_marked_interesting",
    )


@query("A30_not_yet_sent")
def not_yet_sent(spark, sf_dir):
    ids = inputs.articles(spark, sf_dir).filter(col("is_ai_relevant"))
    return facts.not_yet_sent(
        ids.select(col("id").alias("article_id")), inputs.sent_facts(spark, sf_dir)
    )


@query("A31_entries_per_source")
def entries_per_source(spark, sf_dir):
    return _entries(spark, sf_dir).groupBy("source_ordinal", "source_name").agg(
        F.count(F.lit(1)).alias("entries"), F.count("link").alias("linked")
    )


@query("A32_entry_page_text")
def entry_page_text(spark, sf_dir):
    offered = inputs.feed_entries(spark, sf_dir).select("entry_ordinal", "link")
    return pages.attach_page_text(offered, inputs.table(spark, sf_dir, "pages")).select(
        "entry_ordinal", "link", "main_text"
    )


# -- counters and digest --------------------------------------------------------------


@query("A33_ingest_stats")
def ingest_stats(spark, sf_dir):
    offered = _entries(spark, sf_dir)
    arrivals = insertion.new_arrivals(offered, inputs.stored_articles(spark, sf_dir))
    return stats.ingest_stats(offered, arrivals)


@query("A33_ingest_stats_by_source")
def ingest_stats_by_source(spark, sf_dir):
    offered = _entries(spark, sf_dir)
    arrivals = insertion.new_arrivals(offered, inputs.stored_articles(spark, sf_dir))
    return stats.ingest_stats(offered, arrivals, by_source=True)


@query("A34_relevance_stats")
def relevance_stats(spark, sf_dir):
    articles = inputs.articles(spark, sf_dir)
    return stats.relevance_stats(articles.filter(col("is_ai_relevant").isNotNull()))


@query("A35_stage_counts")
def stage_counts(spark, sf_dir):
    return stats.stage_counts(inputs.articles(spark, sf_dir))


@query("A36_digest_document")
def digest_document(spark, sf_dir):
    ranked = queues.ranked_candidates(inputs.articles(spark, sf_dir), C.DIGEST_SIZE)
    items = digest.digest_items(ranked).withColumn("digest_id", F.lit("2025-07-04"))
    return digest.digest_documents(
        items, date=F.lit("July 04, 2025"), brand="Morning News"
    ).drop("part")


@query("A36_digest_fragments")
def digest_fragments(spark, sf_dir):
    return digest.digest_fragments(
        queues.digest_candidates(inputs.articles(spark, sf_dir), limit=-1)
    )


# -- inference ------------------------------------------------------------------------


@query("A37_extractive_summary")
def extractive_summary(spark, sf_dir):
    return extract.extractive_summaries(
        inputs.articles(spark, sf_dir), "id", "original_summary"
    )


@query("A37_summarize")
def summarize(spark, sf_dir):
    """Every relevant article without a summary, through the offline model."""
    queue = queues.summary_queue(inputs.articles(spark, sf_dir), limit=-1)
    return inference.summarize(queue, extract.extractive_model, model_name="extractive")


@query("A38_resolved_attempts")
def resolved_attempts(spark, sf_dir):
    return attempts.resolve_attempts(inputs.inference_attempts(spark, sf_dir))


@query("A38_attempt_waits")
def attempt_waits(spark, sf_dir):
    return attempts.attempt_waits(inputs.inference_attempts(spark, sf_dir)).select(
        "request_id", "attempt", "outcome_class", "wait_s"
    )


@query("A39_classify")
def classify(spark, sf_dir):
    """The whole relevance backlog through the offline term model."""
    backlog = inputs.articles(spark, sf_dir).filter(queues.needs_relevance())
    return inference.classify(backlog, inference.term_model(inputs.RELEVANCE_TERMS))


@query("A40_tiered_inference")
def tiered_inference(spark, sf_dir):
    """A primary that fails on long texts, a fallback that fails on German ones."""
    requests = inference.summary_requests(inputs.articles(spark, sf_dir))
    primary = inference.column_model(
        lambda r: F.when(F.length(r["text"]) < 1000, F.concat(F.lit(" short: "), r["title"]))
    )
    fallback = inference.column_model(
        lambda r: F.when(~r["text"].contains(" der "), F.concat(F.lit("long: "), r["title"]))
    )
    return inference.tiered_inference(requests, primary, fallback)


# -- incremental ------------------------------------------------------------------------


def _new_store(spark: SparkSession, settings: Settings = Settings()) -> ArticleStore:
    store = ArticleStore(spark, f"{shared_folder(spark)}/store-{uuid.uuid4()}", settings)
    store.ensure_tables()
    return store


@query("A41_incremental_ingest")
def incremental_ingest(spark, sf_dir):
    """The documents as a stream of entries into an empty store."""
    store = _new_store(spark)
    page = inputs.table(spark, sf_dir, "pages")
    # The pattern matches the table whether it is one file or a folder of files.
    documents = spark.readStream.schema(inputs.table(spark, sf_dir, "documents").schema).parquet(
        f"{sf_dir}/documents.parque[t]"
    )
    stream = start_ingest(
        store, inputs.entries_of_documents(documents, page), inputs.sources(spark, sf_dir),
        f"{store.root}/stream", name=f"ingest-{uuid.uuid4()}", pages=page,
    )
    stream.awaitTermination()
    return store.raw().drop("batch_key", "fetched_at")


@query("A42_curation_run")
def curation_run(spark, sf_dir):
    """Ingest, relevance and summaries over everything, into an empty store."""
    store = _new_store(spark, Settings(top_n_summaries=-1, summary_model="extractive"))
    models = Models(
        relevance=inference.term_model(inputs.RELEVANCE_TERMS), summary=extract.extractive_model
    )
    run_curation(
        store, inputs.feed_entries(spark, sf_dir), inputs.sources(spark, sf_dir), models, "run-1",
        inputs.table(spark, sf_dir, "pages"),
    )
    return store.articles().select(
        "id", "link", "title", "original_summary", "is_ai_relevant", "ai_filter_model_used",
        "llm_summary", "summarizer_model_used",
    )


@query("A41_replayed_ingest")
def replayed_ingest(spark, sf_dir):
    """Two batches with decisions in between, then the first again: ids, decisions and marks stay."""
    store = _new_store(spark)
    rows, catalog = inputs.feed_entries(spark, sf_dir), inputs.sources(spark, sf_dir)
    first = rows.filter(col("entry_ordinal") % 2 == 0)
    store.add_entries(first, catalog, "b1")
    yes = store.raw().select("link", F.lit(True).alias("is_ai_relevant"), F.lit("m").alias("model"))
    store.record_relevance(yes, "r1")
    store.mark_sent(store.raw().select(col("id").alias("article_id")), "d1", "d1")
    store.add_entries(rows, catalog, "b2")
    store.add_entries(first, catalog, "b1")
    return store.articles().select(
        "id", "link", "is_ai_relevant", col("sent_in_newsletter_at").isNotNull().alias("sent")
    )


@query("A42_second_run_same_key")
def second_run_same_key(spark, sf_dir):
    """Two runs under one key: what the first stored stays, the second adds the rest."""
    store = _new_store(spark, Settings(top_n_summaries=0))
    models = Models(relevance=inference.term_model(inputs.RELEVANCE_TERMS))
    rows, catalog = inputs.feed_entries(spark, sf_dir), inputs.sources(spark, sf_dir)
    run_curation(store, rows.filter(col("entry_ordinal") % 2 == 0), catalog, models, "2025-07-04")
    run_curation(store, rows.filter(col("entry_ordinal") % 2 == 1), catalog, models, "2025-07-04")
    return store.articles().select("id", "link", "title", "is_ai_relevant")


# -- editorial ----------------------------------------------------------------------------

for _name, _function in {**EDITORIAL, **STORIES, **LEARNED}.items():
    query(_name)(_function)
