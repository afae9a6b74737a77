"""Incremental runs: equal to the batch run, and unchanged by replays."""

import pytest
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.operators.extract import extractive_model
from newsloom.operators.inference import term_model
from newsloom.plans.lifecycle import Models
from newsloom.plans.store import ArticleStore
from newsloom.settings import Settings
from newsloom.sources import feeds
from newsloom.sources.catalogue import catalogue_frame
from newsloom.streaming.incremental import start_curation, start_ingest


@pytest.fixture
def sources(spark):
    return catalogue_frame(spark, [{"name": "One", "url": "u1"}])


def land(spark, folder, start, end):
    """Entries start..end; every link comes twice within a landing, and across landings."""
    rows = spark.range(start, end).select(
        F.lit("u1").alias("feed_url"), F.col("id").alias("entry_ordinal"),
        F.concat(F.lit("l"), F.floor(F.col("id") / 2).cast("string")).alias("link"),
        F.concat(F.lit("Title "), F.col("id").cast("string")).alias("title"),
        F.lit(None).cast("string").alias("published"),
        F.lit(None).cast("timestamp").alias("published_parsed"),
        F.concat(F.lit("A license for "), F.col("id").cast("string"), F.lit(". More.")).alias("summary"),
        F.lit(None).cast("string").alias("description"),
        F.lit(None).cast(schemas.CONTENT_ITEMS).alias("content"),
    )
    rows.coalesce(1).write.mode("append").parquet(folder)
    return rows


def content(store):
    return sorted(tuple(r) for r in store.raw().select("link", "title", "original_summary").collect())


def test_stream_equals_batch_and_restarts_add_nothing(spark, tmp_path, sources):
    landing = str(tmp_path / "landing")
    store = ArticleStore(spark, str(tmp_path / "streamed"))

    def run():
        stream = feeds.stream_landed_entries(spark, landing, max_files=1)
        start_ingest(store, stream, sources, str(tmp_path / "checkpoint")).awaitTermination()

    land(spark, landing, 0, 20)
    run()
    assert store.raw().count() == 10
    land(spark, landing, 10, 40)
    run()
    run()
    batch = ArticleStore(spark, str(tmp_path / "batch"))
    batch.ensure_tables()
    batch.add_entries(feeds.read_landed_entries(spark, landing), sources, "b1")
    assert content(store) == content(batch)
    ids = sorted(r["id"] for r in store.raw().collect())
    assert ids == list(range(1, 21))


def test_lost_checkpoint_replays_into_the_same_partitions(spark, tmp_path, sources):
    landing = str(tmp_path / "landing")
    store = ArticleStore(spark, str(tmp_path / "store"))
    land(spark, landing, 0, 20)
    for checkpoint in ("c1", "c2"):
        stream = feeds.stream_landed_entries(spark, landing)
        start_ingest(store, stream, sources, str(tmp_path / checkpoint)).awaitTermination()
    assert store.raw().count() == 10


def test_incremental_stages_take_only_what_is_open(spark, tmp_path, sources):
    landing = str(tmp_path / "landing")
    store = ArticleStore(spark, str(tmp_path / "store"), Settings(top_n_summaries=-1))
    models = Models(relevance=term_model(["license"]), summary=extractive_model)

    def run():
        stream = feeds.stream_landed_entries(spark, landing)
        start_curation(
            store, stream, sources, models, str(tmp_path / "checkpoint")
        ).awaitTermination()

    land(spark, landing, 0, 10)
    run()
    land(spark, landing, 6, 14)
    run()
    articles = store.articles()
    assert articles.count() == 7
    assert articles.filter("is_ai_relevant AND llm_summary IS NOT NULL").count() == 7
    per_run = store.read("relevance_facts").groupBy("run_key").count().collect()
    assert sorted(r["count"] for r in per_run) == [2, 5]
