"""Replays and reused keys: nothing is removed, renumbered, asked again or sent twice."""

import pytest
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.operators.extract import extractive_model
from newsloom.operators.inference import batch_model, classify, column_model, term_model
from newsloom.plans import lifecycle
from newsloom.plans.lifecycle import Models, publish_digest, run_curation
from newsloom.plans.store import ArticleStore
from newsloom.settings import Settings
from newsloom.sources import feeds
from newsloom.sources.catalogue import catalogue_frame


@pytest.fixture
def store(spark, tmp_path):
    store = ArticleStore(spark, str(tmp_path / "store"))
    store.ensure_tables()
    return store


@pytest.fixture
def sources(spark):
    return catalogue_frame(spark, [{"name": "One", "url": "u1"}])


def batch(spark, *links, start=0):
    rows = [("u1", start + k, link, f"T {link}", "2025-06-01", None, f"{link} text. More of {link}.", None, None)
            for k, link in enumerate(links)]
    return spark.createDataFrame(rows, schemas.FEED_ENTRIES)


MODELS = Models(relevance=term_model(["text"]), summary=extractive_model)


def stored(store):
    return {r["link"]: (r["id"], r["fetched_at"]) for r in store.raw().collect()}


def test_a_key_used_again_adds(spark, store, sources):
    assert store.add_entries(batch(spark, "a", "b"), sources, "2025-07-04").newly_added == 2
    before = stored(store)
    assert store.add_entries(batch(spark, "c", start=5), sources, "2025-07-04").newly_added == 1
    after = stored(store)
    assert {k: after[k] for k in before} == before and after["c"][0] == 3


def test_a_replay_after_a_later_batch_keeps_ids_and_decisions(spark, store, sources):
    run_curation(store, batch(spark, "a", "b"), sources, MODELS, "b1")
    run_curation(store, batch(spark, "c", start=5), sources, MODELS, "b2")
    assert publish_digest(store, "d1") == 3
    before, articles = stored(store), sorted(map(tuple, store.articles().collect()), key=str)
    report = run_curation(store, batch(spark, "a", "b"), sources, MODELS, "b1")
    assert report.ingest.newly_added == 2 and report.processed == 2 and report.summarized == 2
    assert stored(store) == before
    assert sorted(map(tuple, store.articles().collect()), key=str) == articles
    assert store.open_for_filtering().isEmpty() and store.for_digest().isEmpty()


def test_decided_articles_are_not_asked_again(spark, store, sources):
    asked = []
    run_curation(store, batch(spark, "a"), sources, MODELS, "day")
    counting = column_model(lambda r: asked.append(r.count()) or F.lit("yes"))
    run_curation(store, batch(spark, "b", start=3), sources, Models(relevance=counting), "day")
    assert asked == [1]


def test_a_replayed_digest_keeps_its_selection(spark, store, sources):
    one = ArticleStore(spark, store.root, Settings(digest_size=1))
    run_curation(one, batch(spark, "old"), sources, MODELS, "b1")
    seen = []
    assert publish_digest(one, "d1", deliver=lambda s, h: seen.append(h) or True) == 1
    run_curation(one, batch(spark, "new", start=3), sources, MODELS, "b2")
    assert publish_digest(one, "d1", deliver=lambda s, h: seen.append(h) or True) == 1
    assert len(seen) == 1 and [r["link"] for r in one.for_digest().collect()] == ["new"]
    assert publish_digest(one, "d2", deliver=lambda s, h: seen.append(h) or True) == 1
    assert "T old" in seen[0] and "T new" in seen[1] and len(seen) == 2


def test_a_refused_digest_leaves_what_another_sent(spark, store, sources):
    run_curation(store, batch(spark, "a", "b"), sources, MODELS, "b1")
    assert publish_digest(store, "d1", deliver=lambda s, h: False) == 0
    assert publish_digest(store, "d2") == 2
    assert publish_digest(store, "d1", deliver=lambda s, h: True) == 0


@pytest.mark.parametrize("size", [-1, 300_000])
def test_a_digest_of_any_size_is_delivered_in_parts(spark, store, sources, size, monkeypatch):
    monkeypatch.setattr(lifecycle, "PART_ITEMS", 2)
    large = ArticleStore(spark, store.root, Settings(digest_size=size, top_n_summaries=-1))
    run_curation(large, batch(spark, "a", "b", "c", "d", "e"), sources, MODELS, "b1")
    assert publish_digest(large, "refused", deliver=lambda s, h: False) == 0
    assert large.for_digest(-1).count() == 5
    parts = []
    assert publish_digest(large, "d/1", deliver=lambda s, h: parts.append(h) or len(parts) < 3) == 4
    assert [p.count("<h2>") for p in parts] == [2, 2, 1]
    assert all(p.startswith("<!DOCTYPE html>") and p.rstrip().endswith("</html>") for p in parts)
    assert publish_digest(large, "d/1", deliver=lambda s, h: parts.append(h) or True) == 5
    assert parts[-1].count("<h2>") == 1 and large.for_digest(-1).isEmpty()


def test_the_backlog_is_not_sorted_before_a_model(spark, store, sources):
    store.add_entries(batch(spark, "a"), sources, "b1")
    plan = classify(store.open_for_filtering(), term_model(["x"]))._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort" not in plan


def test_a_model_sees_the_whole_text(spark):
    rows = spark.createDataFrame([("l", "t", "x" * 4000 + " token"), ("m", "t", "x" * 4000)], "link string, title string, original_summary string")
    found = {r["link"]: r["is_ai_relevant"] for r in classify(rows, term_model(["token", "truncated"])).collect()}
    assert found == {"l": True, "m": False}


def test_a_batch_model_gets_lists(spark):
    rows = spark.createDataFrame([(f"l{k}", "t", "text") for k in range(5)], "link string, title string, original_summary string")
    assert classify(rows.coalesce(1), batch_model(lambda s, p: ["yes"] * len(p))).filter("is_ai_relevant AND NOT failed").count() == 5
    assert classify(rows.coalesce(1), batch_model(lambda s, p: [])).filter("failed").count() == 5


def test_landed_entries_are_whole_when_splits_change(spark, store, sources, tmp_path):
    root = str(tmp_path / "rss")
    items = spark.range(200).select(F.concat(F.lit("l"), F.col("id").cast("string")).alias("link"), F.lit("t").alias("title"))
    items.repartition(7).write.format("xml").option("rootTag", "feed").option("rowTag", "item").save(feeds.landing_folder(root, "u1"))
    items.write.format("xml").option("rootTag", "feed").option("rowTag", "item").save(feeds.landing_folder(root, "u2"))
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        entries = feeds.read_rss(spark, root)
        spark.conf.set("spark.sql.files.minPartitionNum", "12")
        assert store.add_entries(entries, sources, "b1").newly_added == 200
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    plan = feeds.parsed_items(spark, root, "rss", ["u1"])._jdf.queryExecution().executedPlan().toString()
    assert "feed_url" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_guid_links_updated_dates_and_rejected_items(spark, tmp_path):
    root = tmp_path / "rss" / "feed_url=u1"
    root.mkdir(parents=True)
    (root / "a.xml").write_text(
        "<rss><channel><item><guid>http://g/1</guid><title>a</title></item>"
        "<item><guid isPermaLink='false'>id-2</guid><title>b</title></item>"
        "<item><link>http://l/3</link><guid isPermaLink='true'>http://g/3</guid></item>"
        "<item><link>http://l/4</link><title>broken & </title></item></channel></rss>")
    got = {r["title"]: r["link"] for r in feeds.read_rss(spark, str(tmp_path / "rss")).collect()}
    assert got == {"a": "http://g/1", "b": None, None: "http://l/3"}
    rejected = feeds.rejected_items(spark, str(tmp_path / "rss"), "rss")
    assert [tuple(r) for r in feeds.rejected_counts(rejected).collect()] == [("u1", 1)]
    atom = tmp_path / "atom" / "feed_url=u1"
    atom.mkdir(parents=True)
    (atom / "a.xml").write_text("<feed><entry><link href='http://l/1'/><updated>2025-06-01T00:00:00Z</updated></entry></feed>")
    assert feeds.read_atom(spark, str(tmp_path / "atom")).first()["published"] == "2025-06-01T00:00:00Z"
