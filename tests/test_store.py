"""The store: lifecycle, idempotence, first and last writers, ids, skew."""

import pytest
from pyspark.sql import functions as F

from newsloom import constants as C
from newsloom import schemas
from newsloom.operators import facts, insertion, queues, stats
from newsloom.operators.extract import extractive_model
from newsloom.operators.inference import term_model
from newsloom.plans.lifecycle import Models, publish_digest, run_curation
from newsloom.plans.store import TABLES, ArticleStore
from newsloom.settings import Settings
from newsloom.sources.catalogue import catalogue_frame


def entry(feed, ordinal, link, title="t", text=None, published=None):
    return (feed, ordinal, link, title, published, None, text, None, None)


@pytest.fixture
def sources(spark):
    return catalogue_frame(spark, [{"name": "One", "url": "u1"}, {"name": "Two", "url": "u2"}])


@pytest.fixture
def store(spark, tmp_path):
    store = ArticleStore(spark, str(tmp_path / "store"))
    store.ensure_tables()
    return store


def entries_frame(spark, rows):
    return spark.createDataFrame(rows, schemas.FEED_ENTRIES)


def rows_of(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())


def test_lifecycle_of_one_article(spark, store, sources):
    link = "http://example.com/test-unique-article"
    body = "This is the full text of a unique test article."
    batch = entries_frame(spark, [entry("u1", 0, link, "A Unique Test Article", body)])
    report = store.add_entries(batch, sources, "b1")
    assert (report.total_items, report.newly_added) == (1, 1)
    assert [r["link"] for r in store.for_filtering().collect()] == [link]
    assert store.for_summarization().isEmpty()

    yes = spark.createDataFrame([(link, True, "test_filter_model")], "link string, is_ai_relevant boolean, model string")
    assert store.record_relevance(yes, "r1") == 1
    assert store.for_filtering().isEmpty()
    queue = store.for_summarization(10).collect()
    assert [(r["id"], r["title"], r["original_summary"]) for r in queue] == [
        (1, "A Unique Test Article", body)
    ]

    text = spark.createDataFrame([(link, "This is the summary.", "m")], "link string, llm_summary string, model string")
    assert store.record_summaries(text, "r1") == 1
    assert store.for_summarization(10).isEmpty()
    assert [r["llm_summary"] for r in store.for_digest().collect()] == ["This is the summary."]

    ids = spark.createDataFrame([(1,), (99,)], "article_id long")
    assert store.mark_sent(ids, "d1", "s1") == 1
    assert store.for_digest().isEmpty()
    first = store.articles().first()["sent_in_newsletter_at"]
    assert store.mark_sent(ids, "d2", "s2") == 0
    assert store.articles().first()["sent_in_newsletter_at"] == first
    assert store.articles().first()["user_saved"] is False


def test_ensure_tables_keeps_content(spark, store, sources):
    store.add_entries(entries_frame(spark, [entry("u1", 0, "l1")]), sources, "b1")
    store.ensure_tables()
    assert store.raw().count() == 1
    assert {table: store.read(table).columns for table in TABLES} == {
        table: schema.names for table, (schema, _) in TABLES.items()
    }


def test_first_arrival_wins_and_ids_follow_arrival(spark, store, sources):
    rows = [
        entry("u2", 0, "b", "from two"), entry("u1", 5, "b", "from one, later"),
        entry("u1", 3, "b", "from one"), entry("u1", 4, "a", "  a  "), entry("u2", 9, "c", None),
        entry("u1", 6, None), entry("u1", 7, ""), entry("nowhere", 0, "d"),
    ]
    report = store.add_entries(entries_frame(spark, rows), sources, "b1")
    assert (report.total_items, report.newly_added) == (7, 3)
    assert rows_of(store.raw(), "id", "link", "title", "source_name") == [
        (1, "b", "from one", "One"), (2, "a", "a", "One"), (3, "c", C.DEFAULT_TITLE, "Two"),
    ]
    again = store.add_entries(entries_frame(spark, rows), sources, "b2")
    assert (again.total_items, again.newly_added) == (7, 0)
    more = store.add_entries(entries_frame(spark, [*rows, entry("u1", 0, "z")]), sources, "b3")
    assert more.newly_added == 1
    assert rows_of(store.raw(), "id", "link")[-1] == (4, "z")
    assert rows_of(store.latest_inserted(2), "id", "summary_len") == [(3, 0), (4, 0)]


def test_replayed_batch_leaves_the_same_rows(spark, store, sources):
    rows = [entry("u1", i, f"l{i}") for i in range(5)]
    store.add_entries(entries_frame(spark, rows[:2]), sources, "b1")
    first = store.add_entries(entries_frame(spark, rows), sources, "b2")
    before = rows_of(store.raw(), "id", "link")
    assert store.add_entries(entries_frame(spark, rows), sources, "b2") == first
    assert rows_of(store.raw(), "id", "link") == before


def test_last_decision_wins_and_early_ones_are_ignored(spark):
    raw = spark.createDataFrame(
        [(1, "a"), (2, "b"), (3, "c")], "id long, link string"
    ).select(
        "id", "link", *[F.lit("x").alias(n) for n in
                        ("title", "source_name", "original_summary", "published_at")],
        F.lit("2025-01-02 00:00:00").cast("timestamp").alias("fetched_at"),
    )
    relevance = spark.createDataFrame(
        [("a", True, "m1", "2025-01-03", "r1"), ("a", False, "m2", "2025-01-04", "r2"),
         ("b", True, "m1", "2025-01-01", "r1"), ("nobody", True, "m1", "2025-01-03", "r1")],
        "link string, is_ai_relevant boolean, model string, decided_at string, run_key string",
    ).withColumn("decided_at", F.col("decided_at").cast("timestamp"))
    summaries = spark.createDataFrame([], schemas.SUMMARY_FACTS)
    sent = spark.createDataFrame([(3, "2025-01-05"), (3, "2025-01-06")], "article_id long, sent_at string")
    current = facts.current_articles(raw, relevance, summaries, sent)
    assert rows_of(current.na.fill("-", ["ai_filter_model_used"]), "id", "ai_filter_model_used") == [
        (1, "m2"), (2, "-"), (3, "-"),
    ]
    by_id = {r["id"]: r for r in current.collect()}
    assert [by_id[i]["is_ai_relevant"] for i in (1, 2, 3)] == [False, None, None]
    assert by_id[3]["sent_in_newsletter_at"].startswith("2025-01-05")


def test_a_link_that_fills_a_third_of_the_entries(spark, store, sources):
    """Copies of one link stay apart until they are reduced; the result is whole."""
    n = 30_000
    entries = spark.range(n).select(
        F.lit("u1").alias("feed_url"), F.col("id").alias("entry_ordinal"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("l"), F.col("id").cast("string"))).alias("link"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("title"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.FEED_ENTRIES.fields[4:]],
    )
    report = store.add_entries(entries, sources, "b1")
    assert report.total_items == n
    assert report.newly_added == n - n // 3 + 1
    ids = store.raw().agg(F.min("id"), F.max("id"), F.count_distinct("id")).first()
    assert tuple(ids) == (1, report.newly_added, report.newly_added)
    hot = store.raw().filter("link = 'hot'").collect()
    assert [(r["id"], r["title"]) for r in hot] == [(1, "t0")]


def test_dense_ids_equal_a_sort(spark):
    rows = spark.range(5_000).select(
        F.pmod(F.xxhash64("id"), F.lit(7)).alias("source_ordinal"), F.col("id").alias("entry_ordinal")
    )
    numbered = insertion.with_dense_ids(rows.repartition(5), ["source_ordinal", "entry_ordinal"], 10)
    got = [(r["source_ordinal"], r["entry_ordinal"]) for r in numbered.orderBy("id").collect()]
    assert got == sorted(got)
    assert [r["id"] for r in numbered.select("id").orderBy("id").collect()] == list(range(10, 5_010))


def test_stats_of_sources_without_new_entries(spark):
    entries = spark.createDataFrame(
        [(0, "One"), (0, "One"), (1, "Two")], "source_ordinal long, source_name string"
    )
    arrivals = spark.createDataFrame([(0,)], "source_ordinal long")
    assert tuple(stats.ingest_stats(entries, arrivals).first()) == (3, 1)
    assert rows_of(stats.ingest_stats(entries, arrivals, by_source=True), "*") == [
        ("One", 2, 1), ("Two", 1, 0),
    ]
    assert tuple(stats.ingest_stats(entries.limit(0), arrivals).first()) == (0, 0)


def test_text_order_of_dates_and_the_opt_in(spark):
    articles = spark.createDataFrame(
        [(1, "2025-06-05 12:00:01"), (2, "Thu, 05 Jun 2020 23:30:00 GMT"), (3, None),
         (4, "2025-06-05 12:00:01")],
        "id long, published_at string",
    ).withColumns({
        "link": F.lit("l"), "title": F.lit("t"), "source_name": F.lit("s"),
        "original_summary": F.lit("o"), "llm_summary": F.lit("x"),
        "fetched_at": F.lit("2025-07-01").cast("timestamp"), "is_ai_relevant": F.lit(True),
        "sent_in_newsletter_at": F.lit(None).cast("timestamp"),
    })

    def ids(**options):
        return [r["id"] for r in queues.digest_candidates(articles, **options).collect()]

    assert ids() == [2, 1, 4, 3]
    assert ids(order_by="published_ts") == [1, 4, 2, 3]
    assert ids(limit=1) == [2]
    assert ids(limit=0) == []
    assert ids(limit=-1) == [2, 1, 4, 3]
    assert [r["rank"] for r in queues.ranked_candidates(articles, 2).collect()] == [1, 2]


@pytest.fixture
def curated(spark, store, sources):
    texts = {
        "ai": "Machine learning is here. It is big. Learning machines learn.",
        "deep": "A story on neural networks. Networks of networks.",
        "cook": "A story on soup.",
        "blank": "",
    }
    rows = [entry("u1", i, link, f"T & {link}", text, f"2025-06-0{i + 1} 00:00:00")
            for i, (link, text) in enumerate(texts.items())]
    models = Models(
        relevance=term_model(["machine learning", "neural networks", "blank"]),
        summary=extractive_model,
    )
    batch = entries_frame(spark, rows)
    report = run_curation(store, batch, sources, models, "run1")
    return store, batch, models, report


def test_run_and_digest(spark, curated, sources):
    store, batch, models, report = curated
    assert (report.ingest.total_items, report.ingest.newly_added) == (4, 4)
    assert (report.processed, report.retained, report.summarized) == (4, 3, 3)
    summaries = {r["link"]: r["llm_summary"] for r in store.articles().collect()}
    assert summaries["blank"] == C.SUMMARY_NO_CONTENT
    assert summaries["cook"] is None
    assert run_curation(store, batch, sources, models, "run1") == report
    later = run_curation(store, batch, sources, models, "run2")
    assert (later.ingest.newly_added, later.processed, later.summarized) == (0, 0, 0)

    seen = []
    refuse = publish_digest(store, "d0", deliver=lambda subject, html: False)
    assert refuse == 0 and store.for_digest().count() == 3
    sent = publish_digest(
        store, "d1", deliver=lambda subject, html: seen.append((subject, html)) or True,
        date=F.lit("July 04, 2025"),
    )
    assert sent == 3
    (subject, html), = seen
    assert subject == "News Digest - July 04, 2025"
    assert html.index("T &amp; blank") < html.index("T &amp; deep") < html.index("T &amp; ai")
    assert "One • June 04, 2025" in html
    assert publish_digest(store, "d1", date=F.lit("July 04, 2025")) == 3
    assert publish_digest(store, "d2") == 0
    assert store.read("digests").filter("run_key = 'd2'").isEmpty()


def test_digest_without_limit_is_written_in_parts(spark, curated):
    store, *_ = curated
    everything = ArticleStore(spark, store.root, Settings(digest_size=-1))
    assert publish_digest(everything, "all") == 3
    lines = spark.read.text(f"{store.path('digest_parts')}/run_key=all")
    assert lines.filter(F.col("value").startswith("<h2>")).count() == 3
    assert store.for_digest().isEmpty()


def test_empty_batch(spark, store, sources):
    report = store.add_entries(entries_frame(spark, []), sources, "b0")
    assert (report.total_items, report.newly_added) == (0, 0)


def test_pages_give_the_text_and_the_newest_copy_wins(spark, store, sources):
    pages = spark.createDataFrame(
        [(1, "l1", "<article>old " + "x" * 200 + "</article>"),
         (2, "l1", "<article>new " + "y" * 200 + "</article>"),
         (3, "l2", "<article>short</article>"), (4, "other", "<article>no</article>")],
        "page_id long, url string, html string",
    )
    rows = [entry("u1", 0, "l1", text="feed"), entry("u1", 1, "l2", text="<b>a longer feed text</b>"),
            entry("u1", 2, "l3", text="only feed")]
    store.add_entries(entries_frame(spark, rows), sources, "b1", pages)
    texts = {r["link"]: r["original_summary"] for r in store.raw().collect()}
    assert texts["l1"].startswith("new y")
    assert texts["l2"] == "a longer feed text"
    assert texts["l3"] == "only feed"
