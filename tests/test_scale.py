"""What keeps runs from reading a whole store: link index, open work, compaction."""

import pytest
from pyspark.sql import functions as F

from newsloom.operators import inference
from newsloom.plans.compaction import Compacted
from newsloom.plans.generations import files_of
from newsloom.plans.lifecycle import Models, publish_digest, run_curation
from newsloom.plans.links import LinkIndex
from newsloom.plans.store import ArticleStore
from newsloom.schemas import FEED_ENTRIES, SOURCES
from newsloom.settings import Settings

MODELS = Models(relevance=inference.term_model(["ai"]), summary=inference.column_model(lambda r: r["title"]))
LONG = "words of the article " * 20


def entries(spark, numbers):
    rows = [("u", k, f"l{k}", "AI" if k % 2 else "garden", None, None, LONG, None, None) for k in numbers]
    return spark.createDataFrame(rows, FEED_ENTRIES)


@pytest.fixture(scope="module")
def catalog(spark):
    return spark.createDataFrame([(0, "s", "u", None, None, None, True)], SOURCES)


@pytest.fixture
def store(spark, tmp_path):
    made = ArticleStore(spark, str(tmp_path / "store"), Settings(link_folders=4, top_n_summaries=-1, digest_size=2))
    made.ensure_tables()
    return made


def state(store):
    return sorted((r["link"], r["id"], r["is_ai_relevant"], r["llm_summary"], r["sent_in_newsletter_at"] is not None)
                  for r in store.articles().collect())


def test_compaction_can_stop_after_each_step(spark, store, catalog):
    for k in range(3):
        run_curation(store, entries(spark, range(4 * k, 4 * k + 4)), catalog, MODELS, f"r{k}")
    publish_digest(store, "d0")
    before = state(store)
    assert len(before) == 12 and sum(r[4] for r in before) == 2
    for table in ("articles_raw", "relevance_facts", "summary_facts", "sent_facts"):
        for stop in range(4):
            for at, _ in enumerate(Compacted(store, table).steps()):
                if at == stop:
                    break
            assert state(store) == before, (table, stop)
        held = Compacted(store, table)
        assert len(files_of(store.read(table))) == 1
        assert held.vacuum() > 0 and held.vacuum() == 0
        assert state(store) == before and not files_of(held.appended())


def test_keys_written_to_after_compaction(spark, store, catalog):
    run_curation(store, entries(spark, range(4)), catalog, MODELS, "r")
    store.compact()
    run_curation(store, entries(spark, range(8)), catalog, MODELS, "r")
    assert [r[0] for r in state(store)] == [f"l{k}" for k in range(8)]
    assert store.of_run("articles_raw", "r").count() == 8
    store.compact()
    pinned = store.raw()
    run_curation(store, entries(spark, range(9)), catalog, MODELS, "r")
    store.compact(target_bytes=1)
    assert pinned.count() == 8 and store.raw().count() == 9
    store.vacuum(keep=2)
    assert pinned.count() == 8
    store.vacuum()
    assert len(state(store)) == 9 and {r[1] for r in state(store)} == set(range(1, 10))
    report = run_curation(store, entries(spark, range(9)), catalog, MODELS, "again")
    assert report.ingest.newly_added == 0 and report.processed == 0


def test_open_work_is_what_a_run_reads(spark, store, catalog):
    for k in range(4):
        run_curation(store, entries(spark, range(6 * k, 6 * k + 6)), catalog, MODELS, f"r{k}")
        publish_digest(store, f"d{k}")
    pending = store.work.pending()
    # Six of the twelve relevant articles are summarized and sent, the others wait; no irrelevant one is read again.
    assert sorted(r["link"] for r in pending["articles_raw"].select("link").collect()) == sorted(
        r[0] for r in state(store) if r[2] and not r[4])
    assert pending["articles_raw"].count() == 4 and pending["relevance_facts"].count() == 4
    assert not any("/articles_raw/" in f and "/open_work/" not in f for f in files_of(pending["articles_raw"]))
    assert "original_summary" not in pending["articles_raw"].columns
    assert store.raw().count() == 24


def test_decisions_bring_finished_articles_back(spark, store, catalog):
    run_curation(store, entries(spark, range(4)), catalog, MODELS, "r")
    assert store.for_summarization(-1).count() == 0
    yes = spark.createDataFrame([("l0", True, "m"), ("unknown", True, "m")], "link string, is_ai_relevant boolean, model string")
    store.record_relevance(yes, "later")
    assert [r["link"] for r in store.for_summarization(-1).collect()] == ["l0"]
    store.work.refresh()
    assert [r["link"] for r in store.for_summarization(-1).collect()] == ["l0"]
    store.record_relevance(yes.withColumn("is_ai_relevant", F.lit(False)), "latest")
    assert store.for_summarization(-1).count() == 0


@pytest.mark.parametrize("compacted", [False, True])
def test_open_work_equals_the_whole_tables(spark, store, catalog, compacted):
    run_curation(store, entries(spark, range(6)), catalog, MODELS, "r0")
    if compacted:
        store.compact()
    store.add_entries(entries(spark, range(4, 9)), catalog, "r1")
    whole = ArticleStore(spark, store.root, store.settings)
    whole.work.generations.root += "-none"
    for queue in (lambda s: s.for_filtering(), lambda s: s.for_summarization(-1), lambda s: s.for_digest(-1)):
        assert queue(store).collect() == queue(whole).collect()


def test_index_opens_only_folders_of_known_links(spark, tmp_path):
    index = LinkIndex(spark, str(tmp_path), folders=8)
    index.ensure()
    links = lambda names: spark.createDataFrame([(n,) for n in names], "link string")
    stored = links([f"a{k}" for k in range(50)]).withColumn("batch_key", F.lit("b"))
    index.announce(stored.filter("link < 'a3'"))
    index.announce(stored.filter("link >= 'a3'"))
    found, opened = index.announced(links(["a7", "new1", "new2", "new3", "new4"]))
    assert [tuple(r) for r in found.collect()] == [("a7", "b")] and len(opened) == 1
    assert index.announced(links([f"n{k}" for k in range(40)]))[1] == []
    assert index.known(links(["a1", "a2", "x"]), stored).count() == 2
    assert index.known(links([]), stored).count() == 0


def test_shared_bits_are_verified(spark, tmp_path):
    """With two bits a folder every link is suspected, and only stored ones are known."""
    index = LinkIndex(spark, str(tmp_path), folders=2, bits=2)
    index.ensure()
    stored = spark.createDataFrame([(f"a{k}", "b") for k in range(9)], "link string, batch_key string")
    index.announce(stored)
    offered = spark.createDataFrame([(f"a{k}",) for k in range(0, 20, 3)], "link string")
    assert len(index.announced(offered)[1]) == 2
    assert sorted(r["link"] for r in index.known(offered, stored).collect()) == ["a0", "a3", "a6"]


def test_links_announced_before_a_crash_are_not_lost(spark, store, catalog, monkeypatch):
    write = store._write
    monkeypatch.setattr(store, "_write", lambda table, *a, **b: (_ for _ in ()).throw(OSError("lost")) if table == "articles_raw" else write(table, *a, **b))
    with pytest.raises(OSError):
        store.add_entries(entries(spark, range(3)), catalog, "r")
    monkeypatch.undo()
    assert store.add_entries(entries(spark, range(3)), catalog, "r").newly_added == 3
    assert store.add_entries(entries(spark, range(4)), catalog, "r2").newly_added == 1
    assert store.raw().count() == 4


def test_a_store_without_an_index_gets_one(spark, store, catalog):
    store.add_entries(entries(spark, range(3)), catalog, "r")
    older = ArticleStore(spark, store.root, store.settings)
    older.links.root += "/elsewhere"
    older.ensure_tables()
    assert older.add_entries(entries(spark, range(5)), catalog, "r2").newly_added == 2
