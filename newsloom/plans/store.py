"""The article store: append-only Parquet tables below one folder.

A write adds to the partition named by its batch or run and never removes a row. An
ingest adds only links that no batch holds yet, and a stage takes only rows that are
still open, so a retried or replayed run adds nothing and a run key that is used again
keeps what it wrote before. Stored ids and ``fetched_at`` never change. The one thing
that is replaced is the text of a digest, which follows from its stored selection.

Three things keep runs from reading the whole store: an index of the stored links
(``links``), the table of open work (``work``), and files merged by ``compact``.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom import constants as C
from newsloom import schemas
from newsloom.operators import entries as entry_ops
from newsloom.operators import facts, insertion, queues
from newsloom.operators.sizing import broadcast_small
from newsloom.plans.compaction import TARGET_BYTES, Compacted
from newsloom.plans.links import LinkIndex
from newsloom.plans.work import OpenWork
from newsloom.session import checkpointed
from newsloom.settings import Settings
from newsloom.sources.pages import attach_page_text

TABLES: dict[str, tuple[T.StructType, str]] = {
    "articles_raw": (schemas.ARTICLES_RAW, "batch_key"),
    "relevance_facts": (schemas.RELEVANCE_FACTS, "run_key"),
    "summary_facts": (schemas.SUMMARY_FACTS, "run_key"),
    "sent_facts": (schemas.SENT_FACTS, "run_key"),
    "digest_items": (schemas.DIGEST_ITEMS, "run_key"),
    "digests": (schemas.DIGESTS, "run_key"),
}


@dataclass(frozen=True)
class IngestReport:
    total_items: int
    newly_added: int


class ArticleStore:
    def __init__(self, spark: SparkSession, root: str, settings: Settings = Settings()):
        self.spark = spark
        self.root = root.rstrip("/")
        self.settings = settings
        self.links = LinkIndex(spark, self.root, settings.link_folders)
        self.work = OpenWork(self)

    # -- tables ---------------------------------------------------------------

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def ensure_tables(self) -> None:
        """Create what does not exist yet and leave the rest alone."""
        for table, (schema, key) in TABLES.items():
            empty = self.spark.createDataFrame([], schema)
            empty.write.mode("ignore").partitionBy(key).parquet(self.path(table))

        if not self.links.exists():
            self.links.ensure()
            stored = self.raw().select("link", "batch_key")
            if not stored.isEmpty():
                self.links.announce(stored)

    def layout(self, table: str) -> tuple[T.StructType, str]:
        """The schema of a table and its partition column."""
        return TABLES[table]

    def read(self, table: str) -> DataFrame:
        return Compacted(self, table).read()

    def compact(self, tables: Iterable[str] = tuple(TABLES), target_bytes: int = TARGET_BYTES) -> None:
        """Merges the small files of the tables; readers change over at each table's commit."""
        for table in tables:
            for _ in Compacted(self, table).steps(target_bytes):
                pass

    def vacuum(self, keep: int = 1) -> int:
        """Removes merged files that no reader of the ``keep`` last generations needs; how many."""
        return sum(Compacted(self, table).vacuum(keep) for table in TABLES)

    def of_run(self, table: str, key: str) -> DataFrame:
        """The rows of one batch or run; the scan reads its partition alone."""
        return self.read(table).filter(F.col(TABLES[table][1]) == key)

    def _write(self, table: str, df: DataFrame, key: str, mode: str = "append") -> int:
        """Write to one partition and return the rows written, observed during the write."""
        schema, partition = TABLES[table]
        written = Observation()
        columns = [
            F.col(field.name).cast(field.dataType) for field in schema if field.name != partition
        ]
        (
            df.select(*columns)
            .observe(written, F.count(F.lit(1)).alias("rows"))
            .write.mode(mode)
            .parquet(f"{self.path(table)}/{partition}={quote(key, safe='')}")
        )
        return written.get["rows"]

    def raw(self) -> DataFrame:
        return self.read("articles_raw")

    def articles(self) -> DataFrame:
        """Current state of every article."""
        return facts.current_articles(
            self.raw(), self.read("relevance_facts"), self.read("summary_facts"),
            self.read("sent_facts"),
        )

    # -- ingest ---------------------------------------------------------------

    def add_entries(
        self, entries: DataFrame, sources: DataFrame, batch_key: str,
        pages: DataFrame | None = None,
    ) -> IngestReport:
        """Insert the entries of enabled sources whose link no batch holds yet.

        ``newly_added`` counts the offered links that ``batch_key`` holds, so a replay
        reports what its first try did.
        """
        offered = entry_ops.entries_of_sources(entries, sources)
        seen = Observation()
        keys = offered.select("link", *insertion.ARRIVAL).observe(
            seen, F.count(F.lit(1)).alias("rows")
        )
        firsts = checkpointed(insertion.first_arrivals(keys))
        stored = self.raw()
        offered_links = broadcast_small(firsts.select("link"))
        known = self.links.known(offered_links, stored.select("link", "batch_key"))
        before = self.of_run("articles_raw", batch_key).join(offered_links, "link", "left_semi").count()
        arrivals = insertion.with_dense_ids(
            insertion.new_arrivals_of(firsts, known), [*insertion.ARRIVAL, "link"],
            start=insertion.next_id(stored),
        )
        rows = insertion.select_arrivals(offered, arrivals)
        if pages is None:
            rows = rows.withColumn("main_text", F.lit(""))
        else:
            rows = attach_page_text(rows, pages, links=arrivals.select("link"))
        inserted = entry_ops.article_rows(
            rows, self.settings.feed_fallback_threshold, keep=("id",)
        ).withColumn("fetched_at", F.date_trunc("second", F.current_timestamp()))
        # Announced first: an article is never stored without its link in the index.
        self.links.announce(arrivals.select("link", F.lit(batch_key).alias("batch_key")))
        added = self._write("articles_raw", inserted, batch_key)
        return IngestReport(seen.get["rows"], before + added)

    def latest_inserted(self, added: int) -> DataFrame:
        return queues.inserted_sample(self.raw(), added)

    # -- queues ---------------------------------------------------------------
    # Which rows are open is decided over the open work, without the article text
    # and with no more facts than needed; the text is then read for the open rows
    # alone. Joining on the partition column as well lets the scan skip partitions
    # without open rows.

    _QUEUE = ("id", "link", "title", "original_summary")

    def _with_text(self, keys: DataFrame) -> DataFrame:
        text = self.raw().select("batch_key", *self._QUEUE)
        return text.join(keys, ["batch_key", "id"])

    def open_for_filtering(self) -> DataFrame:
        """The articles without a decision, in no order, for a model that needs none."""
        pending = self.work.pending()
        articles = facts.with_relevance(pending["articles_raw"], pending["relevance_facts"])
        keys = articles.filter(queues.needs_relevance()).select("batch_key", "id", "fetched_at")
        return self._with_text(keys)

    def for_filtering(self) -> DataFrame:
        newest = [F.col("fetched_at").desc_nulls_last(), F.col("id")]
        return self.open_for_filtering().orderBy(*newest).select(*self._QUEUE)

    def open_for_summarization(self, limit: int) -> DataFrame:
        """The newest relevant articles without a summary, in no order."""
        pending = self.work.pending()
        articles = facts.with_summary(
            facts.with_relevance(pending["articles_raw"], pending["relevance_facts"]),
            pending["summary_facts"],
        )
        queue = articles.filter(queues.needs_summary())
        if limit >= 0:
            queue = queue.orderBy(*queues.newest_first("published_at")).limit(limit)
        return self._with_text(queue.select("batch_key", "id", "published_at", "fetched_at"))

    def for_summarization(self, limit: int = C.SUMMARY_QUEUE_LIMIT) -> DataFrame:
        order = queues.newest_first("published_at")
        return self.open_for_summarization(limit).orderBy(*order).select(*self._QUEUE)

    def _digest_state(self) -> DataFrame:
        pending = self.work.pending()
        articles = facts.with_relevance(pending["articles_raw"], pending["relevance_facts"])
        summarized = facts.with_summary(articles, pending["summary_facts"])
        return facts.with_sent(summarized, pending["sent_facts"])

    def for_digest(self, limit: int = C.DIGEST_QUEUE_LIMIT) -> DataFrame:
        return queues.digest_candidates(self._digest_state(), limit)

    def ranked_for_digest(self, limit: int) -> DataFrame:
        """The digest candidates with their rank, numbered without a global window."""
        order = queues.newest_first("published_at")
        top = queues.take(self._digest_state().filter(queues.ready_for_digest()).orderBy(*order), limit)
        ranked = insertion.with_dense_ids(
            top.select(*queues.CANDIDATE, "fetched_at").withColumnRenamed("id", "article_id"),
            queues.newest_first("published_at", "article_id"), start=1,
        )
        return ranked.withColumnRenamed("id", "rank").withColumnRenamed("article_id", "id").drop("fetched_at")

    # -- decisions ------------------------------------------------------------

    def record_relevance(self, decisions: DataFrame, run_key: str) -> int:
        """Columns: link, is_ai_relevant, model, provider_used, failed."""
        return self._record("relevance_facts", decisions, run_key)

    def record_summaries(self, summaries: DataFrame, run_key: str) -> int:
        """Columns: link, llm_summary, model, provider_used, summary_status."""
        return self._record("summary_facts", summaries, run_key)

    def _record(self, table: str, decisions: DataFrame, run_key: str) -> int:
        schema, key = TABLES[table]
        for field in schema:
            if field.name not in (*decisions.columns, "decided_at", key):
                decisions = decisions.withColumn(field.name, F.lit(None))
        usable = decisions.filter(F.coalesce(F.col("link"), F.lit("")) != "")
        return self._write(table, usable.withColumn("decided_at", F.current_timestamp()), run_key)

    def mark_sent(self, ids: DataFrame, digest_id: str, run_key: str) -> int:
        """Mark ids (column ``article_id``) that exist and are not marked yet; how many were.

        The first mark of an article stands. Marks carry the link, by which they are read.
        """
        known = self.raw().select(F.col("id").alias("article_id"), "link")
        open_ids = facts.not_yet_sent(ids, self.read("sent_facts"))
        rows = known.join(open_ids, "article_id", "left_semi").select(
            "article_id", "link",
            F.date_trunc("second", F.current_timestamp()).alias("sent_at"),
            F.lit(digest_id).alias("digest_id"),
        )
        return self._write("sent_facts", rows, run_key)

    def digest_selection(self, run_key: str, limit: int) -> DataFrame:
        """The ranked articles of a digest, chosen once and kept under its run key."""
        chosen = self.of_run("digest_items", run_key)
        if chosen.isEmpty():
            self._write("digest_items", self.ranked_for_digest(limit), run_key, mode="overwrite")
            chosen = self.of_run("digest_items", run_key)
        return chosen

    def write_digest(self, documents: DataFrame, run_key: str) -> int:
        return self._write("digests", documents, run_key, mode="overwrite")
